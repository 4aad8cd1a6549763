"""The marts and derived tables as logged jobs (M3-M10): what each writes, its
volumes, and a re-run that adds nothing.

Appended marts use ``sources.batches`` (rows come once, written once), updated
ones ``sources.ranges`` (only touched days or ranges are rewritten).  Every
count is observed by the write itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from arrears.operators import merge as mg
from arrears.plans import derived, marts, runlog
from arrears.sources import batches, io, ranges

MAILING_RANGE = 5_000_000


def _observed(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), lambda: int(seen.get["n"])


def append_absent(spark: SparkSession, path: str, staged: DataFrame, keys: Sequence[str], run: str,
                  partition: str | None = None, held: Column | None = None, counts_absent: bool = False) -> dict:
    """K1 + K3: append the staged rows whose key the table lacks, as the batch
    ``run``.  Of the table only the partitions that ``held`` selects are read."""
    target = spark.read.schema(staged.schema).parquet(path) if io.exists(spark, path) else spark.createDataFrame([], staged.schema)
    if held is not None:
        target = target.where(held)
    staged, rows = _observed(staged)
    new = mg.insert_absent(target, staged, keys)
    batches.prepare(new, path, run, None if counts_absent else lambda n: rows(), [partition] if partition else None)
    return batches.finish(spark, path, run)


def mailing_attach(spark: SparkSession, path: str, base360: DataFrame, mailing: DataFrame, carteiras: DataFrame, as_of, run: str) -> dict:
    """M3: BaseMailing360, by day.  Its source rows are not counted."""
    staged = marts.mailing_attach(base360, mailing, carteiras, as_of).select("id_base", "data", "id_devedor", "id_titulo", "id_retirada")
    staged = io.stage(staged, path + "#attached")
    table = ranges.DayTable(spark, path, "data", staged.schema)
    table.sweep()
    days = table.touched(staged)
    return table.rewrite(marts.mailing_apply(table.read(days), staged, mark=True), days, run, 0)


def payments(spark: SparkSession, path: str, star: Sequence[DataFrame], base360: DataFrame, run: str) -> dict:
    """M7: Pagamentos360, appended by day of payment.  The payments it lacks are
    staged (they give the days to read); source rows are those and the held ones."""
    acordos, tipos, negociadas, pagar, usuarios, status, origem = star
    schema = marts.payments_mart(*star, base360).withColumn("dia", F.col("data_pagamento")).schema
    mart = spark.read.schema(schema).parquet(path) if io.exists(spark, path) else spark.createDataFrame([], schema)
    seen = Observation()
    keys = marts.payment_keys(acordos, negociadas, pagar, mart).observe(seen, F.count(F.when(F.col("no_mart"), 1)).alias("n"))
    keys = io.stage(keys.where(~F.col("no_mart")), path + "#payments")
    new = marts.payments_of(keys, acordos, tipos, usuarios, status, origem, base360).withColumn("dia", F.col("data_pagamento"))
    batches.prepare(new.select(*schema.fieldNames()), path, run, lambda n: n + int(seen.get["n"]), ["dia"])
    return batches.finish(spark, path, run)


def due(spark: SparkSession, path: str, star: Sequence[DataFrame], base360: DataFrame, as_of, run: str) -> dict:
    """M8: Vencimentos360; inserts and cancellations in one pass over its day."""
    staged, rows = _observed(marts.due_mart(*star, base360, as_of))
    staged = io.stage(staged, path + "#due")
    mg.require_unique(staged, marts.FACT_KEY)
    table = ranges.DayTable(spark, path, "data_vencimento", staged.schema)
    table.sweep()
    days = table.touched(staged)
    new = mg.upsert(table.read(days), staged, marts.FACT_KEY, ["data_cancelamento"], ["data_cancelamento"], mark=True, fill_only=True)
    return table.rewrite(new, days, run, rows())


def agreement_channels(spark: SparkSession, path: str, ocorrencias: DataFrame, ligacoes: DataFrame, run: str) -> dict:
    """M9: OrigemAcordos; its source rows are those it lacks."""
    return append_absent(spark, path, derived.agreement_channel(ocorrencias, ligacoes), ["id_acordo"], run, counts_absent=True)


def mailing(spark: SparkSession, path: str, source: DataFrame, parcelas: DataFrame, titulos: DataFrame,
            ocorrencias: DataFrame, promessas: DataFrame, as_of, run: str) -> dict:
    """Mailing, by ranges of the debtor.  The marked state is staged once,
    as are the returns it rests on; only ranges with a changed row are written."""
    schema = io.T.StructType.fromDDL("id_devedor bigint, id_carteira int, id_retirada int")
    table = ranges.RangeTable(spark, path, "id_devedor", MAILING_RANGE, schema)
    table.sweep()
    held = table.read()
    back = derived.returned_debtors(parcelas, titulos, held, as_of)
    back = back.unionByName(derived.returns_by_reason(derived.return_reasons(ocorrencias, titulos, promessas, as_of), held))
    back, returned = _observed(back)
    back = io.stage(back, path + "#returns")
    state = io.stage(derived.mailing_state(held, source, back), path + "#state")
    days = table.touched(state.where("mudou"))
    counts = runlog.volumes_from_actions(state).first()
    written = state.where(table.range_of().isin(days)) if days else state.where(F.lit(False))
    out = table.rewrite(written.drop("mudou"), days, run, returned() + int(counts["linhas_inseridas"]))
    return out | {k: int(counts[k]) for k in ("linhas_inseridas", "linhas_atualizadas", "linhas_totais_destino")}


def settle(spark: SparkSession, path: str, job: str, source: str, target: str, log_paths: dict, as_of) -> None:
    """Log what an earlier run of the job published and left unlogged."""
    if ranges.is_range_table(spark, path):
        last = ranges.RangeTable(spark, path, "", 1, None).state()["last"]
        unlogged = {last["run"]: last["counts"]} if last else {}
    else:
        unlogged = batches.open_batches(spark, path)
    for run, counts in unlogged.items():
        runlog.log_published(spark, run, job, source, target, counts, log_paths, as_of)
        batches.settle(spark, path, run)


def run(spark: SparkSession, job: str, source: str, target: str, path: str, log_paths: dict, as_of, body: Callable[[str], dict]) -> dict:
    """A mart job with its log: ``body(run_id)`` writes and returns the counts."""
    settle(spark, path, job, source, target, log_paths, as_of)

    def stages(set_stage):
        set_stage("Persistencia final")
        return body(set_stage.run_id)
    counts = runlog.logged_run(spark, job, source, target, log_paths, as_of, stages)
    for r in batches.open_batches(spark, path):
        batches.settle(spark, path, r)
    return counts
