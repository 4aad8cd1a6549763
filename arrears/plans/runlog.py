"""Run control kept as tables (R1-R4): runs, volumes, errors, purges.

Log tables are append-only: a state change of a run is a new row, and the
current state of a run is the latest row per run id -- computed with a
partial aggregate (``max`` of a struct), never by updating in place.
"""

from __future__ import annotations

import datetime as _dt
import json
import time
import traceback
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.functions import derive as X
from arrears.operators.incremental import DONE, FAILED, RUNNING

RUN_SCHEMA = T.StructType([
    T.StructField("id_execucao", T.StringType()),
    T.StructField("nome_procedure", T.StringType()),
    T.StructField("data_hora_inicio", T.TimestampNTZType()),
    T.StructField("data_hora_fim", T.TimestampNTZType()),
    T.StructField("status_execucao", T.StringType()),
    T.StructField("registrado_em", T.TimestampNTZType()),
])
VOLUME_SCHEMA = T.StructType([
    T.StructField("id_execucao", T.StringType()),
    T.StructField("nome_tabela_origem", T.StringType()),
    T.StructField("nome_tabela_destino", T.StringType()),
    T.StructField("linhas_origem", T.LongType()),
    T.StructField("linhas_inseridas", T.LongType()),
    T.StructField("linhas_atualizadas", T.LongType()),
    T.StructField("linhas_totais_destino", T.LongType()),
    T.StructField("data_execucao", T.TimestampNTZType()),
])
ERROR_SCHEMA = T.StructType([
    T.StructField("id_execucao", T.StringType()),
    T.StructField("nome_procedure", T.StringType()),
    T.StructField("data_erro", T.TimestampNTZType()),
    T.StructField("mensagem_erro", T.StringType()),
    T.StructField("etapa_erro", T.StringType()),
])
PURGE_SCHEMA = T.StructType([
    T.StructField("id_tabela_expurgo", T.IntegerType()),
    T.StructField("nome_tabela", T.StringType()),
    T.StructField("data_execucao", T.TimestampNTZType()),
])


def _ts(v) -> _dt.datetime:
    if isinstance(v, _dt.datetime):
        return v
    return _dt.datetime.fromisoformat(str(v))


# ---- R1 ------------------------------------------------------------------

def start_run(spark: SparkSession, job: str, as_of) -> tuple[str, DataFrame]:
    """Open a run: a new id (UUID, D10) and its ``Executando`` row."""
    run_id = str(uuid.uuid4())
    at = _ts(as_of)
    return run_id, spark.createDataFrame([(run_id, job, at, None, RUNNING, at)], RUN_SCHEMA)


def finish_run(spark: SparkSession, run_id: str, job: str, started, at, ok: bool = True) -> DataFrame:
    """Close a run as ``Concluida`` or ``Erro`` (a new row; D13: in the log
    it was opened in)."""
    return spark.createDataFrame(
        [(run_id, job, _ts(started), _ts(at), DONE if ok else FAILED, _ts(at))], RUN_SCHEMA)


def run_status(run_rows: DataFrame) -> DataFrame:
    """Current state of every run (latest row per run id) with its
    duration in whole seconds (X10, NULL while running)."""
    latest = (run_rows.groupBy("id_execucao")
              .agg(F.max(F.struct(F.col("registrado_em"), F.col("data_hora_fim"),
                                  F.col("status_execucao"), F.col("nome_procedure"),
                                  F.col("data_hora_inicio"))).alias("_r")))
    return latest.select(
        "id_execucao",
        F.col("_r.nome_procedure").alias("nome_procedure"),
        F.col("_r.data_hora_inicio").alias("data_hora_inicio"),
        F.col("_r.data_hora_fim").alias("data_hora_fim"),
        X.seconds_between(F.col("_r.data_hora_inicio"), F.col("_r.data_hora_fim"))
        .cast("decimal(18,0)").alias("tempo_execucao_segundos"),
        F.col("_r.status_execucao").alias("status_execucao"),
    )


# ---- R2 / R3 -------------------------------------------------------------

def log_volume(spark: SparkSession, run_id: str, source: str, target: str, counts: dict, at) -> DataFrame:
    """Volume row; NULL counts become 0 and the total is inserted + updated
    (D19: counters start at 0)."""
    i = int(counts.get("linhas_inseridas") or 0)
    u = int(counts.get("linhas_atualizadas") or 0)
    return spark.createDataFrame([(run_id, source, target, int(counts.get("linhas_origem") or 0),
                                   i, u, i + u, _ts(at))], VOLUME_SCHEMA)


def volumes_from_actions(marked: DataFrame, staged_rows: DataFrame | None = None,
                         action_col: str = "acao") -> DataFrame:
    """A10 as one aggregate over a marked result (I / U / N ...): counts of
    inserted and updated rows, and the staged row count when given."""
    agg = marked.agg(
        F.count(F.when(F.col(action_col) == "I", 1)).alias("linhas_inseridas"),
        F.count(F.when(F.col(action_col).isin("U", "R"), 1)).alias("linhas_atualizadas"))
    if staged_rows is not None:
        agg = agg.crossJoin(staged_rows.agg(F.count(F.lit(1)).alias("linhas_origem")))
    else:
        agg = agg.withColumn("linhas_origem", F.lit(None).cast("long"))
    return agg.select(
        F.coalesce("linhas_origem", F.lit(0)).cast("long").alias("linhas_origem"),
        F.col("linhas_inseridas").cast("long").alias("linhas_inseridas"),
        F.col("linhas_atualizadas").cast("long").alias("linhas_atualizadas"),
        (F.col("linhas_inseridas") + F.col("linhas_atualizadas")).cast("long").alias("linhas_totais_destino"))


def volumes_of(marked: DataFrame, counted: DataFrame, action_col: str = "acao") -> DataFrame:
    """A10 of a run in one aggregate: ``counted`` are its source rows, ``marked``
    the new target."""
    n = marked.select(action_col).unionByName(counted.select(F.lit("S").alias(action_col)))
    agg = n.agg(*(F.count(F.when(F.col(action_col) == a, 1)).alias(c) for a, c in (("S", "linhas_origem"), ("I", "linhas_inseridas"), ("U", "linhas_atualizadas"))))
    return agg.withColumn("linhas_totais_destino", F.col("linhas_inseridas") + F.col("linhas_atualizadas"))


def log_error(spark: SparkSession, run_id: str, job: str, stage: str, exc: BaseException, at) -> DataFrame:
    """Error row with the stage name and the full message."""
    msg = "".join(traceback.format_exception_only(type(exc), exc)).strip()
    return spark.createDataFrame([(run_id, job, _ts(at), msg, stage)], ERROR_SCHEMA)


# ---- R4 / C4 -------------------------------------------------------------

def purge_due(config: DataFrame, done: DataFrame, as_of) -> DataFrame:
    """C4: configured tables whose purge hour has been reached at ``as_of``
    and that were not purged yet today (A9: distinct done ids with a
    marker; left join).  D26: decided on the rows, not on ids 1..n."""
    day = X.date_lit(as_of).cast("timestamp_ntz")
    clock = F.date_format(X.ts_lit(as_of), "HH:mm:ss")
    today = (done.filter(F.col("data_execucao") >= day).select("id_tabela_expurgo").distinct()
             .withColumn("executado", F.lit(1)))
    return (config.join(today, "id_tabela_expurgo", "left")
            .filter((F.col("hora_expurgo") <= clock) & F.col("executado").isNull())
            .select("id_tabela_expurgo", "nome_tabela", "hora_expurgo"))


def run_purge(spark: SparkSession, config: DataFrame, done: DataFrame, as_of, purge_fn, log_fn=None) -> DataFrame:
    """Empty each due table once (K6 via ``purge_fn(name)``) and return
    the purge-log rows.  ``log_fn(row_frame)`` is called right after each
    purge, so a failure half-way keeps the log of the tables already
    emptied.  The due list is the one thing collected: a configuration
    list, bounded by the number of configured tables."""
    rows = []
    for r in purge_due(config, done, as_of).collect():
        purge_fn(r["nome_tabela"])
        rows.append((int(r["id_tabela_expurgo"]), r["nome_tabela"], _ts(as_of)))
        if log_fn is not None:
            log_fn(spark.createDataFrame(rows[-1:], PURGE_SCHEMA))
    return spark.createDataFrame(rows, PURGE_SCHEMA)


def log_published(spark: SparkSession, run_id: str, job: str, source: str, target: str, counts: dict, log_paths: dict, at) -> None:
    """R2 and R1 of a run whose rows are in its table: its volume row and its
    end, each unless the log has it.  Used when a job died after publishing its
    rows and before logging them; asks for one run id only."""
    from arrears.sources import io

    def missing(log: str, schema, where) -> bool:
        return not io.exists(spark, log_paths[log]) or spark.read.schema(schema).parquet(log_paths[log]).where(where & (F.col("id_execucao") == run_id)).limit(1).isEmpty()

    if missing("volumes", VOLUME_SCHEMA, F.col("nome_tabela_destino") == target):
        io.append(log_volume(spark, run_id, source, target, counts, at), log_paths["volumes"])
    if missing("runs", RUN_SCHEMA, F.col("status_execucao") == DONE):
        opened = None if not io.exists(spark, log_paths["runs"]) else (
            spark.read.schema(RUN_SCHEMA).parquet(log_paths["runs"]).where(F.col("id_execucao") == run_id).agg(F.min("data_hora_inicio")).first()[0])
        io.append(finish_run(spark, run_id, job, opened or at, at, ok=True), log_paths["runs"])


# ---- compaction ------------------------------------------------------------

def compact(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """Replace the files of an append-only log by one; returns how many it had.

    The log of runs keeps the latest row of each run, which is its state; the
    others keep all rows.  Rows appended meanwhile stay as the tail.  The new
    file is written beside the log; then a plan (what comes, what goes) is put
    down, and only then files move: ``recover_compaction`` carries out a plan
    that a job left behind, and a file without a plan is dropped.  Until the old
    files are gone a reader may see a run's state twice, which ``run_status``
    counts once.
    """
    from arrears.sources.ranges import _path, write_text
    recover_compaction(spark, path)
    p, fs = _path(spark, path)
    old = [f.getPath().getName() for f in fs.listStatus(p) if f.getPath().getName().endswith(".parquet")] if fs.exists(p) else []
    if len(old) < 2:
        return len(old)
    rows = spark.read.schema(schema).parquet(*(f"{path.rstrip('/')}/{name}" for name in old))
    if schema == RUN_SCHEMA:
        rest = [c for c in rows.columns if c not in ("id_execucao", "registrado_em")]
        latest = rows.groupBy("id_execucao").agg(F.max(F.struct("registrado_em", "data_hora_fim", *(c for c in rest if c != "data_hora_fim"))).alias("r"))
        rows = latest.select("id_execucao", "r.*").select(*rows.columns)
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{_COMPACT}/rows")
    write_text(spark, f"{path.rstrip('/')}/{_COMPACT}/plan.json", json.dumps(old))
    recover_compaction(spark, path)
    return len(old)


_COMPACT = "_compact"


def recover_compaction(spark: SparkSession, path: str) -> None:
    """Carry out the plan of a compaction that has one, drop one that has none."""
    from arrears.sources.ranges import _path, read_text
    base = f"{path.rstrip('/')}/{_COMPACT}"
    p, fs = _path(spark, base)
    if not fs.exists(p):
        return
    jpath, plan = spark._jvm.org.apache.hadoop.fs.Path, read_text(spark, f"{base}/plan.json")
    if plan is not None:
        rows = jpath(f"{base}/rows")
        for f in (fs.listStatus(rows) if fs.exists(rows) else []):
            name = f.getPath().getName()
            if name.endswith(".parquet"):
                fs.rename(f.getPath(), jpath(path, name))
        for name in json.loads(plan):
            fs.delete(jpath(path, name), False)
    fs.delete(p, True)


class _Stage:
    """Names the stage a job is in; ``run_id`` is its run."""

    def __init__(self, run_id: str):
        self.run_id, self.name = run_id, "Carga"

    def __call__(self, name: str) -> None:
        self.name = name


def logged_run(spark: SparkSession, job: str, source: str, target: str, log_paths: dict, as_of,
               body, finished_at=None) -> dict:
    """R1-R3 around any job: open the run (``Executando``), run
    ``body(stage_setter)`` -- it returns the counts dict, may name its
    current stage and finds the run id in ``stage_setter.run_id`` -- then append the volume row and close the run as
    ``Concluida``; on an exception append the error row with the stage
    name, close as ``Erro`` and re-raise."""
    from arrears.sources import io
    run_id, opened = start_run(spark, job, as_of)
    io.append(opened, log_paths["runs"])
    stage = _Stage(run_id)
    began = time.monotonic()

    def end():
        return finished_at or _ts(as_of) + _dt.timedelta(seconds=int(time.monotonic() - began))
    try:
        counts = body(stage) or {}
        io.append(log_volume(spark, run_id, source, target, counts, end()), log_paths["volumes"])
        io.append(finish_run(spark, run_id, job, as_of, end(), ok=True), log_paths["runs"])
        return counts
    except Exception as exc:  # noqa: BLE001 - logged and re-raised
        io.append(log_error(spark, run_id, job, stage.name, exc, end()), log_paths["errors"])
        io.append(finish_run(spark, run_id, job, as_of, end(), ok=False), log_paths["runs"])
        raise
