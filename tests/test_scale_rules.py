"""Key-list reduction by bloom filters, log compaction, text compares of the server."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from arrears.operators import incremental as inc
from arrears.operators import joins
from arrears.plans import runlog, snapshot
from arrears.session import REDUCE_CONF
from arrears.sources import io, schemas
from arrears.sources import standins as S

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def conf(spark):
    """As on a cluster, where no side of these joins is small: no broadcast, filters from any size on."""
    wanted = {**REDUCE_CONF, "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffled(df):
    """Rows written by the exchanges of a query that has run."""
    def walk(p):
        m = p.metrics().get("shuffleRecordsWritten") if p.nodeName() == "Exchange" else None
        kids = p.children()
        return (int(m.get().value()) if m is not None and m.isDefined() else 0) + sum(walk(kids.apply(i)) for i in range(kids.size()))
    return walk(df._jdf.queryExecution().executedPlan())


def collected(df):
    rows = df._jdf.queryExecution().executedPlan().executeCollectPublic()
    return len(rows)


def base(t, keys):
    late = S.parcelas(t).filter((F.col("id_situacao_parcela") == "A") & (F.col("data_vencimento") >= F.lit("2001-06-01").cast("timestamp_ntz")))
    return snapshot.base_snapshot(snapshot.open_instalments(late, S.CONTRACT_AS_OF), S.titulos(t), S.devedores(t), S.carteiras(t), titulos_info=S.titulos_info(t),
                                  escob=S.escob(t), propensao=S.propensao(t), open_keys=late.select("id_titulo") if keys else None)


def test_contract_sides_are_reduced_before_their_shuffle(spark, conf):
    t = S.DriverTables(spark, SF)
    plain, reduced = base(t, False), base(t, True)
    text = reduced._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("might_contain") >= 3 and "might_contain" not in plain._jdf.queryExecution().optimizedPlan().toString()
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(plain) == rows(reduced) and len(rows(reduced)) > 0

    def contract_rows(df):
        n = collected(df)
        assert n
        return shuffled(df)
    assert contract_rows(reduced) < contract_rows(plain)


def test_reduce_by_keys_is_a_semi_join(spark):
    df, keys = spark.range(10).withColumnRenamed("id", "k"), spark.createDataFrame([(3,), (3,), (None,), (40,)], "k long")
    assert [r.k for r in joins.reduce_by_keys(df, keys, "k").collect()] == [3]


# ---- logs

def a_log(spark, path, runs=500, files=40):
    """Twice as many state rows as runs, in many files."""
    at = lambda i: dt.datetime(2026, 1, 1) + dt.timedelta(hours=i)
    rows = []
    for i in range(runs):
        job = f"Proc{i % 7}"
        rows.append((f"run-{i}", job, at(i), None, inc.RUNNING, at(i)))
        if i % 11:
            rows.append((f"run-{i}", job, at(i), at(i) + dt.timedelta(minutes=5), inc.DONE if i % 5 else inc.FAILED, at(i) + dt.timedelta(minutes=5)))
    spark.createDataFrame(rows, runlog.RUN_SCHEMA).repartition(files).write.parquet(path)
    return len(rows)


def facts(spark, path):
    log = runlog.run_status(spark.read.schema(runlog.RUN_SCHEMA).parquet(path))
    marks = [sorted(map(str, f(log).collect())) for f in (inc.watermark_forward, inc.watermark_backward, inc.watermark_penultimate)]
    return sorted(map(str, log.collect())), marks


def parquet_files(path):
    return sorted(f for f in os.listdir(path) if f.endswith(".parquet"))


def test_compaction_keeps_states_and_watermarks(spark, scratch):
    path = f"{scratch}/runs"
    assert a_log(spark, path) > 900
    before = facts(spark, path)
    assert runlog.compact(spark, path, runlog.RUN_SCHEMA) == 40 and len(parquet_files(path)) == 1
    assert facts(spark, path) == before and spark.read.parquet(path).count() == 500
    run, opened = runlog.start_run(spark, "Proc0", dt.datetime(2026, 8, 1))
    io.append(opened, path)                                     # the tail
    assert len(facts(spark, path)[0]) == 501
    runlog.compact(spark, path, runlog.RUN_SCHEMA)
    assert len(facts(spark, path)[0]) == 501 and len(parquet_files(path)) == 1
    assert runlog.compact(spark, path, runlog.RUN_SCHEMA) == 1  # nothing to do
    assert runlog.compact(spark, f"{scratch}/none", runlog.RUN_SCHEMA) == 0


class Killed(BaseException):
    pass


@pytest.mark.parametrize("moved", [None, 0, 1])
def test_compaction_that_dies(spark, scratch, monkeypatch, moved):
    """Killed before its plan, before any file moves, or after the new file came and one old one went."""
    path = f"{scratch}/runs"
    a_log(spark, path, 60, 12)
    before = facts(spark, path)
    real, calls = runlog.recover_compaction, []

    def dies(sp, p):
        calls.append(p)
        if len(calls) == 1:
            return real(sp, p)
        if moved:
            base = f"{path}/_compact/rows"
            new = parquet_files(base)[0]
            old = parquet_files(path)[0]
            os.rename(f"{base}/{new}", f"{path}/{new}")
            os.remove(f"{path}/{old}")
        raise Killed

    def no_plan(*a):
        raise Killed
    with monkeypatch.context() as m:
        if moved is None:
            from arrears.sources import ranges
            m.setattr(ranges, "write_text", no_plan)
        else:
            m.setattr(runlog, "recover_compaction", dies)
        with pytest.raises(Killed):
            runlog.compact(spark, path, runlog.RUN_SCHEMA)
    assert facts(spark, path) == before                         # readers in between see every state once
    runlog.compact(spark, path, runlog.RUN_SCHEMA)
    assert facts(spark, path) == before and len(parquet_files(path)) == 1 and spark.read.parquet(path).count() == 60
    assert not os.path.exists(f"{path}/_compact")


def test_other_logs_keep_all_rows(spark, scratch):
    path = f"{scratch}/volumes"
    for i in range(5):
        io.append(runlog.log_volume(spark, f"r{i % 2}", "s", "t", {"linhas_inseridas": i}, dt.datetime(2026, 8, 1)), path)
    runlog.compact(spark, path, runlog.VOLUME_SCHEMA)
    assert sorted(r.linhas_inseridas for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 4] and len(parquet_files(path)) == 1


# ---- text

def test_server_text(spark):
    df = spark.createDataFrame([("Ab ", 1), ("aB", 2), ("AB  ", 3), ("x", 4), (None, 5)], "cluster string, v int")
    c = schemas.as_server_text(df, "escob")
    assert c.groupBy("cluster").count().count() == 3
    assert c.where(F.col("cluster").isin("ab")).count() == 3 and c.where(F.col("cluster") == "X ").count() == 1
    other = schemas.as_server_text(spark.createDataFrame([("AB",)], "cluster string"), "escob")
    assert sorted(r.v for r in c.join(other, "cluster").collect()) == [1, 2, 3]
    assert sorted(r.v for r in c.join(other, "cluster", "left_anti").collect()) == [4, 5]
    assert schemas.as_plain_text(c).where(F.col("cluster") == "aB").count() == 1 and schemas.as_server_text(df, "titulos").schema == df.schema
    for table, columns in schemas.COMPARED.items():
        assert set(columns) <= set(schemas.schema(table).fieldNames())
