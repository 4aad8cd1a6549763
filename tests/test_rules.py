"""Rules of the loads and the log that their queries do not show."""
import datetime as dt
import os

import pytest

from arrears.operators import incremental as inc
from arrears.operators import merge as mg
from arrears.plans import runlog
from arrears.plans.loads import LOADS
from arrears.sources import io, schemas

DONE = inc.DONE


def test_penultimate_run_is_by_start_not_by_id(spark):
    rows = [("f", "P", dt.datetime(2026, 8, 15, 3), DONE), ("b", "P", dt.datetime(2026, 8, 16, 3), DONE),
            ("d", "P", dt.datetime(2026, 8, 17, 3), DONE), ("a", "P", dt.datetime(2026, 8, 18, 3), "Erro")]
    runs = spark.createDataFrame(rows, f"{inc.RUN_ID} string, {inc.JOB} string, {inc.START} timestamp_ntz, {inc.STATUS} string")
    assert str(inc.watermark_penultimate(runs, ["P"]).first()["watermark"])[:10] == "2026-08-16"


def test_fill_once_takes_the_pair(spark):
    schema = "k int, d date, v int"
    day, other = dt.date(2026, 8, 1), dt.date(2026, 8, 9)
    t = spark.createDataFrame([(1, None, 5), (2, day, None), (3, None, 1)], schema)
    s = spark.createDataFrame([(1, day, 7), (2, other, 7), (3, None, 9)], schema)
    want = {1: (day, 7), 2: (day, None), 3: (None, 1)}
    for out in (mg.fill_null_once(t, s, "k", ["d", "v"]), mg.upsert(t, s, "k", ["d"], ["d", "v"], fill_only=True)):
        assert {r.k: (r.d, r.v) for r in out.collect()} == want


def test_replace_leaves_no_stale_partition(spark, scratch):
    path = scratch + "/t"
    io.replace(spark.createDataFrame([(1, 1), (2, 2)], "k int, p int"), path, ["p"], reads_target=False)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    io.replace(spark.createDataFrame([(1, 1)], "k int, p int"), path, ["p"], reads_target=False)
    assert spark.read.parquet(path).count() == 1


def test_set_columns_and_keys_are_checked(spark):
    t = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError, match="no column"):
        mg.upsert(t, t, "k", ["v"], ["w"])
    mg.require_unique(t.union(t), "k")
    with pytest.raises(ValueError, match="different rows"):
        mg.require_unique(t.union(spark.createDataFrame([(1, 3)], "k int, v int")), "k")


def test_every_load_knows_its_columns():
    for spec in LOADS:
        names = schemas.schema(schemas.TABLES[spec.target]).fieldNames()
        wanted = [*spec.key, *(spec.dedup_key or []), *(c for c in spec.set_cols if c != "*"), *spec.versions, *filter(None, [spec.id_col, spec.date_col])]
        assert not set(wanted) - set(names), spec.job
    assert len(schemas.schema("titulos_info").fields) == 89 and len(schemas.schema("acordos_parcelas_negociadas").fields) == 40


def test_first_run_creates_the_table(spark, scratch):
    spec = next(x for x in LOADS if x.job == "ProcOrigens")
    source = spark.createDataFrame([(1, "a"), (2, "b")], schemas.schema("origens"))
    logs = {k: f"{scratch}/{k}" for k in ("runs", "volumes", "errors")}
    path = f"{scratch}/Origens"
    runs = spark.createDataFrame([], runlog.RUN_SCHEMA)
    for want in (2, 0):
        assert spec.run(spark, source, path, runs, logs, dt.datetime(2026, 8, 17, 3))["linhas_inseridas"] == want
    assert spark.read.parquet(path).count() == 2


def test_run_length_is_measured(spark, scratch):
    import time
    logs = {k: f"{scratch}/{k}" for k in ("runs", "volumes", "errors")}
    runlog.logged_run(spark, "J", "s", "t", logs, dt.datetime(2026, 8, 17, 3), lambda stage: time.sleep(2.1))
    assert runlog.run_status(spark.read.parquet(logs["runs"])).first()["tempo_execucao_segundos"] >= 2


def test_purge_is_logged_table_by_table(spark, scratch):
    config = spark.createDataFrame([(1, "A", "00:00:00"), (2, "B", "00:00:01")], "id_tabela_expurgo int, nome_tabela string, hora_expurgo string")
    done = spark.createDataFrame([], runlog.PURGE_SCHEMA)
    seen = []

    def purge(name):
        if seen:
            raise OSError(name)
        seen.append(name)
    with pytest.raises(OSError):
        runlog.run_purge(spark, config, done, dt.datetime(2026, 8, 17, 3), purge, lambda row: io.append(row, scratch + "/done"))
    assert [r["nome_tabela"] for r in spark.read.parquet(scratch + "/done").collect()] == seen


def test_only_a_missing_path_is_a_first_run(spark, scratch):
    assert not io.exists(spark, scratch + "/none")
    os.makedirs(scratch + "/bad")
    with open(scratch + "/bad/part-0.parquet", "w") as f:
        f.write("not parquet")
    assert io.exists(spark, scratch + "/bad")


@pytest.mark.parametrize("inclusive", [False, True])
def test_extract_bounds_reach_the_scan(spark, scratch, inclusive):
    path = scratch + "/src"
    spark.range(100).selectExpr("id", "timestamp_ntz'2026-01-01' + make_dt_interval(cast(id as int)) v").write.parquet(path)
    source, target = spark.read.parquet(path), spark.range(40)
    for df, n in ((inc.extract_new_or_changed(source, target, "id", "v", dt.date(2026, 4, 1), inclusive), None), (inc.extract_id_or_date(source, target, "id", "v", None), 60)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        pushed = plan[plan.index("PushedFilters"):]
        assert "GreaterThan" in pushed[:200] and (n is None or df.count() == n)
