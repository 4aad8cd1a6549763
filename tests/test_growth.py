"""What must not grow with a hot key, a long history or a wide table."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from arrears.operators.joins import in_snapshot, left_lookup, semi_by_ids
from arrears.plans import loads
from arrears.sources import load_standins as LS
from arrears.sources import standins as S


@pytest.fixture()
def shuffled_joins(spark):
    """Every join by a shuffle into 16 partitions that stay as they are."""
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rows_without_a_key_are_spread_over_the_partitions(spark, shuffled_joins):
    facts = spark.range(20_000).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).alias("id_ligacao"))
    calls = spark.range(20_000).select(F.col("id").alias("id_ligacao"), F.lit("A").alias("origem"))
    out = left_lookup(facts, calls, "id_ligacao")
    assert (out.count(), out.where("origem IS NOT NULL").count(), out.where("id_ligacao IS NULL").count()) == (20_000, 2_000, 18_000)
    most = out.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert most < 5_000


def exchanged(df):
    """Rows written by the exchanges of a query, which is run."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollectPublic()

    def walk(p):
        m = p.metrics().get("shuffleRecordsWritten") if p.nodeName() == "Exchange" else None
        kids = p.children()
        return (int(m.get().value()) if m is not None and m.isDefined() else 0) + sum(walk(kids.apply(i)) for i in range(kids.size()))
    return walk(plan)


def test_a_long_history_is_not_shuffled_by_the_day(spark, shuffled_joins):
    days = F.explode(F.sequence(F.lit(dt.date(1969, 11, 1)), F.lit(dt.date(1970, 3, 31))))  # on both sides of day 0
    history = spark.range(0, 200, 1, 4).select((F.col("id") % 20).alias("id_devedor"), F.col("id").alias("id_titulo"), days.alias("data")).where("id_titulo <> 7 OR data <> DATE '1970-01-05'")
    days_paid = F.explode(F.sequence(F.lit(dt.date(1969, 10, 30)), F.lit(dt.date(1970, 4, 2))))
    paid = spark.range(5, 9).select((F.col("id") % 20).alias("id_devedor"), F.col("id").alias("id_titulo"), days_paid.alias("dia"))
    out = in_snapshot(paid, history, "dia")
    plain = paid.join(history.withColumnRenamed("data", "dia"), ["id_devedor", "id_titulo", "dia"])
    rows = lambda df: sorted(map(tuple, df.select("id_titulo", "dia").collect()))
    assert rows(out) == rows(plain) and len(rows(out)) == 4 * 151 - 1
    assert exchanged(out) < 3_000 < exchanged(plain)


def test_wide_children_are_kept_by_id_without_a_shuffle(spark, shuffled_joins):
    ids = [-2**31, -65, -64, -1, 0, 1, 63, 64, 65, 2**31 - 1]
    wide = spark.createDataFrame([(i, f"{i} {n}") for i in [*ids, -3, 2, 66, None] for n in (1, 2)], "id_acordo int, texto string")
    wanted = spark.createDataFrame([(i,) for i in [*ids, *ids, None, 77]], "id_acordo int")
    out = semi_by_ids(wide, wanted, "id_acordo")
    assert sorted(map(tuple, out.collect())) == sorted((i, f"{i} {n}") for i in ids for n in (1, 2))
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_the_load_of_wide_children_shuffles_keys_only(spark, shuffled_joins):
    spec = loads.LOADS_BY_JOB["AcordosParcelasNegociadas"]
    t = S.DriverTables(spark, "/root/testdata/sf0.001")
    source, target = LS.source_and_target(t, spec.target)
    staged = spec.plan(source, target, watermark=dt.date(1998, 8, 31), as_of=dt.datetime(1998, 9, 1), inputs=LS.inputs(t))
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert staged.count() > 0 and "valor_cobrado" not in "".join(x for x in plan.splitlines() if "Exchange" in x or "Sort " in x)
    wide = [x for x in plan.split("Exchange hashpartitioning")[1:] if "valor_cobrado" in x]
    assert not wide
