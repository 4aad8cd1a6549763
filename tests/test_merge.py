"""Change detection and maintenance rules (C1-C6, K3-K5, J12) on tiny frames,
"""
import datetime as dt

from pyspark.sql import functions as F

from arrears.operators import merge as mg

from conftest import rows

S = "k long, v timestamp_ntz, x string"
T0 = dt.datetime(1900, 1, 1)
D1 = dt.datetime(2026, 8, 1)


def test_version_compare(spark):
    # source/target: NULL/NULL unchanged; NULL/1900-01-01 unchanged; date/NULL update;
    # key absent insert; key only in target kept.
    src = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, D1, "c"), (4, D1, "d")], S)
    tgt = spark.createDataFrame([(1, None, "a0"), (2, T0, "b0"), (3, None, "c0"), (5, D1, "e0")], S)
    assert rows(mg.drop_unchanged(src, tgt, "k", ["v"]), "k") == [(3,), (4,)]
    up = mg.upsert(tgt, src, "k", ["v"], ["x", "v"], mark=True)
    got = {r.k: (r.x, r.acao) for r in up.collect()}
    assert got == {1: ("a0", "N"), 2: ("b0", "N"), 3: ("c", "U"), 4: ("d", "I"), 5: ("e0", "N")}


def test_null_safe_variant(spark):
    src = spark.createDataFrame([(1, None, "a"), (2, T0, "b")], S)
    tgt = spark.createDataFrame([(1, None, "a"), (2, None, "b")], S)
    assert rows(mg.drop_unchanged(src, tgt, "k", ["v"], null_safe=True), "k") == [(2,)]


def test_update_unless_equal(spark):
    tgt = spark.createDataFrame([(1, D1, "old"), (2, None, "old"), (3, D1, "old")], S)
    src = spark.createDataFrame([(1, D1, "new"), (2, None, "new"), (3, T0, "new")], S)
    got = {r.k: r.x for r in mg.update_unless_equal(tgt, src, "k", "v", ["x"]).collect()}
    assert got == {1: "old", 2: "new", 3: "new"}


def test_fill_null_once(spark):
    d2 = dt.datetime(2026, 9, 1)
    tgt = spark.createDataFrame([(1, None, "a"), (2, D1, "b"), (3, None, "c")], S)
    src = spark.createDataFrame([(1, D1, "a"), (2, d2, "b"), (3, None, "c")], S)
    got = {r.k: r.v for r in mg.fill_null_once(tgt, src, "k", ["v"]).collect()}
    assert got == {1: D1, 2: D1, 3: None}


def test_wildcard_key(spark):
    tgt = spark.createDataFrame([(None, 10), (5, 11), (5, 12)], "c int, d long")
    stg = spark.createDataFrame([(7, 10), (6, 11), (None, 12)], "c int, d long")
    assert rows(mg.wildcard_semi(tgt, stg, "d", "c"), "d") == [(10,)]
    assert rows(mg.wildcard_semi(tgt, stg, "d", "c", anti=True), "d") == [(11,), (12,)]


def test_flag_missing_scope(spark):
    tgt = spark.createDataFrame([(1, dt.date(2026, 8, 17), None), (2, dt.date(2026, 8, 17), None),
                                 (3, dt.date(2026, 8, 16), None), (4, dt.date(2026, 8, 17), 1)],
                                "k long, data date, f int")
    snap = spark.createDataFrame([(1,)], "k long")
    out = mg.flag_missing(tgt, snap, "k", "f", 1, scope=F.col("data") >= F.lit("2026-08-17").cast("date"))
    assert rows(out, "k", "f") == [(1, None), (2, 1), (3, None), (4, 1)]


def test_upsert_idempotent_and_unique(spark):
    src = spark.createDataFrame([(i, D1 if i % 2 else None, f"x{i}") for i in range(50)], S)
    tgt = spark.createDataFrame([(i, None, "old") for i in range(0, 50, 3)], S)
    once = mg.upsert(tgt, src, "k", ["v"], ["x", "v"], mark=True)
    c = {r.acao: r.n for r in once.groupBy("acao").agg(F.count("*").alias("n")).collect()}
    staged = src.count()
    unchanged = mg.upsert(tgt, src, "k", ["v"], ["x", "v"]).join(src, ["k", "v", "x"], "left_semi").count()
    assert c.get("I", 0) + c.get("U", 0) <= staged <= unchanged + c.get("I", 0) + c.get("U", 0)
    state = once.drop("acao")
    assert state.select("k").distinct().count() == state.count()
    twice = mg.upsert(state, src, "k", ["v"], ["x", "v"], mark=True)
    assert twice.filter("acao <> 'N'").count() == 0
    assert rows(twice.drop("acao")) == rows(state)


def test_insert_absent_keeps_batch_duplicates(spark):
    tgt = spark.createDataFrame([(1, None, "a")], S)
    stg = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (2, None, "b")], S)
    assert mg.insert_absent(tgt, stg, "k").count() == 2


def test_null_safe_drop_unchanged_on_one_lineage(spark):
    src = spark.createDataFrame([(1, None, "a"), (2, T0, "b"), (3, D1, "c")], S)
    held = src.filter("k <> 3").withColumn("v", F.lit(None).cast("timestamp_ntz"))
    assert rows(mg.drop_unchanged(src, held, "k", ["v"], null_safe=True), "k") == [(2,), (3,)]
    assert rows(mg.drop_unchanged(src, held, "k", ["v"]), "k") == [(3,)]
