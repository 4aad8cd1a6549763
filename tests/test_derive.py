"""Edge frames of FIXTURES.md part B for the scalar rules."""
from decimal import Decimal as D

from pyspark.sql import functions as F

from arrears.functions import derive as X


def _one(spark, schema, data, expr):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_value_band(spark):
    data = [(D("500.0000"), D("9")), (D("500.0100"), D("9")), (None, D("20000.0000")),
            (None, D("20000.0100")), (D("80000.0100"), None), (D("-1.0000"), None), (None, None)]
    got = _one(spark, "v decimal(19,4), r decimal(19,4)", data, X.value_band("v", "r"))
    assert got == ["01. 0 a 500", "02. 501 a 1000", "06. 7001 a 20000", "07. 20000 a 80000",
                   "08. Acima de 80000", "01. 0 a 500", "00. Sem faixa"]


def test_delay_band(spark):
    data = [("02", -5), ("11", 90), ("2", 91), ("2", 2301), ("01", 4), ("1", 5), ("1", 31), ("1", 2301),
            ("1", None), ("3", 100)]
    df = spark.createDataFrame(data, "a string, d int").withColumn("s", X.sub_product("a"))
    got = [(r.s, r.b) for r in df.select("s", X.delay_band("s", "d").alias("b")).collect()]
    assert got == [("NCOR", "01. Menor que 91"), ("NCOR", "01. Menor que 91"), ("NCOR", "02. 91 a 180"),
                   ("NCOR", "09. Acima de 2300"), ("BPF", "00. Sem faixa"), ("BPF", "01. 5 a 30"),
                   ("BPF", "02. 31 a 60"), ("BPF", "11. Acima de 2300"), ("BPF", "00. Sem faixa"),
                   (None, "00. Sem faixa")]


def test_score_code_first_non_null_decides(spark):
    data = [(None, "A01", "W1"), ("A4", "A0", None), ("B1", "A0", None), (None, None, None)]
    got = _one(spark, "a string, b string, c string", data, X.score_code("a", "b", "c"))
    assert got == ["A1", "A3", None, None]


def test_padding_phone_duration(spark):
    got = _one(spark, "s string", [("12345678901",), ("12345",), ("12345678000199",)], X.pad_tax_id("s"))
    assert got == ["00012345678901", "000000012345", "12345678000199"]
    r = spark.createDataFrame([("11987654321", 30)], "p string, n int").select(
        X.area_code("p"), X.local_number("p"), X.seconds_to_day_fraction("n")).first()
    assert (r[0], r[1]) == ("11", "987654321") and abs(r[2] - 30 / 86400) < 1e-15
    assert _one(spark, "s string", [("",), ("x",), (None,)], X.empty_to_null("s")) == [None, "x", None]


def test_contact_flags(spark):
    data = [(1, None, 0), (1, 7, 1), (2, None, 2), (None, None, None)]
    df = spark.createDataFrame(data, "o int, a int, c int")
    got = [tuple(r) for r in df.select(X.attended_flag("o", "a"), X.agreement_flag("a"),
                                       X.right_party_flag("c")).collect()]
    assert got == [(None, None, None), (1, 1, 1), (1, None, None), (None, None, None)]


def test_sentinel_compares(spark):
    df = spark.createDataFrame([(None, None), (None, "1900-01-01 00:00:00"), ("2026-08-01 00:00:00", None)],
                               "a string, b string").select(F.col("a").cast("timestamp_ntz").alias("a"),
                                                            F.col("b").cast("timestamp_ntz").alias("b"))
    assert [r[0] for r in df.select(X.differs_date("a", "b")).collect()] == [False, False, True]
    n = spark.createDataFrame([(None, 0), (1, None), (2, 2)], "a int, b int")
    assert [r[0] for r in n.select(X.differs_num("a", "b")).collect()] == [False, True, False]


def test_money_sum_exact_and_null(spark):
    df = spark.createDataFrame([(1, D("0.1000")), (1, D("0.2000")), (2, None)], "k int, v decimal(19,4)")
    got = dict((r.k, r.s) for r in df.groupBy("k").agg(X.money_sum("v").alias("s")).collect())
    assert got == {1: D("0.3000"), 2: None}
    assert df.groupBy("k").agg(X.money_sum("v").alias("s")).schema["s"].dataType.simpleString() == "decimal(19,4)"
