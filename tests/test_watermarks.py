"""Watermarks and the payment date (FIXTURES.md part B)."""
import datetime as dt

from arrears.operators import incremental as inc

SCHEMA = "id_execucao long, nome_procedure string, data_hora_inicio timestamp_ntz, status_execucao string"


def _runs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def T(s):
    return dt.datetime.fromisoformat(s)


def test_forward_backward(spark):
    early = _runs(spark, [(1, "J", T("2026-08-17 21:59:00"), "Concluida"),
                          (2, "J", T("2026-08-18 03:00:00"), "Erro"),
                          (3, "J", T("2026-08-18 04:00:00"), "Executando")])
    late = _runs(spark, [(1, "J", T("2026-08-17 22:00:00"), "Concluida")])
    f = inc.watermark_forward(early).first()
    b = inc.watermark_backward(early).first()
    assert (f.watermark, b.watermark) == (dt.date(2026, 8, 17), dt.date(2026, 8, 16))
    assert inc.watermark_forward(late).first().watermark == dt.date(2026, 8, 18)
    assert inc.watermark_backward(late).first().watermark == dt.date(2026, 8, 15)
    none = _runs(spark, [(1, "J", T("2026-08-17 22:00:00"), "Erro")])
    assert inc.watermark_forward(none).count() == 0
    assert spark.range(1).select(inc.watermark_of(none, "J")).first()[0] is None


def test_penultimate(spark):
    r = _runs(spark, [(1, "P", T("2026-08-14 20:00:00"), "Concluida"),
                      (2, "P", T("2026-08-15 22:30:00"), "Concluida"),
                      (3, "P", T("2026-08-16 20:00:00"), "Concluida")])
    assert inc.watermark_penultimate(r).first().watermark == dt.date(2026, 8, 16)
    one = _runs(spark, [(1, "P", T("2026-08-14 20:00:00"), "Concluida")])
    assert inc.watermark_penultimate(one).count() == 0


def test_payment_date(spark):
    w = spark.createDataFrame([(dt.date(2026, 8, 17),), (dt.date(2026, 8, 18),), (dt.date(2026, 8, 16),)],
                              "watermark date")
    got = [r.data_pagamento for r in inc.with_payment_date(w).collect()]
    assert got == [dt.date(2026, 8, 14), dt.date(2026, 8, 17), dt.date(2026, 8, 15)]


def test_extract_null_watermark_modes(spark):
    src = spark.createDataFrame([(1, T("2026-01-01 00:00:00")), (2, T("2026-02-01 00:00:00"))],
                                "id long, v timestamp_ntz")
    tgt = src.filter("id = 2")
    none_w = spark.createDataFrame([], SCHEMA)
    w = inc.watermark_of(none_w, "J")
    assert inc.extract_new_or_changed(src, tgt, "id", "v", w).count() == 2
    assert inc.extract_new_or_changed(src, tgt, "id", "v", w, on_null_watermark="none").count() == 0
    # id branch: id > max (exclusive) / id >= max (inclusive)
    assert inc.extract_new_or_changed(src, tgt, "id", "v", dt.date(2030, 1, 1)).count() == 0
    assert inc.extract_new_or_changed(src, tgt, "id", "v", dt.date(2030, 1, 1), inclusive=True).count() == 1


def test_id_or_date_branch(spark):
    src = spark.createDataFrame([(1, T("2026-01-01 00:00:00")), (5, T("2026-03-01 00:00:00"))],
                                "id long, d timestamp_ntz")
    empty = src.filter("id < 0")
    held = src.filter("id = 1")
    assert [r.id for r in inc.extract_id_or_date(src, held, "id", "d", dt.date(2000, 1, 1)).collect()] == [5]
    assert sorted(r.id for r in inc.extract_id_or_date(src, empty, "id", "d", dt.date(2026, 2, 1)).collect()) == [5]
