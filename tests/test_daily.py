"""Two warehouse days end to end on the driver tables, then a re-run."""
import datetime as dt
import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "examples"))

from arrears.plans import runlog  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_two_days_and_rerun(spark, scratch):
    from daily_run import run_day
    d1, d2 = dt.datetime(2024, 1, 15, 12, 0), dt.datetime(2024, 1, 16, 12, 0)
    r1 = run_day(spark, SF, scratch, d1)
    r2 = run_day(spark, SF, scratch, d2)
    again = run_day(spark, SF, scratch, d2)
    assert r1["ocorrencias"]["linhas_inseridas"] > 0 and r2["ocorrencias"]["linhas_inseridas"] > 0
    assert again["ocorrencias"]["linhas_inseridas"] == 0
    assert r1["base360"]["linhas_inseridas"] > 0
    assert again["base360"]["linhas_inseridas"] == 0 and again["base360"]["linhas_atualizadas"] == 0
    assert again["crm360"]["linhas_inseridas"] == 0
    b = spark.read.parquet(f"{scratch}/base360")
    assert sorted(r.data for r in b.select("data").distinct().collect()) == [d1.date(), d2.date()]
    assert b.select("id_base").distinct().count() == b.count()
    occ = spark.read.parquet(f"{scratch}/ocorrencias")
    assert occ.select("id_ocorrencia").distinct().count() == occ.count()
    st = [r.status_execucao for r in runlog.run_status(spark.read.parquet(f"{scratch}/log/runs")).collect()]
    assert len(st) == 15 and set(st) == {"Concluida"}
    assert spark.read.parquet(f"{scratch}/log/volumes").count() == 15
    assert again["discador360"]["linhas_inseridas"] == 0
    assert again["base"]["linhas_inseridas"] == spark.read.parquet(f"{scratch}/base").count() > 0
