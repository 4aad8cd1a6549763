"""Hot keys: one contract / debtor / agreement holds a third of the rows.
Results must be whole and equal to a brute-force pandas computation; the
plans must split the hot key (AQE skew join) or pre-aggregate it."""
import datetime as dt
from decimal import Decimal as D

import pandas as pd
import pytest
from pyspark.sql import functions as F

from arrears.operators import merge as mg
from arrears.plans import derived, snapshot

N = 30_000
AS_OF = dt.datetime(2026, 8, 17)


@pytest.fixture()
def skew_conf(spark):
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _instalments(spark):
    pdf = pd.DataFrame({
        "id_titulo": [7 if i % 3 == 0 else i for i in range(N)],
        "numero_parcela": [i % 13 + 1 for i in range(N)],
        "id_situacao_parcela": ["A" if i % 5 else "P" for i in range(N)],
        "valor_principal": [D(i % 997) + D("0.0100") for i in range(N)],
        "data_vencimento": [AS_OF - dt.timedelta(days=i % 40 - 20) for i in range(N)],
        "data_inclusao": [AS_OF - dt.timedelta(days=100 + i % 7) for i in range(N)],
        "data_reabertura": [None] * N,
    })
    schema = ("id_titulo long, numero_parcela int, id_situacao_parcela string, valor_principal decimal(19,4), "
              "data_vencimento timestamp_ntz, data_inclusao timestamp_ntz, data_reabertura timestamp_ntz")
    return pdf, spark.createDataFrame(pdf, schema).repartition(16)


def test_open_instalments_hot_contract(spark, skew_conf):
    pdf, df = _instalments(spark)
    got = {r.id_titulo: (r.numero_parcela, r.risco, r.saldo_vencido)
           for r in snapshot.open_instalments(df, AS_OF).collect()}
    o = pdf[pdf.id_situacao_parcela == "A"]
    exp = {}
    for k, g in o.groupby("id_titulo"):
        over = g[g.data_vencimento < AS_OF].valor_principal
        exp[k] = (int(g.numero_parcela.min()), sum(g.valor_principal, D(0)),
                  sum(over, D(0)) if len(over) else None)
    assert got == exp
    assert len(got) == len(exp) and got[7][1] == exp[7][1]


def test_attach_hot_debtor_whole_and_split(spark, skew_conf):
    """Calls of a debtor holding a third of them attach to every contract of
    that debtor (an equi join whose output is the result itself)."""
    calls = spark.createDataFrame([(1 if i % 3 == 0 else i % 500 + 2, i) for i in range(N)], "d long, call long")
    base = spark.createDataFrame([(1, c) for c in range(5)] + [(d, 100 + d) for d in range(2, 502)],
                                 "d long, contract long")
    j = calls.join(base, "d")
    out = j.collect()                         # runs this plan, so AQE's final plan is recorded on it
    assert len(out) == (N // 3) * 5 + (N - N // 3)
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan, plan[:2000]


def test_lowest_id_per_hot_agreement(spark):
    oc = pd.DataFrame({"id_ocorrencia": list(range(N)),
                       "id_acordo": [9 if i % 3 == 0 else i // 2 for i in range(N)],
                       "id_ligacao": [i if i % 4 else None for i in range(N)]})
    lig = pd.DataFrame({"id_ligacao": list(range(0, N, 2)), "id_origem_ligacao": ["A", "M"] * (N // 4)})
    oc_rows = [(int(a), int(b), None if pd.isna(c) else int(c)) for a, b, c in oc.itertuples(index=False)]
    got = {r.id_acordo: r.id_origem_acordo for r in derived.agreement_channel(
        spark.createDataFrame(oc_rows, "id_ocorrencia long, id_acordo long, id_ligacao long"),
        spark.createDataFrame(lig, "id_ligacao long, id_origem_ligacao string")).collect()}
    m = oc.merge(lig, on="id_ligacao", how="left")
    m["ch"] = m.id_origem_ligacao.fillna("H")
    exp = {k: g.sort_values("id_ocorrencia").ch.iloc[0] for k, g in m.groupby("id_acordo")}
    assert got == exp


def test_wildcard_hot_debtor(spark, skew_conf):
    tgt = spark.createDataFrame([(None if i % 2 else i % 7, 1 if i % 3 == 0 else i) for i in range(3000)],
                                "c int, d long")
    stg = spark.createDataFrame([(i % 5, 1 if i % 3 == 0 else i) for i in range(3000)], "c int, d long")
    got = sorted(((-1 if r.c is None else r.c), r.d) for r in mg.wildcard_semi(tgt, stg, "d", "c").collect())
    t, s = tgt.toPandas(), stg.toPandas()
    exp = sorted((-1 if pd.isna(r.c) else int(r.c), int(r.d)) for r in t.itertuples()
                 if ((s.d == r.d) & ((s.c == r.c) if not pd.isna(r.c) else True)).any())
    assert got == exp


def test_null_keys_bypass_lookup(spark):
    """Two thirds of the facts have no call: they must not be shuffled into
    one partition, and every fact row must come back once."""
    from arrears.operators.joins import left_lookup
    facts = spark.createDataFrame([(i, i if i % 3 == 0 else None) for i in range(N)], "id long, id_ligacao long")
    calls = spark.createDataFrame([(i, "A") for i in range(0, N, 6)], "id_ligacao long, origem string")
    out = left_lookup(facts, calls, "id_ligacao")
    got = {r.id: r.origem for r in out.collect()}
    assert len(got) == N and out.count() == N
    assert sum(1 for v in got.values() if v == "A") == N // 6
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Union" not in plan      # the input is read once
