"""Plan properties: no Python UDF, no cartesian product between multi-row
inputs, filters and column lists pushed to the scans."""
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_python_no_cartesian(spark, name):
    p = _plan(E.queries()[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "FlatMapGroupsInPandas"):
        assert bad not in p, f"{name}: {bad}"
    # the only nested-loop joins allowed are against one-row scalar frames
    assert "BroadcastNestedLoopJoin" not in p or name == "load_volumes", name


def test_day_filter_and_pruning_reach_scan(spark):
    from arrears.plans import marts
    from arrears.sources import standins as S
    t = S.DriverTables(spark, SF)
    df = marts.crm_contacts(S.ocorrencias(t), S.eventos(t), S.tipos_ocorrencias(t), S.tipos_eventos(t),
                            S.ligacoes(t), S.usuarios(t), S.EVENT_AS_OF)
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-15T00:00)" in p or \
        "GreaterThanOrEqual(ts" in p
    base = _plan(E.queries()["base_open_instalments"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double," in base
