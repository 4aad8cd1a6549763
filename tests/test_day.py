"""Three warehouse days, one of them stopped in the middle and resumed, held
against a plain re-computation of what each job had to load."""
import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from arrears.operators import incremental as inc
from arrears.plans import day as day_module
from arrears.plans import jobs, marts, runlog
from arrears.plans.day import Day
from arrears.sources import day_standins, io, ranges
from arrears.sources import standins as S

SF = "/root/testdata/sf0.001"
DAYS = [dt.datetime(2024, 1, 15 + k, 12) for k in range(3)]
#: Read by no other job, left out for time.
UNREAD = {"ProcDevedoresInformacoesComplementares", "ProcTelefones", "ProcOrigens", "ProcOrigensLigacoes"}
#: Their sources don't change after the first day; run on that day only, for time.
STILL = {"ProcTitulosInformacoesComplementares", "ProcEscob", "ProcPropensao", "ProcUsuarios", "Carteiras", "ProcProdutos", "ProcStatusAcordos", "ProcTiposAcordos",
         "ProcTiposEventos", "ProcTiposOcorrencias", "ProcDevedores"}


class Stopped(Exception):
    pass


def plain(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """The warehouse after three days; the second stopped before L14."""
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    root = str(tmp_path_factory.mktemp("warehouse"))
    for k in (13, 14):  # earlier runs of the parent load give the first watermark
        at = dt.datetime(2024, 1, k, 12)
        run, opened = runlog.start_run(spark, "ProcAcordos", at)
        io.append(opened.unionByName(runlog.finish_run(spark, run, "ProcAcordos", at, at)), f"{root}/log/runs")
    t, seen, expected = S.DriverTables(spark, SF), [], []
    for k, as_of in enumerate(DAYS):
        d = Day(spark, root, day_standins.sources(t, as_of), as_of)
        names = [n for n in d.jobs() if n not in UNREAD and (not k or n not in STILL)]
        expected += [(n, as_of.date()) for n in names]
        seen.append({n: plain(d.sources[n], *cols) for n, cols in (
            ("Acordos", ("id_acordo", "data_inclusao", "data_aprovacao_proposta", "data_cancelamento", "id_status_acordo")),
            ("AcordosParcelasPagar", ("id_acordo_parcela_pagar", "id_acordo", "data_vencimento", "data_pagamento")),
            ("AcordosParcelasNegociadas", ("id_acordo_parcela_negociada", "id_acordo")))})
        if k == 1:
            sound = d.sources["AcordosInformacoesComplementares"]
            d.sources["AcordosInformacoesComplementares"] = sound.withColumn("id_acordo", F.raise_error(F.lit("source went away")).cast("int"))
            with pytest.raises(Exception, match="source went away"):
                d.run(names)
            assert "ProcAcordos" in d.finished() and "AcordosInformacoesComplementares" not in d.finished()
            d.sources["AcordosInformacoesComplementares"] = sound
            first = d.finished()
            rest = d.run(names)
            assert not first & set(rest) and first | set(rest) == set(names)
        else:
            d.run(names)
    assert d.run(names) == {}                                  # a finished day has nothing left to do
    return d, seen, expected


def as_date(v):
    return v.date() if isinstance(v, dt.datetime) else v


def test_each_job_ends_once_a_day(spark, world):
    d, _, expected = world
    log = d.run_log().where("data_hora_inicio >= '2024-01-15'").collect()
    done = Counter((r.nome_procedure, r.data_hora_inicio.date()) for r in log if r.status_execucao == inc.DONE)
    assert done == Counter(expected)
    failed = [r for r in log if r.status_execucao == inc.FAILED]
    assert [(r.nome_procedure, r.data_hora_inicio) for r in failed] == [("AcordosInformacoesComplementares", DAYS[1])]
    assert spark.read.parquet(d.log_paths["errors"]).count() == 1
    assert spark.read.parquet(d.log_paths["volumes"]).count() == len(expected)


def test_agreement_loads_against_plain_code(world):
    """L11-L14 day by day, by sets; the day that was resumed must load what an unbroken one loads."""
    d, seen, _ = world
    acordos, pagar, negociadas = {}, {}, set()
    for as_of, src in zip(DAYS, seen):
        w = as_of.date() - dt.timedelta(days=1)
        paid_day = w - dt.timedelta(days=3 if w.weekday() == 0 else 1)
        today = as_of.date()
        scope = {a[0] for a in src["Acordos"] if any(x is not None and as_date(x) >= w for x in a[1:4])}
        kids = {p[1] for p in src["AcordosParcelasPagar"] if (p[3] and p[3] >= paid_day) or (p[2] and w <= p[2] <= today)}
        for a in src["Acordos"]:
            if a[0] in scope | kids:
                acordos[a[0]] = a[2:]
        chosen = [p for p in src["AcordosParcelasPagar"] if p[1] in scope or p[3] == paid_day or (p[2] and w <= p[2] <= today)]
        held = {x[1] for x in negociadas}
        by_date = {p[1] for p in src["AcordosParcelasPagar"] if p[3] == paid_day or (p[2] and w <= p[2] <= today)}
        negociadas |= {x for x in src["AcordosParcelasNegociadas"] if x[1] in scope | by_date and x[1] not in held}
        for p in chosen:
            if p[0] not in pagar or (pagar[p[0]] is None and p[3] is not None):
                pagar[p[0]] = p[3]
    got = d.table("Acordos")
    assert {r.id_acordo: (r.data_aprovacao_proposta, r.data_cancelamento, r.id_status_acordo) for r in got.collect()} == acordos and len(acordos) > 400
    assert {r.id_acordo_parcela_pagar: r.data_pagamento for r in d.table("AcordosParcelasPagar").collect()} == pagar
    assert set(plain(d.table("AcordosParcelasNegociadas"), "id_acordo_parcela_negociada", "id_acordo")) == negociadas
    assert {r.id_acordo for r in d.table("AcordosInformacoesComplementares").collect()} >= {x[1] for x in negociadas}


def test_payments_and_due_marts_against_plain_code(spark, world):
    d = world[0]
    snap = {(r.id_devedor, r.id_titulo, r.data): r.id_base for r in spark.read.parquet(d.path("Base360")).collect()}
    owner = {r.id_acordo: r.id_devedor for r in d.table("Acordos").collect()}
    known = {r.id_acordo for r in spark.read.parquet(d.path("OrigemAcordos")).collect()}
    contracts = {(r.id_acordo, r.id_titulo) for r in d.table("AcordosParcelasNegociadas").collect()}
    dims = {r.id_acordo for r in d.table("Acordos").collect() if r.id_tipo_acordo and r.id_negociador_responsavel and r.id_status_acordo}
    paid = {(r.id_acordo, r.numero_parcela, r.data_pagamento) for r in d.table("AcordosParcelasPagar").collect() if r.data_pagamento}
    want = {(snap[owner[a], t, day], a, n) for a, n, day in paid for b, t in contracts if a == b and a in known & dims and (owner.get(a), t, day) in snap}
    mart = spark.read.parquet(d.path("Pagamentos360"))
    assert set(plain(mart, *marts.FACT_KEY)) == want and mart.count() == len(want) > 50
    due = ranges.RangeTable(spark, d.path("Vencimentos360"), "", 1, marts.due_mart(*d._star(), d._snapshot(), d.as_of).schema).read()
    assert due.select("data_vencimento").distinct().count() == 3 and due.select(*marts.FACT_KEY).distinct().count() == due.count() > 150


def test_marts_run_again_add_nothing(spark, world):
    d = world[0]
    for again in (d.base360, d.mailing, d.base_mailing, d.channels, d.crm, d.dialer, d.digital_dialer, d.payments, d.due):
        c = again()
        assert c["linhas_inseridas"] == 0 and (again == d.mailing or c["linhas_atualizadas"] == 0), again.__name__


def test_cancellations_of_the_afternoon_are_filled_once(spark, world):
    """M8: the same day at 18:00, when the cancellations of 15:00 are known; then once more."""
    d = world[0]
    late = Day(spark, d.root, day_standins.sources(S.DriverTables(spark, SF), DAYS[2].replace(hour=18)), DAYS[2].replace(hour=18))
    star = late._star()
    star[0] = late.sources["Acordos"]
    schema = marts.due_mart(*star, late._snapshot(), late.as_of).schema
    read = lambda: ranges.RangeTable(spark, d.path("Vencimentos360"), "", 1, schema).read()
    before = {tuple(r[c] for c in marts.FACT_KEY): r.data_cancelamento for r in read().where(F.col("data_vencimento") == DAYS[2].date()).collect()}
    known = {r.id_acordo: r.data_cancelamento for r in star[0].collect()}
    c = jobs.due(spark, d.path("Vencimentos360"), star, late._snapshot(), late.as_of, "late-run")
    want = {k: v or known[k[1]] for k, v in before.items()}
    after = {tuple(r[c_] for c_ in marts.FACT_KEY): r.data_cancelamento for r in read().where(F.col("data_vencimento") == DAYS[2].date()).collect()}
    assert after == want and c["linhas_inseridas"] == 0 and c["linhas_atualizadas"] == sum(before[k] != want[k] for k in want) > 5
    assert jobs.due(spark, d.path("Vencimentos360"), star, late._snapshot(), late.as_of, "later-run")["linhas_atualizadas"] == 0


def test_new_payments_prune_the_snapshot_history(spark, world):
    """Only the day partitions that the new payments fall on are scanned."""
    d = world[0]
    star, base360 = d._star(), d._snapshot()
    mart = spark.read.parquet(d.path("Pagamentos360"))
    last = DAYS[2].date()
    # payments that nothing attaches stay new, and their days are looked at again; leave them out
    star[3] = star[3].join(mart.select("id_acordo").distinct(), "id_acordo", "left_semi")
    new = marts.payments_new(*star, base360, mart.where(F.col("data_pagamento") != last))
    plan = new._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "Base360" in x)
    filters = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "data#" in filters and "2024-01-17" in filters and "2024-01-16" not in filters
    assert new.count() == mart.where(F.col("data_pagamento") == last).count() > 0


def test_order_of_jobs():
    after = {"c": ["b"], "b": ["a"]}
    assert day_module.ordered(["c", "a", "b"], after) == ["a", "b", "c"] and day_module.ordered(["c"], after) == ["c"]
    with pytest.raises(ValueError):
        day_module.ordered(["a"], {"a": ["b"], "b": ["a"]})
