"""The registered queries: one per operator group of the inventory, each
running the library's jobs over the stand-ins of the driver tables.

Each builder takes ``(spark, sf_dir)`` and returns a lazy ``DataFrame``.
Surrogate snapshot ids (``id_base``, a 64-bit Spark hash) are dropped from
outputs -- they key the tables but cannot be recomputed by the oracle; the
natural key (debtor, contract, day) is kept instead.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.functions import derive as X
from arrears.operators import incremental as inc
from arrears.operators import merge as mg
from arrears.plans import derived, loads, marts, runlog, snapshot
from arrears.sources import load_standins as LS
from arrears.sources import schemas
from arrears.sources import standins as S
from arrears.sources.standins import CONTRACT_AS_OF as C_AS_OF
from arrears.sources.standins import EVENT_AS_OF as E_AS_OF

# Load clock of the contract world: last successful load on Monday
# 1998-08-31 (so the payment date is Friday 1998-08-28).
C_WATERMARK = _dt.date(1998, 8, 31)
C_PAY_DATE = _dt.date(1998, 8, 28)
# Contracts included up to this day were held by the target before the run.
C_HELD_BEFORE = _dt.datetime(1998, 1, 1)


def _t(spark: SparkSession, sf_dir: str) -> S.DriverTables:
    return S.DriverTables(spark, sf_dir)


# ---------------------------------------------------------------- snapshot

def _base(t: S.DriverTables, as_of, parcel_filter=None) -> DataFrame:
    p = S.parcelas(t)
    if parcel_filter is not None:
        p = p.filter(parcel_filter)
    return snapshot.base_snapshot(
        snapshot.open_instalments(p, as_of), S.titulos(t), S.devedores(t), S.carteiras(t),
        titulos_info=S.titulos_info(t), escob=S.escob(t), propensao=S.propensao(t))


def _base360(t: S.DriverTables, as_of, lines_filter=None) -> DataFrame:
    """Base360 of ``as_of``'s day; ``lines_filter`` on the driver lineitem."""
    if lines_filter is not None:
        t = _Filtered(t, lineitem=t.lineitem.filter(lines_filter))
    return snapshot.base360_derive(_base(t, as_of), as_of)


class _Filtered(S.DriverTables):
    """Driver tables with one table replaced by a filtered view."""

    def __init__(self, base: S.DriverTables, **override):
        super().__init__(base.spark, base.sf_dir)
        self._cache.update(base._cache)
        self._cache.update(override)


def q_base_open_instalments(spark, sf_dir):
    return snapshot.open_instalments(S.parcelas(_t(spark, sf_dir)), C_AS_OF)


def q_base_snapshot(spark, sf_dir):
    return _base(_t(spark, sf_dir), C_AS_OF)


def q_base_snapshot_products(spark, sf_dir):
    """M1 whole: with the product join (J1) and the reopening dates of the
    instalment info (A1), which open instalments are joined to."""
    t = _t(spark, sf_dir)
    open_ = snapshot.open_instalments(S.parcelas_com_id(t), C_AS_OF, S.parcelas_info(t))
    return snapshot.base_snapshot(open_, S.titulos(t), S.devedores(t), S.carteiras(t), titulos_info=S.titulos_info(t), escob=S.escob(t),
                                  propensao=S.propensao(t), produtos=S.produtos(t))


def q_base_snapshot_reduced(spark, sf_dir):
    """The contract-keyed sides reduced to the contracts of open instalments first."""
    t = _t(spark, sf_dir)
    keys = S.parcelas(t).filter(F.col("id_situacao_parcela") == snapshot.OPEN).select("id_titulo")
    return snapshot.base_snapshot(snapshot.open_instalments(S.parcelas(t), C_AS_OF), S.titulos(t), S.devedores(t), S.carteiras(t),
                                  titulos_info=S.titulos_info(t), escob=S.escob(t), propensao=S.propensao(t), open_keys=keys)


def q_base_snapshot_untidy(spark, sf_dir):
    """D8 behind F4 / X3 / X4: states, business areas and scores with mixed case
    and trailing blanks, compared as the server does."""
    t, text = _t(spark, sf_dir), schemas.as_server_text
    base = snapshot.base_snapshot(
        snapshot.open_instalments(text(S.untidy_parcelas(t), "parcelas"), C_AS_OF), S.titulos(t), S.devedores(t), S.carteiras(t),
        titulos_info=text(S.untidy_titulos_info(t), "titulos_info"), escob=text(S.untidy_cluster(t, S.escob(t)), "escob"),
        propensao=text(S.untidy_cluster(t, S.propensao(t)), "propensao"))
    return schemas.as_plain_text(base.withColumn("sub_produto", X.sub_product("area_negocio")).drop("area_negocio"))


def q_calls_by_name(spark, sf_dir):
    """D8 behind J2: calls joined to debtors by a name typed in any case, with
    blanks; debtors without a call by the anti join."""
    t = _t(spark, sf_dir)
    name = F.collate(F.col("razao_social_nome"), schemas.SERVER_TEXT).alias("nome")
    calls, debtors = S.named_calls(t).select("id_ligacao", name), S.devedores(t).select("id_devedor", name)
    called = calls.join(debtors, "nome").select("id_devedor", "id_ligacao")
    silent = mg.insert_absent(calls, debtors, ["nome"]).select("id_devedor", F.lit(None).cast("bigint").alias("id_ligacao"))
    return called.unionByName(silent)


def q_base360_derived(spark, sf_dir):
    return _base360(_t(spark, sf_dir), C_AS_OF).drop("id_base")


def q_base360_upsert(spark, sf_dir):
    """Earlier run of the day had not seen instalments with return flag N."""
    t = _t(spark, sf_dir)
    target = _base360(t, C_AS_OF, F.col("l_returnflag") != "N")
    staged = _base360(t, C_AS_OF)
    return snapshot.base360_apply(target, staged, C_AS_OF).drop("id_base")


def q_base360_withdrawn(spark, sf_dir):
    """Instalments with return flag R were withdrawn since the earlier run."""
    t = _t(spark, sf_dir)
    target = _base360(t, C_AS_OF)
    staged = _base360(t, C_AS_OF, F.col("l_returnflag") != "R")
    return snapshot.base360_apply(target, staged, C_AS_OF).drop("id_base")


# -------------------------------------------------------------- watermarks

def q_watermark_forward(spark, sf_dir):
    return inc.watermark_forward(S.runs(_t(spark, sf_dir)))


def q_watermark_backward(spark, sf_dir):
    return inc.watermark_backward(S.runs(_t(spark, sf_dir)))


def q_watermark_penultimate(spark, sf_dir):
    return inc.watermark_penultimate(S.runs(_t(spark, sf_dir)))


def q_watermark_penultimate_any_ids(spark, sf_dir):
    """W3 over run ids that are not in time order, as the engine's own are."""
    runs = S.runs(_t(spark, sf_dir))
    return inc.watermark_penultimate(runs.withColumn(inc.RUN_ID, F.md5(F.col(inc.RUN_ID).cast("string"))))


def q_payment_date(spark, sf_dir):
    return inc.with_payment_date(inc.watermark_forward(S.runs(_t(spark, sf_dir))))


# ----------------------------------------------------------------- extracts

def _events_held(t, before=E_AS_OF):
    return t.events.filter(F.col("ts") <= X.ts_lit(before))


def q_extract_new(spark, sf_dir):
    t = _t(spark, sf_dir)
    return inc.extract_new(t.events, _events_held(t), "event_id")


def q_extract_new_filtered(spark, sf_dir):
    t = _t(spark, sf_dir)
    return inc.extract_new(t.events, _events_held(t), "event_id", F.col("event_type") == "purchase")


def _titulos_held(t):
    """Contracts as the target held them before the run: only those
    included before 1998, plan-5 versions one day older, plan-4 versions
    unknown (NULL)."""
    s = S.titulos(t).filter(F.col("data_inclusao") < X.ts_lit(C_HELD_BEFORE))
    v = F.col("data_atualizacao")
    return s.withColumns({
        "plano": F.when(F.col("situacao") == "P", F.col("plano") + 1).otherwise(F.col("plano")),
        "data_atualizacao": F.when(F.col("plano") == 5, v - F.make_dt_interval(F.lit(1)))
        .when(F.col("plano") == 4, F.lit(None)).otherwise(v),
    })


def q_extract_new_or_changed(spark, sf_dir):
    t = _t(spark, sf_dir)
    return inc.extract_new_or_changed(S.titulos(t), _titulos_held(t), "id_titulo", "data_atualizacao",
                                      C_WATERMARK, inclusive=True)


def q_extract_id_or_date(spark, sf_dir):
    t = _t(spark, sf_dir)
    held = t.events.filter(F.col("ts") < X.ts_lit("2024-01-10 00:00:00"))
    w = inc.watermark_of(S.runs(t), "purchase", "forward")
    return inc.extract_id_or_date(t.events, held, "event_id", "ts", w)


def q_extract_id_or_date_initial(spark, sf_dir):
    """Empty target (nothing held before 2000): by date from the run-log
    watermark of the job."""
    t = _t(spark, sf_dir)
    held = t.events.filter(F.col("ts") < X.ts_lit("2000-01-01 00:00:00"))
    w = inc.watermark_of(S.runs(t), "purchase", "forward")
    return inc.extract_id_or_date(t.events, held, "event_id", "ts", w)


AGREEMENT_DATES = ["data_inclusao", "data_cancelamento", "data_aprovacao_proposta"]


def _acordos_held(t):
    return S.acordos(t).filter(F.col("data_inclusao") < X.ts_lit(C_WATERMARK))


def q_extract_agreements(spark, sf_dir):
    """H6 U H7 (U3): agreements with a date since the watermark, or with an
    instalment paid from the payment date on / due since the watermark,
    not already held with the same status (and dates, branch 1)."""
    t = _t(spark, sf_dir)
    src, held = S.acordos(t), _acordos_held(t)
    b1 = mg.drop_unchanged(inc.extract_multi_date(src, AGREEMENT_DATES, C_WATERMARK), held, ["id_acordo"],
                           ["id_status_acordo", "data_cancelamento", "data_aprovacao_proposta"])
    b2 = mg.drop_unchanged(
        inc.extract_by_child_dates(src, S.acordos_parcelas_pagar(t), "id_acordo", "data_pagamento",
                                   "data_vencimento", C_WATERMARK, C_PAY_DATE, C_AS_OF),
        held, ["id_acordo"], ["id_status_acordo"])
    return b1.unionByName(b2).distinct()


def _scope_lists(t):
    src = S.acordos(t)
    pagar = S.acordos_parcelas_pagar(t)
    by_parent = inc.parents_in_scope(src, "id_acordo", AGREEMENT_DATES, C_WATERMARK)
    by_child = pagar.filter((F.col("data_pagamento") == X.date_lit(C_PAY_DATE))
                            | F.col("data_vencimento").between(X.date_lit(C_WATERMARK), X.date_lit(C_AS_OF)))
    return by_parent, by_child


def q_extract_children_scope(spark, sf_dir):
    t = _t(spark, sf_dir)
    by_parent, by_child = _scope_lists(t)
    return inc.extract_children(S.acordos_parcelas_negociadas(t), "id_acordo", [by_parent, by_child])


def q_extract_due_instalments(spark, sf_dir):
    t = _t(spark, sf_dir)
    by_parent, _ = _scope_lists(t)
    return inc.extract_due_children(S.acordos_parcelas_pagar(t), "id_acordo", by_parent, "data_pagamento",
                                    "data_vencimento", C_WATERMARK, C_PAY_DATE, C_AS_OF)


PARCEL_KEY = ["id_titulo", "numero_parcela"]


def q_extract_instalments_initial(spark, sf_dir):
    t = _t(spark, sf_dir)
    p = S.parcelas(t)
    held = p.filter(F.col("data_vencimento") < X.ts_lit("1900-01-01 00:00:00"))
    return inc.extract_instalments(p, held, PARCEL_KEY, "data_atualizacao", "data_inclusao",
                                   "id_situacao_parcela", "A", C_WATERMARK)


def q_extract_instalments_next(spark, sf_dir):
    t = _t(spark, sf_dir)
    p = S.parcelas(t)
    held = p.filter(F.col("data_inclusao") < X.ts_lit(C_WATERMARK))
    return inc.extract_instalments(p, held, PARCEL_KEY, "data_atualizacao", "data_inclusao",
                                   "id_situacao_parcela", "A", C_WATERMARK)


def q_extract_info_by_parent_state(spark, sf_dir):
    t = _t(spark, sf_dir)
    p = S.parcelas(t)
    info = p.select(*PARCEL_KEY, "data_reabertura", "data_atualizacao")
    return inc.extract_by_parent_state(info, p, PARCEL_KEY, "id_situacao_parcela", "A", "data_atualizacao",
                                       C_WATERMARK, not_null_col="data_reabertura")


# ----------------------------------------------------------- maintenance

TITULO_COLS = ["id_titulo", "id_devedor", "plano", "data_atualizacao", "situacao"]


def _titulos_pair(spark, sf_dir):
    t = _t(spark, sf_dir)
    return S.titulos(t).select(*TITULO_COLS), _titulos_held(t).select(*TITULO_COLS)


def q_drop_unchanged(spark, sf_dir):
    src, held = _titulos_pair(spark, sf_dir)
    return mg.drop_unchanged(src, held, ["id_titulo"], ["data_atualizacao"])


def q_insert_absent(spark, sf_dir):
    src, held = _titulos_pair(spark, sf_dir)
    return mg.insert_absent(held, src, ["id_titulo"])


def q_update_matched(spark, sf_dir):
    src, held = _titulos_pair(spark, sf_dir)
    return mg.update_matched(held, src, ["id_titulo"], ["plano", "data_atualizacao"],
                             when=lambda old, new: X.differs_date(old("data_atualizacao"),
                                                                  new("data_atualizacao")),
                             mark=True)


def q_upsert(spark, sf_dir):
    src, held = _titulos_pair(spark, sf_dir)
    return mg.upsert(held, src, ["id_titulo"], ["data_atualizacao"], ["plano", "data_atualizacao"], mark=True)


def q_fill_null_once(spark, sf_dir):
    src, held = _titulos_pair(spark, sf_dir)
    return mg.fill_null_once(held, src, ["id_titulo"], ["data_atualizacao"], mark=True)


def q_fill_pair_once(spark, sf_dir):
    """C5 as the payments use it: a pair of columns behind one trigger."""
    src, held = _titulos_pair(spark, sf_dir)
    return mg.fill_null_once(held, src, ["id_titulo"], ["data_atualizacao", "plano"], mark=True)


def q_update_unless_equal(spark, sf_dir):
    src, held = _titulos_pair(spark, sf_dir)
    return mg.update_unless_equal(held, src, ["id_titulo"], "data_atualizacao",
                                  ["plano", "data_atualizacao"], mark=True)


def q_load_volumes(spark, sf_dir):
    """A10: the source rows are those that C1 leaves."""
    src, held = _titulos_pair(spark, sf_dir)
    changed = mg.drop_unchanged(src, held, ["id_titulo"], ["data_atualizacao"])
    marked = mg.upsert(held, changed, ["id_titulo"], ["data_atualizacao"], ["plano", "data_atualizacao"],
                       mark=True)
    return runlog.volumes_from_actions(marked, changed)


# ------------------------------------------------------- table-load shapes

def q_load_insert_only(spark, sf_dir):
    """The contact loads' shape (L15-L17): id-else-date extract, insert
    only, through the ``TableLoad`` spec; new table state marked I / N."""
    t = _t(spark, sf_dir)
    spec = dataclasses.replace(loads.LOADS_BY_JOB["ProcOcorrencias"], key=["event_id"], id_col="event_id",
                               date_col="ts")
    held = t.events.filter(F.col("ts") < X.ts_lit("2024-01-10 00:00:00"))
    w = inc.watermark_of(S.runs(t), "purchase", "forward")
    return spec.plan(t.events, held, watermark=w)


def q_load_upsert(spark, sf_dir):
    """The id-or-version upsert shape (L1-L7): extract by id above the
    target's maximum or version since the watermark, drop unchanged rows,
    insert absent keys, update changed keys."""
    src, held = _titulos_pair(spark, sf_dir)
    spec = dataclasses.replace(loads.LOADS_BY_JOB["ProcTitulos"], set_cols=["plano", "data_atualizacao"])
    # Last successful load in mid-1997: versions since then are re-read.
    return spec.plan(src, held, watermark=_dt.date(1997, 7, 1))


def q_load_parent_scoped(spark, sf_dir):
    """The parent-scoped shape (L13): children of agreements in scope by
    their own dates or their instalments' (union all of key lists), inserted
    when the agreement is not held yet (D21)."""
    t = _t(spark, sf_dir)
    spec = loads.LOADS_BY_JOB["AcordosParcelasNegociadas"]
    neg = S.acordos_parcelas_negociadas(t)
    held = neg.join(_acordos_held(t).select("id_acordo"), "id_acordo", "left_semi")
    return spec.plan(neg, held, watermark=C_WATERMARK, as_of=C_AS_OF,
                     inputs={"acordos": S.acordos(t), "parcelas_pagar": S.acordos_parcelas_pagar(t)})


# ------------------------------------------- the 25 loads, specs as they stand

def _load_arguments(t, spec) -> dict:
    source, target = LS.source_and_target(t, spec.target)
    return {"source": source, "target": target, "watermark": C_WATERMARK, "as_of": C_AS_OF, "inputs": LS.inputs(t)}


def _load_query(spec):
    def query(spark, sf_dir):
        return spec.plan(**_load_arguments(_t(spark, sf_dir), spec))
    query.__doc__ = f"{spec.job}: the target after the run, rows marked I / U / N."
    return query


#: A load of every way to count and to maintain (A10).
VOLUME_TARGETS = ("Titulos", "Telefones", "ParcelasInformacoesComplementares", "Acordos", "AcordosParcelasPagar", "AcordosParcelasNegociadas", "Eventos", "Carteiras")


def q_load_volumes_by_shape(spark, sf_dir):
    """A10 / R2: the volume rows of one load of every shape."""
    t, out = _t(spark, sf_dir), None
    for spec in (x for x in loads.LOADS if x.target in VOLUME_TARGETS):
        row = spec.volumes(**_load_arguments(t, spec)).select(F.lit(spec.target).alias("tabela"), "*")
        out = row if out is None else out.unionByName(row)
    return out


# ------------------------------------------------------------------ mailing

def q_mailing_attach(spark, sf_dir):
    t = _t(spark, sf_dir)
    return marts.mailing_attach(_base360(t, C_AS_OF), S.mailing_target(t), S.carteiras(t), C_AS_OF) \
        .drop("id_base")


def q_mailing_attach_apply(spark, sf_dir):
    """BaseMailing360 after today's run.  The earlier run saw the mailing
    before today's flags and before the HOUSEHOLD debtors were added; today
    the flagged mailing is attached again and applied."""
    t = _t(spark, sf_dir)
    base = _base360(t, C_AS_OF)
    household = t.customer.filter(F.col("c_mktsegment") == "HOUSEHOLD").select(
        F.col("c_custkey").alias("id_devedor"))
    earlier = (S.mailing_target(t).join(household, "id_devedor", "left_anti")
               .withColumn("id_retirada", F.lit(None).cast("int")).select("id_carteira", "id_devedor", "id_retirada"))
    mailing = S.mailing_target(t)
    reasons = derived.return_reasons(S.ocorrencias_retorno(t), S.titulos_carteira(t), S.promessas(t), E_AS_OF)
    flagged = derived.mailing_flags(mailing, S.mailing_source(t),
                                    derived.returns_by_reason(reasons, mailing, null_portfolio_matches_any=True))
    cols = ["id_base", "data", "id_devedor", "id_titulo", "id_retirada"]
    target = marts.mailing_attach(base, earlier, S.carteiras(t), C_AS_OF).select(*cols)
    staged = marts.mailing_attach(base, flagged, S.carteiras(t), C_AS_OF).select(*cols)
    return marts.mailing_apply(target, staged, mark=True).drop("id_base")


def q_mailing_returns(spark, sf_dir):
    t = _t(spark, sf_dir)
    return derived.returned_debtors(S.parcelas(t), S.titulos_carteira(t), S.mailing_target(t), C_AS_OF)


def q_mailing_returns_closed(spark, sf_dir):
    """J11 with rows: debtors whose instalments went back yesterday and who
    have no active one left."""
    t = _t(spark, sf_dir)
    return derived.returned_debtors(S.parcelas_devolvidas(t), S.titulos_carteira(t), S.mailing_target(t), C_AS_OF)


def q_mailing_state(spark, sf_dir):
    """M10's table after the run with its actions, as the job writes it."""
    t = _t(spark, sf_dir)
    mailing = S.mailing_target(t)
    reasons = derived.return_reasons(S.ocorrencias_retorno(t), S.titulos_carteira(t), S.promessas(t), E_AS_OF)
    returns = derived.returns_by_reason(reasons, mailing, null_portfolio_matches_any=True)
    return derived.mailing_state(mailing, S.mailing_source(t).filter(F.col("id_carteira") > 4), returns)


def q_return_reasons(spark, sf_dir):
    t = _t(spark, sf_dir)
    return derived.return_reasons(S.ocorrencias_retorno(t), S.titulos_carteira(t), S.promessas(t), E_AS_OF)


def q_mailing_flags(spark, sf_dir):
    t = _t(spark, sf_dir)
    mailing = S.mailing_target(t)
    reasons = derived.return_reasons(S.ocorrencias_retorno(t), S.titulos_carteira(t), S.promessas(t), E_AS_OF)
    returns = derived.returns_by_reason(reasons, mailing, null_portfolio_matches_any=True)
    return derived.mailing_flags(mailing, S.mailing_source(t), returns)


def q_mailing_run(spark, sf_dir):
    """M10 end to end: returned debtors and return reasons, new rows from
    today's list, then flags 1 (returned) and 2 (left the list)."""
    t = _t(spark, sf_dir)
    return derived.mailing_run(S.mailing_source(t), S.mailing_target(t), S.parcelas(t), S.titulos_carteira(t),
                               S.ocorrencias_retorno(t), S.promessas(t), E_AS_OF)


# -------------------------------------------------------------------- CRM

def _crm(t, as_of):
    contacts = marts.crm_contacts(S.ocorrencias(t), S.eventos(t), S.tipos_ocorrencias(t), S.tipos_eventos(t),
                                  S.ligacoes(t), S.usuarios(t), as_of)
    return marts.crm_final(contacts, _base360(t, as_of), as_of)


def q_crm_contacts(spark, sf_dir):
    """Contacts of the day not yet in CRM360: the mart holds what the 12:00
    run loaded (the same job over the contacts before 12:00 -- the contact
    filter commutes with the joins, so it is taken from the staged rows)."""
    t = _t(spark, sf_dir)
    staged = _crm(t, E_AS_OF)
    target = staged.filter(F.col("data") < X.ts_lit(E_AS_OF))
    return mg.insert_absent(target, staged, ["id_base", "data"]).drop("id_base")


# ----------------------------------------------------------------- dialers

def q_dialer_calls(spark, sf_dir):
    """Calls not yet in Discador360; the mart holds the calls the 12:00
    run loaded (derived from the same materialised snapshot slice)."""
    t = _t(spark, sf_dir)
    base = _base360(t, E_AS_OF)
    target = marts.attach_calls(marts.read_dialer(S.dialer_source(t), E_AS_OF), base, E_AS_OF,
                                marts.DIALER_DURATIONS).filter(F.col("data") < X.ts_lit(E_AS_OF))
    return marts.dialer_calls(S.dialer_source(t), base, target, E_AS_OF).drop("id_base")


def q_digital_calls(spark, sf_dir):
    t = _t(spark, sf_dir)
    base = _base360(t, E_AS_OF)
    target = marts.attach_calls(marts.read_digital(S.digital_source(t), E_AS_OF), base, E_AS_OF,
                                marts.DIGITAL_DURATIONS).filter(F.col("data") < X.ts_lit(E_AS_OF))
    return marts.digital_calls(S.digital_source(t), base, target, E_AS_OF).drop("id_base")


# -------------------------------------------------------------- agreements

def _star(t):
    origem = derived.agreement_channel(S.ocorrencias_acordo(t), S.ligacoes_acordo(t))
    return (S.acordos(t), S.tipos_acordos(t), S.acordos_parcelas_negociadas(t), S.acordos_parcelas_pagar(t),
            S.usuarios(t), S.status_acordos(t), origem)


def _base360_history(t):
    """Snapshot history stand-in: each open contract's snapshot dated on
    its first open due day."""
    b = _base360(t, C_AS_OF)
    return (b.withColumn("data", F.to_date("data_vencimento"))
            .withColumn("id_base", F.xxhash64("id_devedor", "id_titulo", "data")))


def q_payments_mart(spark, sf_dir):
    """Payments not yet in Pagamentos360 (paid-off agreements were loaded)."""
    t = _t(spark, sf_dir)
    star = _star(t)
    staged = marts.payments_mart(*star, _base360_history(t))
    target = staged.filter(F.col("status_acordo") == "Quitado")
    return mg.insert_absent(target, staged, marts.FACT_KEY).drop("id_base")


#: Days of the snapshot history that does not follow from the payments.
HISTORY_FROM = _dt.date(1998, 6, 1)


def _daily_history(t):
    """Base360 of every day from June 1998 on."""
    days = F.explode(F.sequence(F.lit(HISTORY_FROM), F.lit(C_AS_OF.date())))
    return _base360(t, C_AS_OF).select("id_devedor", "id_titulo", days.alias("data")).withColumn("id_base", F.xxhash64("id_devedor", "id_titulo", "data"))


def q_payments_new(spark, sf_dir):
    """M7 by touched days over a daily history: the mart holds what a run of
    1 August loaded, when later payments and agreements of low priority were
    not known."""
    t = _t(spark, sf_dir)
    star, history = list(_star(t)), _daily_history(t)
    earlier = [star[0].filter(F.col("proposta") != "5-LOW"), *star[1:3], star[3].filter(F.col("data_pagamento") < X.date_lit("1998-08-01")), *star[4:]]
    mart = marts.payments_mart(*earlier, history)
    return marts.payments_new(*star, history, mart).drop("id_base")


def q_due_state(spark, sf_dir):
    """M8 in one pass: the mart as loaded in the morning, when cancellations
    and agreements of low priority were not known, after the evening's run."""
    t = _t(spark, sf_dir)
    star, base = list(_star(t)), _base360(t, C_AS_OF)
    # one row an instalment (the driver's line numbers repeat), all due today
    star[3] = star[3].groupBy("id_acordo", "numero_parcela").agg(
        F.lit(C_AS_OF.date()).alias("data_vencimento"), F.min("valor").alias("valor"), F.max("data_pagamento").alias("data_pagamento"), F.max("valor_pago").alias("valor_pago"))
    morning = star[0].filter(F.col("proposta") != "5-LOW").withColumn("data_cancelamento", F.lit(None).cast("timestamp_ntz"))
    mart = marts.due_mart(morning, *star[1:], base, C_AS_OF)
    return marts.due_state(*star, base, C_AS_OF, mart).drop("id_base")


def q_due_mart(spark, sf_dir):
    t = _t(spark, sf_dir)
    star = _star(t)
    staged = marts.due_mart(*star, _base360(t, C_AS_OF), C_AS_OF)
    target = staged.filter(F.col("status_acordo") == "Quitado")
    return mg.insert_absent(target, staged, marts.FACT_KEY).drop("id_base")


def q_due_cancellations(spark, sf_dir):
    """M8 update: Vencimentos360 as loaded before the cancellations were
    known (cancellation dates empty) gets each date filled once (C5)."""
    t = _t(spark, sf_dir)
    staged = marts.due_mart(*_star(t), _base360(t, C_AS_OF), C_AS_OF)
    target = staged.withColumn("data_cancelamento", F.lit(None).cast("timestamp_ntz"))
    return marts.due_cancellations(target, staged).drop("id_base")


def q_agreement_channel(spark, sf_dir):
    t = _t(spark, sf_dir)
    oc = S.ocorrencias(t)
    held = derived.agreement_channel(oc.filter(F.col("data_ocorrencia") < X.ts_lit("2024-01-10 00:00:00")),
                                     S.ligacoes(t))
    return derived.agreement_channel_new(oc, S.ligacoes(t), held)


# ------------------------------------------------------------------ run log

def _run_rows(t):
    """State-change rows of the run log: an opening row per run and a
    closing row when it finished."""
    r = S.runs(t).withColumn("id_execucao", F.col("id_execucao").cast("string"))
    opened = r.select("id_execucao", "nome_procedure", "data_hora_inicio",
                      F.lit(None).cast("timestamp_ntz").alias("data_hora_fim"),
                      F.lit(inc.RUNNING).alias("status_execucao"),
                      F.col("data_hora_inicio").alias("registrado_em"))
    closed = (r.filter(F.col("status_execucao") != inc.RUNNING)
              .select("id_execucao", "nome_procedure", "data_hora_inicio", "data_hora_fim", "status_execucao",
                      F.col("data_hora_fim").alias("registrado_em")))
    return opened.unionByName(closed)


def q_run_status(spark, sf_dir):
    return runlog.run_status(_run_rows(_t(spark, sf_dir)))


def _purge_tables(t):
    e = t.events
    tid = (F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "error", 2)
           .when(F.col("event_type") == "purchase", 3).when(F.col("event_type") == "signup", 4)
           .otherwise(5).cast("int"))
    hour = (F.when(F.col("event_type").isin("click", "error"), "09:00:00")
            .when(F.col("event_type") == "purchase", "12:00:00").otherwise("13:30:00"))
    config = e.select(tid.alias("id_tabela_expurgo"), F.col("event_type").alias("nome_tabela"),
                      hour.alias("hora_expurgo")).distinct()
    done = (e.filter((F.col("value") < 2) & (F.col("ts") <= X.ts_lit(E_AS_OF)))
            .select(tid.alias("id_tabela_expurgo"), F.col("event_type").alias("nome_tabela"),
                    F.col("ts").alias("data_execucao")))
    return config, done


def q_purge_due(spark, sf_dir):
    config, done = _purge_tables(_t(spark, sf_dir))
    return runlog.purge_due(config, done, E_AS_OF)


QUERIES = {
    "base_open_instalments": q_base_open_instalments,
    "base_snapshot": q_base_snapshot,
    "base_snapshot_products": q_base_snapshot_products,
    "base_snapshot_reduced": q_base_snapshot_reduced,
    "base_snapshot_untidy": q_base_snapshot_untidy,
    "calls_by_name": q_calls_by_name,
    "base360_derived": q_base360_derived,
    "base360_upsert": q_base360_upsert,
    "base360_withdrawn": q_base360_withdrawn,
    "watermark_forward": q_watermark_forward,
    "watermark_backward": q_watermark_backward,
    "watermark_penultimate": q_watermark_penultimate,
    "watermark_penultimate_any_ids": q_watermark_penultimate_any_ids,
    "payment_date": q_payment_date,
    "extract_new": q_extract_new,
    "extract_new_filtered": q_extract_new_filtered,
    "extract_new_or_changed": q_extract_new_or_changed,
    "extract_id_or_date": q_extract_id_or_date,
    "extract_id_or_date_initial": q_extract_id_or_date_initial,
    "extract_agreements": q_extract_agreements,
    "extract_children_scope": q_extract_children_scope,
    "extract_due_instalments": q_extract_due_instalments,
    "extract_instalments_initial": q_extract_instalments_initial,
    "extract_instalments_next": q_extract_instalments_next,
    "extract_info_by_parent_state": q_extract_info_by_parent_state,
    "drop_unchanged": q_drop_unchanged,
    "insert_absent": q_insert_absent,
    "update_matched": q_update_matched,
    "upsert": q_upsert,
    "fill_null_once": q_fill_null_once,
    "fill_pair_once": q_fill_pair_once,
    "update_unless_equal": q_update_unless_equal,
    "load_volumes": q_load_volumes,
    "load_insert_only": q_load_insert_only,
    "load_upsert": q_load_upsert,
    "load_parent_scoped": q_load_parent_scoped,
    "mailing_attach": q_mailing_attach,
    "mailing_attach_apply": q_mailing_attach_apply,
    "mailing_returns": q_mailing_returns,
    "mailing_returns_closed": q_mailing_returns_closed,
    "mailing_state": q_mailing_state,
    "return_reasons": q_return_reasons,
    "mailing_flags": q_mailing_flags,
    "mailing_run": q_mailing_run,
    "crm_contacts": q_crm_contacts,
    "dialer_calls": q_dialer_calls,
    "digital_calls": q_digital_calls,
    "payments_mart": q_payments_mart,
    "payments_new": q_payments_new,
    "due_mart": q_due_mart,
    "due_state": q_due_state,
    "due_cancellations": q_due_cancellations,
    "agreement_channel": q_agreement_channel,
    "run_status": q_run_status,
    "purge_due": q_purge_due,
    **{"load_" + schemas.TABLES[spec.target]: _load_query(spec) for spec in loads.LOADS},
    "load_volumes_by_shape": q_load_volumes_by_shape,
}
