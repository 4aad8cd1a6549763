"""Fact marts hanging off the daily snapshot (M3-M8).

Each mart: today's snapshot slice (partition filter on ``data``), the
day's facts, an equi join on the snapshot key, and insert-if-absent
against the mart.  The snapshot slice of one day is bounded by the number
of open contracts, not by history, but it is not assumed small: joins are
plain equi joins that AQE may turn into broadcasts at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.functions import derive as X
from arrears.operators.joins import attach_snapshot, in_snapshot, left_lookup, snapshot_id
from arrears.operators.merge import insert_absent, upsert
from arrears.plans.snapshot import today_snapshot

# Client codes of the dialer extracts (fixed values).
DIALER_CLIENTS = [771, 777, 779, 799]


# ---- M3 BaseMailing360 ---------------------------------------------------

def mailing_attach(base360: DataFrame, mailing: DataFrame, carteiras: DataFrame, as_of) -> DataFrame:
    """Mailing rows attached to today's snapshot by (debtor, portfolio
    reference code).  D6: when two portfolios share a code, one row per
    snapshot row, lowest portfolio id first (partial aggregate, not a
    window, so a hot snapshot row cannot overload one task)."""
    base = today_snapshot(base360, as_of, ["id_base", "data", "id_devedor", "id_titulo",
                                           "codigo_referencia"])
    m = mailing.join(carteiras.select("id_carteira", "codigo_referencia"),
                     "id_carteira", "inner")
    j = base.join(m.select("id_devedor", "codigo_referencia", "id_carteira", "id_retirada"),
                  ["id_devedor", "codigo_referencia"], "inner")
    keys = ["id_base", "data", "id_devedor", "id_titulo", "codigo_referencia"]
    first = (j.groupBy(*keys)
             .agg(F.min(F.struct("id_carteira", "id_retirada")).alias("_m"))
             .select(*keys, F.col("_m.id_carteira").alias("id_carteira"),
                     F.col("_m.id_retirada").alias("id_retirada")))
    return first


def mailing_apply(target: DataFrame, attached: DataFrame, mark: bool = False) -> DataFrame:
    """New BaseMailing360 state: insert absent ``id_base`` (K3), and for
    present ones take the staged withdrawal flag whenever
    ``isnull(old, 0) <> isnull(new, 0)`` -- including back to NULL (J16).

    That is the upsert rule with the flag as its own version column (the
    integer sentinel is 0), so it runs as one full outer join on
    ``id_base`` and the attached rows are read once."""
    return upsert(target, attached.select(*target.columns), ["id_base"], ["id_retirada"], ["id_retirada"],
                  mark=mark)


# ---- M4 CRM360 -----------------------------------------------------------

CRM_COLS = ["data", "id_devedor", "id_titulo", "codigo_ocorrencia", "tipo_ocorrencia", "id_ligacao",
            "id_origem_ligacao", "ddd", "numero", "chave", "id_acordo", "referencia", "id_origem",
            "id_classificacao"]


def crm_contacts(ocorrencias: DataFrame, eventos: DataFrame, tipos_ocorrencias: DataFrame,
                 tipos_eventos: DataFrame, ligacoes: DataFrame, usuarios: DataFrame,
                 as_of) -> DataFrame:
    """Occurrences and events of the day (F7), each with its type
    (inner), call and user (left); the events branch has no agreement."""
    calls = ligacoes.select("id_ligacao", "id_origem_ligacao", F.col("ddd_ligacao").alias("ddd"),
                            F.col("numero_ligacao").alias("numero"), "chave")
    users = usuarios.select(F.col("id_usuario").alias("id_usuario_inclusao"), "referencia")
    # only the columns used: the stored tables share names besides their keys
    kept = ["id_devedor", "id_titulo", "id_ligacao", "id_usuario_inclusao", "id_origem"]
    oc = (ocorrencias.filter(X.since_midnight("data_ocorrencia", as_of)).select("data_ocorrencia", "id_tipo_ocorrencia", "id_acordo", *kept)
          .join(tipos_ocorrencias.select("id_tipo_ocorrencia", "codigo_ocorrencia", "tipo_ocorrencia", "id_classificacao"), "id_tipo_ocorrencia", "inner"))
    oc = (left_lookup(left_lookup(oc, calls, "id_ligacao"), users, "id_usuario_inclusao")
          .select(F.col("data_ocorrencia").alias("data"), "id_devedor", "id_titulo",
                  "codigo_ocorrencia", "tipo_ocorrencia", "id_ligacao", "id_origem_ligacao", "ddd",
                  "numero", "chave", "id_acordo", "referencia", "id_origem", "id_classificacao"))
    ev = (eventos.filter(X.since_midnight("data_evento", as_of)).select("data_evento", "id_tipo_evento", *kept)
          .join(tipos_eventos.select("id_tipo_evento", "codigo_evento", "tipo_evento", "id_classificacao"), "id_tipo_evento", "inner"))
    ev = (left_lookup(left_lookup(ev, calls, "id_ligacao"), users, "id_usuario_inclusao")
          .select(F.col("data_evento").alias("data"), "id_devedor", "id_titulo",
                  F.col("codigo_evento").alias("codigo_ocorrencia"),
                  F.col("tipo_evento").alias("tipo_ocorrencia"), "id_ligacao", "id_origem_ligacao",
                  "ddd", "numero", "chave", "referencia", "id_origem", "id_classificacao"))
    return oc.unionByName(ev, allowMissingColumns=True).select(*CRM_COLS)


def crm_final(contacts: DataFrame, base360: DataFrame, as_of) -> DataFrame:
    """J3 + X4: contacts attached to today's snapshot by debtor, contract
    and calendar day, with the attended / right-party / agreement flags."""
    base = today_snapshot(base360, as_of, ["id_base", "data", "id_devedor", "id_titulo"])
    j = attach_snapshot(contacts, base.withColumnRenamed("data", "dia_base"),
                        ["id_devedor", "id_titulo"], "data", "dia_base", ["id_base"])
    return j.select("id_base", *[c for c in CRM_COLS if c not in ("id_origem", "id_classificacao")],
                    X.attended_flag("id_origem", "id_acordo").alias("atendimento"),
                    X.right_party_flag("id_classificacao").alias("cpc"),
                    X.agreement_flag("id_acordo").alias("acordo"))


# ---- M5 / M6 dialers -----------------------------------------------------

def read_dialer(source: DataFrame, as_of, clients: Sequence[int] = DIALER_CLIENTS) -> DataFrame:
    """S3: the dialer extract -- projection, phone split and filter, all
    pushed to the source scan by Catalyst."""
    return (source.filter(X.since_midnight("inicio_discagem", as_of)
                          & F.col("cliente").isin(list(clients)))
            .select(F.col("inicio_discagem").alias("data"), "codigo_referencia",
                    F.col("cpf_cnpj").alias("cnpj_cpf"), F.col("contrato").alias("numero_contrato"),
                    X.area_code("telefone_discado").alias("ddd"),
                    X.local_number("telefone_discado").alias("numero"),
                    "origem", "classificacao", "motivo_finalizacao",
                    F.col("cobrador").alias("referencia"), "campanha", "tipo_telefone",
                    "duracao_chamada", F.col("duracao_conectado").alias("duracao_falado"),
                    F.col("duracao_wrap_up").alias("duracao_tabulando"),
                    F.col("itr_key").alias("chave")))


def read_digital(source: DataFrame, as_of, clients: Sequence[int] = DIALER_CLIENTS) -> DataFrame:
    """S3 for the digital dialer: tax id zero-padded (X18), empty strings
    to NULL (X19)."""
    return (source.filter(X.since_midnight("data", as_of) & F.col("cliente").isin(list(clients)))
            .select("data", "codigo_referencia", X.pad_tax_id("cpf_cnpj").alias("cnpj_cpf"),
                    F.col("contrato").alias("numero_contrato"),
                    X.area_code("telefone_discado").alias("ddd"),
                    X.local_number("telefone_discado").alias("numero"),
                    "origem", "classificacao",
                    X.empty_to_null("tabulacao").alias("motivo_finalizacao"),
                    X.empty_to_null("cobrador").alias("referencia"), "campanha",
                    "duracao_chamada", F.col("call_id").alias("chave")))


def attach_calls(calls: DataFrame, base360: DataFrame, as_of, durations: Sequence[str]) -> DataFrame:
    """J2 + X15: calls attached to today's snapshot by (portfolio code, tax
    id) -- every contract of the debtor in that portfolio -- with
    durations as fractions of a day (D15: double)."""
    base = today_snapshot(base360, as_of, ["id_base", "id_devedor", "id_titulo", "codigo_referencia",
                                           "cnpj_cpf"])
    j = calls.join(base, ["codigo_referencia", "cnpj_cpf"], "inner")
    keep = [c for c in calls.columns if c not in ("codigo_referencia", "cnpj_cpf", "numero_contrato")
            and c not in durations]
    return j.select("id_base", "id_devedor", "id_titulo", *keep,
                    *[X.seconds_to_day_fraction(c).alias(c) for c in durations])


DIALER_DURATIONS = ["duracao_chamada", "duracao_falado", "duracao_tabulando"]
DIGITAL_DURATIONS = ["duracao_chamada"]
CALL_KEY = ["id_devedor", "id_titulo", "data"]


def dialer_calls(source: DataFrame, base360: DataFrame, target: DataFrame, as_of) -> DataFrame:
    """M5: rows to insert into Discador360 (absent (debtor, contract,
    timestamp); D22 duplicates in one batch all go in)."""
    staged = attach_calls(read_dialer(source, as_of), base360, as_of, DIALER_DURATIONS)
    return insert_absent(target, staged, CALL_KEY)


def digital_calls(source: DataFrame, base360: DataFrame, target: DataFrame, as_of) -> DataFrame:
    """M6: rows to insert into DiscadorDigital360."""
    staged = attach_calls(read_digital(source, as_of), base360, as_of, DIGITAL_DURATIONS)
    return insert_absent(target, staged, CALL_KEY)


# ---- M7 / M8 agreement facts ---------------------------------------------

def agreement_facts(acordos: DataFrame, tipos: DataFrame, negociadas: DataFrame, pagar: DataFrame,
                    usuarios: DataFrame, status: DataFrame, origem: DataFrame,
                    pagar_filter=None, row_filter=None, cols: Sequence[str] = ()) -> DataFrame:
    """The seven-table agreement star, distinct.

    Negotiated instalments are first reduced to distinct (agreement,
    contract) pairs -- a partial aggregate -- so a hot agreement does not
    multiply its instalments against its payable instalments; the type,
    user and status sides are left to Spark to broadcast when small.
    """
    neg = negociadas.select("id_acordo", "id_titulo").distinct()
    p = pagar if pagar_filter is None else pagar.filter(pagar_filter)
    a = acordos
    j = (a.join(tipos.select("id_tipo_acordo", "tipo_acordo"), "id_tipo_acordo")
         .join(status.select("id_status_acordo", "status_acordo"), "id_status_acordo")
         .join(usuarios.select(F.col("id_usuario").alias("id_negociador_responsavel"),
                                                    "referencia"), "id_negociador_responsavel")
         .join(origem.select("id_acordo", "id_origem_acordo"), "id_acordo")
         .join(neg, "id_acordo")
         .join(p.select("id_acordo", "numero_parcela", "data_vencimento", "valor", "data_pagamento",
                        "valor_pago"), "id_acordo"))
    if row_filter is not None:
        j = j.filter(row_filter)
    return j.select(*cols).distinct()


PAYMENT_COLS = ["id_acordo", "tipo_acordo", "id_devedor", "id_titulo", "plano", "numero_parcela",
                "data_pagamento", "valor_pago", "referencia", "proposta", "data_aprovacao_proposta",
                "status_acordo", "id_origem_acordo"]
DUE_COLS = ["id_acordo", "tipo_acordo", "id_devedor", "id_titulo", "plano", "numero_parcela", "valor",
            "data_vencimento", "referencia", "proposta", "data_aprovacao_proposta", "status_acordo",
            "data_cancelamento", "id_origem_acordo"]
FACT_KEY = ["id_base", "id_acordo", "numero_parcela"]


def payments_mart(acordos, tipos, negociadas, pagar, usuarios, status, origem,
                  base360: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """M7: payments from the earliest payment date on (A4, a scalar
    subquery), attached where the snapshot day equals the payment date (the
    snapshot's id follows from its key, D10);
    with a ``target``, only the rows absent from the mart (by snapshot id,
    agreement, instalment)."""
    first = pagar.agg(F.min("data_pagamento")).scalar()
    facts = agreement_facts(acordos, tipos, negociadas, pagar, usuarios, status, origem,
                            pagar_filter=F.col("data_pagamento") >= first, cols=PAYMENT_COLS)
    key = ["id_devedor", "id_titulo", "data_pagamento"]
    types = {f.name: f.dataType for f in base360.schema.fields}
    staged = in_snapshot(facts, base360.filter(F.col("data") >= first), "data_pagamento")
    staged = staged.select(*key, *[c for c in PAYMENT_COLS if c not in key],
                           snapshot_id(F.col("id_devedor").cast(types["id_devedor"]), F.col("id_titulo").cast(types["id_titulo"]), "data_pagamento").alias("id_base"))
    return staged if target is None else insert_absent(target, staged, FACT_KEY)


def payment_keys(acordos, negociadas, pagar, mart: DataFrame) -> DataFrame:
    """Every payment with the snapshot id that its debtor, contract and day
    give, and ``no_mart``: whether the mart holds it."""
    paid = pagar.where(F.col("data_pagamento").isNotNull()).select("id_acordo", "numero_parcela", "data_pagamento", "valor_pago")
    key = (paid.join(negociadas.select("id_acordo", "id_titulo").distinct(), "id_acordo").join(acordos.select("id_acordo", "id_devedor"), "id_acordo")
           .withColumn("id_base", snapshot_id("id_devedor", "id_titulo", "data_pagamento")).distinct())
    held = mart.select(*FACT_KEY).distinct().withColumn("no_mart", F.lit(True))
    return key.join(held, FACT_KEY, "left").withColumn("no_mart", F.col("no_mart").isNotNull())


def payments_of(keys: DataFrame, acordos, tipos, usuarios, status, origem, base360: DataFrame) -> DataFrame:
    """The mart's rows of some payments.  Their days, at most as many values as
    there are days, prune the snapshot history: only those day partitions of
    Base360 are read, not all since the first payment."""
    days = [r[0] for r in keys.select("data_pagamento").distinct().collect()]
    base = base360.where(F.col("data").isin(days) if days else F.lit(False))
    a = acordos.select("id_acordo", "id_tipo_acordo", "plano", "id_negociador_responsavel", "proposta", "data_aprovacao_proposta", "id_status_acordo")
    facts = (in_snapshot(keys.drop("no_mart"), base, "data_pagamento").join(a, "id_acordo")
             .join(tipos.select("id_tipo_acordo", "tipo_acordo"), "id_tipo_acordo").join(status.select("id_status_acordo", "status_acordo"), "id_status_acordo")
             .join(usuarios.select(F.col("id_usuario").alias("id_negociador_responsavel"), "referencia"), "id_negociador_responsavel")
             .join(origem.select("id_acordo", "id_origem_acordo"), "id_acordo"))
    return facts.select("id_base", *PAYMENT_COLS).distinct()


def payments_new(acordos, tipos, negociadas, pagar, usuarios, status, origem, base360: DataFrame, mart: DataFrame) -> DataFrame:
    """M7 by touched days: the rows of ``payments_mart`` that the mart lacks.
    Payments that it holds are dropped before anything else is joined."""
    keys = payment_keys(acordos, negociadas, pagar, mart).where(~F.col("no_mart"))
    return payments_of(keys, acordos, tipos, usuarios, status, origem, base360)


def due_state(acordos, tipos, negociadas, pagar, usuarios, status, origem, base360: DataFrame, as_of, mart: DataFrame) -> DataFrame:
    """M8 in one pass: the day's rows of the mart after the run, marked I / U / N.

    Insert-absent (K3) and the cancellation filled once (C5) are one full outer
    join on the fact key; ``mart`` holds the days that the facts touch."""
    staged = due_mart(acordos, tipos, negociadas, pagar, usuarios, status, origem, base360, as_of)
    return upsert(mart, staged.select(*mart.columns), FACT_KEY, ["data_cancelamento"], ["data_cancelamento"], mark=True, fill_only=True)


def due_mart(acordos, tipos, negociadas, pagar, usuarios, status, origem,
             base360: DataFrame, as_of, target: DataFrame | None = None) -> DataFrame:
    """M8: instalments due today or agreements cancelled today (F8, an OR
    across two joined tables: two branches, so that each day filter reaches
    its own scan; the second leaves out the rows of the first), attached where the
    snapshot day equals the due date (D20); with a ``target``, only the
    rows absent from the mart (``due_cancellations`` then fills the
    cancellation date of present ones)."""
    day = X.date_lit(as_of)
    due = agreement_facts(acordos, tipos, negociadas, pagar, usuarios, status, origem,
                          pagar_filter=F.col("data_vencimento") == day, cols=DUE_COLS)
    cancelled = agreement_facts(acordos.filter(F.to_date("data_cancelamento") == day), tipos, negociadas, pagar, usuarios, status, origem,
                                row_filter=F.col("data_vencimento").isNull() | (F.col("data_vencimento") != day), cols=DUE_COLS)
    facts = due.unionByName(cancelled)
    base = today_snapshot(base360, as_of, ["id_base", "id_devedor", "id_titulo",
                                           F.col("data").alias("data_vencimento")])
    staged = facts.join(base, ["id_devedor", "id_titulo", "data_vencimento"], "inner")
    return staged if target is None else insert_absent(target, staged, FACT_KEY)


def due_cancellations(target: DataFrame, staged: DataFrame) -> DataFrame:
    """M8 update: fill the cancellation date once."""
    from arrears.operators.merge import fill_null_once
    return fill_null_once(target, staged.select(*FACT_KEY, "data_cancelamento"), FACT_KEY,
                          ["data_cancelamento"], mark=True)



def append_new(spark, mart_path: str, staged: DataFrame, keys: Sequence[str], partition_col: str,
               scope=None) -> int:
    """K1 + K3 as a job: append the staged rows whose key the mart does not
    hold, partitioned by ``partition_col``.  Only the mart partitions in
    ``scope`` (e.g. ``data >= today``) are read for the anti join.  Files
    are committed at job end, so a failed run leaves nothing visible and a
    re-run inserts exactly the missing rows.  Returns the rows appended."""
    from arrears.sources import io
    target = spark.read.parquet(mart_path) if io.exists(spark, mart_path) else staged.filter(F.lit(False))
    if scope is not None:
        target = target.filter(scope)
    from pyspark.sql import Observation
    new = io.stage(insert_absent(target, staged, keys), mart_path + "#append")
    # A10 with ``observe``: the row count is gathered by the append itself
    # (from successful tasks only), not by a separate counting job.
    obs = Observation("appended")
    io.append(new.observe(obs, F.count(F.lit(1)).alias("n")), mart_path, [partition_col])
    return int(obs.get["n"])
