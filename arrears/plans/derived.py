"""Derived ODS tables: ``OrigemAcordos`` (M9) and ``Mailing``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.functions import derive as X
from arrears.operators.incremental import on_day_before
from arrears.operators.joins import lookup_default
from arrears.operators.merge import INSERTED, KEPT, UPDATED, flag_wildcard, insert_absent, wildcard_marker

# Fixed values of the mailing return rules.
RETURN_OCCURRENCE_TYPE = 350
CUSHION_PRODUCT = 9
CUSHION_REASON = "Colchão"
PROMISE_REASON = "Remessa"
RETURN_REASONS = [CUSHION_REASON, PROMISE_REASON]
PAYMENT_WRITE_OFF_PATTERN = "%BAIXA PGTO DO / DT PGTO%"
RETURNED, LEFT_LIST = 1, 2


# ---- M9 ------------------------------------------------------------------

def agreement_channel(ocorrencias: DataFrame, ligacoes: DataFrame) -> DataFrame:
    """(id_acordo, id_origem_acordo): the call origin of the occurrence that
    carries the agreement, ``'H'`` when there is no call (J5).  D5: one row
    per agreement -- the lowest occurrence id -- by a partial aggregate
    (``min`` of a struct), skew-safe for an agreement with many
    occurrences."""
    oc = ocorrencias.filter(F.col("id_acordo").isNotNull()).select("id_ocorrencia", "id_acordo", "id_ligacao")
    j = lookup_default(oc, ligacoes.select("id_ligacao", "id_origem_ligacao"), "id_ligacao",
                       "id_origem_ligacao", X.DEFAULT_AGREEMENT_CHANNEL, alias="id_origem_acordo")
    return (j.groupBy("id_acordo")
            .agg(F.min(F.struct("id_ocorrencia", "id_origem_acordo")).alias("_f"))
            .select("id_acordo", F.col("_f.id_origem_acordo").alias("id_origem_acordo")))


def agreement_channel_new(ocorrencias: DataFrame, ligacoes: DataFrame, target: DataFrame) -> DataFrame:
    """M9 rows to insert: agreements the table does not hold yet."""
    return insert_absent(target, agreement_channel(ocorrencias, ligacoes), ["id_acordo"])


# ---- M10 -----------------------------------------------------------------

def returned_debtors(parcelas: DataFrame, titulos: DataFrame, mailing: DataFrame, as_of) -> DataFrame:
    """J11 + F12: (portfolio, debtor) pairs with an instalment returned
    yesterday, no open instalment left, and still active in the mailing
    (not withdrawn).  Distinct pair lists first, then one anti and one semi
    join, all on the pair."""
    t = titulos.select("id_titulo", "id_carteira", "id_devedor")
    returned = (on_day_before(parcelas, "data_devolucao", as_of).select("id_titulo")
                .join(t, "id_titulo").select("id_carteira", "id_devedor").distinct())
    # Open instalments are first reduced to distinct contracts (partial
    # aggregate), then to distinct (portfolio, debtor) pairs.
    active = (parcelas.filter(F.col("id_situacao_parcela") == F.lit("A")).select("id_titulo").distinct()
              .join(t, "id_titulo").select("id_carteira", "id_devedor").distinct())
    held = mailing.filter(F.col("id_retirada").isNull()).select("id_carteira", "id_devedor").distinct()
    pair = ["id_carteira", "id_devedor"]
    return returned.join(active, pair, "left_anti").join(held, pair, "left_semi")


def return_reasons(ocorrencias: DataFrame, titulos: DataFrame, promessas: DataFrame, as_of) -> DataFrame:
    """U4: three-way distinct union of return reasons -- cushion
    occurrences of yesterday on product 9 (D29: calendar day), any
    occurrence of type 350 after yesterday (portfolio NULL, its text as
    the reason), and payment promises due after yesterday (portfolio
    NULL)."""
    yday = F.date_sub(X.date_lit(as_of), 1)
    yday_ts = yday.cast("timestamp_ntz")
    oc = ocorrencias.filter(F.col("id_tipo_ocorrencia") == F.lit(RETURN_OCCURRENCE_TYPE))
    t = titulos.filter(F.col("id_produto") == F.lit(CUSHION_PRODUCT)).select("id_titulo", "id_carteira")
    b1 = (oc.filter(F.to_date("data_ocorrencia") == yday).join(t, "id_titulo")
          .select(F.col("id_carteira").cast("int"), "id_devedor", F.lit(CUSHION_REASON).alias("complemento")))
    b2 = (oc.filter(F.col("data_ocorrencia") > yday_ts)
          .select(F.lit(None).cast("int").alias("id_carteira"), "id_devedor", "complemento"))
    b3 = (promessas.filter(F.col("data_vencimento") > yday_ts)
          .select(F.lit(None).cast("int").alias("id_carteira"), "id_devedor",
                  F.lit(PROMISE_REASON).alias("complemento")))
    return b1.unionByName(b2).unionByName(b3).distinct()


def returns_by_reason(reasons: DataFrame, mailing: DataFrame,
                      null_portfolio_matches_any: bool = False) -> DataFrame:
    """F4 + F5: reasons in the list or like the write-off text, for pairs
    active in the mailing.  By default the equality drops NULL portfolios
    (D18); ``null_portfolio_matches_any`` treats them as a wildcard."""
    r = reasons.filter(F.col("complemento").isin(RETURN_REASONS)
                       | F.col("complemento").like(PAYMENT_WRITE_OFF_PATTERN))
    held = mailing.filter(F.col("id_retirada").isNull()).select("id_carteira", "id_devedor")
    held_keys = held.distinct()
    if null_portfolio_matches_any:
        # A NULL reason portfolio stands for every active portfolio of the
        # debtor: the active rows of debtors with such a reason (a semi
        # join, so no reason-by-row pairs are formed).
        exact = (r.filter(F.col("id_carteira").isNotNull())
                 .join(held_keys, ["id_carteira", "id_devedor"], "left_semi").select("id_carteira", "id_devedor"))
        wild = held.join(r.filter(F.col("id_carteira").isNull()).select("id_devedor").distinct(), "id_devedor",
                         "left_semi")
        return exact.unionByName(wild.select("id_carteira", "id_devedor"))
    return r.join(held_keys, ["id_carteira", "id_devedor"], "left_semi").select("id_carteira", "id_devedor")


def mailing_new(source: DataFrame, mailing: DataFrame) -> DataFrame:
    """New (debtor, portfolio) rows (K3)."""
    return insert_absent(mailing, source.select("id_carteira", "id_devedor").distinct(),
                         ["id_devedor", "id_carteira"])


def mailing_flags(mailing: DataFrame, source: DataFrame, returns: DataFrame) -> DataFrame:
    """Mailing table after today's flags: 1 = returned (J12, a NULL
    portfolio in the table matches any), then 2 = left the list (K5 on the
    not-yet-flagged rows, same wildcard)."""
    m = mailing
    if "id_retirada" not in m.columns:
        m = m.withColumn("id_retirada", F.lit(None).cast("int"))
    returns = returns.select("id_carteira", "id_devedor").distinct()
    step1 = flag_wildcard(m, returns, "id_devedor", "id_carteira", "id_retirada", RETURNED,
                          only_unflagged=False, anti=False)
    return flag_wildcard(step1, source, "id_devedor", "id_carteira", "id_retirada", LEFT_LIST,
                         only_unflagged=True, anti=True)


def mailing_run(source: DataFrame, mailing: DataFrame, parcelas: DataFrame, titulos: DataFrame,
                ocorrencias: DataFrame, promessas: DataFrame, as_of) -> DataFrame:
    """M10 end to end: returns, new rows, flags.  Returns the new table."""
    returns = returned_debtors(parcelas, titulos, mailing, as_of).unionByName(
        returns_by_reason(return_reasons(ocorrencias, titulos, promessas, as_of), mailing))
    new = mailing_new(source, mailing).withColumn("id_retirada", F.lit(None).cast("int"))
    return mailing_flags(mailing.unionByName(new.select(*mailing.columns)), source, returns)


def mailing_state(mailing: DataFrame, source: DataFrame, returns: DataFrame) -> DataFrame:
    """M10's table after the run, marked I / U / N, with ``mudou``: whether the
    row is new or its flag changed.  As U counts every row that either update
    reaches, also where it sets the flag that was there."""
    new = mailing_new(source, mailing).select("id_devedor", "id_carteira").withColumn("id_retirada", F.lit(None).cast("int"))
    m = mailing.select("id_devedor", "id_carteira", "id_retirada").withColumn("acao", F.lit(KEPT)).unionByName(new.withColumn("acao", F.lit(INSERTED)))
    m = m.withColumn("_antes", F.col("id_retirada"))
    hit = wildcard_marker(m, returns.select("id_carteira", "id_devedor").distinct(), "id_devedor", "id_carteira")
    m = hit.withColumn("id_retirada", F.when(F.col("_hit"), RETURNED).otherwise(F.col("id_retirada"))).withColumnRenamed("_hit", "_devolvido")
    listed = wildcard_marker(m, source, "id_devedor", "id_carteira")
    left = F.col("id_retirada").isNull() & ~F.col("_hit")
    touched = F.col("_devolvido") | left
    return listed.select("id_devedor", "id_carteira", F.when(left, LEFT_LIST).otherwise(F.col("id_retirada")).alias("id_retirada"),
                         F.when(F.col("acao") == INSERTED, INSERTED).when(touched, UPDATED).otherwise(KEPT).alias("acao"),
                         ((F.col("acao") == INSERTED) | ~F.when(left, LEFT_LIST).otherwise(F.col("id_retirada")).eqNullSafe(F.col("_antes"))).alias("mudou"))
