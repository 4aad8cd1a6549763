"""The warehouse's sources as they stood at a clock, from the driver tables:
what a day of ``plans.day`` reads.  Rows appear on their date; versions, payments
and cancellations when their own moment has come.  Agreement instalments fall due
from 15 January 2024 on, a fifth of them each day; those of finished orders are
paid on that day, those of pending orders are cancelled at its 15:00.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.functions import derive as X
from arrears.sources import load_standins as LS
from arrears.sources import standins as S

FIRST_DAY = _dt.date(2024, 1, 15)
#: Order dates are moved by this many days, so that orders and events share a clock.
SHIFT = (FIRST_DAY - _dt.date(1998, 9, 1)).days


class _World(S.DriverTables):
    """Driver tables with some replaced."""

    def __init__(self, base: S.DriverTables, **tables: DataFrame):
        super().__init__(base.spark, base.sf_dir)
        self._cache.update(base._cache)
        self._cache.update(tables)


def _set(df: DataFrame, **values: Column) -> DataFrame:
    types = dict(df.dtypes)
    return df.withColumns({c: v.cast(types[c]) for c, v in values.items()})


def sources(t: S.DriverTables, as_of: _dt.datetime) -> dict[str, DataFrame]:
    now = X.ts_lit(as_of)
    orders = t.orders.withColumn("o_orderdate", F.col("o_orderdate") + F.make_dt_interval(F.lit(SHIFT))).where(F.col("o_orderdate") <= now)
    events = t.events.where(F.col("ts") <= now)
    world = _World(t, orders=orders, events=events)
    out = {target: LS.source_and_target(world, target)[0] for target in LS.schemas.TABLES}

    def since(c: str) -> Column:
        return F.when(F.col(c) <= now, F.col(c))

    def with_order(target: str, key: str) -> DataFrame:
        o = orders.select(F.col("o_orderkey").cast("int").alias(key), F.col("o_custkey").alias("dono"), F.col("o_orderstatus").alias("estado"))
        return out[target].join(o, key)

    for target in ("Titulos", "TitulosInformacoesComplementares", "Escob", "Propensao", "Parcelas", "ParcelasInformacoesComplementares"):
        out[target] = _set(out[target], data_atualizacao=since("data_atualizacao"))
    columns = {target: df.columns for target, df in out.items()}
    k = F.col("id_titulo")
    out["Titulos"] = _set(with_order("Titulos", "id_titulo"), id_devedor=F.col("dono"), id_carteira=2 + k % 5 * 5, id_produto=1 + k % 9)
    out["Devedores"] = _set(out["Devedores"], cnpj_cpf=S.tax_id(F.col("id_devedor")))
    out["Carteiras"] = _set(out["Carteiras"], codigo_referencia=F.floor((F.col("id_carteira") - 2) / 5))
    out["Parcelas"] = _set(out["Parcelas"], id_titulo=F.col("id_parcela"), data_vencimento=F.col("data_inclusao") + S._days(10), id_situacao_parcela=F.lit("A"))
    for target, key in (("TitulosInformacoesComplementares", "id_titulo_informacao_complementar"), ("Escob", "id_escob"), ("Propensao", "id_propensao")):
        out[target] = _set(out[target], id_titulo=F.col(key))

    due = F.date_add(F.lit(FIRST_DAY), (F.col("id_acordo") % 5).cast("int"))
    ended = F.when(F.col("estado") == "P", due.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(15)))
    a = _set(with_order("Acordos", "id_acordo"), id_devedor=F.col("dono"), id_tipo_acordo=1 + F.col("id_acordo") % 9, id_negociador_responsavel=1 + F.col("id_acordo") % 9,
             data_aprovacao_proposta=since("data_aprovacao_proposta"), data_cancelamento=F.when(ended <= now, ended))
    out["Acordos"] = a
    p = with_order("AcordosParcelasPagar", "id_acordo")
    paid = (F.col("estado") == "F") & (due.cast("timestamp_ntz") <= now)
    out["AcordosParcelasPagar"] = _set(p, data_vencimento=due, data_pagamento=F.when(paid, due), valor_pago=F.when(paid, F.col("valor")))
    out["AcordosParcelasNegociadas"] = _set(out["AcordosParcelasNegociadas"], id_titulo=F.col("id_acordo"))

    first = S.contrato_principal(world).select(F.col("id_devedor").alias("dono"), F.col("id_titulo").alias("principal"))
    who = events.select(F.col("event_id").alias("_id"), F.col("user_id").alias("dono"))
    for target, key, kind in (("Eventos", "id_evento", "id_tipo_evento"), ("Ocorrencias", "id_ocorrencia", "id_tipo_ocorrencia")):
        d = out[target].join(who, F.col(key) == F.col("_id")).join(first, "dono", "left")
        more = {"id_acordo": F.col(key)} if "id_acordo" in d.columns else {}
        out[target] = _set(d, id_devedor=F.col("dono"), id_titulo=F.col("principal"), id_ligacao=F.col(key), **{kind: 1 + F.col(key) % 9}, **more)
    out = {target: df.select(*columns[target]) for target, df in out.items()}
    return out | {"mailing": S.mailing_source(world).select(F.col("id_carteira").cast("int"), "id_devedor"), "promessas": S.promessas(world),
                  "discador": S.dialer_source(world), "discador_digital": S.digital_source(world)}
