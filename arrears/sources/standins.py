"""Warehouse tables derived from the driver's TPC-H-style tables.

The warehouse's own sources (contracts, instalments, debtors, contacts,
calls, agreements, run logs) are not public, so the checks run on stand-ins
derived column by column from the driver tables.  Each stand-in exists
twice: as a Spark ``DataFrame`` (what the jobs read) and as a DuckDB SQL
CTE (what the oracle reads), written independently.

Mapping: ``lineitem`` = instalments and agreement instalments, ``orders`` =
contracts and agreements, ``customer`` = debtors, ``nation`` = portfolios,
``supplier`` = users, ``events`` = contacts, calls and the run log.  Every
rule is a per-row derivation or a full-table aggregate; nothing samples or
caps rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(19,4)"

# The clocks of the two worlds in the driver data (orders / lineitem span
# 1995-2001, events span January 2024).
CONTRACT_AS_OF = _dt.datetime(1998, 9, 1, 0, 0, 0)
EVENT_AS_OF = _dt.datetime(2024, 1, 15, 12, 0, 0)

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


class DriverTables:
    """Lazy readers of ``{sf_dir}/{name}.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in DRIVER_TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]


def _days(n) -> F.Column:
    return F.make_dt_interval(F.lit(n) if isinstance(n, int) else n)


def _digit(c: str) -> F.Column:
    return F.substring(F.col(c), 1, 1)


# ---------------------------------------------------------------- contracts

def parcelas(t: DriverTables) -> DataFrame:
    l = t.lineitem
    return l.select(
        F.col("l_orderkey").alias("id_titulo"),
        F.col("l_linenumber").alias("numero_parcela"),
        F.when(F.col("l_linestatus") == "O", "A").otherwise("P").alias("id_situacao_parcela"),
        F.col("l_extendedprice").cast(MONEY).alias("valor_principal"),
        F.col("l_shipdate").alias("data_vencimento"),
        (F.col("l_shipdate") - _days(F.col("l_linenumber") * 30)).alias("data_inclusao"),
        F.when(F.col("l_returnflag") == "R", F.col("l_shipdate") - _days(7)).alias("data_reabertura"),
        F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")).alias("data_devolucao"),
        (F.col("l_shipdate") + _days(F.col("l_linenumber"))).alias("data_atualizacao"),
    )


def titulos(t: DriverTables) -> DataFrame:
    o = t.orders
    return o.select(
        F.col("o_orderkey").alias("id_titulo"),
        F.col("o_custkey").alias("id_devedor"),
        F.col("o_orderkey").cast("string").alias("numero_contrato"),
        _digit("o_orderpriority").cast("int").alias("plano"),
        (_digit("o_orderpriority").cast("int") + F.lit(5)).alias("id_produto"),
        F.col("o_orderdate").alias("data_inclusao"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderdate") + _days(3)).alias("data_atualizacao"),
        F.col("o_orderstatus").alias("situacao"),
    )


def titulos_info(t: DriverTables) -> DataFrame:
    o = t.orders
    d = _digit("o_orderpriority")
    return o.select(
        F.col("o_orderkey").alias("id_titulo"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast(MONEY)).alias("valor_contrato_atualizado"),
        F.when(d == "3", "11").when(d == "4", "01").otherwise(d).alias("area_negocio"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("A0"), d)).alias("codigo_cluster_score"),
    )


def escob(t: DriverTables) -> DataFrame:
    o = t.orders
    return (o.filter(F.col("o_orderstatus") == "O")
            .select(F.col("o_orderkey").alias("id_titulo"),
                    F.concat(F.lit("W"), _digit("o_orderpriority")).alias("cluster")))


def propensao(t: DriverTables) -> DataFrame:
    o = t.orders
    return o.select(F.col("o_orderkey").alias("id_titulo"),
                    F.concat(F.lit("A"), _digit("o_orderpriority")).alias("cluster"))


def tax_id(key) -> F.Column:
    """14-character debtor tax id of a customer key."""
    return F.right(F.concat(F.lit("0000000"), (F.lit(10_000_000_000) + key).cast("string")), F.lit(14))


def devedores(t: DriverTables) -> DataFrame:
    c = t.customer
    return c.select(
        F.col("c_custkey").alias("id_devedor"),
        tax_id(F.col("c_custkey")).alias("cnpj_cpf"),
        F.col("c_name").alias("razao_social_nome"),
        F.col("c_nationkey").alias("id_carteira"),
    )


def carteiras(t: DriverTables) -> DataFrame:
    n = t.nation
    return n.select(F.col("n_nationkey").alias("id_carteira"),
                    F.col("n_regionkey").alias("codigo_referencia"),
                    F.col("n_name").alias("carteira"))


# ---------------------------------------------------------------- contacts

def contrato_principal(t: DriverTables) -> DataFrame:
    """Each debtor's first contract (contacts are recorded on it)."""
    return (t.orders.groupBy(F.col("o_custkey").alias("id_devedor"))
            .agg(F.min("o_orderkey").alias("id_titulo")))


def _with_contract(t: DriverTables, e: DataFrame) -> DataFrame:
    cp = contrato_principal(t).withColumnRenamed("id_devedor", "user_id")
    return e.join(cp, "user_id", "left")


def _call_id(e) -> F.Column:
    return F.when(F.col("event_type").isin("click", "view")
                  | ((F.col("event_type") == "purchase") & (F.col("value") >= 20)), F.col("event_id"))


def ocorrencias(t: DriverTables) -> DataFrame:
    e = _with_contract(t, t.events.filter(F.col("event_type") != "click"))
    return e.select(
        F.col("event_id").alias("id_ocorrencia"),
        F.col("user_id").alias("id_devedor"),
        F.col("id_titulo"),
        F.col("event_type").alias("id_tipo_ocorrencia"),
        F.when(F.col("event_type") == "view", 1).when(F.col("event_type") == "error", None)
        .otherwise(2).cast("int").alias("id_origem"),
        _call_id(e).alias("id_ligacao"),
        F.col("ts").alias("data_ocorrencia"),
        F.col("props").alias("complemento"),
        F.floor("value").cast("bigint").alias("id_usuario_inclusao"),
        F.when(F.col("event_type") == "purchase", F.col("id_titulo")).alias("id_acordo"),
    )


def eventos(t: DriverTables) -> DataFrame:
    e = _with_contract(t, t.events.filter(F.col("event_type") == "click"))
    return e.select(
        F.col("event_id").alias("id_evento"),
        F.col("user_id").alias("id_devedor"),
        F.col("id_titulo"),
        F.col("event_type").alias("id_tipo_evento"),
        F.lit(5).cast("int").alias("id_origem"),
        F.col("event_id").alias("id_ligacao"),
        F.col("ts").alias("data_evento"),
        F.col("props").alias("complemento"),
        F.floor("value").cast("bigint").alias("id_usuario_inclusao"),
    )


def _classification(c) -> F.Column:
    return F.when(F.col(c).isin("purchase", "view"), 1).otherwise(2).cast("int")


def tipos_ocorrencias(t: DriverTables) -> DataFrame:
    return (t.events.select("event_type").distinct()
            .select(F.col("event_type").alias("id_tipo_ocorrencia"),
                    F.upper("event_type").alias("codigo_ocorrencia"),
                    F.col("event_type").alias("tipo_ocorrencia"),
                    _classification("event_type").alias("id_classificacao")))


def tipos_eventos(t: DriverTables) -> DataFrame:
    return (t.events.select("event_type").distinct()
            .select(F.col("event_type").alias("id_tipo_evento"),
                    F.upper("event_type").alias("codigo_evento"),
                    F.col("event_type").alias("tipo_evento"),
                    _classification("event_type").alias("id_classificacao")))


def phone(event_id) -> F.Column:
    return F.concat(F.lit("11"), (F.lit(900_000_000) + event_id).cast("string"))


def ligacoes(t: DriverTables) -> DataFrame:
    e = t.events
    return (e.filter(_call_id(e).isNotNull())
            .select(F.col("event_id").alias("id_ligacao"),
                    F.concat(F.lit("K"), F.col("event_id").cast("string")).alias("chave"),
                    F.when(F.col("value") < 100, "A").when(F.col("value") < 250, "M")
                    .otherwise("P").alias("id_origem_ligacao"),
                    F.lit("11").alias("ddd_ligacao"),
                    F.right(phone(F.col("event_id")), F.lit(9)).alias("numero_ligacao"),
                    F.col("ts").alias("data_inicializacao"),
                    F.col("user_id").alias("id_devedor")))


def usuarios(t: DriverTables) -> DataFrame:
    s = t.supplier
    return s.select(F.col("s_suppkey").alias("id_usuario"), F.col("s_name").alias("nome"),
                    F.concat(F.lit("U"), F.col("s_suppkey").cast("string")).alias("referencia"))


def runs(t: DriverTables, as_of=EVENT_AS_OF) -> DataFrame:
    """Run log as it stood at ``as_of``: one run per event up to then."""
    from arrears.functions.derive import ts_lit
    e = t.events.filter(F.col("ts") <= ts_lit(as_of))
    status = (F.when(F.col("value") < 5, "Erro").when(F.col("value") < 8, "Executando")
              .otherwise("Concluida"))
    return e.select(
        F.col("event_id").alias("id_execucao"),
        F.col("event_type").alias("nome_procedure"),
        F.col("ts").alias("data_hora_inicio"),
        F.when(status != "Executando",
               F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.floor("value").cast("decimal(18,6)")))
        .alias("data_hora_fim"),
        status.alias("status_execucao"),
    )


def _client(v) -> F.Column:
    return (F.when(v < 100, 771).when(v < 200, 777).when(v < 300, 779).when(v < 400, 799)
            .otherwise(800).cast("int"))


def dialer_source(t: DriverTables) -> DataFrame:
    """The dialer's call table (remote in production)."""
    e = t.events.filter(F.col("event_type") == "click")
    return e.select(
        F.col("ts").alias("inicio_discagem"),
        _client(F.col("value")).alias("cliente"),
        F.floor(F.col("value") / 100).cast("int").alias("codigo_referencia"),
        tax_id(F.col("user_id")).alias("cpf_cnpj"),
        F.lit(None).cast("string").alias("contrato"),
        phone(F.col("event_id")).alias("telefone_discado"),
        F.lit("DISCADOR").alias("origem"),
        F.when(F.col("value") < 50, 1).otherwise(2).cast("int").alias("classificacao"),
        F.col("props").alias("motivo_finalizacao"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("cobrador"),
        F.col("event_type").alias("campanha"),
        F.lit("CELULAR").alias("tipo_telefone"),
        F.floor(F.col("value") * 10).cast("int").alias("duracao_chamada"),
        F.floor(F.col("value") * 5).cast("int").alias("duracao_conectado"),
        F.floor(F.col("value")).cast("int").alias("duracao_wrap_up"),
        F.concat(F.lit("K"), F.col("event_id").cast("string")).alias("itr_key"),
    )


def digital_source(t: DriverTables) -> DataFrame:
    """The digital dialer's call table (remote in production)."""
    e = t.events.filter(F.col("event_type") == "view")
    return e.select(
        F.col("ts").alias("data"),
        _client(F.col("value")).alias("cliente"),
        F.floor(F.col("value") / 100).cast("int").alias("codigo_referencia"),
        (F.lit(10_000_000_000) + F.col("user_id")).cast("string").alias("cpf_cnpj"),
        F.lit(None).cast("string").alias("contrato"),
        phone(F.col("event_id")).alias("telefone_discado"),
        F.lit("DIGITAL").alias("origem"),
        F.when(F.col("value") < 50, 1).otherwise(2).cast("int").alias("classificacao"),
        F.when(F.col("value") < 10, "").otherwise(F.col("props")).alias("tabulacao"),
        F.when(F.col("value") < 20, "").otherwise(F.concat(F.lit("U"), F.col("user_id").cast("string"))).alias("cobrador"),
        F.col("event_type").alias("campanha"),
        F.floor(F.col("value") * 10).cast("int").alias("duracao_chamada"),
        F.concat(F.lit("C"), F.col("event_id").cast("string")).alias("call_id"),
    )


# -------------------------------------------------------------- agreements

def acordos(t: DriverTables) -> DataFrame:
    o = t.orders
    return o.select(
        F.col("o_orderkey").alias("id_acordo"),
        _digit("o_orderpriority").cast("int").alias("id_tipo_acordo"),
        F.col("o_custkey").alias("id_devedor"),
        _digit("o_orderpriority").cast("int").alias("plano"),
        F.floor(F.col("o_totalprice") / 5000).cast("bigint").alias("id_negociador_responsavel"),
        F.col("o_orderdate").alias("data_inclusao"),
        F.col("o_orderpriority").alias("proposta"),
        F.when(F.col("o_orderstatus").isin("F", "P"), F.col("o_orderdate") + _days(2)).alias("data_aprovacao_proposta"),
        F.col("o_orderstatus").alias("id_status_acordo"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate") + _days(45)).alias("data_cancelamento"),
    )


def acordos_parcelas_pagar(t: DriverTables) -> DataFrame:
    l = t.lineitem
    paid = F.col("l_returnflag") == "A"
    return l.select(
        F.col("l_orderkey").alias("id_acordo"),
        F.col("l_linenumber").alias("numero_parcela"),
        F.to_date("l_shipdate").alias("data_vencimento"),
        F.col("l_extendedprice").cast(MONEY).alias("valor"),
        F.when(paid, F.to_date("l_shipdate")).alias("data_pagamento"),
        F.when(paid, F.col("l_extendedprice").cast(MONEY)).alias("valor_pago"),
    )


def acordos_parcelas_negociadas(t: DriverTables) -> DataFrame:
    l = t.lineitem
    return l.select(F.col("l_orderkey").alias("id_acordo"), F.col("l_orderkey").alias("id_titulo"),
                    F.col("l_linenumber").alias("numero_parcela"))


def tipos_acordos(t: DriverTables) -> DataFrame:
    return (t.orders.select(_digit("o_orderpriority").cast("int").alias("id_tipo_acordo"),
                            F.col("o_orderpriority").alias("tipo_acordo")).distinct())


def status_acordos(t: DriverTables) -> DataFrame:
    s = F.col("o_orderstatus")
    return (t.orders.select(s.alias("id_status_acordo")).distinct()
            .withColumn("status_acordo", F.when(F.col("id_status_acordo") == "F", "Quitado")
                        .when(F.col("id_status_acordo") == "O", "Ativo").otherwise("Cancelado")))


def ocorrencias_acordo(t: DriverTables) -> DataFrame:
    """Occurrences carrying agreements in the contract world."""
    o = t.orders
    return o.select(F.col("o_orderkey").alias("id_ocorrencia"), F.col("o_orderkey").alias("id_acordo"),
                    F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_orderkey"))
                    .alias("id_ligacao"))


def ligacoes_acordo(t: DriverTables) -> DataFrame:
    o = t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    return o.select(F.col("o_orderkey").alias("id_ligacao"),
                    F.when(F.col("o_orderstatus") == "F", "A").otherwise("M").alias("id_origem_ligacao"))


# ---------------------------------------------------------------- mailing

def mailing_source(t: DriverTables) -> DataFrame:
    """Today's callable list: debtor and portfolio of every open contract."""
    p = t.lineitem.filter(F.col("l_linestatus") == "O").select(F.col("l_orderkey").alias("o_orderkey"))
    o = t.orders.join(p, "o_orderkey", "left_semi")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return (o.join(c, "o_custkey").select(F.col("c_nationkey").alias("id_carteira"),
                                          F.col("o_custkey").alias("id_devedor")).distinct())


def mailing_target(t: DriverTables) -> DataFrame:
    """The mailing table as held before today's run: every debtor with a
    contract in its portfolio; debtors of the AUTOMOBILE segment were kept
    without portfolio (NULL, the wildcard of J12) and those of the
    MACHINERY segment were already withdrawn once."""
    c = t.customer
    return c.select(
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(None)).otherwise(F.col("c_nationkey"))
        .cast("int").alias("id_carteira"),
        F.col("c_custkey").alias("id_devedor"),
        F.when(F.col("c_mktsegment") == "MACHINERY", 1).cast("int").alias("id_retirada"),
    )


def promessas(t: DriverTables) -> DataFrame:
    """Payment promises: one per purchase contact, due three days later."""
    e = t.events.filter(F.col("event_type") == "purchase")
    return e.select(F.col("user_id").alias("id_devedor"), (F.col("ts") + _days(3)).alias("data_vencimento"))


def ocorrencias_retorno(t: DriverTables) -> DataFrame:
    """Occurrences with numeric type codes for the mailing return rules:
    error contacts are type 350, their text a return reason."""
    e = _with_contract(t, t.events)
    v = F.col("value")
    return e.select(
        F.col("event_id").alias("id_ocorrencia"), F.col("user_id").alias("id_devedor"), "id_titulo",
        F.when(F.col("event_type") == "error", 350).otherwise(0).cast("int").alias("id_tipo_ocorrencia"),
        F.col("ts").alias("data_ocorrencia"),
        F.when(v < 100, "Colchão").when(v < 200, F.concat(F.lit("BAIXA PGTO DO / DT PGTO "), F.col("props")))
        .otherwise(F.col("props")).alias("complemento"))


def titulos_carteira(t: DriverTables) -> DataFrame:
    """Contracts with the portfolio of their debtor."""
    c = t.customer.select(F.col("c_custkey").alias("id_devedor"), F.col("c_nationkey").alias("id_carteira"))
    return titulos(t).join(c, "id_devedor")


# ------------------------------------------------- variants of single rules

def produtos(t: DriverTables) -> DataFrame:
    """Products of the contracts; that of low priority is not in the table."""
    o = t.orders.filter(F.col("o_orderpriority") != "5-LOW")
    return o.select((_digit("o_orderpriority").cast("int") + F.lit(5)).alias("id_produto"), F.col("o_orderpriority").alias("produto")).distinct()


def _parcela_id() -> F.Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def parcelas_com_id(t: DriverTables) -> DataFrame:
    """Instalments with an id and without the reopening date, which ``parcelas_info`` has."""
    return parcelas(t).withColumn("id_parcela", F.col("id_titulo") * 10 + F.col("numero_parcela")).drop("data_reabertura")


def parcelas_info(t: DriverTables) -> DataFrame:
    back = t.lineitem.filter(F.col("l_returnflag") == "R")
    return back.groupBy(_parcela_id().alias("id_parcela")).agg(F.max(F.col("l_shipdate") - _days(7)).alias("data_reabertura"))


def parcelas_devolvidas(t: DriverTables) -> DataFrame:
    """Instalments of which the returned ones went back the day before the
    contract clock, and only large open ones are still active."""
    l = t.lineitem
    return l.select(
        F.col("l_orderkey").alias("id_titulo"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_quantity") > 48), "A").otherwise("P").alias("id_situacao_parcela"),
        F.when(F.col("l_returnflag") == "R", F.lit(CONTRACT_AS_OF).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.col("l_linenumber"))).alias("data_devolucao"))


def untidy(c: F.Column, by: F.Column) -> F.Column:
    """Text as people type it: some in lower case, some with trailing blanks."""
    return F.when(by == "P", F.concat(F.lower(c), F.lit("  "))).when(by == "O", F.concat(c, F.lit(" "))).otherwise(c)


def untidy_titulos_info(t: DriverTables) -> DataFrame:
    by = t.orders.select(F.col("o_orderkey").alias("id_titulo"), F.col("o_orderstatus").alias("_by"))
    d = titulos_info(t).join(by, "id_titulo")
    return d.withColumns({c: untidy(F.col(c), F.col("_by")) for c in ("area_negocio", "codigo_cluster_score")}).drop("_by")


def untidy_cluster(t: DriverTables, table: DataFrame) -> DataFrame:
    by = t.orders.select(F.col("o_orderkey").alias("id_titulo"), F.col("o_orderstatus").alias("_by"))
    return table.join(by, "id_titulo").withColumn("cluster", untidy(F.col("cluster"), F.col("_by"))).drop("_by")


def untidy_parcelas(t: DriverTables) -> DataFrame:
    l = parcelas(t)
    return l.withColumn("id_situacao_parcela", F.when(F.col("numero_parcela") > 3, F.concat(F.lower("id_situacao_parcela"), F.lit(" "))).otherwise(F.col("id_situacao_parcela")))


def named_calls(t: DriverTables) -> DataFrame:
    """Calls that carry their debtor's name as typed."""
    name = F.concat(F.lit("customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0"))
    typed = F.when(F.col("event_type") == "click", F.concat(F.upper(name), F.lit(" "))).when(F.col("event_type") == "view", F.initcap(name)).otherwise(name)
    return t.events.select(F.col("event_id").alias("id_ligacao"), typed.alias("razao_social_nome"))
