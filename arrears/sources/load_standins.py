"""Full-width sources and earlier targets of the 25 loads, from the driver tables.

Each load gets a source table with every column of its declared schema and the
target as an earlier run had left it.  A row's key comes from a driver table; its
*class*, an attribute of that table, says how the target held it:

    1 not held            2 held in the same version     3 held in a version one day older
    4 held with version NULL                             5 held, version NULL on both sides

Columns without a rule of their own are filled from key, column position and
type; in the target all of them are shifted by one, so that a comparison shows
which columns an update takes over and which it leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.sources import schemas
from arrears.sources.standins import DriverTables, _days

START = "1997-01-01 00:00:00"
HELD_EVENTS = "2024-01-10 00:00:00"
_SEGMENTS = {"BUILDING": 1, "AUTOMOBILE": 2, "MACHINERY": 3, "HOUSEHOLD": 4, "FURNITURE": 5}


def _start() -> Column:
    return F.lit(START).cast("timestamp_ntz")


def filler(field: T.StructField, position: int, shift: int) -> Column:
    n = F.col("k") + F.lit(position + shift)
    kind = field.dataType
    if isinstance(kind, T.StringType):
        v = F.concat(F.lit(field.name + "-"), (n % 50).cast("string"))
    elif isinstance(kind, T.TimestampNTZType):
        v = _start() + _days((n % 700).cast("int"))
    elif isinstance(kind, T.DateType):
        v = F.to_date(_start() + _days((n % 700).cast("int")))
    elif isinstance(kind, T.DoubleType):
        v = (n * 5 % 1000) / F.lit(4.0)
    elif isinstance(kind, T.DecimalType):
        v = n * 13 % 100000
    elif isinstance(kind, T.ShortType):
        v = n % 100
    else:
        v = n * 7 % 1000
    return v.cast(kind)


def rows(df: DataFrame, table: str, own: dict[str, Column], shift: int = 0) -> DataFrame:
    """``df`` (with the key ``k``) as a row of ``table``: ``own`` columns, fillers elsewhere."""
    fields = schemas.schema(table).fields
    return df.select(*((own[f.name].cast(f.dataType) if f.name in own else filler(f, i + 1, shift)).alias(f.name) for i, f in enumerate(fields)))


# keys: k, class, when, state

def by_order(t: DriverTables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("k"), F.substring("o_orderpriority", 1, 1).cast("int").alias("class"),
                           F.col("o_orderdate").alias("when"), F.col("o_orderstatus").alias("state"), F.col("o_totalprice").alias("price"))


def by_customer(t: DriverTables) -> DataFrame:
    named = F.create_map(*(F.lit(x) for kv in _SEGMENTS.items() for x in kv))
    return t.customer.select(F.col("c_custkey").alias("k"), named[F.col("c_mktsegment")].alias("class"), (_start() + _days(F.col("c_nationkey") * 50)).alias("when"))


def by_supplier(t: DriverTables) -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").alias("k"), (F.floor(F.col("s_nationkey") / 5) + 1).cast("int").alias("class"),
                             (_start() + _days(F.col("s_nationkey") * 50)).alias("when"), F.col("s_nationkey").alias("nation"))


def _version() -> Column:
    return F.when(F.col("class") != 5, F.col("when") + _days(3))


def _held_version() -> Column:
    return F.when(F.col("class") == 2, F.col("when") + _days(3)).when(F.col("class") == 3, F.col("when") + _days(2))


def _held(df: DataFrame) -> DataFrame:
    return df.where(F.col("class") != 1)


# A key, a version, everything else filled

_VERSIONED = {"Titulos": by_order, "Devedores": by_customer, "DevedoresInformacoesComplementares": by_customer, "TitulosInformacoesComplementares": by_order,
              "Usuarios": by_supplier, "Escob": by_order, "Propensao": by_order, "Telefones": by_customer}


def versioned(t: DriverTables, target: str) -> tuple[DataFrame, DataFrame]:
    base, table = _VERSIONED[target](t), schemas.TABLES[target]
    key = schemas.schema(table).fieldNames()[0]
    return (rows(base, table, {key: F.col("k"), "data_atualizacao": _version()}),
            rows(_held(base), table, {key: F.col("k"), "data_atualizacao": _held_version()}, 1))


# L9-L14

def parcelas(t: DriverTables) -> tuple[DataFrame, DataFrame]:
    base = by_order(t)
    own = {"id_parcela": F.col("k"), "id_situacao_parcela": F.when(F.col("state") == "O", "A").otherwise("P"), "data_inclusao": F.col("when")}
    return (rows(base, "parcelas", {**own, "data_atualizacao": _version()}), rows(_held(base), "parcelas", {**own, "data_atualizacao": _held_version()}, 1))


def parcelas_info(t: DriverTables) -> tuple[DataFrame, DataFrame]:
    base = by_order(t)
    own = {"id_parcela_informacao_complementar": F.col("k"), "id_parcela": F.col("k"), "data_reabertura": F.when(F.col("state") != "F", F.to_date("when"))}
    return (rows(base, "parcelas_info", {**own, "data_atualizacao": _version()}),
            rows(_held(base), "parcelas_info", {**own, "data_reabertura": F.to_date(F.col("when") - _days(1)), "data_atualizacao": _held_version()}, 1))


def acordos(t: DriverTables) -> tuple[DataFrame, DataFrame]:
    """Held with another status (class 3), without cancellation (4) or without approval (5)."""
    base = by_order(t)
    status = F.when(F.col("state") == "F", 1).when(F.col("state") == "O", 2).otherwise(3)
    approved, ended = F.when(F.col("state") != "O", F.col("when") + _days(2)), F.when(F.col("state") == "P", F.col("when") + _days(45))
    own = {"id_acordo": F.col("k"), "data_inclusao": F.col("when")}
    return (rows(base, "acordos", {**own, "id_status_acordo": status, "data_aprovacao_proposta": approved, "data_cancelamento": ended}),
            rows(_held(base), "acordos", {**own, "id_status_acordo": F.when(F.col("class") == 3, status + 5).otherwise(status),
                                          "data_aprovacao_proposta": F.when(F.col("class") != 5, approved), "data_cancelamento": F.when(F.col("class") != 4, ended)}, 1))


def parcelas_pagar(t: DriverTables) -> tuple[DataFrame, DataFrame]:
    """Held unpaid (class 3) or paid on another day (4)."""
    base = by_order(t)
    due, paid = F.to_date(F.col("when") + _days(30)), F.col("state") == "F"
    own = {"id_acordo_parcela_pagar": F.col("k"), "id_acordo": F.col("k"), "data_vencimento": due, "valor": F.col("price")}
    held_day = F.when(F.col("class") == 4, F.date_sub(due, 1)).when(F.col("class") != 3, due)
    return (rows(base, "acordos_parcelas_pagar", {**own, "data_pagamento": F.when(paid, due), "valor_pago": F.when(paid, F.col("price"))}),
            rows(_held(base), "acordos_parcelas_pagar", {**own, "data_pagamento": F.when(paid, held_day),
                                                         "valor_pago": F.when(paid & (F.col("class") != 3), F.col("price"))}, 1))


def parcelas_negociadas(t: DriverTables) -> tuple[DataFrame, DataFrame]:
    """Instalments of returned lines were held."""
    base = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), F.col("l_orderkey").alias("parent"), F.col("l_returnflag").alias("flag"))
    own = {"id_acordo_parcela_negociada": F.col("k"), "id_acordo": F.col("parent")}
    return rows(base, "acordos_parcelas_negociadas", own), rows(base.where("flag = 'R'"), "acordos_parcelas_negociadas", own, 1)


def acordos_info(t: DriverTables) -> tuple[DataFrame, DataFrame]:
    base = by_order(t)
    return rows(base, "acordos_info", {"id_acordo": F.col("k")}), rows(_held(base), "acordos_info", {"id_acordo": F.col("k")}, 1)


# Contacts by id; L18-L25: dimensions, whose sources repeat rows

_CONTACTS = {"Eventos": ("id_evento", "data_evento"), "Ocorrencias": ("id_ocorrencia", "data_ocorrencia"), "Ligacoes": ("id_ligacao", "data_inicializacao")}


def contacts(t: DriverTables, target: str) -> tuple[DataFrame, DataFrame]:
    key, when = _CONTACTS[target]
    base = t.events.select(F.col("event_id").alias("k"), F.col("ts").alias("when"))
    own = {key: F.col("k"), when: F.col("when")}
    held = base.where(F.col("when") < F.lit(HELD_EVENTS).cast("timestamp_ntz"))
    return rows(base, schemas.TABLES[target], own), rows(held, schemas.TABLES[target], own, 1)


def dimension(t: DriverTables, target: str) -> tuple[DataFrame, DataFrame]:
    table = schemas.TABLES[target]
    key = schemas.schema(table).fieldNames()[0]
    if target == "Carteiras":
        base = t.nation.select(F.col("n_nationkey").cast("bigint").alias("k"), F.col("n_name").alias("name"), (F.col("n_regionkey") + 3).alias("client"))
        held, own = base.where("name <= 'NATION_17'"), {key: F.col("k"), "id_cliente": F.col("client")}
    elif target == "OrigensLigacoes":
        base = t.region.select(F.col("r_regionkey").cast("bigint").alias("k"), F.col("r_name").alias("name"))
        held, own = base.where("name < 'ASIA'"), {key: F.col("k").cast("string")}
    else:
        base = by_supplier(t)
        held, own = base.where("nation = 0"), {key: F.col("k")}
    return rows(base.unionByName(base), table, own), rows(held, table, own, 1)


def source_and_target(t: DriverTables, target: str) -> tuple[DataFrame, DataFrame]:
    """The source of a load and its target before the run."""
    special = {"Parcelas": parcelas, "ParcelasInformacoesComplementares": parcelas_info, "Acordos": acordos, "AcordosParcelasPagar": parcelas_pagar,
               "AcordosParcelasNegociadas": parcelas_negociadas, "AcordosInformacoesComplementares": acordos_info}
    if target in special:
        return special[target](t)
    if target in _VERSIONED:
        return versioned(t, target)
    return contacts(t, target) if target in _CONTACTS else dimension(t, target)


def inputs(t: DriverTables) -> dict[str, DataFrame]:
    """The other sources that the extracts of L10-L14 read."""
    return {"parcelas": parcelas(t)[0], "acordos": acordos(t)[0], "parcelas_pagar": parcelas_pagar(t)[0]}
