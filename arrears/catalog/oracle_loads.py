"""DuckDB SQL of the 25 loads on their full-width stand-ins, written apart from
the load code: sources and earlier targets as CTEs, each load's extract, the rows
left after its comparison, and the new target.  Column lists come from the
declared schemas; the set lists are repeated here as the oracle's own."""

from __future__ import annotations

import re

from arrears.sources import schemas

DAY, TS = "DATE '1998-08-31'", "TIMESTAMP '1998-08-31 00:00:00'"
PAID, TODAY = "DATE '1998-08-28'", "DATE '1998-09-01'"
START = "TIMESTAMP '1997-01-01 00:00:00'"
ZERO = "TIMESTAMP '1900-01-01 00:00:00'"

BASES = {
    "by_order": "SELECT o_orderkey AS k, CAST(o_orderpriority[1] AS INT) AS class, o_orderdate AS w, o_orderstatus AS state, o_totalprice AS price FROM orders",
    "by_customer": f"""SELECT c_custkey AS k, list_position(['BUILDING', 'AUTOMOBILE', 'MACHINERY', 'HOUSEHOLD', 'FURNITURE'], c_mktsegment) AS class,
                   {START} + to_days(c_nationkey * 50) AS w FROM customer""",
    "by_supplier": f"SELECT s_suppkey AS k, s_nationkey // 5 + 1 AS class, {START} + to_days(s_nationkey * 50) AS w, s_nationkey AS nation FROM supplier",
    "by_line": "SELECT l_orderkey * 10 + l_linenumber AS k, l_orderkey AS parent, l_returnflag AS flag FROM lineitem",
    "by_event": "SELECT event_id AS k, ts AS w FROM events",
    "by_nation": "SELECT n_nationkey::BIGINT AS k, n_name AS name, n_regionkey + 3 AS client FROM nation",
    "by_region": "SELECT r_regionkey::BIGINT AS k, r_name AS name FROM region",
}
VERSION = {"data_atualizacao": "CASE WHEN class <> 5 THEN w + INTERVAL 3 DAY END"}
HELD_VERSION = {"data_atualizacao": "CASE class WHEN 2 THEN w + INTERVAL 3 DAY WHEN 3 THEN w + INTERVAL 2 DAY END"}
STATUS = "CASE state WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END"
APPROVED, ENDED = "CASE WHEN state <> 'O' THEN w + INTERVAL 2 DAY END", "CASE WHEN state = 'P' THEN w + INTERVAL 45 DAY END"
DUE = "CAST(w + INTERVAL 30 DAY AS DATE)"


def columns(table: str) -> list[tuple[str, str]]:
    return re.findall(r"(\w+) (\w+(?:\(\d+,\d+\))?)", schemas.DDL[table])


def _filled(name: str, kind: str, n: str) -> str:
    if kind == "string":
        return f"'{name}-' || ({n} % 50)"
    if kind in ("timestamp_ntz", "date"):
        return f"CAST({START} + to_days(CAST({n} % 700 AS INT)) AS {'DATE' if kind == 'date' else 'TIMESTAMP'})"
    if kind == "double":
        return f"({n} * 5 % 1000) / 4.0::DOUBLE"
    if kind.startswith("decimal"):
        return f"CAST({n} * 13 % 100000 AS {kind})"
    return f"CAST({n} % 100 AS SMALLINT)" if kind == "smallint" else f"CAST({n} * 7 % 1000 AS INT)"


def table_sql(table: str, base: str, own: dict[str, str], shift: int = 0, where: str = "TRUE") -> str:
    types = {"timestamp_ntz": "TIMESTAMP", "string": "VARCHAR"}
    out = [f"CAST({own[c]} AS {types.get(kind, kind)}) AS {c}" if c in own else f"{_filled(c, kind, f'(k + {i + shift})')} AS {c}"
           for i, (c, kind) in enumerate(columns(table), 1)]
    return f"SELECT {', '.join(out)} FROM {base} WHERE {where}"


def _pair(table: str, base: str, own: dict, held: dict | None = None, where: str = "class <> 1") -> tuple[str, str]:
    return table_sql(table, base, own), table_sql(table, base, {**own, **(held or {})}, 1, where)


def _key(table: str) -> str:
    return columns(table)[0][0]


PARCELA = {"id_parcela": "k", "id_situacao_parcela": "CASE WHEN state = 'O' THEN 'A' ELSE 'P' END", "data_inclusao": "w"}
INFO = {"id_parcela_informacao_complementar": "k", "id_parcela": "k", "data_reabertura": "CASE WHEN state <> 'F' THEN CAST(w AS DATE) END"}
ACORDO = {"id_acordo": "k", "data_inclusao": "w", "id_status_acordo": STATUS, "data_aprovacao_proposta": APPROVED, "data_cancelamento": ENDED}
PAGAR = {"id_acordo_parcela_pagar": "k", "id_acordo": "k", "data_vencimento": DUE, "valor": "price", "data_pagamento": f"CASE WHEN state = 'F' THEN {DUE} END",
         "valor_pago": "CASE WHEN state = 'F' THEN price END"}
SOURCES = {
    "parcelas": _pair("parcelas", "by_order", {**PARCELA, **VERSION}, HELD_VERSION),
    "parcelas_info": _pair("parcelas_info", "by_order", {**INFO, **VERSION}, {**HELD_VERSION, "data_reabertura": "CAST(w - INTERVAL 1 DAY AS DATE)"}),
    "acordos": _pair("acordos", "by_order", ACORDO, {"id_status_acordo": f"CASE WHEN class = 3 THEN {STATUS} + 5 ELSE {STATUS} END",
                                                     "data_aprovacao_proposta": f"CASE WHEN class <> 5 THEN {APPROVED} END", "data_cancelamento": f"CASE WHEN class <> 4 THEN {ENDED} END"}),
    "acordos_parcelas_pagar": _pair("acordos_parcelas_pagar", "by_order", PAGAR,
                                    {"data_pagamento": f"CASE WHEN state = 'F' THEN CASE WHEN class = 4 THEN {DUE} - 1 WHEN class <> 3 THEN {DUE} END END",
                                     "valor_pago": "CASE WHEN state = 'F' AND class <> 3 THEN price END"}),
    "acordos_parcelas_negociadas": _pair("acordos_parcelas_negociadas", "by_line", {"id_acordo_parcela_negociada": "k", "id_acordo": "parent"}, where="flag = 'R'"),
    "acordos_info": _pair("acordos_info", "by_order", {"id_acordo": "k"}),
    "carteiras": _pair("carteiras", "by_nation", {"id_carteira": "k", "id_cliente": "client"}, where="name <= 'NATION_17'"),
    "origens_ligacoes": _pair("origens_ligacoes", "by_region", {"id_origem_ligacao": "k"}, where="name < 'ASIA'"),
    **{x: _pair(x, b, {_key(x): "k", **VERSION}, HELD_VERSION) for x, b in (
        ("titulos", "by_order"), ("devedores", "by_customer"), ("devedores_info", "by_customer"), ("titulos_info", "by_order"), ("usuarios", "by_supplier"),
        ("escob", "by_order"), ("propensao", "by_order"), ("telefones", "by_customer"))},
    **{x: _pair(x, "by_event", {_key(x): "k", w: "w"}, where="w < TIMESTAMP '2024-01-10 00:00:00'") for x, w in (
        ("eventos", "data_evento"), ("ocorrencias", "data_ocorrencia"), ("ligacoes", "data_inicializacao"))},
    **{x: _pair(x, "by_supplier", {_key(x): "k"}, where="nation = 0") for x in ("origens", "produtos", "status_acordos", "tipos_acordos", "tipos_eventos", "tipos_ocorrencias")},
}
BASE_OF = {x: next(b for b in BASES if f"FROM {b} " in sql + " ") for x, (sql, _) in SOURCES.items()}

# The columns that an update takes over (fixed values).
SETS = {
    "titulos": "id_carteira plano percentual_juros_remuneratorios data_atualizacao id_usuario_atualizacao data_exclusao id_usuario_exclusao",
    "devedores": "data_atualizacao id_usuario_atualizacao data_exclusao id_usuario_exclusao id_ultimo_enriquecimento apelido",
    "devedores_info": "*", "titulos_info": "*",
    "usuarios": "nome referencia data_admissao data_demissao data_atualizacao",
    "escob": "cluster data_atualizacao", "propensao": "cluster data_atualizacao", "telefones": "data_atualizacao pontuacao",
    "parcelas": "id_origem tipo id_situacao_parcela data_previsao_devolucao data_devolucao id_motivo_devolucao data_atualizacao id_usuario_atualizacao "
                "data_exclusao id_usuario_exclusao valido_de valido_ate",
    "parcelas_info": "data_atualizacao id_usuario_atualizacao data_reabertura valido_de valido_ate",
    "acordos": "data_aprovacao_proposta id_status_acordo codigo_acordo_cliente data_cancelamento id_usuario_cancelamento",
    "acordos_parcelas_pagar": "data_pagamento valor_pago",
}
SAME = f"coalesce(a.data_atualizacao, {ZERO}) = coalesce(b.data_atualizacao, {ZERO})"
NEW_DATES = f"(data_inclusao >= {TS} OR data_cancelamento >= {TS} OR data_aprovacao_proposta >= {TS})"
SAME_STATUS = "coalesce(a.id_status_acordo, 0) = coalesce(b.id_status_acordo, 0)"
SAME_AGREEMENT = SAME_STATUS + "".join(f" AND coalesce(a.{c}, {ZERO}) = coalesce(b.{c}, {ZERO})" for c in ("data_cancelamento", "data_aprovacao_proposta"))
SAME_PAID = "coalesce(a.data_pagamento, DATE '1900-01-01') = coalesce(b.data_pagamento, DATE '1900-01-01')"
SCOPE = f"SELECT id_acordo FROM acordos WHERE {NEW_DATES}"
CHILD_SCOPE = f"{SCOPE} UNION ALL SELECT id_acordo FROM acordos_parcelas_pagar WHERE data_pagamento = {PAID} OR data_vencimento BETWEEN {DAY} AND {TODAY}"


def _lacks(x: str, on: str) -> str:
    return f"NOT EXISTS (SELECT 1 FROM {x}_held b WHERE a.{_key(x)} = b.{_key(x)} AND {on})"


def _by_version(x: str, sign: str = ">") -> str:
    return (f"SELECT DISTINCT * FROM {x} a WHERE (a.{_key(x)} {sign} (SELECT coalesce(max({_key(x)}), 0) FROM {x}_held) OR a.data_atualizacao >= {TS}) AND {_lacks(x, SAME)}")


def _by_id(x: str, where: str = "TRUE") -> str:
    return f"SELECT * FROM {x} a WHERE a.{_key(x)} > (SELECT max({_key(x)}) FROM {x}_held) AND {where}"


#: The rows that a load counts as its source rows and goes on with.
COUNTED = {
    **{x: _by_version(x) for x in ("titulos", "devedores_info", "titulos_info", "escob", "propensao")},
    **{x: _by_version(x, ">=") for x in ("devedores", "usuarios", "telefones")},
    "parcelas": f"SELECT * FROM parcelas a WHERE (a.data_atualizacao >= {TS} OR a.data_inclusao >= {TS}) AND {_lacks('parcelas', SAME)}",
    "parcelas_info": f"""SELECT * FROM parcelas_info a WHERE a.data_reabertura IS NOT NULL
        AND EXISTS (SELECT 1 FROM parcelas p WHERE p.id_parcela = a.id_parcela AND (p.id_situacao_parcela = 'A' OR p.data_atualizacao >= {TS}))
        AND {_lacks('parcelas_info', 'a.data_atualizacao IS NOT DISTINCT FROM b.data_atualizacao')}""",
    "acordos": f"""SELECT * FROM acordos a WHERE {NEW_DATES} AND {_lacks('acordos', SAME_AGREEMENT)}
        UNION SELECT * FROM acordos a WHERE EXISTS (SELECT 1 FROM acordos_parcelas_pagar p WHERE p.id_acordo = a.id_acordo
            AND (p.data_pagamento >= {PAID} OR p.data_vencimento BETWEEN {DAY} AND {TODAY})) AND {_lacks('acordos', SAME_STATUS)}""",
    "acordos_parcelas_pagar": f"""SELECT * FROM (SELECT * FROM acordos_parcelas_pagar WHERE id_acordo IN ({SCOPE})
        UNION ALL SELECT * FROM acordos_parcelas_pagar WHERE data_pagamento = {PAID} OR data_vencimento BETWEEN {DAY} AND {TODAY}) a
        WHERE {_lacks('acordos_parcelas_pagar', SAME_PAID)}""",
    **{x: f"SELECT * FROM {x} a WHERE id_acordo IN ({CHILD_SCOPE}) AND id_acordo NOT IN (SELECT id_acordo FROM {x}_held)" for x in ("acordos_parcelas_negociadas", "acordos_info")},
    **{x: _by_id(x) for x in ("eventos", "ocorrencias", "ligacoes")},
    **{x: _by_id(x).replace("SELECT *", "SELECT DISTINCT *", 1) for x in ("origens", "produtos", "status_acordos", "tipos_acordos", "tipos_eventos", "tipos_ocorrencias")},
    "carteiras": _by_id("carteiras", "id_cliente = 5").replace("SELECT *", "SELECT DISTINCT *", 1),
    "origens_ligacoes": f"SELECT DISTINCT * FROM origens_ligacoes a WHERE {_lacks('origens_ligacoes', 'TRUE')}",
}
CHANGES = {x: f"NOT ({SAME})" for x in SETS} | {"acordos": f"NOT ({SAME_AGREEMENT})", "acordos_parcelas_pagar": "b.data_pagamento IS NULL AND a.data_pagamento IS NOT NULL"}
#: The other sources that an extract reads.
READS = {"parcelas_info": ["parcelas"], "acordos": ["acordos_parcelas_pagar"], "acordos_parcelas_pagar": ["acordos"],
         "acordos_parcelas_negociadas": ["acordos", "acordos_parcelas_pagar"], "acordos_info": ["acordos", "acordos_parcelas_pagar"]}


def _result(x: str) -> str:
    """The new target with ``acao``: b is the held row, a the staged one."""
    names, key = [c for c, _ in columns(x)], _key(x)
    if x not in SETS:
        absent = f"a.{key} NOT IN (SELECT {key} FROM {x}_held)"
        return f"SELECT *, 'N' AS acao FROM {x}_held UNION ALL SELECT *, 'I' FROM {x}_counted a WHERE {absent}"
    taken = names[1:] if SETS[x] == "*" else SETS[x].split()
    out = [f"CASE WHEN b.{key} IS NULL OR (a.{key} IS NOT NULL AND {CHANGES[x]}) THEN a.{c} ELSE b.{c} END AS {c}" if c in taken
           else f"CASE WHEN b.{key} IS NULL THEN a.{c} ELSE b.{c} END AS {c}" for c in names]
    action = f"CASE WHEN b.{key} IS NULL THEN 'I' WHEN a.{key} IS NOT NULL AND {CHANGES[x]} THEN 'U' ELSE 'N' END AS acao"
    return f"SELECT {', '.join(out)}, {action} FROM {x}_held b FULL OUTER JOIN (SELECT DISTINCT * FROM {x}_counted) a ON a.{key} = b.{key}"


def ctes(x: str) -> dict[str, str]:
    out = {}
    for y in (x, *READS.get(x, [])):
        out[BASE_OF[y]] = BASES[BASE_OF[y]]
        source = SOURCES[y][0]
        out[y] = f"{source} UNION ALL {source}" if BASE_OF[y] in ("by_supplier", "by_nation", "by_region") and x not in SETS else source
    return out | {f"{x}_held": SOURCES[x][1], f"{x}_counted": COUNTED[x]}


def _with(parts: dict[str, str], body: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in parts.items()) + "\n" + body


def load_sql(x: str) -> str:
    return _with(ctes(x), _result(x))


def volume_sql(x: str, target: str) -> str:
    return _with(ctes(x) | {"r": _result(x)}, f"""SELECT '{target}' AS tabela, (SELECT count(*) FROM {x}_counted) AS linhas_origem, count(*) FILTER (acao = 'I') AS linhas_inseridas,
        count(*) FILTER (acao = 'U') AS linhas_atualizadas, count(*) FILTER (acao IN ('I', 'U')) AS linhas_totais_destino FROM r""")


def name_of(target: str) -> str:
    return "load_" + schemas.TABLES[target]


ORACLE = {name_of(t): load_sql(x) for t, x in schemas.TABLES.items()}
ORACLE["load_volumes_by_shape"] = "\nUNION ALL ".join(f"SELECT * FROM ({volume_sql(schemas.TABLES[t], t)})" for t in (
    "Titulos", "Telefones", "ParcelasInformacoesComplementares", "Acordos", "AcordosParcelasPagar", "AcordosParcelasNegociadas", "Eventos", "Carteiras"))
