"""DuckDB SQL for every registered query, over the driver's tables.

Written independently of the Spark code: the stand-ins are re-derived as
CTEs and each job is re-stated as plain SQL, so a match is a real check.
Money is DECIMAL(19,4) on both sides, day differences are INTEGER, and
Monday is ``dayofweek = 1`` in DuckDB (2 in Spark).
"""

from __future__ import annotations

from arrears.catalog.oracle_loads import ORACLE as LOADS_ORACLE

# ------------------------------------------------------------ stand-in CTEs
CTE = {
    "parcelas": """
  SELECT l_orderkey AS id_titulo, l_linenumber AS numero_parcela,
         CASE WHEN l_linestatus = 'O' THEN 'A' ELSE 'P' END AS id_situacao_parcela,
         CAST(l_extendedprice AS DECIMAL(19,4)) AS valor_principal,
         l_shipdate AS data_vencimento,
         l_shipdate - to_days(CAST(l_linenumber * 30 AS INTEGER)) AS data_inclusao,
         CASE WHEN l_returnflag = 'R' THEN l_shipdate - INTERVAL 7 DAY END AS data_reabertura,
         CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS data_devolucao,
         l_shipdate + to_days(CAST(l_linenumber AS INTEGER)) AS data_atualizacao,
         l_returnflag AS flag
  FROM lineitem""",
    "titulos": """
  SELECT o_orderkey AS id_titulo, o_custkey AS id_devedor, CAST(o_orderkey AS VARCHAR) AS numero_contrato,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS plano,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) + 5 AS id_produto,
         o_orderdate AS data_inclusao,
         CASE WHEN o_orderstatus <> 'F' THEN o_orderdate + INTERVAL 3 DAY END AS data_atualizacao,
         o_orderstatus AS situacao
  FROM orders""",
    "titulos_info": """
  SELECT o_orderkey AS id_titulo,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(19,4)) END AS valor_contrato_atualizado,
         CASE substr(o_orderpriority, 1, 1) WHEN '3' THEN '11' WHEN '4' THEN '01'
              ELSE substr(o_orderpriority, 1, 1) END AS area_negocio,
         CASE WHEN o_orderstatus = 'F' THEN 'A0' || substr(o_orderpriority, 1, 1) END AS codigo_cluster_score
  FROM orders""",
    "escob": """
  SELECT o_orderkey AS id_titulo, 'W' || substr(o_orderpriority, 1, 1) AS cluster
  FROM orders WHERE o_orderstatus = 'O'""",
    "propensao": """
  SELECT o_orderkey AS id_titulo, 'A' || substr(o_orderpriority, 1, 1) AS cluster FROM orders""",
    "devedores": """
  SELECT c_custkey AS id_devedor,
         right('0000000' || CAST(10000000000 + c_custkey AS VARCHAR), 14) AS cnpj_cpf,
         c_name AS razao_social_nome, c_nationkey AS id_carteira
  FROM customer""",
    "carteiras": """
  SELECT n_nationkey AS id_carteira, n_regionkey AS codigo_referencia, n_name AS carteira FROM nation""",
    "contrato_principal": """
  SELECT o_custkey AS id_devedor, min(o_orderkey) AS id_titulo FROM orders GROUP BY o_custkey""",
    "ocorrencias": """
  SELECT e.event_id AS id_ocorrencia, e.user_id AS id_devedor, cp.id_titulo,
         e.event_type AS id_tipo_ocorrencia,
         CAST(CASE WHEN e.event_type = 'view' THEN 1 WHEN e.event_type = 'error' THEN NULL ELSE 2 END AS INTEGER) AS id_origem,
         CASE WHEN e.event_type IN ('click', 'view') OR (e.event_type = 'purchase' AND e.value >= 20)
              THEN e.event_id END AS id_ligacao,
         e.ts AS data_ocorrencia, e.props AS complemento,
         CAST(floor(e.value) AS BIGINT) AS id_usuario_inclusao,
         CASE WHEN e.event_type = 'purchase' THEN cp.id_titulo END AS id_acordo
  FROM events e LEFT JOIN contrato_principal cp ON e.user_id = cp.id_devedor
  WHERE e.event_type <> 'click'""",
    "eventos": """
  SELECT e.event_id AS id_evento, e.user_id AS id_devedor, cp.id_titulo, e.event_type AS id_tipo_evento,
         CAST(5 AS INTEGER) AS id_origem, e.event_id AS id_ligacao, e.ts AS data_evento,
         e.props AS complemento, CAST(floor(e.value) AS BIGINT) AS id_usuario_inclusao
  FROM events e LEFT JOIN contrato_principal cp ON e.user_id = cp.id_devedor
  WHERE e.event_type = 'click'""",
    "tipos_ocorrencias": """
  SELECT event_type AS id_tipo_ocorrencia, upper(event_type) AS codigo_ocorrencia, event_type AS tipo_ocorrencia,
         CAST(CASE WHEN event_type IN ('purchase', 'view') THEN 1 ELSE 2 END AS INTEGER) AS id_classificacao
  FROM (SELECT DISTINCT event_type FROM events)""",
    "tipos_eventos": """
  SELECT event_type AS id_tipo_evento, upper(event_type) AS codigo_evento, event_type AS tipo_evento,
         CAST(CASE WHEN event_type IN ('purchase', 'view') THEN 1 ELSE 2 END AS INTEGER) AS id_classificacao
  FROM (SELECT DISTINCT event_type FROM events)""",
    "ligacoes": """
  SELECT event_id AS id_ligacao, 'K' || CAST(event_id AS VARCHAR) AS chave,
         CASE WHEN value < 100 THEN 'A' WHEN value < 250 THEN 'M' ELSE 'P' END AS id_origem_ligacao,
         '11' AS ddd_ligacao, right('11' || CAST(900000000 + event_id AS VARCHAR), 9) AS numero_ligacao,
         ts AS data_inicializacao, user_id AS id_devedor
  FROM events
  WHERE event_type IN ('click', 'view') OR (event_type = 'purchase' AND value >= 20)""",
    "usuarios": """
  SELECT s_suppkey AS id_usuario, s_name AS nome, 'U' || CAST(s_suppkey AS VARCHAR) AS referencia FROM supplier""",
    "runs": """
  SELECT event_id AS id_execucao, event_type AS nome_procedure, ts AS data_hora_inicio,
         CASE WHEN value < 5 OR value >= 8 THEN ts + to_seconds(CAST(floor(value) AS BIGINT)) END AS data_hora_fim,
         CASE WHEN value < 5 THEN 'Erro' WHEN value < 8 THEN 'Executando' ELSE 'Concluida' END AS status_execucao
  FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00'""",
    "acordos": """
  SELECT o_orderkey AS id_acordo, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS id_tipo_acordo,
         o_custkey AS id_devedor, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS plano,
         CAST(floor(o_totalprice / 5000) AS BIGINT) AS id_negociador_responsavel,
         o_orderdate AS data_inclusao, o_orderpriority AS proposta,
         CASE WHEN o_orderstatus IN ('F', 'P') THEN o_orderdate + INTERVAL 2 DAY END AS data_aprovacao_proposta,
         o_orderstatus AS id_status_acordo,
         CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 45 DAY END AS data_cancelamento
  FROM orders""",
    "pagar": """
  SELECT l_orderkey AS id_acordo, l_linenumber AS numero_parcela, CAST(l_shipdate AS DATE) AS data_vencimento,
         CAST(l_extendedprice AS DECIMAL(19,4)) AS valor,
         CASE WHEN l_returnflag = 'A' THEN CAST(l_shipdate AS DATE) END AS data_pagamento,
         CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(19,4)) END AS valor_pago
  FROM lineitem""",
    "negociadas": """
  SELECT l_orderkey AS id_acordo, l_orderkey AS id_titulo, l_linenumber AS numero_parcela FROM lineitem""",
    "tipos_acordos": """
  SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS id_tipo_acordo, o_orderpriority AS tipo_acordo
  FROM orders""",
    "status_acordos": """
  SELECT id_status_acordo,
         CASE id_status_acordo WHEN 'F' THEN 'Quitado' WHEN 'O' THEN 'Ativo' ELSE 'Cancelado' END AS status_acordo
  FROM (SELECT DISTINCT o_orderstatus AS id_status_acordo FROM orders)""",
    "origem_acordos": """
  SELECT oc.id_acordo, arg_min(coalesce(l.id_origem_ligacao, 'H'), oc.id_ocorrencia) AS id_origem_acordo
  FROM (SELECT o_orderkey AS id_ocorrencia, o_orderkey AS id_acordo,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderkey END AS id_ligacao
        FROM orders) oc
  LEFT JOIN (SELECT o_orderkey AS id_ligacao, CASE WHEN o_orderstatus = 'F' THEN 'A' ELSE 'M' END AS id_origem_ligacao
             FROM orders WHERE o_orderpriority = '1-URGENT') l ON oc.id_ligacao = l.id_ligacao
  GROUP BY oc.id_acordo""",
    "mailing_target": """
  SELECT CAST(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE c_nationkey END AS INTEGER) AS id_carteira,
         c_custkey AS id_devedor,
         CAST(CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 END AS INTEGER) AS id_retirada
  FROM customer""",
    "mailing_source": """
  SELECT DISTINCT c.c_nationkey AS id_carteira, o.o_custkey AS id_devedor
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE o.o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'O')""",
    "titulos_carteira": """
  SELECT t.*, c.c_nationkey AS id_carteira FROM titulos t JOIN customer c ON t.id_devedor = c.c_custkey""",
    "ocorrencias_retorno": """
  SELECT e.event_id AS id_ocorrencia, e.user_id AS id_devedor, cp.id_titulo,
         CAST(CASE WHEN e.event_type = 'error' THEN 350 ELSE 0 END AS INTEGER) AS id_tipo_ocorrencia,
         e.ts AS data_ocorrencia,
         CASE WHEN e.value < 100 THEN 'Colchão' WHEN e.value < 200 THEN 'BAIXA PGTO DO / DT PGTO ' || e.props
              ELSE e.props END AS complemento
  FROM events e LEFT JOIN contrato_principal cp ON e.user_id = cp.id_devedor""",
    "promessas": """
  SELECT user_id AS id_devedor, ts + INTERVAL 3 DAY AS data_vencimento FROM events WHERE event_type = 'purchase'""",
}

DEPS = {
    "ocorrencias": ["contrato_principal"], "eventos": ["contrato_principal"],
    "ocorrencias_retorno": ["contrato_principal"], "titulos_carteira": ["titulos"],
}


def with_ctes(names, body: str, extra: list[tuple[str, str]] = ()) -> str:
    order: list[str] = []

    def add(n):
        for d in DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = [f"{n} AS ({CTE[n]}\n)" for n in order] + [f"{n} AS ({q}\n)" for n, q in extra]
    return "WITH " + ",\n".join(parts) + "\n" + body


def _bands(x: str, bands, above: str, default: str = "00. Sem faixa") -> str:
    whens = " ".join(f"WHEN {x} <= {b} THEN '{lab}'" for b, lab in bands)
    return f"CASE {whens} WHEN {x} > {bands[-1][0]} THEN '{above}' ELSE '{default}' END"


# ------------------------------------------------------------ snapshot SQL
C_DAY = "DATE '1998-09-01'"
C_TS = "TIMESTAMP '1998-09-01 00:00:00'"
E_DAY = "DATE '2024-01-15'"
E_TS = "TIMESTAMP '2024-01-15 12:00:00'"

SNAP_NAMES = ["parcelas", "titulos", "titulos_info", "escob", "propensao", "devedores", "carteiras"]


def open_sql(midnight: str, where: str = "TRUE") -> str:
    return f"""
  SELECT id_titulo, min(numero_parcela) AS numero_parcela, min(valor_principal) AS valor_principal,
         CAST(sum(valor_principal) AS DECIMAL(19,4)) AS risco,
         CAST(sum(CASE WHEN data_vencimento < {midnight} THEN valor_principal END) AS DECIMAL(19,4)) AS saldo_vencido,
         min(data_vencimento) AS data_vencimento, max(data_inclusao) AS data_inclusao,
         max(data_reabertura) AS data_reabertura
  FROM parcelas WHERE id_situacao_parcela = 'A' AND ({where}) GROUP BY id_titulo"""


SCORE = """CASE
    WHEN sc IN ('A0', 'A00') THEN 'A0' WHEN sc IN ('A1', 'A01') THEN 'A1' WHEN sc IN ('A2', 'A02') THEN 'A2'
    WHEN sc IN ('A3', 'A03', 'A04', 'A4') THEN 'A3' WHEN sc IN ('W1', 'W01') THEN 'W1'
    WHEN sc IN ('W2', 'W02') THEN 'W2' WHEN sc IN ('W3', 'W03') THEN 'W3' WHEN sc IN ('W4', 'W04') THEN 'W4' END"""


def base_sql(open_cte: str) -> str:
    return f"""
  SELECT d.codigo_referencia, d.carteira,
         {SCORE.replace('sc', 'coalesce(i.codigo_cluster_score, e.cluster, pr.cluster)')} AS cluster,
         c.id_devedor, c.cnpj_cpf, t.id_titulo, t.numero_contrato, c.razao_social_nome, t.plano,
         p.numero_parcela, coalesce(p.data_reabertura, p.data_inclusao) AS data_inclusao, p.data_vencimento,
         p.risco, p.saldo_vencido, CAST(i.valor_contrato_atualizado AS DECIMAL(19,4)) AS valor_regularizacao,
         i.area_negocio
  FROM {open_cte} p
  JOIN titulos t ON p.id_titulo = t.id_titulo
  LEFT JOIN titulos_info i ON p.id_titulo = i.id_titulo
  LEFT JOIN escob e ON p.id_titulo = e.id_titulo
  LEFT JOIN propensao pr ON p.id_titulo = pr.id_titulo
  JOIN devedores c ON t.id_devedor = c.id_devedor
  JOIN carteiras d ON c.id_carteira = d.id_carteira"""


VALUE_BANDS = [(500, "01. 0 a 500"), (1000, "02. 501 a 1000"), (2000, "03. 1001 a 2000"),
               (5000, "04. 2001 a 5000"), (7000, "05. 5001 a 7000"), (20000, "06. 7001 a 20000"),
               (80000, "07. 20000 a 80000")]
NCOR = [(90, "01. Menor que 91"), (180, "02. 91 a 180"), (360, "03. 181 a 360"), (720, "04. 361 a 720"),
        (1200, "05. 721 a 1200"), (1500, "06. 1201 a 1500"), (1800, "07. 1501 a 1800"),
        (2300, "08. 1801 a 2300")]
BPF = [(30, "01. 5 a 30"), (60, "02. 31 a 60"), (90, "03. 61 a 90"), (180, "04. 91 a 180"),
       (360, "05. 181 a 360"), (720, "06. 361 a 720"), (1200, "07. 721 a 1200"), (1500, "08. 1201 a 1500"),
       (1800, "09. 1501 a 1800"), (2300, "10. 1801 a 2300")]


def b360_sql(base_cte: str, day: str, as_of_ts: str) -> str:
    ncor = _bands("dias_em_atraso", NCOR, "09. Acima de 2300")
    bpf = "CASE WHEN dias_em_atraso < 5 THEN '00. Sem faixa' " + \
        _bands("dias_em_atraso", BPF, "11. Acima de 2300")[5:]
    return f"""
  SELECT {day} AS data, codigo_referencia, carteira, sub_produto, cluster, id_devedor, cnpj_cpf, id_titulo,
         numero_contrato, razao_social_nome, plano, numero_parcela, data_inclusao, data_vencimento,
         dias_em_atraso,
         CASE WHEN sub_produto = 'NCOR' THEN {ncor} WHEN sub_produto = 'BPF' THEN {bpf}
              ELSE '00. Sem faixa' END AS faixa_atraso,
         risco, saldo_vencido, valor_regularizacao,
         {_bands('coalesce(valor_regularizacao, risco)', VALUE_BANDS, '08. Acima de 80000')} AS faixa_valor,
         CAST(NULL AS INTEGER) AS id_retirada
  FROM (SELECT *, CASE WHEN area_negocio IN ('02', '2', '11') THEN 'NCOR'
                       WHEN area_negocio IN ('01', '1') THEN 'BPF' END AS sub_produto,
               CAST(date_diff('day', CAST(data_vencimento AS DATE), CAST({as_of_ts} AS DATE)) AS INTEGER)
                 AS dias_em_atraso
        FROM {base_cte})"""


def b360_ctes(prefix: str, where: str, midnight: str, day: str, as_of_ts: str) -> list[tuple[str, str]]:
    return [(f"{prefix}_open", open_sql(midnight, where)), (f"{prefix}_base", base_sql(f"{prefix}_open")),
            (f"{prefix}", b360_sql(f"{prefix}_base", day, as_of_ts))]


B360_COLS = ["codigo_referencia", "carteira", "sub_produto", "cluster", "cnpj_cpf", "numero_contrato",
             "razao_social_nome", "plano", "numero_parcela", "data_inclusao", "data_vencimento", "dias_em_atraso",
             "faixa_atraso", "risco", "saldo_vencido", "valor_regularizacao", "faixa_valor"]
B360_SET = ["plano", "numero_parcela", "data_inclusao", "data_vencimento", "dias_em_atraso", "faixa_atraso",
            "risco", "saldo_vencido", "valor_regularizacao", "faixa_valor"]


def apply_sql(target: str, staged: str) -> str:
    chg = " OR ".join([f"coalesce(t.{c}, 0) <> coalesce(s.{c}, 0)" for c in
                       ["numero_parcela", "dias_em_atraso", "risco", "saldo_vencido", "valor_regularizacao"]]
                      + ["coalesce(t.data_inclusao, TIMESTAMP '1900-01-01') <> "
                         "coalesce(s.data_inclusao, TIMESTAMP '1900-01-01')"])
    cols = []
    for c in B360_COLS:
        if c in B360_SET:
            cols.append(f"CASE WHEN t.id_devedor IS NULL OR (s.id_devedor IS NOT NULL AND ({chg})) "
                        f"THEN s.{c} ELSE t.{c} END AS {c}")
        else:
            cols.append(f"CASE WHEN t.id_devedor IS NULL THEN s.{c} ELSE t.{c} END AS {c}")
    return f"""
  SELECT coalesce(t.id_devedor, s.id_devedor) AS id_devedor, coalesce(t.id_titulo, s.id_titulo) AS id_titulo,
         coalesce(t.data, s.data) AS data, {', '.join(cols)},
         CASE WHEN t.id_devedor IS NULL THEN CAST(NULL AS INTEGER)
              WHEN s.id_devedor IS NULL AND t.id_retirada IS NULL THEN 1 ELSE t.id_retirada END AS id_retirada,
         CASE WHEN t.id_devedor IS NULL THEN 'I'
              WHEN s.id_devedor IS NOT NULL AND ({chg}) THEN 'U'
              WHEN s.id_devedor IS NULL AND t.id_retirada IS NULL THEN 'R' ELSE 'N' END AS acao
  FROM (SELECT * FROM {target} WHERE data >= {C_DAY}) t
  FULL OUTER JOIN {staged} s ON t.id_devedor = s.id_devedor AND t.id_titulo = s.id_titulo AND t.data = s.data"""


def _b360(prefix="b360", where="TRUE", e=False):
    if e:
        return b360_ctes(prefix, where, "TIMESTAMP '2024-01-15 00:00:00'", E_DAY, E_TS)
    return b360_ctes(prefix, where, C_TS, C_DAY, C_TS)


def _wm(form: str, src: str = "ok") -> str:
    m = "max(data_hora_inicio)"
    if form == "forward":
        w = f"CASE WHEN hour({m}) >= 22 THEN CAST({m} AS DATE) + 1 ELSE CAST({m} AS DATE) END"
    else:
        w = f"CASE WHEN hour({m}) >= 22 THEN CAST({m} AS DATE) - 2 ELSE CAST({m} AS DATE) - 1 END"
    return f"{m} AS ultima_execucao, {w} AS watermark"


OK_RUNS = [("ok", "SELECT * FROM runs WHERE status_execucao = 'Concluida'")]
PURCHASE_W = ("(SELECT CASE WHEN hour(max(data_hora_inicio)) >= 22 THEN CAST(max(data_hora_inicio) AS DATE) + 1 "
              "ELSE CAST(max(data_hora_inicio) AS DATE) END FROM runs "
              "WHERE status_execucao = 'Concluida' AND nome_procedure = 'purchase')")

TITULOS_HELD = """
  SELECT id_titulo, id_devedor, CASE WHEN situacao = 'P' THEN plano + 1 ELSE plano END AS plano,
         CASE WHEN plano = 5 THEN data_atualizacao - INTERVAL 1 DAY WHEN plano = 4 THEN NULL
              ELSE data_atualizacao END AS data_atualizacao, situacao
  FROM titulos WHERE data_inclusao < TIMESTAMP '1998-01-01 00:00:00'"""
T_SRC = "SELECT id_titulo, id_devedor, plano, data_atualizacao, situacao FROM titulos"
T_PAIR = [("src", T_SRC), ("held", TITULOS_HELD)]
SENT = "TIMESTAMP '1900-01-01 00:00:00'"


def _merge_sql(when: str, set_expr: dict[str, str]) -> str:
    """K4 on (held t, src s) by id_titulo: new state + acao."""
    cols = []
    for c in ["plano", "data_atualizacao"]:
        cols.append(f"CASE WHEN s.id_titulo IS NOT NULL AND ({when}) THEN {set_expr.get(c, 's.' + c)} "
                    f"ELSE t.{c} END AS {c}" if c in set_expr or not set_expr else f"t.{c}")
    return f"""
SELECT t.id_titulo, t.id_devedor, {', '.join(cols)}, t.situacao,
       CASE WHEN s.id_titulo IS NOT NULL AND ({when}) THEN 'U' ELSE 'N' END AS acao
FROM held t LEFT JOIN src s ON t.id_titulo = s.id_titulo"""


UPSERT_SQL = f"""
SELECT coalesce(t.id_titulo, s.id_titulo) AS id_titulo,
       CASE WHEN t.id_titulo IS NULL THEN s.id_devedor ELSE t.id_devedor END AS id_devedor,
       CASE WHEN s.id_titulo IS NOT NULL THEN s.plano ELSE t.plano END AS plano,
       CASE WHEN s.id_titulo IS NOT NULL THEN s.data_atualizacao ELSE t.data_atualizacao END AS data_atualizacao,
       CASE WHEN t.id_titulo IS NULL THEN s.situacao ELSE t.situacao END AS situacao,
       CASE WHEN t.id_titulo IS NULL THEN 'I' WHEN s.id_titulo IS NOT NULL THEN 'U' ELSE 'N' END AS acao
FROM held t FULL OUTER JOIN changed s ON t.id_titulo = s.id_titulo"""
CHANGED = f"""
  SELECT DISTINCT * FROM src s WHERE NOT EXISTS (
    SELECT 1 FROM held h WHERE h.id_titulo = s.id_titulo
      AND coalesce(h.data_atualizacao, {SENT}) = coalesce(s.data_atualizacao, {SENT}))"""

AGREEMENT_HELD = "SELECT * FROM acordos WHERE data_inclusao < TIMESTAMP '1998-08-31 00:00:00'"
W = "DATE '1998-08-31'"
WTS = "TIMESTAMP '1998-08-31 00:00:00'"
PAY = "DATE '1998-08-28'"
SENT_TS = SENT

CRM_BODY_COLS = ("data, id_devedor, id_titulo, codigo_ocorrencia, tipo_ocorrencia, id_ligacao, id_origem_ligacao, "
                 "ddd, numero, chave, id_acordo, referencia")


def crm_ctes() -> list[tuple[str, str]]:
    contacts = f"""
  SELECT o.data_ocorrencia AS data, o.id_devedor, o.id_titulo, t.codigo_ocorrencia, t.tipo_ocorrencia,
         o.id_ligacao, l.id_origem_ligacao, l.ddd_ligacao AS ddd, l.numero_ligacao AS numero, l.chave,
         o.id_acordo, u.referencia, o.id_origem, t.id_classificacao
  FROM ocorrencias o JOIN tipos_ocorrencias t ON o.id_tipo_ocorrencia = t.id_tipo_ocorrencia
  LEFT JOIN ligacoes l ON o.id_ligacao = l.id_ligacao
  LEFT JOIN usuarios u ON o.id_usuario_inclusao = u.id_usuario
  WHERE o.data_ocorrencia >= TIMESTAMP '2024-01-15 00:00:00'
  UNION ALL
  SELECT o.data_evento, o.id_devedor, o.id_titulo, t.codigo_evento, t.tipo_evento, o.id_ligacao,
         l.id_origem_ligacao, l.ddd_ligacao, l.numero_ligacao, l.chave, CAST(NULL AS BIGINT), u.referencia,
         o.id_origem, t.id_classificacao
  FROM eventos o JOIN tipos_eventos t ON o.id_tipo_evento = t.id_tipo_evento
  LEFT JOIN ligacoes l ON o.id_ligacao = l.id_ligacao
  LEFT JOIN usuarios u ON o.id_usuario_inclusao = u.id_usuario
  WHERE o.data_evento >= TIMESTAMP '2024-01-15 00:00:00'"""
    final = f"""
  SELECT c.{CRM_BODY_COLS.replace(', ', ', c.')},
         CASE WHEN c.id_origem NOT IN (1, 5) OR c.id_acordo IS NOT NULL THEN 1 END AS atendimento,
         CASE WHEN c.id_classificacao = 1 THEN 1 END AS cpc,
         CASE WHEN c.id_acordo IS NOT NULL THEN 1 END AS acordo
  FROM contacts c JOIN b360 b ON c.id_devedor = b.id_devedor AND c.id_titulo = b.id_titulo
   AND CAST(c.data AS DATE) = b.data"""
    return _b360(e=True) + [("contacts", contacts), ("crm", final)]


def dialer_ctes(digital: bool) -> list[tuple[str, str]]:
    if digital:
        calls = """
  SELECT data, codigo_referencia, right('0000000' || cpf_cnpj, 14) AS cnpj_cpf, left(telefone_discado, 2) AS ddd,
         right(telefone_discado, 9) AS numero, origem, classificacao, nullif(tabulacao, '') AS motivo_finalizacao,
         nullif(cobrador, '') AS referencia, campanha, duracao_chamada, call_id AS chave
  FROM (SELECT ts AS data,
               CAST(CASE WHEN value < 100 THEN 771 WHEN value < 200 THEN 777 WHEN value < 300 THEN 779
                         WHEN value < 400 THEN 799 ELSE 800 END AS INTEGER) AS cliente,
               CAST(floor(value / 100) AS INTEGER) AS codigo_referencia,
               CAST(10000000000 + user_id AS VARCHAR) AS cpf_cnpj,
               '11' || CAST(900000000 + event_id AS VARCHAR) AS telefone_discado, 'DIGITAL' AS origem,
               CAST(CASE WHEN value < 50 THEN 1 ELSE 2 END AS INTEGER) AS classificacao,
               CASE WHEN value < 10 THEN '' ELSE props END AS tabulacao,
               CASE WHEN value < 20 THEN '' ELSE 'U' || CAST(user_id AS VARCHAR) END AS cobrador,
               event_type AS campanha, CAST(floor(value * 10) AS INTEGER) AS duracao_chamada,
               'C' || CAST(event_id AS VARCHAR) AS call_id
        FROM events WHERE event_type = 'view')
  WHERE data >= TIMESTAMP '2024-01-15 00:00:00' AND cliente IN (771, 777, 779, 799)"""
        durs = "CAST(a.duracao_chamada AS DOUBLE) / 86400.0 AS duracao_chamada"
        other = "a.data, a.ddd, a.numero, a.origem, a.classificacao, a.motivo_finalizacao, a.referencia, " \
                "a.campanha, a.chave"
    else:
        calls = """
  SELECT data, codigo_referencia, cnpj_cpf, left(telefone_discado, 2) AS ddd, right(telefone_discado, 9) AS numero,
         origem, classificacao, motivo_finalizacao, referencia, campanha, tipo_telefone, duracao_chamada,
         duracao_falado, duracao_tabulando, chave
  FROM (SELECT ts AS data,
               CAST(CASE WHEN value < 100 THEN 771 WHEN value < 200 THEN 777 WHEN value < 300 THEN 779
                         WHEN value < 400 THEN 799 ELSE 800 END AS INTEGER) AS cliente,
               CAST(floor(value / 100) AS INTEGER) AS codigo_referencia,
               right('0000000' || CAST(10000000000 + user_id AS VARCHAR), 14) AS cnpj_cpf,
               '11' || CAST(900000000 + event_id AS VARCHAR) AS telefone_discado, 'DISCADOR' AS origem,
               CAST(CASE WHEN value < 50 THEN 1 ELSE 2 END AS INTEGER) AS classificacao,
               props AS motivo_finalizacao, 'U' || CAST(user_id AS VARCHAR) AS referencia,
               event_type AS campanha, 'CELULAR' AS tipo_telefone,
               CAST(floor(value * 10) AS INTEGER) AS duracao_chamada,
               CAST(floor(value * 5) AS INTEGER) AS duracao_falado,
               CAST(floor(value) AS INTEGER) AS duracao_tabulando, 'K' || CAST(event_id AS VARCHAR) AS chave
        FROM events WHERE event_type = 'click')
  WHERE data >= TIMESTAMP '2024-01-15 00:00:00' AND cliente IN (771, 777, 779, 799)"""
        durs = ("CAST(a.duracao_chamada AS DOUBLE) / 86400.0 AS duracao_chamada, "
                "CAST(a.duracao_falado AS DOUBLE) / 86400.0 AS duracao_falado, "
                "CAST(a.duracao_tabulando AS DOUBLE) / 86400.0 AS duracao_tabulando")
        other = "a.data, a.ddd, a.numero, a.origem, a.classificacao, a.motivo_finalizacao, a.referencia, " \
                "a.campanha, a.tipo_telefone, a.chave"
    final = f"""
  SELECT b.id_devedor, b.id_titulo, {other}, {durs}
  FROM calls a JOIN b360 b ON a.codigo_referencia = b.codigo_referencia AND a.cnpj_cpf = b.cnpj_cpf"""
    return _b360(e=True) + [("calls", calls), ("staged", final)]


STAR = """
  SELECT DISTINCT {cols}
  FROM acordos a JOIN tipos_acordos b ON a.id_tipo_acordo = b.id_tipo_acordo
  JOIN (SELECT DISTINCT id_acordo, id_titulo FROM negociadas) c ON a.id_acordo = c.id_acordo
  JOIN pagar d ON a.id_acordo = d.id_acordo
  JOIN usuarios e ON a.id_negociador_responsavel = e.id_usuario
  JOIN status_acordos f ON a.id_status_acordo = f.id_status_acordo
  JOIN origem_acordos g ON a.id_acordo = g.id_acordo
  WHERE {where}"""
STAR_NAMES = ["acordos", "tipos_acordos", "negociadas", "pagar", "usuarios", "status_acordos", "origem_acordos"]
PAY_COLS = ("a.id_acordo, b.tipo_acordo, a.id_devedor, c.id_titulo, a.plano, d.numero_parcela, d.data_pagamento, "
            "d.valor_pago, e.referencia, a.proposta, a.data_aprovacao_proposta, f.status_acordo, g.id_origem_acordo")
DUE_COLS = ("a.id_acordo, b.tipo_acordo, a.id_devedor, c.id_titulo, a.plano, d.numero_parcela, d.valor, "
            "d.data_vencimento, e.referencia, a.proposta, a.data_aprovacao_proposta, f.status_acordo, "
            "a.data_cancelamento, g.id_origem_acordo")

PURGE = """
  SELECT CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
                   WHEN 'signup' THEN 4 ELSE 5 END AS INTEGER) AS id_tabela_expurgo,
         event_type AS nome_tabela, {extra}
  FROM events"""


def _oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    q["base_open_instalments"] = with_ctes(["parcelas"], open_sql(C_TS))
    q["base_snapshot"] = with_ctes(SNAP_NAMES, base_sql("p"), [("p", open_sql(C_TS))])
    q["base_snapshot_reduced"] = q["base_snapshot"]
    with_product = base_sql("p").replace("d.carteira,", "d.carteira, x.produto,", 1) + """
  JOIN (SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) + 5 AS id_produto, o_orderpriority AS produto
        FROM orders WHERE o_orderpriority <> '5-LOW') x ON t.id_produto = x.id_produto"""
    reopened = open_sql(C_TS).replace("max(data_reabertura)", "max(i.reaberta)").replace("FROM parcelas", """FROM parcelas LEFT JOIN (
    SELECT l_orderkey AS contrato, l_linenumber AS linha, max(l_shipdate - INTERVAL 7 DAY) AS reaberta
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2) i ON i.contrato = id_titulo AND i.linha = numero_parcela""")
    q["base_snapshot_products"] = with_ctes(SNAP_NAMES, with_product, [("p", reopened)])
    q["base_snapshot_untidy"] = with_ctes(SNAP_NAMES, """
SELECT * EXCLUDE (area_negocio), CASE WHEN area_negocio IN ('02', '2', '11') THEN 'NCOR' WHEN area_negocio IN ('01', '1') THEN 'BPF' END AS sub_produto FROM b""",
                                          [("p", open_sql(C_TS)), ("b", base_sql("p"))])
    q["calls_by_name"] = """
WITH calls AS (SELECT event_id, CASE event_type WHEN 'click' THEN upper(n) || ' ' WHEN 'view' THEN 'C' || n[2:] ELSE n END AS name
               FROM (SELECT *, 'customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS n FROM events))
SELECT c_custkey AS id_devedor, event_id AS id_ligacao
FROM customer LEFT JOIN calls ON rtrim(c_name) COLLATE NOCASE = rtrim(name) COLLATE NOCASE"""
    q["base360_derived"] = with_ctes(SNAP_NAMES, "SELECT * FROM b360", _b360())
    q["base360_upsert"] = with_ctes(
        SNAP_NAMES, apply_sql("tgt", "b360"), _b360("tgt", "flag <> 'N'") + _b360())
    q["base360_withdrawn"] = with_ctes(
        SNAP_NAMES, apply_sql("b360", "stg"), _b360() + _b360("stg", "flag <> 'R'"))
    q["watermark_forward"] = with_ctes(
        ["runs"], f"SELECT nome_procedure, {_wm('forward')} FROM ok GROUP BY nome_procedure", OK_RUNS)
    q["watermark_backward"] = with_ctes(
        ["runs"], f"SELECT nome_procedure, {_wm('backward')} FROM ok GROUP BY nome_procedure", OK_RUNS)
    q["watermark_penultimate"] = with_ctes(["runs"], f"""
SELECT ok.nome_procedure, {_wm('forward')}
FROM ok JOIN (SELECT nome_procedure, max(id_execucao) AS m FROM ok GROUP BY nome_procedure) mx
  ON ok.nome_procedure = mx.nome_procedure
WHERE ok.id_execucao < mx.m GROUP BY ok.nome_procedure""", OK_RUNS)
    q["watermark_penultimate_any_ids"] = with_ctes(["runs"], f"""
SELECT ok.nome_procedure, {_wm('forward')}
FROM (SELECT *, row_number() OVER (PARTITION BY nome_procedure
                                   ORDER BY data_hora_inicio DESC, md5(CAST(id_execucao AS VARCHAR)) DESC) AS k FROM ok) ok
WHERE k > 1 GROUP BY ok.nome_procedure""", OK_RUNS)
    q["payment_date"] = with_ctes(["runs"], """
SELECT *, CASE WHEN dayofweek(watermark) = 1 THEN watermark - 3 ELSE watermark - 1 END AS data_pagamento
FROM wm""", OK_RUNS + [("wm", f"SELECT nome_procedure, {_wm('forward')} FROM ok GROUP BY nome_procedure")])
    held_max = "(SELECT coalesce(max(event_id), 0) FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00')"
    q["extract_new"] = f"SELECT DISTINCT * FROM events WHERE event_id > {held_max}"
    q["extract_new_filtered"] = (f"SELECT DISTINCT * FROM events WHERE event_id > {held_max} "
                                 "AND event_type = 'purchase'")
    q["extract_new_or_changed"] = with_ctes(["titulos"], f"""
SELECT DISTINCT * FROM titulos
WHERE id_titulo >= (SELECT coalesce(max(id_titulo), 0) FROM held) OR coalesce(data_atualizacao >= {WTS}, FALSE)""",
                                            [("held", TITULOS_HELD)])
    q["extract_id_or_date"] = with_ctes(["runs"], f"""
SELECT * FROM events
WHERE coalesce(CASE WHEN (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-10 00:00:00') IS NOT NULL
                    THEN event_id > (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-10 00:00:00')
                    ELSE ts >= CAST({PURCHASE_W} AS TIMESTAMP) OR {PURCHASE_W} IS NULL END, FALSE)""")
    q["extract_id_or_date_initial"] = with_ctes(["runs"], f"""
SELECT * FROM events
WHERE coalesce(CASE WHEN (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2000-01-01 00:00:00') IS NOT NULL
                    THEN event_id > (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2000-01-01 00:00:00')
                    ELSE ts >= CAST({PURCHASE_W} AS TIMESTAMP) OR {PURCHASE_W} IS NULL END, FALSE)""")
    q["extract_agreements"] = with_ctes(["acordos", "pagar"], f"""
SELECT * FROM acordos a
WHERE (a.data_inclusao >= {WTS} OR a.data_cancelamento >= {WTS} OR a.data_aprovacao_proposta >= {WTS})
  AND NOT EXISTS (SELECT 1 FROM held b WHERE a.id_acordo = b.id_acordo AND a.id_status_acordo = b.id_status_acordo
        AND coalesce(a.data_cancelamento, {SENT}) = coalesce(b.data_cancelamento, {SENT})
        AND coalesce(a.data_aprovacao_proposta, {SENT}) = coalesce(b.data_aprovacao_proposta, {SENT}))
UNION
SELECT * FROM acordos a
WHERE EXISTS (SELECT 1 FROM pagar b WHERE a.id_acordo = b.id_acordo
               AND (b.data_pagamento >= {PAY} OR b.data_vencimento BETWEEN {W} AND {C_DAY}))
  AND NOT EXISTS (SELECT 1 FROM held c WHERE a.id_acordo = c.id_acordo AND a.id_status_acordo = c.id_status_acordo)""",
                                        [("held", AGREEMENT_HELD)])
    scope = f"""
  SELECT id_acordo FROM acordos
  WHERE data_inclusao >= {WTS} OR data_cancelamento >= {WTS} OR data_aprovacao_proposta >= {WTS}"""
    q["extract_children_scope"] = with_ctes(["acordos", "pagar", "negociadas"], f"""
SELECT * FROM negociadas a WHERE EXISTS (SELECT 1 FROM sc b WHERE a.id_acordo = b.id_acordo)""",
                                            [("sc", scope + f"""
  UNION ALL
  SELECT id_acordo FROM pagar WHERE data_pagamento = {PAY} OR data_vencimento BETWEEN {W} AND {C_DAY}""")])
    q["extract_due_instalments"] = with_ctes(["acordos", "pagar"], f"""
SELECT * FROM pagar a WHERE EXISTS (SELECT 1 FROM sc b WHERE a.id_acordo = b.id_acordo)
UNION ALL
SELECT * FROM pagar WHERE data_pagamento = {PAY} OR data_vencimento BETWEEN {W} AND {C_DAY}""", [("sc", scope)])
    pcols = ("id_titulo, numero_parcela, id_situacao_parcela, valor_principal, data_vencimento, data_inclusao, "
             "data_reabertura, data_devolucao, data_atualizacao")
    q["extract_instalments_initial"] = with_ctes(["parcelas"], f"""
SELECT {pcols} FROM parcelas WHERE id_situacao_parcela = 'A' OR coalesce(data_atualizacao >= {WTS}, FALSE)""")
    q["extract_instalments_next"] = with_ctes(["parcelas"], f"""
SELECT {pcols} FROM parcelas a
WHERE coalesce(a.data_atualizacao >= {WTS} OR a.data_inclusao >= {WTS}, FALSE)
  AND NOT EXISTS (SELECT 1 FROM parcelas b WHERE b.data_inclusao < {WTS} AND a.id_titulo = b.id_titulo
                  AND a.numero_parcela = b.numero_parcela
                  AND coalesce(a.data_atualizacao, {SENT}) = coalesce(b.data_atualizacao, {SENT}))""")
    q["extract_info_by_parent_state"] = with_ctes(["parcelas"], f"""
SELECT a.id_titulo, a.numero_parcela, a.data_reabertura, a.data_atualizacao FROM parcelas a
WHERE a.data_reabertura IS NOT NULL
  AND EXISTS (SELECT 1 FROM parcelas b WHERE a.id_titulo = b.id_titulo AND a.numero_parcela = b.numero_parcela
              AND (b.id_situacao_parcela = 'A' OR coalesce(b.data_atualizacao >= {WTS}, FALSE)))""")
    q["drop_unchanged"] = with_ctes(["titulos"], f"""
SELECT * FROM src s WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.id_titulo = s.id_titulo
  AND coalesce(h.data_atualizacao, {SENT}) = coalesce(s.data_atualizacao, {SENT}))""", T_PAIR)
    q["insert_absent"] = with_ctes(["titulos"], """
SELECT * FROM src s WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.id_titulo = s.id_titulo)""", T_PAIR)
    q["update_matched"] = with_ctes(["titulos"], _merge_sql(
        f"coalesce(t.data_atualizacao, {SENT}) <> coalesce(s.data_atualizacao, {SENT})", {}), T_PAIR)
    q["upsert"] = with_ctes(["titulos"], UPSERT_SQL, T_PAIR + [("changed", CHANGED)])
    q["fill_null_once"] = with_ctes(["titulos"], """
SELECT t.id_titulo, t.id_devedor, t.plano,
       CASE WHEN t.data_atualizacao IS NULL AND s.data_atualizacao IS NOT NULL THEN s.data_atualizacao
            ELSE t.data_atualizacao END AS data_atualizacao, t.situacao,
       CASE WHEN t.data_atualizacao IS NULL AND s.data_atualizacao IS NOT NULL THEN 'U' ELSE 'N' END AS acao
FROM held t LEFT JOIN src s ON t.id_titulo = s.id_titulo""", T_PAIR)
    q["fill_pair_once"] = with_ctes(["titulos"], """
SELECT t.id_titulo, t.id_devedor,
       CASE WHEN t.data_atualizacao IS NULL AND s.data_atualizacao IS NOT NULL THEN s.plano ELSE t.plano END AS plano,
       CASE WHEN t.data_atualizacao IS NULL AND s.data_atualizacao IS NOT NULL THEN s.data_atualizacao
            ELSE t.data_atualizacao END AS data_atualizacao, t.situacao,
       CASE WHEN t.data_atualizacao IS NULL AND s.data_atualizacao IS NOT NULL THEN 'U' ELSE 'N' END AS acao
FROM held t LEFT JOIN src s ON t.id_titulo = s.id_titulo""", T_PAIR)
    q["update_unless_equal"] = with_ctes(["titulos"], _merge_sql(
        "NOT coalesce(t.data_atualizacao = s.data_atualizacao, FALSE)", {}), T_PAIR)
    q["load_volumes"] = with_ctes(["titulos"], """
SELECT CAST((SELECT count(*) FROM changed) AS BIGINT) AS linhas_origem,
       CAST(count(CASE WHEN acao = 'I' THEN 1 END) AS BIGINT) AS linhas_inseridas,
       CAST(count(CASE WHEN acao = 'U' THEN 1 END) AS BIGINT) AS linhas_atualizadas,
       CAST(count(CASE WHEN acao IN ('I', 'U') THEN 1 END) AS BIGINT) AS linhas_totais_destino
FROM up""", T_PAIR + [("changed", CHANGED), ("up", UPSERT_SQL)])
    q["load_insert_only"] = with_ctes(["runs"], f"""
SELECT *, 'N' AS acao FROM held
UNION ALL
SELECT *, 'I' AS acao FROM stg s WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.event_id = s.event_id)""",
                                      [("held", "SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-10 00:00:00'"),
                                       ("stg", f"""
  SELECT * FROM events
  WHERE coalesce(CASE WHEN (SELECT max(event_id) FROM held) IS NOT NULL
                      THEN event_id > (SELECT max(event_id) FROM held)
                      ELSE ts >= CAST({PURCHASE_W} AS TIMESTAMP) OR {PURCHASE_W} IS NULL END, FALSE)""")])
    q["load_upsert"] = with_ctes(["titulos"], UPSERT_SQL, T_PAIR + [
        ("stg", f"""
  SELECT DISTINCT * FROM src
  WHERE id_titulo > (SELECT coalesce(max(id_titulo), 0) FROM held)
     OR coalesce(data_atualizacao >= TIMESTAMP '1997-07-01 00:00:00', FALSE)"""),
        ("changed", CHANGED.replace("FROM src s", "FROM stg s"))])
    q["load_parent_scoped"] = with_ctes(["acordos", "pagar", "negociadas"], """
SELECT *, 'N' AS acao FROM held
UNION ALL
SELECT *, 'I' AS acao FROM negociadas a
WHERE EXISTS (SELECT 1 FROM sc b WHERE a.id_acordo = b.id_acordo)
  AND NOT EXISTS (SELECT 1 FROM held h WHERE h.id_acordo = a.id_acordo)""", [
        ("held", f"""
  SELECT n.* FROM negociadas n
  WHERE EXISTS (SELECT 1 FROM acordos a WHERE a.id_acordo = n.id_acordo AND a.data_inclusao < {WTS})"""),
        ("sc", scope + f"""
  UNION ALL
  SELECT id_acordo FROM pagar WHERE data_pagamento = {PAY} OR data_vencimento BETWEEN {W} AND {C_DAY}""")])
    q["mailing_attach"] = with_ctes(SNAP_NAMES + ["mailing_target"], """
SELECT b.data, b.id_devedor, b.id_titulo, b.codigo_referencia, min(m.id_carteira) AS id_carteira,
       arg_min(m.id_retirada, m.id_carteira) AS id_retirada
FROM b360 b JOIN (SELECT m.*, c.codigo_referencia FROM mailing_target m
                  JOIN carteiras c ON m.id_carteira = c.id_carteira) m
  ON b.id_devedor = m.id_devedor AND b.codigo_referencia = m.codigo_referencia
WHERE b.data >= DATE '1998-09-01'
GROUP BY b.data, b.id_devedor, b.id_titulo, b.codigo_referencia""", _b360())
    q["mailing_returns"] = with_ctes(["parcelas", "titulos_carteira", "mailing_target"], """
SELECT id_carteira, id_devedor FROM (
  SELECT DISTINCT t.id_carteira, t.id_devedor FROM parcelas p JOIN titulos_carteira t ON p.id_titulo = t.id_titulo
  WHERE CAST(p.data_devolucao AS DATE) = DATE '1998-08-31') a
WHERE NOT EXISTS (SELECT 1 FROM parcelas p JOIN titulos_carteira t ON p.id_titulo = t.id_titulo
                  WHERE p.id_situacao_parcela = 'A' AND t.id_carteira = a.id_carteira AND t.id_devedor = a.id_devedor)
  AND EXISTS (SELECT 1 FROM mailing_target m WHERE m.id_retirada IS NULL AND m.id_carteira = a.id_carteira
              AND m.id_devedor = a.id_devedor)""")
    reasons = """
  SELECT CAST(t.id_carteira AS INTEGER) AS id_carteira, o.id_devedor, 'Colchão' AS complemento
  FROM ocorrencias_retorno o JOIN titulos_carteira t ON o.id_titulo = t.id_titulo
  WHERE CAST(o.data_ocorrencia AS DATE) = DATE '2024-01-14' AND o.id_tipo_ocorrencia = 350 AND t.id_produto = 9
  UNION
  SELECT CAST(NULL AS INTEGER), id_devedor, complemento FROM ocorrencias_retorno
  WHERE data_ocorrencia > TIMESTAMP '2024-01-14 00:00:00' AND id_tipo_ocorrencia = 350
  UNION
  SELECT CAST(NULL AS INTEGER), id_devedor, 'Remessa' FROM promessas
  WHERE data_vencimento > TIMESTAMP '2024-01-14 00:00:00'"""
    q["return_reasons"] = with_ctes(["ocorrencias_retorno", "titulos_carteira", "promessas"],
                                    "SELECT * FROM reasons", [("reasons", reasons)])
    q["mailing_flags"] = with_ctes(["ocorrencias_retorno", "titulos_carteira", "promessas", "mailing_target",
                                    "mailing_source"], """
SELECT m.id_carteira, m.id_devedor,
       CASE WHEN EXISTS (SELECT 1 FROM ret r WHERE coalesce(m.id_carteira, r.id_carteira) = r.id_carteira
                         AND m.id_devedor = r.id_devedor) THEN 1
            WHEN m.id_retirada IS NULL AND NOT EXISTS (
                 SELECT 1 FROM mailing_source s WHERE coalesce(m.id_carteira, s.id_carteira) = s.id_carteira
                   AND m.id_devedor = s.id_devedor) THEN 2
            ELSE m.id_retirada END AS id_retirada
FROM mailing_target m""", [("reasons", reasons), ("held", "SELECT * FROM mailing_target WHERE id_retirada IS NULL"),
                           ("ret", """
  SELECT r.id_carteira, r.id_devedor FROM reasons r
  WHERE (r.complemento IN ('Colchão', 'Remessa') OR r.complemento LIKE '%BAIXA PGTO DO / DT PGTO%')
    AND r.id_carteira IS NOT NULL AND EXISTS (SELECT 1 FROM held h WHERE h.id_carteira = r.id_carteira
                                                AND h.id_devedor = r.id_devedor)
  UNION ALL
  SELECT h.id_carteira, h.id_devedor FROM held h
  WHERE EXISTS (SELECT 1 FROM reasons r WHERE r.id_carteira IS NULL AND r.id_devedor = h.id_devedor
                  AND (r.complemento IN ('Colchão', 'Remessa') OR r.complemento LIKE '%BAIXA PGTO DO / DT PGTO%'))""")])
    q["mailing_returns_closed"] = with_ctes(["titulos_carteira", "mailing_target"], """
SELECT id_carteira, id_devedor FROM (
  SELECT DISTINCT t.id_carteira, t.id_devedor FROM lineitem l JOIN titulos_carteira t ON l.l_orderkey = t.id_titulo WHERE l.l_returnflag = 'R') a
WHERE (id_carteira, id_devedor) NOT IN (
  SELECT (t.id_carteira, t.id_devedor) FROM lineitem l JOIN titulos_carteira t ON l.l_orderkey = t.id_titulo WHERE l.l_linestatus = 'O' AND l.l_quantity > 48)
  AND EXISTS (SELECT 1 FROM mailing_target m WHERE m.id_retirada IS NULL AND m.id_carteira = a.id_carteira AND m.id_devedor = a.id_devedor)""")
    q["mailing_state"] = with_ctes(["ocorrencias_retorno", "titulos_carteira", "promessas", "mailing_target", "mailing_source"], """
SELECT id_carteira, id_devedor, id_retirada, CASE WHEN nova THEN 'I' WHEN volta OR saiu THEN 'U' ELSE 'N' END AS acao,
       nova OR id_retirada IS DISTINCT FROM antes AS mudou
FROM (SELECT *, CASE WHEN volta THEN 1 WHEN saiu THEN 2 ELSE antes END AS id_retirada FROM (
  SELECT *, NOT volta AND antes IS NULL AND NOT EXISTS (
    SELECT 1 FROM lista s WHERE coalesce(m.id_carteira, s.id_carteira) = s.id_carteira AND m.id_devedor = s.id_devedor) AS saiu
  FROM (SELECT *, EXISTS (SELECT 1 FROM ret r WHERE coalesce(x.id_carteira, r.id_carteira) = r.id_carteira AND x.id_devedor = r.id_devedor) AS volta FROM toda x) m))""",
                                   [("reasons", reasons), ("held", "SELECT * FROM mailing_target WHERE id_retirada IS NULL"),
                                    ("lista", "SELECT * FROM mailing_source WHERE id_carteira > 4"), ("toda", """
  SELECT id_carteira, id_devedor, id_retirada AS antes, FALSE AS nova FROM mailing_target
  UNION ALL SELECT CAST(s.id_carteira AS INTEGER), s.id_devedor, CAST(NULL AS INTEGER), TRUE FROM lista s
  WHERE NOT EXISTS (SELECT 1 FROM mailing_target m WHERE m.id_carteira = s.id_carteira AND m.id_devedor = s.id_devedor)"""), ("ret", """
  SELECT r.id_carteira, r.id_devedor FROM reasons r
  WHERE (r.complemento IN ('Colchão', 'Remessa') OR r.complemento LIKE '%BAIXA PGTO DO / DT PGTO%')
    AND EXISTS (SELECT 1 FROM held h WHERE h.id_carteira = r.id_carteira AND h.id_devedor = r.id_devedor)
  UNION ALL
  SELECT h.id_carteira, h.id_devedor FROM held h
  WHERE EXISTS (SELECT 1 FROM reasons r WHERE r.id_carteira IS NULL AND r.id_devedor = h.id_devedor
                  AND (r.complemento IN ('Colchão', 'Remessa') OR r.complemento LIKE '%BAIXA PGTO DO / DT PGTO%'))""")])
    flag_ctes = [("reasons", reasons), ("held", "SELECT * FROM mailing_target WHERE id_retirada IS NULL"),
                 ("ret", """
  SELECT r.id_carteira, r.id_devedor FROM reasons r
  WHERE (r.complemento IN ('Colchão', 'Remessa') OR r.complemento LIKE '%BAIXA PGTO DO / DT PGTO%')
    AND r.id_carteira IS NOT NULL AND EXISTS (SELECT 1 FROM held h WHERE h.id_carteira = r.id_carteira
                                                AND h.id_devedor = r.id_devedor)
  UNION ALL
  SELECT h.id_carteira, h.id_devedor FROM held h
  WHERE EXISTS (SELECT 1 FROM reasons r WHERE r.id_carteira IS NULL AND r.id_devedor = h.id_devedor
                  AND (r.complemento IN ('Colchão', 'Remessa') OR r.complemento LIKE '%BAIXA PGTO DO / DT PGTO%'))"""),
                 ("flagged", """
  SELECT m.id_carteira, m.id_devedor,
         CASE WHEN EXISTS (SELECT 1 FROM ret r WHERE coalesce(m.id_carteira, r.id_carteira) = r.id_carteira
                           AND m.id_devedor = r.id_devedor) THEN 1
              WHEN m.id_retirada IS NULL AND NOT EXISTS (
                   SELECT 1 FROM mailing_source s WHERE coalesce(m.id_carteira, s.id_carteira) = s.id_carteira
                     AND m.id_devedor = s.id_devedor) THEN 2
              ELSE m.id_retirada END AS id_retirada
  FROM mailing_target m"""),
                 ("earlier", """
  SELECT m.id_carteira, m.id_devedor, CAST(NULL AS INTEGER) AS id_retirada FROM mailing_target m
  WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = m.id_devedor AND c.c_mktsegment = 'HOUSEHOLD')""")]

    def attach(src):
        return f"""
  SELECT b.data, b.id_devedor, b.id_titulo, arg_min(m.id_retirada, m.id_carteira) AS id_retirada
  FROM b360 b JOIN (SELECT m.*, c.codigo_referencia FROM {src} m
                    JOIN carteiras c ON m.id_carteira = c.id_carteira) m
    ON b.id_devedor = m.id_devedor AND b.codigo_referencia = m.codigo_referencia
  WHERE b.data >= DATE '1998-09-01'
  GROUP BY b.data, b.id_devedor, b.id_titulo, b.codigo_referencia"""
    q["mailing_attach_apply"] = with_ctes(
        SNAP_NAMES + ["ocorrencias_retorno", "titulos_carteira", "promessas", "mailing_target", "mailing_source"], """
SELECT t.data, t.id_devedor, t.id_titulo,
       CASE WHEN s.id_devedor IS NOT NULL AND coalesce(t.id_retirada, 0) <> coalesce(s.id_retirada, 0)
            THEN s.id_retirada ELSE t.id_retirada END AS id_retirada,
       CASE WHEN s.id_devedor IS NOT NULL AND coalesce(t.id_retirada, 0) <> coalesce(s.id_retirada, 0)
            THEN 'U' ELSE 'N' END AS acao
FROM tgt t LEFT JOIN stg s ON t.data = s.data AND t.id_devedor = s.id_devedor AND t.id_titulo = s.id_titulo
UNION ALL
SELECT s.*, 'I' FROM stg s
WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.data = s.data AND t.id_devedor = s.id_devedor
                  AND t.id_titulo = s.id_titulo)""",
        _b360() + flag_ctes + [("tgt", attach("earlier")), ("stg", attach("flagged"))])
    q["mailing_run"] = with_ctes(["ocorrencias_retorno", "titulos_carteira", "promessas", "mailing_target",
                                  "mailing_source", "parcelas"], """
SELECT m.id_carteira, m.id_devedor,
       CASE WHEN EXISTS (SELECT 1 FROM ret r WHERE coalesce(m.id_carteira, r.id_carteira) = r.id_carteira
                         AND m.id_devedor = r.id_devedor) THEN 1
            WHEN m.id_retirada IS NULL AND NOT EXISTS (
                 SELECT 1 FROM mailing_source s WHERE coalesce(m.id_carteira, s.id_carteira) = s.id_carteira
                   AND m.id_devedor = s.id_devedor) THEN 2
            ELSE m.id_retirada END AS id_retirada
FROM allm m""", [("reasons", reasons), ("held", "SELECT * FROM mailing_target WHERE id_retirada IS NULL"),
                 ("ret", """
  SELECT id_carteira, id_devedor FROM (
    SELECT DISTINCT t.id_carteira, t.id_devedor FROM parcelas p JOIN titulos_carteira t ON p.id_titulo = t.id_titulo
    WHERE CAST(p.data_devolucao AS DATE) = DATE '2024-01-14') a
  WHERE NOT EXISTS (SELECT 1 FROM parcelas p JOIN titulos_carteira t ON p.id_titulo = t.id_titulo
                    WHERE p.id_situacao_parcela = 'A' AND t.id_carteira = a.id_carteira
                      AND t.id_devedor = a.id_devedor)
    AND EXISTS (SELECT 1 FROM held h WHERE h.id_carteira = a.id_carteira AND h.id_devedor = a.id_devedor)
  UNION ALL
  SELECT r.id_carteira, r.id_devedor FROM reasons r
  WHERE (r.complemento IN ('Colchão', 'Remessa') OR r.complemento LIKE '%BAIXA PGTO DO / DT PGTO%')
    AND EXISTS (SELECT 1 FROM held h WHERE h.id_carteira = r.id_carteira AND h.id_devedor = r.id_devedor)"""),
                 ("allm", """
  SELECT * FROM mailing_target
  UNION ALL
  SELECT s.id_carteira, s.id_devedor, CAST(NULL AS INTEGER) FROM (SELECT DISTINCT * FROM mailing_source) s
  WHERE NOT EXISTS (SELECT 1 FROM mailing_target m WHERE m.id_devedor = s.id_devedor
                    AND m.id_carteira = s.id_carteira)""")])
    crm_names = SNAP_NAMES + ["ocorrencias", "eventos", "tipos_ocorrencias", "tipos_eventos", "ligacoes", "usuarios"]
    q["crm_contacts"] = with_ctes(crm_names, f"""
SELECT s.* FROM crm s WHERE NOT EXISTS (
  SELECT 1 FROM crm t WHERE t.data < {E_TS} AND t.id_devedor = s.id_devedor AND t.id_titulo = s.id_titulo
    AND CAST(t.data AS DATE) = CAST(s.data AS DATE) AND t.data = s.data)""", crm_ctes())
    for name, digital in (("dialer_calls", False), ("digital_calls", True)):
        q[name] = with_ctes(SNAP_NAMES, f"""
SELECT s.* FROM staged s WHERE NOT EXISTS (
  SELECT 1 FROM staged t WHERE t.data < {E_TS} AND t.id_devedor = s.id_devedor AND t.id_titulo = s.id_titulo
    AND t.data = s.data)""", dialer_ctes(digital))
    hist = ("hist", "SELECT * REPLACE (CAST(data_vencimento AS DATE) AS data) FROM b360")
    q["payments_mart"] = with_ctes(SNAP_NAMES + STAR_NAMES, """
SELECT s.* EXCLUDE (data_hist) FROM staged s WHERE NOT EXISTS (
  SELECT 1 FROM staged t WHERE t.status_acordo = 'Quitado' AND t.id_devedor = s.id_devedor
    AND t.id_titulo = s.id_titulo AND t.data_hist = s.data_hist AND t.id_acordo = s.id_acordo
    AND t.numero_parcela = s.numero_parcela)""", _b360() + [hist, ("facts", STAR.format(
        cols=PAY_COLS, where="d.data_pagamento >= (SELECT min(data_pagamento) FROM pagar)")), ("staged", """
  SELECT f.*, h.data AS data_hist FROM facts f JOIN hist h ON f.id_devedor = h.id_devedor
    AND f.id_titulo = h.id_titulo AND f.data_pagamento = h.data
  WHERE h.data >= (SELECT min(data_pagamento) FROM pagar)""")])
    q["due_mart"] = with_ctes(SNAP_NAMES + STAR_NAMES, """
SELECT s.* FROM staged s WHERE NOT EXISTS (
  SELECT 1 FROM staged t WHERE t.status_acordo = 'Quitado' AND t.id_devedor = s.id_devedor
    AND t.id_titulo = s.id_titulo AND t.data_vencimento = s.data_vencimento AND t.id_acordo = s.id_acordo
    AND t.numero_parcela = s.numero_parcela)""", _b360() + [("facts", STAR.format(
        cols=DUE_COLS, where=f"d.data_vencimento = {C_DAY} OR CAST(a.data_cancelamento AS DATE) = {C_DAY}")),
        ("staged", f"""
  SELECT f.* FROM facts f JOIN b360 b ON f.id_devedor = b.id_devedor AND f.id_titulo = b.id_titulo
    AND f.data_vencimento = b.data
  WHERE b.data >= {C_DAY}""")])
    q["payments_new"] = with_ctes(SNAP_NAMES + STAR_NAMES, """
SELECT f.* FROM facts f JOIN b360 b ON f.id_devedor = b.id_devedor AND f.id_titulo = b.id_titulo
WHERE f.data_pagamento BETWEEN DATE '1998-06-01' AND DATE '1998-09-01'
  AND (f.id_acordo, f.numero_parcela, f.data_pagamento) NOT IN (
    SELECT (id_acordo, numero_parcela, data_pagamento) FROM facts WHERE data_pagamento < DATE '1998-08-01' AND proposta <> '5-LOW')""",
                                  _b360() + [("facts", STAR.format(cols=PAY_COLS, where="d.data_pagamento IS NOT NULL"))])
    one_due = """(SELECT id_acordo, numero_parcela, DATE '1998-09-01' AS data_vencimento, min(valor) AS valor
              FROM pagar GROUP BY 1, 2)"""
    q["due_state"] = with_ctes(SNAP_NAMES + STAR_NAMES, """
SELECT f.*, CASE WHEN proposta = '5-LOW' THEN 'I' WHEN data_cancelamento IS NOT NULL THEN 'U' ELSE 'N' END AS acao
FROM facts f JOIN b360 b ON f.id_devedor = b.id_devedor AND f.id_titulo = b.id_titulo""",
                               _b360() + [("facts", STAR.replace("JOIN pagar d", f"JOIN {one_due} d").format(cols=DUE_COLS, where="TRUE"))])
    due_ctes = _b360() + [("facts", STAR.format(
        cols=DUE_COLS, where=f"d.data_vencimento = {C_DAY} OR CAST(a.data_cancelamento AS DATE) = {C_DAY}")),
        ("staged", f"""
  SELECT f.* FROM facts f JOIN b360 b ON f.id_devedor = b.id_devedor AND f.id_titulo = b.id_titulo
    AND f.data_vencimento = b.data
  WHERE b.data >= {C_DAY}""")]
    q["due_cancellations"] = with_ctes(SNAP_NAMES + STAR_NAMES, """
SELECT s.* REPLACE (CASE WHEN s.data_cancelamento IS NOT NULL THEN s.data_cancelamento END AS data_cancelamento),
       CASE WHEN s.data_cancelamento IS NOT NULL THEN 'U' ELSE 'N' END AS acao
FROM staged s""", due_ctes)
    chan = """
  SELECT oc.id_acordo, arg_min(coalesce(l.id_origem_ligacao, 'H'), oc.id_ocorrencia) AS id_origem_acordo
  FROM ocorrencias oc LEFT JOIN ligacoes l ON oc.id_ligacao = l.id_ligacao
  WHERE oc.id_acordo IS NOT NULL {extra}
  GROUP BY oc.id_acordo"""
    q["agreement_channel"] = with_ctes(["ocorrencias", "ligacoes"], """
SELECT * FROM allc a WHERE NOT EXISTS (SELECT 1 FROM heldc h WHERE h.id_acordo = a.id_acordo)""",
                                       [("allc", chan.format(extra="")),
                                        ("heldc", chan.format(
                                            extra="AND oc.data_ocorrencia < TIMESTAMP '2024-01-10 00:00:00'"))])
    q["run_status"] = with_ctes(["runs"], """
SELECT CAST(id_execucao AS VARCHAR) AS id_execucao, nome_procedure, data_hora_inicio,
       CASE WHEN status_execucao <> 'Executando' THEN data_hora_fim END AS data_hora_fim,
       CAST(date_diff('second', data_hora_inicio,
                      CASE WHEN status_execucao <> 'Executando' THEN data_hora_fim END) AS DECIMAL(18,0))
         AS tempo_execucao_segundos,
       status_execucao
FROM runs""")
    q["purge_due"] = f"""
WITH config AS (SELECT DISTINCT * FROM ({PURGE.format(extra='''CASE WHEN event_type IN ('click', 'error') THEN '09:00:00'
                   WHEN event_type = 'purchase' THEN '12:00:00' ELSE '13:30:00' END AS hora_expurgo''')})),
done AS ({PURGE.format(extra='ts AS data_execucao')} WHERE value < 2 AND ts <= {E_TS})
SELECT c.id_tabela_expurgo, c.nome_tabela, c.hora_expurgo
FROM config c LEFT JOIN (SELECT DISTINCT id_tabela_expurgo, 1 AS executado FROM done
                         WHERE data_execucao >= TIMESTAMP '2024-01-15 00:00:00') d
  ON c.id_tabela_expurgo = d.id_tabela_expurgo
WHERE c.hora_expurgo <= '12:00:00' AND d.executado IS NULL"""
    return q


ORACLE = {**_oracle(), **LOADS_ORACLE}
