"""Property tests: random small tables against a plain-Python model of the
reference's rules (sentinel version compare, insert absent, update changed,
NULL-wildcard match)."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from arrears.operators import merge as mg

D = [None, dt.datetime(1900, 1, 1), dt.datetime(2026, 8, 1), dt.datetime(2026, 8, 2)]
S = "k long, v timestamp_ntz, x string"
SENT = dt.datetime(1900, 1, 1)

rows = st.dictionaries(st.integers(0, 12), st.tuples(st.sampled_from(D), st.sampled_from(["a", "b", None])),
                       max_size=10)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def _df(spark, d):
    return spark.createDataFrame([(k, v, x) for k, (v, x) in d.items()], S)


def _same(a, b):
    return (a if a is not None else SENT) == (b if b is not None else SENT)


@SETTINGS
@given(target=rows, staged=rows)
def test_upsert_matches_model(spark, target, staged):
    got = {r.k: (r.v, r.x, r.acao) for r in
           mg.upsert(_df(spark, target), _df(spark, staged), "k", ["v"], ["v", "x"], mark=True).collect()}
    exp = {}
    for k in set(target) | set(staged):
        if k not in target:
            exp[k] = (*staged[k], "I")
        elif k in staged and not _same(target[k][0], staged[k][0]):
            exp[k] = (*staged[k], "U")
        else:
            exp[k] = (*target[k], "N")
    assert got == exp


@SETTINGS
@given(target=rows, staged=rows)
def test_drop_unchanged_matches_model(spark, target, staged):
    got = sorted(r.k for r in mg.drop_unchanged(_df(spark, staged), _df(spark, target), "k", ["v"]).collect())
    exp = sorted(k for k, (v, _) in staged.items() if not (k in target and _same(target[k][0], v)))
    assert got == exp


pairs = st.lists(st.tuples(st.sampled_from([None, 1, 2, 3]), st.integers(0, 6)), max_size=12)


@SETTINGS
@given(target=pairs, staged=pairs)
def test_wildcard_matches_model(spark, target, staged):
    t = spark.createDataFrame(target, "c int, d long")
    s = spark.createDataFrame(staged, "c int, d long")
    got = sorted(((-1 if r.c is None else r.c), r.d) for r in mg.wildcard_semi(t, s, "d", "c").collect())
    # isnull(t.c, s.c) = s.c and t.d = s.d  (a NULL staged portfolio never matches)
    exp = sorted(((-1 if c is None else c), d) for c, d in target
                 if any(sd == d and sc is not None and (c is None or c == sc) for sc, sd in staged))
    assert got == exp
    marked = {((-1 if r.c is None else r.c), r.d, r._hit) for r in mg.wildcard_marker(t, s, "d", "c").collect()}
    assert {(c, d) for c, d, h in marked if h} == set(exp)


runs_st = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 47), st.sampled_from(["Concluida", "Erro", "Executando"])),
                   min_size=0, max_size=12)


@SETTINGS
@given(runs=runs_st)
def test_watermarks_match_model(spark, runs):
    from arrears.operators import incremental as inc
    base = dt.datetime(2026, 8, 14)
    data = [(i, f"J{j}", base + dt.timedelta(hours=h), s) for i, (j, h, s) in enumerate(runs)]
    df = spark.createDataFrame(data, "id_execucao long, nome_procedure string, data_hora_inicio timestamp_ntz, "
                                     "status_execucao string")
    fwd = {r.nome_procedure: r.watermark for r in inc.watermark_forward(df).collect()}
    bwd = {r.nome_procedure: r.watermark for r in inc.watermark_backward(df).collect()}
    pen = {r.nome_procedure: r.watermark for r in inc.watermark_penultimate(df).collect()}
    done = {}
    for i, j, ts, s in data:
        if s == "Concluida":
            done.setdefault(j, []).append((i, ts))

    def fwd_of(ts):
        return ts.date() + dt.timedelta(days=1 if ts.hour >= 22 else 0)

    assert fwd == {j: fwd_of(max(t for _, t in v)) for j, v in done.items()}
    assert bwd == {j: max(t for _, t in v).date() - dt.timedelta(days=2 if max(t for _, t in v).hour >= 22 else 1)
                   for j, v in done.items()}
    exp_pen = {}
    for j, v in done.items():
        earlier = sorted((t, i) for i, t in v)[:-1]
        if earlier:
            exp_pen[j] = fwd_of(earlier[-1][0])
    assert pen == exp_pen


snap_rows = st.dictionaries(st.integers(0, 8), st.tuples(st.integers(0, 3), st.sampled_from([None, 1, 2])),
                            max_size=8)


@SETTINGS
@given(today=snap_rows, staged=snap_rows, flagged=st.sets(st.integers(0, 8)))
def test_base360_apply_matches_model(spark, today, staged, flagged):
    """Base360 rules: insert absent, update when a compared column differs
    (NULL counts as 0), flag today's rows missing from the snapshot."""
    from decimal import Decimal as Dec

    from arrears.plans import snapshot
    day = dt.date(2026, 8, 17)
    cols = ("id_base long, data date, id_devedor long, id_titulo long, plano int, numero_parcela int, "
            "data_inclusao timestamp_ntz, dias_em_atraso int, risco decimal(19,4), saldo_vencido decimal(19,4), "
            "valor_regularizacao decimal(19,4), id_retirada int")

    def row(k, num, risco, ret=None):
        return (k, day, 1, k, 1, num, None, 0, None if risco is None else Dec(risco), None, None, ret)

    t = spark.createDataFrame([row(k, n, r, 1 if k in flagged else None) for k, (n, r) in today.items()], cols)
    s = spark.createDataFrame([row(k, n, r) for k, (n, r) in staged.items()], cols)
    got = {r.id_titulo: (r.acao, r.numero_parcela, r.id_retirada)
           for r in snapshot.base360_apply(t, s.drop("id_retirada"), dt.datetime(2026, 8, 17, 9)).collect()}
    exp = {}
    for k in set(today) | set(staged):
        ret = 1 if k in flagged else None
        if k not in today:
            exp[k] = ("I", staged[k][0], None)
        elif k not in staged:
            exp[k] = ("R", today[k][0], 1) if ret is None else ("N", today[k][0], ret)
        elif (today[k][0] or 0) != (staged[k][0] or 0) or (today[k][1] or 0) != (staged[k][1] or 0):
            exp[k] = ("U", staged[k][0], ret)
        else:
            exp[k] = ("N", today[k][0], ret)
    assert got == exp


pay = st.dictionaries(st.integers(0, 10), st.tuples(st.sampled_from([None, dt.date(2026, 8, 1), dt.date(2026, 8, 2)]),
                                                    st.sampled_from([None, 5, 7])), max_size=8)


@SETTINGS
@given(target=pay, staged=pay)
def test_fill_once_load_matches_model(spark, target, staged):
    """C1 (sentinel version compare) + K3 + C5 (the pair, while the date is NULL)."""
    schema = "k long, d date, v int"
    t = spark.createDataFrame([(k, d, v) for k, (d, v) in target.items()], schema)
    s = spark.createDataFrame([(k, d, v) for k, (d, v) in staged.items()], schema)
    got = {r.k: (r.d, r.v, r.acao) for r in mg.upsert(t, s, "k", ["d"], ["d", "v"], mark=True,
                                                       fill_only=True).collect()}
    sent = dt.date(1900, 1, 1)
    exp = {}
    for k in set(target) | set(staged):
        if k not in target:
            exp[k] = (*staged[k], "I")
            continue
        td, tv = target[k]
        if k in staged and (td or sent) != (staged[k][0] or sent):
            sd, sv = staged[k]
            exp[k] = (sd, sv, "U") if td is None and sd is not None else (td, tv, "N")
        else:
            exp[k] = (td, tv, "N")
    assert got == exp
