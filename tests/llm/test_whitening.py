"""Whitening: every exact step against exact brute force, the whole against numpy's eigenvectors."""
import random
from fractions import Fraction

import numpy as np
import pytest

from arrears.llm import whitening as w
from arrears.llm.queries import QUERIES
from tests.llm.conftest import SMALL, odd_vectors


def integers(vectors):
    return np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000


def spd(d, rank, seed, top=50):
    r = random.Random(seed)
    a = [[r.randint(-top, top) for _ in range(d)] for _ in range(rank)]
    return [[sum(v[i] * v[j] for v in a) for j in range(d)] for i in range(d)]


def leverrier(m):
    """Characteristic polynomial by the Faddeev-LeVerrier recurrence in fractions."""
    d = len(m)
    c, k = [Fraction(0)] * d + [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
    for n in range(1, d + 1):
        k = [[sum(m[i][x] * k[x][j] for x in range(d)) + (c[d - n + 1] if i == j else 0) for j in range(d)] for i in range(d)]
        c[d - n] = -sum(sum(m[i][x] * k[x][i] for x in range(d)) for i in range(d)) / n
    return [int(x) for x in c]


@pytest.mark.parametrize("d,rank,seed", [(1, 1, 0), (2, 2, 1), (5, 5, 2), (7, 3, 3), (12, 12, 4), (6, 1, 5)])
def test_polynomial(spark, d, rank, seed):
    m = spd(d, rank, seed)
    assert w.characteristic_polynomial(spark, m) == leverrier(m)


def test_polynomial_with_zero_columns_and_repeated_roots(spark):
    for m in ([[0, 0, 0], [0, 4, 0], [0, 0, 4]], [[2, 0, 0, 0], [0, 2, 0, 0], [0, 0, 2, 0], [0, 0, 0, 5]], [[10 ** 40, 1], [1, 10 ** 40]]):
        assert w.characteristic_polynomial(spark, m) == leverrier(m)


def test_roots_are_counted_with_multiplicity():
    poly = [1]
    for r in (0, 3, 3, 3, 7, 10 ** 30):
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0])]
    assert [w.above(poly, a) for a in (-1, 0, 2, 3, 6, 7, 10 ** 30 - 1, 10 ** 30)] == [6, 5, 5, 2, 2, 1, 1, 0]
    assert [w.root(poly, k, 10 ** 31) for k in range(1, 6)] == [(10 ** 30, 0, 1), (7, 1, 1), (3, 2, 3), (3, 2, 3), (3, 2, 3)]


@pytest.mark.parametrize("m", [spd(8, 8, 1), spd(8, 4, 2), [[4, 0, 0], [0, 4, 0], [0, 0, 9]], [[10 ** 20, 0], [0, 1]], [[2, 1], [1, 2]]])
def test_components_are_eigenvectors(spark, m):
    poly, a = leverrier(m), np.array(m, float)
    found = [w.component(m, poly, k) for k in range(1, 1 + len(m) - next(i for i, c in enumerate(poly) if c))]
    eigen = np.array([e for _, e in found]) * np.trace(a)
    v = np.array([x for x, _ in found]).T * np.sqrt(eigen)
    assert np.allclose(v.T @ v, np.eye(len(found)), atol=1e-14) and np.allclose(a @ v, v * eigen, rtol=1e-13, atol=1e-13 * np.trace(a))
    assert np.allclose(eigen, np.linalg.eigvalsh(a)[::-1][:len(found)], rtol=1e-9, atol=1e-9 * np.trace(a)) and list(eigen) == sorted(eigen, reverse=True)


@pytest.mark.parametrize("top", [50, 1 << 30, 1 << 61])
def test_gram_is_exact(top):
    r = np.random.default_rng(1)
    y = r.integers(-top, top, (300, 4))
    exact = y.astype(object)
    assert (w.gram(y) == exact.T @ exact).all()


def test_scatter_is_exact_for_huge_entries(spark):
    rows = [[float(x) for x in v] for v in ([1e18, -3.0, 0.1], [2.5e15, 1e30, 7.0], [-1e17, 2.0, -0.01])]
    n, sums, m = w.scatter(spark.createDataFrame([(v,) for v in rows], "v array<double>").repartition(3), "v", 3)
    y = [[max(-(1 << 62), min(1 << 62, int(np.floor(64 * x)))) for x in v] for v in rows]
    s = [sum(c) for c in zip(*y)]
    assert (n, sums) == (3, s) and m == [[3 * sum(v[i] * v[j] for v in y) - s[i] * s[j] for j in range(3)] for i in range(3)]


def test_query_against_eigenvectors(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    got = QUERIES["op12_whitening"](spark, SMALL).orderBy("vec_id", "component").collect()
    x = integers([r.embedding for r in rows])
    n, sums = len(x), x.sum(axis=0)
    e, v = np.linalg.eigh(np.cov(x.T, bias=True))
    e, v = e[::-1][:32], v[:, ::-1][:, :32]
    white = (x - sums / n) @ v / np.sqrt(e)
    mine = np.array([r.whitened for r in got]).reshape(n, 32)
    white *= np.sign((white * mine).sum(axis=0))
    assert np.abs(white - mine).max() < 1e-8
    assert [r.component for r in got[:32]] == list(range(1, 33)) and {r.n for r in got} == {n}
    assert np.allclose([r.explained for r in got[:32]], e / np.trace(np.cov(x.T, bias=True)), rtol=1e-9)
    assert [r.deviation for r in got[::32]] == [int(d) for d in ((n * x - sums) ** 2).sum(axis=1)]
    cov = np.cov(mine.T, bias=True) - np.eye(32)
    assert {r.identity_error for r in got} == {got[0].identity_error} and abs(got[0].identity_error - np.abs(cov).max()) < 1e-12 and got[0].identity_error < 1e-10


def test_odd_vectors(spark):
    df = odd_vectors(spark)
    model = w.fit(df)
    got = w.whitened(df, model).collect()
    assert model.n == 6 and model.dims == 3 and sorted({r.vec_id for r in got}, key=str) == [1, 10, 2, 9, None] and len(got) == 18
    assert model.identity_error < 1e-9
    x = integers([r.embedding for r in df.collect() if r.vec_id in (1, 2, 9, 10, None)])
    assert {r.deviation for r in got} == {int(d) for d in ((6 * x - x.sum(axis=0)) ** 2).sum(axis=1)}


@pytest.mark.parametrize("rows", [[], [[1.0, 2.0]], [[0.5, 0.5]] * 4, [None, None], [[], []]])
def test_no_component(spark, rows):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "vec_id int, embedding array<float>")
    out = w.whitened(df, w.fit(df))
    assert out.collect() == [] and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_constant_dimensions_and_ties(spark):
    df = spark.createDataFrame([(i, [float(i % 2), float(i // 2 % 2), 1.0, 0.0]) for i in range(4)], "vec_id int, embedding array<double>")
    model = w.fit(df)
    got = w.whitened(df, model).collect()
    assert model.explained == [0.5, 0.5] and len(got) == 8 and model.identity_error < 1e-14
    assert np.allclose(np.abs(model.weights[2:]), 0)


def test_deviation_beyond_a_long(spark):
    df = spark.createDataFrame([(0, [1e17, 0.0]), (1, [0.0, 1.0])], "vec_id int, embedding array<double>")
    assert {r.deviation for r in w.whitened(df, w.fit(df)).collect()} == {None}
