"""Embedding whitening from the exact characteristic polynomial of the scatter.

Every entry c of a vector becomes the integer x = floor(64 c) + 1000000, so
the scatter n * sum(x x') - S S' is a matrix of integers, n^2 times the
covariance.  Spark sums it exactly.  Its characteristic polynomial comes from
Hessenberg reductions modulo many 31-bit primes, which Spark's tasks share,
and the Chinese remainder theorem.  Its roots are real and none is negative,
so by Descartes' rule the sign changes of p(z + a) are exactly the number of
roots above a: every root is isolated by halving, in integers, to ``_BITS``
binary places of the trace.  Inverse iteration in integers of the same
precision then finds the null space of scatter - root * identity.  A task
finds the root and the unit vector of one component.

What reaches the driver is bounded by the square of the number of dimensions;
the work on it grows with about their fourth power, which suits some hundreds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
_BITS = 256
#: Larger entries count as this.
_MOST = 1 << 62
_LIMB = 20
_ROWS = 4096

_CELLS = "i int, j int, high decimal(38,0), low decimal(38,0)"
_OUT = [("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())]


@dataclass
class Whitening:
    """A fitted map.  ``sums`` are those of floor(64 c); ``weights`` (dimension
    by component) take n * x - S to whitened values."""

    n: int = 0
    dims: int = 0
    sums: list = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    explained: list = field(default_factory=list)
    identity_error: float = 0.0


# integers of vectors

def _usable(vec_col: str):
    finite = F.forall(vec_col, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")))
    return F.col(vec_col).isNotNull() & finite


def _blocks(batch: pa.RecordBatch, dims: int, column: int) -> Iterator[tuple[slice, np.ndarray]]:
    """floor(64 c) of some rows at a time, as 64-bit integers."""
    values = np.asarray(batch.column(column).flatten()).astype(np.float64).reshape(-1, dims)
    for a in range(0, len(values), _ROWS):
        scaled = np.floor(np.clip(values[a:a + _ROWS] * SCALE, -float(_MOST), float(_MOST)))
        yield slice(a, a + len(scaled)), scaled.astype(np.int64)


def gram(y: np.ndarray) -> np.ndarray:
    """y'y as Python integers: by limbs whose products doubles hold exactly."""
    top, limbs, rest = int(np.abs(y).max(initial=0)), [], y
    if top * top * max(1, len(y)) < 1 << 53:
        limbs = [y]
    else:
        for _ in range(3):
            limbs.append(rest & ((1 << _LIMB) - 1))
            rest = rest >> _LIMB
        limbs.append(rest)
    limbs = [x.astype(np.float64) for x in limbs]
    out = np.zeros((y.shape[1], y.shape[1]), object)
    for a, x in enumerate(limbs):
        for b, z in enumerate(limbs):
            out = out + ((x.T @ z).astype(np.int64).astype(object) << (_LIMB * (a + b)))
    return out


def _partial(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cells = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for b in batches:
            for _, y in _blocks(b, dims, 0):
                n += len(y)
                sums = sums + np.array([int(s) for s in (y >> 31).sum(axis=0)], object) * (1 << 31) + (y & ((1 << 31) - 1)).sum(axis=0).astype(object)
                cells = cells + gram(y)
        if not n:
            return
        at = [(-1, -1, n), *((i, -1, s) for i, s in enumerate(sums)), *((i, j, cells[i, j]) for i in range(dims) for j in range(i, dims))]
        parts = [divmod(int(v), 1 << 60) for _, _, v in at]
        number = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _, _ in at], pa.int32()), pa.array([j for _, j, _ in at], pa.int32()),
                                          pa.array([Decimal(h) for h, _ in parts], number), pa.array([Decimal(x) for _, x in parts], number)], ["i", "j", "high", "low"])
    return run


def scatter(vectors: DataFrame, vec_col: str, dims: int) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums and n * sum(y y') - S S' of all vectors, y = floor(64 c);
    each task sends one row per entry, which Spark adds up."""
    sums = (vectors.select(vec_col).mapInArrow(_partial(dims), _CELLS).groupBy("i", "j")
            .agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect())
    cell = {(r.i, r.j): int(r.high) * (1 << 60) + int(r.low) for r in sums}
    n = cell.get((-1, -1), 0)
    s = [cell.get((i, -1), 0) for i in range(dims)]
    return n, s, [[n * cell.get((min(i, j), max(i, j)), 0) - s[i] * s[j] for j in range(dims)] for i in range(dims)]


# the characteristic polynomial

def primes(most_bits: int) -> list[int]:
    """Primes below 2^31, falling, whose product has more than ``most_bits`` bits."""
    def prime(n: int) -> bool:
        odd, twos = n - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for a in (2, 3, 5, 7):  # enough below 3.2e9
            x = pow(a, odd, n)
            if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
                return False
        return True
    found, bits, n = [], 0.0, (1 << 31) - 1
    while bits <= most_bits:
        if prime(n):
            found.append(n)
            bits += math.log2(n)
        n -= 2
    return found


def polynomials(matrix: list[list[int]], moduli: list[int]) -> np.ndarray:
    """Characteristic polynomials modulo primes, lowest coefficient first: by
    similarity to Hessenberg form, all primes at once."""
    d, p = len(matrix), np.array(moduli, np.int64)
    col, mat = p[:, None], p[:, None, None]
    a = np.array([[[x % q for x in row] for row in matrix] for q in moduli], np.int64).reshape(len(p), d, d)
    every = np.arange(len(p))
    for k in range(d - 2):
        pivot = k + 1 + np.argmax(a[:, k + 1:, k] != 0, axis=1)
        rows = a[every, pivot].copy()
        a[every, pivot] = a[:, k + 1]
        a[:, k + 1] = rows
        cols = a[every, :, pivot].copy()
        a[every, :, pivot] = a[:, :, k + 1]
        a[:, :, k + 1] = cols
        inverse = np.array([pow(int(x), q - 2, q) if x else 0 for x, q in zip(a[:, k + 1, k], moduli)], np.int64)
        m = a[:, k + 2:, k] * inverse[:, None] % col
        a[:, k + 2:] = (a[:, k + 2:] - m[:, :, None] * a[:, k + 1][:, None, :] % mat) % mat
        a[:, :, k + 1] = (a[:, :, k + 1] + (a[:, :, k + 2:] * m[:, None, :] % mat).sum(axis=2)) % col
    poly = [np.ones((len(p), 1), np.int64)]
    for k in range(d):
        new = np.zeros((len(p), k + 2), np.int64)
        new[:, 1:] = poly[k]
        new[:, :-1] = (new[:, :-1] - a[:, k, k][:, None] * poly[k] % col) % col
        below = np.ones(len(p), np.int64)
        for i in range(k - 1, -1, -1):
            below = below * a[:, i + 1, i] % p
            new[:, :i + 1] = (new[:, :i + 1] - (below * a[:, i, k] % p)[:, None] * poly[i] % col) % col
        poly.append(new)
    return poly[d]


def _residues(matrix: list[list[int]]):
    chunk = max(1, (1 << 20) // len(matrix) ** 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            moduli = b.column(0).to_pylist()
            for k in range(0, len(moduli), chunk):
                found = polynomials(matrix, moduli[k:k + chunk])
                yield pa.RecordBatch.from_arrays([pa.array(moduli[k:k + chunk], pa.int64()), pa.array(found.tolist(), pa.list_(pa.int64()))], ["p", "c"])
    return run


def _dealt(spark: SparkSession, numbers: list[int]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in numbers], "k bigint").repartition(min(len(numbers), max(8, spark.sparkContext.defaultParallelism)))


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """The integer coefficients, lowest first, for a matrix without negative
    roots: their sizes are at most those of (z + trace / d)^d."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    bound = max(math.comb(d, k) * trace ** k // d ** k + 1 for k in range(d + 1))
    moduli = primes((2 * bound).bit_length())
    product, total = math.prod(moduli), [0] * (d + 1)
    for r in _dealt(spark, moduli).mapInArrow(_residues(matrix), "p bigint, c array<bigint>").collect():
        rest = product // r.p
        unit = rest * pow(rest, -1, r.p)
        total = [t + c * unit for t, c in zip(total, r.c)]
    return [(t + product // 2) % product - product // 2 for t in total]


# roots and vectors

def above(poly: list[int], a: int) -> int:
    """How many roots of a real-rooted polynomial lie above ``a``."""
    c = list(poly)
    for k in range(len(c) - 1):
        for i in range(len(c) - 2, k - 1, -1):
            c[i] += a * c[i + 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def root(poly: list[int], k: int, most: int) -> tuple[int, int, int]:
    """The least integer z that at least the k-th largest root doesn't exceed
    (the root lies in (z - 1, z]), the number of roots above z and of those in
    that interval.  ``most`` is above all roots."""
    low, high, over_low, over_high = 0, most, len(poly) - 1, 0
    while high - low > 1:
        mid = (low + high) // 2
        if over_low - over_high == 1:  # a simple root: its side shows in the sign
            value = 0
            for c in reversed(poly):
                value = value * mid + c
            over = over_high if value == 0 or (value > 0) == (over_high % 2 == 0) else over_low
        else:
            over = above(poly, mid)
        if over >= k:
            low, over_low = mid, over
        else:
            high, over_high = mid, over
    return high, over_high, over_low - over_high


def null_vectors(matrix: list[list[int]], count: int, bits: int) -> list[list[int]]:
    """``count`` orthonormal vectors, in units of 2^-bits, that span the space
    which an almost singular integer matrix takes to almost nothing."""
    d, one = len(matrix), 1 << bits
    a, steps = [list(r) for r in matrix], []
    for k in range(d):
        best = max(range(k, d), key=lambda r: abs(a[r][k]))
        a[k], a[best] = a[best], a[k]
        a[k][k] = a[k][k] or 1
        top, factors = a[k], []
        for r in range(k + 1, d):
            f = (a[r][k] << bits) // top[k]
            factors.append(f)
            if f:
                a[r] = [0] * (k + 1) + [x - (f * t >> bits) for x, t in zip(a[r][k + 1:], top[k + 1:])]
        steps.append((best, factors))

    def solved(b: list[int]) -> list[int]:
        b = list(b)
        for k, (best, factors) in enumerate(steps):
            b[k], b[best] = b[best], b[k]
            for r, f in enumerate(factors, k + 1):
                b[r] -= f * b[k] >> bits
        for k in range(d - 1, -1, -1):
            rest = (b[k] << bits) - sum(a[k][j] * b[j] for j in range(k + 1, d))
            b[k] = rest // a[k][k]
        return b

    def unit(v: list[int], others: list[list[int]]) -> list[int]:
        for _ in range(2):
            size = math.isqrt(sum(x * x for x in v)) or 1
            v = [(x << bits) // size for x in v]
            for o in others:
                dot = sum(x * y for x, y in zip(v, o)) >> bits
                v = [x - (dot * y >> bits) for x, y in zip(v, o)]
        size = math.isqrt(sum(x * x for x in v)) or 1
        return [(x << bits) // size for x in v]

    found: list[list[int]] = []
    for k in range(count):
        v = [one * (1 + (i + 1) * (k + 2) * 7919 % 101) for i in range(d)]
        for _ in range(3):
            v = unit(solved(unit(v, found)), found)
        found.append(v)
    return found


def component(matrix: list[list[int]], poly: list[int], k: int) -> tuple[list[float], float]:
    """Weights (unit eigenvector over the root's square root) and share of the
    trace of the k-th component, a positive one."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    places = max(0, _BITS - trace.bit_length())
    zeros = next(i for i, c in enumerate(poly) if c)
    rest = poly[zeros:]
    fine = [c << places * (len(rest) - 1 - i) for i, c in enumerate(rest)]
    z, over, same = root(fine, k, (trace << places) + 1)
    near = [[(x << places) - (z if i == j else 0) for j, x in enumerate(row)] for i, row in enumerate(matrix)]
    bits = _BITS + 64
    v = null_vectors(near, same, bits)[k - over - 1]
    size = math.isqrt(z << 2 * bits - places)
    return [x / size for x in v], z / (trace << places)


def _components(matrix: list[list[int]], poly: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ks = b.column(0).to_pylist()
            found = [component(matrix, poly, k) for k in ks]
            yield pa.RecordBatch.from_arrays([pa.array(ks, pa.int64()), pa.array([w for w, _ in found], pa.list_(pa.float64())), pa.array([e for _, e in found], pa.float64())], ["k", "w", "e"])
    return run


# fitting and applying

def _centred(y: np.ndarray, model: Whitening) -> np.ndarray:
    """n * x - S, exact."""
    top = model.n * int(np.abs(y).max(initial=0)) + max((abs(s) for s in model.sums), default=0)
    if top < 1 << 62:
        return y * model.n - np.array(model.sums, np.int64)
    return y.astype(object) * model.n - np.array(model.sums, object)


def _deviations(z: np.ndarray) -> list[int | None]:
    top = max((abs(int(x)) for x in (z.min(initial=0), z.max(initial=0))), default=0)
    if top * top * max(1, z.shape[1]) < 1 << 63:
        return (z.astype(np.int64) ** 2).sum(axis=1).tolist()
    return [s if s < 1 << 63 else None for s in (z.astype(object) ** 2).sum(axis=1)]


def _moments(model: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = model.weights.shape[1]
        sums, cells = np.zeros(k), np.zeros((k, k))
        for b in batches:
            for _, y in _blocks(b, model.dims, 0):
                w = _centred(y, model).astype(np.float64) @ model.weights
                sums += w.sum(axis=0)
                cells += w.T @ w
        at = [*((i, -1, sums[i]) for i in range(k)), *((i, j, cells[i, j]) for i in range(k) for j in range(i, k))]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in at], pa.int32()), pa.array([x[1] for x in at], pa.int32()), pa.array([float(x[2]) for x in at], pa.float64())], ["i", "j", "v"])
    return run


def usable(vectors: DataFrame, vec_col: str) -> DataFrame:
    """The rows whose vector is neither null nor holds null or non-finite entries."""
    return vectors.where(_usable(vec_col))


def fit(vectors: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """The whitening of all usable vectors.

    Vectors of another length than the most common one (the least of those
    that tie) are left out like unusable ones.  Entries beyond 2^62 / 64 count
    as that.  Components with eigenvalue zero are none: constant vectors, a
    single one or an empty table give no component.  Of equal eigenvalues any
    orthonormal vectors serve, the same ones in every run.
    """
    spark = vectors.sparkSession
    rows = usable(vectors.select(vec_col), vec_col)
    length = rows.groupBy(F.size(vec_col).alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if not length or not length.dims:
        return Whitening()
    rows = rows.where(F.size(vec_col) == length.dims)
    n, sums, matrix = scatter(rows, vec_col, length.dims)
    model = Whitening(n, length.dims, sums, np.zeros((length.dims, 0)))
    if not any(matrix[i][i] for i in range(length.dims)):
        return model
    poly = characteristic_polynomial(spark, matrix)
    positive = length.dims - next(i for i, c in enumerate(poly) if c)
    got = sorted(_dealt(spark, list(range(1, min(components, positive) + 1))).mapInArrow(_components(matrix, poly), "k bigint, w array<double>, e double").collect())
    model.weights, model.explained = np.array([r.w for r in got]).T, [r.e for r in got]
    moments = {(r.i, r.j): r.v for r in rows.mapInArrow(_moments(model), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    mean = [moments[i, -1] / n for i in range(len(got))]
    model.identity_error = float(max(abs(moments[i, j] / n - mean[i] * mean[j] - (i == j)) for i in range(len(got)) for j in range(i, len(got))))
    return model


def whitened(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """A row per usable vector and component: the id, ``component`` from 1,
    ``n``, ``deviation`` (null where it exceeds a long), ``whitened``,
    ``explained`` and ``identity_error``.  Repeated rows and null ids are rows
    like others; other columns are not looked at."""
    k = model.weights.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, y in _blocks(b, model.dims, 1):
                z = _centred(y, model)
                white, rows = z.astype(np.float64) @ model.weights, len(y)
                cols = [np.tile(np.arange(1, k + 1), rows), np.full(rows * k, model.n), None, white.ravel(), np.tile(model.explained, rows), np.full(rows * k, model.identity_error)]
                each = pa.array(np.repeat(np.arange(rows), k))
                cols[2] = pa.array(_deviations(z), pa.int64()).take(each)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(part.start, rows).take(each), *(c if isinstance(c, pa.Array) else pa.array(c, t) for c, (_, t) in zip(cols, _OUT))],
                                                 [id_col, *(c for c, _ in _OUT)])

    kind = vectors.select(id_col).schema[0].dataType.simpleString()
    out = f"`{id_col}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = usable(vectors.select(id_col, vec_col), vec_col).where(F.size(vec_col) == model.dims)
    return (rows if k else rows.limit(0)).mapInArrow(run, out)
