"""Near-duplicate documents by MinHash and a multi-index Hamming join.

Every document gets a b-bit MinHash signature (``SYMBOLS`` symbols of 16
bits).  Two signatures that differ in at most ``MOST_ERRORS`` symbols must, by
pigeonhole, agree on one of the ``CHUNKS`` chunks up to
``MOST_ERRORS // CHUNKS`` = 1 symbol.  So each chunk is indexed once for every
symbol left out, and every pair under the distance shares an index key; none
is lost.  A pair of Jaccard similarity 0.8 differs in 12.8 symbols on average
(sd 3.2), 24 or more in fewer than one case in a thousand.  Candidates are
then confirmed on the full shingle sets.

Equal sets are one class from the start.  Every class is first compared with
its home, the lowest class that heads one of its buckets (documents of one
key); only pairs still in different components are compared further.  So
thousands of near copies cost one link each, and no link between components
is lost: classes of one home are compared block by block within a task, which
gives out no more links than rows, and those of different homes as pairs.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.common import Scratch, connected_components
from arrears.llm.shingles import Words, mix, pieces, shingle_sets

SYMBOLS, CHUNKS, MOST_ERRORS = 64, 12, 23
#: Classes compared at a time within a home, and shingles.
BLOCK, COLUMNS = 256, 4096
PLANES = tuple(f"q{i}" for i in range(6))
_EDGES = np.linspace(0, SYMBOLS, CHUNKS + 1).round().astype(int)
_A = mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)
_B = mix(np.arange(1001, SYMBOLS + 1001, dtype=np.uint64)).astype(np.uint32)


def signature(s: np.ndarray) -> np.ndarray:
    """The lowest value of each hash function over a set, reduced to 16 bits."""
    low = np.full(SYMBOLS, 0xFFFFFFFF, np.uint32)
    h = (s >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(h), 4096):
        np.minimum(low, (h[i:i + 4096, None] * _A + _B).min(axis=0), out=low)
    return mix(low.astype(np.uint64)).astype(np.uint16)


def index_keys(sig: np.ndarray) -> np.ndarray:
    """For signatures (n, SYMBOLS), keys (n, SYMBOLS): column i stands for the
    chunk that holds symbol i, with that symbol left out."""
    spread = mix(sig.astype(np.uint64) + (np.arange(SYMBOLS, dtype=np.uint64) << np.uint64(20)))
    out = np.empty(spread.shape, np.uint64)
    for a, b in zip(_EDGES[:-1], _EDGES[1:]):
        whole = spread[:, a:b].sum(axis=1, dtype=np.uint64)
        for i in range(a, b):
            out[:, i] = whole - spread[:, i] + mix(np.array([i], np.uint64) + np.uint64(77))
    return mix(out).view(np.int64)


def _describe(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for whole in batches:
            for b in pieces(whole, "text"):
                sets = shingle_sets(words, b.column("text"), k)
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id"), b.column("thash"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                    ["doc_id", "thash", "n", "cls", "sig"])
    return run


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint16).reshape(-1, SYMBOLS)
            yield pa.RecordBatch.from_arrays([pa.array(index_keys(sig).ravel()), pa.array(np.repeat(np.asarray(b.column("cid")), SYMBOLS))], ["key", "cid"])


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for whole in batches:
            for b in pieces(whole, "text"):
                got = [(c, s.tobytes()) for c, want, s in zip(b.column("cid").to_pylist(), b.column("cls").to_pylist(), shingle_sets(words, b.column("text"), k))
                       if hashlib.blake2b(s.tobytes(), digest_size=16).digest() == want]
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in got], pa.int64()), pa.array([s for _, s in got], pa.binary())], ["cid", "shingles"])
    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = np.zeros(b.num_rows, bool)
            for i, (x, y) in enumerate(zip(b.column("x"), b.column("y"))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = (x, y) if len(x) < len(y) else (y, x)
                at = np.searchsorted(large, small)
                shared = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                ok[i] = 100 * shared >= percent * (len(x) + len(y) - shared)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(ok)], ["a", "b", "ok"])
    return run


def linked(sets: list[np.ndarray], part: np.ndarray, comp: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join different components, no more than a forest of them:
    between the rows of two parts, or among those of one."""
    n, size = len(sets), np.array([len(s) for s in sets])
    shared = np.zeros((n, n), np.float32)
    token, row = np.unique(np.concatenate(sets), return_inverse=True)[1], np.repeat(np.arange(n), size)
    often = np.bincount(token)
    rank = np.cumsum(often > 1) - 1  # shingles of one row only are shared with none
    token, row = rank[token[often[token] > 1]], row[often[token] > 1]
    order = np.argsort(token, kind="stable")
    token, row = token[order], row[order]
    for lo in range(0, int(token[-1]) + 1 if len(token) else 0, COLUMNS):
        x, y = np.searchsorted(token, (lo, lo + COLUMNS))
        m = np.zeros((n, COLUMNS), np.float32)
        m[row[x:y], token[x:y] - lo] = 1
        shared += m @ m.T
    near = 100 * shared >= percent * (size[:, None] + size[None, :] - shared)
    if part.min() != part.max():
        near &= part[:, None] != part[None, :]
    root = {int(c): int(c) for c in comp}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    out = []
    for a, b in np.argwhere(np.triu(near, 1) & (comp[:, None] != comp[None, :])).tolist():
        if (x := find(int(comp[a]))) != (y := find(int(comp[b]))):
            root[x] = y
            out.append((a, b))
    return out


def _blocks(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for key, row in itertools.chain(_keyed(batches), [(None, None)]):
            if key != at and rows:
                cid, comp, part = (np.array([r[k] for r in rows]) for k in range(3))
                links = linked([np.frombuffer(r[3], np.uint64) for r in rows], part, comp, percent)
                yield pa.RecordBatch.from_arrays([pa.array([int(cid[x[k]]) for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])
                rows = []
            at = key
            rows.append(row)
    return run


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, tuple]]:
    for b in batches:
        yield from zip(zip(*(b.column(c).to_pylist() for c in ("home", "i", "j"))), zip(*(b.column(c).to_pylist() for c in ("cid", "comp", "part", "shingles"))))


def _near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes allow the similarity and whose signatures, seen
    through some bits of each symbol, differ in no more than MOST_ERRORS."""
    side = lambda s: classes.select(F.col("cid").alias(s), *(F.col(c).alias(f"{s}_{c}") for c in ("n", *PLANES)))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(_close("a_", "b_", percent)).select("a", "b")


def _close(p: str, q: str, percent: int):
    apart = F.bit_count(F.expr(" | ".join(f"({p}{x} ^ {q}{x})" for x in PLANES)))
    least, most = F.least(f"{p}n", f"{q}n"), F.greatest(f"{p}n", f"{q}n")
    return (100 * least >= percent * most) & (apart <= MOST_ERRORS)


def _planes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the lowest bits of every symbol as 64-bit words, a word for each bit."""
    for b in batches:
        sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint16).reshape(-1, SYMBOLS) if b.num_rows else np.zeros((0, SYMBOLS), np.uint16)
        bits = [np.packbits((sig >> i & 1).astype(np.uint8), axis=1).view(np.int64).ravel() for i in range(len(PLANES))]
        yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, bits)], [*b.schema.names, *PLANES])


def near_duplicates(docs: DataFrame, scratch: Scratch, shingle_words: int = 5, percent: int = 80,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, thash, n_shingles, component_id,
    kept, leader``.

    Rows are linked when the Jaccard similarity of their sets of distinct
    ``shingle_words``-word shingles is at least ``percent``; ``component_id``
    is the smallest id reachable.  ``kept`` says that the row's id is that
    one; ``leader`` that the row is of the one (id, text) that stands for its
    component also where ids repeat.  ``thash`` is xxhash64 of the text.
    A null or wordless text has an empty set and is linked with nothing.  A
    null id is larger than all others; a component of null ids has a null
    ``component_id``.  Repeated rows are one class.  An empty table gives an
    empty result; other columns are not looked at.
    """
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    d = d.withColumn("thash", F.xxhash64("text"))
    rows = scratch.table(d.mapInArrow(_describe(shingle_words), "doc_id bigint, thash bigint, n bigint, cls binary, sig binary"), "rows")
    # one row for each different set; the row that stands for it has the smallest id
    classes = (rows.where("n > 0").groupBy("cls", "n").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"))
               .withColumn("cid", F.monotonically_increasing_id()))
    classes = scratch.table(classes.mapInArrow(_planes, "cls binary, n bigint, rep bigint, sig binary, cid bigint, " + ", ".join(f"{x} bigint" for x in PLANES)), "classes")
    keys = classes.select("cid", "sig").mapInArrow(_index, "key bigint, cid bigint")
    shared = scratch.table(keys.groupBy("key").agg(F.count("*").alias("m"), F.min("cid").alias("low")).where("m > 1").select("key", "low"), "shared")
    buckets = scratch.table(keys.join(shared, "key"), "buckets")
    slim = classes.drop("sig")
    # null ids meet under one key; the class's digest then tells their texts apart
    used = buckets.select("cid").distinct().join(classes.select("cid", "cls", F.coalesce("rep", F.lit(2**63 - 1)).alias("k")), "cid")
    text = d.withColumn("k", F.coalesce("doc_id", F.lit(2**63 - 1))).join(used, "k").dropDuplicates(["k", "cid", "thash"])
    sets = scratch.table(text.select("cid", "cls", "text").mapInArrow(_sets(shingle_words), "cid bigint, shingles binary"), "sets")

    def confirmed(pairs: DataFrame, label: str) -> DataFrame:
        x = pairs.join(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("y")), "b")
        x = x.join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("x")), "a").select("a", "b", "x", "y")
        return scratch.table(x.mapInArrow(_confirm(percent), "a bigint, b bigint, ok boolean"), label)

    # a class's home is the lowest class that heads one of its buckets
    homes = scratch.table(buckets.groupBy("cid").agg(F.min("low").alias("home")), "homes")
    first = confirmed(_near(homes.where("cid <> home").select(F.col("home").alias("a"), F.col("cid").alias("b")), slim, percent), "links-1")
    comp = connected_components(first.where("ok"), scratch, "cc-1").withColumnRenamed("node", "cid")
    homes = homes.join(comp, "cid", "left").select("cid", "home", F.coalesce("component", "cid").alias("comp"))
    # what is left: pairs that are still in different components, of one home ...
    sizes = homes.groupBy("home").agg(F.count("*").alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    parts = F.ceil(F.col("m") / BLOCK).cast("int")
    mine = homes.join(sizes, "home").select("cid", "comp", "home", parts.alias("parts"), F.pmod(F.xxhash64("cid"), parts).cast("int").alias("part"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    mine = mine.select("*", other.alias("other")).select("cid", "comp", "home", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    mine = mine.join(sets, "cid").repartition("home", "i", "j").sortWithinPartitions("home", "i", "j", "cid")
    second = scratch.table(mine.mapInArrow(_blocks(percent), "a bigint, b bigint"), "links-2")
    # ... and of one bucket but different homes
    member = buckets.select("key", "cid").join(homes, "cid")
    open_ = member.groupBy("key").agg(F.min("home").alias("h"), F.max("home").alias("h2"), F.min("comp").alias("c"), F.max("comp").alias("c2")).where("h <> h2 and c <> c2").select("key")
    member = scratch.table(member.join(scratch.table(open_, "open"), "key"), "open-buckets")
    shape = slim.select("cid", "n", *PLANES).join(member.groupBy("cid").agg(F.collect_list("key").alias("keys")), "cid")
    member = scratch.table(member.join(shape, "cid"), "members")
    a, b = (member.select("key", *(F.col(c).alias(f"{s}_{c}") for c in ("cid", "home", "comp", "n", "keys", *PLANES))) for s in "ab")
    # a pair that shares several keys is made in the bucket of the lowest only
    rest = a.join(b, "key").where((F.col("a_comp") < F.col("b_comp")) & (F.col("a_home") != F.col("b_home")) & _close("a_", "b_", percent)
                                  & (F.col("key") == F.array_min(F.array_intersect("a_keys", "b_keys"))))
    third = confirmed(rest.select(F.col("a_cid").alias("a"), F.col("b_cid").alias("b")), "links-3")
    links = first.where("ok").drop("ok").unionByName(second).unionByName(third.where("ok").drop("ok"))
    comp = connected_components(links, scratch, "cc-2")
    for name in ("shared", "buckets", "homes", "sets", "members", "open", "open-buckets"):
        scratch.drop(name)
    # back to rows: the smallest id of each component, then of each set
    of = slim.join(comp.withColumnRenamed("node", "cid"), "cid", "left").select("cls", "n", "rep", F.coalesce("component", "cid").alias("comp"))
    best = of.groupBy("comp").agg(F.min(F.struct(F.col("rep").isNull().alias("no_id"), "rep", "cls")).alias("best"))
    of = of.join(best, "comp").select("cls", "n", F.col("best.rep").alias("component_id"), F.col("best.cls").alias("best"))
    return rows.drop("sig").join(of, ["cls", "n"], "left").select(
        "doc_id", "thash", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        ((F.col("n") == 0) | F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"),
        ((F.col("n") == 0) | (F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("cls") == F.col("best")))).alias("leader"))


def without_near_duplicates(docs: DataFrame, scratch: Scratch, shingle_words: int = 5, percent: int = 80,
                            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their component: the one of the
    smallest id, once if it is repeated.  Null and wordless texts all stay.
    Columns pass through, whatever their names."""
    near = near_duplicates(docs, scratch, shingle_words, percent, id_col, text_col)
    no_id = F.lit(-(2**63))
    stay = near.where("leader").select(F.coalesce("doc_id", no_id).alias("__id"), F.col("thash").alias("__hash"), (F.col("n_shingles") == 0).alias("__empty")).distinct()
    d = docs.select(F.struct("*").alias("__row"), F.coalesce(F.col(id_col).cast("bigint"), no_id).alias("__id"), F.xxhash64(text_col).alias("__hash"))
    first = F.row_number().over(Window.partitionBy("__id", "__hash").orderBy("__id"))
    return (d.join(stay, ["__id", "__hash"]).withColumn("__n", first).where("__empty or __n = 1")
            .select(*(F.col("__row")[c].alias(c) for c in docs.columns)))
