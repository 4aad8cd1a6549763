"""How five document filters interact, by a sparse document-term matrix.

Texts are cut into words ``[^\\x20\\x09-\\x0D]+``.  Each scan task fills
shards of a document-term matrix in compressed sparse row form (row starts,
columns, counts) under a dictionary of the shard's own words.  These words are
dealt by their hash and sorted; every distinct one gets the next number of all,
and the columns of each shard are rewritten to those numbers.  A row's sum is a document's number of words,
its number of stored entries that of its distinct words: filters A and B.
The other flags come from the text's bytes and its SHA-256.

A shard closes once it holds ``SHARD_BYTES`` of text; a text is never cut, so
a very long one makes a shard of its own size.  The matrix has a row for every
row of the table: null texts count as empty, and an empty table has no shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.common import Scratch
from arrears.llm.shingles import pieces

SHARD_BYTES = 8 << 20
#: Numbered words that a task gathers before it sends them to their shards.
_GATHERED = 1 << 20
FILTERS = "ABCDE"
_UPPER, _SYMBOL = np.zeros(256, bool), np.zeros(256, bool)
_UPPER[65:91] = True
_SYMBOL[list(b"#$%&*|")] = True

_CSR = "shard bigint, row_starts binary, columns binary, counts binary"
_ROW = {"doc_id": "bigint", "part": "string", "n_chars": "bigint", "n_upper": "bigint", "symbol": "boolean", "digest": "binary"}
_ROWS = ", ".join(f"{c} array<{t}>" for c, t in _ROW.items())
_NUMBERS = "range int, shard bigint, places binary, numbers binary, words array<string>, first bigint"
_ZSTD = pa.Codec("zstd")
_ARROW = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}


def packed(a: np.ndarray) -> bytes:
    """Integers as compressed differences."""
    steps = np.diff(a.astype(np.int64), prepend=0)
    narrow = not len(steps) or -(1 << 31) <= steps.min() and steps.max() < 1 << 31
    data = steps.astype(np.int32 if narrow else np.int64).tobytes()
    return len(a).to_bytes(8, "little") + bytes([int(narrow)]) + _ZSTD.compress(data, asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n, kind = int.from_bytes(data[:8], "little"), np.dtype(np.int32 if data[8] else np.int64)
    return np.cumsum(np.frombuffer(_ZSTD.decompress(data[9:], n * kind.itemsize, asbytes=True), kind), dtype=np.int64)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes one after another, and where each begins (and the end)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _per_text(hit: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(hit)
    return np.diff(np.searchsorted(at, offsets))


def _facts(texts: pa.Array) -> dict[str, pa.Array]:
    data, offsets = _bytes(texts)
    inner = _per_text((data & 0xC0) == 0x80, offsets)
    view = memoryview(data)
    return {"n_chars": pa.array(np.diff(offsets) - inner, pa.int64()), "n_upper": pa.array(_per_text(_UPPER[data], offsets), pa.int64()),
            "symbol": pa.array(_per_text(_SYMBOL[data], offsets) > 0),
            "digest": pa.array([hashlib.sha256(view[a:b]).digest() for a, b in zip(offsets.tolist(), offsets[1:].tolist())], pa.binary())}


def csr(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Row starts, columns (ascending within a row) and counts of the texts,
    and the words that the columns stand for."""
    lists = pc.ascii_split_whitespace(texts)
    words, rows = lists.flatten(), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(words), 0)
    coded = words.filter(full).dictionary_encode()
    rows = np.asarray(rows.filter(full)).astype(np.int64)
    n = max(1, len(coded.dictionary))
    cells, counts = np.unique(rows * n + np.asarray(coded.indices), return_counts=True)
    starts = np.searchsorted(cells, np.arange(len(texts) + 1, dtype=np.int64) * n)
    return starts, cells % n, counts, coded.dictionary


def _shard(k: int, kept: list[pa.RecordBatch]) -> pa.RecordBatch:
    t = pa.Table.from_batches(kept).combine_chunks()
    texts = pc.fill_null(t["text"].cast(pa.large_string()), "")
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    starts, columns, counts, words = csr(texts)
    facts = {"doc_id": t["doc_id"], "part": t["part"], **_facts(texts)}
    one = {"shard": pa.array([TaskContext.get().partitionId() << 32 | k], pa.int64()),
           **{c: pa.array([packed(a)], pa.binary()) for c, a in (("row_starts", starts), ("columns", columns), ("counts", counts))}}
    whole = lambda a, kind: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), (a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a).cast(kind))
    one |= {c: whole(facts[c], _ARROW[kind]) for c, kind in _ROW.items()}
    one["words"] = whole(words, pa.string())
    return pa.RecordBatch.from_pydict(one)


def _local_shards(shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size, k = [], 0, 0
        for whole in batches:
            for b in pieces(whole, "text", min(shard_bytes, 4 << 20)):
                kept.append(b)
                size += b.nbytes
                if size >= shard_bytes:
                    yield _shard(k, kept)
                    kept, size, k = [], 0, k + 1
        if kept:
            yield _shard(k, kept)
    return run


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of words in order, each with a shard and its place there: blocks of
    (places, numbers) for the shards, and the distinct words from ``first`` on.
    Numbers count from 0 in every task."""
    task, count, last, gathered, size = TaskContext.get().partitionId(), 0, None, [], 0
    names = [c.split()[0] for c in _NUMBERS.split(", ")]

    def rows(columns: list, words=None, first=None) -> pa.RecordBatch:
        n = len(columns[0]) if columns else 1
        shards, places, numbers = columns or ([None], [None], [None])
        return pa.RecordBatch.from_arrays([pa.array([task] * n, pa.int32()), pa.array(shards, pa.int64()), pa.array(places, pa.binary()), pa.array(numbers, pa.binary()),
                                           pa.array([words] * n, pa.list_(pa.string())), pa.array([first] * n, pa.int64())], names)

    def blocks() -> pa.RecordBatch:
        shard, place, number = (np.concatenate(x) for x in zip(*gathered))
        order = np.lexsort((place, shard))
        shard, place, number = shard[order], place[order], number[order]
        cuts = np.flatnonzero(np.diff(shard, prepend=shard[:1] - 1))
        ends = [*cuts[1:].tolist(), len(shard)]
        return rows([shard[cuts].tolist(), [packed(place[a:z]) for a, z in zip(cuts.tolist(), ends)], [packed(number[a:z]) for a, z in zip(cuts.tolist(), ends)]])

    for b in batches:
        words = b.column("word").cast(pa.large_string())
        if not len(words):
            continue
        new = np.ones(len(words), bool)
        new[1:] = np.asarray(pc.not_equal(words[1:], words[:-1]))
        new[0] = last is None or words[0].as_py() != last
        last = words[-1].as_py()
        fresh = words.filter(pa.array(new)).to_pylist()
        gathered.append((np.asarray(b.column("shard")), np.asarray(b.column("place")), count - 1 + np.cumsum(new)))
        if fresh:
            yield rows([], fresh, count)
        count, size = count + len(fresh), size + len(words)
        if size >= _GATHERED:
            yield blocks()
            gathered, size = [], 0
    if gathered:
        yield blocks()


def _globally(key, blocks: pa.Table, shard: pa.Table) -> pa.Table:
    """A shard's columns under the numbers of the global dictionary, each row's in ascending order."""
    if not len(shard):
        return pa.table({c: [] for c in _GLOBAL.names}, schema=_GLOBAL)
    starts, columns, counts = (unpacked(shard[c][0].as_py()) for c in ("row_starts", "columns", "counts"))
    ids = np.zeros(columns.max(initial=-1) + 1, np.int64)
    for places, numbers, start in zip(*(blocks[c].to_pylist() for c in ("places", "numbers", "start"))):
        ids[unpacked(places)] = start + unpacked(numbers)
    columns = ids[columns]
    order = np.lexsort((columns, np.repeat(np.arange(len(starts) - 1), np.diff(starts))))
    new = {"columns": pa.array([packed(columns[order])], pa.binary()), "counts": pa.array([packed(counts[order])], pa.binary())}
    return pa.table({c: new.get(c, shard[c].combine_chunks() if c in shard.column_names else None) for c in _GLOBAL.names}).cast(_GLOBAL)


_GLOBAL = pa.schema([("shard", pa.int64()), ("row_starts", pa.binary()), ("columns", pa.binary()), ("counts", pa.binary()),
                     *((c, pa.list_(_ARROW[t])) for c, t in _ROW.items())])


def document_terms(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
                   shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """The matrix: a table ``(word, word_id)`` of all distinct words, numbered
    from 0, and one of CSR shards, whose ``row_starts``, ``columns`` and
    ``counts`` are ``unpacked`` to integers, with the facts of their rows.

    A word comes once from each shard that has it, so no word is hotter than
    the number of shards.  Repeated rows and rows without an id are rows like
    others; columns besides the three named ones are not looked at."""
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).alias("text"))
    local = scratch.table(d.mapInArrow(_local_shards(shard_bytes), f"{_CSR}, {_ROWS}, words array<string>"), "local")
    entries = local.select("shard", F.posexplode("words").alias("place", "word")).repartition("word").sortWithinPartitions("word")
    numbered = scratch.table(entries.mapInArrow(_numbered, _NUMBERS), "numbers")
    distinct = numbered.where("words is not null").groupBy("range").agg(F.sum(F.size("words")).alias("n"))
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))  # one row a task
    starts = F.broadcast(distinct.select("range", F.coalesce(before, F.lit(0)).alias("start")))
    dictionary = (numbered.where("words is not null").join(starts, "range")
                  .select("first", "start", F.posexplode("words").alias("at", "word")).select("word", (F.col("start") + F.col("first") + F.col("at")).alias("word_id")))
    blocks = numbered.where("words is null").join(starts, "range").select(F.col("shard").alias("of"), "places", "numbers", "start")
    shards = blocks.groupBy("of").cogroup(local.drop("words").groupBy("shard")).applyInArrow(_globally, f"{_CSR}, {_ROWS}")
    shards = scratch.table(shards, "shards")
    scratch.drop("local")
    return dictionary, shards


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(b.num_rows):
            starts, counts = (unpacked(b.column(c)[k].as_py()) for c in ("row_starts", "counts"))
            total = np.concatenate(([0], np.cumsum(counts)))
            facts = {c: b.column(c)[k].values for c in _ROW}
            yield pa.RecordBatch.from_pydict(facts | {"n_words": pa.array(total[starts[1:]] - total[starts[:-1]]), "n_distinct": pa.array(np.diff(starts))})


def row_facts(shards: DataFrame) -> DataFrame:
    """One row per document: its facts, the row sum ``n_words`` and the number
    of stored entries ``n_distinct``."""
    return shards.mapInArrow(_sums, ", ".join(f"{c} {t}" for c, t in _ROW.items()) + ", n_words bigint, n_distinct bigint")


def failures(rows: DataFrame) -> DataFrame:
    """``part``, ``doc_id`` and ``mask``, whose bit k says that a document fails
    the k-th filter.

    E compares ids: of equal texts (SHA-256 of their bytes) all but those with
    the smallest id fail; a row without an id has no smaller one and is none.
    """
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    fails = ["n_words < 50", "100 * n_distinct < 65 * n_words", "100 * n_upper > 5 * n_chars", "symbol", "coalesce(doc_id > first_id, false)"]
    mask = sum((F.expr(f).cast("int") * (1 << k) for k, f in enumerate(fails)), F.lit(0))
    return rows.join(first, "digest", "left").select("part", "doc_id", mask.alias("mask"))


def interactions(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order of the filters and step, what that step keeps and removes.

    ``labels`` has ``doc_id, quality, toxic``; if an id is labelled more than
    once, any 1 counts, and null ids label nothing.  A part has at most 32
    masks, so its orders are worked out from those counts alone.  A filter's
    Shapley sum needs no order at all: with k other filters failing, it comes
    first among them in 120 / (k + 1) of the orders.
    """
    marks = labels.groupBy("doc_id").agg(*(F.max((F.col(c) == 1).cast("int")).alias(c) for c in ("quality", "toxic")))
    count = F.count(F.lit(1))
    masks = (failed.join(marks.where("doc_id is not null"), "doc_id", "left").groupBy("part", "mask")
             .agg(count.alias("n"), F.coalesce(F.sum("quality"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")))
    parts = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("m"))
    bit = {f: 1 << k for k, f in enumerate(FILTERS)}
    steps = [(o, s + 1, bit[f], sum(bit[x] for x in o[:s])) for o in map("".join, permutations(FILTERS)) for s, f in enumerate(o)]
    table = F.array(*(F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(own).alias("own"), F.lit(earlier).alias("earlier")) for o, s, own, earlier in steps))

    def total(value: str, where: str):
        return F.expr(f"aggregate(filter(m, x -> {where}), 0L, (s, x) -> s + {value})")

    removed = "(x.mask & own) <> 0 and (x.mask & earlier) = 0"
    return (parts.select("part", "m", F.explode(table).alias("s")).select("part", "m", "s.*").select(
        "part", "filter_order", "step",
        total("x.n", "(x.mask & (own | earlier)) = 0").alias("kept"), total("x.n", removed).alias("removed"),
        total("x.n", "(x.mask & own) <> 0 and (x.mask & earlier) <> 0").alias("redundant"), total("x.n", "x.mask = own").alias("unique_fails"),
        total("x.good", removed).alias("good_lost"), total("x.toxic", removed).alias("toxic_lost"),
        total("x.n * 120 div bit_count(x.mask)", "(x.mask & own) <> 0").alias("shapley")))


def audit(docs: DataFrame, labels: DataFrame, scratch: Scratch, **columns: str) -> DataFrame:
    """``interactions`` of all documents, by the document-term matrix."""
    _, shards = document_terms(docs, scratch, **columns)
    return interactions(failures(scratch.table(row_facts(shards), "rows")), labels)
