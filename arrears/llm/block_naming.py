"""Exact dedup by deterministic block naming.

A text, without its white space, is cut into fixed-size blocks.  All blocks
are sorted and every distinct block gets an integer name; then adjacent
names of a document are paired, the pairs sorted and named in turn, and so on
until one name is left.  Two documents get the same last name in the same
round exactly when their texts are equal: names come from sorted content,
never from a hash, so there are no collisions.

Each sort is a range exchange on (content, row), so the copies of a hot block
spread over several partitions; only the first and last key of each
partition (two blocks a partition) reach the driver, to join up a name that
runs over a partition's edge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import Scratch

BLOCK_CHARS = 2048
#: The white space that does not count, as a Java pattern.
SPACE = r"[\x20\x09-\x0D]+"
_SHIFT = 40  # a name is the partition's number, shifted, plus the key's rank there


def _ranked(keys: list[str], carry: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, rank, lo, last = TaskContext.get().partitionId() << _SHIFT, -1, None, None
        schema = None
        for b in batches:
            if not b.num_rows:
                continue
            new = np.zeros(b.num_rows, bool)
            for k in keys:
                c = b.column(k)
                same = pc.fill_null(pc.equal(c[1:], c[:-1]), False)
                both = pc.and_(pc.is_null(c[1:]), pc.is_null(c[:-1]))
                new[1:] |= ~np.asarray(pc.or_(same, both))
            first = tuple(b.column(k)[0].as_py() for k in keys)
            new[0] = rank < 0 or first != last
            lo = first if rank < 0 else lo
            names = rank + np.cumsum(new)
            rank, last = int(names[-1]), tuple(b.column(k)[-1].as_py() for k in keys)
            cols = {c: b.column(c) for c in carry} | {"name": pa.array(base + names)}
            for k in keys:
                cols |= {f"lo_{k}": pa.nulls(b.num_rows, b.column(k).type), f"hi_{k}": pa.nulls(b.num_rows, b.column(k).type)}
            cols["edge"] = pa.array(np.zeros(b.num_rows, bool))
            out = pa.RecordBatch.from_pydict(cols)
            schema = out.schema
            yield out
        if schema is not None:  # one row more: what lies at the partition's edges
            row = {c: None for c in carry} | {"name": base + rank, "edge": True}
            for k, x, y in zip(keys, lo, last):
                row |= {f"lo_{k}": x, f"hi_{k}": y}
            yield pa.RecordBatch.from_pydict({f.name: pa.array([row[f.name]], f.type) for f in schema}, schema=schema)
    return run


def sorted_names(df: DataFrame, keys: list[str], order: list[str], carry: list[str], scratch: Scratch, label: str) -> DataFrame:
    """``carry`` columns plus ``name``: equal keys have equal integer names,
    different keys different ones.  ``order`` makes the sort total."""
    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in carry), "name bigint",
                        *(f"lo_{k} {kinds[k]}, hi_{k} {kinds[k]}" for k in keys), "edge boolean"])
    dealt = df.select(*keys, *order, *[c for c in carry if c not in order]).repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    t = scratch.table(dealt.mapInArrow(_ranked(keys, carry), schema), label)
    edges = sorted(t.where("edge").select("name", *(f"{s}_{k}" for k in keys for s in ("lo", "hi"))).collect())
    renamed, before, name = [], None, None
    for r in edges:
        lo, hi = tuple(r[f"lo_{k}"] for k in keys), tuple(r[f"hi_{k}"] for k in keys)
        first = r["name"] >> _SHIFT << _SHIFT
        if before is not None and lo == before:
            renamed.append((first, name))
            name = name if r["name"] == first else r["name"]
        else:
            name = r["name"]
        before = hi
    t = t.where("not edge").select(*carry, "name")
    if not renamed:
        return t
    # one row for each partition at most
    again = F.broadcast(df.sparkSession.createDataFrame(renamed, "name bigint, to bigint"))
    return t.join(again, "name", "left").select(*carry, F.coalesce("to", "name").alias("name"))


def exact_groups(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept,
    text_sha256, n_chars``.

    Of equal texts the row with the most code points stays, then the one with
    the smallest id, then (repeated rows) the first read.  A null text counts
    as empty and all empty texts are equal; a null id sorts after all others.
    An empty table gives an empty result; other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("bigint").alias("doc_id"),
                    F.length(text).cast("bigint").alias("n_chars"), F.regexp_replace(text, SPACE, "").alias("norm"))
    blocks = F.regexp_extract_all("norm", F.lit("(?s).{1,%d}" % block_chars), F.lit(0))
    d = d.select("rid", F.struct("doc_id", "n_chars", F.sha2("norm", 256).alias("sha")).alias("meta"), blocks.alias("blocks"))
    d = d.select("rid", F.size("blocks").alias("n"), "meta", F.posexplode_outer("blocks").alias("pos", "block"))
    d = d.select("rid", F.coalesce("pos", F.lit(0)).alias("pos"), "block", "n",
                 F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("meta")).alias("meta"))
    named = sorted_names(d, ["block"], ["rid", "pos"], ["rid", "pos", "n", "meta"], scratch, "round-0")
    meta = named.where("pos = 0").select("rid", "meta.*", "n")
    level, done, i = named.select("rid", "pos", "n", "name"), [], 0
    longest = level.agg(F.max("n").alias("n")).first().n or 0
    while True:
        done.append(level.where("n <= 1").select("rid", F.lit(i).alias("round"), "name"))
        if longest <= 1:
            break
        pairs = (level.where("n > 1").groupBy("rid", F.expr("pos div 2").cast("int").alias("pos"))
                 .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
                      F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("right"), F.max("n").alias("n"))
                 .select("rid", "pos", "left", "right", F.expr("cast((n + 1) div 2 as int)").alias("n")))
        i, longest = i + 1, (longest + 1) // 2
        level = sorted_names(pairs, ["left", "right"], ["rid", "pos"], ["rid", "pos", "n"], scratch, f"round-{i}")
    identity = done[0]
    for x in done[1:]:
        identity = identity.unionByName(x)
    # of the first round, the texts without blocks share the null block's name
    rows = scratch.table(meta.drop("n").join(identity, "rid"), "identity")
    best = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid"))
    groups = rows.groupBy("round", "name").agg(best.alias("best"), F.count("*").alias("group_size"))
    return rows.join(groups, ["round", "name"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("rid") == F.col("best.rid")).alias("kept"),
        F.col("sha").alias("text_sha256"), "n_chars")
