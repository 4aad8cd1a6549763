"""Packing token sequences: first-fit decreasing on a tournament tree.

Documents are dealt into randomised groups of bounded size; each group packs
by itself.  A document's full sequences are cut off first.  What remains of
each goes, longest first, into the first sequence with room, found by walking
down a tournament tree whose inner nodes hold the most room below them.  As
pieces may be cut freely, the emptiest sequences are then cut up to fill the
gaps of the others, so a group pads at most one sequence.
"""

from __future__ import annotations

import zlib
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.tokens import Encoder

CAPACITY = 2048
#: A group is about so many documents and so many characters.
GROUP_DOCS, GROUP_CHARS = 1024, 4 << 20
_SHIFT = 32  # a sequence's number is its group's, shifted, plus its place there

PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


class TournamentTree:
    """Room of ``n`` bins; ``place(size)`` takes it from the first that fits."""

    def __init__(self, n: int, capacity: int):
        self.leaves = 1 << max(0, n - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        room, i = self.room, 1
        if room[1] < size:
            raise ValueError("no bin has so much room")
        while i < self.leaves:
            i *= 2
            if room[i] < size:
                i += 1
        leaf = i
        room[i] -= size
        while i > 1:
            i >>= 1
            room[i] = max(room[2 * i], room[2 * i + 1])
        return leaf - self.leaves


def pack_group(lengths: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Bins of pieces ``(item, start, length)``, for items of given lengths."""
    bins, left = [], []
    for i, n in enumerate(lengths):
        full = n // capacity
        bins += [[(i, j * capacity, capacity)] for j in range(full)]
        if n % capacity:
            left.append((n % capacity, i, full * capacity))
    left.sort(key=lambda x: (-x[0], x[1]))
    tree = TournamentTree(len(left), capacity)
    open_: list[list[tuple[int, int, int]]] = []
    for n, i, start in left:
        at = tree.place(n)
        if at == len(open_):
            open_.append([])
        open_[at].append((i, start, n))
    return bins + _fill(open_, capacity)


def _fill(bins: list[list[tuple[int, int, int]]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Cuts up the emptiest bins to fill the others; the last may stay partly empty."""
    used = sorted(((sum(p[2] for p in b), k) for k, b in enumerate(bins)), reverse=True)
    order = [bins[k] for _, k in used]
    room = [capacity - n for n, _ in used]
    lo, hi = 0, len(order) - 1
    while lo < hi:
        if not room[lo]:
            lo += 1
        elif not order[hi]:
            hi -= 1
        else:
            i, start, n = order[hi].pop()
            take = min(n, room[lo])
            order[lo].append((i, start, take))
            room[lo] -= take
            if take < n:
                order[hi].append((i, start + take, n - take))
    return [b for b in order if b]


def _group(path: str, end_id: int, capacity: int):
    def run(t: pa.Table) -> pa.Table:
        encoder = Encoder.at(path)
        wide = np.dtype("<u4")
        docs = sorted(zip(t.column("doc_id").to_pylist(), t.column("text").to_pylist()), key=lambda d: (d[0] is None, d[0] or 0, d[1]))
        ids = [np.append(np.frombuffer(x, encoder.dtype), encoder.dtype.type(end_id)) for x in encoder.encode([x for _, x in docs])]
        out: dict[str, list] = {c.split()[0]: [] for c in PIECES.split(", ")}
        base = (t.column("grp")[0].as_py() << _SHIFT) if t.num_rows else 0
        for k, b in enumerate(pack_group([len(x) for x in ids], capacity)):
            offset = 0
            for i, start, n in b:
                row = (docs[i][0], start, n, zlib.crc32(ids[i][start:start + n].astype(wide).tobytes()), len(ids[i]), base + k, offset)
                for c, v in zip(out, row):
                    out[c].append(v)
                offset += n
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})
    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY,
         group_docs: int = GROUP_DOCS, group_chars: int = GROUP_CHARS,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece, columns ``PIECES``: where it starts in its document
    (whose ids end with ``end_id``), and its sequence and place there.

    A null text is packed like an empty one (just the end id); repeated rows
    and null ids are each packed as documents of their own.  A document longer
    than a group's target is a group's work by itself: its ids lie in one task
    as its text does.  An empty table gives an empty result; other columns are
    not looked at.  Rows are dealt by a hash of their place in the scan, so
    ``docs`` should be read from files, whose order a second attempt repeats.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = docs.agg(F.count("*").alias("n"), F.sum(F.length(text)).alias("chars")).first()
    groups = max(1, ceil(size.n / group_docs), ceil((size.chars or 0) / group_chars))
    dealt = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"),
                        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).alias("grp"))
    return dealt.groupBy("grp").applyInArrow(_group(tokenizer, end_id, capacity), PIECES)
