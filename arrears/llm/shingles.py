"""Word shingles of texts as 64-bit hashes, computed on whole Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_Q = np.uint64(0xC2B2AE3D27D4EB4F)
_SPAN = 1 << 20  # bytes hashed at a time


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(p: int, n: int) -> np.ndarray:
    a = np.full(n, p, np.uint64)
    a[:1] = 1
    return np.cumprod(a, dtype=np.uint64)


class Words:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of each text, with A-Z
    lower-cased; a null text has no words."""

    def __init__(self) -> None:
        self.up, self.down = _powers(_P, _SPAN), _powers(_P_INV, _SPAN)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The word hashes of all texts in order, and each text's first index
        in them (one more entry than texts)."""
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        inside = ~_SPACE[data]
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        cut = offsets[:-1][offsets[:-1] < len(data)]
        start[cut] = inside[cut]
        starts = np.flatnonzero(start)
        end = inside.copy()
        end[:-1] &= ~inside[1:]
        cut = offsets[1:][offsets[1:] > 0] - 1
        end[cut] = inside[cut]
        ends = np.flatnonzero(end) + 1
        out = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + _SPAN, "right")))
            lo, n = starts[i], int(ends[j - 1] - starts[i])
            if n > len(self.up):  # one word longer than the span
                self.up, self.down = _powers(_P, n), _powers(_P_INV, n)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((_LOWER[data[lo:lo + n]].astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
            s, e = starts[i:j] - lo, ends[i:j] - lo
            out[i:j] = (sums[e] - sums[s]) * self.down[s] + (e - s).astype(np.uint64)
            i = j
        return mix(out), np.searchsorted(starts, offsets)


def shingle_sets(words: Words, texts: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct ``k``-word shingles of each text; a text of fewer
    words has its whole sequence as its only one, a text without words none."""
    h, first = words(texts)
    g = np.zeros(max(0, len(h) - k + 1), np.uint64)
    for j in range(k):
        g = g * _Q + h[j:j + len(g)]
    g = mix(g)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= k:
            out.append(np.unique(g[a:b - k + 1]))
        else:
            x = np.uint64(0)
            for y in h[a:b]:
                x = np.uint64((int(x) * int(_Q) + int(y)) & 0xFFFFFFFFFFFFFFFF)
            out.append(mix(np.array([x + np.uint64(1)], np.uint64)) if b > a else np.zeros(0, np.uint64))
    return out


def pieces(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20):
    """Slices of a batch of about ``most_bytes`` of text each."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    group = (np.cumsum(size) - size) // most_bytes
    for g in np.unique(group):
        i = np.flatnonzero(group == g)
        yield batch.slice(int(i[0]), len(i))
