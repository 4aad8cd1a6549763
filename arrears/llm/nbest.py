"""SentencePiece encoding and decoding with N-best segmentation.

A text is a lattice whose edges are the model's pieces.  A forward Viterbi
pass gives every place the best score from the start; these are exact
heuristics for an A* search backward from the end, which therefore takes
complete segmentations off its heap in order of their score.

Scores are log-probabilities.  A unigram model brings its own; a BPE model's
"scores" are merge ranks, which must not be added up, so the pieces that it
itself uses for the whole corpus are counted in Spark and their smoothed
frequencies taken instead.

No piece runs on across the start of a word, so the lattice is a chain of
word lattices: each is searched once and kept, and the N best segmentations of a
text combine the best ones of the words that lose the least.  Both passes work
on the distinct words of a batch.  All N segmentations of a text are put together
and decoded, and what comes out is compared with the text.  A text without spaces is one word: time and
memory grow in proportion to its length.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import accumulate, chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.shingles import pieces

SPACE = "▁"
#: Words kept, in each of two generations; longer ones are not kept.
MOST_WORDS, LONGEST_KEPT = 400_000, 48
#: Scores are multiples of a part of this.
GRID = 1 << 20
#: So many ids are decoded together.
MOST_IDS = 1 << 20
_WORD = re.compile(rf"{SPACE}*[^{SPACE}]+|{SPACE}+")

Segmentation = tuple[float, tuple[int, ...]]  # score, piece ids
Word = tuple[bytes, float, float, bool]  # best ids, their score, what the second best loses, whether decoding gives the word again


def model_path(name: str) -> str:
    return public_tokenizers.path(name)


class Lattice:
    """Pieces and scores of a SentencePiece model, or other ``scores`` of its
    pieces.  Characters that no piece covers are spelled in byte pieces, at less
    than any piece's score each."""

    _open: dict[tuple, Lattice] = {}

    def __init__(self, path: str, scores: np.ndarray | None = None):
        p = sentencepiece.SentencePieceProcessor(model_file=path)
        n = p.get_piece_size()
        self.bytes = {int(p.id_to_piece(i)[1:-1], 16): i for i in range(n) if p.is_byte(i)}
        odd = lambda i: p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i)
        own = np.array([p.get_score(i) for i in range(n)]) if scores is None else scores
        # sums of these are exact, so that segmentations of equal score are seen to be equal; else a search looks at all of them
        own = (np.round(own * GRID) / GRID).tolist()
        self.score = {p.id_to_piece(i): (own[i], i) for i in range(n) if not odd(i)}
        self.longest = max(map(len, self.score))
        self.whole = {x: (s, (i,)) for x, (s, i) in self.score.items()}
        self.tree = self._tree()
        self.worst = min(s for s, _ in self.score.values()) - 10.0
        self.unknown = p.unk_id()
        self.by_word = not any(SPACE in x.lstrip(SPACE) for x in self.score)
        self.out = [bytes([int(p.id_to_piece(i)[1:-1], 16)]) if p.is_byte(i) else b"" if p.is_control(i) else p.id_to_piece(i).replace(SPACE, " ").encode() for i in range(n)]
        self.spelling = pa.array(self.out, pa.large_binary())
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}
        self.searched: dict[tuple[str, int], list[Segmentation]] = {}

    @classmethod
    def at(cls, path: str, scores: np.ndarray | None = None) -> Lattice:
        """One for each Python worker."""
        key = path, None if scores is None else scores.tobytes()
        if key not in cls._open:
            cls._open.clear()
            cls._open[key] = cls(path, scores)
        return cls._open[key]

    def _tree(self) -> dict[str, list]:
        """The pieces by their characters: a node is its next nodes (or None),
        and the score and ids of the piece that ends there (or None)."""
        root: list = [{}, None, None]
        for piece, (x, i) in self.score.items():
            node = root
            for c in piece:
                if node[0] is None:
                    node[0] = {}
                node = node[0].setdefault(c, [None, None, None])
            node[1:] = x, (i,)
        return root[0]

    def spelled(self, char: str) -> tuple[int, ...]:
        return tuple(self.bytes.get(b, self.unknown) for b in char.encode()) if self.bytes else (self.unknown,)

    def _forward(self, s: str) -> tuple[list[float], list[int], list[tuple[int, ...]], list[float]]:
        """For every place the best score from the start, the start and ids of
        its last piece (of equal scores that of smaller ids), and the score of
        the best one that ends in another piece."""
        tree, n, low = self.tree, len(s), float("-inf")
        best, second, back, last = [low] * (n + 1), [low] * (n + 1), [0] * (n + 1), [()] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here, j, node = best[i], i + 1, tree.get(s[i])
            if node is None or node[1] is None:
                ids = self.spelled(s[i])
                x = here + self.worst * len(ids)
                if x > best[j] or x == best[j] and ids < last[j]:
                    second[j], best[j], back[j], last[j] = best[j], x, i, ids
                elif x > second[j]:
                    second[j] = x
            while node is not None:
                following, x, ids = node
                if ids is not None:
                    x += here
                    top = best[j]
                    if x > top:
                        second[j] = top
                        best[j] = x
                        back[j] = i
                        last[j] = ids
                    elif x > second[j]:
                        if x == top and ids < last[j]:
                            back[j], last[j] = i, ids
                        second[j] = x
                if following is None or j == n:
                    break
                node = following.get(s[j])
                j += 1
        return best, back, last, second

    def _before(self, s: str, at: int) -> Iterator[tuple[int, float, tuple[int, ...]]]:
        """The pieces that end at a place: start, score, ids."""
        get = self.whole.get
        e = get(s[at - 1])
        if e:
            yield at - 1, *e
        else:
            ids = self.spelled(s[at - 1])
            yield at - 1, self.worst * len(ids), ids
        for i in range(at - 2, max(0, at - self.longest) - 1, -1):
            if e := get(s[i:at]):
                yield i, *e

    def search(self, s: str, n: int) -> list[Segmentation]:
        """The ``n`` best segmentations (fewer if there are fewer), best first;
        the first is that of ``word``.  Others of equal score come in the order
        in which the search meets them, the same in every run."""
        if (got := self.searched.get((s, n))) is not None:
            return got
        best, back, last, _ = self._forward(s)
        # a heap's entries point to the one that they continue; of equal scores the one nearest the start goes on
        heap: list[tuple] = [(-best[-1], len(s), 0, 0.0, (), None)]
        out, count = [], 0
        while heap and len(out) < n:
            entry = heapq.heappop(heap)
            at, after = entry[1], entry[3]
            if at == 0:
                out.append((-entry[0], self._ids(entry)))
                continue
            for i, x, ids in self._before(s, at):
                count += 1
                heapq.heappush(heap, (-(best[i] + x + after), i, count, x + after, ids, entry))
        first = self._traced(back, last)[0]
        out = [(best[-1], first), *((x, ids) for x, ids in out if ids != first)][:n]
        if len(s) <= LONGEST_KEPT:
            if len(self.searched) >= MOST_WORDS // 4:
                self.searched.clear()
            self.searched[s, n] = out
        return out

    @staticmethod
    def _ids(entry: tuple) -> tuple[int, ...]:
        out: list[int] = []
        while entry[5] is not None:
            out += entry[4]
            entry = entry[5]
        return tuple(out)

    @staticmethod
    def _traced(back: list[int], last: list[tuple[int, ...]]) -> tuple[tuple[int, ...], list[int]]:
        """The ids of the best segmentation, and the places where its pieces end, from the last."""
        at, path, places = len(back) - 1, [], []
        while at:
            path.append(last[at])
            places.append(at)
            at = back[at]
        path.reverse()
        return tuple([i for ids in path for i in ids]), places

    def word(self, s: str) -> Word:
        """Of one word: the best ids as 32-bit words, their score, what the
        second best loses (infinity without one), and whether decoding gives it
        again.

        The search's first result follows the best pieces from the end; its
        second leaves them once, where that costs the least.
        """
        got = self.young.get(s)
        if got is None:
            got = self.old.pop(s, None)
            if got is None:
                best, back, last, second = self._forward(s)
                at, path, least = len(s), [], float("inf")
                while at:
                    path.append(last[at])
                    if best[at] - second[at] < least:
                        least = best[at] - second[at]
                    at = back[at]
                ids = [i for own in reversed(path) for i in own]
                # pieces and bytes give their characters again
                got = (array("I", ids).tobytes(), best[-1], least, self.unknown not in ids)
            if len(s) <= LONGEST_KEPT:
                if len(self.young) >= MOST_WORDS:
                    self.young, self.old = {}, self.young
                self.young[s] = got
        return got

    def best(self, words: list[str]) -> list[Word]:
        return [x or self.word(w) for x, w in zip(map(self.young.get, words), words)]

    def words(self, text: str) -> list[str]:
        s = SPACE + text.replace(" ", SPACE) if text else ""
        return _WORD.findall(s) if self.by_word else [s] * bool(s)

    def encode(self, text: str, n: int = 1) -> list[Segmentation]:
        """The ``n`` best segmentations of a text, best first; an empty text
        has one, without pieces."""
        words = self.words(text)
        top = self.best(words)
        ids = [x[0] for x in top]
        total = sum(x[1] for x in top)
        if n == 1:
            return [(total, tuple(array("I", b"".join(ids))))]
        own, cuts = b"".join(ids), [0, *accumulate(map(len, ids))]
        return [(score, tuple(array("I", self._changed(own, cuts, change)))) for score, change in self._combined(np.array([x[2] for x in top]), words.__getitem__, total, n)]

    def _combined(self, losses: np.ndarray, word: Callable[[int], str], total: float, n: int) -> Iterator[tuple[float, list]]:
        """Scores of the ``n`` best combinations, and which words take which
        other ids, in the words' order.  Any of the n best changes none but the
        n - 1 words whose second best loses the least."""
        if 1 < n <= len(losses):
            near = np.flatnonzero(losses <= np.partition(losses, n - 2)[n - 2])
        else:
            near = np.arange(len(losses))
        least = [int(k) for k in near[np.argsort(losses[near], kind="stable")][:n - 1] if losses[k] < float("inf")]
        # a word's p-th segmentation loses no less than the second ones of the words before it and its own earlier ones
        found = [self.search(word(k), n - rank) for rank, k in enumerate(least)]
        loss = [[f[0][0] - x for x, _ in f] for f in found]
        heap, seen = [(0.0, (0,) * len(least))], {(0,) * len(least)}
        for _ in range(n):
            if not heap:
                return
            lost, pick = heapq.heappop(heap)
            yield total - lost, sorted((k, found[i][p][1]) for i, (k, p) in enumerate(zip(least, pick)) if p)
            for i in range(len(least)):
                if pick[i] + 1 < len(loss[i]):
                    nxt = (*pick[:i], pick[i] + 1, *pick[i + 1:])
                    if nxt not in seen:
                        seen.add(nxt)
                        heapq.heappush(heap, (sum(x[p] for x, p in zip(loss, nxt)), nxt))

    @staticmethod
    def _changed(own: bytes, cuts, change: list) -> bytes:
        """The best ids of a text, whose words begin at ``cuts``, with those of some words exchanged."""
        out, at = [], 0
        for k, ids in change:
            out += [own[at:cuts[k]], array("I", ids).tobytes()]
            at = cuts[k + 1]
        return b"".join([*out, own[at:]])

    def decoded(self, segmentations: list[bytes]) -> Iterator[bytes]:
        """The texts (in UTF-8) of piece ids as 32-bit words; the space before the first word goes."""
        got = self.spelling.take(pa.array(np.frombuffer(b"".join(segmentations), np.uint32)))
        ends = np.frombuffer(got.buffers()[1], np.int64)[got.offset:got.offset + len(got) + 1]
        data = got.buffers()[2].to_pybytes() if len(got) and got.buffers()[2] else b""
        at = ends[np.cumsum([0, *(len(x) // 4 for x in segmentations)])].tolist()
        for i, j in zip(at, at[1:]):
            yield data[i + 1:j] if data[i:i + 1] == b" " and i < j else data[i:j]

    def decode(self, ids) -> str:
        """The text of piece ids; the space before the first word goes."""
        text = b"".join(map(self.out.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def words_of(lattice: Lattice, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of texts (null as empty), the word of every place, and
    where each text begins (and the end)."""
    plain = pc.fill_null(texts.cast(pa.large_string()), "")
    signs = pc.match_substring(plain, SPACE)
    odd = pc.or_(pc.or_(pc.match_substring(plain, "  "), signs), pc.or_(pc.starts_with(plain, " "), pc.ends_with(plain, " ")))
    if not lattice.by_word or pc.any(pc.or_(odd, pc.equal(plain, ""))).as_py():
        lists = [lattice.words(t) for t in plain.to_pylist()]
        flat, ends, mark = pa.array(list(chain.from_iterable(lists)), pa.large_string()), np.cumsum([0, *map(len, lists)]), ""
    else:
        lists = pc.split_pattern(plain, " ")
        flat, ends, mark = lists.flatten(), np.asarray(lists.offsets), SPACE
        ends = ends - ends[0]
    coded = flat.dictionary_encode()
    words = pc.binary_join_element_wise(pa.scalar(mark, pa.large_string()), coded.dictionary, pa.scalar("", pa.large_string())) if mark else coded.dictionary
    return words.to_numpy(zero_copy_only=False).tolist(), np.asarray(coded.indices), ends


def _counter(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = sentencepiece.SentencePieceProcessor(model_file=model)
        counts, lattice = np.zeros(p.get_piece_size(), np.int64), Lattice.at(model)
        for whole in batches:
            for b in pieces(whole, "text", 16 << 20):  # the more text, the fewer words come again
                words, places, _ = words_of(lattice, b.column("text"))
                found = p.encode([w.replace(SPACE, " ").removeprefix(" ") for w in words], num_threads=1)
                sizes = np.fromiter(map(len, found), np.int64, len(found))
                ids = np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum()))
                times = np.repeat(np.bincount(places, minlength=len(words)), sizes)
                counts += np.bincount(ids, times, len(counts)).astype(np.int64)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())], ["piece", "n"])
    return run


def log_probabilities(docs: DataFrame, model: str, text_col: str = "text") -> np.ndarray:
    """A score for every piece: the model's own if they are log-probabilities,
    else those of its use in all texts, half a use added to each.  What reaches
    the driver is one row a piece.  An empty table gives equal scores."""
    p = sentencepiece.SentencePieceProcessor(model_file=model)
    n = p.get_piece_size()
    own = np.array([p.get_score(i) for i in range(n)])
    if not (own == np.round(own)).all():
        return own
    counts = np.full(n, 0.5)
    for r in docs.select(F.col(text_col).alias("text")).mapInArrow(_counter(model), "piece int, n bigint").groupBy("piece").agg(F.sum("n").alias("n")).collect():
        counts[r.piece] += r.n
    return np.log(counts / counts.sum())


def _encoder(model: str, scores: np.ndarray, n_best: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice.at(model, scores)
        for whole in batches:
            for b in pieces(whole, "text"):
                words, places, ends = words_of(lattice, b.column("text"))
                top = lattice.best(words)
                value, loss = np.array([x[1] for x in top]), np.array([x[2] for x in top])
                ids = pa.array([x[0] for x in top], pa.large_binary()).take(pa.array(places))
                cuts = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset:ids.offset + len(ids) + 1]
                data = memoryview(ids.buffers()[2]) if len(ids) and ids.buffers()[2] else memoryview(b"")
                size, crc, score, again, held, waiting = [], [], [], [], [], 0
                texts = iter(pc.fill_null(b.column("text").cast(pa.large_binary()), b""))
                for a, z in zip(ends[:-1].tolist(), ends[1:].tolist()):
                    here, at = places[a:z], cuts[a:z + 1] - cuts[a] if z > a else [0]
                    own = bytes(data[cuts[a]:cuts[z]]) if z > a else b""
                    best = list(lattice._combined(loss[here], lambda k: words[here[k]], float(value[here].sum()), n_best))
                    found = [lattice._changed(own, at, change) for _, change in best]
                    size.append([len(x) // 4 for x in found])
                    crc.append([zlib.crc32(x) for x in found])
                    score.append([s for s, _ in best])
                    held.append(found)
                    waiting += sum(size[-1])
                    if waiting >= MOST_IDS or len(size) == b.num_rows:
                        back = lattice.decoded(list(chain.from_iterable(held)))
                        again += [all([x == text for x in islice(back, len(found))]) for found, text in zip(held, (t.as_py() for t in islice(texts, len(held))))]
                        held, waiting = [], 0
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x[0] for x in size], pa.int64()), pa.array([x[0] for x in crc], pa.int64()),
                                                  pa.array(score, pa.list_(pa.float64())), pa.array(again, pa.bool_()), pa.array(size, pa.list_(pa.int64())), pa.array(crc, pa.list_(pa.int64()))],
                                                 ["doc_id", "n_pieces", "ids_crc32", "scores", "round_trip", "nbest_pieces", "nbest_crc32"])
    return run


def encoded(docs: DataFrame, model: str, n_best: int = 4, id_col: str = "doc_id", text_col: str = "text", scores: np.ndarray | None = None) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_pieces``, ``ids_crc32`` (of the
    best segmentation's ids as little-endian 32-bit integers), ``scores`` (of the
    up to ``n_best`` best, in order), ``round_trip`` (whether the text came out
    again when each of these segmentations was decoded, which fails for texts that
    hold the space sign itself), and ``nbest_pieces`` and ``nbest_crc32`` of each.
    ``scores`` of the pieces are ``log_probabilities`` of these texts unless given.

    A null text is encoded like an empty one: no pieces, one score of 0.
    Null ids and repeated rows give a row each, an empty table none; segmentations
    of equal score come in the same order in every run; other columns are not
    looked at.
    """
    scores = log_probabilities(docs, model, text_col) if scores is None else scores
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(_encoder(model, scores, n_best), "doc_id bigint, n_pieces bigint, ids_crc32 bigint, scores array<double>, round_trip boolean, nbest_pieces array<bigint>, nbest_crc32 array<bigint>")
