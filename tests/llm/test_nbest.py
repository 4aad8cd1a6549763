"""Segmentations against the library's own on a unigram model trained here, the scores of a BPE model, and long words."""
import os
import subprocess
import sys
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from arrears.llm import nbest
from tests.llm.conftest import SMALL

BPE = nbest.model_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def unigram(small, tmp_path_factory):
    """A small unigram model of the driver's texts (trained in the test only)."""
    d = tmp_path_factory.mktemp("unigram")
    with open(d / "texts", "w") as f:
        f.write("\n".join(" ".join(t.split()) for _, t in small[:80]))
    sentencepiece.SentencePieceTrainer.train(input=str(d / "texts"), model_prefix=str(d / "m"), vocab_size=600, model_type="unigram", normalization_rule_name="identity",
                                             byte_fallback=True, remove_extra_whitespaces=False, num_threads=1, minloglevel=2)
    return str(d / "m.model")


def some_texts(small):
    return [" ".join(t.split()[k:k + 6]) for _, t in small[:60] for k in (0, 9)] + ["the house", "a"]


def test_best_and_n_best_are_the_librarys(spark, small, unigram):
    p = sentencepiece.SentencePieceProcessor(model_file=unigram)
    lattice = nbest.Lattice(unigram)
    score = lambda ids: sum(p.get_score(i) for i in ids)
    for t in some_texts(small):
        if any(p.is_byte(i) or i == p.unk_id() for i in p.encode(t)):
            continue  # the library charges characters without a piece otherwise
        want = [score(ids) for ids in p.nbest_encode(t, nbest_size=5)]
        got = lattice.encode(t, 5)
        assert np.allclose([s for s, _ in got], want, atol=1e-3), t
        assert np.allclose(score(got[0][1]), score(p.encode(t)), atol=1e-3) and len({ids for _, ids in got}) == len(got)
        assert all(p.decode(list(ids)) == t for _, ids in got)
    assert (nbest.log_probabilities(spark.createDataFrame([], "text string"), unigram) < 0).any()


def test_scores_of_a_bpe_model_are_its_uses(spark, small):
    p = sentencepiece.SentencePieceProcessor(model_file=BPE)
    docs = spark.createDataFrame([(t,) for _, t in small[:40]] + [(None,), ("",), ("a  b ",)], "text string")
    uses = Counter(i for _, t in small[:40] for w in nbest.Lattice.at(BPE).words(t) for i in p.encode(w.replace(nbest.SPACE, " ").removeprefix(" ")))
    got = nbest.log_probabilities(docs.repartition(3), BPE)
    odd = Counter(i for w in nbest.Lattice.at(BPE).words("a  b ") for i in p.encode(w.replace(nbest.SPACE, " ").removeprefix(" ")))
    n = np.full(p.get_piece_size(), 0.5)
    for i, k in (uses + odd).items():
        n[i] += k
    assert np.allclose(got, np.log(n / n.sum()))
    assert np.allclose(np.exp(got).sum(), 1)


def test_frequent_words_are_one_piece(spark):
    p = sentencepiece.SentencePieceProcessor(model_file=BPE)
    docs = spark.createDataFrame([("the house is big and the house is old",)], "text string")
    lattice = nbest.Lattice(BPE, nbest.log_probabilities(docs, BPE))
    assert [p.id_to_piece(i) for i in lattice.encode("the house is big")[0][1]] == ["▁the", "▁house", "▁is", "▁big"]


def test_query_rows_follow_the_lattice(spark, small):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(3)
    scores = nbest.log_probabilities(docs, BPE)
    lattice = nbest.Lattice(BPE, scores)
    text = dict(small)
    for r in nbest.encoded(docs, BPE, 4, scores=scores).collect():
        want = lattice.encode(text[r.doc_id], 4)
        assert (r.n_pieces, r.ids_crc32) == (len(want[0][1]), zlib.crc32(np.array(want[0][1], "<u4").tobytes()))
        assert np.allclose(r.scores, [s for s, _ in want]) and r.round_trip == (lattice.decode(want[0][1]) == text[r.doc_id])


def test_all_segmentations_are_made_and_decoded(spark, small, monkeypatch):
    rows = [*small[:40], (-1, None), (-2, ""), (-3, " a  b "), (-4, "the ▁ sign"), (-5, "é😀 中文"), (-6, "one"), (-7, "\ta\nb")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    scores = nbest.log_probabilities(docs, BPE)
    lattice = nbest.Lattice(BPE, scores)
    for r in nbest.encoded(docs, BPE, 4, scores=scores).collect():
        text = dict(rows)[r.doc_id] or ""
        want = [np.array(ids, "<u4") for _, ids in lattice.encode(text, 4)]
        assert r.nbest_pieces == [len(x) for x in want] and r.nbest_crc32 == [zlib.crc32(x.tobytes()) for x in want]
        assert [lattice.decode(x) for x in want] == [x.decode() for x in lattice.decoded([x.tobytes() for x in want])]
        assert r.round_trip == all(lattice.decode(x) == text for x in want) == ("▁" not in text)
    # what round_trip says is what decoding gives
    monkeypatch.setattr(nbest.Lattice, "_open", {})
    wrong = nbest.Lattice.at(BPE, scores)
    the = next(i for i, x in enumerate(wrong.out) if x == b" the")
    wrong.spelling = pa.array([x if i != the else b" teh" for i, x in enumerate(wrong.out)], pa.large_binary())
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2], pa.int64()), "text": pa.array(["the house", "a house"])})
    monkeypatch.setattr(nbest.Lattice, "at", classmethod(lambda cls, *a: wrong))
    assert [b.column("round_trip").to_pylist() for b in nbest._encoder(BPE, scores, 4)(iter([batch]))] == [[False, True]]


@pytest.mark.parametrize("word", ["z" * 200_000, "ab+/9Zq" * 20_000, "中文字the" * 20_000])
def test_long_words_end_soon(word):
    lattice, began = nbest.Lattice.at(BPE), time.monotonic()
    got = lattice.encode(word, 4)
    assert len({ids for _, ids in got}) == 4 and all(lattice.decode(ids) == word for _, ids in got)
    assert [s for s, _ in got] == sorted((s for s, _ in got), reverse=True) and time.monotonic() - began < 120


def test_the_tree_holds_every_piece_and_words_are_scored_as_by_search():
    size = sentencepiece.SentencePieceProcessor(model_file=BPE).get_piece_size()
    lattice = nbest.Lattice(BPE, np.log(np.random.default_rng(5).random(size) + 1e-6))
    found = {}

    def walk(node, so_far):
        for c, (following, score, ids) in node.items():
            if ids is not None:
                found[so_far + c] = (score, *ids)
            walk(following or {}, so_far + c)
    walk(lattice.tree, "")
    assert found == lattice.score
    for w in ("▁the", "▁unthinkable###", "▁é😀x", "▁中文", "a", "▁"):
        ids, score, loss, again = lattice.word(w)
        best = lattice.search(w, 2)
        assert again and (score, tuple(np.frombuffer(ids, "<u4"))) == best[0]
        assert loss == pytest.approx(best[0][0] - best[1][0] if len(best) > 1 else float("inf"))


def test_long_words_end_soon_with_logarithms_as_scores():
    code = """
import numpy as np, sentencepiece
from arrears.llm import nbest
path = nbest.model_path("piece_bpe_32k.model")
n = sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()
lattice = nbest.Lattice(path, np.log(np.random.default_rng(1).random(n)))
for word in ("z" * 70_000, "ab+/9Zq" * 5_000, "-=" * 9_000):
    got = lattice.encode("a long word " + word, 4)
    assert len({ids for _, ids in got}) == 4 and all(lattice.decode(ids) == "a long word " + word for _, ids in got)
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=60, cwd=os.path.dirname(nbest.__file__) + "/../..")
