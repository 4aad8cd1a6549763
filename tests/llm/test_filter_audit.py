"""The filter audit against brute force, and its matrix against word counts."""
import re
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from arrears.llm import filter_audit as fa
from arrears.llm.common import Scratch
from arrears.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(rows):
    ids = {}
    for i, _, t in rows:
        if i is not None:
            ids[t or ""] = min(i, ids.get(t or "", i))
    out = []
    for i, part, t in rows:
        t = t or ""
        words = WORD.findall(t)
        out.append((i, part or "", {f for f, bad in zip("ABCDE", (len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                                                                   bool(re.search(r"[#$%&*|]", t)), i is not None and i > ids[t])) if bad}))
    return out


def brute(rows, labels):
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    found, out = fails(rows), []
    for part in {p for _, p, _ in found}:
        docs = [(i, f) for i, p, f in found if p == part]
        lines = []
        for order in permutations("ABCDE"):
            for s, f in enumerate(order):
                before = set(order[:s])
                hit = [(i, x) for i, x in docs if f in x and not x & before]
                lines.append(("".join(order), s + 1, f, sum(not x & (before | {f}) for _, x in docs), len(hit), sum(f in x and bool(x & before) for _, x in docs),
                              sum(x == {f} for _, x in docs), sum(i in good for i, _ in hit), sum(i in toxic for i, _ in hit)))
        total = Counter()
        for x in lines:
            total[x[2]] += x[4]
        out += [(part, o, s, *rest, total[f]) for o, s, f, *rest in lines]
    return sorted(out)


COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audited(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_query_and_sql(spark):
    rows = [(r.doc_id, r.source, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    got = audited(QUERIES["op13_filter_audit"](spark, SMALL))
    assert got == brute(rows, labels)
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    assert got == sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLE['op13_filter_audit']})").fetchall())


def test_odd_rows(spark, odd_docs, odd_files):
    rows = [(r.doc_id, r.source, r.text) for r in odd_docs.collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{odd_files}/labels.parquet").collect()]
    got = audited(QUERIES["op13_filter_audit"](spark, odd_files))
    assert got == brute(rows, labels) and {r[0] for r in got} == {"", "s"}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab  \u0085 \t\n\x0b\x0c\r\x1cé中😀"), max_size=30), max_size=12))
def test_csr_counts_words(texts):
    starts, columns, counts, words = fa.csr(pa.array(texts, pa.large_string()))
    words = words.to_pylist()
    assert len(starts) == len(texts) + 1 and len(words) == len(set(words))
    for k, t in enumerate(texts):
        row = slice(starts[k], starts[k + 1])
        assert {words[c]: n for c, n in zip(columns[row], counts[row])} == Counter(WORD.findall(t)) and list(columns[row]) == sorted(columns[row])


@pytest.mark.parametrize("a", [[], [0], [5, -3, 1 << 40, -(1 << 40)], list(range(1000))])
def test_packed_integers(a):
    assert fa.unpacked(fa.packed(np.array(a, np.int64))).tolist() == a


@pytest.mark.parametrize("size", [1, 20_000, 8 << 20])
def test_matrix_under_any_shard_size(spark, size):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(3)
    dictionary, shards = fa.document_terms(docs, Scratch(spark, "t"), shard_bytes=size)
    word = {r.word_id: r.word for r in dictionary.collect()}
    assert len(set(word.values())) == len(word) and sorted(word) == list(range(len(word)))
    assert shards.count() > 50 if size == 1 else shards.count() >= 1
    text, seen = {r.doc_id: r.text or "" for r in docs.collect()}, 0
    for s in shards.collect():
        starts, columns, counts = (fa.unpacked(s[c]) for c in ("row_starts", "columns", "counts"))
        for k, i in enumerate(s.doc_id):
            row = slice(starts[k], starts[k + 1])
            assert {word[c]: n for c, n in zip(columns[row], counts[row])} == Counter(WORD.findall(text[i])) and (np.diff(columns[row]) > 0).all()
            seen += 1
    assert seen == len(text)
    assert {r.doc_id: (r.n_words, r.n_distinct, r.n_chars) for r in fa.row_facts(shards).collect()} == {i: (len(w := WORD.findall(t)), len(set(w)), len(t)) for i, t in text.items()}
