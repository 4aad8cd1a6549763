"""Personal data by candidate gradient boosting.

Base spans follow fixed formats and are always kept.  High-recall generators
propose further spans, which may overlap: numbers and addresses written
around the formats (no plus sign, dots spelled out, odd separators).  Boosted
trees, fit on format and context features, score them; a span is added when its
score passes its kind's threshold, which is set on held-out candidates so
that at most ``1 - PRECISION`` of what passes is wrong.

There are no labelled spans, so the trees learn from the texts themselves:
base spans rewritten the way people obscure them (positives) and candidates
that fail a checksum, a range or their context (negatives).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.shingles import pieces
from arrears.llm.trees import Node, boost, sigmoid, values

KINDS = ("email", "ip", "card", "phone")
#: The classifier is fit on the candidates of about so many documents at most.
SAMPLE_DOCS = 4_000
PRECISION, TREES, DEPTH = 0.98, 40, 3
CONTEXT = 40

Span = tuple[str, int, int]

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){15,}+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their @ signs: what comes before one is
    the longest run of allowed characters since the match before."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        free = m.end() if m else at + 1
        if m:
            yield start, m.end()
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """The fixed formats: leftmost non-overlapping matches of each kind, in
    order of kind and start; matches that fail their check are dropped."""
    out = [("email", a, b) for a, b in _emails(text)]
    if _DIGITS.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(_octet(p) for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m[0]) if m.end() - m.start() <= 40 else ""
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_DIGITS.findall(m[0])) <= 15]
    return out


#: High-recall generators: a kind, what every match of the pattern has in it, the pattern.
GENERATORS = (
    ("email", re.compile(r"@|[\s\[({]at[\s\])}]", re.I),
     re.compile(r"[A-Za-z0-9._%+-]+\s?(?:[\[({]\s?(?:at|@)\s?[\])}]|\sat\s|\s@\s|@)\s?[A-Za-z0-9-]+(?:\s?(?:[\[({]\s?dot\s?[\])}]|\sdot\s|\.)\s?[A-Za-z0-9-]+)+", re.I)),
    ("ip", re.compile(r"[0-9]\s?(?:[\[({]\s?(?:\.|dot)\s?[\])}]|\sdot\s|\.)\s?[0-9]", re.I),
     re.compile(r"(?<![\w.])[0-9]{1,3}(?:\s?(?:[\[({]\s?(?:\.|dot)\s?[\])}]|\sdot\s|\.)\s?[0-9]{1,3}){3}(?!\w)", re.I)),
    ("card", re.compile(r"[0-9]{4}"), re.compile(r"(?<!\w)[0-9]{4}(?:[\x20./_-]{0,2}[0-9]{2,6}){2,5}(?!\w)")),
    ("phone", re.compile(r"[0-9]{2}"), re.compile(r"(?<![\w+])(?:00[0-9]{1,3}[\x20.-]?)?(?:\(?[0-9]{2,4}\)?[\x20./-]{1,2}[0-9]{3,4}[\x20./-][0-9]{3,4}|[0-9]{1,2}(?:[\x20./-][0-9]{2}){4})(?!\w)")),
)
_HINTS = {
    "email": re.compile(r"e-?mail|contact|write|reach|address|correo|courriel", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|login|port\b", re.I),
    "card": re.compile(r"card|visa|master|amex|credit|pay|tarjeta|carte|karte", re.I),
    "phone": re.compile(r"phone|tel\b|tel[.:]|call|mobile|cell|fax|contact", re.I),
}


def candidates(text: str) -> list[Span]:
    return [(kind, *m.span()) for kind, gate, pattern in GENERATORS if gate.search(text) for m in pattern.finditer(text)]


FEATURES = ("kind", "length", "digits", "letters", "spaces", "dots", "dashes", "brackets", "luhn", "octets", "spelled",
            "hint", "other_hint", "number_before", "number_after", "joined_before", "joined_after", "groups", "digit_share_around")


def features(text: str, span: Span) -> list[float]:
    kind, a, b = span
    s, before, after = text[a:b], text[max(0, a - CONTEXT):a], text[b:b + CONTEXT]
    digits, numbers = re.sub("[^0-9]", "", s), re.findall("[0-9]+", s)
    around = before + after
    return [float(KINDS.index(kind)), b - a, len(digits), sum(c.isalpha() for c in s), s.count(" "), s.count("."), s.count("-"),
            sum(s.count(c) for c in "[](){}"), bool(digits) and luhn(digits), len(numbers) == 4 and all(map(_octet, numbers)),
            len(re.findall(r"\b(?:at|dot)\b", s, re.I)), bool(_HINTS[kind].search(around)), any(h.search(around) for k, h in _HINTS.items() if k != kind),
            bool(re.search(r"[0-9]\s?$", before)), bool(re.match(r"\s?[0-9]", after)), bool(re.search(r"[\w@+]$", before)), bool(re.match(r"[\w@]", after)),
            len(numbers), sum(c.isdigit() for c in around) / (len(around) + 1)]


@dataclass(frozen=True)
class Model:
    base: float
    trees: tuple[tuple[Node, ...], ...]
    cut: dict[str, float]  # of each kind, the calibrated threshold

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(sum((values(list(t), x) for t in self.trees), np.full(len(x), self.base)))


def _obscured(text: str, span: Span, pick: int) -> str:
    """A base span the way people rewrite one."""
    kind, a, b = span
    s = text[a:b]
    if kind == "email":
        at, dot = ((" [at] ", " [dot] "), (" at ", " dot "), (" (at) ", "."), (" @ ", "."))[pick % 4]
        name, _, host = s.partition("@")
        return name + at + host.replace(".", dot)
    if kind == "ip":
        return s.replace(".", ("[.]", " dot ", "(.)", " [.] ")[pick % 4])
    digits = re.sub("[^0-9]", "", s)
    if kind == "card":
        sep = ("  ", ".", "/", " . ")[pick % 4]
        return sep.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    plain = digits[-10:]
    return (f"({plain[:3]}) {plain[3:6]}-{plain[6:]}", f"{plain[:3]}-{plain[3:6]}-{plain[6:]}", f"00{digits[:-10] or 1} {plain[:3]} {plain[3:6]} {plain[6:]}", f"{plain[:3]}.{plain[3:6]}.{plain[6:]}",
            " ".join(plain[i:i + 2] for i in range(0, len(plain), 2)))[pick % 5]


def training_rows(text: str) -> list[tuple[list[float], int]]:
    """Features and labels of one text: its base spans in every disguise, the
    same disguises around numbers that fail the formats' checks, and its own
    candidates that overlap no base span."""
    out: list[tuple[list[float], int]] = []
    base = base_spans(text)
    for k, (kind, a, b) in enumerate(base):
        for pick in range(5 if kind == "phone" else 4):
            for good in (True, False):
                s = _obscured(text, (kind, a, b), pick + k)
                if not good:
                    s = _spoiled(kind, s, a + pick)
                other = text[max(0, a - CONTEXT):a] + s + text[b:b + CONTEXT]
                at = a - max(0, a - CONTEXT)
                hits = [c for c in candidates(other) if c[0] == kind and c[1] < at + len(s) and c[2] > at]
                out += [(features(other, c), int(good and c[1] == at and c[2] == at + len(s))) for c in hits]
    for c in candidates(text):
        if not any(c[1] < b and a < c[2] for _, a, b in base):
            out.append((features(text, c), 0))
    return out


def _spoiled(kind: str, s: str, seed: int) -> str:
    """The same shape without the meaning."""
    if kind == "email":
        return re.sub(r"(\[dot\]|\bdot\b|\.)", ",", s)
    if kind == "ip":
        return re.sub(r"[0-9]+", lambda m: str(256 + (int(m[0]) * 7 + seed) % 700), s)
    if kind == "card":
        i = max(i for i, c in enumerate(s) if c.isdigit())
        return s[:i] + str((int(s[i]) + 1 + seed % 8) % 10)
    return re.sub(r"[0-9]{4}$", lambda m: m[0][:2], s) if seed % 2 else "7" + s + "31"


def fit_model(rows: list[tuple[list[float], int]]) -> Model:
    """Kinds without enough held-out candidates above the asked precision get
    a threshold that nothing passes."""
    never = {k: 2.0 for k in KINDS}
    x, y = np.array([r[0] for r in rows], float).reshape(-1, len(FEATURES)), np.array([r[1] for r in rows], float)
    if len(y) < 100 or not 0 < y.mean() < 1:
        return Model(-9.0, (), never)
    order = np.lexsort((*x.T, y))
    x, y = x[order], y[order]
    check = np.random.default_rng(5).random(len(y)) < 0.3
    base, trees = boost(x[~check], y[~check], TREES, DEPTH)
    model = Model(base, tuple(tuple(t) for t in trees), never)
    score, cut = model.score(x), dict(never)
    for k, kind in enumerate(KINDS):
        m = check & (x[:, 0] == k)
        s, t = score[m], y[m]
        at = np.argsort(-s, kind="stable")
        s, right = s[at], np.cumsum(t[at])
        precise = right / np.arange(1, len(s) + 1)
        last = np.append(s[1:] < s[:-1], True) if len(s) else np.zeros(0, bool)  # ties pass together
        ok = np.flatnonzero(last & (precise >= PRECISION) & (right >= 20) & (s >= 0.5))
        if len(ok):
            # halfway to the next held-out score, as any value between passes the same
            cut[kind] = float(s[ok[-1]] + max([0.5, *s[ok[-1] + 1:ok[-1] + 2]])) / 2
    return Model(base, model.trees, cut)


def added_spans(text: str, base: list[Span], model: Model) -> list[Span]:
    """Of the candidates that pass and touch no base span, the best of those that overlap."""
    rest = [c for c in candidates(text) if not any(c[1] < b and a < c[2] for _, a, b in base)] if min(model.cut.values()) <= 1 else []
    if not rest:
        return []
    score = model.score(np.array([features(text, c) for c in rest], float))
    out: list[Span] = []
    for s, c in sorted(zip(score.tolist(), rest), key=lambda x: (-x[0], x[1])):
        if s >= model.cut[c[0]] and not any(c[1] < b and a < c[2] for _, a, b in out):
            out.append(c)
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learns from the candidates of about ``sample_docs`` documents, chosen
    by a hash of id and text."""
    d = docs.select(F.col(text_col).alias("text"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"))
    every = max(1, ceil(docs.count() / sample_docs))
    rows = d.where(F.col("text").isNotNull() & (F.pmod("h", F.lit(every)) == 0)).select("text").mapInArrow(_train, "x array<double>, y int").toArrow().to_pylist()
    return fit_model([(r["x"], r["y"]) for r in rows])


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [r for t in b.column("text").to_pylist() for r in training_rows(t)]
        yield pa.RecordBatch.from_arrays([pa.array([[float(v) for v in x] for x, _ in rows], pa.list_(pa.float64())), pa.array([y for _, y in rows], pa.int32())], ["x", "y"])


def found(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, the number of base spans of each
    kind, ``base_sha256`` of the base spans as text, and all ``spans``.

    A null text is scanned like an empty one and has no spans; repeated rows
    and null ids give a row each; other columns are not looked at.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole, "text"):
                base = [base_spans(t or "") for t in b.column("text").to_pylist()]
                both = [x + added_spans(t or "", x, model) for t, x in zip(b.column("text").to_pylist(), base)]
                counts = [pa.array([sum(s[0] == k for s in x) for x in base], pa.int64()) for k in KINDS]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *counts, pa.array([hashlib.sha256(joined(x).encode()).hexdigest() for x in base], pa.string()),
                                                  pa.array([joined(x) for x in both], pa.string())], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")


def redact_text(text: str, spans: list[Span]) -> str:
    """Each span becomes its kind in brackets; of overlapping ones the first, which
    takes in the others."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with every span in its text replaced; a null text stays null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = whole.schema.get_field_index(text_col)
            for b in pieces(whole, text_col):
                new = []
                for t in b.column(at).to_pylist():
                    base = base_spans(t or "")
                    new.append(t if t is None else redact_text(t, base + added_spans(t, base, model)))
                yield b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))
    return docs.mapInArrow(run, docs.schema)
