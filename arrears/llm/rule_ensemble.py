"""Text quality by a sparse rule ensemble.

Statistics of a text are Spark columns.  Boosted trees are grown on a bounded
sample of labelled rows; every path to a node is a conjunctive rule; a lasso
logistic regression gives most rules the weight zero; the rest is compiled
back into one Spark expression, so scoring is a projection of the scan: no
Python, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import ceil

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.llm.trees import Node, auc, boost, sigmoid

#: The classifier is fit on about so many labelled rows at most.
SAMPLE_ROWS = 12_000
TREES, DEPTH = 40, 3
FOLDS = 5  # rows whose id's checksum is 0 modulo this are held out

Rule = tuple[tuple[int, bool, float], ...]  # (feature, at most, threshold), all of which hold


def statistics(text: Column) -> dict[str, Column]:
    """What rules speak of; a null text counts as empty, and every ratio of an
    empty text is 0."""
    t = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chars, n = F.length(t), F.size(words)
    per = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    count = lambda p: F.regexp_count(t, F.lit(p))
    return {
        "log_chars": F.log1p(chars.cast("double")),
        "upper": per(count(r"\p{Lu}"), chars),
        "digits": per(count(r"[0-9]"), chars),
        "symbols": per(count(r"[#$%&*<>=@^_`{|}~\\]"), chars),
        "bangs": per(count(r"[!?]"), chars),
        "stops": per(count(r"[.,;:]"), chars),
        "lines": per(count(r"\n"), n),
        "distinct": per(F.size(F.array_distinct(words)), n),
        "word_length": per(F.length(F.array_join(words, "")), n),
        "wordless": per(F.size(F.filter(words, lambda w: ~w.rlike(r"\p{L}"))), n),
        "symbol_words": per(F.size(F.filter(words, lambda w: w.rlike(r"[^\p{L}\p{N}]{2}"))), n),
    }


@dataclass(frozen=True)
class Ensemble:
    names: tuple[str, ...]
    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, columns: dict[str, Column]) -> Column:
        """The chance of class 1 as one Spark expression."""
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            holds = reduce(lambda a, b: a & b, [columns[self.names[f]] <= F.lit(t) if most else columns[self.names[f]] > F.lit(t) for f, most, t in rule])
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.bias + sum((w * holds(r, x) for r, w in self.rules), np.zeros(len(x))))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([x[:, f] <= t if most else x[:, f] > t for f, most, t in rule])


def tree_rules(tree: list[Node]) -> list[Rule]:
    """The conjunction on the path to every node below the root."""
    out: list[Rule] = []

    def walk(at: int, path: Rule) -> None:
        if path:
            out.append(tuple(sorted(set(path))))
        f, cut, left, right, _ = tree[at]
        if f >= 0:
            walk(left, (*path, (f, True, cut)))
            walk(right, (*path, (f, False, cut)))
    walk(0, ())
    return out


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 300) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient; the bias is not penalised."""
    n, k = x.shape
    w, b = np.zeros(k), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    v, c, t = w.copy(), b, 1.0
    step = 4 * n / (np.linalg.norm(np.c_[x, np.ones(n)], 2) ** 2)
    for _ in range(steps):
        r = sigmoid(x @ v + c) - y
        u = v - step * (x.T @ r) / n
        u, d = np.sign(u) * np.maximum(np.abs(u) - step * penalty, 0), c - step * r.mean()
        t, s = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v, c = u + (s - 1) / t * (u - w), d + (s - 1) / t * (d - b)
        w, b = u, d
    return b, w


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str], seed: int = 7) -> Ensemble:
    """Without rows, or with one class only, the score is the share of class 1
    (0.5 without rows)."""
    share = float(y.mean()) if len(y) else 0.5
    if len(y) < 40 or share in (0.0, 1.0):
        p = min(max(share, 0.01), 0.99)
        return Ensemble(tuple(names), float(np.log(p / (1 - p))), ())
    _, trees = boost(x, y, TREES, DEPTH, seed=seed)
    rules = list(dict.fromkeys(r for t in trees for r in tree_rules(t)))
    m = np.column_stack([holds(r, x) for r in rules]).astype(np.float64) if rules else np.zeros((len(x), 0))
    _, first = np.unique(m, axis=1, return_index=True)  # rules that hold for the same rows are one
    rules, m = [rules[i] for i in sorted(first)], m[:, sorted(first)]
    check = np.random.default_rng(seed).random(len(y)) < 0.25
    best = (-1.0, 1e-3)
    for penalty in (1e-2, 3e-3, 1e-3, 3e-4):
        b, w = lasso_logistic(m[~check], y[~check], penalty)
        best = max(best, (round(auc(m[check] @ w + b, y[check]), 3), penalty))  # of equals, the sparser
    b, w = lasso_logistic(m, y, best[1])
    return Ensemble(tuple(names), float(b), tuple((r, float(v)) for r, v in zip(rules, w) if abs(v) > 1e-6))


def held_out(id_: Column) -> Column:
    """Whether a row is kept from the fit; a null id counts as an empty text."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit(""))) % FOLDS == 0


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        sample_rows: int = SAMPLE_ROWS) -> Ensemble:
    """Learns from at most about ``sample_rows`` labelled rows outside the
    held-out fold, chosen by a hash of the id.  Labels that are null or
    contradict each other and rows without an id are left out."""
    l = (labels.select(F.col(id_col).alias("i"), F.col(target).alias("y")).where(F.col("i").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("i")))
         .groupBy("i").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z").drop("z"))
    every = max(1, ceil(l.count() / sample_rows))
    # bounded by sample_rows, so it may be sent to all
    l = F.broadcast(l.where(F.pmod(F.xxhash64("i"), F.lit(every)) == 0))
    d = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).join(l, "i")
    columns = statistics(F.col("t"))
    rows = np.array(d.select(F.col("i").cast("double"), F.col("y").cast("double"), *columns.values()).toPandas(), np.float64).reshape(-1, 2 + len(columns))
    rows = rows[np.lexsort(rows.T[::-1])]
    return fit_rules(rows[:, 2:], (rows[:, 1] > 0).astype(np.float64), list(columns))


def scored(docs: DataFrame, model: Ensemble, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with its score (0 to 1) in a new column; every row is kept, an
    empty or null text is scored like any other."""
    columns = statistics(F.col(text_col))
    # the statistics are computed once, under a name no input column has
    at = "stats"
    while at in docs.columns:
        at += "_"
    d = docs.withColumn(at, F.struct(*(c.alias(k) for k, c in columns.items())))
    return d.withColumn(score_col, model.score({k: F.col(at)[k] for k in columns})).drop(at)
