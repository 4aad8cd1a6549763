"""Small gradient-boosted trees in numpy, for models fit on a bounded sample.

A tree is a list of nodes ``(feature, threshold, left, right, value)``; a row
goes left where its feature is at most the threshold; leaves have feature -1.
"""

from __future__ import annotations

import numpy as np

Node = tuple[int, float, int, int, float]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def thresholds(x: np.ndarray, most: int = 24) -> list[np.ndarray]:
    """Split points of each feature: midpoints between neighbouring quantiles."""
    out = []
    for c in x.T:
        q = np.unique(np.quantile(c, np.linspace(0, 1, most + 1)))
        out.append((q[1:] + q[:-1]) / 2)
    return out


def grow(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, cuts: list[np.ndarray], depth: int,
         features: np.ndarray, least: int = 20, ridge: float = 1.0) -> list[Node]:
    nodes: list[Node] = []

    def add(rows: np.ndarray, level: int) -> int:
        g, h = grad[rows].sum(), hess[rows].sum()
        at = len(nodes)
        nodes.append((-1, 0.0, -1, -1, float(g / (h + ridge))))
        if level == depth or len(rows) < 2 * least:
            return at
        best = (1e-6, -1, 0.0)
        for f in features:
            if not len(cuts[f]):
                continue
            k = np.searchsorted(cuts[f], x[rows, f], "left")
            n = len(cuts[f]) + 1
            gs, hs, ns = (np.cumsum(np.bincount(k, w, n))[:-1] for w in (grad[rows], hess[rows], None))
            gain = gs**2 / (hs + ridge) + (g - gs) ** 2 / (h - hs + ridge) - g**2 / (h + ridge)
            gain[(ns < least) | (len(rows) - ns < least)] = 0
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (float(gain[i]), int(f), float(cuts[f][i]))
        if best[1] >= 0:
            left = x[rows, best[1]] <= best[2]
            a, b = add(rows[left], level + 1), add(rows[~left], level + 1)
            nodes[at] = (best[1], best[2], a, b, nodes[at][4])
        return at

    add(np.arange(len(x)), 0)
    return nodes


def values(tree: list[Node], x: np.ndarray) -> np.ndarray:
    at = np.zeros(len(x), int)
    feature, cut, left, right, value = (np.array(c) for c in zip(*tree))
    while (inner := feature[at] >= 0).any():
        r = np.flatnonzero(inner)
        a = at[r]
        at[r] = np.where(x[r, feature[a]] <= cut[a], left[a], right[a])
    return value[at]


def boost(x: np.ndarray, y: np.ndarray, n_trees: int, depth: int, rate: float = 0.2, rows: float = 0.5,
          features: float = 0.7, seed: int = 7) -> tuple[float, list[list[Node]]]:
    """Logistic boosting on random halves of the rows; base log-odds and trees."""
    rng = np.random.default_rng(seed)
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base, cuts, trees = float(np.log(p / (1 - p))), thresholds(x), []
    score = np.full(len(x), base)
    for _ in range(n_trees):
        i = np.flatnonzero(rng.random(len(x)) < rows)
        f = np.flatnonzero(rng.random(x.shape[1]) < features)
        q = sigmoid(score)
        tree = grow(x[i], (y - q)[i], (q * (1 - q))[i], cuts, depth, f if len(f) else np.arange(x.shape[1]))
        trees.append([(a, b, c, d, e * rate) for a, b, c, d, e in tree])
        score += values(trees[-1], x)
    return base, trees


def auc(score: np.ndarray, y: np.ndarray) -> float:
    """Chance that a row of class 1 scores above one of class 0; ties count half."""
    _, at, n = np.unique(score, return_inverse=True, return_counts=True)
    rank = (np.cumsum(n) - (n - 1) / 2)[at]
    pos = y > 0
    a, b = pos.sum(), (~pos).sum()
    return float((rank[pos].sum() - a * (a + 1) / 2) / (a * b)) if a and b else 0.5
