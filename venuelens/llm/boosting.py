"""Histogram gradient-boosted trees for a binary label, in numpy.

Features are binned at quantiles; every tree is grown level by level from gradient histograms, to
a fixed depth. Trees are kept flat: node i of a tree has children 2 i + 1 and 2 i + 2, so one
comparison per level moves all rows of a batch at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes); rows above it go right
    value: np.ndarray  # (trees, leaves)
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        depth = int(np.log2(self.value.shape[1]))
        row = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[row, f[node]] > t[node])
            out += v[node - len(f)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def constant(p: float, depth: int = 1) -> Trees:
    p = min(max(p, 1e-3), 1 - 1e-3)
    return Trees(np.zeros((0, 2**depth - 1), np.int64), np.zeros((0, 2**depth - 1)), np.zeros((0, 2**depth)), float(np.log(p / (1 - p))))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15,
    shrink: float = 1.0, min_rows: int = 5,
) -> Trees:
    """Boosting of the logistic loss. A table with one class (or no rows) gives a constant."""
    n, m = x.shape
    if n == 0 or y.min() == y.max():
        return constant(0.5 if n == 0 else (y.sum() + 1) / (n + 2), depth)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.column_stack([np.searchsorted(cuts[j], x[:, j], "left") for j in range(m)])  # bin b: at most cuts[b]
    p = y.mean()
    margin = np.full(n, np.log(p / (1 - p)))
    out = Trees(np.zeros((trees, 2**depth - 1), np.int64), np.full((trees, 2**depth - 1), np.inf), np.zeros((trees, 2**depth)), float(margin[0]))
    for t in range(trees):
        prob = 1 / (1 + np.exp(-margin))
        g, h = prob - y, prob * (1 - prob)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            at = node - first
            best = np.full(count, 1e-9)
            total_g = np.bincount(at, g, count)
            total_h = np.bincount(at, h, count)
            parent = total_g**2 / (total_h + shrink)
            for j in range(m):
                k = len(cuts[j])
                if not k:
                    continue
                cell = at * (k + 1) + binned[:, j]
                size = (count, k + 1)
                gl = np.cumsum(np.bincount(cell, g, count * (k + 1)).reshape(size), axis=1)[:, :k]
                hl = np.cumsum(np.bincount(cell, h, count * (k + 1)).reshape(size), axis=1)[:, :k]
                nl = np.cumsum(np.bincount(cell, minlength=count * (k + 1)).reshape(size), axis=1)
                gain = gl**2 / (hl + shrink) + (total_g[:, None] - gl) ** 2 / (total_h[:, None] - hl + shrink) - parent[:, None]
                gain[(nl[:, :k] < min_rows) | (nl[:, -1:] - nl[:, :k] < min_rows)] = -1
                pick = gain.argmax(axis=1)
                got = gain[np.arange(count), pick]
                better = np.flatnonzero(got > best)
                best[better] = got[better]
                out.feature[t, first + better] = j
                out.threshold[t, first + better] = cuts[j][pick[better]]
            node = 2 * node + 1 + (x[np.arange(n), out.feature[t, node]] > out.threshold[t, node])
        leaf = node - (2**depth - 1)
        value = -rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + shrink)
        out.value[t] = value
        margin += value[leaf]
    return out
