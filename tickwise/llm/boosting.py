"""Histogram gradient-boosted trees in numpy, flattened into arrays.

Features are cut into at most ``bins`` quantile bins. Each tree is grown level
by level on sums of gradient and curvature of the logistic loss per node,
feature and bin, found for all nodes of a level at once. The trained trees are
six flat arrays; rows descend together, one array lookup for each level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """``roots`` points into the node arrays; a leaf points to itself on both sides."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row; a missing value (NaN) goes right."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


def constant(p: float) -> Trees:
    """No trees: every row gets ``p``."""
    none = np.zeros(0, np.int64)
    p = min(max(p, 1e-6), 1 - 1e-6)
    return Trees(none, none, np.zeros(0), none, none, np.zeros(0), float(np.log(p / (1 - p))), 0)


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64,
        l2: float = 1.0, min_rows: int = 10) -> Trees:
    """Trees fitted to labels 0/1. Without rows every row scores 0.5; with one
    class only, close to that class."""
    if len(y) == 0:
        return constant(0.5)
    if y.min() == y.max():
        return constant((y.sum() + 1) / (len(y) + 2))
    n, k = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(k)]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
    flat = binned + np.arange(k) * bins
    prior = y.mean()
    base = float(np.log(prior / (1 - prior)))
    total = np.full(n, base)
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, curve = p - y, p * (1 - p)
        roots.append(len(nodes))
        nodes.append([0, 0.0, len(nodes), len(nodes), 0.0])
        at = np.full(n, roots[-1])
        level = [roots[-1]]
        for _ in range(depth):
            place = {node: i for i, node in enumerate(level)}
            slot = np.array([place.get(a, -1) for a in range(roots[-1], len(nodes))])[at - roots[-1]]
            live = np.flatnonzero(slot >= 0)
            size = len(level) * k * bins
            cell = (slot[live, None] * (k * bins) + flat[live]).ravel()
            g, h, c = (np.bincount(cell, np.repeat(w[live], k), size).reshape(len(level), k, bins).cumsum(2)
                       for w in (grad, curve, np.ones(n)))
            g_all, h_all, c_all = g[:, :1, -1:], h[:, :1, -1:], c[:, :1, -1:]
            gain = g ** 2 / (h + l2) + (g_all - g) ** 2 / (h_all - h + l2) - g_all ** 2 / (h_all + l2)
            gain[(c < min_rows) | (c_all - c < min_rows)] = 0
            best = gain.reshape(len(level), -1).argmax(1)
            grown = []
            for i, node in enumerate(level):
                j, cut = divmod(int(best[i]), bins)
                if gain[i, j, cut] <= 1e-9 or cut >= len(cuts[j]):
                    continue
                a = len(nodes)
                nodes[node][:4] = [j, cuts[j][cut], a, a + 1]
                nodes += [[0, 0.0, a, a, 0.0], [0, 0.0, a + 1, a + 1, 0.0]]
                grown += [a, a + 1]
                mine = live[slot[live] == i]
                at[mine] = np.where(binned[mine, j] <= cut, a, a + 1)
            if not (level := grown):
                break
        span = at - roots[-1]
        g, h = np.bincount(span, grad), np.bincount(span, curve)
        values = -rate * g / (h + l2)
        for i, v in enumerate(values):
            nodes[roots[-1] + i][4] = float(v)
        total += values[span]
    f, t, left, right, v = (np.array(c) for c in zip(*nodes))
    return Trees(np.array(roots), f.astype(np.int64), t, left.astype(np.int64), right.astype(np.int64), v, base, depth)
