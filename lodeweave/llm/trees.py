"""Histogram gradient-boosted trees in numpy, flattened into arrays.

Features are cut into quantile bins once; each level of a tree sums gradients by (node, bin) with one bincount for
each feature, and takes each node's best split. A tree is a full binary tree in arrays (feature, threshold, value),
so a batch goes down all trees by indexing, one step for each level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    start: float
    features: np.ndarray  # trees x inner nodes
    thresholds: np.ndarray  # a value above it goes right
    values: np.ndarray  # trees x leaves
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.features, self.thresholds, self.values, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - (len(feature))]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, l2: float = 1.0, least: float = 1.0) -> Trees:
    """Logistic loss; least: the least sum of second derivatives in a child. One class, or no rows: a constant."""
    n, width = x.shape
    p = (y.sum() + 1) / (n + 2)
    inner, start = (1 << depth) - 1, float(np.log(p / (1 - p)))
    features, thresholds, values = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, 1 << depth))
    if n < 2 or y.min() == y.max():
        return Trees(start, features[:0], thresholds[:0], values[:0], depth)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(width)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f]) for f in range(width)])  # bin b: cuts[b-1] < value <= cuts[b]
    raw = np.full(n, start)
    for t in range(trees):
        prob = 1 / (1 + np.exp(-raw))
        grad, hess = prob - y, prob * (1 - prob)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            nodes, first = 1 << level, (1 << level) - 1
            best, feature, cut = np.zeros(nodes), np.zeros(nodes, np.int64), np.full(nodes, bins)
            own = node - first
            for f in range(width):
                key = own * bins + binned[f]
                g = np.bincount(key, grad, nodes * bins).reshape(nodes, bins)
                h = np.bincount(key, hess, nodes * bins).reshape(nodes, bins)
                gl, hl = np.cumsum(g, 1), np.cumsum(h, 1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
                gain[(hl < least) | (ht - hl < least)] = 0
                gain[:, len(cuts[f]) :] = 0
                at = gain.argmax(1)
                top = gain[np.arange(nodes), at]
                better = top > best + 1e-9
                best[better], feature[better], cut[better] = top[better], f, at[better]
            some = best > 0
            features[t, first : first + nodes] = feature
            thresholds[t, first : first + nodes][some] = [cuts[f][c] for f, c in zip(feature[some], cut[some], strict=True)]
            right = binned[feature[own], np.arange(n)] > cut[own]
            node = 2 * node + 1 + (right & some[own])
        leaf = node - inner
        g, h = np.bincount(leaf, grad, 1 << depth), np.bincount(leaf, hess, 1 << depth)
        values[t] = -rate * g / (h + l2)
        raw += values[t][leaf]
    return Trees(start, features, thresholds, values, depth)
