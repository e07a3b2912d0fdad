"""Gradient-boosted trees for two classes, in numpy: histograms of binned features, complete trees of one depth."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    start: float
    features: np.ndarray  # trees x inner nodes
    limits: np.ndarray  # trees x inner nodes: larger values go right
    leaves: np.ndarray  # trees x leaves

    def logit(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        inner = self.features.shape[1]
        for features, limits, leaves in zip(self.features, self.limits, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, features[node]] > limits[node])
            out += leaves[node - inner]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 32, ridge: float = 1.0) -> Trees:
    """Trees for P(y = 1), each fitted to the gradient of the logistic loss of those before."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(width)], axis=1)
    mean = (y.sum() + 1) / (n + 2)
    model = Trees(float(np.log(mean / (1 - mean))), np.zeros((trees, 2**depth - 1), np.int64), np.full((trees, 2**depth - 1), np.inf), np.zeros((trees, 2**depth)))
    score = np.full(n, model.start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h, node = y - p, p * (1 - p), np.zeros(n, np.int64)
        for level in range(depth):
            count, first = 2**level, 2**level - 1
            best, choice = np.full(count, 1e-9), np.full(count, -1)
            for f in range(width):
                size = len(edges[f])
                if not size:
                    continue
                at = (node - first) * (size + 1) + binned[:, f]
                left_g, left_h = (np.cumsum(np.bincount(at, w, count * (size + 1)).reshape(count, size + 1), axis=1) for w in (g, h))
                total_g, total_h = left_g[:, -1:], left_h[:, -1:]
                gain = left_g**2 / (left_h + ridge) + (total_g - left_g) ** 2 / (total_h - left_h + ridge) - total_g**2 / (total_h + ridge)
                cut = gain[:, :-1].argmax(axis=1)
                value = gain[np.arange(count), cut]
                better = value > best
                best[better], choice[better] = value[better], f * bins + cut[better]
            for i in np.flatnonzero(choice >= 0):
                model.features[t, first + i], model.limits[t, first + i] = choice[i] // bins, edges[choice[i] // bins][choice[i] % bins]
            feature = model.features[t, node]
            node = 2 * node + 1 + (x[np.arange(n), feature] > model.limits[t, node])
        leaf = node - (2**depth - 1)
        model.leaves[t] = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
        score += model.leaves[t][leaf]
    return model
