"""Gradient-boosted trees in numpy: logistic loss, binned features, complete trees of one depth.

Small on purpose: fitted on the driver on a bounded sample, applied to whole batches in tasks.
"""

from __future__ import annotations

import numpy as np


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 24, l2: float = 1.0) -> dict:
    """Model of P(y = 1). Every tree splits all nodes of a level, each at its own best place."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    mean = np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    margin = np.full(len(y), base)
    feature = np.zeros((trees, 2 ** depth - 1), dtype=np.int64)
    cut = np.full((trees, 2 ** depth - 1), np.inf)
    leaf = np.zeros((trees, 2 ** depth))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (p - y), weight * p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, many = 2 ** level - 1, 2 ** level
            best = np.full(many, 1e-6)
            for j, e in enumerate(edges):
                k = len(e) + 1
                if k < 2:
                    continue
                at = node * k + binned[:, j]
                gl = np.bincount(at, g, many * k).reshape(many, k).cumsum(1)
                hl = np.bincount(at, h, many * k).reshape(many, k).cumsum(1)
                G, H = gl[:, -1:], hl[:, -1:]
                gain = (gl ** 2 / (hl + l2) + (G - gl) ** 2 / (H - hl + l2) - G ** 2 / (H + l2))[:, :-1]
                c = gain.argmax(1)
                better = gain[np.arange(many), c] > best
                best = np.where(better, gain[np.arange(many), c], best)
                feature[t, first:first + many][better] = j
                cut[t, first:first + many][better] = e[c[better]]
            f, c = feature[t, first + node], cut[t, first + node]
            node = 2 * node + (x[np.arange(len(y)), f] > c)
        leaf[t] = -rate * np.bincount(node, g, 2 ** depth) / (np.bincount(node, h, 2 ** depth) + l2)
        margin += leaf[t][node]
    return {"base": base, "depth": depth, "feature": feature, "cut": cut, "leaf": leaf}


def margins(x: np.ndarray, model: dict) -> np.ndarray:
    """Log odds of each row."""
    out, rows = np.full(len(x), model["base"]), np.arange(len(x))
    for feature, cut, leaf in zip(model["feature"], model["cut"], model["leaf"]):
        node = np.zeros(len(x), dtype=np.int64)
        for level in range(model["depth"]):
            at = 2 ** level - 1 + node
            node = 2 * node + (x[rows, feature[at]] > cut[at])
        out += leaf[node]
    return out
