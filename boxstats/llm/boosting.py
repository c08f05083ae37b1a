"""Gradient-boosted trees for small tables: logistic loss, splits on quantile bins."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Boosted:
    """Trees as arrays by node: feature (-1: a leaf), cut (values up to it go to node 2i + 1,
    others to 2i + 2) and leaf value."""

    start: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), np.int64)
            while (inner := feature[at] >= 0).any():
                right = x[rows, np.maximum(feature[at], 0)] > cut[at]
                at = np.where(inner, 2 * at + 1 + right, at)
            total += value[at]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def train(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32, least: float = 2.0, ridge: float = 1.0) -> Boosted:
    """Newton boosting of trees of ``depth``; deterministic, ties go to the first feature."""
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(share / (1 - share))))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    margin = np.full(len(x), model.start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = y - p, np.maximum(p * (1 - p), 1e-9)
        nodes = 2 ** (depth + 1) - 1
        feature, cut, value = np.full(nodes, -1), np.zeros(nodes), np.zeros(nodes)
        at = np.zeros(len(x), np.int64)
        for node in range(nodes):
            rows = np.flatnonzero(at == node)
            if not len(rows):
                continue
            g, h = slope[rows].sum(), bend[rows].sum()
            value[node] = rate * g / (h + ridge)
            if node >= 2**depth - 1:
                continue
            best = (1e-6, -1, 0)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                gl = np.cumsum(np.bincount(binned[rows, f], slope[rows], len(c) + 1))[:-1]
                hl = np.cumsum(np.bincount(binned[rows, f], bend[rows], len(c) + 1))[:-1]
                n = np.cumsum(np.bincount(binned[rows, f], minlength=len(c) + 1))[:-1]
                gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
                gain[(n < least) | (len(rows) - n < least)] = 0
                k = int(gain.argmax())
                if gain[k] > best[0] + 1e-12:
                    best = (gain[k], f, k)
            if best[1] >= 0:
                feature[node], cut[node], value[node] = best[1], cuts[best[1]][best[2]], 0.0
                at[rows] = 2 * node + 1 + (binned[rows, best[1]] > best[2])
        model.trees.append((feature, cut, value))
        margin += value[at]
    return model
