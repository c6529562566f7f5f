"""Gradient-boosted trees for two classes, in numpy: binned features, trees of one fixed depth, logistic loss."""

from __future__ import annotations

import numpy as np


class Boosted:
    """``edges``: bin edges by feature; trees are complete, nodes numbered 1, 2-3, 4-7, ... as in a heap."""

    def __init__(self, base: float, features: np.ndarray, cuts: np.ndarray, leaves: np.ndarray):
        self.base, self.features, self.cuts, self.leaves = base, features, cuts, leaves

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, least: float = 5.0, ridge: float = 1.0) -> Boosted:
        n, f = x.shape
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(f)]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
        flat = binned + np.arange(f) * bins
        base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        score = np.full(n, base)
        all_features, all_cuts, all_leaves = [], [], []
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            feature, cut = np.zeros(1 << depth, dtype=np.int64), np.full(1 << depth, np.inf)
            node = np.ones(n, dtype=np.int64)
            for level in range(depth):
                first, width = 1 << level, f * bins
                at = ((node - first)[:, None] * width + flat).reshape(-1)
                sums = [np.bincount(at, np.repeat(v, f), minlength=first * width).reshape(first, f, bins) for v in (g, h)]
                left_g, left_h = (s.cumsum(2) for s in sums)
                all_g, all_h = left_g[:, :1, -1:], left_h[:, :1, -1:]
                right_g, right_h = all_g - left_g, all_h - left_h
                gain = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge) - all_g**2 / (all_h + ridge)
                gain[(left_h < least) | (right_h < least)] = 0
                best = gain.reshape(first, -1).argmax(1)
                for k in range(first):
                    j, b = divmod(int(best[k]), bins)
                    if gain[k, j, b] > 1e-6 and b < len(edges[j]):
                        feature[first + k], cut[first + k] = j, edges[j][b]
                node = 2 * node + (x[np.arange(n), feature[node]] > cut[node])
            leaf = node - (1 << depth)
            value = rate * np.bincount(leaf, g, minlength=1 << depth) / (np.bincount(leaf, h, minlength=1 << depth) + ridge)
            score += value[leaf]
            all_features.append(feature)
            all_cuts.append(cut)
            all_leaves.append(value)
        return cls(base, np.array(all_features), np.array(all_cuts), np.array(all_leaves))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of class one."""
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        depth = int(self.leaves.shape[1]).bit_length() - 1
        for feature, cut, value in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.ones(len(x), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + (x[rows, feature[node]] > cut[node])
            out += value[node - (1 << depth)]
        return out
