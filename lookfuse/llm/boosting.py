"""Gradient-boosted trees for two classes, on binned features, in numpy."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Complete trees of one depth: per tree, features and thresholds by node in breadth-first order, and leaf values."""

    def __init__(self, start: float, features: np.ndarray, thresholds: np.ndarray, leaves: np.ndarray):
        self.start, self.features, self.thresholds, self.leaves = start, features, thresholds, leaves

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """The log odds of class 1 for each row."""
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        inner = self.features.shape[1]
        for features, thresholds, leaves in zip(self.features, self.thresholds, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            while inner and node.size and node[0] < inner:  # all rows are at one depth
                node = 2 * node + 1 + (x[rows, features[node]] > thresholds[node])
            total += leaves[node - inner]
        return total


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, leaf_penalty: float = 1.0, least: float = 5.0) -> BoostedTrees:
    """Newton boosting of the logistic loss. A node without a split that helps sends every row left."""
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], "left") for j in range(width)], 1)
    share = min(max(float(y.mean()), 1e-6), 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    odds, inner = np.full(n, start), 2**depth - 1
    all_features, all_thresholds, all_leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        gradient, curve = y - p, p * (1 - p)
        features, thresholds = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            local = node - first
            best = np.full(count, 1e-9)
            whole_g, whole_h = np.bincount(local, gradient, count), np.bincount(local, curve, count)
            for j in range(width):
                steps = len(cuts[j]) + 1
                if steps < 2:
                    continue
                at = local * steps + binned[:, j]
                g = np.bincount(at, gradient, count * steps).reshape(count, steps).cumsum(1)[:, :-1]
                h = np.bincount(at, curve, count * steps).reshape(count, steps).cumsum(1)[:, :-1]
                g_right, h_right = whole_g[:, None] - g, whole_h[:, None] - h
                gain = g**2 / (h + leaf_penalty) + g_right**2 / (h_right + leaf_penalty) - (whole_g**2 / (whole_h + leaf_penalty))[:, None]
                gain[(h < least / 4) | (h_right < least / 4)] = 0
                step = gain.argmax(1)
                top = gain[np.arange(count), step]
                better = top > best
                best[better] = top[better]
                features[first + np.flatnonzero(better)] = j
                thresholds[first + np.flatnonzero(better)] = cuts[j][step[better]]
            node = 2 * node + 1 + (x[np.arange(n), features[node]] > thresholds[node])
        leaf = node - inner
        values = rate * np.bincount(leaf, gradient, inner + 1) / (np.bincount(leaf, curve, inner + 1) + leaf_penalty)
        odds += values[leaf]
        all_features.append(features)
        all_thresholds.append(thresholds)
        all_leaves.append(values)
    return BoostedTrees(start, np.array(all_features), np.array(all_thresholds), np.array(all_leaves))
