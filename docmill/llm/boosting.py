"""Gradient-boosted trees in numpy for several classes: binned features, second-order leaves, complete trees of equal depth."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Trees:
    """borders: upper borders of each feature's bins; per round and class a tree of `depth` levels, its inner nodes and leaves by level."""

    borders: list[np.ndarray]
    prior: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    leaf: np.ndarray
    depth: int

    def binned(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint8)
        for j, border in enumerate(self.borders):
            out[:, j] = np.searchsorted(border, x[:, j], side="left")
        return out

    def log_chances(self, x: np.ndarray) -> np.ndarray:
        """Natural logarithm of each row's chance of each class."""
        used, feature = np.unique(self.feature, return_inverse=True)
        feature, odds = feature.reshape(self.feature.shape), np.tile(self.prior, (len(x), 1))
        b = np.empty((len(x), len(used)), np.uint8)
        for at, j in enumerate(used):
            b[:, at] = np.searchsorted(self.borders[j], x[:, j], side="left")
        flat, rows = b.ravel(), np.arange(len(x)) * len(used)
        for r in range(len(feature)):
            for k in range(len(self.prior)):
                node = np.zeros(len(x), np.int64)
                for _ in range(self.depth):
                    node = 2 * node + 1 + (flat[rows + feature[r, k][node]] > self.bin[r, k][node])
                odds[:, k] += self.leaf[r, k][node - self.bin.shape[2]]
        return odds - np.logaddexp.reduce(odds, axis=1, keepdims=True)


def borders_of(x: np.ndarray) -> list[np.ndarray]:
    """Up to BINS - 1 borders a feature, at quantiles of its values."""
    out = []
    for column in x.T:
        values = np.unique(column)
        out.append((values[:-1] + values[1:]) / 2 if len(values) <= BINS else np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])))
    return out


def fit(x: np.ndarray, y: np.ndarray, classes: int, rounds: int = 60, depth: int = 4, rate: float = 0.3, ridge: float = 1.0, least: float = 2.0) -> Trees:
    """Trees for labels 0..classes - 1; features that never split cost nothing in scoring."""
    n, inner = len(x), (1 << depth) - 1
    share = (np.bincount(y, minlength=classes) + 1) / (n + classes)
    trees = Trees(borders_of(x), np.log(share), np.zeros((rounds, classes, inner), np.int64), np.full((rounds, classes, inner), 255, np.int64), np.zeros((rounds, classes, inner + 1)), depth)
    if not n:
        return trees
    b = trees.binned(x)
    several_bins = [j for j, border in enumerate(trees.borders) if len(border) > 1]
    two_bins = [j for j, border in enumerate(trees.borders) if len(border) == 1]
    # Candidate splits: every border of the first kind, then the one border of each of the second.
    column = np.array([j for j in several_bins for _ in range(BINS - 1)] + two_bins, np.int64)
    border = np.array([i for _ in several_bins for i in range(BINS - 1)] + [0] * len(two_bins), np.int64)
    if not len(column):
        return trees
    wide = len(several_bins) * BINS
    cell = b[:, several_bins].astype(np.int64) + np.arange(len(several_bins)) * BINS
    high = b[:, two_bins].astype(np.float32)
    odds, rows = np.tile(trees.prior, (n, 1)), np.arange(n)
    for r in range(rounds):
        chance = np.exp(odds - np.logaddexp.reduce(odds, axis=1, keepdims=True))
        for k in range(classes):
            pull, curve = chance[:, k] - (y == k), np.maximum(chance[:, k] * (1 - chance[:, k]), 1e-6)
            node = np.zeros(n, np.int64)
            for level in range(depth):
                first, several = (1 << level) - 1, 1 << level
                at = node - first
                key = (at[:, None] * wide + cell).ravel()
                spread = np.zeros((n, 2 * several), np.float32)
                spread[rows, at], spread[rows, at + several] = pull, curve
                right = (spread.T @ high).astype(float)
                lows, totals = [], []
                for values, above in ((pull, right[:several]), (curve, right[several:])):
                    total = np.bincount(at, values, several)[:, None]
                    each = np.bincount(key, np.repeat(values, len(several_bins)), several * wide).reshape(several, -1, BINS)
                    lows.append(np.concatenate([each.cumsum(axis=2)[:, :, :-1].reshape(several, -1), total - above], axis=1))
                    totals.append(total)
                (gl, hl), (gt, ht) = lows, totals
                gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                gain = np.where((hl >= least) & (ht - hl >= least), gain, 0)
                best = gain.argmax(axis=1)
                split = gain[np.arange(several), best] > 1e-9
                trees.feature[r, k, first : first + several] = np.where(split, column[best], 0)
                trees.bin[r, k, first : first + several] = np.where(split, border[best], 255)
                node = 2 * node + 1 + (b[rows, trees.feature[r, k][node]] > trees.bin[r, k][node])
            leaf = node - inner
            g, h = np.bincount(leaf, pull, inner + 1), np.bincount(leaf, curve, inner + 1)
            trees.leaf[r, k] = -rate * g / (h + ridge)
            odds[:, k] += trees.leaf[r, k][leaf]
    return trees
