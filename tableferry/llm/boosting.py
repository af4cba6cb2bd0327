"""Gradient-boosted trees for a binary label, in numpy: histogram splits, logistic loss, a calibrated probability."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass(frozen=True)
class Trees:
    feature: np.ndarray  # rounds x inner nodes
    cut: np.ndarray
    leaf: np.ndarray  # rounds x leaves
    start: float
    scale: float  # probability = sigmoid(scale * margin + shift)
    shift: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        depth = int(np.log2(self.leaf.shape[1]))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
            out += leaf[node - (len(leaf) - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.margin(x) + self.shift, -40, 40)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, held: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, penalty: float = 1.0) -> Trees:
    """Trees learned from the rows that are not ``held``; slope and shift of the probability from those that are (Platt)."""
    train, label = x[~held], y[~held].astype(float)
    inner, leaves = 2**depth - 1, 2**depth
    cuts = np.quantile(train, np.linspace(0, 1, BINS + 1)[1:-1], axis=0)  # BINS - 1 x features
    codes = np.stack([np.searchsorted(cuts[:, j], train[:, j], "left") for j in range(x.shape[1])], axis=1)
    share = np.clip(label.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    margin, features, limits, values = np.full(len(label), start), [], [], []
    columns = np.arange(x.shape[1])
    for _ in range(rounds):
        chance = _sigmoid(margin)
        slope, curve = chance - label, chance * (1 - chance)
        feature, limit, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(label), np.int64)
        for level in range(depth):
            for at in range(2**level - 1, 2 ** (level + 1) - 1):
                rows = np.flatnonzero(node == at)
                if len(rows):
                    slot = (codes[rows] + columns * BINS).ravel()
                    g, h = (np.bincount(slot, np.repeat(v[rows], len(columns)), len(columns) * BINS).reshape(-1, BINS).cumsum(axis=1) for v in (slope, curve))
                    gain = g**2 / (h + penalty) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + penalty)
                    j, b = np.unravel_index(gain[:, :-1].argmax(), (len(columns), BINS - 1))
                    feature[at], limit[at] = j, cuts[b, j]
            node = 2 * node + 1 + (train[np.arange(len(node)), feature[node]] > limit[node])
        place = node - inner
        leaf = -rate * np.bincount(place, slope, leaves) / (np.bincount(place, curve, leaves) + penalty)
        margin += leaf[place]
        features.append(feature)
        limits.append(limit)
        values.append(leaf)
    trees = Trees(np.array(features), np.array(limits), np.array(values), start, 1.0, 0.0)
    z, truth = (trees.margin(x[held]), y[held].astype(float)) if held.any() else (margin, label)
    # Platt's targets keep the slope finite where the held-out rows are separated.
    truth = np.where(truth > 0, (truth.sum() + 1) / (truth.sum() + 2), 1 / (len(truth) - truth.sum() + 2))
    scale, shift = 1.0, 0.0
    for _ in range(200):
        off = _sigmoid(scale * z + shift) - truth
        scale, shift = scale - 0.05 * float((off * z).mean()), shift - 0.05 * float(off.mean())
    return Trees(trees.feature, trees.cut, trees.leaf, start, max(scale, 1e-3), shift)
