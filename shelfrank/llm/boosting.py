"""Small gradient-boosted trees for a bounded labelled sample (logistic loss)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    """Complete trees of equal depth: inner nodes' features and cuts, leaves' values."""

    base: float
    features: np.ndarray  # (trees, 2**depth - 1)
    cuts: np.ndarray
    leaves: np.ndarray  # (trees, 2**depth)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        inner = self.features.shape[1]
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(x), int)
            while node.size and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 40,
    depth: int = 4,
    rate: float = 0.2,
    bins: int = 24,
    ridge: float = 1.0,
) -> Boosted:
    """Second-order boosting over cuts at each feature's quantiles."""
    levels = np.linspace(0, 1, bins + 1)[1:-1]
    cuts = np.quantile(x, levels, axis=0, method="lower")
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts.T, x.T, strict=True)], 1)
    count = x.shape[1]
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    margin = np.full(len(y), base)
    offset = np.arange(count) * bins
    made = ([], [], [])
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = p - y, p * (1 - p)
        node = np.zeros(len(y), int)
        features, places = [], []
        for level in range(depth):
            slots = ((node * count * bins)[:, None] + offset + binned).ravel()
            size = (1 << level) * count * bins
            sums = [
                np.bincount(slots, np.repeat(v, count), size).reshape(-1, count, bins)
                for v in (gradient, weight)
            ]
            left = [s.cumsum(2)[:, :, :-1] for s in sums]
            both = [s.sum(2, keepdims=True) for s in sums]
            gain = left[0] ** 2 / (left[1] + ridge)
            gain = gain + (both[0] - left[0]) ** 2 / (both[1] - left[1] + ridge)
            best = gain.reshape(len(gain), -1).argmax(1)
            feature, place = np.divmod(best, bins - 1)
            features.extend(feature)
            places.extend(place)
            node = 2 * node + (binned[np.arange(len(y)), feature[node]] > place[node])
        g = np.bincount(node, gradient, 1 << depth)
        h = np.bincount(node, weight, 1 << depth)
        leaf = -rate * g / (h + ridge)
        margin += leaf[node]
        feature, place = np.array(features), np.array(places)
        made[0].append(feature)
        made[1].append(cuts[place, feature])
        made[2].append(leaf)
    return Boosted(base, *map(np.array, made))


def calibrated_threshold(score: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest score whose isotonic estimate of P(y = 1) reaches ``precision``."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # score where it begins, sum, rows; means rise
    for s, v in zip(score[order], y[order], strict=True):
        blocks.append([s, v, 1])
        while len(blocks) > 1 and (
            blocks[-2][0] == blocks[-1][0]
            or blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]
        ):
            _, total, rows = blocks.pop()
            blocks[-1][1] += total
            blocks[-1][2] += rows
    return next((s for s, total, rows in blocks if total / rows >= precision), np.inf)
