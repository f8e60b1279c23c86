"""Gradient-boosted decision trees for a yes-or-no target, on binned features, in numpy."""

from __future__ import annotations

import io

import numpy as np

BINS = 32


class BoostedTrees:
    """Complete binary trees of one depth: inner nodes by level order with feature and threshold, leaves with values."""

    def __init__(self, base: float, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray):
        self.base, self.feature, self.threshold, self.value = base, feature, threshold, value

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2,
            ridge: float = 2.0, least: float = 4.0) -> BoostedTrees:
        n, features = x.shape
        share = float(np.clip((weight * y).sum() / max(weight.sum(), 1e-9), 1e-3, 1 - 1e-3)) if n else 0.5
        base = float(np.log(share / (1 - share)))
        inner = (1 << depth) - 1
        out = cls(base, np.zeros((trees, inner), np.int32), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
        if not n or y.min() == y.max():
            return out
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="nearest")) for f in range(features)]
        bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
        score = np.full(n, base)
        for tree in range(trees):
            p = 1 / (1 + np.exp(-score))
            g, h = weight * (p - y), weight * p * (1 - p) + 1e-9
            node = np.zeros(n, np.int64)
            for level in range(depth):
                first, width = (1 << level) - 1, 1 << level
                place = node - first
                best = np.full(width, 1e-6)
                where = [(0, np.inf)] * width
                sum_g, sum_h = np.bincount(place, g, width), np.bincount(place, h, width)
                whole = sum_g**2 / (sum_h + ridge)
                for f in range(features):
                    if not len(edges[f]):
                        continue
                    cell = place * (BINS + 1) + bins[f]
                    gl = np.bincount(cell, g, width * (BINS + 1)).reshape(width, -1).cumsum(axis=1)[:, :len(edges[f])]
                    hl = np.bincount(cell, h, width * (BINS + 1)).reshape(width, -1).cumsum(axis=1)[:, :len(edges[f])]
                    gr, hr = sum_g[:, None] - gl, sum_h[:, None] - hl
                    gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - whole[:, None]
                    gain[(hl < least / 4) | (hr < least / 4)] = -1
                    top = gain.argmax(axis=1)
                    for k in np.flatnonzero(gain[np.arange(width), top] > best):
                        best[k], where[k] = gain[k, top[k]], (f, edges[f][top[k]])
                for k, (f, t) in enumerate(where):
                    out.feature[tree, first + k], out.threshold[tree, first + k] = f, t
                right = x[np.arange(n), out.feature[tree, node]] > out.threshold[tree, node]
                node = 2 * node + 1 + right
            leaf = node - inner
            out.value[tree] = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
            score += out.value[tree][leaf]
        return out

    def logit(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            while inner and node.size and node[0] < inner:  # all rows are at one level
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            score += value[node - inner]
        return score

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, base=self.base, feature=self.feature, threshold=self.threshold, value=self.value)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> BoostedTrees:
        with np.load(io.BytesIO(data)) as z:
            return cls(float(z["base"]), z["feature"], z["threshold"], z["value"])
