"""Small models in numpy: boosted trees, isotonic regression, Platt scaling.

They are fitted on the driver, on samples whose size a parameter bounds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_DRAW = 1 << 30


def sample_of(rows: DataFrame, key: str, limit: int, seed: int = 7) -> DataFrame:
    """About ``limit`` rows at most, the same ones every time: those whose hashed
    key is below the limit's share of all rows. All rows if there are no more."""
    count = rows.count()
    share = min(1.0, limit / max(count, 1))
    draw = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(_DRAW))
    return rows.where(draw < int(share * _DRAW))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class BoostedTrees:
    """Gradient boosting for log loss: trees of fixed depth over binned features."""

    def __init__(self, trees=50, depth=3, rate=0.25, bins=48, least=6.0):
        self.trees, self.depth, self.rate, self.bins, self.least = trees, depth, rate, bins, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        x = x.astype(np.float64)
        mean = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
        self.base = float(np.log(mean / (1 - mean)))
        quantiles = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(c, quantiles)) if len(y) else c[:0] for c in x.T]
        binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(self.cuts, x.T)], 1)
        self.model, score = [], np.full(len(y), self.base)
        for _ in range(self.trees if 0 < y.sum() < len(y) else 0):
            p = sigmoid(score)
            tree, leaf = self._grow(binned, p - y, p * (1 - p))
            score += tree[2][leaf]
            self.model.append(tree)
        return self

    def _grow(self, binned, gradient, weight):
        inner = (1 << self.depth) - 1
        feature, cut = np.zeros(inner, int), np.full(inner, np.inf)
        node = np.zeros(len(gradient), int)
        for level in range(self.depth):
            begin, width = (1 << level) - 1, 1 << level
            best = np.full(width, 1e-6)
            split = np.full((width, 2), -1)
            for f, cuts in enumerate(self.cuts):
                size = len(cuts) + 1
                place = (node - begin) * size + binned[:, f]
                g, h = (
                    np.bincount(place, w, width * size).reshape(width, size)
                    for w in (gradient, weight)
                )
                gl, hl = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
                gs, hs = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                gain[np.minimum(hl, hs - hl) < self.least * 0.1] = 0
                if not gain.size:
                    continue
                top = gain.argmax(1)
                better = gain[np.arange(width), top] > best
                best[better] = gain[np.arange(width), top][better]
                split[better] = np.stack([np.full(width, f), top], 1)[better]
            for k in range(width):
                if split[k, 0] >= 0:
                    feature[begin + k] = split[k, 0]
                    cut[begin + k] = self.cuts[split[k, 0]][split[k, 1]]
            chosen, border = split[node - begin, 0], split[node - begin, 1]
            right = (chosen >= 0) & (binned[np.arange(len(node)), chosen] > border)
            node = 2 * node + 1 + right
        leaf = node - inner
        size = 1 << self.depth
        g, h = np.bincount(leaf, gradient, size), np.bincount(leaf, weight, size)
        return (feature, cut, -self.rate * g / (h + 1)), leaf

    def decide(self, x: np.ndarray) -> np.ndarray:
        """The log odds of each row."""
        score = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.model:
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            score += value[node - len(feature)]
        return score


class Isotonic:
    """The non-decreasing function nearest to the labels (pool adjacent violators).

    Between its levels it rises in a straight line; below the first and above the last
    it is flat.
    """

    def fit(self, x: np.ndarray, y: np.ndarray) -> Isotonic:
        levels, place = np.unique(x, return_inverse=True)
        sums, counts = np.bincount(place, y), np.bincount(place).astype(float)
        blocks: list[list[float]] = []  # first and last x, sum, count
        for level, s, c in zip(levels, sums, counts):
            blocks.append([level, level, s, c])
            while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
                _, last, s, c = blocks.pop()
                blocks[-1][1] = last
                blocks[-1][2] += s
                blocks[-1][3] += c
        self.at = np.array([end for b in blocks for end in b[:2]])
        self.value = np.repeat([b[2] / b[3] for b in blocks], 2)
        return self

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if not len(self.at):
            return sigmoid(x)
        return np.interp(x, self.at, self.value)


class Platt:
    """Logistic calibration of a score: two numbers, by damped Newton steps.

    A small penalty on the slope keeps it finite where the labels are separable.
    """

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Platt:
        if weight is None:
            weight = np.ones(len(y))
        share = weight / weight.mean()
        ones, zeros = (weight * y).sum(), (weight * (1 - y)).sum()
        target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
        centre = (share * x).mean()
        spread = np.sqrt((share * (x - centre) ** 2).mean())
        self.centre, self.scale = float(centre), float(spread + 1e-9)
        x = (x - self.centre) / self.scale
        a, b = 1.0, 0.0
        for _ in range(100):
            p = sigmoid(a * x + b)
            g, w = share * (p - target), share * np.maximum(p * (1 - p), 1e-9)
            cross = (w * x).mean()
            hessian = np.array([[(w * x * x).mean() + 1e-3, cross], [cross, w.mean() + 1e-6]])
            step = np.linalg.solve(hessian, [(g * x).mean() + 1e-3 * a, g.mean() + 1e-6 * b])
            step = np.clip(step, -1, 1)
            a, b = a - step[0], b - step[1]
            if abs(step).max() < 1e-6:
                break
        self.a, self.b = float(a), float(b)
        return self

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.a * (x - self.centre) / self.scale + self.b)
