"""Gradient-boosted trees for two classes and isotonic calibration, on bounded samples of dense features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    """Nodes in order; a leaf has feature -1. Rows with a value at most the threshold go left."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), "i8")
        while True:
            feature = self.feature[node]
            inner = np.flatnonzero(feature >= 0)
            if not len(inner):
                return self.value[node]
            at = node[inner]
            goes_left = x[inner, feature[inner]] <= self.threshold[at]
            node[inner] = np.where(goes_left, self.left[at], self.right[at])


def grow(binned: np.ndarray, edges: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray, depth: int, ridge: float,
         least: float) -> Tree:
    """One tree on binned features, by the gain of second-order boosting."""
    feature, threshold, left, right, value = [], [], [], [], []

    def node(rows: np.ndarray, level: int) -> int:
        here = len(feature)
        g, h = gradient[rows].sum(), hessian[rows].sum()
        for column, x in ((feature, -1), (threshold, 0.0), (left, 0), (right, 0), (value, g / (h + ridge))):
            column.append(x)
        best = (1e-6, -1, 0)
        if level < depth:
            for f, cuts in enumerate(edges):
                if not len(cuts):
                    continue
                bins = binned[rows, f]
                gl = np.cumsum(np.bincount(bins, gradient[rows], len(cuts) + 1))[:-1]
                hl = np.cumsum(np.bincount(bins, hessian[rows], len(cuts) + 1))[:-1]
                gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
                gain[(hl < least) | (h - hl < least)] = 0
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (gain[at], f, at)
        if best[1] >= 0:
            goes_left = binned[rows, best[1]] <= best[2]
            feature[here], threshold[here] = best[1], edges[best[1]][best[2]]
            left[here] = node(rows[goes_left], level + 1)
            right[here] = node(rows[~goes_left], level + 1)
        return here

    node(np.arange(len(binned)), 0)
    return Tree(*(np.array(x) for x in (feature, threshold, left, right, value)))


class BoostedTrees:
    """Log-odds as a sum of small trees. With one class in the sample, or none, the prior alone."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64,
                 ridge: float = 1.0, least: float = 0.2):
        self.rate, self.trees = rate, []
        share = (y.sum() + 0.5) / (len(y) + 1)
        self.start = float(np.log(share / (1 - share)))
        if not len(y) or y.min() == y.max():
            return
        # a cut lies at a value of the sample; small values beside many zeros have cuts too
        edges = []
        for column in x.T:
            values = np.unique(column)
            if len(values) > bins:
                values = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1), method="lower"))
            edges.append((values[:-1] + values[1:]) / 2 if len(values) <= bins else values[:-1])
        binned = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)])
        margin = np.full(len(y), self.start)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            tree = grow(binned, edges, y - p, p * (1 - p), depth, ridge, least)
            self.trees.append(tree)
            margin += rate * tree.predict(x)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.start + self.rate * sum((t.predict(x) for t in self.trees), np.zeros(len(x)))


class Isotonic:
    """Share of positive rows as a rising function of the margin: pool adjacent violators, straight between the pools.

    Rows with one margin are one pool from the start. Shares are kept off 0 and 1 by a tenth of a row.
    """

    def __init__(self, margin: np.ndarray, y: np.ndarray):
        at, inverse = np.unique(np.round(margin, 9), return_inverse=True)
        positive, rows = np.bincount(inverse, y, len(at)), np.bincount(inverse, minlength=len(at))
        pools: list[list[float]] = []  # sum of y, rows, sum of margins
        for m, t, n in zip(at.tolist(), positive.tolist(), rows.tolist()):
            pools.append([t, n, m * n])
            while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last)]
        self.at = np.array([p[2] / p[1] for p in pools])
        self.share = np.maximum.accumulate([(p[0] + 0.05) / (p[1] + 0.1) for p in pools]) if pools else np.zeros(0)

    def score(self, margin: np.ndarray) -> np.ndarray:
        return np.interp(margin, self.at, self.share) if len(self.at) else 1 / (1 + np.exp(-margin))
