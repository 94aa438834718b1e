"""Histogram gradient-boosted trees, flattened into arrays.

The fit runs on a bounded sample. A fitted model is a few flat arrays, small enough
to travel with a task, and scores many rows at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class TreeParams:
    trees: int = 60
    depth: int = 4
    rate: float = 0.15
    bins: int = 64
    ridge: float = 1.0
    least_weight: float = 2.0


@dataclass(frozen=True)
class FlatTrees:
    """All nodes of all trees in a row. A leaf is its own child, so every tree is walked the same number of steps."""

    base: float
    depth: int
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        nodes = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            low = x[rows, self.feature[nodes]] <= self.threshold[nodes]
            nodes = np.where(low, self.left[nodes], self.right[nodes])
        return self.base + self.value[nodes].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(x)))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Cuts between bins of each feature: midpoints around quantiles of the values that occur."""
    cuts = []
    for column in x.T:
        values = np.unique(column)
        middle = (values[1:] + values[:-1]) / 2
        if len(middle) >= bins:
            picks = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))
            middle = np.unique(middle[np.clip(np.searchsorted(middle, picks), 0, len(middle) - 1)])
        cuts.append(middle)
    return cuts


def fit_trees(x: np.ndarray, y: np.ndarray, params: TreeParams = TreeParams()) -> FlatTrees:
    """Trees for the log odds of ``y`` (0 or 1). Without rows the score is one half; with one class, close to it."""
    positive = (y.sum() + 1.0) / (len(y) + 2.0)
    base = float(np.log(positive / (1 - positive)))
    roots: list[int] = []
    feature, threshold, left, right, value = [], [], [], [], []

    def node() -> int:
        at = len(feature)
        for column, start in ((feature, 0), (threshold, 0.0), (left, at), (right, at), (value, 0.0)):
            column.append(start)
        return at

    if len(y) and 0 < y.sum() < len(y):
        cuts = _edges(x, params.bins)
        width = params.bins + 1
        binned = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T, strict=True)], axis=1)
        slots = binned + np.arange(x.shape[1]) * width
        cells = x.shape[1] * width
        margin = np.full(len(y), base)
        for _ in range(params.trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, p * (1 - p)
            root = node()
            roots.append(root)
            open_nodes, place = [root], np.zeros(len(y), np.int64)
            for level in range(params.depth + 1):
                count = len(open_nodes)
                live = place >= 0
                where = (place[live][:, None] * cells + slots[live]).ravel()
                shape = (count, x.shape[1], width)
                sums = [
                    np.bincount(where, np.repeat(v[live], x.shape[1]), count * cells).reshape(shape).cumsum(axis=2) for v in (grad, hess)
                ]
                g, h = sums
                all_g, all_h = g[:, :1, -1:], h[:, :1, -1:]
                gain = g**2 / (h + params.ridge) + (all_g - g) ** 2 / (all_h - h + params.ridge) - all_g**2 / (all_h + params.ridge)
                gain[(h < params.least_weight) | (all_h - h < params.least_weight)] = 0
                new_nodes: list[int] = []
                split: list[tuple[int, int, int, int] | None] = []
                for i, at in enumerate(open_nodes):
                    best = int(gain[i].argmax())
                    f, cut = divmod(best, width)
                    if level < params.depth and gain[i, f, cut] > 1e-6 and cut < len(cuts[f]):
                        feature[at], threshold[at] = f, float(cuts[f][cut])
                        left[at], right[at] = node(), node()
                        split.append((f, cut, len(new_nodes), len(new_nodes) + 1))
                        new_nodes += [left[at], right[at]]
                    else:
                        value[at] = float(-all_g[i, 0, 0] / (all_h[i, 0, 0] + params.ridge) * params.rate)
                        split.append(None)
                moved = np.full(len(y), -1)
                for i, s in enumerate(split):
                    mine = place == i
                    if s is None:
                        margin[mine] += value[open_nodes[i]]
                    else:
                        moved[mine] = np.where(binned[mine, s[0]] <= s[1], s[2], s[3])
                open_nodes, place = new_nodes, moved
                if not open_nodes:
                    break
    if not roots:
        roots.append(node())
    return FlatTrees(
        base,
        params.depth,
        np.array(roots),
        np.array(feature),
        np.array(threshold, float),
        np.array(left),
        np.array(right),
        np.array(value, float),
    )
