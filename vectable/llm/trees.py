"""Gradient-boosted trees for two classes, on samples that fit into one task."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    """A full binary tree in level order: node ``i`` has the children ``2i + 1`` (at most) and ``2i + 2``.

    ``feature`` is -1 at a leaf; ``value`` is what a leaf adds to the log odds.
    """

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def predict(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), np.int64)
        every = np.arange(len(rows))
        while True:
            feature = self.feature[node]
            inner = feature >= 0
            if not inner.any():
                return self.value[node]
            over = rows[every, np.maximum(feature, 0)] > self.threshold[node]
            node = np.where(inner, 2 * node + 1 + over, node)

    def paths(self) -> list[tuple[tuple[int, bool, float], ...]]:
        """Every way from the root to another node, as ``(feature, above, threshold)`` conditions."""
        found = []

        def walk(node: int, conditions: tuple) -> None:
            if conditions:
                found.append(conditions)
            if self.feature[node] >= 0:
                for above in (False, True):
                    step = (int(self.feature[node]), above, float(self.threshold[node]))
                    walk(2 * node + 1 + above, (*conditions, step))

        walk(0, ())
        return found


def log_odds(trees: list[Tree], start: float, rows: np.ndarray) -> np.ndarray:
    return start + sum((tree.predict(rows) for tree in trees), np.zeros(len(rows)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit_trees(
    rows: np.ndarray,
    label: np.ndarray,
    rounds: int = 40,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 32,
    least: int = 10,
    ridge: float = 1.0,
) -> tuple[list[Tree], float]:
    """Trees and the log odds they start from; each split is the best of ``bins`` quantiles per feature."""
    n, width = rows.shape
    share = np.clip(label.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    if not n:
        return [], start
    points = np.linspace(0, 1, bins + 1)[1:-1]
    edges = [np.unique(np.quantile(rows[:, f], points, method="lower")) for f in range(width)]
    codes = np.stack([np.searchsorted(edges[f], rows[:, f]) for f in range(width)], 1)  # > edge k: code > k
    odds = np.full(n, start)
    size = (2 << depth) - 1
    trees = []
    for _ in range(rounds):
        guess = sigmoid(odds)
        slope, curve = label - guess, guess * (1 - guess)
        tree = Tree(np.full(size, -1), np.zeros(size), np.zeros(size))
        node = np.zeros(n, np.int64)
        for level in range(depth + 1):
            first = (1 << level) - 1
            for one in range(first, 2 * first + 1):
                own = np.flatnonzero(node == one)
                if not len(own):
                    continue
                total, weight = slope[own].sum(), curve[own].sum()
                tree.value[one] = rate * total / (weight + ridge)
                best = (1e-6, -1, 0.0, 0)
                if level < depth and len(own) >= 2 * least:
                    for f in range(width):
                        if not len(edges[f]):
                            continue
                        code = codes[own, f]
                        k = len(edges[f]) + 1
                        low = np.cumsum(np.bincount(code, slope[own], k))[:-1]
                        low_weight = np.cumsum(np.bincount(code, curve[own], k))[:-1]
                        count = np.cumsum(np.bincount(code, minlength=k))[:-1]
                        gain = low**2 / (low_weight + ridge) + (total - low) ** 2 / (weight - low_weight + ridge)
                        gain = gain - total**2 / (weight + ridge)
                        gain[(count < least) | (len(own) - count < least)] = 0
                        at = int(np.argmax(gain))
                        if gain[at] > best[0] * (1 + 1e-9):
                            best = (float(gain[at]), f, float(edges[f][at]), at)
                if best[1] >= 0:
                    tree.feature[one], tree.threshold[one] = best[1], best[2]
                    node[own] = 2 * one + 1 + (codes[own, best[1]] > best[3])
        odds = odds + tree.value[node]
        trees.append(tree)
    return trees, start
