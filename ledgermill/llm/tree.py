"""A small binary decision tree (CART with the Gini impurity) for tables of a few hundred rows."""

from __future__ import annotations

import numpy as np


def _gini(y: np.ndarray) -> float:
    p = y.mean() if len(y) else 0.0
    return 2 * p * (1 - p)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 5, least: int = 2):
    """A leaf (share of ones) or (column, threshold, tree for values up to it, tree for larger ones)."""
    if depth == 0 or len(y) < 2 * least or y.min() == y.max():
        return float(y.mean())
    best = None
    for column in range(x.shape[1]):
        values = np.unique(x[:, column])
        for threshold in (values[1:] + values[:-1]) / 2:
            left = x[:, column] <= threshold
            n = int(left.sum())
            if min(n, len(y) - n) >= least:
                impurity = (n * _gini(y[left]) + (len(y) - n) * _gini(y[~left])) / len(y)
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, column, float(threshold))
    if best is None or best[0] >= _gini(y) - 1e-12:
        return float(y.mean())
    _, column, threshold = best
    left = x[:, column] <= threshold
    return column, threshold, grow(x[left], y[left], depth - 1, least), grow(x[~left], y[~left], depth - 1, least)


def predict(tree, x: np.ndarray) -> np.ndarray:
    """The leaf value of each row."""
    if isinstance(tree, float):
        return np.full(len(x), tree)
    column, threshold, low, high = tree
    left = x[:, column] <= threshold
    out = np.empty(len(x))
    out[left], out[~left] = predict(low, x[left]), predict(high, x[~left])
    return out
