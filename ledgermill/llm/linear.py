"""Small linear models for bounded training tables."""

from __future__ import annotations

import numpy as np


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the last is the intercept, which isn't penalised."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    weight = np.ones(len(x)) if weight is None else weight
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ w)
        slope = x.T @ (weight * (p - y)) + penalty * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w = w - step * min(1.0, 5.0 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 20) -> np.ndarray:
    """Weights of a linear support vector machine (squared hinge) by Newton steps; y is -1 or 1, the last weight the
    intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.ones(x.shape[1])
    penalty[-1] = 1e-3
    for _ in range(steps):
        active = y * (x @ w) < 1
        a, c = x[active], cost[active]
        new = np.linalg.solve((a * c[:, None]).T @ a + np.diag(penalty), a.T @ (c * y[active]))
        done = np.abs(new - w).max() < 1e-8
        w = new
        if done:
            break
    return w


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))
