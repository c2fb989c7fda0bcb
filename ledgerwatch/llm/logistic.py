"""Logistic regression on a small table of features, by Newton steps."""

from __future__ import annotations

import numpy as np


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights with the intercept last, means, deviations) of a ridge logistic regression on standardised features.

    With one class only, or no rows, the weights are zero but for the intercept, which gives the smoothed share of ones.
    """
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
    deviation = np.maximum(x.std(axis=0), 1e-6) if len(x) else np.ones(x.shape[1])
    w = np.zeros(x.shape[1] + 1)
    w[-1] = np.log(share / (1 - share))
    if len(y) == 0 or y.min() == y.max():
        return w, mean, deviation
    z = np.hstack([(x - mean) / deviation, np.ones((len(x), 1))])
    penalty = np.append(np.full(x.shape[1], ridge), 1e-6)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hessian, z.T @ (y - p) - penalty * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, deviation


def predict_logistic(x: np.ndarray, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    w, mean, deviation = model
    return 1 / (1 + np.exp(-np.clip(((x - mean) / deviation) @ w[:-1] + w[-1], -30, 30)))
