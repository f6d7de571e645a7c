"""Logistic regression in numpy, for samples of bounded size."""

from __future__ import annotations

import math

import numpy as np


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def fit_lasso(
    x: np.ndarray, target: np.ndarray, weight: np.ndarray, penalty: float, rounds: int = 400
) -> tuple[float, np.ndarray]:
    """(bias, weights) under an L1 penalty, by accelerated proximal gradient steps.

    Targets may lie between 0 and 1. Columns are scaled for the fit and the weights scaled back.
    """
    weight = weight / weight.sum()
    mean, spread = weight @ x, np.sqrt(weight @ (x - weight @ x) ** 2) + 1e-6
    scaled = (x - mean) / spread
    with_bias = np.hstack([np.ones((len(x), 1)), scaled])
    gram = (with_bias * weight[:, None]).T @ with_bias
    step = 4 / max(1e-9, np.linalg.eigvalsh(gram)[-1])
    beta = np.zeros(with_bias.shape[1])
    look, momentum = beta.copy(), 1.0
    for _ in range(rounds):
        slope = with_bias.T @ (weight * (logistic(with_bias @ look) - target))
        after = look - step * slope
        after[1:] = np.sign(after[1:]) * np.maximum(np.abs(after[1:]) - step * penalty, 0)
        grown = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        look = after + (momentum - 1) / grown * (after - beta)
        beta, momentum = after, grown
    plain = beta[1:] / spread
    return float(beta[0] - plain @ mean), plain
