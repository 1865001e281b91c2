"""Logistic regression by follow-the-regularised-leader updates (FTRL-proximal) over hashed features."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


class Ftrl:
    """Weights of ``size`` hashed features; the last one is the bias, which is not regularised."""

    def __init__(self, size: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.5, l2: float = 1.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == len(self.z) - 1, 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def update(self, at: np.ndarray, x: np.ndarray, label: float, weight: float = 1.0) -> None:
        """One example: distinct features ``at`` with values ``x``, and a label of 0 to 1."""
        at, x = np.append(at, len(self.z) - 1), np.append(x, 1.0)
        w = self.weights(at)
        g = (float(sigmoid(w @ x)) - label) * weight * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g

    def sparse(self) -> tuple[np.ndarray, np.ndarray, float]:
        """The features with a weight, their weights, and the bias."""
        w = self.weights(np.arange(len(self.z)))
        at = np.flatnonzero(w[:-1])
        return at.astype(np.int64), w[at], float(w[-1])


def fit(examples: list[tuple[np.ndarray, np.ndarray, float, float]], size: int, epochs: int = 3, seed: int = 7, **settings) -> tuple[np.ndarray, np.ndarray, float]:
    """Sparse weights and bias from (features, values, label, weight) examples; the order is drawn from ``seed``."""
    model, order = Ftrl(size, **settings), np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(examples)):
            model.update(*examples[i])
    return model.sparse()


def dense(at: Iterable[int], weights: Iterable[float], size: int) -> np.ndarray:
    out = np.zeros(size)
    out[np.asarray(at, np.int64)] = np.asarray(weights, np.float64)
    return out
