"""Linear support vector machines by dual coordinate descent on sparse rows."""

from __future__ import annotations

import numpy as np


def train_svm(
    rows: list[tuple[np.ndarray, np.ndarray]],
    signs: np.ndarray,
    dim: int,
    cost: float = 1.0,
    epochs: int = 12,
    seed: int = 7,
) -> np.ndarray:
    """Weights of an L2-regularised machine with hinge loss; classes weigh the same in total.

    ``rows`` are ``(indices, values)`` pairs, ``signs`` +1 or -1. The order of the coordinates is
    drawn from ``seed``, so equal input gives equal weights.
    """
    n = len(rows)
    weights = np.zeros(dim)
    if n == 0:
        return weights
    positive = max(int((signs > 0).sum()), 1)
    negative = max(n - positive, 1)
    upper = np.where(signs > 0, cost * n / (2 * positive), cost * n / (2 * negative))
    squares = np.array([float(v @ v) for _, v in rows])
    alpha = np.zeros(n)
    generator = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in generator.permutation(n):
            if squares[i] == 0.0:
                continue
            index, value = rows[i]
            sign = signs[i]
            gradient = sign * float(weights[index] @ value) - 1.0
            new = min(max(alpha[i] - gradient / squares[i], 0.0), upper[i])
            step = new - alpha[i]
            if step:
                weights[index] += (step * sign) * value
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights
