"""Follow-the-regularised-leader (proximal) for sparse linear models, on the driver over a bounded sample."""

from __future__ import annotations

import numpy as np


class Ftrl:
    """Per-coordinate rates, L1 and L2 penalty; one column of weights per class. With one column the
    loss is logistic, with more it is the multinomial one."""

    def __init__(self, dims: int, classes: int, alpha=0.1, beta=1.0, l1=1.0, l2=1.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((dims, classes))
        self.n = np.zeros((dims, classes))

    def weights(self, index=slice(None)) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def step(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        """``index`` holds no coordinate twice."""
        w = self.weights(index)
        logits = value @ w
        if len(logits) == 1:
            error = np.array([sigmoid(logits[0]) - label])
        else:
            error = softmax(logits)
            error[label] -= 1
        gradient = value[:, None] * error[None, :]
        n = self.n[index]
        grown = n + gradient * gradient
        self.z[index] += gradient - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * w
        self.n[index] = grown


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits under which the held-back labels are likeliest."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 120))
    rows = np.arange(len(labels))
    loss = [-np.log(np.maximum(softmax(logits / t)[rows, labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])
