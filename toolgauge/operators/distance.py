"""Small numpy helpers that run inside Spark tasks on one block of vectors."""

from __future__ import annotations

import numpy as np

# Below this share of the squared norms the product form loses too many digits.
_CANCELLATION = 1e-6


def matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def direct(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise Euclidean distances of two equally long blocks; the same both ways."""
    return np.sqrt(np.sum((a - b) ** 2, axis=1))


def pairwise(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances between two blocks, near-equal vectors recomputed directly."""
    a2, b2 = np.sum(a * a, axis=1), np.sum(b * b, axis=1)
    squares = np.maximum(a2[:, None] + b2[None, :] - 2.0 * (a @ b.T), 0.0)
    i, j = np.nonzero(squares <= _CANCELLATION * (a2[:, None] + b2[None, :]))
    distances = np.sqrt(squares)
    distances[i, j] = direct(a[i], b[j])
    return distances
