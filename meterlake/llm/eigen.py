"""Leading eigenpairs of a symmetric matrix: tridiagonal form, bisection, inverse iteration."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
# Eigenvalues nearer than this, against the size of the matrix, are one cluster: inverse
# iteration alone would not keep their vectors apart.
CLUSTER = 1e-3
ITERATIONS = 5


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the reflections that lead there (Householder).

    The k-th reflection, a unit vector or one of zeros, is of the entries from k + 1 on.
    """
    a = np.array(matrix, dtype=np.float64)
    reflections = []
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        length = np.linalg.norm(v)
        v = v / length if length else v
        reflections.append(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
    return a.diagonal().copy(), a.diagonal(-1).copy(), reflections


def below(diagonal: np.ndarray, off: np.ndarray, points: np.ndarray) -> np.ndarray:
    """How many eigenvalues are smaller than each point: the signs of a Sturm sequence."""
    tiny = EPS * max(np.abs(off).max(initial=0), np.finfo(np.float64).tiny / EPS)
    q = np.ones(len(points))
    count = np.zeros(len(points), dtype=np.int64)
    squares = np.concatenate([[0.0], off**2])
    for d, square in zip(diagonal, squares, strict=True):
        q = d - points - square / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def largest(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The `k` largest eigenvalues, falling, each bisected until no number lies between."""
    n = len(diagonal)
    reach = np.zeros(n)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    low = np.full(k, (diagonal - reach).min())
    high = np.full(k, (diagonal + reach).max())
    width = max(np.abs(low[0]), np.abs(high[0])) * EPS
    low, high = low - 2 * width, high + 2 * width
    # the largest but i has n - 1 - i eigenvalues below it
    rank = n - 1 - np.arange(k)
    for _ in range(2000):
        middle = (low + high) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        right = below(diagonal, off, middle) <= rank
        low, high = np.where(right, middle, low), np.where(right, high, middle)
    return (low + high) / 2


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, tiny: float, b: np.ndarray) -> np.ndarray:
    """x of (T - shift) x = b, by elimination with row exchanges; pivots of at least `tiny`."""
    n = len(diagonal)
    main = diagonal - shift
    upper = np.append(off, 0.0)
    upper2 = np.zeros(n)
    x = b.copy()
    for i in range(n - 1):
        lower, next_main, next_upper = off[i], main[i + 1], upper[i + 1]
        if abs(lower) > abs(main[i]):
            factor = main[i] / lower
            main[i + 1] = upper[i] - factor * next_main
            upper[i + 1] = -factor * next_upper
            main[i], upper[i], upper2[i] = lower, next_main, next_upper
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            if abs(main[i]) < tiny:
                main[i] = tiny
            factor = lower / main[i]
            main[i + 1] = next_main - factor * upper[i]
            x[i + 1] -= factor * x[i]
    if abs(main[-1]) < tiny:
        main[-1] = tiny
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            x[i] -= upper[i] * x[i + 1]
        if i + 2 < n:
            x[i] -= upper2[i] * x[i + 2]
        x[i] /= main[i]
        if abs(x[i]) > 1e150:
            x /= abs(x[i])
    return x


def vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors, as columns, by inverse iteration.

    A vector is made orthogonal, in every step, to the ones before it whose eigenvalues
    are in its cluster. Equal eigenvalues are shifted apart by rounding errors.
    """
    n = len(diagonal)
    size = max(np.abs(diagonal).max(initial=0), np.abs(off).max(initial=0))
    tiny = max(EPS * size, np.finfo(np.float64).tiny)
    found = np.zeros((n, len(values)))
    first, shift = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * size:
            first = j
        shift = min(value, shift - 10 * tiny) if j > first else value
        x = np.random.default_rng(j).normal(size=n)
        x /= np.linalg.norm(x)
        near = found[:, first:j]
        for _ in range(ITERATIONS):
            x = _solve(diagonal, off, shift, tiny, x)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= near @ (near.T @ x)
            x /= np.linalg.norm(x)
        found[:, j] = x
    return found


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The `k` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors."""
    size = np.abs(matrix).max(initial=0)
    if not len(matrix) or not size:
        return np.zeros(0), np.zeros((len(matrix), 0))
    diagonal, off, reflections = tridiagonal(matrix / size)
    values = largest(diagonal, off, min(k, len(matrix)))
    found = vectors(diagonal, off, values)
    for i, v in reversed(list(enumerate(reflections))):
        found[i + 1 :] -= 2 * np.outer(v, v @ found[i + 1 :])
    return values * size, found
