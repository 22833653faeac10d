"""The largest eigenvalues of a symmetric matrix and their vectors, by contour integration.

The spectrum is cut into slices of few eigenvalues. In each, an integral around the slice over solutions of complex
shifted systems projects a random subspace onto the wanted vectors; Rayleigh-Ritz extracts them, and the projection is
repeated on what it found until the residuals vanish. How many eigenvalues a slice has is known beforehand from the inertia of
the matrix shifted by its ends (the number of negative pivots), so none can be missed.

The matrix has as many rows as vectors have dimensions, whatever the number of vectors.
"""

from __future__ import annotations

import numpy as np

NODES = 12  # of the quadrature on half of a contour
SLICE = 8  # eigenvalues wanted in a slice
ROUNDS = 40
TOLERANCE = 4e-15  # residual of a vector against the norm of the matrix, for each dimension


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The diagonal and the one beside it of an orthogonally similar matrix, by Householder reflections."""
    a = np.array(matrix, float)
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        x[0] += norm if x[0] >= 0 else -norm
        v = x / np.linalg.norm(x)
        a[k + 1 :, k:] -= 2 * np.outer(v, v @ a[k + 1 :, k:])
        a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def n_below(diagonal: np.ndarray, beside: np.ndarray, shift: float) -> int:
    """Eigenvalues below ``shift``: the negative pivots of the shifted matrix (Sylvester's law of inertia)."""
    tiny = np.finfo(float).tiny ** 0.5
    count, pivot = 0, 1.0
    for k, value in enumerate(diagonal):
        pivot = value - shift - (beside[k - 1] ** 2 / pivot if k else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot < 0
    return count


def slices(diagonal: np.ndarray, beside: np.ndarray, low: float, high: float, width: float) -> list[tuple[float, float, int]]:
    """Intervals with at most ``SLICE`` eigenvalues, or narrower than ``width``: ``low, high, number``, without empty ones."""
    below = {x: n_below(diagonal, beside, x) for x in (low, high)}
    todo, out = [(low, high)], []
    while todo:
        a, b = todo.pop()
        count = below[b] - below[a]
        if count == 0:
            continue
        if count <= SLICE or b - a <= width:
            out.append((a, b, count))
            continue
        middle = a + (b - a) / 2
        below[middle] = n_below(diagonal, beside, middle)
        todo += [(a, middle), (middle, b)]
    return out


def in_interval(matrix: np.ndarray, low: float, high: float, count: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues from ``low`` to ``high`` and their vectors."""
    n = len(matrix)
    norm = np.abs(matrix).sum(axis=1).max()
    # half a circle around the interval; the other half is its mirror image
    points, weights = np.polynomial.legendre.leggauss(NODES)
    centre, radius = (low + high) / 2, (high - low) / 2
    turns = np.exp(1j * np.pi * (1 - points) / 2)
    inverses = [np.linalg.inv((centre + radius * t) * np.eye(n) - matrix) for t in turns]
    random = np.random.default_rng(seed)
    size = min(n, count + max(4, count // 2))
    found, least = np.empty(0), None
    while True:
        basis = random.standard_normal((n, size))
        for _ in range(ROUNDS):
            projected = sum((w * radius / 2 * (t * (inverse @ basis))).real for w, t, inverse in zip(weights, turns, inverses))
            basis, _ = np.linalg.qr(projected)
            values, inner = np.linalg.eigh(basis.T @ matrix @ basis)
            vectors = basis @ inner
            residuals = np.linalg.norm(matrix @ vectors - vectors * values, axis=0)
            # an end of the interval may lie on an eigenvalue up to rounding
            slack = n * np.finfo(float).eps * norm
            inside = (values >= low - slack) & (values <= high + slack)
            good = inside & (residuals <= TOLERANCE * n * norm)
            if good.sum() >= count and good.sum() == inside.sum():
                order = np.argsort(np.abs(values[good] - centre))[:count]
                return values[good][order], vectors[:, good][:, order]
            found, least = values[inside], residuals[inside].max(initial=0)
            basis = vectors
        if size == n:
            raise ArithmeticError(f"{count} eigenvalues from {low} to {high}, found {len(found)} with residuals up to {least}")
        size = min(n, 2 * size)


def largest(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``count`` of the largest eigenvalues over rounding error, falling, and unit vectors as columns.

    The largest entry of each vector is positive.
    """
    n = len(matrix)
    scale = float(np.trace(matrix))
    if n == 0 or not scale > 0:
        return np.empty(0), np.empty((n, 0))
    unit = matrix / scale  # eigenvalues from 0 to 1
    diagonal, beside = tridiagonal(unit)
    floor, top = n * 4 * np.finfo(float).eps, 1 + 1e-9
    low = floor
    if n - n_below(diagonal, beside, floor) > count:
        # close in on a value with ``count`` or few more eigenvalues above it
        high = top
        while high - low > 1e-3 * high:
            middle = (low + high) / 2
            above = n - n_below(diagonal, beside, middle)
            low, high = (middle, high) if above >= count else (low, middle)
            if above == count:
                break
    parts = [in_interval(unit, a, b, c) for a, b, c in slices(diagonal, beside, low, top, 1e-6 * top)]
    if not parts:
        return np.empty(0), np.empty((n, 0))
    expected = n_below(diagonal, beside, top) - n_below(diagonal, beside, low)
    vectors = np.concatenate([v for _, v in parts], axis=1)
    if vectors.shape[1] != expected:
        raise ArithmeticError(f"{vectors.shape[1]} of {expected} eigenvalues found")
    # vectors of neighbouring slices become orthogonal to the last digit
    basis, _ = np.linalg.qr(vectors)
    values, inner = np.linalg.eigh(basis.T @ unit @ basis)
    order = np.argsort(-values)[:count]
    vectors = basis @ inner[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return values[order] * scale, vectors * signs
