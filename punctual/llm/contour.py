"""Eigenpairs of a symmetric matrix by contour integration (FEAST).

The spectral projector onto an interval is an integral of the resolvent along a
circle around it. Quadrature turns it into a few solves with complex shifts; it
is applied to a block of vectors, whose span then holds the wanted eigenvectors,
and Rayleigh-Ritz takes them out. Repeating that filters out the rest.

How many eigenvalues lie below a number is the inertia of the matrix shifted by
it: the negative pivots of its elimination, which a tridiagonal form gives for
many shifts at once. These counts place every interval around eigenvalues that
lie closely together, as far from all others as the spectrum allows, size the
block, and prove in the end that no eigenvalue is missed.

The matrices here are as wide as a vector, whatever the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EPS = float(np.finfo(np.float64).eps)


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and side diagonal of an orthogonally similar matrix, by reflections."""
    a = np.array(matrix, np.float64)
    n = len(a)
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        length = np.linalg.norm(v)
        if not length:
            continue
        v[0] += np.copysign(length, v[0])
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        w = rest @ v
        w -= (v @ w) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1, k] = -np.copysign(length, a[k + 1, k])
    return a.diagonal().copy(), a.diagonal(-1).copy()


def below(form: tuple[np.ndarray, np.ndarray], shifts: np.ndarray) -> np.ndarray:
    """Eigenvalues less than each shift: negative pivots of the shifted matrix."""
    diagonal, side = form
    shifts = np.asarray(shifts, np.float64)
    size = max(np.abs(diagonal).max(initial=0.0), np.abs(side).max(initial=0.0))
    least = max(EPS * EPS * size, np.finfo(np.float64).tiny)
    negative = np.zeros(shifts.shape, np.int64)
    pivot = np.ones(shifts.shape)
    for d, e in zip(diagonal, np.concatenate([[0.0], side])):
        pivot = (d - shifts) - e * e / pivot
        # a pivot of zero counts as a negative one of rounding size
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        negative += pivot < 0
    return negative


@dataclass(frozen=True)
class Interval:
    """The eigenvalues in [low, high), ``count`` of them."""

    low: float
    high: float
    count: int


def intervals(matrix: np.ndarray, wanted: int, floor: float, steps: int = 32) -> list[Interval]:
    """Intervals, falling, around the ``wanted`` largest eigenvalues not below
    ``floor``; the last one may hold more, if they lie too closely together."""
    n = len(matrix)
    form = tridiagonal(matrix)
    # no eigenvalue is larger than the largest row sum; halve for each by itself
    bound = float(np.abs(matrix).sum(axis=1).max()) * (1 + 8 * n * EPS) + np.finfo(np.float64).tiny
    low, high = np.full(n, -bound), np.full(n, bound)
    rank = np.arange(n - 1, -1, -1)  # eigenvalues below the i-th largest
    for _ in range(steps):
        middle = (low + high) / 2
        under = below(form, middle) <= rank
        low, high = np.where(under, middle, low), np.where(under, high, middle)
    # apart: from the next smaller one by more than a millionth of the spectrum
    gaps = low[:-1] - high[1:]
    ends = [*np.flatnonzero(gaps > 2e-6 * bound).tolist(), n - 1]
    found, start = [], 0
    for end in ends:
        if start >= wanted or high[start] < floor:
            break
        free = min(
            gaps[start - 1] if start else 2 * bound, gaps[end] if end < n - 1 else 2 * bound
        )
        # half of the way to the nearest other eigenvalue on both sides
        part = (low[end] - free / 2, high[start] + free / 2)
        count = int(np.diff(below(form, np.array(part)))[0])
        found.append(Interval(*map(float, part), count))
        start = end + 1
    return found


def eigenpairs(
    matrix: np.ndarray, part: Interval, nodes: int = 8, most_rounds: int = 40, seed: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """All eigenvalues in an interval, falling, and their unit eigenvectors.

    Raises ArithmeticError unless as many pairs as the inertia counts solve the
    matrix to rounding.
    """
    n = len(matrix)
    centre, radius = (part.low + part.high) / 2, (part.high - part.low) / 2
    size = min(n, part.count + max(4, part.count // 2))
    points, weights = np.polynomial.legendre.leggauss(nodes)
    turn = np.exp(0.5j * np.pi * (1 - points))  # upper half; the lower one is its mirror image
    block = np.random.default_rng(seed).standard_normal((n, size))
    norm = float(np.abs(matrix).sum(axis=1).max())
    eye = np.eye(n)
    for _ in range(most_rounds):
        filtered = np.zeros((n, block.shape[1]))
        for point, weight in zip(turn, weights):
            shifted = (centre + radius * point) * eye - matrix
            solved = np.linalg.solve(shifted, block.astype(np.complex128))
            filtered += weight / 2 * (radius * point * solved).real
        # an orthonormal basis of the filtered span, and the matrix within it
        basis, scales, _ = np.linalg.svd(filtered, full_matrices=False)
        basis = basis[:, scales > scales[0] * EPS * n]
        values, small = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ small
        residual = np.linalg.norm(matrix @ block - block * values, axis=0)
        inside = (values >= part.low) & (values < part.high) & (residual <= 8 * n * EPS * norm)
        if np.count_nonzero(inside) == part.count:
            return values[inside][::-1], block[:, inside][:, ::-1]
    raise ArithmeticError(
        f"{np.count_nonzero(inside)} of {part.count} eigenvalues found in {part}"
    )


def largest(matrix: np.ndarray, wanted: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues not below ``floor`` (fewer if there are
    fewer), falling, with unit eigenvectors as columns, whose largest entry is
    positive."""
    n = len(matrix)
    if not np.any(matrix):
        return np.zeros(0), np.zeros((n, 0))
    pairs = [eigenpairs(matrix, part) for part in intervals(matrix, wanted, floor)]
    values = np.concatenate([np.zeros(0), *(p[0] for p in pairs)])
    vectors = np.concatenate([np.zeros((n, 0)), *(p[1] for p in pairs)], axis=1)
    real = np.flatnonzero(values >= floor)[:wanted]
    values, vectors = values[real], vectors[:, real]
    if not len(values):
        return values, vectors
    # neighbouring intervals' vectors are made orthogonal to rounding
    upright, _ = np.linalg.qr(vectors)
    top = upright[np.abs(upright).argmax(axis=0), np.arange(len(values))]
    return values, upright * np.sign(top)
