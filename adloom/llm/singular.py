"""Singular values and right singular vectors of a square matrix.

Householder steps make the matrix bidiagonal; the differential qd algorithm with
shifts (dqds) finds every singular value to high relative accuracy, and a twisted
factorisation of B'B at the value found gives its vector. Used on the small
triangular factor that stands for all rows, never on the rows.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(np.float64).eps)
_NEGLIGIBLE = (100 * EPS) ** 2


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """A unit vector u with (I - 2uu')x = alpha e1, and alpha."""
    norm = float(np.linalg.norm(x))
    if norm == 0.0:
        return np.zeros_like(x), 0.0
    alpha = -norm if x[0] >= 0 else norm
    u = x.astype(np.float64).copy()
    u[0] -= alpha
    return u / np.linalg.norm(u), alpha


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and V of matrix = U B V'; U is not kept."""
    work = np.array(matrix, np.float64)
    size = len(work)
    right = np.eye(size)
    for k in range(size):
        u, _ = _reflector(work[k:, k])
        work[k:, k:] -= 2.0 * np.outer(u, u @ work[k:, k:])
        if k + 2 < size:
            u, _ = _reflector(work[k, k + 1 :])
            work[k:, k + 1 :] -= 2.0 * np.outer(work[k:, k + 1 :] @ u, u)
            right[:, k + 1 :] -= 2.0 * np.outer(right[:, k + 1 :] @ u, u)
    return np.diagonal(work).copy(), np.diagonal(work, 1).copy(), right


def _qd_pass(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One dqds transform, or None when the shift is above the smallest eigenvalue."""
    new_q, new_e = [], []
    d = least = q[0] - shift
    for i, step in enumerate(e):
        if d < 0.0:
            return None
        pivot = d + step
        new_q.append(pivot)
        if pivot == 0.0:
            # Nothing couples the two parts: the next one starts afresh.
            new_e.append(0.0)
            d = q[i + 1] - shift
        else:
            ratio = q[i + 1] / pivot
            new_e.append(step * ratio)
            d = d * ratio - shift
        least = min(least, d)
    if d < 0.0:
        return None
    new_q.append(d)
    return new_q, new_e, least


def _low_shift(q: list[float], e: list[float]) -> float:
    """The smaller eigenvalue of the last two rows of B'B: above the smallest of all,
    and close to it once the end has nearly come apart."""
    a, b, c = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
    half = (a - b) / 2
    return max(0.0, b - c / (abs(half) + (half * half + c) ** 0.5) if half >= 0 and c > 0 else min(a, b) - (c**0.5 if c else 0.0))


def singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """All singular values of an upper bidiagonal matrix, falling."""
    scale = float(max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0)))
    if scale == 0.0:
        return np.zeros(len(diagonal))
    q = [float(a / scale) ** 2 for a in diagonal]
    e = [float(b / scale) ** 2 for b in above]
    found: list[float] = []
    sigma = 0.0
    budget = 60 * len(q) + 200
    while q:
        if len(q) == 1:
            found.append(sigma + q.pop())
            continue
        if e[-1] <= _NEGLIGIBLE * (sigma + q[-1]) or e[-1] <= EPS**4:
            found.append(sigma + q.pop())
            e.pop()
            continue
        if q[0] < q[-1]:
            # Small values leave at the end: a matrix graded the other way is turned over.
            q, e = q[::-1], e[::-1]
            if e[-1] <= _NEGLIGIBLE * (sigma + q[-1]):
                continue
        budget -= 1
        if budget < 0:
            raise ArithmeticError("the qd algorithm did not converge")
        shift = _low_shift(q, e) * (1 - 1e-9)
        done = None
        for attempt in (shift, shift * 0.5, shift * 0.05, 0.0):
            done = _qd_pass(q, e, attempt)
            if done is not None:
                break
        assert done is not None  # a pass without a shift cannot fail
        q, e, _ = done
        sigma += attempt
    return scale * np.sqrt(np.sort(np.array(found))[::-1])


def _twisted(diagonal: np.ndarray, above: np.ndarray, value: float, skip: int = 0) -> np.ndarray:
    """Eigenvector of B'B at ``value``: the stationary factors from the top and the
    progressive ones from the bottom meet where their twist element is smallest
    (``skip``: the next smallest, for a value met again)."""
    size = len(diagonal)
    q, e, off = diagonal**2, above**2, diagonal[:-1] * above
    tiny = EPS**2 * (float(q.max()) + (float(e.max()) if size > 1 else 0.0)) or EPS**2

    def safe(pivot: float) -> float:
        return pivot if abs(pivot) > tiny else (tiny if pivot >= 0 else -tiny)

    down, up = np.empty(size), np.empty(size)
    down_pivot, up_pivot = np.empty(max(size - 1, 0)), np.empty(max(size - 1, 0))
    down[0], up[-1] = -value, q[-1] - value
    for i in range(size - 1):
        down_pivot[i] = safe(down[i] + q[i])
        down[i + 1] = down[i] * (e[i] / down_pivot[i]) - value
    for i in range(size - 2, -1, -1):
        up_pivot[i] = safe(e[i] + up[i + 1])
        up[i] = up[i + 1] * (q[i] / up_pivot[i]) - value
    twist = int(np.argsort(np.abs(down + up + value), kind="stable")[skip % size])
    z = np.zeros(size)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -off[i] / down_pivot[i] * z[i + 1]
    for i in range(twist, size - 1):
        z[i + 1] = -off[i] / up_pivot[i] * z[i]
    return z / np.linalg.norm(z)


def _parts(diagonal: np.ndarray, above: np.ndarray) -> list[tuple[int, int]]:
    """Ranges that B'B does not couple: each has vectors of its own."""
    size = len(diagonal)
    off = np.abs(diagonal[:-1] * above)
    main = diagonal**2 + np.concatenate(([0.0], above**2))
    apart = off <= EPS * EPS * main.max()
    bounds = [0, *(np.flatnonzero(apart) + 1).tolist(), size]
    return list(zip(bounds[:-1], bounds[1:], strict=True))


def leading_directions(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest singular values of a square matrix, falling, and their
    right singular vectors as orthonormal columns; the entry of largest size is positive.

    Values that are zero to rounding come as exactly 0. Equal values have any
    orthonormal basis of their common space.
    """
    size = len(matrix)
    diagonal, above, right = bidiagonalise(matrix)
    found: list[tuple[float, int, int]] = []
    for low, high in _parts(diagonal, above):
        first = diagonal[low:high].copy()
        if low:
            # The coupling was negligible, what stands above this part is not: B'B has it
            # on its diagonal, so the part goes on with a bidiagonal factor of its own.
            block = np.diag(diagonal[low:high]) + np.diag(above[low : high - 1], 1)
            lead = np.zeros((1, high - low))
            lead[0, 0] = above[low - 1]
            block = np.linalg.qr(np.vstack([lead, block]), mode="r")
            first, inner = np.diagonal(block).copy(), np.diagonal(block, 1).copy()
        else:
            inner = above[low : high - 1]
        for value in singular_values(first, inner):
            found.append((float(value), low, high))
        diagonal[low:high] = first
        above[low : high - 1] = inner
    found.sort(key=lambda item: -item[0])
    top = found[0][0] if found else 0.0
    values, columns = [], []
    for value, low, high in found[:count]:
        zero = value <= size * EPS * top
        values.append(0.0 if zero else value)
        best = None
        for skip in range(high - low):
            z = np.zeros(size)
            z[low:high] = _twisted(diagonal[low:high], above[low : high - 1], value * value, skip)
            for _ in range(2):
                for known in columns:
                    z -= (known @ z) * known
            norm = float(np.linalg.norm(z))
            if norm > 0 and (best is None or norm > best[0]):
                best = (norm, z / norm)
            if norm > 0.5:
                break
        columns.append(best[1])
    vectors = right @ np.array(columns).T if columns else np.zeros((size, 0))
    for j in range(vectors.shape[1]):
        if vectors[np.argmax(np.abs(vectors[:, j])), j] < 0:
            vectors[:, j] *= -1
    return np.array(values), vectors
