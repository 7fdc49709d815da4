"""Singular values and right vectors of a small square matrix by way of its bidiagonal form.

Householder reflections make the matrix upper bidiagonal, dqds finds the squared singular
values to high relative accuracy, and twisted factorisations of the shifted triangular product
give one vector each. Vectors of values that almost agree are made orthogonal in their cluster.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(np.float64).eps)

#: Values nearer than this, relative to their size, are a cluster.
CLUSTER_GAP = 1e-3


def _reflector(x: np.ndarray) -> np.ndarray | None:
    """The unit vector whose reflection maps ``x`` to a multiple of the first unit vector."""
    scale = np.max(np.abs(x), initial=0.0)
    if scale == 0 or not np.any(x[1:]):
        return None
    v = x / scale
    v[0] += np.copysign(np.linalg.norm(v), v[0])
    return v / np.linalg.norm(v)


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of ``U.T @ matrix @ P``, and the orthogonal ``P``."""
    a = np.array(matrix, np.float64)
    d = len(a)
    right = np.eye(d)
    for k in range(d):
        v = _reflector(a[k:, k])
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k + 2 < d and (w := _reflector(a[k, k + 1 :])) is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ w, w)
            right[:, k + 1 :] -= 2 * np.outer(right[:, k + 1 :] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], int]:
    """One dqds transform; the last item is the place of the first negative pivot, or -1."""
    n = len(q)
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    if d < 0:
        return q, e, 0
    for i in range(n - 1):
        new_q[i] = d + e[i]
        t = q[i + 1] / new_q[i] if new_q[i] else 0.0
        new_e[i] = e[i] * t
        d = d * t - shift
        if d < 0:
            return q, e, i + 1
    new_q[-1] = d
    return new_q, new_e, -1


def squared_singular_values(diagonal: np.ndarray, superdiagonal: np.ndarray) -> np.ndarray:
    """All squared singular values of an unreduced upper bidiagonal matrix, largest first."""
    q, e = (diagonal**2).tolist(), (superdiagonal**2).tolist()
    floor = (EPS * 1e-2) ** 2 * max(max(q), max(e, default=0.0))
    found, moved = [], 0.0
    while q:
        if len(q) == 1:
            found.append(q[0] + moved)
            break
        if e[-1] <= EPS**2 * (q[-1] + moved) or e[-1] <= floor:
            found.append(q.pop() + moved)
            e.pop()
            continue
        cut = next((i for i in range(len(e)) if e[i] <= min(floor, EPS**2 * moved)), None)
        if cut is not None:  # both halves stand for themselves from here on
            for part_q, part_e in ((q[: cut + 1], e[:cut]), (q[cut + 1 :], e[cut + 1 :])):
                part = squared_singular_values(np.sqrt(part_q), np.sqrt(part_e))
                found.extend((part + moved).tolist())
            break
        # The smaller value of the last two rows of the triangular product is above the least one.
        high, low = q[-2] + (e[-3] if len(e) > 2 else 0.0), q[-1] + e[-1]
        off = q[-2] * e[-1]
        mean, half = (high + low) / 2, (high - low) / 2
        near = mean - np.hypot(half, np.sqrt(off))
        coupling = np.sqrt(q[-3] * e[-2]) if len(q) > 2 else 0.0
        for shift in (near * (1 - 4 * EPS), near - coupling, near * 0.75, near * 0.25, 0.0):
            if shift < 0:
                continue
            if shift and shift <= EPS * moved:
                shift = 0.0
            new_q, new_e, bad = _step(q, e, shift)
            if bad < 0:
                q, e, moved = new_q, new_e, moved + shift
                break
    return np.sort(np.array(found))[::-1]


def _twisted(diagonal: np.ndarray, superdiagonal: np.ndarray, value: float, start: np.ndarray | None = None) -> np.ndarray:
    """A unit vector of the triangular product at ``value``; with ``start``, one step of inverse iteration from it."""
    n = len(diagonal)
    pivots = (diagonal**2).tolist()
    lower = (superdiagonal / diagonal[:-1]).tolist()
    tiny = EPS * EPS * max(max(pivots), value, 1e-300)
    down, up = [0.0] * n, [0.0] * n  # pivots from the top and from the bottom
    left, right = [0.0] * (n - 1), [0.0] * (n - 1)
    s, stationary = -value, [0.0] * n
    for i in range(n):
        stationary[i] = s
        down[i] = s + pivots[i] or tiny
        if i < n - 1:
            left[i] = pivots[i] * lower[i] / down[i]
            s = left[i] * lower[i] * s - value
    p, progressive = pivots[-1] - value, [0.0] * n
    for i in range(n - 1, -1, -1):
        progressive[i] = p
        if i:
            up[i] = pivots[i - 1] * lower[i - 1] ** 2 + p or tiny
            t = pivots[i - 1] / up[i]
            right[i - 1] = lower[i - 1] * t
            p = p * t - value
    up[0] = progressive[0] or tiny
    twist = np.array(stationary) + np.array(progressive) + value
    z = np.zeros(n)
    r = int(np.argmin(np.abs(twist)))
    if start is None:
        z[r] = 1.0
    else:  # solve N D N.T z = start for the twisted factors
        y = start.copy()
        for i in range(r):
            y[i + 1] -= left[i] * y[i]
        for i in range(n - 2, r - 1, -1):
            y[i] -= right[i] * y[i + 1]
        z[:r] = y[:r] / np.array(down[:r])
        z[r + 1 :] = y[r + 1 :] / np.array(up[r + 1 :])
        z[r] = y[r] / (twist[r] or tiny)
    for i in range(r - 1, -1, -1):
        z[i] -= left[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] -= right[i] * z[i]
    return z / np.linalg.norm(z)


def _cluster(diagonal: np.ndarray, superdiagonal: np.ndarray, values: np.ndarray, seed: int) -> np.ndarray:
    """Orthonormal vectors of a cluster: inverse iteration, each orthogonal to those before, then Ritz vectors."""
    random = np.random.default_rng(seed)
    basis = np.zeros((len(diagonal), len(values)))
    for j, value in enumerate(values):
        z = _twisted(diagonal, superdiagonal, value)
        for step in range(8):
            for _ in range(2):
                z = z - basis[:, :j] @ (basis[:, :j].T @ z)
            size = np.linalg.norm(z)
            if step >= 2 and size > 0.5:
                break
            z = z / size if size > 1e-8 else random.standard_normal(len(z))
            z = _twisted(diagonal, superdiagonal, value * (1 + 2 * EPS * (j + 1)), z)
        basis[:, j] = z / np.linalg.norm(z)
    bidiagonal = np.diag(diagonal) + np.diag(superdiagonal, 1)
    image = bidiagonal @ np.linalg.qr(basis)[0]
    order, turn = np.linalg.eigh(image.T @ image)
    return np.linalg.qr(basis)[0] @ turn[:, np.argsort(order)[::-1]]


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest squared singular values and their right vectors (as columns).

    Fewer are returned where the rank is lower. A vector's largest entry is positive.
    """
    scale = float(np.max(np.abs(matrix), initial=0.0))
    if scale == 0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    diagonal, superdiagonal, right = bidiagonalise(matrix / scale)
    size = np.max(np.abs(diagonal)) + np.max(np.abs(superdiagonal), initial=0.0)
    # A zero pivot has no triangular factor; this much is below the rounding of the reduction.
    diagonal[np.abs(diagonal) < EPS * EPS * size] = EPS * EPS * size
    superdiagonal[np.abs(superdiagonal) <= EPS * 1e-2 * (np.abs(diagonal[:-1]) + np.abs(diagonal[1:]))] = 0.0
    cuts = [0, *(np.flatnonzero(superdiagonal == 0) + 1).tolist(), len(diagonal)]
    values, places = [], []
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        squares = squared_singular_values(diagonal[lo:hi], superdiagonal[lo : hi - 1])
        values.extend(squares.tolist())
        places.extend((lo, hi, k) for k in range(hi - lo))
    order = sorted(range(len(values)), key=lambda i: -values[i])[:count]
    order = [i for i in order if values[i] > (len(matrix) * EPS * size) ** 2]
    vectors = np.zeros((len(matrix), len(order)))
    made: dict[tuple[int, int], np.ndarray] = {}
    for column, i in enumerate(order):
        lo, hi, k = places[i]
        if (lo, hi) not in made:
            last = max(places[j][2] for j in order if places[j][:2] == (lo, hi))
            made[lo, hi] = _block_vectors(diagonal[lo:hi], superdiagonal[lo : hi - 1], np.array([values[j] for j in range(len(values)) if places[j][:2] == (lo, hi)]), last + 1)
        vectors[lo:hi, column] = made[lo, hi][:, k]
    vectors = right @ vectors
    signs = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(len(order))])
    return np.array([values[i] for i in order]) * scale**2, vectors * signs


def _block_vectors(diagonal: np.ndarray, superdiagonal: np.ndarray, values: np.ndarray, wanted: int) -> np.ndarray:
    """Vectors of the first ``wanted`` of an unreduced block's values, cluster by cluster."""
    if len(diagonal) == 1:
        return np.ones((1, 1))
    out, i = np.zeros((len(diagonal), wanted)), 0
    while i < wanted:
        j = i + 1
        while j < len(values) and values[j - 1] - values[j] < CLUSTER_GAP * values[j - 1]:
            j += 1
        part = _twisted(diagonal, superdiagonal, values[i])[:, None] if j == i + 1 else _cluster(diagonal, superdiagonal, values[i:j], i)
        out[:, i : min(j, wanted)] = part[:, : min(j, wanted) - i]
        i = j
    return out
