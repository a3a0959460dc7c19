"""Eigenpairs of a symmetric matrix in an interval, by contour integration.

The matrix is one of d x d entries on the driver, where d is the vectors'
dimension; it does not grow with the rows.
"""

from __future__ import annotations

import numpy as np

NODES = 8  # quadrature points on the upper half of a contour
ROUNDS = 40
PER_INTERVAL = 8  # eigenvalues that an interval should hold at most


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a similar tridiagonal matrix
    (Householder reflections)."""
    a = a.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        size = np.linalg.norm(x)
        if size == 0:
            continue
        x[0] += np.copysign(size, x[0])
        x /= np.linalg.norm(x)
        b = a[k + 1:, k + 1:]
        p = b @ x
        p -= (x @ p) * x
        b -= 2 * np.outer(x, p) + 2 * np.outer(p, x)
        a[k + 1:, k] = a[k, k + 1:] = 0
        a[k + 1, k] = a[k, k + 1] = -np.copysign(size, x[0])
    return np.diag(a).copy(), np.diag(a, 1).copy()


def above(t: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """Number of eigenvalues above ``shift``: the positive pivots of the shifted
    matrix's LDL^T factors (its inertia)."""
    d, e = t
    tiny = np.finfo(float).tiny
    q, n = 1.0, 0
    for i in range(len(d)):
        q = d[i] - shift - (e[i - 1] ** 2 / q if i else 0.0)
        if abs(q) < tiny:
            q = -tiny
        n += q > 0
    return n


def in_interval(a: np.ndarray, low: float, high: float, count: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs between ``low`` and ``high``. The subspace is
    filtered by quadrature of the resolvent around the interval and solved by
    Rayleigh-Ritz, until that many pairs have residuals at rounding level."""
    n = len(a)
    size = min(n, max(count + 4, 2 * count))
    q = np.linalg.qr(np.random.default_rng(13).standard_normal((n, size)))[0]
    x, w = np.polynomial.legendre.leggauss(NODES)
    angle = np.pi * (1 + x) / 2
    centre, radius = (low + high) / 2, (high - low) / 2
    step = radius * np.exp(1j * angle)
    eye = np.eye(n)
    best = None
    for _ in range(ROUNDS):
        y = np.zeros_like(q)
        for z, weight in zip(step, w):
            y += weight / 2 * (z * np.linalg.solve((centre + z) * eye - a, q.astype(complex))).real
        q = np.linalg.qr(y)[0]
        values, small = np.linalg.eigh(q.T @ a @ q)
        vectors = q @ small
        inside = np.flatnonzero((values > low) & (values < high))
        if len(inside) >= count:
            residual = np.linalg.norm(a @ vectors[:, inside] - vectors[:, inside] * values[inside], axis=0)
            # a mixture of outer vectors may lie inside for many rounds: it has a large residual
            inside = inside[np.sort(np.argsort(residual, kind="stable")[:count])]
            worst = np.sort(residual)[:count].max(initial=0)
            if best is None or worst < best[0]:
                best = worst, values[inside], vectors[:, inside]
            elif worst <= 1e-11 * scale:  # no longer improves
                break
            if worst <= 4e-16 * scale:
                break
        q = vectors
    if best is None or best[0] > 1e-9 * scale:
        raise ArithmeticError(f"{count} eigenvalues lie between {low} and {high}, the contour found others")
    return best[1], best[2]


def largest(a: np.ndarray, most: int, relative: float = 1e-10) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of a positive semidefinite matrix, in
    falling order, and their unit eigenvectors as columns. Values below
    ``relative`` times the largest are rounding and are left out.

    Intervals from the top down hold a few eigenvalues each, by inertia counts
    at ends that lie in gaps; each one's contour has to find as many as the
    counts say, so none is missed. A last Rayleigh-Ritz over all found vectors
    makes them orthogonal across intervals."""
    n = len(a)
    scale = float(np.abs(a).sum(1).max(initial=0))  # no eigenvalue is larger
    if n == 0 or scale == 0 or not np.isfinite(scale):
        return np.empty(0), np.empty((n, 0))
    t = tridiagonal(a)
    top, bottom = scale * 1.01, 0.0
    low, high = 0.0, top
    for _ in range(60):  # the largest value, roughly
        mid = (low + high) / 2
        low, high = (mid, high) if above(t, mid) else (low, mid)

    def cut(lo: float, hi: float) -> float:
        """A place near the middle, by ratio, without an eigenvalue close by."""
        for share in (0.5, 0.45, 0.55, 0.4, 0.6, 0.35, 0.65, 0.3, 0.7):
            at = lo * (hi / lo) ** share
            near = 1e-3 * (hi - lo)
            if above(t, at - near) == above(t, at + near):
                return at
        return lo * (hi / lo) ** 0.5

    bottom = cut(relative * high, 2 * relative * high)
    wanted = min(most, above(t, bottom))
    found, vectors = [], []
    todo = [(bottom, top)]
    while todo and sum(map(len, found)) < wanted:
        lo, hi = todo.pop()
        count = above(t, lo) - above(t, hi)
        if count == 0:
            continue
        if hi > lo * (1 + 1e-9) and (count > PER_INTERVAL or hi > 3 * lo):
            mid = cut(lo, hi)
            todo += [(lo, mid), (mid, hi)]
            continue
        values, u = in_interval(a, lo, hi, count, scale)
        found.append(values)
        vectors.append(u)
    q = np.linalg.qr(np.concatenate(vectors, axis=1))[0]
    values, small = np.linalg.eigh(q.T @ a @ q)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], q @ small[:, order]
