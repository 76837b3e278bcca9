"""Leading eigenpairs of a symmetric matrix: Householder tridiagonalisation, bisection with Sturm counts, inverse
iteration with reorthogonalisation inside clusters. The matrix has one row a dimension, so it is the driver's work."""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
CLUSTER = 1e-3     # eigenvalues nearer to each other than this share of the norm are orthogonalised together


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, q) with q.T @ a @ q tridiagonal, by Householder reflections."""
    a = a.copy()
    n = len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        if not x[1:].any():
            continue
        norm = np.copysign(np.linalg.norm(x), x[0])
        v = x.copy()
        v[0] += norm
        v /= np.linalg.norm(v)
        # two-sided update of the trailing block: a - v w' - w v'
        p = a[k + 1:, k + 1:] @ v
        w = 2 * (p - (v @ p) * v)
        a[k + 1:, k + 1:] -= np.outer(v, w) + np.outer(w, v)
        a[k + 1:, k] = a[k, k + 1:] = 0.0
        a[k + 1, k] = a[k, k + 1] = -norm
        q[:, k + 1:] -= 2 * np.outer(q[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def count_below(d: np.ndarray, e: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm count: how many eigenvalues of the tridiagonal matrix lie below each of the values ``at``."""
    tiny = max(float(np.max(e * e, initial=0.0)), 1.0) * np.finfo(float).tiny
    q = d[0] - at
    count = (q < 0).astype(np.int64)
    for i in range(1, len(d)):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = d[i] - at - e[i - 1] ** 2 / q
        count += q < 0
    return count


def leading_values(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection to neighbouring numbers."""
    n = len(d)
    reach = np.abs(np.concatenate([e, [0]])) + np.abs(np.concatenate([[0], e]))
    lo = np.full(k, float(np.min(d - reach)))
    hi = np.full(k, float(np.max(d + reach)))
    pad = EPS * max(float(np.max(np.abs(d) + reach)), np.finfo(float).tiny) * 4
    lo -= pad
    hi += pad
    wanted = n - 1 - np.arange(k)      # the j-th largest has n - 1 - j eigenvalues below it
    for _ in range(2200):              # the range of doubles; ends as soon as no middle lies between
        mid = lo + (hi - lo) / 2
        open_ = (mid > lo) & (mid < hi)
        if not open_.any():
            break
        below = count_below(d, e, mid)
        down = below > wanted
        hi = np.where(open_ & down, mid, hi)
        lo = np.where(open_ & ~down, mid, lo)
    return lo


class ShiftedSolver:
    """LU factors with partial pivoting of a tridiagonal matrix less a shift."""

    def __init__(self, d: np.ndarray, e: np.ndarray, shift: float, tiny: float):
        n = len(d)
        main, up, low = (d - shift).tolist(), [*e.tolist(), 0.0], e.tolist()
        self.up2, self.swap, self.factor = [0.0] * n, [False] * n, [0.0] * n
        for i in range(n - 1):
            if abs(main[i]) >= abs(low[i]):
                if abs(main[i]) < tiny:
                    main[i] = tiny
                f = low[i] / main[i]
                main[i + 1] -= f * up[i]
            else:
                f = main[i] / low[i]
                self.swap[i] = True
                next_main, next_up = main[i + 1], up[i + 1]
                main[i], low_up = low[i], up[i]
                up[i] = next_main
                main[i + 1] = low_up - f * next_main
                self.up2[i] = next_up
                up[i + 1] = -f * next_up
            self.factor[i] = f
        if abs(main[-1]) < tiny:
            main[-1] = tiny
        self.main, self.up = main, up

    def solve(self, b: np.ndarray) -> np.ndarray:
        x = b.tolist()
        n = len(x)
        for i in range(n - 1):
            if self.swap[i]:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= self.factor[i] * x[i]
        for i in range(n - 1, -1, -1):
            s = x[i]
            if i + 1 < n:
                s -= self.up[i] * x[i + 1]
            if i + 2 < n:
                s -= self.up2[i] * x[i + 2]
            x[i] = s / self.main[i]
        return np.array(x)


def inverse_iteration(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) for falling eigenvalues; those of a cluster are kept orthogonal to each other."""
    n, k = len(d), len(values)
    norm = max(float(np.max(np.abs(d))) + 2 * float(np.max(np.abs(e), initial=0.0)), np.finfo(float).tiny)
    tiny = EPS * norm
    rng = np.random.default_rng(1)
    z = np.zeros((n, k))
    first, shift = 0, np.inf
    for j in range(k):
        if j and values[j - 1] - values[j] > CLUSTER * norm:
            first = j
        # equal eigenvalues get shifts a little apart, so that their solves differ
        shift = min(float(values[j]), shift - 2 * tiny) if j > first else float(values[j])
        solver = ShiftedSolver(d, e, shift, tiny)
        x = rng.standard_normal(n)
        for _ in range(6):
            for _ in range(2):
                x -= z[:, first:j] @ (z[:, first:j].T @ x)
            x /= np.linalg.norm(x)
            x = solver.solve(x)
            x /= np.abs(x).max()
        for _ in range(2):
            x -= z[:, first:j] @ (z[:, first:j].T @ x)
            x /= np.linalg.norm(x)
        z[:, j] = x
    return z


def leading_eigenpairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as rows) of the k largest eigenvalues, falling; in each vector the entry that is largest in
    absolute value is positive."""
    k, size = min(k, len(a)), float(np.abs(a).max(initial=0.0))
    if size == 0:
        return np.zeros(k), np.eye(len(a))[:k]
    d, e, q = tridiagonal((a + a.T) / 2 / size)
    values = leading_values(d, e, k)
    v = (q @ inverse_iteration(d, e, values)).T
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    top = v[np.arange(k), np.abs(v).argmax(axis=1)]
    return values * size, v * np.where(top < 0, -1.0, 1.0)[:, None]
