"""Singular values and right singular vectors of a small matrix, without forming its square.

Householder reflections make the matrix bidiagonal, B = U' A V. The squares q and e of B's diagonal
and upper diagonal are taken through dqds transforms, which find the squares of the singular values
to high relative accuracy, one after another from the smallest. For each of them the shifted
matrix B'B - sI is factorised from the top and from the bottom; twisting both factors together
where the residual is least gives its vector by multiplications alone. Vectors of values that lie
very near each other are made again by inverse steps with the same factors and kept apart.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
# Squares of neighbours that differ by less than this part are a cluster.
NEAR = 1e-6


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit v and value a with (I - 2vv')x = a * first unit vector."""
    size = float(np.linalg.norm(x))
    if size == 0.0:
        return np.zeros_like(x), 0.0
    a = -np.copysign(size, x[0])
    v = x.copy()
    v[0] -= a
    length = float(np.linalg.norm(v))
    return (v / length if length else v), float(a)


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, upper diagonal and V of B = U' matrix V."""
    a = np.array(matrix, float)
    n = a.shape[1]
    if a.shape[0] < n:
        a = np.vstack([a, np.zeros((n - a.shape[0], n))])
    v = np.eye(n)
    diagonal, upper = np.zeros(n), np.zeros(max(0, n - 1))
    for k in range(n):
        u, diagonal[k] = _reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(u, u @ a[k:, k:])
        if k + 1 < n:
            w, upper[k] = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ w, w)
            v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ w, w)
    return diagonal, upper, v


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One dqds transform: new q, new e, and the values d that tell how near the shift is."""
    new_q, new_e, every = [], [], []
    d = q[0] - shift
    for k in range(len(e)):
        every.append(d)
        top = d + e[k]
        t = q[k + 1] / top if top else 0.0
        new_q.append(top)
        new_e.append(e[k] * t)
        d = d * t - shift
    every.append(d)
    new_q.append(d)
    return new_q, new_e, every


def squared_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, falling."""
    tolerance = (10 * EPS) ** 2
    todo = [((diagonal**2).tolist(), (upper**2).tolist(), 0.0)]
    found: list[float] = []
    while todo:
        q, e, base = todo.pop()
        while True:
            # Small off-diagonal squares part the matrix.
            at = next((k for k in reversed(range(len(e))) if e[k] <= tolerance * (base + min(q[k], q[k + 1]))), None)
            if at is not None:
                todo.append((q[: at + 1], e[:at], base))
                q, e = q[at + 1 :], e[at + 1 :]
                continue
            if len(q) == 1:
                found.append(base + max(q[0], 0.0))
                break
            if q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            plain_q, plain_e, d = _transform(q, e, 0.0)
            # The sum of 1/d is the trace of the inverse, so its reciprocal lies below the least value.
            shift = 0.0 if min(d) <= 0 else 1 / sum(1 / x for x in d)
            new_q, new_e, d = _transform(q, e, shift) if shift > EPS * base else (plain_q, plain_e, [0.0])
            if min(d) < 0:
                new_q, new_e, shift = plain_q, plain_e, 0.0
            elif new_q is plain_q:
                shift = 0.0
            q, e, base = new_q, new_e, base + shift
    return np.array(sorted(found, reverse=True))


class _Twisted:
    """Factors of B'B - value * I for one bidiagonal block, from both ends."""

    def __init__(self, diagonal: np.ndarray, upper: np.ndarray, value: float):
        n = len(diagonal)
        tiny = EPS * EPS * max(value, float((diagonal**2).max(initial=0.0)), np.finfo(float).tiny)
        pivot = np.where(diagonal**2 > 0, diagonal**2, tiny)
        lower = upper * diagonal[:-1] / pivot[:-1]
        self.top, self.down = np.zeros(n), np.zeros(max(0, n - 1))
        self.bottom, self.up = np.zeros(n), np.zeros(max(0, n - 1))
        s, p = np.zeros(n), np.zeros(n)
        s[0] = -value
        for i in range(n - 1):
            self.top[i] = s[i] + pivot[i] or tiny
            self.down[i] = pivot[i] * lower[i] / self.top[i]
            s[i + 1] = self.down[i] * lower[i] * s[i] - value
        self.top[-1] = s[-1] + pivot[-1] or tiny
        p[-1] = pivot[-1] - value
        for i in reversed(range(n - 1)):
            self.bottom[i + 1] = pivot[i] * lower[i] ** 2 + p[i + 1] or tiny
            t = pivot[i] / self.bottom[i + 1]
            self.up[i] = lower[i] * t
            p[i] = p[i + 1] * t - value
        self.bottom[0] = p[0] or tiny
        gamma = s + p + value
        gamma = np.where(np.isfinite(gamma), gamma, np.inf)
        self.at = int(np.abs(gamma).argmin())
        self.gamma = float(gamma[self.at]) or tiny

    def _back(self, x: np.ndarray) -> np.ndarray:
        for i in reversed(range(self.at)):
            x[i] -= self.down[i] * x[i + 1]
        for i in range(self.at, len(x) - 1):
            x[i + 1] -= self.up[i] * x[i]
        return x / np.linalg.norm(x)

    def vector(self) -> np.ndarray:
        x = np.zeros(len(self.top))
        x[self.at] = 1.0
        return self._back(x)

    def inverse_step(self, x: np.ndarray) -> np.ndarray:
        """Direction of (B'B - value * I)^-1 x."""
        y, r = x.copy(), self.at
        for i in range(1, r + 1):
            y[i] -= self.down[i - 1] * y[i - 1]
        for i in reversed(range(r, len(y) - 1)):
            y[i] -= self.up[i] * y[i + 1]
        scale = np.concatenate([self.top[:r], [self.gamma], self.bottom[r + 1 :]])
        # Only the direction matters: multiply by the smallest pivot first.
        y *= np.abs(scale).min() / scale
        return self._back(y)


def _apart(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for o in others:
            x = x - (o @ x) * o
    return x


def _block_vectors(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Vectors, as columns, of one block without zero off-diagonals; values falling."""
    out: list[np.ndarray] = []
    rng = np.random.default_rng(7)
    cluster = 0
    for k, value in enumerate(values.tolist()):
        factors = _Twisted(diagonal, upper, value)
        if k and values[k - 1] - value <= NEAR * values[k - 1]:
            others = out[cluster:]
            x = _apart(factors.vector(), others)
            if np.linalg.norm(x) < 0.5:
                x = _apart(rng.standard_normal(len(diagonal)), others)
            for _ in range(3):
                x = _apart(factors.inverse_step(x / np.linalg.norm(x)), others)
                if np.linalg.norm(x) < 1e-8:
                    x = _apart(rng.standard_normal(len(diagonal)), others)
            out.append(x / np.linalg.norm(x))
        else:
            cluster = k
            out.append(factors.vector())
    return np.stack(out, 1)


def right_singular(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Singular values, falling, and right singular vectors as columns."""
    diagonal, upper, v = bidiagonal(matrix)
    n = len(diagonal)
    largest = float(max(np.abs(diagonal).max(initial=0.0), np.abs(upper).max(initial=0.0)))
    if not n or not largest:
        return np.zeros(n), np.eye(n)
    diagonal, upper = diagonal / largest, upper / largest
    cuts = [0, *(np.flatnonzero(np.abs(upper) <= EPS * EPS) + 1).tolist(), n]
    values, vectors = np.zeros(n), np.zeros((n, n))
    for a, b in zip(cuts, cuts[1:], strict=False):
        d, u = diagonal[a:b], upper[a : b - 1]
        values[a:b] = squared_values(d, u)
        vectors[a:b, a:b] = _block_vectors(d, u, values[a:b])
    order = np.argsort(-values, kind="stable")
    return np.sqrt(values[order]) * largest, v @ vectors[:, order]
