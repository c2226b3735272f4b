"""Singular values and right singular vectors of a small square matrix, by way of its bidiagonal form.

Householder reflections bring the matrix to upper bidiagonal form B. The squares of its singular
values come from dqds, which forms no difference but the shift's, and so keeps small values
accurate. The vectors of B'B come from twisted factorisations: a factorisation from the top and one from
the bottom meet where the remainder is smallest, and solving from there outwards loses no digits.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and V of r = U B V', for a square matrix."""
    a, n = np.array(r, float), len(r)
    v = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        u, size = x.copy(), np.sqrt(x @ x)
        if size == 0 or not np.any(x[1:]):
            return None
        u[0] += np.copysign(size, x[0])
        return u / np.sqrt(u @ u)

    for k in range(n):
        u = reflector(a[k:, k])
        if u is not None:
            a[k:, k:] -= 2 * np.outer(u, u @ a[k:, k:])
        u = reflector(a[k, k + 1 :]) if k < n - 2 else None
        if u is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ u, u)
            v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _pass(q: list, e: list, shift: float):
    """One dqds transformation, and its remainders d; None if the shift exceeds the smallest value."""
    d, new_q, new_e, remainders = q[0] - shift, [], [], []
    for k in range(len(e)):
        if not d >= 0:
            return None
        remainders.append(d)
        top = d + e[k]
        ratio = q[k + 1] / top if top else 0.0
        new_q.append(top)
        new_e.append(e[k] * ratio)
        d = d * ratio - shift
    if not d >= 0:
        return None
    return [*new_q, d], new_e, [*remainders, d]


def _shifts(q: list, e: list, remainders: list) -> list[float]:
    """Shifts to try, boldest first. The second is never above the smallest value but for rounding.

    The remainders of a pass without shift are the reciprocals of the inverse's diagonal, so the
    reciprocal of their sum of reciprocals bounds the smallest value from below.
    """
    safe = 0.0 if min(remainders) <= 0 else (1 - 8 * EPS * len(q)) / sum(1 / d for d in remainders)
    # Ritz value of the last two rows, less its distance to a value of the whole.
    top, low, side = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
    gap = (top - low) / 2
    spread = side / (gap + np.sqrt(gap * gap + side)) if gap >= 0 else np.sqrt(gap * gap + side) - gap
    share = side / (side + (spread + 2 * max(gap, 0.0)) ** 2) if side else 0.0
    beyond = np.sqrt(q[-3] * e[-2] * share) if len(q) > 2 else 0.0
    bold = float((low - spread - beyond) * (1 - 4 * EPS))
    return [bold, safe, 0.0] if bold > safe else [safe, 0.0]


def singular_squares(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, falling."""
    found, work = [], [((diagonal**2).tolist(), (above**2).tolist(), 0.0)]
    passes = 200 * len(diagonal) + 100
    while work:
        q, e, sigma = work.pop()
        while q:
            if not e or e[-1] <= EPS**2 * (sigma + q[-1]):
                found.append(sigma + q.pop())
                e = e[:-1]
                continue
            cut = next((k for k in range(len(e) - 2, -1, -1) if e[k] <= EPS**2 * (sigma + min(q[k], q[k + 1]))), None)
            if cut is not None:
                work.append((q[: cut + 1], e[:cut], sigma))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            q, e, remainders = _pass(q, e, 0.0)
            for shift in _shifts(q, e, remainders):
                shifted = _pass(q, e, shift)
                if shifted is not None:
                    q, e, _ = shifted
                    sigma += shift
                    break
            passes -= 1
            if passes < 0:
                raise ArithmeticError("dqds did not converge")
    return np.sort(np.array(found))[::-1]


class Twisted:
    """B'B less ``value``, factorised from the top and from the bottom, and twisted at ``at``."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, value: float):
        n, q, e = len(diagonal), diagonal**2, above**2
        tiny = EPS**2 * value
        safe = lambda pivot: pivot if abs(pivot) > tiny else -tiny
        self.top, self.low = np.empty(n), np.empty(n)
        s, p = np.empty(n), np.empty(n)
        s[0] = -value
        for k in range(n - 1):
            self.top[k] = safe(s[k] + q[k])
            s[k + 1] = e[k] / self.top[k] * s[k] - value
        p[-1] = q[-1] - value
        for k in range(n - 2, -1, -1):
            self.low[k + 1] = safe(e[k] + p[k + 1])
            p[k] = p[k + 1] * q[k] / self.low[k + 1] - value
        self.middle = s + p + value
        self.at = int(np.argmin(np.abs(self.middle)))
        self.middle = safe(self.middle[self.at])
        side = diagonal[:-1] * above
        self.down = side / self.top[:-1]  # rows above the twist
        self.up = side / self.low[1:]  # rows below it

    def vector(self) -> np.ndarray:
        """The vector the factorisation maps to a multiple of one unit vector, of length 1."""
        z = np.zeros(len(self.top))
        z[self.at] = 1
        for k in range(self.at - 1, -1, -1):
            z[k] = -self.down[k] * z[k + 1]
        for k in range(self.at, len(z) - 1):
            z[k + 1] = -self.up[k] * z[k]
        return z / np.sqrt(z @ z)

    def solve(self, b: np.ndarray) -> np.ndarray:
        at, y = self.at, b.copy()
        for k in range(at):
            y[k + 1] -= self.down[k] * y[k]
        for k in range(len(y) - 2, at - 1, -1):
            y[k] -= self.up[k] * y[k + 1]
        y[:at] /= self.top[:at]
        y[at + 1 :] /= self.low[at + 1 :]
        y[at] /= self.middle
        for k in range(at - 1, -1, -1):
            y[k] -= self.down[k] * y[k + 1]
        for k in range(at, len(y) - 1):
            y[k + 1] -= self.up[k] * y[k]
        return y


def right_vectors(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of r'r, falling, and unit eigenvectors as columns; none for values that are 0.

    A vector's largest entry is positive. Where values agree to working accuracy, the vectors of one
    factorisation coincide; inverse iteration, kept orthogonal to those found, gives the others.
    """
    diagonal, above, v = bidiagonalise(r)
    values = singular_squares(diagonal, above)
    zero = values[0] * (EPS * len(r)) ** 2 if len(values) else 0.0
    values = values[:most]
    chosen: list[np.ndarray] = []
    rng = np.random.default_rng(0)

    def apart(z: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for other in chosen:
                z = z - (other @ z) * other
        return z

    for value in values[values > zero]:
        twisted = Twisted(diagonal, above, value)
        z = apart(twisted.vector())
        if z @ z < 0.5:
            z = apart(rng.standard_normal(len(r)))
            for _ in range(4):
                z = apart(twisted.solve(z / np.sqrt(z @ z)))
        chosen.append(z / np.sqrt(z @ z))
    vectors = v @ np.array(chosen).reshape(len(chosen), len(r)).T
    largest = np.abs(vectors).argmax(axis=0) if chosen else np.empty(0, int)
    return values, vectors * np.sign(vectors[largest, np.arange(len(chosen))])
