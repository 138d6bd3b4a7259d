"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The number of positive pivots of a pivoted LDL^T of ``a - s I`` is the number
of eigenvalues above ``s``.  Bisection on these counts isolates each wanted
eigenvalue, Rayleigh quotient iteration inside its slice converges cubically,
and two more counts just beside every result certify its number.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
TIE = 1e-13  # slices narrower than this part of the norm are not cut further
STEPS = 14
_ALPHA = (1 + 17**0.5) / 8  # pivots kept at this share of their column


def count_above(a: np.ndarray, shift: float) -> int:
    """Eigenvalues of ``a`` above ``shift``: the inertia of ``a - shift I`` by a
    Bunch-Kaufman LDL^T, whose 2 x 2 pivots hold one of each sign."""
    m = a - shift * np.eye(len(a))
    k, above = 0, 0
    while k < len(m):
        below = np.abs(m[k + 1 :, k])
        r = k + 1 + int(below.argmax()) if below.size else k
        most, here = (float(below.max()) if below.size else 0.0), abs(m[k, k])
        two = False
        if here < _ALPHA * most:
            column = np.abs(m[k:, r])
            column[r - k] = 0.0
            widest = float(column.max())
            if here * widest < _ALPHA * most * most:
                two = abs(m[r, r]) < _ALPHA * widest
                p = k + 1 if two else k
                m[[p, r], k:] = m[[r, p], k:]
                m[k:, [p, r]] = m[k:, [r, p]]
        if two:
            block, rest = m[k : k + 2, k : k + 2], m[k + 2 :, k : k + 2]
            m[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(block, rest.T)
            above, k = above + 1, k + 2
        else:
            if m[k, k] != 0:
                m[k + 1 :, k + 1 :] -= np.outer(m[k + 1 :, k] / m[k, k], m[k, k + 1 :])
            above, k = above + (m[k, k] > 0), k + 1
    return above


def slices(a: np.ndarray, wanted: int, scale: float) -> list[tuple[float, float, int, int]]:
    """(low, high, first, last): disjoint slices, high ones first, that hold
    the eigenvalues numbered first to last; one each, but for ties."""
    out, todo = [], [(-1.01 * scale, 1.01 * scale, len(a), 0)]
    while todo:
        low, high, to_low, to_high = todo.pop()
        if to_low == to_high or to_high >= wanted:
            continue
        if to_low - to_high == 1 or high - low <= TIE * scale:
            out.append((low, high, to_high + 1, to_low))
            continue
        middle = (low + high) / 2
        n = min(max(count_above(a, middle), to_high), to_low)
        todo += [(low, middle, to_low, n), (middle, high, n, to_high)]
    return out


def _solved(a: np.ndarray, shift: float, x: np.ndarray, scale: float) -> np.ndarray:
    for nudge in (0.0, EPS, 4 * EPS, 64 * EPS):
        try:
            y = np.linalg.solve(a - (shift + nudge * scale) * np.eye(len(a)), x)
        except np.linalg.LinAlgError:
            continue
        size = float(np.linalg.norm(y))
        if np.isfinite(size) and size > 0:
            return y / size
    return x


def rayleigh(a: np.ndarray, start: float, x: np.ndarray, scale: float, plain: int = 2) -> tuple[float, np.ndarray]:
    """An eigenpair near ``start``: ``plain`` inverse iterations, then Rayleigh quotients."""
    for _ in range(plain):
        x = _solved(a, start, x, scale)
    for _ in range(STEPS):
        value = float(x @ a @ x)
        if np.linalg.norm(a @ x - value * x) <= 2 * EPS * scale:
            break
        x = _solved(a, value, x, scale)
    return float(x @ a @ x), x


def leading(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit vectors as
    columns.  Vectors already found are shifted below the spectrum, so those
    of ties and close neighbours come out orthogonal.  Raises ArithmeticError
    if the counts do not certify a number."""
    wanted = min(wanted, len(a))
    scale = float(np.abs(a).sum(axis=1).max()) if len(a) else 0.0
    if wanted == 0 or scale == 0.0:
        return np.zeros(wanted), np.eye(len(a))[:, :wanted]
    rng = np.random.default_rng(len(a))
    left = a.copy()  # what is found already lies below the rest in it
    values, vectors = [], []
    for low, high, first, last in slices(a, wanted, scale):
        for number in range(first, min(last, wanted) + 1):
            lo, hi, slack = low, high, max(64, 16 * len(a)) * EPS * scale
            plain = 2
            while True:
                value, x = rayleigh(left, (lo + hi) / 2, rng.standard_normal(len(a)), scale, plain)
                cut = first == last and hi - lo > TIE * scale
                if (lo + slack < value < hi - slack) if cut else (lo - slack <= value <= hi + slack):
                    break
                if cut:  # it may belong to a neighbour: a narrower slice
                    middle = (lo + hi) / 2
                    lo, hi = (middle, hi) if count_above(a, middle) >= number else (lo, middle)
                elif plain > 64:
                    raise ArithmeticError(f"no eigenvector in the slice of eigenvalue {number}")
                plain += 4
            for y in vectors:
                x = x - (y @ x) * y
            x /= np.linalg.norm(x)
            value = float(x @ a @ x)
            left -= 3 * scale * np.outer(x, x)
            values.append(value)
            vectors.append(x)
    order = np.argsort(-np.array(values), kind="stable")[:wanted]
    e, u = np.array(values)[order], np.array(vectors)[order].T
    certify(a, e, u, scale)
    return e, u


def certify(a: np.ndarray, e: np.ndarray, u: np.ndarray, scale: float) -> None:
    """Each value is the eigenvalue of its number, up to its residual: fewer
    eigenvalues than its number lie above, and that many at least not below."""
    for k, value in enumerate(e, 1):
        slack = max(2 * float(np.linalg.norm(a @ u[:, k - 1] - value * u[:, k - 1])), max(64, 16 * len(a)) * EPS * scale)
        if slack > 1e-9 * scale or not count_above(a, value + slack) < k <= count_above(a, value - slack):
            raise ArithmeticError(f"eigenvalue {k} is not certified by its counts")
