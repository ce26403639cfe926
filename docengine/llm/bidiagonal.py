"""Singular values and right singular vectors of a triangular factor of bounded size.

Householder reflections make the factor bidiagonal, dqds sweeps find the squares of its
singular values to high relative accuracy, and a twisted factorisation at each of them gives
its vector. The factor has as many rows as a vector has entries, however many vectors there are.
"""

import math

import numpy as np

EPS = float(np.finfo(float).eps)
# Values closer than this, in relation to their size, are made orthogonal explicitly.
CLOSE = 1e-3


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, upper diagonal and right factor P of a square matrix, R = U B P^T."""
    a = r.astype(float).copy()
    size = len(a)
    right = np.eye(size)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        scale = np.abs(x).max(initial=0.0)
        if len(x) < 2 or scale == 0 or not x[1:].any():
            return None
        v = x / scale
        v[0] += math.copysign(math.sqrt(float(v @ v)), v[0])
        return v / math.sqrt(float(v @ v))

    for k in range(size):
        v = reflector(a[k:, k])
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k + 1 < size:
            v = reflector(a[k, k + 1 :])
            if v is not None:
                a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
                right[:, k + 1 :] -= 2 * np.outer(right[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _sweep(q: list[float], e: list[float], shift: float):
    """One differential quotient-difference step; the failing place and pivot if one is negative."""
    d, qs, es = q[0] - shift, [], []
    for i in range(len(e)):
        if d < 0:
            return None, (i, d)
        pivot = d + e[i]
        ratio = q[i + 1] / pivot if pivot > 0 else 0.0
        qs.append(pivot)
        es.append(e[i] * ratio)
        d = d * ratio - shift if pivot > 0 else q[i + 1] - shift
    if d < 0:
        return None, (len(e), d)
    return (qs + [d], es), None


def dqds(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, falling."""
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(upper).max(initial=0.0))
    if scale == 0:
        return np.zeros(len(diagonal))
    q0 = [float(x) ** 2 for x in diagonal / scale]
    e0 = [float(x) ** 2 for x in upper / scale]
    blocks, found = [(q0, e0, 0.0)], []
    tiny, budget = (4 * EPS) ** 2, 200 * len(q0) + 200
    while blocks:
        q, e, moved = blocks.pop()
        while e:
            # Leaving out an entry moves no value by more than the entry of B^T B that it makes.
            small = (
                e[i] < 1e-290 or q[i] * e[i] <= tiny * (moved + min(q[i], q[i + 1])) ** 2
                for i in range(len(e) - 1, -1, -1)
            )
            cut = next((len(e) - 1 - k for k, yes in enumerate(small) if yes), None)
            if cut == len(e) - 1:
                found.append(moved + q.pop())
                e.pop()
                continue
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:  # the same values, with small ones last
                q, e = q[::-1], e[::-1]
            # The lower value of the last two rows is an upper bound of the least one.
            a, b, c = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
            shift = max(0.0, min(a, b) - c / (abs(a - b) / 2 + math.sqrt((a - b) ** 2 / 4 + c)))
            for attempt in range(4):
                done, failed = _sweep(q, e, shift if attempt < 3 else 0.0)
                if done:
                    moved += shift if attempt < 3 else 0.0
                    break
                # With all pivots but the last positive, the sum bounds the least value below; it
                # may be negative among values that are all but equal, which no shift of 0 parts.
                late = failed[0] == len(e) and shift + failed[1] > 0
                shift = (shift + failed[1]) * (1 - 4 * EPS) if late else shift / 4
            q, e = done
            budget -= 1
            if budget < 0:
                raise ArithmeticError("dqds did not converge")
        found.extend(moved + x for x in q)
    return np.sort(np.array(found))[::-1] * scale**2


def _factors(diagonal: np.ndarray, upper: np.ndarray, value: float):
    """Both triangular factorisations of B^T B - value, and the twist's pivots."""
    q, e, off = diagonal**2, upper**2, diagonal[:-1] * upper
    size = len(q)
    least = EPS**2 * (q.max() + (e.max() if len(e) else 0.0))

    def safe(x: float) -> float:
        return x if abs(x) > least else math.copysign(least, x)

    lower, above = np.empty(size - 1), np.empty(size)
    above[0] = -value
    for i in range(size - 1):
        down = safe(above[i] + q[i])
        lower[i] = off[i] / down
        above[i + 1] = e[i] * above[i] / down - value
    below, higher = np.empty(size), np.empty(size - 1)
    below[-1] = q[-1] - value
    for i in range(size - 2, -1, -1):
        up = safe(e[i] + below[i + 1])
        higher[i] = off[i] / up
        below[i] = below[i + 1] * q[i] / up - value
    return lower, higher, above + below + value


def vectors(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit right singular vectors, as columns, for the given squares of singular values."""
    scale = max(np.abs(diagonal).max(), np.abs(upper).max(initial=0.0))
    diagonal, upper, values = diagonal / scale, upper / scale, values / scale**2
    out = np.zeros((len(diagonal), len(values)))
    b = np.diag(diagonal) + np.diag(upper, 1)
    product = b.T @ b
    random, start = np.random.default_rng(12), 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLOSE * values[k - 1]:
            start = k
        near = out[:, start:k]
        lower, higher, twist = _factors(diagonal, upper, value)
        z = np.zeros(len(diagonal))
        r = int(np.abs(twist).argmin())
        z[r] = 1.0
        for i in range(r - 1, -1, -1):
            z[i] = -lower[i] * z[i + 1]
        for i in range(r, len(z) - 1):
            z[i + 1] = -higher[i] * z[i]
        z /= math.sqrt(float(z @ z))
        for _ in range(8):
            z = z - near @ (near.T @ z)
            left = math.sqrt(float(z @ z))
            if left > 0.5:
                break
            # The same vector again: iterate from a start without the ones found before.
            z = random.standard_normal(len(z))
            shifted = product - value * (1 + 4 * EPS) * np.eye(len(z))
            for _ in range(3):
                z = np.linalg.solve(shifted, z - near @ (near.T @ z))
                z /= math.sqrt(float(z @ z))
        z -= near @ (near.T @ z)
        out[:, k] = z / math.sqrt(float(z @ z))
    return out
