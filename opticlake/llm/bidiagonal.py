"""Singular values and right singular vectors of a small matrix by way of its bidiagonal form.

`bidiagonalise` brings R to an upper bidiagonal B = Q^T R P by Householder reflections. With q and e, the squares of B's
diagonal and of what stands above it, `dqds` finds the eigenvalues of B^T B: each transform shifts q and e without a
subtraction that could lose small values, and what is left over in the last place is one of them to full relative
accuracy. `twisted_vectors` then solves for the direction of each value: B^T B minus the value is factored from above and
from below, the two factorisations are joined where they agree best, and the direction follows by multiplications alone.
Values that nearly coincide share a plane of directions; there the vectors come from inverse iteration on the whole plane.

Sizes are those of a vector's dimensions, never of the data.
"""

from __future__ import annotations

import math

import numpy as np

EPS = np.finfo(float).eps
APART = 1e-4  # values that are closer than this, relative to their size, are one cluster


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """A unit vector v, and what (I - 2 v v^T) x has in its first place, with zeros below."""
    length = np.linalg.norm(x)
    if length == 0:
        return np.zeros_like(x), 0.0
    v = x.copy()
    first = -math.copysign(length, x[0])
    v[0] -= first
    return v / np.linalg.norm(v), first


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, upper diagonal, and the reflections from the right (the k-th acts on places k + 1 onwards)."""
    n = r.shape[1]
    a = np.vstack([r, np.zeros((max(0, n - len(r)), n))])
    upper, right = np.zeros(max(n - 1, 0)), []
    diagonal = np.zeros(n)
    for k in range(n):
        v, diagonal[k] = _reflector(a[k:, k])
        a[k:, k + 1 :] -= 2 * np.outer(v, v @ a[k:, k + 1 :])
        if k < n - 1:
            v, upper[k] = _reflector(a[k, k + 1 :])
            if k == n - 2:  # one place: nothing to bring to zero
                v, upper[k] = np.zeros(1), a[k, k + 1]
            a[k + 1 :, k + 1 :] -= 2 * np.outer(a[k + 1 :, k + 1 :] @ v, v)
            right.append(v)
    return diagonal, upper, right


def turn_back(vectors: np.ndarray, right: list[np.ndarray]) -> np.ndarray:
    """Columns given in the directions of B in those of R."""
    out = vectors.copy()
    for k in range(len(right) - 1, -1, -1):
        v = right[k]
        out[k + 1 :] -= 2 * np.outer(v, v @ out[k + 1 :])
    return out


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, int]:
    """One dqds transform; also the least d, and the place where d became negative (the length if it never did)."""
    n = len(q)
    d = q[0] - shift
    least = d
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    for i in range(n - 1):
        if d < 0:
            return new_q, new_e, d, i
        new_q[i] = d + e[i]
        ratio = q[i + 1] / new_q[i] if new_q[i] > 0 else math.inf
        if ratio == math.inf:  # a zero pivot: the value is 0 to working accuracy
            new_e[i], d = 0.0, q[i + 1] - shift
        else:
            new_e[i] = e[i] * ratio
            d = d * ratio - shift
        least = min(least, d)
    new_q[n - 1] = d
    return new_q, new_e, least, n if d >= 0 else n - 1


def dqds(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Eigenvalues of B^T B, the largest first."""
    found: list[float] = []
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(upper).max(initial=0.0))
    if scale == 0:
        return np.zeros(len(diagonal))
    q0, e0 = ((diagonal / scale) ** 2).tolist(), ((upper / scale) ** 2).tolist()
    # Where e is 0 the matrix falls apart.
    parts, start = [], 0
    for i in range(len(e0) + 1):
        if i == len(e0) or e0[i] == 0.0:
            parts.append((q0[start : i + 1], e0[start:i]))
            start = i + 1
    for q, e in parts:
        sigma = 0.0
        fresh = True
        while q:
            n = len(q)
            if n == 1 or e[-1] <= EPS * EPS * (sigma + q[-1]) or e[-1] * q[-2] <= (EPS * (sigma + q[-1])) ** 2 and e[-1] <= EPS * (sigma + q[-1]):
                found.append(sigma + q.pop())
                if e:
                    e.pop()
                fresh = True
                continue
            if fresh and q[0] * 1.5 < q[-1]:  # small values belong at the end
                q, e = q[::-1], e[::-1]
            # The smaller eigenvalue of the last two places is near the least, from above.
            half, product = (q[-2] + q[-1] + e[-1]) / 2, q[-2] * q[-1]
            shift = product / (half + math.sqrt(max(half * half - product, 0.0))) if half > 0 else 0.0
            for attempt in range(40):
                new_q, new_e, least, at = _transform(q, e, shift)
                if at == n:
                    break
                # A failure in the last place tells how much was too much.
                late = at == n - 1 and shift + least > 0
                shift = (shift + least) * (1 - 4 * EPS) if late and attempt < 2 else shift / 4 if attempt < 20 else 0.0
            q, e, fresh = new_q, new_e, False
            sigma += shift
    return np.sort(np.array(found))[::-1] * scale * scale


def _twisted(d: np.ndarray, low: np.ndarray, value: float) -> np.ndarray:
    """The direction for one eigenvalue of L D L^T."""
    n = len(d)
    tiny = EPS * EPS * max(abs(value), float(np.abs(d).max()))
    s, p = np.empty(n), np.empty(n)
    above, below = np.empty(max(n - 1, 0)), np.empty(max(n - 1, 0))
    s[0] = -value
    for i in range(n - 1):  # from above
        pivot = d[i] + s[i]
        pivot = pivot if abs(pivot) > tiny else tiny
        above[i] = d[i] * low[i] / pivot
        s[i + 1] = above[i] * low[i] * s[i] - value
    p[n - 1] = d[n - 1] - value
    for i in range(n - 2, -1, -1):  # from below
        pivot = d[i] * low[i] * low[i] + p[i + 1]
        pivot = pivot if abs(pivot) > tiny else tiny
        ratio = d[i] / pivot
        below[i] = low[i] * ratio
        p[i] = p[i + 1] * ratio - value
    twist = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -above[i] * z[i + 1]
    for i in range(twist, n - 1):
        z[i + 1] = -below[i] * z[i]
    return z / np.linalg.norm(z)


def twisted_vectors(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray, most: int) -> np.ndarray:
    """Columns: the eigenvectors of B^T B for the `most` largest of `values`, which fall."""
    n = len(diagonal)
    floor = EPS * math.sqrt(values[0])
    held = np.where(np.abs(diagonal) > floor * EPS, diagonal, floor * EPS)  # a pivot of 0 has no direction
    d, low = held * held, upper / held[:-1]
    tri = np.diag(diagonal * diagonal) + np.diag(np.concatenate([[0.0], upper**2])) if n > 1 else np.diag(diagonal**2)
    if n > 1:
        side = diagonal[:-1] * upper
        tri += np.diag(side, 1) + np.diag(side, -1)
    out, at = [], 0
    while at < min(most, n):
        end = at + 1
        while end < n and values[end - 1] - values[end] <= APART * values[end - 1]:
            end += 1
        block = np.stack([_twisted(d, low, float(v)) for v in values[at:end]], 1)
        if end - at > 1:
            block = _plane(tri, block, values[at:end])
        out.append(block)
        at = end
    vectors = np.concatenate(out, 1)[:, :most]
    return vectors


def _plane(tri: np.ndarray, start: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal eigenvectors for values that nearly coincide: inverse iteration on all of them at once."""
    n, m = start.shape
    rng = np.random.default_rng(n)
    basis = start + 0.1 * rng.normal(size=(n, m)) / math.sqrt(n)
    spread = max(float(values[0] - values[-1]), EPS * float(values[0]))
    shifted = tri - (float(values.mean()) + spread * 1e-3 + 4 * EPS * float(values[0])) * np.eye(n)
    for _ in range(3):
        basis = np.linalg.qr(np.linalg.solve(shifted, basis))[0]
    small, turn = np.linalg.eigh(basis.T @ tri @ basis)
    return basis @ turn[:, np.argsort(-small, kind="stable")]
