"""Spectra of covariances that grow by centred rank-one updates, in numpy.

A spectrum is the eigendecomposition of a scatter matrix (the sum of outer
products of centred vectors) with the number and mean of its vectors. A vector
changes it by one rank-one term, whose new eigenvalues are the roots of a secular
equation; components that a term does not touch, and equal eigenvalues, are
deflated first. Two spectra combine by one such update for each eigenpair of the
smaller one and one for the distance of the means.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps
#: Root searches end after so many steps; bisection alone would need about as many.
_STEPS = 80
#: How far from zero a secular function may be at a root, in parts of its terms. The vectors are orthogonal for any
#: roots between the poles, and a refinement follows, so this bounds the work and not the result.
_NEAR_ZERO = 1e-11


class Spectrum:
    def __init__(self, size: int, count: float = 0.0, mean=None, values=None, vectors=None):
        self.count = count
        self.mean = np.zeros(size) if mean is None else mean
        self.values = np.zeros(size) if values is None else values  # rising
        self.vectors = np.eye(size) if vectors is None else vectors  # one in each column

    def add(self, vector: np.ndarray) -> None:
        """Take in one vector: the scatter grows along its distance from the mean so far."""
        away = vector - self.mean
        self.count += 1
        self.mean = self.mean + away / self.count
        self.update(away, (self.count - 1) / self.count)

    def combine(self, other: "Spectrum") -> "Spectrum":
        """Both spectra as one; the larger one is updated."""
        if self.count < other.count:
            return other.combine(self)
        if not other.count:
            return self
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.update(vector, value)
        away, total = other.mean - self.mean, self.count + other.count
        self.update(away, self.count * other.count / total)
        self.mean = self.mean + away * (other.count / total)
        self.count = total
        return self

    def update(self, vector: np.ndarray, weight: float) -> None:
        """Add ``weight`` times the outer product of a vector with itself."""
        z = self.vectors.T @ vector
        norm = np.sqrt(z @ z)
        rho = weight * norm * norm
        if not rho > 0:
            return
        d, z, q = self.values, z / norm, self.vectors
        near = 8 * _EPS * max(abs(d[-1]), rho)
        # a component that the term hardly meets stays as it is
        live = rho * np.abs(z) > near
        if not live.all() or (np.diff(d) <= near).any():
            z, q = z.copy(), q.copy()
            live = self._merged(d, z, q, live, near)
        k = np.flatnonzero(live)
        if len(k) == 0:
            return
        moved, turned = rank_one(d[k], z[k], rho)
        values, vectors = d.copy(), q.copy()
        values[k], vectors[:, k] = moved, q[:, k] @ turned
        order = np.argsort(values, kind="stable")
        self.values, self.vectors = values[order], vectors[:, order]

    @staticmethod
    def _merged(d, z, q, live, near) -> np.ndarray:
        """Rotate pairs of equal eigenvalues so that the term meets only one of each pair."""
        last = -1
        for i in np.flatnonzero(live):
            if last >= 0 and d[i] - d[last] <= near:
                r = np.hypot(z[i], z[last])
                c, s = z[i] / r, z[last] / r
                z[i], z[last] = r, 0.0
                q[:, last], q[:, i] = c * q[:, last] - s * q[:, i], s * q[:, last] + c * q[:, i]
                live[last] = False
            last = i
        return live


def rank_one(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of diag(d) + rho z z', for rising different d and z without zeros.

    Each root lies between two poles. It is kept as a distance from the nearer pole, so differences to poles are exact
    to the last bits, and found by fitting a rational function with both poles; a step that leaves the root's bracket
    is replaced by its middle. The vectors come from the z that fits the roots found, which keeps them orthogonal.
    """
    n, w = len(d), rho * z * z
    if n == 1:
        return d + w, np.ones((1, 1))
    upper = np.append(d[1:], d[-1] + w.sum())
    gap = upper - d
    middle = 1 + (w[:, None] / (d[:, None] - (d + gap / 2))).sum(axis=0)
    right = (middle < 0) & (np.arange(n) < n - 1)  # the nearer pole is the upper one
    anchor = np.where(right, upper, d)
    delta = d[:, None] - anchor
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, gap / 2)
    low[-1], high[-1] = (0.0, gap[-1] / 2) if middle[-1] >= 0 else (gap[-1] / 2, gap[-1])
    mu = (low + high) / 2
    below = np.tri(n).T  # pole i is at or below root j
    column = w[:, None]
    to_lower, to_upper = d - anchor, upper - anchor
    open_ = np.ones(n, bool)
    for _ in range(_STEPS):
        inverse = 1 / (delta - mu)
        ratio = column * inverse
        f = 1 + ratio.sum(axis=0)
        open_ &= np.abs(f) > _NEAR_ZERO * (1 + np.abs(ratio).sum(axis=0))
        if not open_.any():
            break
        ratio *= inverse
        psi = np.einsum("ij,ij->j", ratio, below)
        phi = ratio.sum(axis=0) - psi
        low, high = np.where(f < 0, mu, low), np.where(f < 0, high, mu)
        a1, a2 = to_lower - mu, to_upper - mu
        a = (a1 + a2) * f - a1 * a2 * (psi + phi)
        b = a1 * a2 * f
        c = f - a1 * psi - a2 * phi
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        new = mu + step
        inside = (new > low) & (new < high)
        new = np.where(inside, new, (low + high) / 2)
        open_ &= new != mu
        mu = np.where(open_, new, mu)
        if not open_.any():
            break
    m = delta - mu
    apart = d[:, None] - d
    np.fill_diagonal(apart, 1.0)
    fits = np.sqrt(np.abs(np.prod(np.where(np.eye(n, dtype=bool), -m, m / apart), axis=1))) * np.sign(z)
    vectors = fits[:, None] / m
    return anchor + mu, vectors / np.sqrt((vectors * vectors).sum(axis=0))
