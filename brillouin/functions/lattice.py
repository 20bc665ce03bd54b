"""Lattice arithmetic on small arrays: cells, reduction, changes of basis."""

from __future__ import annotations

from itertools import product

import numpy as np


def angle(a: np.ndarray, b: np.ndarray) -> float:
    """Degrees between two vectors."""
    return float(np.degrees(np.arccos(np.clip(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)), -1.0, 1.0))))


def cell(axes: np.ndarray) -> tuple[float, ...]:
    """a, b, c, alpha, beta, gamma of three row vectors."""
    a, b, c = axes
    return *(float(np.linalg.norm(v)) for v in axes), angle(b, c), angle(a, c), angle(a, b)


def niggli(axes: np.ndarray, eps: float = 1e-7, rounds: int = 200) -> np.ndarray:
    """Reduced basis by the algorithm of Krivy and Gruber: row vectors, right-handed if the given ones are."""
    m = np.array(axes, float)
    tol = eps * abs(np.linalg.det(m)) ** (2 / 3)
    for _ in range(rounds):
        g = m @ m.T
        a, b, c = g.diagonal()
        x, y, z = 2 * g[1, 2], 2 * g[0, 2], 2 * g[0, 1]
        if a > b + tol or (abs(a - b) <= tol and abs(x) > abs(y) + tol):
            m = -m[[1, 0, 2]]
            continue
        if b > c + tol or (abs(b - c) <= tol and abs(y) > abs(z) + tol):
            m = -m[[0, 2, 1]]
            continue
        signs = [0 if abs(v) <= tol else (1 if v > 0 else -1) for v in (x, y, z)]
        acute = signs[0] * signs[1] * signs[2] > 0
        flip = _signs(signs, acute)
        if (flip != 1).any():
            m = m * flip[:, None]
            continue
        if abs(x) > b + tol or (abs(x - b) <= tol and 2 * y < z - tol) or (abs(x + b) <= tol and z < -tol):
            m[2] -= np.sign(x) * m[1]
        elif abs(y) > a + tol or (abs(y - a) <= tol and 2 * x < z - tol) or (abs(y + a) <= tol and z < -tol):
            m[2] -= np.sign(y) * m[0]
        elif abs(z) > a + tol or (abs(z - a) <= tol and 2 * x < y - tol) or (abs(z + a) <= tol and y < -tol):
            m[1] -= np.sign(z) * m[0]
        elif x + y + z + a + b < -tol or (abs(x + y + z + a + b) <= tol and 2 * (a + y) + z > tol):
            m[2] += m[0] + m[1]
        else:
            return m
    return m


def _signs(signs: list[int], acute: bool) -> np.ndarray:
    """Sign of each axis that makes all three angles acute, or none of them; their product is 1."""
    best = np.ones(3)
    for s in product((1, -1), repeat=3):
        if s[0] * s[1] * s[2] != 1:
            continue
        new = (signs[0] * s[1] * s[2], signs[1] * s[0] * s[2], signs[2] * s[0] * s[1])
        if all(v > 0 for v in new) if acute else all(v <= 0 for v in new):
            return np.array(s, float) if tuple(new) != tuple(signs) else best
    return best


def reduced_candidate(v1: np.ndarray, v2: np.ndarray, v3: np.ndarray, min_angle: float = 20.0) -> np.ndarray | None:
    """Setting matrix A of the reduced cell that three vectors span; None if they lie too close to a plane or a line."""
    gamma = angle(v1, v2)
    if gamma < min_angle or 180 - gamma < min_angle:
        return None
    normal = np.cross(v1, v2)
    if gamma < 90:
        v2, normal = -v2, -normal
    if abs(90 - angle(normal, v3)) < min_angle:
        return None
    if angle(v2, v3) < 90:
        v3 = -v3
    if np.dot(normal, v3) < 0:
        v1, v2, v3 = -v1, -v2, -v3
    axes = niggli(np.array([v1, v2, v3]))
    a, b, c = np.linalg.norm(axes, axis=1)
    return np.linalg.inv(axes) if abs(np.linalg.det(axes)) > a * b * c / 100 else None


def reindexings(reach: int = 5, longest: int = 6, moduli: tuple[int, ...] = (2, 3, 5)) -> list[tuple[tuple[int, int, int], int, np.ndarray]]:
    """Systematic absences of a basis that is too large: (vector, modulus, change of basis), in the order they are tried.

    Vectors come by length, then by larger sum, then in descending order; of collinear ones the first. The change of basis has the first
    three points of the sublattice that are not in one plane, right-handed.
    """
    span = range(reach, -reach - 1, -1)
    points = sorted((p for p in product(span, repeat=3) if any(p)), key=lambda p: (np.dot(p, p), -sum(p), tuple(-x for x in p)))
    chosen: list[tuple[int, int, int]] = []
    for p in points:
        if np.dot(p, p) > longest:
            break
        if all(np.cross(p, q).any() for q in chosen):
            chosen.append(p)
    out = []
    for p in chosen:
        for m in moduli:
            basis: list[tuple[int, int, int]] = []
            for q in (q for q in points if np.dot(p, q) % m == 0):
                if np.linalg.matrix_rank(np.array([*basis, q])) == len(basis) + 1:
                    basis.append(q)
                if len(basis) == 3:
                    break
            t = np.array(basis, float)
            out.append((p, m, t[[1, 0, 2]] if np.linalg.det(t) < 0 else t))
    return out


def with_basis(setting: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Setting matrix in the basis of a detected absence, reduced."""
    direct = np.linalg.inv(change).T @ np.linalg.inv(setting)
    return np.linalg.inv(niggli(direct))
