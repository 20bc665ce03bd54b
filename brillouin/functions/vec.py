"""Vectors (STRUCT<x, y, z>) and 3 x 3 matrices (row-major ARRAY<DOUBLE>) as Spark columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Vec = tuple[Column, Column, Column]


def parts(v: Column | Sequence) -> Vec:
    """Components of a struct column, or of three numbers or columns."""
    if isinstance(v, Column):
        return v["x"], v["y"], v["z"]
    return tuple(c if isinstance(c, Column) else F.lit(float(c)) for c in v)


def vector(x: Column, y: Column, z: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"), z.cast("double").alias("z"))


def with_step(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds or replaces columns as the one element of an array that is exploded: later expressions and filters then refer to them, where Spark would
    put a copy of their expressions (of structs, and of all that a filter names) into every place that names them."""
    return rows.select(*(c for c in rows.columns if c not in columns), F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def add(a, b) -> Vec:
    return tuple(p + q for p, q in zip(parts(a), parts(b), strict=True))


def sub(a, b) -> Vec:
    return tuple(p - q for p, q in zip(parts(a), parts(b), strict=True))


def scale(a, k) -> Vec:
    return tuple(p * k for p in parts(a))


def dot(a, b) -> Column:
    (x, y, z), (u, v, w) = parts(a), parts(b)
    return x * u + y * v + z * w


def cross(a, b) -> Vec:
    (x, y, z), (u, v, w) = parts(a), parts(b)
    return y * w - z * v, z * u - x * w, x * v - y * u


def norm2(a) -> Column:
    return dot(a, a)


def norm(a) -> Column:
    return F.sqrt(norm2(a))


def unit(a) -> Vec:
    """Null for the zero vector."""
    n = norm(a)
    return scale(a, F.when(n > 0, 1 / n))


def angle_deg(a, b) -> Column:
    """Angle between two vectors, 0 to 180 degrees."""
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(a, b) / (norm(a) * norm(b))))))


def entries(m: Column | Sequence) -> list[Column]:
    if isinstance(m, Column):
        return [m[k] for k in range(9)]
    return [c if isinstance(c, Column) else F.lit(float(c)) for c in m]


def matrix(cells: Sequence[Column]) -> Column:
    return F.array(*[c.cast("double") for c in cells])


def apply(m, v) -> Vec:
    e = entries(m)
    return tuple(dot(e[3 * r : 3 * r + 3], v) for r in range(3))


def multiply(a, b) -> list[Column]:
    p, q = entries(a), entries(b)
    return [sum((p[3 * r + k] * q[3 * k + c] for k in range(1, 3)), p[3 * r] * q[c]) for r in range(3) for c in range(3)]


def transpose(m) -> list[Column]:
    e = entries(m)
    return [e[3 * c + r] for r in range(3) for c in range(3)]


def determinant(m) -> Column:
    e = entries(m)
    return dot(e[0:3], cross(e[3:6], e[6:9]))


def inverse(m) -> list[Column]:
    """Null entries for a singular matrix: columns of the inverse are cross products of the rows, over the determinant."""
    e = entries(m)
    rows = e[0:3], e[3:6], e[6:9]
    d = determinant(m)
    columns = [scale(cross(rows[(k + 1) % 3], rows[(k + 2) % 3]), F.when(d != 0, 1 / d)) for k in range(3)]
    return [columns[c][r] for r in range(3) for c in range(3)]


def rotate(v, axis, angle: Column) -> Vec:
    """Rodrigues rotation of v about a unit axis by an angle in radians."""
    c, s = F.cos(angle), F.sin(angle)
    return add(add(scale(v, c), scale(cross(axis, v), s)), scale(axis, dot(axis, v) * (1 - c)))


def orthogonalisation(a, b, c, alpha, beta, gamma) -> list[Column]:
    """Matrix from fractional to Cartesian coordinates of a unit cell (lengths, angles in degrees), a along x."""
    ca, cb, cg, sg = F.cos(F.radians(alpha)), F.cos(F.radians(beta)), F.cos(F.radians(gamma)), F.sin(F.radians(gamma))
    cx, cy = c * cb, c * (ca - cb * cg) / sg
    zero = F.lit(0.0)
    return [a, b * cg, cx, zero, b * sg, cy, zero, zero, F.sqrt(c * c - cx * cx - cy * cy)]


def real_space(setting) -> list[Vec]:
    """Real-space axes a, b, c of a crystal: rows of the inverse of its setting matrix."""
    e = inverse(setting)
    return [tuple(e[3 * r : 3 * r + 3]) for r in range(3)]


def unit_cell(setting) -> list[Column]:
    """a, b, c, alpha, beta, gamma of a setting matrix."""
    a, b, c = real_space(setting)
    return [norm(a), norm(b), norm(c), angle_deg(b, c), angle_deg(a, c), angle_deg(a, b)]


def orientation_and_shape(setting) -> tuple[list[Column], list[Column]]:
    """U and B with setting = U B, B upper triangular with positive diagonal (Gram-Schmidt on the columns)."""
    e = entries(setting)
    a, b, c = ([e[k], e[3 + k], e[6 + k]] for k in range(3))
    u = unit(a)
    b_rest = sub(b, scale(u, dot(u, b)))
    v = unit(b_rest)
    w = cross(u, v)
    zero = F.lit(0.0)
    orient = [col[r] for r in range(3) for col in (u, v, w)]
    return orient, [norm(a), dot(u, b), dot(u, c), zero, norm(b_rest), dot(v, c), zero, zero, dot(w, c)]


def d_spacing(h, k, l, cell) -> Column:  # noqa: E741
    """Interplanar spacing by the reciprocal metric; null for hkl = 0."""
    m = orthogonalisation(*cell)
    r = apply(transpose(inverse(m)), (h, k, l))
    n = norm(r)
    return F.when(n > 0, 1 / n)
