"""Vectors as whole numbers, and exact squared distances between them."""

from __future__ import annotations

from math import isqrt

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Whole numbers of doubles are exact below this.
_EXACT = float(1 << 53)


def usable(vector: Column) -> Column:
    """Neither null nor with null or non-finite components."""
    return F.coalesce(F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))


def largest(dims: int) -> int:
    """Components up to this size leave squared distances of `dims` components within a long."""
    return min(isqrt((1 << 62) // max(dims, 1)) // 2, (1 << 31) - 1)


def integers(vector: Column, scale: int, limit: int) -> Column:
    """floor(scale * x) of each component, taken as double; beyond +-limit it is +-limit."""
    return F.transform(vector, lambda v: F.greatest(F.lit(-limit), F.least(F.lit(limit), F.floor(v.cast("double") * scale))).cast("int"))


def rows_of(column, width: int) -> np.ndarray:
    """An Arrow list column without nulls as a matrix of longs."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def squared_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x from all rows of y, as longs."""
    if not len(x) or not len(y) or not x.shape[1]:
        return np.zeros((len(x), len(y)), np.int64)
    reach = float(np.abs(x).max()) + float(np.abs(y).max())
    if reach * reach * x.shape[1] < _EXACT:
        a, b = x.astype(np.float64), y.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    out = np.empty((len(x), len(y)), np.int64)
    for k, row in enumerate(y):
        gap = x - row
        out[:, k] = np.einsum("ij,ij->i", gap, gap)
    return out


def row_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x from the same rows of y, as longs."""
    gap = x - y
    return np.einsum("ij,ij->i", gap, gap)
