"""Rows of two tables matched by a vector within a tolerance: one to one, or each with its nearest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vec as V
from ..plans.scratch import written


def _near_pairs(left: DataFrame, right: DataFrame, key: list[str], vector: str, tolerance: float, ids: tuple[str, str]) -> DataFrame:
    """(*key, a, b, distance): all pairs at most `tolerance` apart, from a join by cells as wide as that, each left row with the cells around its own."""
    if tolerance <= 0:
        raise ValueError("tolerance must be positive")
    cell = lambda c: F.floor(F.col(f"v.{c}") / tolerance)
    near = lambda c: F.explode(F.sequence(cell(c) - 1, cell(c) + 1)).alias(f"c{c}")
    a = left.select(*key, F.col(ids[0]).alias("a"), F.col(vector).alias("v")).where("isnotnull(v.x) AND isnotnull(v.y) AND isnotnull(v.z)")
    for c in "xyz":
        a = a.select("*", near(c))
    b = right.select(*key, F.col(ids[1]).alias("b"), F.col(vector).alias("v")).where("isnotnull(v.x) AND isnotnull(v.y) AND isnotnull(v.z)").select(*key, "b", F.col("v").alias("w"), *(cell(c).alias(f"c{c}") for c in "xyz"))
    distance = V.norm(V.sub(V.parts(F.col("v")), V.parts(F.col("w"))))
    return a.join(b, [*key, "cx", "cy", "cz"]).withColumn("distance", distance).where(F.col("distance") <= tolerance).select(*key, "a", "b", "distance")


def nearest_within(left: DataFrame, right: DataFrame, key: list[str], vector: str, tolerance: float, ids: tuple[str, str] = ("id", "id_right")) -> DataFrame:
    """(*key, ids[0], ids[1], distance): for each left row the nearest right row of equal key at most `tolerance` away, of equally near ones that of the least id.

    A right row can be the nearest of several left rows. Defined cases as in `matched_within`.
    """
    found = _near_pairs(left, right, key, vector, tolerance, ids).groupBy(*key, "a").agg(F.min(F.struct("distance", "b")).alias("m"))
    return found.select(*key, F.col("a").alias(ids[0]), F.col("m.b").alias(ids[1]), "m.distance")


def matched_within(left: DataFrame, right: DataFrame, key: list[str], vector: str, tolerance: float, ids: tuple[str, str] = ("id", "id_right")) -> DataFrame:
    """(*key, ids[0], ids[1], distance): pairs of rows of equal key whose vectors (structs of x, y, z) are at most `tolerance` apart, each row in one pair at most.

    Near pairs are taken by distance, then by the left id, then by the
    right: a round takes all pairs that come first for both of their rows, so rounds are few, and none holds more than the pairs that are left.

    Defined cases: ids tell rows apart and are not null; rows with a null in the key or the vector match nothing; rows that find no partner have no row in the result.
    """
    pairs = written(_near_pairs(left, right, key, vector, tolerance, ids))
    taken = None
    while not pairs.isEmpty():
        first = pairs.groupBy("a").agg(F.min(F.struct("distance", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
        back = pairs.groupBy("b").agg(F.min(F.struct("distance", "a")).alias("m")).select("b", F.col("m.a").alias("a"))
        both = written(pairs.join(first.join(back, ["a", "b"]), ["a", "b"]).select(*key, "a", "b", "distance").distinct())
        taken = both if taken is None else taken.union(both)
        pairs = written(pairs.join(both.select("a"), "a", "left_anti").join(both.select("b"), "b", "left_anti"))
    return (pairs if taken is None else taken).select(*key, F.col("a").alias(ids[0]), F.col("b").alias(ids[1]), "distance")
