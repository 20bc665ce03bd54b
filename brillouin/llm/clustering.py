"""Centroid clustering in whole numbers, filtered by rotated leading coordinates.

Vectors are rotated onto the principal axes of all vectors.  Each keeps its leading coordinates and the norm of the rest, and
|x - c|^2 >= |x_lead - c_lead|^2 + (|x_rest| - |c_rest|)^2, so a centroid whose bound lies above the exact distance of a nearer one is out.
The centroids that are left are compared in whole numbers.  Vectors and their leading coordinates are written once; a round
reads them, ships the centroids (clusters x dims numbers) to the tasks and gets back one sum a cluster from each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .integer_vectors import integers, largest, row_distances, rows_of, usable
from .shared import written

#: Share of the vectors' variance that the leading coordinates hold.
SHARE = 0.9
#: Pairs of a vector and a centroid that are compared at a time.
PAIRS = 1 << 15
#: Share of both squared norms by which a bound in single precision may be off.
SLACK = 4e-6


def _moments(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims + 1))
        for batch in batches:
            x = np.concatenate([rows_of(batch.column(0), dims), np.ones((batch.num_rows, 1), np.int64)], 1).astype(np.float64)
            total += x.T @ x
        if total[-1, -1]:
            yield pa.RecordBatch.from_pydict({"m": pa.array([total.tobytes()], pa.binary())})

    return run


def _summed(rows: pa.Table) -> pa.Table:
    return pa.table({"m": pa.array([sum(np.frombuffer(x.as_py()) for x in rows.column("m")).tobytes()], pa.binary())})


def rotation(vectors: DataFrame, column: str, dims: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean of all vectors, and of their principal axes (the widest first) so many as hold `share` of the variance."""
    parts = vectors.select(column).mapInArrow(_moments(dims), "m binary")
    sums = parts.groupBy((F.spark_partition_id() % 16).alias("k")).applyInArrow(_summed, "m binary").collect()  # 16 rows at most
    if not sums:
        return np.zeros(dims), np.eye(dims)[:, :1]
    total = sum(np.frombuffer(r["m"]) for r in sums).reshape(dims + 1, dims + 1)
    mean = total[-1, :-1] / total[-1, -1]
    variance, axes = np.linalg.eigh(total[:-1, :-1] / total[-1, -1] - np.outer(mean, mean))
    held = np.maximum(variance[::-1], 0).cumsum()
    return mean, axes[:, ::-1][:, : int(np.searchsorted(held, share * held[-1])) + 1]


def leading(x: np.ndarray, mean: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Coordinates on the leading axes and the norm of the rest."""
    x = x - mean
    lead = x @ axes
    rest = np.sqrt(np.maximum((x * x).sum(1) - (lead * lead).sum(1), 0))
    return np.concatenate([lead, rest[:, None]], 1)


def nearest(x: np.ndarray, lead: np.ndarray, centroids: np.ndarray, centroid_lead: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Each row's nearest centroid (ties: the smaller number), its exact squared distance, and how many pairs were compared in full."""
    near, far = (lead * lead).sum(1)[:, None], (centroid_lead * centroid_lead).sum(1)
    bound = near - 2 * (lead @ centroid_lead.T) + far - SLACK * (near + far)
    first = bound.argmin(1)
    known = row_distances(x, centroids[first])
    left = bound <= known[:, None]
    left[np.arange(len(x)), first] = False
    exact = np.full(bound.shape, np.iinfo(np.int64).max)
    exact[np.arange(len(x)), first] = known
    i, j = np.nonzero(left)
    for at in range(0, len(i), PAIRS):
        p, q = i[at : at + PAIRS], j[at : at + PAIRS]
        exact[p, q] = row_distances(x[p], centroids[q])
    cluster = exact.argmin(1)
    return cluster, exact[np.arange(len(x)), cluster], len(i) + len(x)


def _rotated(dims: int, mean: np.ndarray, axes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead = leading(rows_of(batch.column(1), dims), mean, axes).astype(np.float32)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(lead.ravel()), lead.shape[1]).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, flat], ["id", "x", "lead"])

    return run


def moved(parts: DataFrame, centres: np.ndarray, *keys: str) -> np.ndarray:
    """The centres at the floor of their vectors' means; `parts` has (*keys, n, sums) of each task, those without vectors stay."""
    each = parts.select(*keys, "n", F.posexplode("sums").alias("at", "s"))
    totals = each.groupBy(*keys, "at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()  # a row a component
    centres = centres.copy()
    for row in totals:
        centres[(*(row[k] for k in keys), row["at"])] = int(row["s"]) // row["n"]
    return centres


class _Assign:
    def __init__(self, centroids: np.ndarray, mean: np.ndarray, axes: np.ndarray):
        self.centroids, self.lead = centroids, leading(centroids, mean, axes)

    def _nearest(self, x: pa.Array, lead: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = rows_of(x, self.centroids.shape[1])
        lead = lead.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(x), self.lead.shape[1])
        return x, *nearest(x, lead, self.centroids, self.lead)[:2]

    def sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(cluster, n, sums) of the whole task."""
        total, count = np.zeros_like(self.centroids), np.zeros(len(self.centroids), np.int64)
        for batch in batches:
            if batch.num_rows:
                x, cluster, _ = self._nearest(batch.column(0), batch.column(1))
                order = np.argsort(cluster, kind="stable")
                held, at = np.unique(cluster[order], return_index=True)
                total[held] += np.add.reduceat(x[order], at, axis=0)
                count += np.bincount(cluster, minlength=len(count))
        some = np.flatnonzero(count)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some]), pa.array(list(total[some]), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, cluster, distance = self._nearest(batch.column(1), batch.column(2))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"])


def cluster_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, clusters: int = 40, rounds: int = 5, scale: int = 256, seed: str = "2") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for each vector of exactly `dims` components.

    The first centroids are the vectors with the smallest sha256 of `seed:id`; a round assigns every vector to its nearest centroid and moves
    each to the floor of its vectors' mean, and a last assignment follows.

    Defined cases: rows whose vector is null, of another length or with null or non-finite components are left out; rows with a null id come last
    among the first centroids, equal ids are ordered by their vectors; rows that repeat are vectors each; with fewer vectors than clusters each
    starts one; a component counts as at most largest(dims) (2^27 for 64) up or down, so distances stay within a long; an empty table gives an empty
    table; ids may be of any type; other columns are not read.
    """
    if min(dims, clusters) < 1 or rounds < 0:
        raise ValueError("dims and clusters must be positive, rounds not negative")
    spark = vectors.sparkSession
    kept = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where((F.size("v") == dims) & usable(F.col("v"))).select("id", integers(F.col("v"), scale, largest(dims)).alias("x"))
    kept = written(kept)
    id_type = kept.schema["id"].dataType.simpleString()
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    starts = kept.orderBy(draw.asc_nulls_last(), "x").limit(clusters).select("x").collect()  # `clusters` rows
    centroids = np.array([r["x"] for r in starts], np.int64).reshape(-1, dims)
    mean, axes = rotation(kept, "x", dims, SHARE)
    placed = written(kept.mapInArrow(_rotated(dims, mean, axes), f"id {id_type}, x array<int>, lead array<float>"))
    for _ in range(rounds if len(centroids) else 0):
        parts = placed.select("x", "lead").mapInArrow(_Assign(centroids, mean, axes).sums, "cluster long, n long, sums array<long>")
        centroids = moved(parts, centroids, "cluster")
    out = written(placed.mapInArrow(_Assign(centroids, mean, axes).rows, f"id {id_type}, cluster int, distance long"))
    inertia = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    limit = (1 << 63) - 1
    about = [(k, min(s, limit), min(sum(inertia.values()), limit), hashlib.sha256(",".join(map(str, centroids[k].tolist())).encode()).hexdigest()) for k, s in inertia.items()]
    about = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = out.join(F.broadcast(about), "cluster")  # a row a cluster
    return joined.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
