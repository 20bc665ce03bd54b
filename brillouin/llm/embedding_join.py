"""Near-duplicate vectors by an epsilon grid order join.

Cosine >= t between unit vectors is a distance of at most eps = sqrt(2 - 2 t).  Vectors are rotated onto their principal
dimensions and sorted by the cells of a grid of width eps on the leading ones; the sequence is cut into blocks, and
blocks are the leaves of a tree of intervals.  The join starts from (all, all) and goes down level by level:
children of a pair of intervals stay only if their bounding boxes come within eps.  A box spans the leading dimensions and the
norm of the rest, because |x - y|^2 >= |x_lead - y_lead|^2 + (|x_rest| - |y_rest|)^2.  Every level is an equi-join of the pairs that are left with
the boxes of the next level.

Pairs of leaf blocks are dealt into squares of the pair matrix; a block goes once to each square that needs it, not once to each
pair.  In a task the recursion goes on: blocks are sorted by their grid order and cut into tiles, tiles whose boxes lie apart are skipped, and
in the others x_lead . y_lead + |x_rest| |y_rest|, which no cosine exceeds, sieves the pairs.  What passes is compared in double precision
(in single precision first where most of a tile passes).  Equal vectors are one vector with a count; a square returns a
count for each vector and a forest of its links, never its pairs.

The worst case is quadratic: vectors that spread evenly over all dimensions leave few boxes to skip, and then only the sieve saves work.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.graph import components, forest
from .shared import written

#: Vectors of a block and of a tile, children of an interval, dimensions of the grid and leading dimensions of boxes and sieve.
BLOCK, TILE, FAN_OUT, GRID_DIMS, BOX_DIMS = 2048, 512, 16, 6, 16
#: Cells that the grid may have, whatever the threshold and the vectors are (their counts are broadcast).
CELLS = 1 << 17
#: Bytes of the blocks that a square of the pair matrix may need.
SQUARE_BYTES = 1 << 26
#: Single-precision cosines are trusted outside this distance from the threshold; boxes are widened by it too.
SLACK = 1e-4


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of a list column as unit vectors in double precision."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    flat = flat / np.abs(flat).max(1, keepdims=True)  # no overflow of the squares
    return flat / np.sqrt((flat * flat).sum(1, keepdims=True))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column(0))
            total = x.T @ x if total is None else total + x.T @ x
    if total is not None:
        yield pa.RecordBatch.from_pydict({"m": pa.array([total.tobytes()], pa.binary())})


def _summed(rows: pa.Table) -> pa.Table:
    return pa.table({"m": pa.array([sum(np.frombuffer(x.as_py()) for x in rows.column("m")).tobytes()], pa.binary())})


def principal_axes(vectors: DataFrame, column: str) -> np.ndarray:
    """Axes of the second moments of the unit vectors, the widest first: a dim x dim matrix. All vectors count."""
    parts = vectors.select(column).mapInArrow(_moments, "m binary")
    sums = parts.groupBy((F.spark_partition_id() % 16).alias("k")).applyInArrow(_summed, "m binary").collect()  # 16 rows at most
    total = sum(np.frombuffer(r["m"]) for r in sums)
    dim = round(sqrt(len(total)))
    return np.linalg.eigh(total.reshape(dim, dim))[1][:, ::-1]


def _grid(threshold: float, dims: int) -> tuple[float, int, int]:
    """Width of the cells, cells on each side of 0, and dimensions of a grid of at most CELLS cells."""
    eps = sqrt(2 - 2 * threshold)
    reach = int(np.ceil(1 / eps))
    return eps, reach, max(1, min(GRID_DIMS, dims, int(log(CELLS) / log(2 * reach + 1))))


def _lead(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Coordinates on the leading axes and the norm of the rest."""
    y = x @ axes[:, :BOX_DIMS]
    rest = np.sqrt(np.maximum(1 - (y * y).sum(1), 0)) if BOX_DIMS < len(axes) else np.zeros(len(y))
    return np.concatenate([y, rest[:, None]], 1)


def _cells(lead: np.ndarray, eps: float, reach: int, dims: int) -> np.ndarray:
    cell = np.zeros(len(lead), np.int64)
    for k in range(dims):
        cell = cell * (2 * reach + 1) + np.clip(np.floor(lead[:, k] / eps).astype(np.int64) + reach, 0, 2 * reach)
    return cell


def _placing(axes: np.ndarray, grid: tuple[float, int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lead = _lead(_matrix(batch.column(2)), axes)
                place = pa.FixedSizeListArray.from_arrays(pa.array(lead.ravel()), lead.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_cells(lead, *grid)), place], ["id", "copies", "vector", "cell", "place"])

    return run


def _packed(block: pa.Table) -> pa.Table:
    block = block.combine_chunks()
    raw = block.column("vector").chunk(0).flatten().to_numpy(zero_copy_only=False)
    one = lambda data: pa.array([data.tobytes()], pa.binary())
    return pa.table({"block": block.column("block")[:1], "ids": one(block.column("id").to_numpy()), "copies": one(block.column("copies").to_numpy()), "data": one(raw)})


class _Block:
    """Vectors of a block in grid order, with their tiles' boxes."""

    def __init__(self, ids: bytes, copies: bytes, data: bytes, kind: str, axes: np.ndarray, grid: tuple[float, int, int]):
        x = np.frombuffer(data, kind).astype(np.float64).reshape(-1, len(axes))
        x = x / np.abs(x).max(1, keepdims=True)
        x /= np.sqrt((x * x).sum(1, keepdims=True))
        lead = _lead(x, axes)
        order = np.lexsort((lead[:, -1], *lead[:, :2].T[::-1], _cells(lead, *grid)))
        self.ids, self.copies, self.x, self.lead = np.frombuffer(ids, np.int64)[order], np.frombuffer(copies, np.int64)[order], x[order], lead[order]
        self.short = self.lead.astype(np.float32)
        self.tiles = [slice(k, k + TILE) for k in range(0, len(x), TILE)]
        self.low, self.high = ([f(self.lead[t], 0) for t in self.tiles] for f in (np.min, np.max))
        self.count = np.zeros(len(x), np.int64)


def _hits(x: np.ndarray, y: np.ndarray, bound: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows with a cosine of at least the threshold; `bound` is no smaller than any cosine."""
    i, j = np.nonzero(bound >= threshold - SLACK)
    sure = np.zeros(len(i), bool)
    if 8 * len(i) > bound.size:
        near = (x.astype(np.float32) @ y.astype(np.float32).T)[i, j]
        left = near >= threshold - SLACK
        i, j, sure = i[left], j[left], near[left] >= threshold + SLACK
    doubt = np.flatnonzero(~sure)
    for at in range(0, len(doubt), 1 << 15):
        d = doubt[at : at + (1 << 15)]
        sure[d] = np.einsum("ij,ij->i", x[i[d]], y[j[d]]) >= threshold
    return i[sure], j[sure]


def _join_blocks(a: _Block, b: _Block, threshold: float, eps: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Forests of the links between two blocks (or within one); adds to their counts."""
    for p, s in enumerate(a.tiles):
        for q in range(p if a is b else 0, len(b.tiles)):
            t = b.tiles[q]
            gap = np.maximum(np.maximum(a.low[p] - b.high[q], b.low[q] - a.high[p]), 0)
            if (gap * gap).sum() > (eps + SLACK) ** 2:
                continue
            bound = a.short[s] @ b.short[t].T
            if a is b and p == q:
                bound[np.tril_indices(len(bound))] = -1
            i, j = _hits(a.x[s], b.x[t], bound, threshold)
            if len(i):
                i, j = i + s.start, j + t.start
                a.count += np.bincount(i, weights=b.copies[j], minlength=len(a.ids)).astype(np.int64)
                b.count += np.bincount(j, weights=a.copies[i], minlength=len(b.ids)).astype(np.int64)
                yield forest(a.ids[i], b.ids[j])


def _squares(threshold: float, kind: str, axes: np.ndarray, grid: tuple[float, int, int]):
    def run(blocks: pa.Table, pairs: pa.Table) -> pa.Table:
        held = {r["block"]: _Block(r["ids"], r["copies"], r["data"], kind, axes, grid) for r in blocks.select(["block", "ids", "copies", "data"]).to_pylist()}
        links = [link for a, b in sorted(zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), strict=True)) for link in _join_blocks(held[a], held[b], threshold, grid[0])]
        empty = np.zeros(0, np.int64)
        u, v = forest(*(np.concatenate(x) for x in zip(*links, strict=True))) if links else (empty, empty)
        ids, n = (np.concatenate([getattr(b, k) for b in held.values()] or [empty]) for k in ("ids", "count"))
        some = np.flatnonzero(n)
        return pa.table({"a": np.concatenate([u, ids[some]]), "b": pa.concat_arrays([pa.array(v, pa.int64()), pa.nulls(len(some), pa.int64())]), "n": pa.concat_arrays([pa.nulls(len(u), pa.int64()), pa.array(n[some], pa.int64())])})

    return run


def _block_pairs(boxes: DataFrame, blocks: int, dims: int, eps: float) -> DataFrame:
    """Pairs (a, b), a <= b, of blocks whose boxes come within eps, from the whole sequence down."""
    levels = 1
    while FAN_OUT**levels < blocks:
        levels += 1
    gap = F.aggregate(F.zip_with(F.zip_with("low_a", "high_b", lambda x, y: x - y), F.zip_with("low_b", "high_a", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0))), F.lit(0.0), lambda s, x: s + x * x)
    pairs = boxes.sparkSession.createDataFrame([(0, 0)], "parent_a long, parent_b long")
    for level in range(levels - 1, -1, -1):
        width = FAN_OUT**level
        at = boxes.groupBy(F.floor(F.col("block") / width).alias("node")).agg(F.array(*[F.min(F.col("low")[k]) for k in range(dims)]).alias("low"), F.array(*[F.max(F.col("high")[k]) for k in range(dims)]).alias("high"))
        at = at.withColumn("parent", F.floor(F.col("node") / FAN_OUT))
        left, right = (at.select(F.col("node").alias(s), F.col("parent").alias(f"parent_{s}"), F.col("low").alias(f"low_{s}"), F.col("high").alias(f"high_{s}")) for s in "ab")
        pairs = pairs.join(left, "parent_a").join(right, "parent_b").where((F.col("a") <= F.col("b")) & (gap <= (eps + SLACK) ** 2)).select("a", "b")
        if level:
            pairs = written(pairs.select(F.col("a").alias("parent_a"), F.col("b").alias("parent_b")))
    return pairs


def _links(distinct: DataFrame, threshold: float) -> DataFrame:
    """(a, b, null): a forest of the links; (a, null, n): links of a vector, those of equal vectors counted each."""
    axes = principal_axes(distinct, "vector")
    grid = _grid(threshold, len(axes))
    kind = distinct.schema["vector"].dataType.simpleString()
    raw = "f4" if kind == "array<float>" else "f8"
    placed = written(distinct.select("id", "copies", F.col("vector") if raw == "f4" else F.col("vector").cast("array<double>")).mapInArrow(_placing(axes, grid), f"id long, copies long, vector {kind if raw == 'f4' else 'array<double>'}, cell long, place array<double>"))
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.withColumn("first", F.coalesce(F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # CELLS rows at most
    placed = placed.join(F.broadcast(cells), "cell").withColumn("block", F.floor((F.col("first") + F.pmod(F.xxhash64("id"), F.col("n"))) / BLOCK))
    dims = min(BOX_DIMS, len(axes)) + 1
    boxes = written(placed.groupBy("block").agg(F.array(*[F.min(F.col("place")[k]) for k in range(dims)]).alias("low"), F.array(*[F.max(F.col("place")[k]) for k in range(dims)]).alias("high")))
    blocks = boxes.agg(F.max("block")).first()[0] + 1
    pairs = _block_pairs(boxes, blocks, dims, grid[0])
    packed = placed.select("block", "id", "copies", "vector").groupBy("block").applyInArrow(_packed, "block long, ids binary, copies binary, data binary")

    # squares of the pair matrix: large enough to ship a block seldom, small enough for a task's memory and for all cores
    cores = distinct.sparkSession.sparkContext.defaultParallelism
    side = max(1, min(SQUARE_BYTES // (2 * BLOCK * len(axes) * (4 if raw == "f4" else 8)), int(blocks / sqrt(8 * cores))))
    pairs = written(pairs.select("a", "b", F.floor(F.col("a") / side).alias("i"), F.floor(F.col("b") / side).alias("j")))
    needed = pairs.select("i", "j", F.explode(F.array("a", "b")).alias("block")).distinct().join(packed, "block")
    return needed.groupBy("i", "j").cogroup(pairs.select(F.col("i").alias("row"), F.col("j").alias("column"), "a", "b").groupBy("row", "column")).applyInArrow(_squares(threshold, raw, axes, grid), "a long, b long, n long")


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """(id, n_links, component_id, kept) for each row: vectors linked at a cosine of at least `threshold`.

    Defined cases: a vector that is null, empty, zero or holds null or non-finite components, and a row with a null id, has no links,
    and its own id as component; only vectors of the same length are compared; equal vectors are linked;
    rows that repeat an id are vectors of their own in one component; an empty table gives an empty table; other columns are not read.
    """
    if not 0 < threshold < 1:
        raise ValueError("threshold must be between 0 and 1")
    x = F.col("vector")
    given = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(F.col("id").isNotNull() & (F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0), F.lit(False))
    given = given.withColumn("usable", usable).withColumn("h1", F.xxhash64(F.lit(1), x)).withColumn("h2", F.xxhash64(F.lit(2), x))
    good = given.where("usable").drop("usable")
    distinct = written(good.groupBy("h1", "h2", F.size("vector").alias("dim")).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")))
    found = None
    for row in distinct.select("dim").distinct().collect():  # vector lengths: one, as a rule
        part = _links(distinct.where(F.col("dim") == row["dim"]), threshold)
        found = part if found is None else found.union(part)
    spark = vectors.sparkSession
    found = written(spark.createDataFrame([], "a long, b long, n long") if found is None else found)
    joined = components(found.where("b IS NOT NULL").select("a", "b"))
    counts = found.where("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("n"))
    groups = distinct.select("h1", "h2", "id", "copies").join(counts.withColumnRenamed("a", "id"), "id", "left").join(joined.withColumnRenamed("node", "id"), "id", "left")
    groups = groups.select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "id").alias("component"), F.lit(True).alias("usable"))
    out = given.drop("vector").join(groups, ["h1", "h2", "usable"], "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
