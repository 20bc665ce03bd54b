"""Vector codes of four bytes: a codebook for each quarter of the vectors, trained by Lloyd rounds over cover trees.

A task cuts its vectors into blocks and builds one cover tree a block and quarter: a node covers the points within its radius, its
children are a net of points over half of that radius, and the points of a node lie side by side, so that two entries of
a cumulative sum give the sum of a whole subtree.  Trees are built once and written; every round reads them and goes down from the roots.
With the nearest entry at d from a node's centre and all its points within r, no entry beyond d + 2 r can be nearest to any of them.  Where
one entry is left, the whole subtree goes to it by its sum; otherwise its children are asked, and the points of a
node without children are compared exactly with the entries left.  Equal points of a block are one point with a weight.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .clustering import moved
from .integer_vectors import integers, largest, row_distances, rows_of, squared_distances, usable
from .shared import written

#: Vectors of a block, points of a node that needs no children, parts of a vector.
BLOCK, LEAF, PARTS = 2048, 8, 4
#: Sums of this many labels at most are broadcast.
LABELS = 100_000

_NODE = np.dtype([("lo", np.int32), ("hi", np.int32), ("centre", np.int32), ("parent", np.int32), ("level", np.int32), ("radius", np.float64)])


def _net(x: np.ndarray, first: int, radius: float) -> Iterator[tuple[int, np.ndarray, float]]:
    """Centres over `radius` apart, the points that each takes (no further away), and how far they reach; every point goes to the first centre that takes it."""
    far = squared_distances(x, x)
    near = far <= radius * radius
    alone = near.sum(1) == 1
    alone[first] = False
    for k in np.flatnonzero(alone):  # no other point is near: in no one's way
        yield k, np.array([k]), 0.0
    left = np.flatnonzero(~alone)
    while len(left):
        taken = near[first, left]
        members = left[taken]
        yield first, members, float(np.sqrt(far[first, members].max()))
        left = left[~taken]
        first = left[0] if len(left) else first


class CoverTree:
    """Distinct points in the order of the tree, with weights; nodes level by level."""

    def __init__(self, points: np.ndarray, weights: np.ndarray, nodes: np.ndarray):
        self.points, self.weights, self.nodes = points, weights, nodes

    @classmethod
    def build(cls, rows: np.ndarray) -> tuple[CoverTree, np.ndarray]:
        """The tree of the rows, and the place of each row's point in it."""
        points, place, weights = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        x = points.astype(np.float64)
        order, nodes = np.arange(len(x)), []
        start = int(np.argmin(((x - x.mean(0)) ** 2).sum(1)))
        front = [(0, len(x), start, -1, float(np.sqrt(((x - x[start]) ** 2).sum(1).max())))]
        level = 0
        while front:
            below = []
            for lo, hi, centre, parent, radius in front:
                at = len(nodes)
                nodes.append((lo, hi, centre, parent, level, radius))
                if hi - lo <= LEAF or not radius:
                    continue
                inside = order[lo:hi].copy()
                for middle, members, reach in _net(x[inside], int(np.flatnonzero(inside == centre)[0]), radius / 2):
                    order[lo : lo + len(members)] = inside[members]
                    below.append((lo, lo + len(members), int(inside[middle]), at, reach))
                    lo += len(members)
            front, level = below, level + 1
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        held = np.array(nodes, _NODE)
        held["centre"] = rank[held["centre"]]
        return cls(points[order], weights[order], held), rank[place.ravel()]

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]], np.ndarray, np.ndarray]:
        """Sums and counts of each entry's points; subtrees (lo, hi, entry) that went whole; the other points and their entries.

        The nearest entry of a point is that of the smallest exact squared distance, ties to the lower index.
        """
        first = np.sort(np.unique(entries, axis=0, return_index=True)[1])  # of equal entries only the first can win
        book = entries[first]
        weighted = self.weights[:, None] * self.points
        sums, counts = np.concatenate([np.zeros((1, weighted.shape[1]), np.int64), weighted.cumsum(0)]), np.concatenate([[0], self.weights.cumsum()])
        total, n = np.zeros_like(entries), np.zeros(len(entries), np.int64)
        whole, single, doubt, masks = [], [], [], []
        slot = np.full(len(self.nodes), -1)  # row of a node's mask
        mask = np.ones((1, len(book)), bool)
        parents = np.unique(self.nodes["parent"])
        for level in range(int(self.nodes["level"][-1]) + 1):
            ids = np.flatnonzero(self.nodes["level"] == level)
            if level:
                ids = ids[slot[self.nodes["parent"][ids]] >= 0]
                if not len(ids):
                    break
                mask = mask[slot[self.nodes["parent"][ids]]]
            nodes = self.nodes[ids]
            far = np.where(mask, np.sqrt(squared_distances(self.points[nodes["centre"]], book).astype(np.float64)), np.inf)
            bound = far.min(1) + 2 * nodes["radius"]
            mask = far <= (bound * (1 + 1e-12) + 1e-9)[:, None]
            sure = mask.sum(1) == 1
            lo, hi, entry = nodes["lo"][sure], nodes["hi"][sure], first[mask[sure].argmax(1)]
            np.add.at(total, entry, sums[hi] - sums[lo])
            np.add.at(n, entry, counts[hi] - counts[lo])
            whole += zip(lo.tolist(), hi.tolist(), entry.tolist(), strict=True)
            end = ~sure & ~np.isin(ids, parents)
            for lo, hi, row in zip(nodes["lo"][end], nodes["hi"][end], mask[end], strict=True):
                doubt.append(np.arange(lo, hi))
                masks.append(np.broadcast_to(row, (hi - lo, len(book))))
            slot[:] = -1
            slot[ids[~sure]] = np.flatnonzero(~sure)
        points = np.concatenate(doubt) if doubt else np.zeros(0, np.int64)
        if doubt:
            exact = np.where(np.concatenate(masks), squared_distances(self.points[points], book), np.iinfo(np.int64).max)
            single = first[exact.argmin(1)]
            np.add.at(total, single, weighted[points])
            np.add.at(n, single, self.weights[points])
        return total, n, whole, points, np.asarray(single, np.int64)

    def labels(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each point in the order of the tree, and its exact squared distance."""
        _, _, whole, points, single = self.assign(entries)
        label = np.zeros(len(self.points), np.int64)
        for lo, hi, c in whole:
            label[lo:hi] = c
        label[points] = single
        return label, row_distances(self.points, entries[label])


def _filled(x: np.ndarray) -> np.ndarray:
    limit = largest(x.shape[1])
    return np.concatenate([np.clip(x, -limit, limit), np.zeros((len(x), -x.shape[1] % PARTS), np.int64)], 1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        length = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
        for dims in np.unique(length):
            chosen = np.flatnonzero(length == dims)
            for at in range(0, len(chosen), BLOCK):
                rows = batch.take(pa.array(chosen[at : at + BLOCK]))
                x = _filled(rows_of(rows.column(2), int(dims)))
                built = [CoverTree.build(part) for part in np.split(x, PARTS, axis=1)]
                lists = [rows.column(0), rows.column(1), pa.array(np.concatenate([place for _, place in built]).astype(np.int32))]
                columns = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in lists]
                columns += [pa.array([[getattr(tree, k).astype(kind).tobytes() for tree, _ in built]], pa.list_(pa.binary())) for k, kind in (("points", np.int32), ("weights", np.int64), ("nodes", _NODE))]
                yield pa.RecordBatch.from_arrays([pa.array([int(dims)], pa.int32()), *columns], ["dims", "id", "label", "place", "points", "weights", "nodes"])


def _trees(row: dict, width: int) -> list[CoverTree]:
    trees = []
    for points, weights, nodes in zip(row["points"], row["weights"], row["nodes"], strict=True):
        weights = np.frombuffer(weights, np.int64)
        points = np.frombuffer(points, np.int32).astype(np.int64).reshape(-1, width) if width else np.zeros((len(weights), 0), np.int64)
        trees.append(CoverTree(points, weights, np.frombuffer(nodes, _NODE)))
    return trees


class _Round:
    def __init__(self, books: np.ndarray):
        self.books = books  # part, entry, component

    def sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(part, entry, n, sums) of the whole task."""
        total, n = np.zeros_like(self.books), np.zeros(self.books.shape[:2], np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                for p, tree in enumerate(_trees(batch.slice(k, 1).to_pylist()[0], self.books.shape[2])):
                    s, c = tree.assign(self.books[p])[:2]
                    total[p] += s
                    n[p] += c
        part, entry = np.nonzero(n)
        if len(part):
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(n[part, entry]), pa.array(list(total[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                ids, labels, place = (row.column(c).flatten() for c in range(3))
                place = place.to_numpy().reshape(PARTS, -1)
                found = [tree.labels(book) for tree, book in zip(_trees(row.select(["points", "weights", "nodes"]).to_pylist()[0], self.books.shape[2]), self.books, strict=True)]
                code = np.stack([label[at] for (label, _), at in zip(found, place, strict=True)], 1).astype(np.uint8)
                error = sum(far[at] for (_, far), at in zip(found, place, strict=True))
                raw = code.tobytes().hex()
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array([raw[i : i + 2 * PARTS] for i in range(0, len(raw), 2 * PARTS)], pa.string()), pa.array(error, pa.int64())], ["id", "label", "code", "error"])


def _trained(blocks: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    for _ in range(rounds):
        parts = blocks.select("points", "weights", "nodes").mapInArrow(_Round(books).sums, "part long, entry long, n long, sums array<long>")
        books = moved(parts, books, "part", "entry")
    return books


def compress_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", entries: int = 256, rounds: int = 4, scale: int = 1024) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) for each vector.

    Components become floor(scale * x). The codebooks start as the quarters of the vectors with the smallest ids; a round assigns every quarter to the
    nearest entry of its codebook and moves each entry to the floor of its quarters' mean; at the end the quarters are assigned again.

    Defined cases: rows whose vector is null or holds null or non-finite components are left out; equal ids are ordered by their vectors, null ids come last;
    with fewer vectors than entries the codebooks are smaller; vectors of each length have codebooks (and a digest) of their own, lengths that four does
    not divide are filled up with zeros, empty vectors have empty parts and no error; rows that repeat are vectors each; null labels count as one
    label; a component counts as at most largest(dims) (2^27 for 64) up or down, so errors stay within a long, and a label's error ends there; an empty
    table gives an empty table; ids and labels may be of any type that can be compared; other columns are not read.
    """
    if not 0 < entries <= 256 or rounds < 0:
        raise ValueError("entries must be 1 to 256, rounds not negative")
    v = F.col("v")
    given = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v")).where(usable(v))
    types = [given.schema[c].dataType.simpleString() for c in ("id", "label")]
    lists = f"id array<{types[0]}>, label array<{types[1]}>, place array<int>, points array<binary>, weights array<binary>, nodes array<binary>"
    whole = written(given.withColumn("x", integers(v, scale, largest(1))).select("id", "label", "x"))
    blocks = written(whole.mapInArrow(_blocks, f"dims int, {lists}"))
    out = None
    for row in blocks.select("dims").distinct().collect():  # vector lengths: one, as a rule
        dims = row["dims"]
        starts = whole.where(F.size("x") == dims).orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).select("x").collect()  # `entries` rows
        books = _filled(np.array([r["x"] for r in starts], np.int64).reshape(len(starts), dims)).reshape(len(starts), PARTS, -(-dims // PARTS)).transpose(1, 0, 2)
        own = blocks.where(F.col("dims") == dims)
        books = _trained(own, books, rounds)
        digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
        coded = own.select("id", "label", "place", "points", "weights", "nodes").mapInArrow(_Round(books).rows, f"id {types[0]}, label {types[1]}, code string, error long").withColumn("codebooks_sha256", F.lit(digest))
        out = coded if out is None else out.union(coded)
    if out is None:
        out = vectors.sparkSession.createDataFrame([], f"id {types[0]}, label {types[1]}, code string, error long, codebooks_sha256 string")
    out = written(out)
    by_label = written(out.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit((1 << 63) - 1)).cast("long").alias("label_error")))
    if by_label.count() <= LABELS:
        by_label = F.broadcast(by_label)
    joined = out.join(by_label.withColumnRenamed("label", "other"), F.col("label").eqNullSafe(F.col("other")))
    return joined.select(F.col("id").alias(id_col), "code", "error", "label_error", "codebooks_sha256")
