"""Connected components of link tables by alternating large-star and small-star steps.

Each step hangs the neighbours of a node on the smallest of them; the links become stars around the smallest node
of each component in a logarithmic number of rounds.  A node of very many links is no group of its own anywhere: its
smallest neighbour is a partial aggregation, and handing it out is a join that Spark can split.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import written

_LINKS = "a long, b long"


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its component) that join the same nodes as the given links; both are long arrays."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = inverse[: len(a)], inverse[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        new = new[label]
        if np.array_equal(new, label):
            break
        label = new
    hung = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[hung], nodes[label[hung]]


def _contracted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b = forest(*(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    across = down.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return across.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node that has a link; component is the smallest node that it can reach.

    `links` has two long columns. Links of a node with itself and links with null are left out; repeated ones count once.
    """
    a, b = links.columns
    links = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where(F.col("a") != F.col("b"))
    now = written(links.mapInArrow(_contracted, _LINKS))
    before = None
    for _ in range(rounds):
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        now = written(_small_star(_large_star(now).where(F.col("a") != F.col("b"))))
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("node", F.col("node").alias("component")))
