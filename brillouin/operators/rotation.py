"""Rotation indexing from candidate lattices to refined models, for all datasets at the same time.

Spots are rows (dataset, id, x_mm, y_mm, phi in radians, and `overloaded`); models are columns of arrays (`refine.ARRAY`). A candidate is a (dataset, candidate)
with a setting matrix. Candidates whose indices show an absence pattern take the smaller cell and are indexed again, until none shows one;
then all of them are refined together and scored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import vec as V
from ..functions.lattice import reindexings, with_basis
from ..plans.scratch import written
from . import indexing as I
from .predict import repredicted
from .refine import FREE, fitted, part, with_setting

KEY = ["dataset", "candidate"]
#: Rounds of the basis correction: each divides a cell by 2 at least.
CORRECTIONS = 12


def reciprocal_spots(spots: DataFrame, models: DataFrame) -> DataFrame:
    """Adds rlp, s1 (structs) and entering: spots seen with the model of their dataset. Spots of datasets without a model go."""
    m = F.col("model")
    rows = spots.join(models.select("dataset", "model"), "dataset")
    s0, axis = part(m, "s0"), part(m, "axis")
    ray = V.unit(G.lab_point(F.col("x_mm"), F.col("y_mm"), part(m, "fast"), part(m, "slow"), part(m, "origin")))
    rows = written(rows.withColumn("s1", V.vector(*V.scale(ray, V.norm(s0)))))
    s1 = V.parts(F.col("s1"))
    return rows.withColumns({"rlp": V.vector(*G.reciprocal_point(s1, s0, axis, F.col("phi"))), "entering": G.entering(s1, s0, axis)}).drop("model")


def indexed(spots: DataFrame, settings: DataFrame, key: list[str], tolerance: float = 0.3) -> DataFrame:
    """Spots of each of `settings` (*key, setting) with h, k, l and lsq; of rows that share an index in like phi one keeps it. Settings of a dataset are joined with its spots."""
    inverse = settings.withColumn("__inverse", V.matrix(V.inverse(F.col("setting")))).drop("setting")
    rows = spots.select("dataset", "id", "phi", "rlp").join(inverse, "dataset")
    rows = I.with_indices(rows, V.parts(F.col("rlp")), None, tolerance, inverse=F.col("__inverse")).select(*key, "id", "phi", "h", "k", "l", "lsq")
    return I.settle_duplicates(written(rows), key)  # as a table, since a filter on lsq would work out all indices in it again


def absence_patterns(rows: DataFrame, key: list[str], threshold: float = 0.9) -> DataFrame:
    """(*key, n_indexed, n, pattern) of indexed rows: the first pattern of `reindexings` that over `threshold` of the indices follow, or null. One aggregation, no row is repeated."""
    h, k, l = (F.col(c) for c in "hkl")  # noqa: E741
    real = (h != 0) | (k != 0) | (l != 0)
    hits = [F.count_if(real & (F.pmod(h * int(u) + k * int(v) + l * int(w), F.lit(m)) == 0)) for (u, v, w), m, _ in reindexings()]
    counts = rows.groupBy(*key).agg(F.count_if(real).alias("n_indexed"), F.count(F.lit(1)).alias("n"), F.array(*hits).alias("__hits"))
    first = F.array_position(F.transform("__hits", lambda x: x > threshold * F.col("n_indexed")), F.lit(True)) - 1
    return counts.select(*key, "n_indexed", "n", F.when(first >= 0, first.cast("int")).alias("pattern"))


def _rebased(settings: pd.Series, patterns: pd.Series) -> pd.Series:
    table = reindexings()
    return pd.Series([with_basis(np.asarray(a).reshape(3, 3), table[p][2]).ravel() for a, p in zip(settings, patterns, strict=True)])


def primitive_settings(spots: DataFrame, candidates: DataFrame, key: list[str] = KEY, *, tolerance: float = 0.3, threshold: float = 0.9) -> DataFrame:
    """(*key, setting, n_indexed, n): candidates with cells that no absence pattern divides any more.

    Only candidates whose setting has changed are indexed again. A candidate that indexes nothing stays as it is; one whose dataset has no spots has n = 0.
    """
    rebased = F.pandas_udf(_rebased, "array<double>", F.PandasUDFType.SCALAR)
    moving, settled = written(candidates.select(*key, "setting")), None
    for _ in range(CORRECTIONS):
        found = written(moving.join(absence_patterns(indexed(spots, moving, key, tolerance), key, threshold), key, "left"))
        rest = found.where("pattern IS NULL").select(*key, "setting", F.coalesce("n_indexed", F.lit(0)).alias("n_indexed"), F.coalesce("n", F.lit(0)).alias("n"))
        settled = rest if settled is None else settled.union(rest)
        moving = written(found.where("pattern IS NOT NULL").select(*key, rebased("setting", "pattern").alias("setting")))
        if moving.isEmpty():
            return written(settled)
    raise RuntimeError(f"cells did not settle in {CORRECTIONS} rounds")


def refinement_rows(spots: DataFrame, indices: DataFrame, models: DataFrame, key: list[str], *, per_degree: int, least: int = 1000) -> DataFrame:
    """Rows to refine each of `models` (*key, model, width): indexed, not overloaded, not along the axis, inside Tukey's fences of their residuals, and a fixed sample of those.

    Columns: *key, id, h, k, l, x_mm, y_mm, phi, entering.
    """
    m = F.col("model")
    seen = spots.select("dataset", "id", "x_mm", "y_mm", "s1", "entering", "overloaded")
    rows = indices.where("h <> 0 OR k <> 0 OR l <> 0").select(*key, "id", "phi", "h", "k", "l").join(seen, ["dataset", "id"]).join(models.select(*key, "model", "width"), key)
    rows = I.refinement_filter(rows.withColumn("flags", F.lit(0).cast("long")), V.parts(F.col("s1")), part(m, "s0"), part(m, "axis"), F.coalesce("overloaded", F.lit(False)))
    rows = written(rows.withColumns({"setting": V.matrix(V.multiply(part(m, "orientation"), part(m, "shape"))), "phi_obs": F.col("phi")}).drop("s1"))
    rows = written(repredicted(rows, F.col("setting"), part(m, "s0"), part(m, "axis")))
    x, y = G.ray_on_panel(V.parts(F.col("s1")), part(m, "fast"), part(m, "slow"), part(m, "origin"))
    rows = rows.select(*key, "id", "h", "k", "l", "x_mm", "y_mm", "phi", "entering", "width", (x - F.col("x_mm")).alias("dx"), (y - F.col("y_mm")).alias("dy"), (F.col("phi_cal") - F.col("phi")).alias("dphi"))
    good = I.without_outliers(rows, key, ["dx", "dy", "dphi"])
    return I.sampled(good, "id", per_degree, F.col("width"), least=least, key=tuple(key)).drop("width", "dx", "dy", "dphi")


def evaluated_candidates(spots: DataFrame, candidates: DataFrame, geometry: DataFrame, *, tolerance: float = 0.3, per_degree: int = 20, least: int = 1000, free: tuple[int, ...] = FREE) -> DataFrame:
    """All candidates (dataset, candidate, setting) of all datasets, assigned, corrected to primitive cells, refined and scored together.

    `geometry` is (dataset, model, width): beam, axis and panel of each dataset (the crystal of `model` is not used) and the degrees it spans.
    Returns (dataset, candidate, model, setting, n_indexed, fraction, rmsd, volume, score, rank); rank 1 is best.

    Defined cases: a candidate that indexes no spot that can be refined has null rmsd, score and rank; datasets without candidates have no rows; spots of
    other datasets are not read.
    """
    seen = written(reciprocal_spots(spots, geometry))
    cells = primitive_settings(seen, candidates, tolerance=tolerance)
    indices = written(indexed(seen, cells.select(*KEY, "setting"), KEY, tolerance))
    models = written(cells.join(geometry, "dataset").select(*KEY, "width", with_setting(F.col("model"), F.col("setting")).alias("model")))
    fit = fitted(refinement_rows(seen, indices, models, KEY, per_degree=per_degree, least=least), models, KEY, free=free)
    volume = 1 / F.abs(V.determinant(F.col("setting")))
    rows = fit.drop("n").join(cells.drop("setting"), KEY).select(*KEY, "model", "setting", "n_indexed", (F.col("n_indexed") / F.greatest("n", F.lit(1))).alias("fraction"), F.col("rmsd_xy").alias("rmsd"), volume.alias("volume"))
    rows = written(rows)
    ranked = I.scored(rows.where("rmsd IS NOT NULL AND n_indexed > 0").withColumn("rmsd", F.greatest("rmsd", F.lit(1e-12))), ["dataset"]).select(*KEY, "score", "rank")
    return rows.join(ranked, KEY, "left")


def macro_cycles(spots: DataFrame, models: DataFrame, limits: DataFrame, *, cycles: int = 5, done: int = 0, tolerance: float = 0.3, per_degree: int = 100, least: int = 1000, free: tuple[int, ...] = FREE) -> list[DataFrame]:
    """Models (dataset, model, setting, n, rmsd_x, rmsd_y, rmsd_phi, rmsd_xy) after each cycle from `done` on.

    In a cycle the spots are seen with the models so far, those within the cycle's resolution and the first turn are indexed again, filtered and sampled, and the models refined.
    `limits` is (dataset, start, end, osc_start, width): resolution falls in equal steps from `start`, that of the search, to `end`. Each table is in the shared folder:
    after a failure go on with the last one as `models` and the number of cycles `done`.
    """
    out: list[DataFrame] = []
    key = ["dataset"]
    for cycle in range(done, cycles):
        now = models.select("dataset", "model").join(limits.select("dataset", "start", "end", "osc_start", "width"), "dataset")
        seen = reciprocal_spots(spots, now).join(limits.select("dataset", "start", "end", "osc_start"), "dataset")
        limit: Column = I.resolution_step(F.col("start"), F.col("end"), cycle, cycles)
        seen = written(I.selection(seen, V.parts(F.col("rlp")), F.degrees("phi"), limit, F.col("osc_start")).drop("start", "end", "osc_start"))
        m = F.col("model")
        settings = now.select("dataset", V.matrix(V.multiply(part(m, "orientation"), part(m, "shape"))).alias("setting"))
        indices = written(indexed(seen, settings, key, tolerance))
        models = written(fitted(refinement_rows(seen, indices, now, key, per_degree=per_degree, least=least), now, key, free=free))
        out.append(models)
    return out
