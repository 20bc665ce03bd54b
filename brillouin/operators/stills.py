"""Indexing of stills: each frame by itself, from candidate lattices that a search has given.

`panel`: fast, slow, origin, px, size.  A stream uses `index_stills` through `service.per_batch`: each micro-batch is a table of frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import vec as V
from ..plans.scratch import written
from . import indexing as I
from . import predict as P


def index_stills(spots: DataFrame, candidates: DataFrame, *, panel: dict, wavelength: float, s0, tolerance: float = 0.3, min_spots: int = 10, limit: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """(frames, reflections). `spots`: dataset, frame, id, x, y (pixels); `candidates`: dataset, frame, candidate, setting.

    Frames with `min_spots` or more are tried: every candidate indexes the frame's spots, duplicates of an index are settled, the candidate of
    most indexed spots stays, its spots are predicted, and those within `limit` pixels are kept. `frames` has a row for each frame that was
    accepted: candidate, setting, n, n_indexed, rmsd_x, rmsd_y, rmsd_psi; `reflections` the kept spots: id, h, k, l, x, y, x_cal, y_cal, delpsi.
    Frames without candidates, and those of too few kept spots, are in neither. Runs jobs when it is called.
    """
    geometry = {k: panel[k] for k in ("fast", "slow", "origin", "px")}
    tried = I.stills_attempted(spots.select("dataset", "frame", "id", "x", "y"), min_spots)
    rays = G.with_ray(tried, "__s", F.col("x"), F.col("y"), **geometry, wavelength=wavelength)
    points = V.sub(tuple(F.col(f"__s{c}") for c in "xyz"), s0)
    rows = written(rays.withColumns({f"__r{c}": v for c, v in zip("xyz", points, strict=True)}))
    cells = written(candidates.withColumn("__inverse", V.matrix(V.inverse(F.col("setting")))))
    key = ["dataset", "frame", "candidate"]
    tried = I.with_indices(rows.join(cells, ["dataset", "frame"]), tuple(F.col(f"__r{c}") for c in "xyz"), None, tolerance, inverse=F.col("__inverse")).withColumn("phi", F.lit(0.0))
    indexed = written(I.settle_duplicates(tried.drop("__inverse", *(f"__{n}{c}" for n in "sr" for c in "xyz")), key).where("lsq IS NOT NULL"))
    counts = indexed.groupBy(*key).agg(F.count(F.lit(1)).alias("n_indexed"))
    best = I.most_indexed(counts, ["dataset", "frame"]).select(*key)
    chosen = written(P.repredicted_stills(indexed.join(best, key), F.col("setting"), V.parts(s0)))
    x_mm, y_mm = G.ray_on_panel(V.parts(F.col("s1")), panel["fast"], panel["slow"], panel["origin"])
    placed = chosen.withColumns({"x_cal": x_mm / panel["px"][0], "y_cal": y_mm / panel["px"][1]}).withColumnsRenamed({"x": "x_obs", "y": "y_obs"})
    placed = written(placed.select(*key, "setting", "id", "h", "k", "l", "x_obs", "y_obs", "x_cal", "y_cal", "delpsi"))
    frames = I.still_rmsds(placed, [*key, "setting"], limit)
    frames = frames.where(I.stills_accepted(F.col("n_indexed"), min_spots))
    kept = placed.where(I.residual_filter(F.col("x_obs") - F.col("x_cal"), F.col("y_obs") - F.col("y_cal"), limit)).join(frames.select(*key), key, "left_semi")
    return frames, kept
