"""Spots: connected strong pixels in two and three dimensions, and what is measured on them.

`strong`: dataset, frame, y, x, value.  Datasets have numbers or names.  Pixels of a slice are labelled in one pass over the slice (a task holds one
slice's strong pixels); only links between the parts of neighbouring slices go through the distributed components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import vec as V
from ..plans.scratch import written
from .graph import components, forest

#: Bits of a packed coordinate: slice, y, x; 63 - 48 are left for the number of the dataset.
_Z, _Y, _X = 20, 14, 14


def packed(dataset: Column, z: Column, y: Column, x: Column) -> Column:
    """A pixel's number: dataset numbers under 2 ** 15, slices under 2 ** 20, rows and columns under 2 ** 14; null beyond that."""
    fits = (dataset >= 0) & (dataset < 1 << 63 - _Z - _Y - _X) & (z >= 0) & (z < 1 << _Z) & (y >= 0) & (y < 1 << _Y) & (x >= 0) & (x < 1 << _X)
    return F.when(fits, F.shiftleft(dataset.cast("long"), _Z + _Y + _X) + F.shiftleft(z.cast("long"), _Y + _X) + F.shiftleft(y.cast("long"), _X) + x.cast("long"))


def with_slices(strong: DataFrame, frames: DataFrame | None = None, *, glue: bool = False) -> DataFrame:
    """Adds z. By default z is the frame number; `glue` numbers the frames that are held, so a missing one does not part its neighbours."""
    if not glue:
        return strong.withColumn("z", F.col("frame"))
    held = (strong if frames is None else frames).select("dataset", "frame").distinct()
    held = held.withColumn("z", F.dense_rank().over(Window.partitionBy("dataset").orderBy("frame")) - 1)
    return strong.join(held, ["dataset", "frame"])


def adjacency(strong: DataFrame, *, across_frames: bool, wrap_width: int | None = None) -> DataFrame:
    """Links (a, b) of neighbouring strong pixels: right, below and, if wanted, the same pixel of the next slice.

    `wrap_width` also links the last pixel of a row of that width with the first of the next, as flat indices do.
    """
    here = strong.select("dataset", "z", "y", "x", packed(F.col("dataset"), F.col("z"), F.col("y"), F.col("x")).alias("a"))
    steps = [(0, 0, 1), (0, 1, 0)] + ([(1, 0, 0)] if across_frames else [])
    # one shuffle for all directions: each pixel asks for its neighbours by name
    asked = here.select("a", "dataset", F.explode(F.array(*[F.struct((F.col("z") + p).alias("z"), (F.col("y") + q).alias("y"), (F.col("x") + r).alias("x")) for p, q, r in steps])).alias("to"))
    asked = asked.select("a", packed(F.col("dataset"), F.col("to.z"), F.col("to.y"), F.col("to.x")).alias("b"))
    if wrap_width is not None:
        asked = asked.union(here.where(F.col("x") == wrap_width - 1).select("a", packed(F.col("dataset"), F.col("z"), F.col("y") + 1, F.lit(0)).alias("b")))
    return asked.join(here.select(F.col("a").alias("b")), "b").select("a", "b")


def slice_parts(y: np.ndarray, x: np.ndarray, wrap_width: int | None = None) -> np.ndarray:
    """For each strong pixel of a slice the smallest place (y * 2 ** 14 + x) of the pixels it is connected with, right, left, up and down."""
    place = (y.astype(np.int64) << _X) + x
    order = np.argsort(place)
    known = place[order]

    def links(to: np.ndarray, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(known, to), len(known) - 1)
        hit = asks & (known[at] == to)
        return place[hit], to[hit]

    every = np.ones(len(place), bool)
    found = [links(place + 1, every), links(place + (1 << _X), every)]
    if wrap_width is not None:
        found.append(links((y.astype(np.int64) + 1) << _X, x == wrap_width - 1))
    node, part = forest(*(np.concatenate(c) for c in zip(*found, strict=True)))
    out = place.copy()
    if len(node):
        sort = np.argsort(node)
        at = np.minimum(np.searchsorted(node[sort], place), len(node) - 1)
        hit = node[sort][at] == place
        out[hit] = part[sort][at[hit]]
    return out


def labelled(strong: DataFrame, *, across_frames: bool | str, wrap_width: int | None = None) -> DataFrame:
    """Adds `spot`: a number of the connected pixels, the packed place of the first in order (z, y, x); slices are counted through all datasets in their order. Needs z.

    `across_frames` may name a boolean column, the same for all rows of a dataset: only slices of rows in which it is true are linked with the next ones.

    Images have under 2 ** 14 rows and columns, a dataset under 2 ** 20 slices (a spot beyond that raises), all datasets together under 2 ** 35. Runs jobs when
    the function is called.
    """
    columns = strong.columns

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        y, x = (rows.column(c).to_numpy().astype(np.int64) for c in ("y", "x"))
        return rows.append_column("__part", pa.array(slice_parts(y, x, wrap_width)))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in strong.schema)
    # written once: the frames behind the strong pixels are not worked out again for the numbers and the links
    parts = written(strong.groupBy("dataset", "z").applyInArrow(run, f"{schema}, __part long"))
    # a row for each dataset: the slices of those before it
    before = Window.orderBy(F.col("dataset").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    number = parts.groupBy("dataset").agg(F.max(F.col("z").cast("long")).alias("__top")).withColumn("__first", F.coalesce(F.sum(F.greatest("__top", F.lit(0)) + 1).over(before), F.lit(0))).drop("__top")
    rows = parts.join(number, "dataset")
    fits = (F.col("z") >= 0) & (F.col("z") < 1 << _Z) & F.col("__part").between(0, (1 << _Y + _X) - 1) & (F.col("__first") + F.col("z") < 1 << 63 - _Y - _X)
    node = F.when(fits, F.shiftleft(F.col("__first") + F.col("z"), _Y + _X) + F.col("__part"))
    rows = rows.withColumn("__node", F.coalesce(node, F.raise_error(F.lit("a slice or pixel is beyond the packed ranges")).cast("long"))).drop("__first", "__part")
    if not across_frames:
        return rows.select(*columns, F.col("__node").alias("spot"))
    linked = rows.where(F.col(across_frames)) if isinstance(across_frames, str) else rows
    here = linked.select("dataset", "y", "x", "z", F.col("__node").alias("a"))
    above = linked.select("dataset", "y", "x", (F.col("z") - 1).alias("z"), F.col("__node").alias("b"))
    found = components(here.join(above, ["dataset", "y", "x", "z"]).select("a", "b").distinct())
    out = rows.join(found.withColumnRenamed("node", "__node"), "__node", "left")
    return out.select(*columns, F.coalesce("component", "__node").alias("spot"))


def boxes_2d(spots: DataFrame, min_spot_size: int = 0) -> DataFrame:
    """Box and number of pixels of each component of a frame; small ones go."""
    boxes = spots.groupBy("dataset", "frame", "spot").agg(F.min("x").alias("l"), F.min("y").alias("t"), F.max("x").alias("r"), F.max("y").alias("b"), F.count(F.lit(1)).alias("n_px"))
    return boxes.where(F.col("n_px") >= min_spot_size)


def measured(spots: DataFrame) -> DataFrame:
    """A row for each spot: pixels, box, depth, total, centre of mass (pixel centres at +0.5; null if the total is 0), peak, their distance."""
    weight = F.col("value")
    total = F.sum(weight)
    com = lambda c: (F.sum((2 * F.col(c) + 1) * weight) / (2 * F.when(total != 0, total))).cast("double")
    first = F.struct(weight.alias("v"), (-F.col("z")).alias("z"), (-F.col("y")).alias("y"), (-F.col("x")).alias("x"))
    rows = spots.groupBy("dataset", "spot").agg(
        F.count(F.lit(1)).alias("n_px"), *(f(c).alias(f"{c}_{n}") for c in "xyz" for n, f in (("min", F.min), ("max", F.max))),
        total.alias("total"), com("x").alias("com_x"), com("y").alias("com_y"), com("z").alias("com_z"), F.max(first).alias("__peak"),
    )
    rows = rows.withColumns({"depth": F.col("z_max") - F.col("z_min") + 1, "peak_value": F.col("__peak.v"), **{f"peak_{c}": -F.col(f"__peak.{c}") for c in "zyx"}}).drop("__peak")
    apart = sum(((F.col(f"com_{c}") - (F.col(f"peak_{c}") + 0.5)) ** 2 for c in "yz"), (F.col("com_x") - (F.col("peak_x") + 0.5)) ** 2)
    return rows.withColumn("peak_distance", F.sqrt(apart))


def filtered(spots: DataFrame, *, min_spot_size: int = 0, max_separation: float = 0.0) -> DataFrame:
    """Spots of at least so many pixels whose peak lies that close to their centre; 0 turns a filter off."""
    if min_spot_size:
        spots = spots.where(F.col("n_px") >= min_spot_size)
    return spots.where(F.col("peak_distance") <= max_separation) if max_separation else spots


def filter_report(spots: DataFrame, *, min_spot_size: int = 0, max_separation: float = 0.0) -> DataFrame:
    """How many spots each filter takes out of each dataset (0 where it is off)."""
    small = F.col("n_px") < min_spot_size if min_spot_size else F.lit(False)
    far = ~small & (F.col("peak_distance") > max_separation) if max_separation else F.lit(False)
    return spots.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_spots"), F.count_if(small).alias("n_small"), F.count_if(far).alias("n_far"))


def routed(rows: DataFrame, datasets: DataFrame) -> DataFrame:
    """Adds `turning`: is the row's dataset a rotation scan? `datasets`: dataset, osc_width.

    Scans have an oscillation width above 0. All others are stills, each frame by itself: a width of 0 or below, NaN or null, and datasets without a row. A dataset
    with more rows is a scan if one of them says so.
    """
    width = F.col("osc_width")
    scans = datasets.where((width > 0) & ~F.isnan(width.cast("double")) & F.col("dataset").isNotNull()).select("dataset").distinct().withColumn("turning", F.lit(True))
    return rows.join(scans, "dataset", "left").withColumn("turning", F.coalesce("turning", F.lit(False)))


def found_spots(strong: DataFrame, datasets: DataFrame, *, min_spot_size: int = 0, min_scan_size: int = 0, max_separation: float = 0.0) -> DataFrame:
    """Spots of scans in three dimensions and of stills frame by frame, from one labelling of all datasets.

    Columns of `measured`, `turning`, and `frame`: the frame of a still's spot, null for a scan's. `min_spot_size` holds for stills' spots, the other two for those of
    scans, as in `filtered`. Datasets without strong pixels have no rows, nor do frames (see `still_counts`). Runs jobs when it is called.
    """
    rows = written(labelled(with_slices(routed(strong, datasets)), across_frames="turning"))
    kinds = rows.groupBy("dataset", "spot").agg(F.first("turning").alias("turning"))
    spots = measured(rows).join(kinds, ["dataset", "spot"])
    scans = filtered(spots.where("turning"), min_spot_size=min_scan_size, max_separation=max_separation)
    stills = filtered(spots.where("NOT turning"), min_spot_size=min_spot_size)
    return scans.withColumn("frame", F.lit(None).cast("int")).unionByName(stills.withColumn("frame", F.col("z_min").cast("int")))


def still_counts(frames: DataFrame, strong: DataFrame, spots: DataFrame, datasets: DataFrame) -> DataFrame:
    """A row for each frame of the stills: dataset, frame, n_strong, n_spots; frames without any count 0. `spots` are those of `found_spots`."""
    key = ["dataset", "frame"]
    held = routed(frames.select(*key).distinct(), datasets).where("NOT turning").drop("turning")
    pixels = strong.groupBy(*key).agg(F.count(F.lit(1)).alias("n_strong"))
    counts = spots.where("NOT turning").groupBy(*key).agg(F.count(F.lit(1)).alias("n_spots"))
    rows = held.join(pixels, key, "left").join(counts, key, "left")
    return rows.select(*key, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_strong", "n_spots")))


def still_centroids(spots: DataFrame, frames: DataFrame) -> DataFrame:
    """Spots of stills with `id`, the rank of their frame among the frames held (those without spots count)."""
    rank = frames.select("dataset", "frame").distinct().withColumn("id", F.dense_rank().over(Window.partitionBy("dataset").orderBy("frame")) - 1)
    return spots.join(rank, ["dataset", "frame"])


def variances(pixels: DataFrame, spots: DataFrame, geometry: dict) -> DataFrame:
    """Intensity-weighted mean squares of e1, e2 and e3 about each spot's centre: (sigma_b_variance, sigma_m_variance, depth).

    `geometry`: fast, slow, origin, px, wavelength, s0, axis, image_start, osc_start, osc_width.
    """
    g = geometry
    panel = {k: g[k] for k in ("fast", "slow", "origin", "px", "wavelength")}
    angle = lambda z: F.radians(g["osc_start"] + (z - g["image_start"]) * g["osc_width"])
    # a ray for each spot, then one for each pixel
    centres = G.with_ray(spots.select("dataset", "spot", "com_x", "com_y", "com_z", "depth"), "__c", F.col("com_x"), F.col("com_y"), **panel)
    rows = G.with_ray(pixels.join(centres, ["dataset", "spot"]), "__o", F.col("x") + 0.5, F.col("y") + 0.5, **panel)
    ray = lambda n: tuple(F.col(f"__{n}{c}") for c in "xyz")
    rows = G.with_kabsch(rows, ray("o"), angle(F.col("z") + 0.5), ray("c"), angle(F.col("com_z")), g["s0"], g["axis"])
    v, e1, e2, e3 = (F.col(c) for c in ("value", "e1", "e2", "e3"))
    rows = rows.select("dataset", "spot", "depth", v, (v * e1 * e1).alias("a"), (v * e2 * e2).alias("b"), (v * e3 * e3).alias("c"))
    total = F.sum("value")
    return rows.groupBy("dataset", "spot").agg(((F.sum("a") + F.sum("b")) / (2 * total)).alias("sigma_b_variance"), (F.sum("c") / total).alias("sigma_m_variance"), F.max("depth").alias("depth"))


def global_sigmas(spot_variances: DataFrame, min_depth: int = 5) -> DataFrame:
    """sigma_b over all spots, sigma_m over those of some depth."""
    return spot_variances.groupBy("dataset").agg(F.sqrt(F.avg("sigma_b_variance")).alias("sigma_b"), F.sqrt(F.avg(F.when(F.col("depth") >= min_depth, F.col("sigma_m_variance")))).alias("sigma_m"))


def squared_deviation(calculated, observed, s0, phi_calculated: Column, phi_observed: Column, axis) -> tuple[Column, Column]:
    """Squares of an observed ray's distance from the calculated one: (e1^2 + e2^2) / 2 and e3^2."""
    e1, e2, e3, _ = G.kabsch(observed, phi_observed, calculated, s0, phi_calculated, axis)
    return (e1 * e1 + e2 * e2) / 2, e3 * e3


def integration_sigmas(indexed: DataFrame, s0, axis, *, min_depth: int = 6, worst_deg: float = 0.1) -> DataFrame:
    """sigma_b and sigma_m for integration from indexed spots: spot variances and positional residuals, added in quadrature.

    `indexed`: dataset, s1_obs, s1_cal, phi_obs, phi_cal, sigma_b_variance, sigma_m_variance, depth, used, indexed. Rows used in
    refinement count if the dataset has any, else the indexed ones; residuals of over `worst_deg` are left out.
    """
    any_used = F.max(F.col("used").cast("int")).over(Window.partitionBy("dataset"))
    rows = indexed.withColumn("__any", any_used).where(F.when(F.col("__any") == 1, F.col("used")).otherwise(F.col("indexed")))
    b, m = squared_deviation(F.col("s1_cal"), F.col("s1_obs"), s0, F.col("phi_cal"), F.col("phi_obs"), axis)
    near = V.angle_deg(F.col("s1_cal"), F.col("s1_obs")) < worst_deg
    return rows.groupBy("dataset").agg(
        F.sqrt(F.coalesce(F.avg("sigma_b_variance"), F.lit(0.0)) + F.coalesce(F.avg(F.when(near, b)), F.lit(0.0))).alias("sigma_b"),
        F.sqrt(F.coalesce(F.avg(F.when(F.col("depth") >= min_depth, F.col("sigma_m_variance"))), F.lit(0.0)) + F.coalesce(F.avg(F.when(near, m)), F.lit(0.0))).alias("sigma_m"),
    )
