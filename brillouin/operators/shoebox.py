"""Shoeboxes: reflections joined with the pixels of their boxes, classified and summed.

`reflections`: refl_id, dataset, x_min, x_max, y_min, y_max, z_min, z_max (half-open) and what the classification needs.
`pixels`: dataset, frame, y, x, value, valid.  Frames count from 0 as z does.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import vec as V


def on_frames(reflections: DataFrame) -> DataFrame:
    """A row for each frame that a reflection spans."""
    some = reflections.where(F.col("z_max") > F.col("z_min"))
    return some.withColumn("frame", F.explode(F.sequence(F.col("z_min"), F.col("z_max") - 1)))


def box_pixels(reflections: DataFrame) -> DataFrame:
    """A row for each pixel of each box, in the image or not. Empty boxes give none."""
    some = on_frames(reflections).where((F.col("x_max") > F.col("x_min")) & (F.col("y_max") > F.col("y_min")))
    rows = some.withColumn("y", F.explode(F.sequence(F.col("y_min"), F.col("y_max") - 1)))
    return rows.withColumn("x", F.explode(F.sequence(F.col("x_min"), F.col("x_max") - 1)))


def joined(reflections: DataFrame, pixels: DataFrame) -> DataFrame:
    """Box pixels with value and valid; null where a pixel lies outside the image.

    Frames that no reflection needs are not shuffled, and both sides are dealt by (dataset, frame, y), so a
    box row finds its pixels and no frame lands in one task.
    """
    rows = box_pixels(reflections)
    needed = on_frames(reflections).select("dataset", "frame").distinct()
    pixels = pixels.join(needed, ["dataset", "frame"], "left_semi")
    return rows.join(pixels.select("dataset", "frame", "y", "x", "value", "valid"), ["dataset", "frame", "y", "x"], "left")


def is_foreground(x: Column, y: Column, frame: Column, s1, phi: Column, geometry: dict, delta_b: float, delta_m: float, *, flat: bool = False) -> Column:
    """Does any corner of a pixel, on the first or last face of its image, lie in the reflection's ellipsoid?

    If the reflection's own angle lies inside the image its face counts as passing there. `flat` leaves rotation out.
    """
    g = geometry
    e3s = []
    for k in (0, 1):
        angle = F.radians(g["osc_start"] + (frame + k - (g["image_start"] - 1)) * g["osc_width"])
        e3s.append(angle)
    within = (F.least(*e3s) < phi) & (phi < F.greatest(*e3s))
    z = G.zeta(s1, g["s0"], g["axis"])
    depth = F.lit(0.0) if flat else F.when(within, 0.0).otherwise(F.least(*[(z * (a - phi) / delta_m) ** 2 for a in e3s]))
    e1 = V.unit(V.cross(s1, g["s0"]))
    e2 = V.unit(V.cross(s1, e1))
    length = V.norm(s1)
    corners = []
    for dx in (0, 1):
        for dy in (0, 1):
            ray = G.diffracted(G.lab_point((x + dx) * g["px"][0], (y + dy) * g["px"][1], g["fast"], g["slow"], g["origin"]), g["wavelength"])
            shift = V.sub(ray, s1)
            corners.append(((V.dot(e1, shift) / length) ** 2 + (V.dot(e2, shift) / length) ** 2) / delta_b**2)
    return F.least(*corners) + depth <= 1


def summed(box: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Foreground and background of each reflection in one aggregation. Needs `foreground`.

    `ok`: no foreground pixel is masked or outside the image. Coordinates are summed as 2 c + 1, so sums stay whole numbers.
    """
    usable = F.coalesce(F.col("valid"), F.lit(False))
    fg, bg = F.col("foreground") & usable, ~F.col("foreground") & usable
    v = F.when(fg, F.col("value"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return box.groupBy(*(key or ["refl_id"])).agg(
        zero(F.sum(v)).alias("fg_sum"), F.count_if(fg).alias("n_fg"), F.count_if(bg).alias("n_bg"), F.bool_and(~F.col("foreground") | usable).alias("ok"),
        *(zero(F.sum(v * (2 * F.col(c) + 1))).alias(f"{c}_moment") for c in ("x", "y", "frame")), zero(F.sum(F.when(bg, F.col("value")))).alias("bg_sum"),
    )


SUMS = ("fg_sum", "n_fg", "n_bg", "n_fg_bad", "x_moment", "y_moment", "frame_moment", "bg_sum")


Rule = Callable[[np.ndarray, np.ndarray, np.ndarray, dict[str, np.ndarray]], np.ndarray]


def summed_dense(reflections: DataFrame, frames: DataFrame, foreground: Rule) -> DataFrame:
    """What `summed` gives for `refl_id`, from dense frames (dataset, frame, h, w, data, valid)."""
    return totals(frame_sums(reflections, frames, foreground))


def totals(parts: DataFrame) -> DataFrame:
    whole = parts.groupBy("refl_id").agg(*(F.sum(c).alias(c) for c in SUMS))
    return whole.select("refl_id", "fg_sum", "n_fg", "n_bg", (F.col("n_fg_bad") == 0).alias("ok"), "x_moment", "y_moment", "frame_moment", "bg_sum")


def frame_sums(reflections: DataFrame, frames: DataFrame, foreground: Rule, *, histogram: bool = False, pixels: int = 1 << 22) -> DataFrame:
    """(refl_id, SUMS) of each box on each frame; with `histogram` also values and counts of its background pixels.

    Boxes meet frames, not pixels: a frame comes with the boxes on it, their pixels are summed with numpy (`pixels` of them at a time),
    and only a row for each box and frame shuffles on. `foreground(x, y, frame, columns)` gets arrays with an element for each box pixel,
    `columns` the reflection's own.
    """
    own = [c for c in reflections.columns if c not in ("dataset", "z_min", "z_max")]
    boxes = on_frames(reflections.where((F.col("x_max") > F.col("x_min")) & (F.col("y_max") > F.col("y_min"))))

    def sums(rows: dict[str, np.ndarray], value: np.ndarray | None, valid: np.ndarray | None) -> tuple[np.ndarray, pa.Array, pa.Array]:
        wide, high = rows["x_max"] - rows["x_min"], rows["y_max"] - rows["y_min"]
        n = wide * high
        which = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        x, y = rows["x_min"][which] + at % wide[which], rows["y_min"][which] + at // wide[which]
        frame = rows["frame"][which]
        inside = np.zeros(len(x), bool) if value is None else (x >= 0) & (y >= 0) & (x < value.shape[1]) & (y < value.shape[0])
        v, usable = np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        if value is not None:
            v[inside], usable[inside] = value[y[inside], x[inside]], valid[y[inside], x[inside]]
        fg = foreground(x, y, frame, {c: rows[c][which] for c in own})
        some, rest = fg & usable, ~fg & usable
        total = lambda w: np.bincount(which, weights=w, minlength=len(n))
        found = np.stack([total(v * some), total(some), total(rest), total(fg & ~usable), *(total(v * some * (2 * c + 1)) for c in (x, y, frame)), total(v * rest)]).astype(np.int64)
        pairs, count = np.unique(np.stack([which[rest & (v >= 0)], v[rest & (v >= 0)]]), axis=1, return_counts=True) if histogram else (np.zeros((2, 0), np.int64), np.zeros(0, np.int64))
        ends = pa.array(np.searchsorted(pairs[0], np.arange(len(n) + 1)).astype(np.int32))
        return found, pa.ListArray.from_arrays(ends, pa.array(pairs[1])), pa.ListArray.from_arrays(ends, pa.array(count.astype(np.int64)))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        rows = {c: left.column(c).to_numpy() for c in {*own, "x_min", "x_max", "y_min", "y_max", "frame"}}
        rows |= {c: rows[c].astype(np.int64) for c in ("x_min", "x_max", "y_min", "y_max", "frame")}
        value = valid = None
        if right.num_rows:
            h, w = (right.column(c)[0].as_py() for c in ("h", "w"))
            value = right.column("data").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(h, w)
            mask = right.column("valid").combine_chunks()
            valid = np.ones((h, w), bool) if mask.null_count else mask.flatten().to_numpy(zero_copy_only=False).astype(bool).reshape(h, w)
        size = np.cumsum((rows["x_max"] - rows["x_min"]) * (rows["y_max"] - rows["y_min"])) if left.num_rows else np.zeros(0)
        cuts = np.unique(np.concatenate([[0], np.searchsorted(size, np.arange(pixels, size[-1] if len(size) else 0, pixels)), [left.num_rows]])).astype(int)
        out = [sums({c: v[a:b] for c, v in rows.items()}, value, valid) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        found = np.concatenate([o[0] for o in out], 1) if out else np.zeros((len(SUMS), 0), np.int64)
        lists = {n: pa.chunked_array([o[k] for o in out], pa.list_(pa.int64())) for k, n in ((1, "values"), (2, "counts"))} if histogram else {}
        return pa.table({"refl_id": left.column("refl_id"), **{c: found[k] for k, c in enumerate(SUMS)}, **lists})

    kind = reflections.schema["refl_id"].dataType.simpleString()
    images = frames.select(F.col("dataset").alias("__dataset"), F.col("frame").alias("__frame"), "h", "w", "data", "valid")
    needed = boxes.select(F.col("dataset").alias("__dataset"), F.col("frame").alias("__frame")).distinct()
    more = ", values array<long>, counts array<long>" if histogram else ""
    return boxes.groupBy("dataset", "frame").cogroup(images.join(needed, ["__dataset", "__frame"], "left_semi").groupBy("__dataset", "__frame")).applyInArrow(run, f"refl_id {kind}, " + ", ".join(f"{c} long" for c in SUMS) + more)


def with_centroid(rows: DataFrame) -> DataFrame:
    """Adds x_obs, y_obs, z_obs: from the sums, or the middle of the box without counts."""
    for c, lo, hi in (("x", "x_min", "x_max"), ("y", "y_min", "y_max"), ("frame", "z_min", "z_max")):
        mean = F.when(F.col("fg_sum") > 0, F.col(f"{c}_moment").cast("double") / (2 * F.col("fg_sum"))).otherwise((F.col(lo) + F.col(hi)) / 2)
        rows = rows.withColumn({"frame": "z_obs"}.get(c, f"{c}_obs"), mean)
    return rows


def success(ok: Column, n_fg: Column, valid: Column, skipped: Column) -> Column:
    return ok & (n_fg > 0) & valid & ~skipped


def per_image(reflections: DataFrame) -> DataFrame:
    """Least, greatest and mean number of reflections on an image."""
    n = on_frames(reflections).groupBy("dataset", "frame").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("dataset").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.avg("n").alias("mean"))


def largest_corner_grid(reflections: DataFrame) -> DataFrame:
    size = (F.col("x_max") - F.col("x_min") + 1) * (F.col("y_max") - F.col("y_min") + 1)
    return on_frames(reflections).groupBy("dataset", "frame").agg(F.max(size).alias("corners"))


def pass_histogram(reflections: DataFrame, batch: int) -> DataFrame:
    """Box sizes in passes of `batch` pixels, in six buckets weighted by depth: how uneven the work of the boxes is."""
    area = (F.col("x_max") - F.col("x_min")) * (F.col("y_max") - F.col("y_min"))
    passes = F.ceil(area / batch)
    bucket = F.when(passes <= 1, "1").when(passes == 2, "2").when(passes <= 4, "3-4").when(passes <= 8, "5-8").when(passes <= 16, "9-16").otherwise(">16")
    return reflections.groupBy(bucket.alias("passes")).agg(F.sum(F.col("z_max") - F.col("z_min")).alias("frames"))


def reusable_boxes(reflections: DataFrame, stored: DataFrame | None, computed: DataFrame) -> DataFrame:
    """Stored boxes if there is one for each reflection, else the computed ones."""
    if stored is not None and stored.count() == reflections.count():
        return stored
    return computed
