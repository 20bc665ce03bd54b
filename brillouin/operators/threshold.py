"""Strong pixels by dispersion, as windows over pixel rows or as an Arrow kernel over dense frames.

`pixels`: dataset, frame, y, x, value (BIGINT), valid (BOOLEAN), a row for every pixel of the image.  Both paths sum
integers and test the multiplied-out form of the dispersion index, so they agree exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

IMAGE = ("dataset", "frame")


def with_validity(pixels: DataFrame, mask: DataFrame | None = None, trusted_max: int | None = None) -> DataFrame:
    """`valid`: not masked (no mask row: valid) and not above the trusted range."""
    if mask is not None:
        pixels = pixels.drop("valid").join(mask, ["dataset", "y", "x"], "left").withColumn("valid", F.coalesce("valid", F.lit(True)))
    elif "valid" not in pixels.columns:
        pixels = pixels.withColumn("valid", F.lit(True))
    if trusted_max is not None:
        pixels = pixels.withColumn("valid", F.col("valid") & (F.col("value") <= trusted_max))
    return pixels


def mask_from_raw(raw: Column, signed: bool = False) -> Column:
    """Validity of raw mask values: 0 is valid; in signed frames every value that is not negative."""
    return raw >= 0 if signed else raw == 0


def box(pixels: DataFrame, radius: int, reduce=F.sum, **columns: Column) -> DataFrame:
    """Adds each column reduced over the (2 radius + 1)-square around each pixel, cut at the image's edge.

    Separable: along x inside (frame, y), then along y inside (frame, x). Neighbours are found by coordinate.
    """
    along_x = Window.partitionBy(*IMAGE, "y").orderBy("x").rangeBetween(-radius, radius)
    along_y = Window.partitionBy(*IMAGE, "x").orderBy("y").rangeBetween(-radius, radius)
    rows = pixels.withColumns({f"__{k}": reduce(c).over(along_x) for k, c in columns.items()})
    return rows.withColumns({k: reduce(F.col(f"__{k}")).over(along_y) for k in columns}).drop(*(f"__{k}" for k in columns))


def prefix_table(pixels: DataFrame, **columns: Column) -> DataFrame:
    """Summed-area table: for each pixel the sum over all pixels above and left of it, itself included."""
    row = Window.partitionBy(*IMAGE, "y").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*IMAGE, "x").orderBy("y").rowsBetween(Window.unboundedPreceding, 0)
    rows = pixels.withColumns({f"__{k}": F.sum(c).over(row) for k, c in columns.items()})
    return rows.withColumns({k: F.sum(f"__{k}").over(down) for k in columns}).drop(*(f"__{k}" for k in columns))


def _moments(pixels: DataFrame, radius: int, big: int | None = None) -> DataFrame:
    inside = F.col("valid") if big is None else F.col("valid") & (F.col("value") < big)
    one, v = F.when(inside, 1).otherwise(0), F.when(inside, F.col("value")).otherwise(0)
    return box(pixels, radius, n=one.cast("long"), s=v.cast("long"), q=(v * v).cast("long"))


def _overdispersed(n_sig_b: float, min_count: int) -> Column:
    n, s, q = F.col("n"), F.col("s"), F.col("q")
    limit = s.cast("double") * (n - 1) * (1 + n_sig_b * F.sqrt(2.0 / (n - 1)))
    return (n >= min_count) & (n > 1) & ((n * q - s * s).cast("double") > limit)


def dispersion(pixels: DataFrame, *, radius: int = 3, min_count: int = 3, n_sig_b: float = 6.0, n_sig_s: float = 3.0, big: int | None = None, gain: Column | None = None) -> DataFrame:
    """Adds `strong`: the variance of the valid neighbourhood over its mean is too large for counts, and the pixel stands out of it.

    `big` leaves larger neighbours out of the moments; `gain` is a pixel's detector gain (1 by default).
    """
    rows = _moments(pixels, radius, big)
    mean = F.col("s").cast("double") / F.col("n")
    n, s, q = F.col("n"), F.col("s"), F.col("q")
    if gain is None:
        wide, high = _overdispersed(n_sig_b, min_count), F.col("value") > mean + n_sig_s * F.sqrt(mean)
    else:
        limit = gain * s * (n - 1) * (1 + n_sig_b * F.sqrt(2.0 / (n - 1)))
        wide = (n >= min_count) & (n > 1) & ((n * q - s * s).cast("double") > limit)
        high = F.col("value") > mean + n_sig_s * F.sqrt(gain * mean)
    return rows.withColumn("strong", F.coalesce(F.col("valid") & wide & high & (s > 0), F.lit(False))).drop("n", "s", "q")


def dispersion_extended(pixels: DataFrame, *, radius: int = 3, wide_radius: int = 5, erosion: int = 2, min_count: int = 3, n_sig_b: float = 6.0, n_sig_s: float = 3.0) -> DataFrame:
    """Adds `strong`: flag by dispersion alone, erode the flags, then test each flagged pixel against the mean of unflagged pixels around it."""
    rows = _moments(pixels, radius).withColumn("flag", F.coalesce(F.col("valid") & _overdispersed(n_sig_b, min_count), F.lit(False))).drop("n", "s", "q")
    rows = box(rows, erosion, F.max, bare=F.when(F.col("valid") & ~F.col("flag"), 1).otherwise(0))
    rows = rows.withColumn("flag", F.col("flag") & (F.col("bare") == 0)).drop("bare")
    calm = F.col("valid") & ~F.col("flag")
    rows = box(rows, wide_radius, n=F.when(calm, 1).otherwise(0).cast("long"), s=F.when(calm, F.col("value")).otherwise(0).cast("long"))
    mean = F.when(F.col("n") > 1, F.col("s").cast("double") / F.col("n")).when(F.col("n") == 1, 0.0)
    strong = F.col("flag") & (F.col("value") > 0) & (F.col("value") >= mean + n_sig_s * F.sqrt(mean))
    return rows.withColumn("strong", F.coalesce(strong, F.lit(False))).drop("flag", "n", "s")


def per_frame(strong: DataFrame) -> DataFrame:
    """Strong and non-zero pixels of each frame; a frame without any has zeros."""
    return strong.groupBy(*IMAGE).agg(F.count_if("strong").alias("n_strong"), F.count_if(F.col("value") != 0).alias("n_nonzero"))


# --- dense frames -------------------------------------------------------------------------------------------------

def _box(a: np.ndarray, r: int) -> np.ndarray:
    """Sum over the (2 r + 1)-square around each element, cut at the edge, by a summed-area table."""
    t = np.zeros((a.shape[0] + 1, a.shape[1] + 1), np.int64)
    t[1:, 1:] = a.cumsum(0).cumsum(1)
    y0, y1 = np.clip(np.arange(a.shape[0]) - r, 0, None), np.clip(np.arange(a.shape[0]) + r + 1, None, a.shape[0])
    x0, x1 = np.clip(np.arange(a.shape[1]) - r, 0, None), np.clip(np.arange(a.shape[1]) + r + 1, None, a.shape[1])
    return t[y1][:, x1] - t[y0][:, x1] - t[y1][:, x0] + t[y0][:, x0]


def _wide(value: np.ndarray, valid: np.ndarray, radius: int, n_sig_b: float, min_count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    v = np.where(valid, value, 0).astype(np.int64)
    n, s, q = _box(valid.astype(np.int64), radius), _box(v, radius), _box(v * v, radius)
    with np.errstate(divide="ignore", invalid="ignore"):
        limit = s.astype(float) * (n - 1) * (1 + n_sig_b * np.sqrt(2.0 / (n - 1)))
        return valid & (n >= min_count) & (n > 1) & ((n * q - s * s).astype(float) > limit), n, s


def strong_mask(value: np.ndarray, valid: np.ndarray, *, extended: bool = False, radius: int = 3, wide_radius: int = 5, erosion: int = 2, min_count: int = 3, n_sig_b: float = 6.0, n_sig_s: float = 3.0) -> np.ndarray:
    """Strong pixels of one dense frame; the same result as the window path."""
    flag, n, s = _wide(value, valid, radius, n_sig_b, min_count)
    with np.errstate(divide="ignore", invalid="ignore"):
        if not extended:
            mean = s.astype(float) / n
            return flag & (s > 0) & (value > mean + n_sig_s * np.sqrt(mean))
        flag &= _box((valid & ~flag).astype(np.int64), erosion) == 0
        calm = valid & ~flag
        n, s = _box(calm.astype(np.int64), wide_radius), _box(np.where(calm, value, 0).astype(np.int64), wide_radius)
        mean = np.where(n > 1, s.astype(float) / n, np.where(n == 1, 0.0, np.nan))
        return flag & (value > 0) & (value >= mean + n_sig_s * np.sqrt(mean))


def _filled(rows: pa.Table, height: int, width: int) -> np.ndarray:
    """Values of one frame from its pixel rows; pixels without a row are 0."""
    rows = rows.combine_chunks()
    data = np.zeros(height * width, np.int64)
    data[rows.column("y").to_numpy().astype(np.int64) * width + rows.column("x").to_numpy()] = rows.column("value").to_numpy()
    return data.reshape(height, width)


def dense_frames(pixels: DataFrame, height: int, width: int, valid: np.ndarray | None = None) -> DataFrame:
    """Dense frames (dataset, frame, h, w, data, valid) from pixel rows (dataset, frame, y, x, value); pixels without a row are 0.

    One shuffle by frame; a task holds one frame at a time. `valid` is a mask for all frames (null: all pixels are valid).
    """
    mask = pa.nulls(1, pa.list_(pa.bool_())) if valid is None else pa.array([valid.ravel().tolist()], pa.list_(pa.bool_()))
    kinds = [pixels.schema[c].dataType.simpleString() for c in IMAGE]

    def run(rows: pa.Table) -> pa.Table:
        data = _filled(rows, height, width).ravel()
        lists = pa.ListArray.from_arrays(pa.array([0, len(data)], pa.int32()), pa.array(data))
        return pa.table({"dataset": rows.column("dataset")[:1], "frame": rows.column("frame")[:1], "h": pa.array([height], pa.int32()), "w": pa.array([width], pa.int32()), "data": lists, "valid": mask})

    return pixels.select(*IMAGE, "y", "x", "value").groupBy(*IMAGE).applyInArrow(run, f"dataset {kinds[0]}, frame {kinds[1]}, h int, w int, data array<long>, valid array<boolean>")


def _images(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Each frame's row, its values and which of them are valid."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            h, w = (row.column(c)[0].as_py() for c in (2, 3))
            value = row.column(4).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(h, w)
            valid = np.ones((h, w), bool) if row.column(5).null_count else row.column(5).flatten().to_numpy(zero_copy_only=False).astype(bool).reshape(h, w)
            yield row, value, valid


def _tiled_mask(value: np.ndarray, valid: np.ndarray, tile: int, options: dict) -> np.ndarray:
    """`strong_mask` tile by tile: a tile is cut with a margin as wide as the kernels reach, so tiles need no neighbours."""
    reach = options.get("radius", 3) + (options.get("erosion", 2) + options.get("wide_radius", 5) if options.get("extended") else 0)
    out = np.zeros(value.shape, bool)
    for top in range(0, value.shape[0], tile):
        for left in range(0, value.shape[1], tile):
            y0, x0 = max(0, top - reach), max(0, left - reach)
            cut = np.s_[y0 : top + tile + reach, x0 : left + tile + reach]
            out[top : top + tile, left : left + tile] = strong_mask(value[cut], valid[cut], **options)[top - y0 : top - y0 + tile, left - x0 : left - x0 + tile]
    return out


def strong_counts_dense(frames: DataFrame, *, tile: int = 512, **options) -> DataFrame:
    """(dataset, frame, n_strong, n_nonzero) of dense frames: the rows of `per_frame`, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, value, valid in _images(batches):
            n = int(_tiled_mask(value, valid, tile, options).sum())
            yield pa.RecordBatch.from_arrays([row.column(0), row.column(1), pa.array([n], pa.int64()), pa.array([int((value != 0).sum())], pa.int64())], [*IMAGE, "n_strong", "n_nonzero"])

    kinds = [frames.schema[c].dataType.simpleString() for c in IMAGE]
    return frames.select(*IMAGE, "h", "w", "data", "valid").mapInArrow(run, f"dataset {kinds[0]}, frame {kinds[1]}, n_strong long, n_nonzero long")


def strong_pixels_dense(frames: DataFrame, *, tile: int = 512, **options) -> DataFrame:
    """Strong pixels (dataset, frame, y, x, value) of dense frames: dataset, frame, h, w, data, valid (ARRAY<BOOLEAN> or null).

    Nothing shuffles. Dense rows are large: keep spark.sql.execution.arrow.maxRecordsPerBatch small (16 or so) where frames have millions of pixels.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, value, valid in _images(batches):
            y, x = np.nonzero(_tiled_mask(value, valid, tile, options))
            yield pa.RecordBatch.from_arrays([row.column(c).take(pa.array(np.zeros(len(y), np.int64))) for c in (0, 1)] + [pa.array(y.astype(np.int32)), pa.array(x.astype(np.int32)), pa.array(value[y, x])], [*IMAGE, "y", "x", "value"])

    kinds = [frames.schema[c].dataType.simpleString() for c in IMAGE]
    return frames.select(*IMAGE, "h", "w", "data", "valid").mapInArrow(run, f"dataset {kinds[0]}, frame {kinds[1]}, y int, x int, value long")


# --- frames from pixel rows, without a table of dense frames ---------------------------------------------------------

def strong_counts_of(pixels: DataFrame, height: int, width: int, valid: np.ndarray | None = None, *, tile: int = 512, **options) -> DataFrame:
    """The rows of `strong_counts_dense` of the `dense_frames` of these pixel rows.

    A frame is filled, tested and dropped in one step after the shuffle: a batch of dense frames, which grows with the frames of a task, is never made.
    """
    usable = np.ones((height, width), bool) if valid is None else valid

    def run(rows: pa.Table) -> pa.Table:
        value = _filled(rows, height, width)
        n = int(_tiled_mask(value, usable, tile, options).sum())
        return pa.table({"dataset": rows.column("dataset")[:1], "frame": rows.column("frame")[:1], "n_strong": pa.array([n], pa.int64()), "n_nonzero": pa.array([int((value != 0).sum())], pa.int64())})

    kinds = [pixels.schema[c].dataType.simpleString() for c in IMAGE]
    return pixels.select(*IMAGE, "y", "x", "value").groupBy(*IMAGE).applyInArrow(run, f"dataset {kinds[0]}, frame {kinds[1]}, n_strong long, n_nonzero long")


def strong_pixels_of(pixels: DataFrame, height: int, width: int, valid: np.ndarray | None = None, *, tile: int = 512, **options) -> DataFrame:
    """The rows of `strong_pixels_dense` of the `dense_frames` of these pixel rows, in one step like `strong_counts_of`."""
    usable = np.ones((height, width), bool) if valid is None else valid

    def run(rows: pa.Table) -> pa.Table:
        value = _filled(rows, height, width)
        y, x = np.nonzero(_tiled_mask(value, usable, tile, options))
        image = {c: rows.column(c).combine_chunks().take(pa.array(np.zeros(len(y), np.int64))) for c in IMAGE}
        return pa.table({**image, "y": pa.array(y.astype(np.int32)), "x": pa.array(x.astype(np.int32)), "value": pa.array(value[y, x])})

    kinds = [pixels.schema[c].dataType.simpleString() for c in IMAGE]
    return pixels.select(*IMAGE, "y", "x", "value").groupBy(*IMAGE).applyInArrow(run, f"dataset {kinds[0]}, frame {kinds[1]}, y int, x int, value long")
