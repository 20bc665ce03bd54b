"""Frames in: Parquet tables, live frame directories, numbered text-header files, and synthetic images.

Dense frames: dataset, frame, h, w, data (ARRAY<BIGINT>), valid (ARRAY<BOOLEAN>, null: all).  Pixel rows: dataset, frame, y, x, value, valid.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FRAMES = "dataset string, frame int, h int, w int, data array<long>, valid array<boolean>"
#: Fixed values of the text-header format: the marker before the payload, and the escapes of its differences.
_MARKER = b"\x0c\x1a\x04\xd5"


def read_frames(spark: SparkSession, path: str, fmt: str = "parquet", *, dataset: str | None = None) -> DataFrame:
    """Dense frames from `parquet` (stored in that form), `directory` (live frame files) or `cbf` (text header and differences)."""
    if fmt == "parquet":
        return spark.read.schema(FRAMES).parquet(path)
    files = spark.read.format("binaryFile")
    if fmt == "directory":
        return decode_directory(files.option("pathGlobFilter", "image_*").load(path), path, dataset or path, header(spark, path), mask(spark, path))
    if fmt == "cbf":
        return decode_cbf(files.option("pathGlobFilter", "*.cbf").load(path), dataset or path)
    raise ValueError(f"unknown format {fmt}")


def header(spark: SparkSession, path: str) -> dict:
    """Header of a frame directory: one small JSON file."""
    return json.loads(spark.read.text(f"{path}/start_1", wholetext=True).first()[0])


def mask(spark: SparkSession, path: str) -> bytes | None:
    """Mask of a frame directory (32-bit, 0 is valid): one image, if there is one."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "start_5").load(path).select("content").collect()
    return bytes(rows[0][0]) if rows else None


#: Header fields of a frame directory: column, its type, the field.
_HEADER = (
    ("h", "int", "y_pixels_in_detector"), ("w", "int", "x_pixels_in_detector"), ("bit_depth", "int", "bit_depth_image"), ("trusted_max", "long", "countrate_correction_count_cutoff"), ("wavelength", "double", "wavelength"),
    ("distance", "double", "detector_distance"), ("px_x", "double", "x_pixel_size"), ("px_y", "double", "y_pixel_size"), ("beam_x", "double", "beam_center_x"), ("beam_y", "double", "beam_center_y"),
    ("osc_start", "double", "omega_start"), ("osc_width", "double", "omega_increment"),
)


def frame_index(spark: SparkSession, path: str, *, dataset: str | None = None) -> DataFrame:
    """What a frame directory holds, without reading a pixel: a row for each frame that its header announces or that has a file.

    dataset, frame, available, path, bytes, modified, n_images (nimages x ntrigger) and the header's h, w, bit_depth, trusted_max, wavelength, distance, px_x, px_y,
    beam_x, beam_y, osc_start, osc_width; a field that the header lacks is null. `available`: there is a file of the size that the header gives an image. The
    listing is that of the time when a query runs, so a later query sees the frames written since. `osc_width` is what `spots.routed` goes by.
    """
    head = header(spark, path)
    number = lambda name, kind: F.lit(head.get(name)).cast(kind)
    n = int(head.get("nimages", 0)) * int(head.get("ntrigger", 1))
    size = int(head["y_pixels_in_detector"]) * int(head["x_pixels_in_detector"]) * int(head.get("bit_depth_image", 16)) // 8
    files = spark.read.format("binaryFile").option("pathGlobFilter", "image_*").load(path)
    files = files.select(frame_number(F.col("path"), r"image_(\d+)_2$").alias("frame"), "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")).where("frame IS NOT NULL")
    rows = spark.range(n).select(F.col("id").cast("int").alias("frame")).join(files, "frame", "full")
    rows = rows.select(F.lit(dataset or path).alias("dataset"), "frame", F.coalesce(F.col("bytes") >= size, F.lit(False)).alias("available"), "path", "bytes", "modified", F.lit(n).alias("n_images"))
    return rows.withColumns({column: number(field, kind) for column, kind, field in _HEADER})


def frame_number(name, pattern: str = r"(\d+)(?:_2)?(?:\.[A-Za-z0-9]+)?$"):
    """Number in a file name, by the last digits before the ending; null if there is none."""
    return F.regexp_extract(name, pattern, 1).try_cast("int")


def decode_directory(files: DataFrame, path: str, dataset: str, head: dict, raw_mask: bytes | None) -> DataFrame:
    """Frames of raw little-endian images named image_<number>_2, also of a stream of such files.

    A task holds the files of one Arrow batch: for large images set spark.sql.execution.arrow.maxRecordsPerBatch to a few (an 18-megapixel frame takes 36 MB as a file
    and 162 MB as a row of 64-bit values with its mask).
    """
    h, w = int(head["y_pixels_in_detector"]), int(head["x_pixels_in_detector"])
    kind = np.dtype({8: "<u1", 16: "<u2", 32: "<u4"}[int(head.get("bit_depth_image", 16))])
    # a bit for each pixel goes along with the job
    bits = None if raw_mask is None else np.packbits(np.frombuffer(raw_mask, "<i4")[: h * w] == 0).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        valid = None if bits is None else np.unpackbits(np.frombuffer(bits, np.uint8), count=h * w).astype(bool)
        for batch in batches:
            for number, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield _frame(dataset, number, np.frombuffer(content, kind)[: h * w], h, w, valid)

    return files.select(frame_number(F.col("path"), r"image_(\d+)_2$").alias("frame"), "content").where("frame IS NOT NULL").mapInArrow(run, FRAMES)


def _frame(dataset: str, number: int, data: np.ndarray, h: int, w: int, valid: np.ndarray | None) -> pa.RecordBatch:
    one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), pa.array(a))
    mask = pa.array([None], pa.list_(pa.bool_())) if valid is None else one(valid)
    return pa.RecordBatch.from_arrays([pa.array([dataset]), pa.array([number], pa.int32()), pa.array([h], pa.int32()), pa.array([w], pa.int32()), one(data.astype(np.int64)), mask], ["dataset", "frame", "h", "w", "data", "valid"])


def decode_differences(payload: bytes, n: int) -> np.ndarray:
    """Values of a byte-offset payload: running sums of differences, each of one byte or, behind an escape, of two, four or eight."""
    out = np.empty(n, np.int64)
    at = count = 0
    while count < n:
        # a run of plain bytes up to the next escape (-128)
        stop = payload.find(b"\x80", at)
        stop = len(payload) if stop < 0 else stop
        run = min(stop - at, n - count)
        out[count : count + run] = np.frombuffer(payload, "<i1", run, at)
        count, at = count + run, at + run
        if count >= n:
            break
        if at >= len(payload):
            raise ValueError("payload is too short")
        at += 1
        for size, escape in ((2, -(1 << 15)), (4, -(1 << 31)), (8, None)):
            value = int.from_bytes(payload[at : at + size], "little", signed=True)
            at += size
            if value != escape:
                break
        out[count] = value
        count += 1
    return np.cumsum(out)


def decode_cbf(files: DataFrame, dataset: str) -> DataFrame:
    """Frames of text-header files; signed values, negative ones are masked (reported as not valid)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text, _, payload = content.partition(_MARKER)
                fields = dict(line.split(b":", 1) for line in text.splitlines() if line.count(b":") == 1)
                size = {k: int(fields[f"X-Binary-Size-{k}-Dimension".encode()]) for k in ("Fastest", "Second")}
                data = decode_differences(payload, size["Fastest"] * size["Second"])
                yield _frame(dataset, number, data, size["Second"], size["Fastest"], data >= 0)

    return files.select(frame_number(F.col("path")).alias("frame"), "content").where("frame IS NOT NULL").mapInArrow(run, FRAMES)


def expand_template(template: str, index: int) -> str:
    """File name of a frame: the run of # stands for the number, zero-padded."""
    width = template.count("#")
    return template.replace("#" * width, f"{index:0{width}d}") if width else template


def locate(frames: DataFrame, manifest: DataFrame) -> DataFrame:
    """File and offset of each frame. `manifest`: dataset, file_no, frames (in each file); frames beyond the last file have none.

    The join is on the dataset and on the blocks of frames that a file spans, so no frame meets every file.
    """
    block = 1024
    w = Window.partitionBy("dataset").orderBy("file_no").rowsBetween(Window.unboundedPreceding, 0)
    spans = manifest.where(F.col("frames") > 0).withColumn("end", F.sum("frames").over(w)).withColumn("start", F.col("end") - F.col("frames"))
    spans = spans.withColumn("__block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block))))
    rows = frames.withColumn("__block", F.floor(F.col("frame") / block))
    found = rows.join(spans.drop("frames"), ["dataset", "__block"], "left").where(F.col("start").isNull() | ((F.col("frame") >= F.col("start")) & (F.col("frame") < F.col("end"))))
    return found.withColumn("offset", F.col("frame") - F.col("start")).drop("start", "end", "__block")


def to_pixels(frames: DataFrame) -> DataFrame:
    """A row for each pixel of dense frames."""
    rows = frames.select("dataset", "frame", "w", "valid", F.posexplode("data").alias("at", "value"))
    ok = F.coalesce(F.col("valid")[F.col("at")], F.lit(True))
    return rows.select("dataset", "frame", F.floor(F.col("at") / F.col("w")).cast("int").alias("y"), (F.col("at") % F.col("w")).cast("int").alias("x"), "value", ok.alias("valid"))


def in_module(module: tuple[int, int] = (512, 1028), gap: tuple[int, int] = (38, 12)):
    """Does a pixel (columns y, x) lie on a detector module?"""
    return (F.col("y") % (module[0] + gap[0]) < module[0]) & (F.col("x") % (module[1] + gap[1]) < module[1])


def synthetic_pixels(spark: SparkSession, height: int, width: int, kinds: dict[int, str], *, module=(512, 1028), gap=(38, 12)) -> DataFrame:
    """Test images: `kinds` maps a frame to empty, flat, grid (100 every 42 pixels), x, y or random (0 to 9 by hash). Gaps are 0 and masked."""
    size = height * width
    rows = spark.range(size * len(kinds)).select((F.col("id") / size).cast("int").alias("n"), (F.col("id") % size).alias("at"))
    frames, names = F.array(*map(F.lit, kinds)), F.array(*map(F.lit, kinds.values()))
    rows = rows.select(F.lit("synthetic").alias("dataset"), F.element_at(frames, F.col("n") + 1).alias("frame"), F.element_at(names, F.col("n") + 1).alias("kind"), F.floor(F.col("at") / width).cast("int").alias("y"), (F.col("at") % width).cast("int").alias("x"))
    value = F.when(F.col("kind") == "flat", 1).when(F.col("kind") == "grid", F.when((F.col("x") % 42 == 0) & (F.col("y") % 42 == 0), 100).otherwise(0)).when(F.col("kind") == "x", F.col("x"))
    value = value.when(F.col("kind") == "y", F.col("y")).when(F.col("kind") == "random", F.pmod(F.xxhash64("frame", "y", "x"), F.lit(10))).otherwise(0)
    return rows.withColumn("valid", in_module(module, gap)).withColumn("value", F.when(F.col("valid"), value).otherwise(0).cast("long")).drop("kind")


def to_modules(pixels: DataFrame, module=(512, 1028), gap=(38, 12)) -> DataFrame:
    """Pixels of modules with module_y, module_x and coordinates inside the module; gap pixels go."""
    rows = pixels.where(in_module(module, gap))
    for c, m, g in (("y", module[0], gap[0]), ("x", module[1], gap[1])):
        rows = rows.withColumns({f"module_{c}": F.floor(F.col(c) / (m + g)).cast("int"), c: (F.col(c) % (m + g)).cast("int")})
    return rows
