"""Experiments, reflection tables, per-frame results: reading and writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import vec as V

#: Columns of the tables that are written, in order.
SPOTS = ("dataset", "id", "com_x", "com_y", "com_z", "sigma_b_variance", "sigma_m_variance", "depth")
STILLS = ("dataset", "id", "com_x", "com_y", "com_z")
INDEXED = ("dataset", "id", "h", "k", "l", "flags", "x_px", "y_px", "z_px", "x_mm", "y_mm", "phi", "rlp", "s1", "entering", "panel")
PREDICTED = ("dataset", "id", "h", "k", "l", "panel", "entering", "s1", "x_px", "y_px", "z_px", "x_mm", "y_mm", "phi", "flags")
INTEGRATED = ("dataset", "id", "h", "k", "l", "intensity", "variance", "partiality", "lp", "d", "x_px", "y_px", "z_px", "s1", "n_bg", "n_fg", "bg_sum", "mean", "flags")
#: Bits of `flags`.
FLAG = {"predicted": 1 << 0, "indexed": 1 << 2, "used_in_refinement": 1 << 3, "strong": 1 << 5, "integrated_sum": 1 << 8, "overloaded": 1 << 10, "centroid_outlier": 1 << 17}
_VEC = "array<double>"
_XYZ = "struct<x: double, y: double, z: double>"
#: Columns of reflection tables.
REFLECTION_TYPES = {
    **dict.fromkeys(("id", "h", "k", "l", "image", "num_pixels_background", "num_pixels_foreground"), "int"), **dict.fromkeys(("flags", "panel"), "long"), "entering": "boolean", "miller_index": "struct<h: int, k: int, l: int>",
    **dict.fromkeys(("xyzobs_px", "xyzobs_mm", "xyzcal_px", "xyzcal_mm", "rlp", "s1"), _XYZ), **dict.fromkeys(("intensity_sum_value", "intensity_sum_variance", "partiality", "lp", "d", "background_sum_value", "background_mean", "delpsi"), "double"),
}
CRYSTAL = f"identifier string, id int, real_space_a {_VEC}, real_space_b {_VEC}, real_space_c {_VEC}, space_group_hall_symbol string"
EXPERIMENT = f"""experiment array<struct<identifier string, beam int, detector int, goniometer int, scan int, crystal int>>,
  beam array<struct<direction {_VEC}, wavelength double, polarization_normal {_VEC}, polarization_fraction double, s0_at_scan_points array<{_VEC}>>>,
  detector array<struct<panels array<struct<fast_axis {_VEC}, slow_axis {_VEC}, origin {_VEC}, pixel_size {_VEC}, image_size array<int>, trusted_range {_VEC}, thickness double, mu double>>, hierarchy struct<origin {_VEC}>>>,
  goniometer array<struct<axes array<{_VEC}>, angles {_VEC}, names array<string>, scan_axis int, setting_rotation_at_scan_points array<{_VEC}>>>,
  scan array<struct<image_range array<int>, properties struct<oscillation {_VEC}>>>,
  crystal array<struct<real_space_a {_VEC}, real_space_b {_VEC}, real_space_c {_VEC}, space_group_hall_symbol string, A_at_scan_points array<{_VEC}>>>"""


def read_experiments(spark: SparkSession, path: str) -> DataFrame:
    """A row for each experiment of a JSON list: its models joined by their place in the lists. A missing model is null."""
    lists = spark.read.schema(EXPERIMENT).json(path, multiLine=True)
    rows = lists.withColumn("__e", F.explode("experiment"))
    at = lambda name: F.try_element_at(F.col(name), F.col(f"__e.{name}") + 1)
    return rows.select(F.col("__e.identifier").alias("identifier"), *(at(m).alias(m) for m in ("beam", "detector", "goniometer", "scan", "crystal")))


def crystal_list(frames: DataFrame, names: DataFrame, space_group: str = " P 1") -> DataFrame:
    """A crystal for each indexed still, with the columns of CRYSTAL: the axes of its setting matrix, its number among the dataset's indexed frames, its experiment's name.

    `frames`: dataset, frame, setting, a row each, as `index_stills` gives them; `names`: dataset, frame, identifier. Frames without a name are left out. Write it as
    JSON lines (`write.json`); `read_crystals` gives the same rows.
    """
    rows = mapped_ids(with_stills_ids(frames.select("dataset", "frame", "setting")), names)
    axes = {f"real_space_{c}": F.array(*axis) for c, axis in zip("abc", V.real_space(F.col("setting")), strict=True)}
    return rows.select("identifier", F.col("id").cast("int").alias("id"), *(v.alias(c) for c, v in axes.items()), F.lit(space_group).alias("space_group_hall_symbol"))


def read_crystals(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CRYSTAL).json(path)


def with_crystals(experiments: DataFrame, crystals: DataFrame) -> DataFrame:
    """Experiments with the crystals of a list in place of their own, by identifier; the others keep what they have."""
    kind = experiments.schema["crystal"].dataType
    given = crystals.dropDuplicates(["identifier"])
    fields = [(F.col(f.name) if f.name in crystals.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.fields]
    given = given.select("identifier", F.struct(*fields).alias("__crystal"))
    columns = [F.coalesce("__crystal", "crystal").alias("crystal") if c == "crystal" else F.col(c) for c in experiments.columns]
    return experiments.join(given, "identifier", "left").select(*columns)


def still_geometry(experiments: DataFrame) -> DataFrame:
    """Distance, beam centre (pixels), pixel size and wavelength of each experiment, from its first panel and the detector's origin."""
    panel, top = F.col("detector.panels")[0], F.col("detector.hierarchy.origin")
    shift = lambda k: F.coalesce(top[k], F.lit(0.0)) + panel["origin"][k]
    return experiments.select("identifier", F.abs(shift(2)).alias("distance"), (F.abs(shift(0)) / panel["pixel_size"][0]).alias("beam_x"), (F.abs(shift(1)) / panel["pixel_size"][1]).alias("beam_y"), panel["pixel_size"][0].alias("px_x"), panel["pixel_size"][1].alias("px_y"), F.col("beam.wavelength").alias("wavelength"))


def scan_points(experiments: DataFrame) -> DataFrame:
    """(identifier, pt, a, s0, setting): scan-varying setting matrices, beams (structs) and goniometer settings at the boundaries of images.

    A list counts if it has one entry for each boundary; the others are null, and experiments without any have no rows.
    """
    n = F.col("scan.image_range")[1] - F.col("scan.image_range")[0] + 1
    lists = {"a": F.col("crystal.A_at_scan_points"), "s0": F.col("beam.s0_at_scan_points"), "setting": F.col("goniometer.setting_rotation_at_scan_points")}
    rows = experiments.select("identifier", n.alias("n"), *(F.when(F.size(x) == n + 1, x).alias(c) for c, x in lists.items())).where(" OR ".join(f"{c} IS NOT NULL" for c in lists))
    rows = rows.withColumn("pt", F.explode(F.sequence(F.lit(0), F.col("n")))).select("identifier", "pt", *(F.try_element_at(c, F.col("pt") + 1).alias(c) for c in lists))
    return rows.withColumn("s0", F.when(F.col("s0").isNotNull(), F.struct(*(F.col("s0")[k].alias(c) for k, c in enumerate("xyz")))))


def read_reflections(spark: SparkSession, path: str, *wanted: str) -> DataFrame:
    """A reflection table; wanted columns that it lacks come as nulls of their type: that of REFLECTION_TYPES, or the one given as in "score double"."""
    rows = spark.read.parquet(path)
    missing = {}
    for column in wanted:
        name, _, kind = column.partition(" ")
        if name not in rows.columns:
            if not (kind or name in REFLECTION_TYPES):
                raise ValueError(f"give the type of {name}, as in '{name} double'")
            missing[name] = F.lit(None).cast(kind or REFLECTION_TYPES[name])
    return rows.withColumns(missing)


def write_reflections(rows: DataFrame, path: str, columns: tuple[str, ...], mode: str = "errorifexists") -> None:
    """The given columns, in that order, partitioned by dataset."""
    rows.select(*columns).write.mode(mode).partitionBy("dataset").parquet(path)


#: Types of the columns that are written; all others are doubles, and dataset stays a number or a name.
_WRITTEN = {**dict.fromkeys(("h", "k", "l", "panel", "depth"), "int"), **dict.fromkeys(("id", "flags", "n_bg", "n_fg"), "long"), "entering": "boolean", "rlp": _XYZ, "s1": _XYZ}


def fixed_table(rows: DataFrame, columns: tuple[str, ...], **given: Column) -> DataFrame:
    """Exactly these columns, in order and with their types, each from the expression given for it or from the rows' column of that name; one that neither has raises."""
    lost = [c for c in columns if c not in given and c not in rows.columns]
    if lost:
        raise ValueError(f"nothing is given for {', '.join(lost)}")
    typed = lambda c, v: v if c == "dataset" else v.cast(_WRITTEN.get(c, "double"))
    return rows.select(*(typed(c, given.get(c, F.col(c))).alias(c) for c in columns))


def _flags(rows: DataFrame) -> Column:
    return F.coalesce(F.col("flags"), F.lit(0)).cast("long") if "flags" in rows.columns else F.lit(0).cast("long")


def predicted_table(rays: DataFrame, **given: Column) -> DataFrame:
    """The PREDICTED columns of rays on a detector (`on_detector`), flagged predicted; one panel, 0, unless another is given."""
    return fixed_table(rays, PREDICTED, **{"panel": F.lit(0), "flags": with_flags(_flags(rays), "predicted"), **given})


def indexed_table(rows: DataFrame, **given: Column) -> DataFrame:
    """The INDEXED columns of rows with indices (`with_indices`): flagged indexed where a row has one, and the flag taken away where it has none."""
    flags = F.when(F.col("lsq").isNotNull(), with_flags(_flags(rows), "indexed")).otherwise(_flags(rows).bitwiseAND(F.lit(~FLAG["indexed"])))
    return fixed_table(rows, INDEXED, **{"panel": F.lit(0), "flags": flags, **given})


def integrated_table(integrated: DataFrame, predicted: DataFrame, cell: tuple) -> DataFrame:
    """The INTEGRATED columns: intensities (`integrate.integrate`, refl_id) joined with the PREDICTED rows (id) that they are of; x, y, z are the observed centroid.

    `cell`: a, b, c, alpha, beta, gamma as numbers or columns; d is null for the index 0. Predictions that could not be integrated have no row.
    """
    known = predicted.select("dataset", "id", "h", "k", "l", "s1", "flags")
    rows = integrated.drop("s1", "h", "k", "l", "flags").withColumnRenamed("refl_id", "id").join(known, ["dataset", "id"])
    index = tuple(F.col(c).cast("double") for c in "hkl")
    d = V.d_spacing(*index, tuple(v if isinstance(v, Column) else F.lit(float(v)) for v in cell))
    return fixed_table(rows, INTEGRATED, d=d, flags=with_flags(_flags(rows), "integrated_sum"), **{f"{c}_px": F.col(f"{c}_obs") for c in "xyz"})


def with_stills_ids(rows: DataFrame) -> DataFrame:
    """Adds id, the number of a row's frame among those of its dataset. Frames are ranked, not rows."""
    frames = rows.select(F.col("dataset").alias("__dataset"), F.col("frame").alias("__frame")).distinct()
    frames = frames.withColumn("id", F.row_number().over(Window.partitionBy("__dataset").orderBy("__frame")) - 1)
    return rows.join(frames, F.col("dataset").eqNullSafe(F.col("__dataset")) & F.col("frame").eqNullSafe(F.col("__frame"))).drop("__dataset", "__frame")


def mapped_ids(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Rows with new numbers (`id`) joined with the identifier of their dataset and old number (`frame`)."""
    return rows.join(names.select("dataset", "frame", "identifier"), ["dataset", "frame"])


def frame_results(counts: DataFrame, file: Column) -> DataFrame:
    """JSON line of each frame: counts, file, and the number counted from 1."""
    return counts.select(F.to_json(F.struct(F.col("n_strong").alias("num_strong_pixels"), file.alias("file"), (F.col("frame") + 1).alias("file-number"), F.col("n_spots").alias("n_spots_total"))).alias("value"))


def pixel_lines(strong: DataFrame) -> DataFrame:
    """Text of each strong pixel, by frame: write with partitionBy("frame").text."""
    return strong.select("frame", F.format_string("%4d, %4d", "x", "y").alias("value"))


def spot_lines(spots: DataFrame) -> DataFrame:
    return spots.select("dataset", F.format_string("X: [%d, %d] Y: [%d, %d] Z: [%d, %d] COM: (%.6f, %.6f, %.6f)", "x_min", "x_max", "y_min", "y_max", "z_min", "z_max", "com_x", "com_y", "com_z").alias("value"))


def numbered_json(rows: DataFrame, order: list[str], value: Column, width: int = 3) -> DataFrame:
    """One JSON object for each dataset, with zero-padded numbers as keys in the given order (a few hundred candidates)."""
    n = F.row_number().over(Window.partitionBy("dataset").orderBy(*order))
    pair = F.struct(F.lpad(n.cast("string"), width, "0").alias("key"), value.alias("value"))
    keyed = rows.withColumn("__pair", pair)
    return keyed.groupBy("dataset").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list("__pair")))).alias("value"))


def flagged(flags: Column, *names: str) -> Column:
    bits = sum(FLAG[n] for n in names)
    return flags.bitwiseAND(F.lit(bits)) == bits


def with_flags(flags: Column, *names: str) -> Column:
    return flags.bitwiseOR(F.lit(sum(FLAG[n] for n in names)))


def all_predicted(rows: DataFrame) -> bool:
    return bool(rows.agg(F.bool_and(flagged(F.col("flags"), "predicted"))).first()[0])


def parsed_cell(text: Column) -> Column:
    """Six numbers of a unit cell from text with commas or spaces; null if there are not six numbers."""
    parts = F.transform(F.split(F.trim(F.regexp_replace(text, r"[,\s]+", " ")), " "), lambda p: p.try_cast("double"))
    return F.when((F.size(parts) == 6) & F.forall(parts, lambda p: p.isNotNull()), parts)


def mismatches(left: DataFrame, right: DataFrame, key: list[str], value: str) -> DataFrame:
    """Rows in which two tables differ, or that one of them lacks."""
    a, b = left.select(*key, F.col(value).alias("left")), right.select(*key, F.col(value).alias("right"))
    return a.join(b, key, "full").where(~F.col("left").eqNullSafe(F.col("right")))


def first_mismatch(left: DataFrame, right: DataFrame, key: list[str], value: str) -> DataFrame:
    rows = mismatches(left, right, key, value)
    return rows.agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*key, "left", "right")).alias("first"))


def inconsistent_metadata(given: DataFrame, stored: DataFrame) -> DataFrame:
    """Geometry given that is not that of the file: beam centre by 0.1 pixels, pixel size by 1e-9, distance by 1e-7."""
    limits = {"beam_x": 0.1, "beam_y": 0.1, "px_x": 1e-9, "px_y": 1e-9, "distance": 1e-7}
    rows = given.alias("g").join(stored.alias("s"), "dataset")
    off = [F.struct(F.lit(c).alias("what"), F.col(f"g.{c}").alias("given"), F.col(f"s.{c}").alias("stored"), (F.abs(F.col(f"g.{c}") - F.col(f"s.{c}")) >= t).alias("off")) for c, t in limits.items()]
    return rows.select("dataset", F.explode(F.array(*off)).alias("x")).select("dataset", "x.what", "x.given", "x.stored", "x.off").where("off").drop("off")
