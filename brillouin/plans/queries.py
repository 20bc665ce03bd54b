"""Queries over the given tables, with the DuckDB SQL that gives the same rows.

Pixels come from lineitem: ten suppliers make a dataset of ten frames, 32 x 32 pixels each; a pixel's value is the quantity of the lines
whose order and part fall on it.  Vectors come from embeddings, histograms from parts, boxes from orders, requests from events.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import vec as V
from ..operators import background as B
from ..operators import indexing as I
from ..operators import shoebox as X
from ..operators import spots as S
from ..operators import threshold as T
from ..sources import frames as R
from ..streaming import service
from .scratch import written

SIDE = 32
_VALID = "NOT (y % 16 = 15 OR x % 16 = 15)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def seen_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels with a line: dataset, frame, y, x, value. A frame has one at least."""
    supplier = F.col("l_suppkey")
    place = [F.floor(supplier / 10).cast("int").alias("dataset"), (supplier % 10).cast("int").alias("frame")]
    return table(spark, sf_dir, "lineitem").groupBy(*place, (F.col("l_orderkey") % SIDE).cast("int").alias("y"), (F.col("l_partkey") % SIDE).cast("int").alias("x")).agg(F.sum("l_quantity").cast("long").alias("value"))


def _mask() -> np.ndarray:
    at = np.arange(SIDE) % 16 != 15
    return at[:, None] & at[None, :]


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense frames: dataset, frame, h, w, data, valid."""
    return T.dense_frames(seen_pixels(spark, sf_dir), SIDE, SIDE, _mask())


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense pixels: dataset, frame, y, x, value, valid."""
    seen = seen_pixels(spark, sf_dir)
    grid = seen.select("dataset", "frame").distinct().withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(SIDE * SIDE - 1))))
    grid = grid.select("dataset", "frame", F.floor(F.col("at") / SIDE).cast("int").alias("y"), (F.col("at") % SIDE).cast("int").alias("x"))
    rows = grid.join(seen, ["dataset", "frame", "y", "x"], "left")
    return rows.select("dataset", "frame", "y", "x", F.coalesce("value", F.lit(0)).cast("long").alias("value"), F.expr(_VALID).alias("valid"))


_PX = f"""
seen AS (SELECT CAST(l_suppkey // 10 AS INT) AS dataset, CAST(l_suppkey % 10 AS INT) AS frame, CAST(l_orderkey % {SIDE} AS INT) AS y,
                CAST(l_partkey % {SIDE} AS INT) AS x, CAST(sum(l_quantity) AS BIGINT) AS value FROM lineitem GROUP BY ALL),
grid AS (SELECT dataset, frame, CAST(cell // {SIDE} AS INT) AS y, CAST(cell % {SIDE} AS INT) AS x
         FROM (SELECT DISTINCT dataset, frame FROM seen), (SELECT unnest(range({SIDE * SIDE})) AS cell)),
px AS (SELECT dataset, frame, y, x, coalesce(value, 0) AS value, {_VALID} AS valid FROM grid LEFT JOIN seen USING (dataset, frame, y, x))"""


def _box_sql(source: str, radius: int, **columns: str) -> str:
    """Separable box sums (or maxima) in SQL."""
    inner = ", ".join(f"{f}({e}) OVER (PARTITION BY dataset, frame, y ORDER BY x RANGE BETWEEN {radius} PRECEDING AND {radius} FOLLOWING) AS h_{n}" for n, (f, e) in columns.items())
    outer = ", ".join(f"{f}(h_{n}) OVER (PARTITION BY dataset, frame, x ORDER BY y RANGE BETWEEN {radius} PRECEDING AND {radius} FOLLOWING) AS {n}" for n, (f, _) in columns.items())
    return f"SELECT *, {outer} FROM (SELECT *, {inner} FROM {source})"


_MOMENTS = {"n": ("sum", "CASE WHEN valid THEN 1 ELSE 0 END"), "s": ("sum", "CASE WHEN valid THEN value ELSE 0 END"), "q": ("sum", "CASE WHEN valid THEN value * value ELSE 0 END")}
_WIDE = "valid AND n >= 3 AND CAST(n * q - s * s AS DOUBLE) > CAST(s AS DOUBLE) * (n - 1) * (1 + {b} * sqrt(2.0::DOUBLE / (n - 1)))"


def _strong_sql(n_sig_s: float, n_sig_b: float = 6.0) -> str:
    return f"""{_PX},
m AS ({_box_sql("px", 3, **_MOMENTS)}),
strong AS (SELECT dataset, frame, y, x, value, coalesce({_WIDE.format(b=n_sig_b)} AND s > 0 AND value > CAST(s AS DOUBLE) / n + {n_sig_s} * sqrt(CAST(s AS DOUBLE) / n), FALSE) AS strong FROM m)"""


def strong_pixels_per_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.strong_counts_of(seen_pixels(spark, sf_dir), SIDE, SIDE, _mask())


def extended_strong_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.strong_counts_of(seen_pixels(spark, sf_dir), SIDE, SIDE, _mask(), extended=True, n_sig_b=1.0)


_EXTENDED_SQL = f"""WITH {_PX},
m AS ({_box_sql("px", 3, **_MOMENTS)}),
f AS (SELECT dataset, frame, y, x, value, valid, coalesce({_WIDE.format(b=1.0)}, FALSE) AS flag FROM m),
e AS ({_box_sql("f", 2, bare=("max", "CASE WHEN valid AND NOT flag THEN 1 ELSE 0 END"))}),
g AS (SELECT dataset, frame, y, x, value, valid, flag AND bare = 0 AS flag FROM e),
w AS ({_box_sql("g", 5, n=("sum", "CASE WHEN valid AND NOT flag THEN 1 ELSE 0 END"), s=("sum", "CASE WHEN valid AND NOT flag THEN value ELSE 0 END"))}),
t AS (SELECT *, CASE WHEN n > 1 THEN CAST(s AS DOUBLE) / n WHEN n = 1 THEN 0.0 END AS mean FROM w)
SELECT dataset, frame, count(*) FILTER (WHERE flag AND value > 0 AND value >= mean + 3.0 * sqrt(mean)) AS n_strong, count(*) FILTER (WHERE value <> 0) AS n_nonzero
FROM t GROUP BY ALL"""


def summed_area_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.prefix_table(pixels(spark, sf_dir), area=F.when(F.col("valid"), 1).otherwise(0).cast("long"), total=F.when(F.col("valid"), F.col("value")).otherwise(0))
    return rows.select("dataset", "frame", "y", "x", "area", "total")


_SAT_SQL = f"""WITH {_PX},
r AS (SELECT *, sum(CASE WHEN valid THEN 1 ELSE 0 END) OVER w AS a, sum(CASE WHEN valid THEN value ELSE 0 END) OVER w AS t FROM px
      WINDOW w AS (PARTITION BY dataset, frame, y ORDER BY x ROWS UNBOUNDED PRECEDING))
SELECT dataset, frame, y, x, CAST(sum(a) OVER v AS BIGINT) AS area, CAST(sum(t) OVER v AS BIGINT) AS total FROM r
WINDOW v AS (PARTITION BY dataset, frame, x ORDER BY y ROWS UNBOUNDED PRECEDING)"""


def pixel_resolution_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = G.pixel_resolution(F.col("x"), F.col("y"), 15.25, 16.75, 0.075, 0.075, 2.0, 0.9795)
    rows = pixels(spark, sf_dir).withColumn("d", d)
    kept = rows.withColumn("keep", G.resolution_mask(F.col("valid"), F.col("d"), 1.8, 20.0))
    return kept.groupBy("dataset", "frame").agg(F.count_if("keep").alias("n_kept"), F.round(F.min(F.when(F.col("keep"), F.col("d"))), 9).alias("d_min"), F.round(F.max(F.when(F.col("keep"), F.col("d"))), 9).alias("d_max"), F.sum(F.when(F.col("keep"), F.col("value")).otherwise(0)).alias("total"))


_MASK_SQL = f"""WITH {_PX},
r AS (SELECT *, sqrt(pow((x + 0.5 - 15.25) * 0.075, 2) + pow((y + 0.5 - 16.75) * 0.075, 2)) AS r FROM px),
d AS (SELECT *, 0.9795 / (2 * sin(0.5 * atan(r / 2.0))) AS d FROM r),
k AS (SELECT *, valid AND d >= 1.8 AND d <= 20.0 AS keep FROM d)
SELECT dataset, frame, count(*) FILTER (WHERE keep) AS n_kept, round(min(d) FILTER (WHERE keep), 9) AS d_min, round(max(d) FILTER (WHERE keep), 9) AS d_max,
       CAST(coalesce(sum(value) FILTER (WHERE keep), 0) AS BIGINT) AS total FROM k GROUP BY ALL"""


def strong_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strong pixels of `strong_pixels_per_frame` by windows over pixel rows, as tables without dense frames need it."""
    return T.per_frame(T.dispersion(pixels(spark, sf_dir)))


def _strong(spark: SparkSession, sf_dir: str, n_sig_s: float = 3.0) -> DataFrame:
    return T.strong_pixels_of(seen_pixels(spark, sf_dir), SIDE, SIDE, _mask(), n_sig_s=n_sig_s)


def frame_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = S.labelled(S.with_slices(_strong(spark, sf_dir)), across_frames=False)
    return S.boxes_2d(found, 2).drop("spot")


def _reach_sql(across: bool, where: str = "TRUE") -> str:
    """Components by the smallest node that each strong pixel reaches (a recursive closure)."""
    step = "(a.z = b.z AND abs(a.y - b.y) + abs(a.x - b.x) = 1)" + (f" OR (abs(a.z - b.z) = 1 AND a.y = b.y AND a.x = b.x AND {where})" if across else "")
    node = f"((CAST(dataset AS BIGINT) * 1024 + z) * {SIDE} + y) * {SIDE} + x"
    return f"""p AS (SELECT dataset, frame, frame AS z, y, x, value FROM strong WHERE strong),
n AS (SELECT *, {node} AS id FROM p),
e AS (SELECT a.id AS src, b.id AS dst FROM n a JOIN n b ON a.dataset = b.dataset AND ({step})),
reach(src, dst) AS (SELECT id, id FROM n UNION SELECT r.src, e.dst FROM reach r JOIN e ON r.dst = e.src),
label AS (SELECT dst AS id, min(src) AS spot FROM reach GROUP BY dst),
s AS (SELECT n.*, spot FROM n JOIN label USING (id))"""


_BOXES_SQL = f"""WITH RECURSIVE {_strong_sql(3.0)},
{_reach_sql(False)}
SELECT dataset, frame, min(x) AS l, min(y) AS t, max(x) AS r, max(y) AS b, count(*) AS n_px FROM s GROUP BY dataset, frame, spot HAVING count(*) >= 2"""


def spots_3d(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = S.measured(S.labelled(S.with_slices(_strong(spark, sf_dir)), across_frames=True))
    found = S.filtered(found, min_spot_size=2, max_separation=1.5)
    rounded = {c: F.round(c, 9) for c in ("com_x", "com_y", "com_z", "peak_distance")}
    return found.withColumns(rounded).drop("spot")


_MEASURED_SQL = """t AS (SELECT dataset, spot, count(*) AS n_px, min(x) AS x_min, max(x) AS x_max, min(y) AS y_min, max(y) AS y_max, min(z) AS z_min, max(z) AS z_max, CAST(sum(value) AS BIGINT) AS total,
             CAST(sum((2 * x + 1) * value) AS DOUBLE) / (2 * sum(value)) AS com_x, CAST(sum((2 * y + 1) * value) AS DOUBLE) / (2 * sum(value)) AS com_y, CAST(sum((2 * z + 1) * value) AS DOUBLE) / (2 * sum(value)) AS com_z FROM s GROUP BY dataset, spot),
k AS (SELECT dataset, spot, value AS peak_value, z AS peak_z, y AS peak_y, x AS peak_x FROM s QUALIFY row_number() OVER (PARTITION BY dataset, spot ORDER BY value DESC, z, y, x) = 1),
a AS (SELECT *, z_max - z_min + 1 AS depth, sqrt(pow(com_x - peak_x - 0.5, 2) + pow(com_y - peak_y - 0.5, 2) + pow(com_z - peak_z - 0.5, 2)) AS peak_distance FROM t JOIN k USING (dataset, spot))"""
_ROUNDED_SQL = "SELECT * EXCLUDE (spot) REPLACE (round(com_x, 9) AS com_x, round(com_y, 9) AS com_y, round(com_z, 9) AS com_z, round(peak_distance, 9) AS peak_distance)"
_SPOTS_SQL = f"""WITH RECURSIVE {_strong_sql(3.0)},
{_reach_sql(True)},
{_MEASURED_SQL}
{_ROUNDED_SQL} FROM a WHERE n_px >= 2 AND peak_distance <= 1.5"""


def _widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Oscillation width of each dataset: its suppliers' least balance, 0 if that is below."""
    return table(spark, sf_dir, "supplier").groupBy(F.floor(F.col("s_suppkey") / 10).cast("int").alias("dataset")).agg(F.greatest(F.min("s_acctbal"), F.lit(0.0)).alias("osc_width"))


def routed_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spots of a mixture of scans and stills: in three dimensions where a dataset turns, frame by frame where it doesn't."""
    found = S.found_spots(_strong(spark, sf_dir), _widths(spark, sf_dir), min_spot_size=2, min_scan_size=2, max_separation=1.5)
    rounded = {c: F.round(c, 9) for c in ("com_x", "com_y", "com_z", "peak_distance")}
    return found.withColumns(rounded).drop("spot")


_SCANS_SQL = "SELECT CAST(s_suppkey // 10 AS INT) AS dataset FROM supplier GROUP BY ALL HAVING min(s_acctbal) > 0"
_ROUTED_SQL = f"""WITH RECURSIVE {_strong_sql(3.0)},
scans AS ({_SCANS_SQL}),
{_reach_sql(True, "a.dataset IN (SELECT dataset FROM scans)")},
{_MEASURED_SQL},
k2 AS (SELECT *, dataset IN (SELECT dataset FROM scans) AS turning FROM a)
{_ROUNDED_SQL}, CAST(CASE WHEN NOT turning THEN z_min END AS INT) AS frame FROM k2 WHERE n_px >= 2 AND (NOT turning OR peak_distance <= 1.5)"""


def still_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strong pixels and spots of every frame of the datasets that don't turn, frames without any included."""
    strong, widths = written(_strong(spark, sf_dir)), _widths(spark, sf_dir)
    found = S.found_spots(strong, widths, min_spot_size=2, min_scan_size=2, max_separation=1.5)
    return S.still_counts(seen_pixels(spark, sf_dir), strong, found, widths)


_STILL_FRAMES_SQL = f"""WITH RECURSIVE {_strong_sql(3.0)},
scans AS ({_SCANS_SQL}),
{_reach_sql(False)},
b AS (SELECT dataset, frame, count(*) AS n FROM s GROUP BY dataset, frame, spot HAVING count(*) >= 2),
c AS (SELECT dataset, frame, count(*) AS n_spots FROM b GROUP BY ALL),
p2 AS (SELECT dataset, frame, count(*) AS n_strong FROM strong WHERE strong GROUP BY ALL)
SELECT dataset, frame, coalesce(n_strong, 0) AS n_strong, coalesce(n_spots, 0) AS n_spots
FROM (SELECT DISTINCT dataset, frame FROM seen) LEFT JOIN p2 USING (dataset, frame) LEFT JOIN c USING (dataset, frame) WHERE dataset NOT IN (SELECT dataset FROM scans)"""


def _part_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.histogram(table(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "refl_id"), ["refl_id"], F.col("l_quantity").cast("int"))


def background_tukey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.tukey(_part_histogram(spark, sf_dir), ["refl_id"], 49)


_TUKEY_SQL = """
WITH h AS (SELECT l_partkey AS refl_id, CAST(l_quantity AS INT) AS value, count(*) AS cnt FROM lineitem GROUP BY ALL),
c AS (SELECT *, sum(cnt) OVER (PARTITION BY refl_id) AS n, sum(cnt) OVER (PARTITION BY refl_id ORDER BY value ROWS UNBOUNDED PRECEDING) AS cum FROM h),
q AS (SELECT *, coalesce(min(CASE WHEN value < 49 AND cum >= (n + 3) // 4 THEN value END) OVER (PARTITION BY refl_id), 49) AS q1,
                coalesce(min(CASE WHEN value < 49 AND cum >= (3 * n + 1) // 4 THEN value END) OVER (PARTITION BY refl_id), 49) AS q3 FROM c),
g AS (SELECT *, value < 49 AND value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1) AS good FROM q),
a AS (SELECT refl_id, max(n) AS n, coalesce(sum(cnt) FILTER (WHERE value >= 49), 0) AS overflow, max(q1) AS q1, max(q3) AS q3,
             coalesce(sum(cnt) FILTER (WHERE good), 0) AS n_in, coalesce(sum(cnt * value) FILTER (WHERE good), 0) AS sum_in FROM g GROUP BY refl_id),
v AS (SELECT *, n_in > 0 AND overflow <= 0.25 * n AND q3 + 1.5 * (q3 - q1) < 49 AS valid FROM a)
SELECT refl_id, CAST(n AS BIGINT) AS n, CAST(overflow AS BIGINT) AS overflow, q1, q3, CAST(n_in AS BIGINT) AS n_in, CAST(sum_in AS BIGINT) AS sum_in,
       CASE WHEN valid THEN CAST(sum_in AS DOUBLE) / n_in END AS mean, valid FROM v"""


def background_glm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.glm(_part_histogram(spark, sf_dir), ["refl_id"])


def overflow_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.overflow_guard(background_tukey(spark, sf_dir))


_OVERFLOW_SQL = f"SELECT count(*) FILTER (WHERE CAST(overflow AS DOUBLE) / n > 0.25) AS n_over, max(CAST(overflow AS DOUBLE) / n) AS worst FROM ({_TUKEY_SQL})"


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    at = {"x_min": F.col("o_custkey") % 28, "y_min": F.col("o_orderkey") % 28, "z_min": F.col("o_orderkey") % 8}
    suppliers = F.floor(F.max("l_suppkey") / 10).cast("int")
    sets = table(spark, sf_dir, "lineitem").agg(suppliers.alias("sets"))
    rows = o.join(F.broadcast(sets), how="cross")
    rows = rows.select(F.col("o_orderkey").alias("refl_id"), (F.col("o_orderkey") % F.greatest("sets", F.lit(1))).cast("int").alias("dataset"), *(c.cast("int").alias(n) for n, c in at.items()))
    return rows.withColumns({"x_max": F.col("x_min") + 6, "y_max": F.col("y_min") + 6, "z_max": F.col("z_min") + 3})


_BOX_SQL = """
boxes AS (SELECT o_orderkey AS refl_id, CAST(o_orderkey % greatest((SELECT max(l_suppkey) // 10 FROM lineitem), 1) AS INT) AS dataset,
                 CAST(o_custkey % 28 AS INT) AS x_min, CAST(o_orderkey % 28 AS INT) AS y_min, CAST(o_orderkey % 8 AS INT) AS z_min FROM orders)"""


def shoebox_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    def middle(x: np.ndarray, y: np.ndarray, frame: np.ndarray, columns: dict[str, np.ndarray]) -> np.ndarray:
        return (np.abs(2 * (x - columns["x_min"]) - 5) <= 3) & (np.abs(2 * (y - columns["y_min"]) - 5) <= 3)

    return X.summed_dense(_boxes(spark, sf_dir), dense(spark, sf_dir), middle)


_SHOEBOX_SQL = f"""WITH {_PX}, {_BOX_SQL},
b AS (SELECT *, z_min + dz AS frame, y_min + dy AS y, x_min + dx AS x, abs(2 * dx - 5) <= 3 AND abs(2 * dy - 5) <= 3 AS foreground
      FROM boxes, (SELECT unnest(range(3))::INT AS dz), (SELECT unnest(range(6))::INT AS dy), (SELECT unnest(range(6))::INT AS dx)),
j AS (SELECT b.*, px.value, coalesce(px.valid, FALSE) AS usable FROM b LEFT JOIN px USING (dataset, frame, y, x))
SELECT refl_id, CAST(coalesce(sum(value) FILTER (WHERE foreground AND usable), 0) AS BIGINT) AS fg_sum, count(*) FILTER (WHERE foreground AND usable) AS n_fg,
       count(*) FILTER (WHERE NOT foreground AND usable) AS n_bg, bool_and(NOT foreground OR usable) AS ok,
       CAST(coalesce(sum(value * (2 * x + 1)) FILTER (WHERE foreground AND usable), 0) AS BIGINT) AS x_moment,
       CAST(coalesce(sum(value * (2 * y + 1)) FILTER (WHERE foreground AND usable), 0) AS BIGINT) AS y_moment,
       CAST(coalesce(sum(value * (2 * frame + 1)) FILTER (WHERE foreground AND usable), 0) AS BIGINT) AS frame_moment,
       CAST(coalesce(sum(value) FILTER (WHERE NOT foreground AND usable), 0) AS BIGINT) AS bg_sum
FROM j GROUP BY refl_id"""


def net_intensities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shoebox_sum(spark, sf_dir).withColumn("mean", F.when(F.col("n_bg") > 0, F.col("bg_sum") / F.col("n_bg")).otherwise(0.0))
    rows = B.net_intensity(rows.where("ok AND n_fg > 0"))
    return rows.select("refl_id", *(F.round(c, 8).alias(c) for c in ("intensity", "variance", "sigma")))


_NET_SQL = f"""WITH t AS ({_SHOEBOX_SQL}),
m AS (SELECT *, CASE WHEN n_bg > 0 THEN CAST(bg_sum AS DOUBLE) / n_bg ELSE 0.0 END AS mean FROM t WHERE ok AND n_fg > 0),
i AS (SELECT *, fg_sum - n_fg * mean AS intensity, CASE WHEN n_bg > 0 THEN CAST(n_fg AS DOUBLE) / n_bg ELSE 0.0 END AS ratio FROM m),
v AS (SELECT *, abs(intensity) + abs(n_fg * mean) * (1 + ratio) AS variance FROM i)
SELECT refl_id, round(intensity, 8) AS intensity, round(variance, 8) AS variance, round(sqrt(variance), 8) AS sigma FROM v"""


def reflections_per_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.per_image(_boxes(spark, sf_dir))


_PER_IMAGE_SQL = f"""WITH {_BOX_SQL},
n AS (SELECT dataset, frame, count(*) AS n FROM (SELECT dataset, z_min + dz AS frame FROM boxes, (SELECT unnest(range(3)) AS dz)) GROUP BY ALL)
SELECT dataset, min(n) AS least, max(n) AS most, avg(n) AS mean FROM n GROUP BY dataset"""


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    at = lambda k: F.col("embedding")[k].cast("double")
    return e.select("vec_id", "label", V.vector(at(0), at(1), at(2)).alias("rlp"), at(3).alias("phi"))


#: Setting matrix of the test crystal; its inverse is written out for the SQL.
_A = (0.05, 0.01, 0.0, 0.0, 0.04, 0.005, 0.0, 0.0, 0.0625)
_A_INVERSE = ((20.0, -5.0, 0.4), (0.0, 25.0, -2.0), (0.0, 0.0, 16.0))


def hkl_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.with_indices(_points(spark, sf_dir), F.col("rlp"), _A)
    return rows.select("vec_id", "h", "k", "l", F.round("lsq", 9).alias("lsq"))


_HKL_SQL = """
WITH p AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z, CAST(embedding[4] AS DOUBLE) AS phi FROM embeddings),
f AS (SELECT *, 20.0 * x - 5.0 * y + 0.4 * z AS fh, 25.0 * y - 2.0 * z AS fk, 16.0 * z AS fl FROM p),
r AS (SELECT *, round(fh) AS rh, round(fk) AS rk, round(fl) AS rl FROM f),
s AS (SELECT *, pow(rh - fh, 2) + pow(rk - fk, 2) + pow(rl - fl, 2) AS d FROM r),
g AS (SELECT *, d <= 0.09 AND (rh <> 0 OR rk <> 0 OR rl <> 0) AS good FROM s)
SELECT vec_id, label, phi, CAST(CASE WHEN good THEN rh ELSE 0 END AS INT) AS h, CAST(CASE WHEN good THEN rk ELSE 0 END AS INT) AS k, CAST(CASE WHEN good THEN rl ELSE 0 END AS INT) AS l,
       CASE WHEN good THEN d END AS lsq FROM g"""


def indexed_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.indexed_fraction(I.with_indices(_points(spark, sf_dir), F.col("rlp"), _A), ["label"])


def hkl_contest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.with_indices(_points(spark, sf_dir), F.col("rlp"), _A).drop("rlp")
    return I.settle_duplicates(rows, ["label"], row="vec_id").select("vec_id", "h", "k", "l")


# the fold over a Miller index's rows in order of vec_id, one row a step, all indices at a time
_CONTEST_SQL = f"""WITH RECURSIVE x AS ({_HKL_SQL}),
r AS (SELECT label, h, k, l, list(vec_id ORDER BY vec_id) AS ids, list(phi ORDER BY vec_id) AS p, list(lsq ORDER BY vec_id) AS q FROM x WHERE lsq IS NOT NULL GROUP BY ALL),
w(h, k, l, ids, p, q, i, alive) AS (
  SELECT h, k, l, ids, p, q, 1, list_transform(ids, lambda t: TRUE) FROM r
  UNION ALL
  SELECT h, k, l, ids, p, q, i + 1, CASE WHEN alive[i] THEN list_transform(range(1, len(ids) + 1), lambda j: CASE WHEN j = i THEN first_better IS NULL
      WHEN j > i AND j < coalesce(first_better, len(ids) + 1) AND abs(p[j] - p[i]) <= pi() / 4 THEN FALSE ELSE alive[j] END) ELSE alive END
  FROM (SELECT *, list_filter(range(i + 1, len(ids) + 1), lambda j: alive[j] AND abs(p[j] - p[i]) <= pi() / 4 AND q[j] < q[i])[1] AS first_better FROM w WHERE i <= len(ids))),
z AS (SELECT unnest(ids) AS vec_id, h, k, l, unnest(alive) AS keeps FROM w WHERE i = len(ids) + 1),
n AS (SELECT vec_id, h, k, l FROM z WHERE keeps)
SELECT x.vec_id, CAST(coalesce(n.h, 0) AS INT) AS h, CAST(coalesce(n.k, 0) AS INT) AS k, CAST(coalesce(n.l, 0) AS INT) AS l FROM x LEFT JOIN n ON n.vec_id = x.vec_id"""


def grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.grid_cells(_points(spark, sf_dir), ["label"], F.col("rlp"), 2.0, 10.0, 64, row="vec_id")
    return rows.withColumn("weight", F.round("weight", 9))


_GRID_SQL = """
WITH p AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings),
g AS (SELECT *, CAST(round(x * 64.0) AS INT) + 32 AS i, CAST(round(y * 64.0) AS INT) + 32 AS j, CAST(round(z * 64.0) AS INT) + 32 AS k, x * x + y * y + z * z AS q FROM p)
SELECT label, k + 64 * j + 4096 * i AS cell, round(max_by(exp(-10.0 * q / 4), vec_id), 9) AS weight FROM g
WHERE i BETWEEN 0 AND 63 AND j BETWEEN 0 AND 63 AND k BETWEEN 0 AND 63 AND q * 4.0 <= 1 GROUP BY ALL"""


def lp_and_dspacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _points(spark, sf_dir)
    s1 = V.add(V.scale(V.parts(F.col("rlp")), 0.2), (0.0, 0.0, -1.0))
    lp = G.lp_factor(V.parts((0, 0, -1)), V.parts((0, 1, 0)), 0.999, V.parts((1, 0, 0)), s1)
    h, k, l = (F.col("vec_id") % m for m in (7, 5, 11))  # noqa: E741
    d = V.d_spacing(h.cast("double"), k.cast("double"), l.cast("double"), tuple(map(F.lit, (58.0, 58.0, 150.0, 90.0, 90.0, 120.0))))
    return rows.select("vec_id", F.round(lp, 9).alias("lp"), F.round(d, 7).alias("d"))


_LP_SQL = """
WITH p AS (SELECT vec_id, 0.2 * CAST(embedding[1] AS DOUBLE) AS x, 0.2 * CAST(embedding[2] AS DOUBLE) AS y, 0.2 * CAST(embedding[3] AS DOUBLE) - 1.0 AS z,
                  CAST(vec_id % 7 AS DOUBLE) AS h, CAST(vec_id % 5 AS DOUBLE) AS k, CAST(vec_id % 11 AS DOUBLE) AS l FROM embeddings),
n AS (SELECT *, sqrt(x * x + y * y + z * z) AS s FROM p)
SELECT vec_id, round(abs(y) / s / ((1 - 2 * 0.999) * (1 - pow(y / s, 2)) + 0.999 * (1 + pow(-z / s, 2))), 9) AS lp,
       round(CASE WHEN h <> 0 OR k <> 0 OR l <> 0 THEN 1 / sqrt(4.0 / 3.0 * (h * h + h * k + k * k) / (58.0 * 58.0) + l * l / (150.0 * 150.0)) END, 7) AS d FROM n"""


def spot_reciprocal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reciprocal points of the strong pixels' centres, rounded to 1e-8."""
    rows = _strong(spark, sf_dir)
    rlp, _, _ = G.spot_rlp(F.col("x") + 0.5, F.col("y") + 0.5, F.col("frame") + 0.5, fast=V.parts((1, 0, 0)), slow=V.parts((0, -1, 0)), origin=V.parts((-1.2, 1.3, -2.0)), px=(0.075, 0.075), wavelength=1.0, s0=V.parts((0, 0, -1)), axis=V.parts((1, 0, 0)), image_start=1, osc_start=0.0, osc_width=0.5)
    return rows.select("dataset", "frame", "y", "x", *(F.round(c, 8).alias(f"r{n}") for n, c in zip("xyz", rlp, strict=True)))


_RLP_SQL = f"""WITH {_strong_sql(3.0)},
l AS (SELECT dataset, frame, y, x, (x + 0.5) * 0.075 - 1.2 AS u, -(y + 0.5) * 0.075 + 1.3 AS v, -2.0 AS w, radians((frame + 0.5) * 0.5) AS phi FROM strong WHERE strong),
s AS (SELECT *, sqrt(u * u + v * v + w * w) AS n FROM l),
q AS (SELECT *, u / n AS a, v / n AS b, w / n + 1 AS c FROM s)
SELECT dataset, frame, y, x, round(a, 8) AS rx, round(b * cos(phi) + c * sin(phi), 8) AS ry, round(c * cos(phi) - b * sin(phi), 8) AS rz FROM q"""


def candidate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("candidate")).agg(F.avg("l_quantity").alias("rmsd"), F.avg(F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.5)).alias("fraction"), F.sum("l_quantity").alias("volume"))
    rows = I.scored(lines.withColumn("dataset", F.floor(F.col("candidate") / 10)), ["dataset"], in_turn=True)
    return rows.select("dataset", "candidate", F.round("score", 9).alias("score"), "rank")


_SCORES_SQL = """
WITH c AS (SELECT l_suppkey AS candidate, CAST(floor(l_suppkey / 10) AS BIGINT) AS dataset, avg(l_quantity) AS rmsd, avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END) AS fraction, sum(l_quantity) AS volume FROM lineitem GROUP BY l_suppkey),
s AS (SELECT *, log2(rmsd) - min(log2(rmsd)) OVER w + max(log2(fraction)) OVER w - log2(fraction) + log2(volume) - min(log2(volume)) OVER w AS score FROM c WINDOW w AS (PARTITION BY dataset))
SELECT dataset, candidate, round(score, 9) AS score, CAST(row_number() OVER (PARTITION BY dataset ORDER BY score, candidate) AS INT) AS rank FROM s"""


def outlier_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("dataset"), F.col("l_extendedprice").alias("dx"), F.col("l_quantity").alias("dy"))
    return I.without_outliers(rows, ["dataset"], ["dx", "dy"], 0.5).groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))


def _quartile_sql(column: str) -> str:
    return f"""(SELECT dataset, avg(CASE WHEN pos = half // 2 OR (half % 2 = 0 AND pos = half // 2 - 1) THEN v END) AS q1,
                       avg(CASE WHEN pos = n // 2 + half // 2 OR (half % 2 = 0 AND pos = n // 2 + half // 2 - 1) THEN v END) AS q3
                FROM (SELECT dataset, {column} AS v, row_number() OVER (PARTITION BY dataset ORDER BY {column}) - 1 AS pos, count(*) OVER (PARTITION BY dataset) AS n, (count(*) OVER (PARTITION BY dataset) + 1) // 2 AS half FROM t) GROUP BY dataset)"""


_OUTLIER_SQL = f"""WITH t AS (SELECT l_suppkey AS dataset, l_extendedprice AS dx, l_quantity AS dy FROM lineitem)
SELECT t.dataset, count(*) AS n FROM t JOIN {_quartile_sql("dx")} a USING (dataset) JOIN {_quartile_sql("dy")} b USING (dataset)
WHERE dx BETWEEN a.q1 - 0.5 * (a.q3 - a.q1) AND a.q3 + 0.5 * (a.q3 - a.q1) AND dy BETWEEN b.q1 - 0.5 * (b.q3 - b.q1) AND b.q3 + 0.5 * (b.q3 - b.q1)
GROUP BY t.dataset"""


def arm_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    results = e.select(F.floor(F.col("event_id") / 2).alias("dcid"), (F.col("event_id") % 2 == 0).alias("gpu"), "ts", F.col("value").alias("results"))
    return service.paired(results)


_PAIR_SQL = """
SELECT a.event_id // 2 AS dcid, a.ts AS ts_gpu, a.value AS results_gpu, b.ts AS ts_cpu, b.value AS results_cpu
FROM events a JOIN events b ON a.event_id // 2 = b.event_id // 2 WHERE a.event_id % 2 = 0 AND b.event_id % 2 = 1"""


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("user_id", "ts", "event_id", (F.row_number().over(Window.partitionBy("user_id").orderBy(F.col("event_id") % 3, "event_id")) - 1).alias("message_index"))


def message_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service.message_gaps(_messages(spark, sf_dir), "user_id", "message_index", ["ts", "event_id"]).select("user_id", "event_id", "message_index", "expected")


_GAPS_SQL = """
WITH m AS (SELECT user_id, ts, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id % 3, event_id) - 1 AS INT) AS message_index FROM events),
x AS (SELECT *, coalesce(lag(message_index) OVER (PARTITION BY user_id ORDER BY ts, event_id) + 1, 0) AS expected FROM m)
SELECT user_id, event_id, message_index, expected FROM x WHERE message_index <> expected"""


def stale_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").alias("startTime"), (F.col("value") > 50).alias("has_data"))
    last = Window.partitionBy("user_id")
    rows = rows.withColumn("now", F.max("startTime").over(last))
    return service.fresh(rows, F.col("now"), "6 hours", "has_data").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_fresh"))


_STALE_SQL = """
WITH m AS (SELECT *, max(ts) OVER (PARTITION BY user_id) AS now FROM events)
SELECT user_id, count(*) AS n_fresh FROM m WHERE ts IS NULL OR ts + INTERVAL 6 HOUR >= now OR value > 50 GROUP BY user_id"""


def rate_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = service.rates(table(spark, sf_dir, "events"), "ts", ["event_type"], "value")
    return rows.withColumn("total", F.round("total", 6))


_RATE_SQL = "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL"


def manifest_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File and offset of every frame: orders of a day are a file of frames."""
    o = table(spark, sf_dir, "orders")
    manifest = o.groupBy(F.year("o_orderdate").alias("dataset"), F.dayofyear("o_orderdate").alias("file_no")).agg(F.count(F.lit(1)).alias("frames"))
    frames = o.select(F.year("o_orderdate").alias("dataset"), (F.row_number().over(Window.partitionBy(F.year("o_orderdate")).orderBy("o_orderkey")) - 1).alias("frame"))
    return R.locate(frames, manifest).select("dataset", "frame", "file_no", "offset")


_MANIFEST_SQL = """
WITH m AS (SELECT year(o_orderdate) AS dataset, dayofyear(o_orderdate) AS file_no, count(*) AS frames FROM orders GROUP BY ALL),
s AS (SELECT *, sum(frames) OVER (PARTITION BY dataset ORDER BY file_no) AS stop FROM m),
f AS (SELECT year(o_orderdate) AS dataset, CAST(row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) - 1 AS INT) AS frame FROM orders)
SELECT f.dataset, f.frame, s.file_no, CAST(f.frame - (s.stop - s.frames) AS BIGINT) AS "offset" FROM f JOIN s ON f.dataset = s.dataset AND f.frame >= s.stop - s.frames AND f.frame < s.stop"""


def large_void_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("dataset"), (F.col("l_partkey") % 50).alias("void")).agg(F.sum("l_quantity").cast("long").alias("size"))
    return I.large_voids(sizes, ["dataset"], 0.7)


_VOID_SQL = """
WITH v AS (SELECT l_suppkey AS dataset, l_partkey % 50 AS void, CAST(sum(l_quantity) AS BIGINT) AS size FROM lineitem GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY size, void) - 1 AS pos, count(*) OVER (PARTITION BY dataset) AS n FROM v),
q AS (SELECT *, max(CASE WHEN pos = n * 3 // 4 THEN size END) OVER w AS q3, max(CASE WHEN pos = n // 4 THEN size END) OVER w AS q1 FROM r WINDOW w AS (PARTITION BY dataset)),
m AS (SELECT *, max(CASE WHEN size <= (q3 - q1) * 5 + q3 THEN size END) OVER (PARTITION BY dataset) AS top FROM q)
SELECT dataset, void, size FROM m WHERE size > floor(0.7 * top)"""


def absence_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of Miller indices that follow each pattern of absences, by customer segment group."""
    from ..functions.lattice import reindexings

    o = table(spark, sf_dir, "orders")
    rows = o.select((F.col("o_custkey") % 20).alias("dataset"), (F.col("o_orderkey") % 9 * 2).cast("int").alias("h"), (F.col("o_custkey") % 7).cast("int").alias("k"), (F.col("o_orderkey") % 5).cast("int").alias("l"))
    patterns = spark.createDataFrame([(n, *map(int, v), m) for n, (v, m, _) in enumerate(reindexings())], "pattern int, u int, v int, w int, m int")
    return I.detected_pattern(I.residue_counts(rows, ["dataset"], patterns), ["dataset"])


_ALL: dict[Callable[[SparkSession, str], DataFrame], str | None] = {
    strong_pixels_per_frame: f"WITH {_strong_sql(3.0)}\nSELECT dataset, frame, count(*) FILTER (WHERE strong) AS n_strong, count(*) FILTER (WHERE value <> 0) AS n_nonzero FROM strong GROUP BY ALL",
    strong_window_counts: f"WITH {_strong_sql(3.0)}\nSELECT dataset, frame, count(*) FILTER (WHERE strong) AS n_strong, count(*) FILTER (WHERE value <> 0) AS n_nonzero FROM strong GROUP BY ALL",
    extended_strong_pixels: _EXTENDED_SQL, summed_area_table: _SAT_SQL, pixel_resolution_mask: _MASK_SQL, frame_boxes: _BOXES_SQL, spots_3d: _SPOTS_SQL, routed_spots: _ROUTED_SQL, still_frames: _STILL_FRAMES_SQL, background_tukey: _TUKEY_SQL,
    background_glm: None, overflow_report: _OVERFLOW_SQL, shoebox_sum: _SHOEBOX_SQL, net_intensities: _NET_SQL, reflections_per_image: _PER_IMAGE_SQL,
    hkl_assign: f"SELECT vec_id, h, k, l, round(lsq, 9) AS lsq FROM ({_HKL_SQL})",
    indexed_fraction: f"SELECT label, count(*) FILTER (WHERE lsq IS NOT NULL) AS n_indexed, count(*) AS n, CAST(count(*) FILTER (WHERE lsq IS NOT NULL) AS DOUBLE) / count(*) AS fraction FROM ({_HKL_SQL}) GROUP BY label",
    hkl_contest: _CONTEST_SQL, grid_cells: _GRID_SQL, lp_and_dspacing: _LP_SQL, spot_reciprocal: _RLP_SQL, candidate_scores: _SCORES_SQL, outlier_filter: _OUTLIER_SQL, arm_pairing: _PAIR_SQL,
    message_gaps: _GAPS_SQL, stale_requests: _STALE_SQL, rate_windows: _RATE_SQL, manifest_lookup: _MANIFEST_SQL, large_void_filter: _VOID_SQL, absence_pattern: None,
}


def _registered() -> dict[Callable[[SparkSession, str], DataFrame], str | None]:
    from . import reflections

    return _ALL | reflections.ALL | {absence_pattern: reflections.ABSENCE_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _registered()}


def oracle_sql() -> dict[str, str]:
    return {f.__name__: sql for f, sql in _registered().items() if sql}
