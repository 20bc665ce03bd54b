import numpy as np
import pytest
from pyspark.sql import functions as F

from brillouin.functions import geometry as G
from brillouin.functions import vec as V
from brillouin.operators import background as B
from brillouin.operators import shoebox as X
from brillouin.operators import spots as S
from brillouin.operators import threshold as T
from brillouin.operators.graph import components, forest
from brillouin.sources import frames as R

PIXEL = "dataset int, frame int, y int, x int, value long, valid boolean"


def image(seed, h=24, w=30, frames=2):
    rng = np.random.default_rng(seed)
    out = []
    for f in range(frames):
        a = rng.poisson(4, (h, w))
        for _ in range(6):
            y, x = rng.integers(2, h - 2), rng.integers(2, w - 2)
            a[y - 1 : y + 2, x - 1 : x + 2] += rng.poisson(40, (3, 3))
        out.append((a, rng.random((h, w)) > 0.05))
    return out


def pixel_rows(spark, images):
    return spark.createDataFrame([(0, f, y, x, int(a[y, x]), bool(m[y, x])) for f, (a, m) in enumerate(images) for y in range(a.shape[0]) for x in range(a.shape[1])], PIXEL)


@pytest.mark.parametrize("extended", [False, True])
def test_windows_and_tiles_agree(spark, extended):
    images = image(3)
    window = (T.dispersion_extended if extended else T.dispersion)(pixel_rows(spark, images), n_sig_b=2.0).where("strong").select("frame", "y", "x")
    dense = spark.createDataFrame([(0, f, *a.shape, a.ravel().tolist(), m.ravel().tolist()) for f, (a, m) in enumerate(images)], "dataset int, frame int, h int, w int, data array<long>, valid array<boolean>")
    for tile in (7, 64):
        got = T.strong_pixels_dense(dense, tile=tile, extended=extended, n_sig_b=2.0)
        assert set(map(tuple, got.select("frame", "y", "x").collect())) == set(map(tuple, window.collect())) != set()


def test_flat_and_masked_images_have_no_strong_pixels(spark):
    flat = spark.range(400).select(F.lit(0).alias("dataset"), F.lit(0).alias("frame"), (F.col("id") / 20).cast("int").alias("y"), (F.col("id") % 20).cast("int").alias("x"), F.lit(0).cast("long").alias("value"))
    assert T.per_frame(T.dispersion(T.with_validity(flat))).first()["n_strong"] == 0
    hot = T.with_validity(flat.withColumn("value", F.when((F.col("x") == 5) & (F.col("y") == 5), 900).otherwise(0).cast("long")), trusted_max=500)
    assert T.per_frame(T.dispersion(hot)).first()["n_strong"] == 0


def test_synthetic_frames(spark):
    # sizes of the large test detector, read from its description
    px = R.synthetic_pixels(spark, 220, 300, {1: "flat", 2: "grid", 3: "x", 4: "y", 5: "random", 6: "empty"}, module=(64, 90), gap=(8, 12))
    sums = {r["frame"]: r["n"] for r in px.groupBy("frame").agg(F.sum("value").alias("n")).collect()}
    ok = lambda v, m, g: v % (m + g) < m
    cells = [(y, x) for y in range(220) for x in range(300) if ok(y, 64, 8) and ok(x, 90, 12)]
    assert sums == {1: len(cells), 2: 100 * sum(y % 42 == 0 and x % 42 == 0 for y, x in cells), 3: sum(x for _, x in cells), 4: sum(y for y, _ in cells), 5: sums[5], 6: 0}
    one = R.to_modules(px.where("frame = 1"), (64, 90), (8, 12))
    assert one.where("y >= 64 OR x >= 90").count() == 0 and one.count() == len(cells)


def histogram(spark, bins):
    return spark.createDataFrame([(1, v, c) for v, c in bins.items()], "refl_id int, value int, cnt long")


@pytest.mark.parametrize("bins,valid,total,mean", [
    ({v: 1 for v in range(10)}, True, 45, 4.5), ({**{v: 1 for v in range(10)}, 99: 1}, True, 45, 4.5), ({**{v: 1 for v in range(10)}, 60: 1}, True, 45, 4.5), ({5: 20}, True, 100, 5.0),
])
def test_tukey(spark, bins, valid, total, mean):
    got = B.tukey(histogram(spark, bins), ["refl_id"], 64).first()
    assert (got["valid"], got["sum_in"], got["mean"]) == (valid, total, mean)


def test_tukey_refuses(spark):
    assert not B.tukey(histogram(spark, {v: 1 for v in range(16)}), ["refl_id"], 16).first()["valid"]
    assert B.tukey(histogram(spark, {}), ["refl_id"]).count() == 0
    assert B.tukey(histogram(spark, {1: 1, 5000: 3}), ["refl_id"], None).first()["valid"]


@pytest.mark.parametrize("bins,mean,n", [
    ({2: 3, 3: 5, 4: 8, 5: 6, 6: 2}, 4.0304431542, 24), ({2: 3, 3: 5, 4: 8, 5: 6, 6: 2, 120: 1}, 4.1427022177, 25),
    ({2: 10, 3: 20, 4: 30, 5: 25, 999: 4}, 4.0257619071, 89), ({48: 4, 50: 10, 52: 8, 55: 3, 60: 2}, 51.6834964586, 27),
])
def test_robust_poisson(spark, bins, mean, n):
    got = B.glm(histogram(spark, bins), ["refl_id"]).first()
    assert got["valid"] and got["n"] == n and got["mean"] == pytest.approx(mean, abs=1e-6) and got["sum"] == pytest.approx(mean * n, abs=1e-4)


def test_robust_poisson_refuses(spark):
    got = B.glm(histogram(spark, {3: 5}), ["refl_id"]).first()
    assert not got["valid"] and got["mean"] is None
    assert B.merged(histogram(spark, {3: 5}), histogram(spark, {3: 1, 4: 2}), key=["refl_id"]).agg(F.sum("cnt")).first()[0] == 8


def test_box_of_a_known_spot(spark):
    px = pixel_rows(spark, [(np.full((12, 12), 2) + (np.add.outer(np.abs(np.arange(12) - 5), np.abs(np.arange(12) - 5)) <= 1) * 50, np.ones((12, 12), bool))])
    box = spark.createDataFrame([(1, 0, 2, 9, 2, 9, 0, 1), (2, 0, 10, 14, 10, 14, 0, 1), (3, 0, 1, 1, 1, 4, 0, 1)], "refl_id int, dataset int, x_min int, x_max int, y_min int, y_max int, z_min int, z_max int")
    rows = X.joined(box, px).withColumn("foreground", F.abs(F.col("x") - 5) + F.abs(F.col("y") - 5) <= 1)
    got = {r["refl_id"]: r for r in X.summed(rows).collect()}
    assert (got[1]["fg_sum"], got[1]["n_fg"], got[1]["n_bg"], got[1]["ok"]) == (260, 5, 44, True)
    assert (got[2]["n_fg"], got[2]["n_bg"]) == (0, 4) and 3 not in got
    net = B.net_intensity(spark.createDataFrame([(260, 5, 44, 2.0)], "fg_sum long, n_fg long, n_bg long, mean double")).first()
    assert net["intensity"] == 250 and net["variance"] == pytest.approx(250 + 10 * (1 + 5 / 44))
    centre = X.with_centroid(X.summed(rows).join(box, "refl_id")).where("refl_id = 1").first()
    assert (centre["x_obs"], centre["y_obs"], centre["z_obs"]) == (5.5, 5.5, 0.5)
    assert {r["passes"]: r["frames"] for r in X.pass_histogram(box, 8).collect()} == {"5-8": 1, "1": 1, "2": 1}


def test_scans_and_stills_in_one_table(spark):
    """The same column of pixels through three frames: one spot in a scan, three in stills of every kind."""
    strong = spark.createDataFrame([(d, f, y, 7, 5 + f) for d in ("scan", "still", "unknown", "null", "nan") for f in range(3) for y in (3, 4)], "dataset string, frame int, y int, x int, value long")
    widths = spark.createDataFrame([("scan", 0.1), ("scan", 0.0), ("still", 0.0), ("null", None), ("nan", float("nan")), (None, 1.0)], "dataset string, osc_width double")
    found = S.found_spots(strong, widths, min_spot_size=2, min_scan_size=6, max_separation=2.0)
    got = {(r["dataset"], r["frame"], r["turning"], r["n_px"], r["depth"]) for r in found.collect()}
    assert got == {("scan", None, True, 6, 3)} | {(d, f, False, 2, 1) for d in ("still", "unknown", "null", "nan") for f in range(3)}
    frames = spark.createDataFrame([("still", 0), ("still", 9), ("still", 9), ("scan", 0)], "dataset string, frame int")
    assert sorted(map(tuple, S.still_counts(frames, strong, found, widths).collect())) == [("still", 0, 2, 1), ("still", 9, 0, 0)]
    assert S.found_spots(strong.where("false"), widths).count() == 0


def test_pixel_rows_need_no_table_of_dense_frames(spark):
    import numpy as np

    from brillouin.operators import threshold as T

    rng = np.random.default_rng(5)
    rows = [(d, f, y, x, int(rng.poisson(3)) + 60 * (rng.random() < 0.03)) for d in range(2) for f in range(3) for y in range(20) for x in range(17) if rng.random() < 0.9]
    pixels = spark.createDataFrame(rows, "dataset int, frame int, y int, x int, value long")
    valid = np.arange(20)[:, None] % 7 + np.arange(17)[None] % 5 > 0
    frames = T.dense_frames(pixels, 20, 17, valid)
    for extended in (False, True):
        for dense, at_once in ((T.strong_counts_dense, T.strong_counts_of), (T.strong_pixels_dense, T.strong_pixels_of)):
            found = at_once(pixels, 20, 17, valid, tile=8, extended=extended, n_sig_b=1.0)
            assert sorted(found.collect()) == sorted(dense(frames, tile=8, extended=extended, n_sig_b=1.0).collect()) != []
            assert "MapInArrow" not in found._jdf.queryExecution().toString()
