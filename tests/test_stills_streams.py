"""Stills from spots to results; streams against what the same rows give as a table."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from brillouin.functions import geometry as G
from brillouin.functions import vec as V
from brillouin.operators import indexing as I
from brillouin.operators import predict as P
from brillouin.operators import stills
from brillouin.operators import spots as S
from brillouin.operators import threshold as T
from brillouin.sources import frames as R
from brillouin.sources import tables
from brillouin.streaming import service

PANEL = {"fast": (1.0, 0.0, 0.0), "slow": (0.0, -1.0, 0.0), "origin": (-60.0, 60.0, -150.0), "px": (0.075, 0.075), "size": (1600, 1600)}
S0 = (0.0, 0.0, -1.0)


def setting(angle):
    c, s = np.cos(angle), np.sin(angle)
    turn = np.array([[1, 0, 0], [0, c, -s], [0, s, c]]) @ np.array([[c, -s, 0], [s, c, 0], [0, 0, 1]])
    return (turn @ np.diag([1 / 40, 1 / 50, 1 / 60])).ravel().tolist()


@pytest.fixture(scope="module")
def still_spots(spark):
    frames = spark.createDataFrame([("a", 0, setting(0.3), S0), ("a", 1, setting(0.8), S0)], "dataset string, frame int, setting array<double>, s0 struct<x: double, y: double, z: double>")
    rays = P.stills_indices(frames, "setting", "s0", F.lit(1.6), 1e-3)
    rows = P.on_detector(rays, PANEL).select("dataset", "frame", "h", "k", "l", F.col("x_px").alias("x"), F.col("y_px").alias("y"))
    return rows.toPandas()


def test_stills_are_indexed(spark, still_spots):
    assert still_spots.groupby("frame").size().min() > 20, still_spots.groupby("frame").size()
    rows = [(r.dataset, int(r.frame), n, float(r.x), float(r.y)) for n, r in enumerate(still_spots.itertuples())] + [("a", 2, 9000 + k, 5.0 * k, 7.0 * k) for k in range(4)]
    spots = spark.createDataFrame(rows, "dataset string, frame int, id long, x double, y double")
    cells = spark.createDataFrame([("a", f, c, setting(a)) for f, a in ((0, 0.3), (1, 0.8), (2, 0.1)) for c, a in ((1, a + 0.2), (2, a), (3, a + 0.02))], "dataset string, frame int, candidate int, setting array<double>")
    frames, kept = stills.index_stills(spots, cells, panel=PANEL, wavelength=1.0, s0=S0)
    frames = {r["frame"]: r for r in frames.collect()}
    assert set(frames) == {0, 1} and all(r["candidate"] == 2 for r in frames.values())
    got = kept.toPandas().set_index("id")
    for n, r in enumerate(still_spots.itertuples()):
        if n in got.index:
            assert tuple(got.loc[n, ["h", "k", "l"]]) == (r.h, r.k, r.l)
    for f, r in frames.items():
        assert r["n_indexed"] > 0.9 * (still_spots["frame"] == f).sum() and max(r["rmsd_x"], r["rmsd_y"]) < 0.5


def test_residuals_without_near_rows(spark):
    rows = spark.createDataFrame([(0, 0.0, 0.0, 9.0, 9.0, 0.1), (1, 0.0, 0.0, 1.0, 1.0, 0.1)], "frame int, x_obs double, y_obs double, x_cal double, y_cal double, delpsi double")
    got = {r["frame"]: r for r in I.still_rmsds(rows, ["frame"]).collect()}
    assert got[0]["n_indexed"] == 0 and got[0]["rmsd_x"] is None and got[1]["rmsd_x"] == 1.0


def drained(query, spark, name, rows=0):
    """Rows of a memory sink; a stream with timeouts never runs dry, so it is stopped once it has given `rows`."""
    try:
        for _ in range(240):
            if query.awaitTermination(0.5) or (rows and spark.table(name).count() >= rows):
                break
        return spark.table(name).collect()
    finally:
        query.stop()


def memory(rows, name, tmp_path, mode="append"):
    return rows.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"ck_{name}")).trigger(availableNow=True).start()


def test_requests_in_a_stream(spark, tmp_path):
    good = {"dcid": 1, "dcgid": 1, "filename": "f", "message_index": 0, "number_of_frames": 2, "start_frame_index": 0, "xBeam": 1.0, "yBeam": 2.0, "detector_distance": 3.0, "unit_cell": "[58, 58, 150, 90, 90, 120]"}
    lines = [json.dumps(good), json.dumps({**good, "unit_cell": "1 2 3"}), "no json", json.dumps({**good, "dcid": None})]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join(lines))
    stream = spark.readStream.schema("value string").text(str(tmp_path / "in"))
    accepted, rejected = service.parsed_requests(stream)
    got = drained(memory(accepted, "accepted", tmp_path), spark, "accepted")
    assert [(r["dcid"], r["detector"], r["unit_cell"][5]) for r in got] == [(1, "Eiger16M", 120.0)]
    assert len(drained(memory(rejected, "rejected", tmp_path), spark, "rejected")) == 3


def test_soft_order_and_completeness(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.json").write_text("\n".join(json.dumps({"dcgid": 1, "message_index": k, "n": k}) for k in (2, 0, 1)))
    stream = spark.readStream.schema("dcgid int, message_index int, n int").json(str(tmp_path / "m"))
    got = drained(memory(service.in_order(stream), "ordered", tmp_path), spark, "ordered", 3)
    assert [r["message_index"] for r in got] == [0, 1, 2]
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.json").write_text("\n".join(json.dumps({"dataset": d, "frame": k, "n_images": 3}) for d, ks in (("x", (0, 1, 1, 2)), ("y", (0, 1))) for k in ks))
    frames = spark.readStream.schema("dataset string, frame int, n_images int").json(str(tmp_path / "f"))
    got = drained(memory(service.completeness(frames, 600_000), "complete", tmp_path), spark, "complete", 1)
    assert [(r["dataset"], r["seen"], r["status"]) for r in got] == [("x", 3, "complete")]


def test_stills_of_a_stream(spark, still_spots, tmp_path):
    (tmp_path / "s").mkdir()
    still_spots.assign(id=range(len(still_spots)))[["dataset", "frame", "id", "x", "y"]].to_json(tmp_path / "s" / "a.json", orient="records", lines=True)
    cells = spark.createDataFrame([("a", f, 1, setting(a)) for f, a in ((0, 0.3), (1, 0.8))], "dataset string, frame int, candidate int, setting array<double>")
    stream = spark.readStream.schema("dataset string, frame int, id long, x double, y double").json(str(tmp_path / "s"))
    work = lambda part: stills.index_stills(part, cells, panel=PANEL, wavelength=1.0, s0=S0)[0].select("dataset", "frame", "n_indexed")
    query = service.per_batch(stream, work, str(tmp_path / "out"), str(tmp_path / "ck"))
    query.processAllAvailable()
    query.stop()
    assert sorted(r["frame"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 1]


def test_frame_files_to_spots(spark, tmp_path):
    """Two named data sets read from frame directories, with masks, to three-dimensional spots."""
    rng = np.random.default_rng(0)
    sets = {}
    for name, (h, w) in (("run1", (40, 50)), ("run2", (64, 30))):
        path = tmp_path / name
        path.mkdir()
        (path / "start_1").write_text(json.dumps({"y_pixels_in_detector": h, "x_pixels_in_detector": w, "bit_depth_image": 16}))
        mask = np.zeros((h, w), "<i4")
        mask[:, 20] = 1
        (path / "start_5").write_bytes(mask.tobytes())
        for k in range(3):
            image = rng.poisson(1.0, (h, w)).astype("<u2")
            image[10:12, 9:12] = 200 + k
            image[30, 20] = 999  # masked
            (path / f"image_{k:06d}_2").write_bytes(image.tobytes())
        sets[name] = R.read_frames(spark, str(path), "directory", dataset=name)
    frames = sets["run1"].union(sets["run2"])
    strong = T.strong_pixels_dense(frames).where("value >= 100")
    found = S.measured(S.labelled(S.with_slices(strong), across_frames=True)).orderBy("dataset").collect()
    assert [(r["dataset"], r["n_px"], r["depth"], r["x_min"], r["x_max"], r["y_min"], r["y_max"], r["peak_value"]) for r in found] == [(d, 18, 3, 9, 11, 10, 11, 202) for d in ("run1", "run2")]
    boxes = S.boxes_2d(S.labelled(S.with_slices(strong), across_frames=False)).collect()
    assert len(boxes) == 6 and {r["n_px"] for r in boxes} == {6}


def test_frame_index_reads_no_pixels(spark, tmp_path):
    """Announced, written, half-written and unannounced frames; the listing alone is scanned."""
    (tmp_path / "start_1").write_text(json.dumps({"y_pixels_in_detector": 4, "x_pixels_in_detector": 5, "bit_depth_image": 16, "nimages": 2, "ntrigger": 2, "wavelength": 0.98, "omega_start": 0.0, "omega_increment": 0.1}))
    for k, size in ((0, 40), (1, 12), (7, 40)):
        (tmp_path / f"image_{k:06d}_2").write_bytes(bytes(size))
    (tmp_path / "image_000002_1").write_bytes(b"header of a frame")
    index = R.frame_index(spark, str(tmp_path), dataset="d")
    got = {r["frame"]: r for r in index.collect()}
    assert {f: (r["available"], r["bytes"]) for f, r in got.items()} == {0: (True, 40), 1: (False, 12), 2: (False, None), 3: (False, None), 7: (True, 40)}
    assert (got[0]["n_images"], got[0]["h"], got[0]["w"], got[0]["wavelength"], got[0]["osc_width"], got[0]["beam_x"]) == (4, 4, 5, 0.98, 0.1, None) and got[0]["modified"] is not None
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and "length" in plan
    assert S.routed(index.select("dataset", "frame"), index.select("dataset", "osc_width")).where("turning").count() == 5


def test_many_data_sets_are_kept_apart(spark):
    rows = [(d, 0, 5, 5, 9) for d in (0, 65_536, 1 << 40)]
    strong = spark.createDataFrame(rows, "dataset long, frame int, y int, x int, value long")
    assert S.labelled(S.with_slices(strong), across_frames=True).select("spot").distinct().count() == 3


def test_more_data_sets_than_two_to_the_fifteenth(spark):
    strong = spark.range((1 << 15) + 1).select(F.col("id").alias("dataset"), F.lit(0).alias("frame"), F.lit(5).alias("y"), F.lit(5).alias("x"), F.lit(9).cast("long").alias("value"))
    assert S.labelled(S.with_slices(strong), across_frames=False).select("spot").distinct().count() == (1 << 15) + 1


def test_text_header_frames(spark, tmp_path):
    values = np.array([[1, 2, 300], [-1, 70_000, 5]], np.int64)
    data, last = b"", 0
    for v in values.ravel().tolist():
        d, last = v - last, v
        data += d.to_bytes(1, "little", signed=True) if abs(d) < 128 else b"\x80" + d.to_bytes(2, "little", signed=True) if abs(d) < 1 << 15 else b"\x80\x00\x80" + d.to_bytes(4, "little", signed=True)
    (tmp_path / "x_0007.cbf").write_bytes(b"X-Binary-Size-Fastest-Dimension: 3\r\nX-Binary-Size-Second-Dimension: 2\r\n\r\n" + R._MARKER + data)
    row = R.read_frames(spark, str(tmp_path), "cbf", dataset="d").first()
    assert (row["dataset"], row["frame"], row["h"], row["w"], row["data"]) == ("d", 7, 2, 3, values.ravel().tolist()) and row["valid"] == [True, True, True, False, True, True]


def test_experiments(spark, tmp_path):
    panel = {"fast_axis": [1, 0, 0], "slow_axis": [0, -1, 0], "origin": [-10.0, 20.0, -150.0], "pixel_size": [0.1, 0.1], "image_size": [200, 400], "thickness": 0.45, "mu": 3.9}
    models = {"experiment": [{"identifier": "e0", "beam": 0, "detector": 0, "goniometer": None, "scan": 0, "crystal": 0}, {"identifier": "e1", "beam": 0, "detector": 0}], "beam": [{"direction": [0, 0, 1], "wavelength": 0.98}], "detector": [{"panels": [panel]}], "goniometer": [], "scan": [{"image_range": [1, 2], "properties": {"oscillation": [0.0, 0.1]}}], "crystal": [{"real_space_a": [1, 0, 0], "real_space_b": [0, 1, 0], "real_space_c": [0, 0, 1], "A_at_scan_points": [[float(k)] * 9 for k in range(3)]}]}
    (tmp_path / "e.json").write_text(json.dumps(models))
    rows = tables.read_experiments(spark, str(tmp_path / "e.json"))
    geometry = {r["identifier"]: r for r in tables.still_geometry(rows).collect()}
    assert geometry["e0"]["distance"] == 150 and geometry["e1"]["beam_x"] == pytest.approx(100) and geometry["e0"]["beam_y"] == pytest.approx(200)
    assert all(r["s0"] is None and r["setting"] is None for r in tables.scan_points(rows).collect())
    assert [(r["identifier"], r["pt"], r["a"][0]) for r in tables.scan_points(rows).orderBy("pt").collect()] == [("e0", k, float(k)) for k in range(3)]


def test_crystals_of_stills_make_a_round_trip(spark, tmp_path):
    frames = spark.createDataFrame([("d", 4, setting(0.3)), ("d", 9, setting(0.8)), ("d", 11, setting(0.1))], "dataset string, frame int, setting array<double>")
    names = spark.createDataFrame([("d", 4, "e4"), ("d", 9, "e9"), ("d", 5, "e5")], "dataset string, frame int, identifier string")
    found = tables.crystal_list(frames, names)
    found.write.json(str(tmp_path / "crystals"))
    again = tables.read_crystals(spark, str(tmp_path / "crystals"))
    want, got = (sorted(map(tuple, t.collect())) for t in (found, again))
    assert got == want and [(r[0], r[1]) for r in got] == [("e4", 0), ("e9", 1)]
    assert np.array([r[2:5] for r in got]) == pytest.approx(np.array([np.linalg.inv(np.reshape(setting(a), (3, 3))) for a in (0.3, 0.8)]))
    old = {"real_space_a": [1.0, 0, 0], "real_space_b": [0, 1.0, 0], "real_space_c": [0, 0, 1.0], "space_group_hall_symbol": "old"}
    (tmp_path / "e.json").write_text(json.dumps({"experiment": [{"identifier": "e4"}, {"identifier": "e5", "crystal": 0}, {"identifier": "e9", "crystal": 0}], "crystal": [old]}))
    rows = tables.with_crystals(tables.read_experiments(spark, str(tmp_path / "e.json")), again)
    after = {r["identifier"]: r["crystal"] for r in rows.collect()}
    assert after["e5"]["real_space_a"] == [1, 0, 0] and after["e5"]["space_group_hall_symbol"] == "old"
    assert all(after[i]["real_space_a"] == g[2] and after[i]["space_group_hall_symbol"] == " P 1" and after[i]["A_at_scan_points"] is None for i, g in (("e4", got[0]), ("e9", got[1])))


def test_error_function(spark):
    from math import erf

    xs = [-6.0, -3.1, -2.5, -1.0, -1e-3, 0.0, 0.3, 2.4999, 2.5001, 5.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(G.erf(F.col("x")).alias("e")).collect()
    assert [r["e"] for r in got] == pytest.approx([erf(x) for x in xs], abs=1e-10)


def test_resolution_steps_end_at_the_data():
    assert I.resolution_steps(4.0, 2.0) == pytest.approx([3.6, 3.2, 2.8, 2.4, 2.0]) and I.resolution_steps(4.0, 2.0, 1) == [2.0]
