"""Candidates to refined models, against known truth; exact selection against sorting."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brillouin.functions.lattice import cell, reindexings
from brillouin.operators import indexing as I
from brillouin.operators import refine as L
from brillouin.operators import rotation as R
from brillouin.operators import select
from brillouin.operators.select import five_number_quartiles, least_rows

REAL = {0: np.array([[40.0, 1, 0], [0, 50, 2], [1, 0, 60]]), 1: np.array([[31.0, 2, 1], [-1, 44, 0], [0, 3, 71]])}


def truth(dataset=0, s0=(0, 0, -1.0), distance=200.0):
    return L.Model.of(np.linalg.inv(REAL[dataset]), s0=np.array(s0), axis=np.array([1.0, 0, 0]), fast=np.array([1.0, 0, 0]), slow=np.array([0, -1.0, 0]), origin=np.array([-150.0, 150, -distance]), centre=np.array((150.0, 150.0)))


def observations(m, n=600, seed=0, reach=12):
    rng = np.random.default_rng(seed)
    rows = pd.DataFrame(np.unique(rng.integers(-reach, reach + 1, (n, 3)), axis=0), columns=["h", "k", "l"])
    rows = rows[(rows != 0).any(axis=1)]
    rows["entering"] = rng.random(len(rows)) < 0.5
    rows["x_mm"] = rows["y_mm"] = rows["phi"] = 0.0
    seen = m.predicted(rows)
    rows[["x_mm", "y_mm", "phi"]] = seen
    return rows[np.isfinite(seen).all(1) & (np.abs(seen[:, :2]) < 500).all(1)].reset_index(drop=True)


def disturbed(m, turn=0.3, stretch=1.001, distance=0.5):
    return L.replace(m, orientation=L._turn(np.array([1.0, 2, 3]), np.radians(turn)) @ m.orientation, shape=m.shape * stretch, origin=m.origin + np.array([0, 0, -distance]))


def frames(spark, truths, jitter=0.0):
    rng = np.random.default_rng(5)
    spots = pd.concat([observations(m, seed=d).assign(dataset=d) for d, m in truths.items()], ignore_index=True)
    spots["id"], spots["overloaded"] = np.arange(len(spots)), False
    spots[["x_mm", "y_mm"]] += jitter * rng.normal(size=(len(spots), 2))
    return spots, spark.createDataFrame(spots[["dataset", "id", "x_mm", "y_mm", "phi", "overloaded"]])


def geometry(spark, models, width=360.0):
    return spark.createDataFrame([(d, m.array().tolist(), width) for d, m in models.items()], "dataset long, model array<double>, width double")


def test_models_are_arrays_and_back():
    m = truth(1)
    assert np.allclose(L.Model.of_array(m.array()).setting, m.setting) and np.allclose(m.at(m.parameters()).setting, m.setting)


def test_gradients_are_differences_of_predictions():
    m = truth()
    rows, p = observations(m, 40), m.parameters()
    g = L.gradients(m, p, rows, tuple(range(18)))
    for k in (0, 3, 8, 12, 17):
        step = np.zeros(18)
        step[k] = 1e-4
        assert np.allclose(m.at(p + step).predicted(rows) - m.at(p).predicted(rows), g[:, :, k] * 1e-4, atol=1e-6)


def test_all_models_are_fitted_together(spark, monkeypatch):
    monkeypatch.setattr(L, "STATES", 2)  # the join without a broadcast too
    truths = {(d, c): disturbed(truth(d), 0.02 * c, 1 + 1e-4 * c, 0.1 * c) for d in (0, 1) for c in (0, 1, 2)}
    rows = pd.concat([observations(m, 400, d).assign(dataset=d, candidate=c) for (d, c), m in truths.items()])
    models = spark.createDataFrame([(d, c, truth(d).array().tolist()) for d, c in truths] + [(9, 0, truth().array().tolist())], "dataset long, candidate long, model array<double>")
    got = {(r["dataset"], r["candidate"]): r for r in L.fitted(spark.createDataFrame(rows), models, ["dataset", "candidate"], rounds=12).collect()}
    assert got[9, 0]["n"] == 0 and got[9, 0]["rmsd_xy"] is None and np.allclose(got[9, 0]["setting"], truth().setting.ravel())
    for key, m in truths.items():
        assert got[key]["rmsd_xy"] < 1e-4 and got[key]["n"] == len(rows[(rows["dataset"] == key[0]) & (rows["candidate"] == key[1])])
        assert cell(np.linalg.inv(np.reshape(got[key]["setting"], (3, 3)))) == pytest.approx(cell(np.linalg.inv(m.setting)), rel=1e-4)
    assert L.fitted(spark.createDataFrame(rows), models.limit(0), ["dataset", "candidate"]).count() == 0


def test_a_lattice_doubled_twice_comes_back(spark):
    truths = {0: truth(0), 1: truth(1)}
    _, spots = frames(spark, truths)
    seen = R.reciprocal_spots(spots, geometry(spark, truths))
    large = lambda d, *axes: np.linalg.inv(np.diag(axes) @ REAL[d]).ravel().tolist()
    given = [(0, 1, large(0, 1, 1, 1)), (0, 2, large(0, 2, 1, 1)), (0, 3, large(0, 2, 1, 2)), (1, 1, large(1, 4, 1, 1)), (1, 2, large(1, 3, 1, 2)), (7, 1, large(0, 2, 1, 1))]
    got = R.primitive_settings(seen, spark.createDataFrame(given, "dataset long, candidate long, setting array<double>"))
    rows = {(r["dataset"], r["candidate"]): r for r in got.collect()}
    for (d, _), r in rows.items():
        if d != 7:
            assert 1 / abs(np.linalg.det(np.reshape(r["setting"], (3, 3)))) == pytest.approx(abs(np.linalg.det(REAL[d])), rel=1e-6)
            assert r["n_indexed"] > 0.95 * r["n"]
    assert rows[7, 1]["n"] == 0 and len(rows) == len(given)
    again = R.absence_patterns(R.indexed(seen, got.where("dataset <> 7").select(*R.KEY, "setting"), R.KEY), R.KEY)
    assert again.where("pattern IS NOT NULL").count() == 0 and again.count() == 5


def test_patterns_in_one_aggregation_are_those_of_shares(spark):
    rows = spark.createDataFrame([(0, 1, 2 * h, k, k + 3 * m) for h in range(1, 5) for k in range(4) for m in range(3)] + [(0, 2, h, h * h, 1) for h in range(9)] + [(0, 3, 0, 0, 0)], "dataset int, candidate int, h int, k int, l int")
    patterns = spark.createDataFrame([(n, *map(int, v), m) for n, (v, m, _) in enumerate(reindexings())], "pattern int, u int, v int, w int, m int")
    want = {r["candidate"]: r["pattern"] for r in I.detected_pattern(I.residue_counts(rows, R.KEY, patterns), R.KEY).collect()}
    got = {r["candidate"]: r["pattern"] for r in R.absence_patterns(rows, R.KEY).collect()}
    assert got == {1: want[1], 2: want.get(2), 3: None} and want[1] is not None


def test_candidates_are_assigned_corrected_refined_and_ranked(spark):
    truths = {0: truth(0), 1: truth(1)}
    spots, frame = frames(spark, truths, 0.01)
    given = []
    for d in truths:
        near = disturbed(truths[d], 0.05, 1.0005, 0).setting
        given += [(d, 1, np.linalg.inv(REAL[d] @ L._turn(np.array([1.0, 1, 0]), 0.4)).ravel().tolist()), (d, 2, near.ravel().tolist()), (d, 3, np.linalg.inv(np.diag([2.0, 1, 1]) @ np.linalg.inv(near)).ravel().tolist())]
    got = R.evaluated_candidates(frame, spark.createDataFrame(given, "dataset long, candidate long, setting array<double>"), geometry(spark, truths)).toPandas()
    assert len(got) == 6
    for d in truths:
        rows = got[got["dataset"] == d].set_index("candidate")
        assert rows["rank"].idxmin() in (2, 3) and rows.loc[1, "rank"] == 3
        for c in (2, 3):  # the doubled one has come down to the same cell
            assert rows.loc[c, "fraction"] > 0.95 and rows.loc[c, "rmsd"] < 0.02 and rows.loc[c, "n_indexed"] > 0.95 * (spots["dataset"] == d).sum()
            assert rows.loc[c, "volume"] == pytest.approx(abs(np.linalg.det(REAL[d])), rel=2e-3)
    assert got["rank"].notna().all()


def test_cycles_recover_the_models_and_go_on_after_a_failure(spark):
    truths = {0: truth(0), 1: truth(1)}
    _, frame = frames(spark, truths)
    start = geometry(spark, {d: disturbed(m) for d, m in truths.items()}).drop("width")
    limits = spark.createDataFrame([(0, 6.0, 2.0, 0.0, 10.0), (1, 7.0, 3.0, 0.0, 360.0)], "dataset long, start double, end double, osc_start double, width double")
    tables = R.macro_cycles(frame.repartition(3), start, limits, cycles=2)
    end = {r["dataset"]: r for r in tables[-1].collect()}
    for d, m in truths.items():
        assert end[d]["rmsd_xy"] < 1e-3 and cell(np.linalg.inv(np.reshape(end[d]["setting"], (3, 3)))) == pytest.approx(cell(np.linalg.inv(m.setting)), rel=2e-3)
    again = {r["dataset"]: r for r in R.macro_cycles(frame, tables[0], limits, cycles=2, done=1)[-1].collect()}
    for d in truths:
        assert np.allclose(again[d]["model"], end[d]["model"], atol=1e-6) and again[d]["n"] == end[d]["n"]


@pytest.mark.parametrize("small,buckets", [(10_000, 4096), (3, 4)])
def test_quartiles_without_a_sort(spark, monkeypatch, small, buckets):
    monkeypatch.setattr(select, "SMALL", small)
    monkeypatch.setattr(select, "BUCKETS", buckets)
    rng = np.random.default_rng(6)
    groups = {"a": rng.normal(size=101), "b": np.repeat([1.0, 2.0], 30), "c": [5.0], "d": [1e300, -1e300, 0, 5e-324, 0, 0], "e": rng.integers(0, 4, 50) * 1e-320, None: [3.0, 1.0], "f": [float("nan")]}
    rows = [(g, float(x)) for g, values in groups.items() for x in values] + [("a", None)]
    got = {r["g"]: (r["q1"], r["q3"]) for r in five_number_quartiles(spark.createDataFrame(rows, "g string, x double").repartition(5), ["g"], ["x"]).collect()}
    for g, values in groups.items():
        if g != "f":
            v, half = sorted(map(float, values)), (len(values) + 1) // 2
            assert got[g] == pytest.approx((np.median(v[:half]), np.median(v[len(v) // 2 :])), rel=1e-15, abs=0)
    assert "f" not in got


def test_outliers_set_and_clear_flags(spark):
    outlier, used = 1 << 17, 1 << 3
    rows = [(k % 2, float(x), 0.0, 1 | outlier) for k, x in enumerate([*range(22), 500])] + [(0, 1.0, None, 1), (0, 1.0, 0.0, 4)]
    got = I.without_outliers(spark.createDataFrame(rows, "dataset int, dx double, dy double, flags long"), ["dataset"], ["dx", "dy"], flags="flags").collect()
    assert len(got) == 22 and {r["flags"] for r in got} == {1 | used}


def test_samples_do_not_rank_whole_groups(spark):
    rows = spark.createDataFrame([(k % 3, k) for k in range(5000)], "dataset long, id long")
    got = I.sampled(rows, "id", 2, 5.0, least=40).groupBy("dataset").agg(F.collect_set("id").alias("ids")).collect()
    import hashlib

    for r in got:
        assert set(r["ids"]) == set(sorted(range(r["dataset"], 5000, 3), key=lambda k: hashlib.md5(f"43:{k}".encode()).hexdigest())[:40])
    assert least_rows(rows, ["dataset"], [F.col("id")], F.lit(7)).agg(F.max("id")).first()[0] == 20


def test_gradients_predict_no_row_again(monkeypatch):
    import numpy as np
    import pandas as pd

    from brillouin.operators.refine import N, Model, gradients

    rng = np.random.default_rng(3)
    rows = pd.DataFrame({c: rng.integers(-9, 10, 200).astype(float) for c in "hkl"}).assign(x_mm=0.0, y_mm=0.0, phi=rng.uniform(0, 6, 200), entering=rng.random(200) < 0.5)
    base = Model.of(np.linalg.inv(np.array([[40.0, 1, 0], [0, 50, 2], [1, 0, 60]])), s0=np.array([0.01, 0.02, -1.0]), axis=np.array([1.0, 0, 0]), fast=np.array([1.0, 0, 0]), slow=np.array([0, -1.0, 0]), origin=np.array([-150.0, 150, -200]), centre=(150.0, 150.0))
    p = base.parameters() + np.where(np.isin(np.arange(N), (2, *range(6, 12))), 0, 0.3)
    middle = base.at(p)._met(rows)
    speed = np.abs(np.cross(base.axis, middle[2] - base.at(p).s0) @ base.at(p).s0)
    rows = rows[np.isfinite(base.at(p).residuals(rows)).all(1) & (speed > 0.02)]
    want = np.zeros((len(rows), 3, N))
    for k in range(N):
        step = np.zeros(N)
        step[k] = 1e-6 if k == 2 else 1e-4
        want[:, :, k] = (base.at(p + step).predicted(rows) - base.at(p - step).predicted(rows)) / (2 * step[k])
    monkeypatch.setattr(Model, "predicted", None)
    got = gradients(base, p, rows, tuple(range(N)))
    assert len(rows) > 50 and (np.abs(got - want) <= 1e-4 * np.abs(want).max(0) + 1e-9).all()


def test_contests_of_many_indices_are_those_of_one(spark):
    import numpy as np

    from brillouin.operators import indexing as I

    rng = np.random.default_rng(4)
    rows = [(1, i, float(rng.uniform(0, 6)), *(3 * [int(k)]), float(d) / 9) for i, (k, d) in enumerate(zip(rng.integers(1, 9, 300), rng.integers(0, 9, 300), strict=True))] + [(1, 300, None, 1, 1, 1, 0.0), (1, 301, 1.0, 0, 0, 0, None)]
    given = spark.createDataFrame(rows, "dataset int, id long, phi double, h int, k int, l int, lsq double").repartition(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # runs go on in the next batch
        plan = I.settle_duplicates(given, ["dataset"])
        got = {r["id"]: r for r in plan.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(got) == 302 and "FlatMapGroups" not in plan._jdf.queryExecution().toString()
    for k in range(1, 9):
        own = [r for r in rows if r[3] == k]
        keep = I.contest(*(np.array([r[c] for r in own], float) for c in (1, 2, 6)))
        assert [got[r[1]]["h"] == k for r in own] == keep.tolist() == [got[r[1]]["lsq"] is not None for r in own]
    assert got[301]["lsq"] is None
