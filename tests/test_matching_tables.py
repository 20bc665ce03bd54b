"""Matching within a tolerance, reflection tables, voids of named datasets."""

from math import log2

import numpy as np
import pytest
from pyspark.sql import functions as F

from brillouin.operators import indexing as I
from brillouin.operators.matching import matched_within, nearest_within
from brillouin.sources import tables as R

ROW = "h int, id string, s1 struct<x: double, y: double, z: double>"


def test_rows_pair_as_a_greedy_search_pairs_them(spark):
    rng = np.random.default_rng(5)
    xyz = lambda v: tuple(map(float, v))
    left = [(int(rng.integers(0, 3)), f"a{k:03d}", xyz(rng.integers(-6, 7, 3) / 4)) for k in range(160)]  # on a grid: many equal distances
    right = [(h, f"b{159 - k:03d}", xyz(np.array(v) + rng.integers(-1, 2, 3) / 16)) for k, (h, _, v) in enumerate(left)]
    rng.shuffle(right := [tuple(r) for r in right])
    extra = [(None, "a900", (0.0, 0.0, 0.0)), (1, "a901", None), (1, "a902", (0.0, None, 0.0)), (7, "a903", (0.0, 0.0, 0.0))]
    right = [(int(h), str(i), tuple(map(float, v))) for h, i, v in right]
    near = sorted((float(np.linalg.norm(np.subtract(v, w))), a, b, h) for h, a, v in left for g, b, w in right if g == h and np.linalg.norm(np.subtract(v, w)) <= 0.3)
    want, used = set(), set()
    for d, a, b, h in near:
        if not {a, b} & used:
            used |= {a, b}
            want.add((h, a, b, round(d, 12)))
    got = matched_within(spark.createDataFrame(left + extra, ROW).repartition(3), spark.createDataFrame([*right, (None, "b900", (0.0, 0.0, 0.0))], ROW).withColumnRenamed("id", "id_right"), ["h"], "s1", 0.3)
    assert {(r["h"], r["id"], r["id_right"], round(r["distance"], 12)) for r in got.collect()} == want and len(want) > 100
    assert matched_within(spark.createDataFrame([], ROW), spark.createDataFrame(right, ROW).withColumnRenamed("id", "id_right"), ["h"], "s1", 0.3).count() == 0


def test_missing_columns_have_types(spark, tmp_path):
    spark.createDataFrame([(1, 2.0)], "id int, d double").write.parquet(str(tmp_path / "in"))
    rows = R.read_reflections(spark, str(tmp_path / "in"), "d", "s1", "flags", "score float")
    assert dict(rows.dtypes) == {"id": "int", "d": "double", "s1": "struct<x:double,y:double,z:double>", "flags": "bigint", "score": "float"}
    rows.write.parquet(str(tmp_path / "out"))
    with pytest.raises(ValueError):
        R.read_reflections(spark, str(tmp_path / "in"), "unheard")


def test_frames_are_numbered_not_rows(spark):
    rows = spark.createDataFrame([("a", 5), ("a", 5), ("a", 9), ("b", 7), (None, 1)], "dataset string, frame int")
    assert sorted(map(tuple, R.with_stills_ids(rows).collect()), key=str) == [("a", 5, 0), ("a", 5, 0), ("a", 9, 1), ("b", 7, 0), (None, 1, 0)]


def test_voids_of_named_datasets(spark):
    cells = [("run1", c) for c in (0, 1, 4, 100)] + [("run2", c) for c in (0, 20, 12)]
    got = I.voids(spark.createDataFrame(cells, "dataset string, cell long"), 5)
    assert {(r["dataset"], r["void"], r["size"]) for r in got.select("dataset", F.col("void").cast("long").alias("void"), "size").collect()} == {("run1", 0, 4), ("run2", 0, 2), ("run2", 12, 1)}


def test_tables_with_fixed_columns(spark, tmp_path):
    xyz = "struct<x: double, y: double, z: double>"
    rays = spark.createDataFrame([("run1", 7, 1, 0, 2, True, (0.0, 0.1, -1.0), 10.0, 20.0, 3.5, 1.0, 2.0, 0.1), ("run1", 8, 0, 0, 0, False, (0.1, 0.0, -1.0), 11.0, 21.0, 4.5, 1.1, 2.1, 0.2)], f"dataset string, n int, h int, k int, l int, entering boolean, s1 {xyz}, x_px double, y_px double, z_px double, x_mm double, y_mm double, phi double")
    predicted = R.predicted_table(rays, id=F.col("n"))
    assert tuple(predicted.columns) == R.PREDICTED and dict(predicted.dtypes)["id"] == "bigint" and {r["flags"] for r in predicted.collect()} == {R.FLAG["predicted"]}
    with pytest.raises(ValueError, match="id"):
        R.predicted_table(rays)
    sums = spark.createDataFrame([(7, "run1", 50.0, 60.0, 0.9, 1.5, 10.4, 20.6, 3.4, 40, 5, 80, 2.0)], "refl_id int, dataset string, intensity double, variance double, partiality double, lp double, x_obs double, y_obs double, z_obs double, n_bg long, n_fg long, bg_sum long, mean double")
    out = R.integrated_table(sums, predicted, (40, 50, 60, 90, 90, 90))
    R.write_reflections(out, str(tmp_path / "integrated"), R.INTEGRATED)
    (row,) = R.read_reflections(spark, str(tmp_path / "integrated")).collect()
    assert (row["id"], row["x_px"], row["flags"], row["bg_sum"], row["dataset"]) == (7, 10.4, R.FLAG["predicted"] | R.FLAG["integrated_sum"], 80.0, "run1")
    assert row["d"] == pytest.approx(1 / np.sqrt(1 / 40**2 + 4 / 60**2)) and row["s1"]["y"] == 0.1
    seen = rays.withColumns({"lsq": F.when(F.col("h") == 1, 0.01), "flags": F.lit(R.FLAG["indexed"] | R.FLAG["strong"]), "rlp": F.col("s1")})
    indexed = R.indexed_table(seen, id=F.col("n"))
    assert tuple(indexed.columns) == R.INDEXED and {r["id"]: r["flags"] for r in indexed.collect()} == {7: R.FLAG["indexed"] | R.FLAG["strong"], 8: R.FLAG["strong"]}


def test_a_fraction_of_a_size_is_exact(spark):
    sizes = spark.createDataFrame([(0, n, v) for n, v in enumerate([10, 30, 62, 63, 64, 90])], "dataset int, void int, size long")  # 0.7 * 90 is under 63 in doubles
    assert sorted(r["size"] for r in I.large_voids(sizes, ["dataset"], 0.7).collect()) == [64, 90]


def test_scores_have_the_bits_of_their_formula(spark):
    rows = [(n // 10, n, 25 + n % 7 / 9, 0.6 + n % 11 / 40, float(14000 + 37 * n)) for n in range(200)]
    got = {r["candidate"]: r["score"] for r in I.scored(spark.createDataFrame(rows, "dataset int, candidate int, rmsd double, fraction double, volume double"), ["dataset"], in_turn=True).collect()}
    for d, n, rmsd, fraction, volume in rows:
        mine = [r for r in rows if r[0] == d]
        assert got[n] == log2(rmsd) - min(log2(r[2]) for r in mine) + max(log2(r[3]) for r in mine) - log2(fraction) + log2(volume) - min(log2(r[4]) for r in mine)
    odd = I.scored(spark.createDataFrame([(0, 1, 1.0, 0.0, 2.0), (0, 2, 1.0, None, 2.0)], "dataset int, candidate int, rmsd double, fraction double, volume double"), ["dataset"])
    assert [(r["score"], r["rank"]) for r in odd.orderBy("candidate").collect()] == [(None, 1), (None, 2)]


def test_two_rows_can_have_one_nearest(spark):
    left = spark.createDataFrame([(1, "a1", (0.0, 0.0, 0.0)), (1, "a2", (0.1, 0.0, 0.0)), (1, "a3", (5.0, 0.0, 0.0)), (2, "a4", (0.0, 0.0, 0.0)), (None, "a5", (0.0, 0.0, 0.0)), (1, "a6", None)], ROW)
    right = spark.createDataFrame([(1, "b2", (0.05, 0.0, 0.0)), (1, "b1", (0.05, 0.0, 0.0)), (1, "b3", (0.3, 0.0, 0.0)), (None, "b4", (0.0, 0.0, 0.0))], ROW).withColumnRenamed("id", "id_right")
    got = nearest_within(left, right, ["h"], "s1", 0.25).collect()
    assert sorted((r["h"], r["id"], r["id_right"], round(r["distance"], 9)) for r in got) == [(1, "a1", "b1", 0.05), (1, "a2", "b1", 0.05)]
