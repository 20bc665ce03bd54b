import numpy as np
import pytest
from pyspark.sql import functions as F

from brillouin.functions import vec as V
from brillouin.functions.lattice import cell, niggli, reduced_candidate, reindexings, with_basis
from brillouin.operators import indexing as I
from brillouin.operators import predict as P
from brillouin.operators.select import five_number_quartiles
from brillouin.sources.tables import scan_points

PANEL = {"fast": (0.9999343565703017, 0.008972928699089156, 0.007125243918478585), "slow": (0.009011312015482328, -0.9999449607587793, -0.005373240073119384), "origin": (-154.36992588196173, 164.3947680648576, -198.15267891180412), "px": (0.075, 0.075), "size": (4148, 4362), "mu": 3.9219876752936167, "thickness": 0.45}
WAVELENGTH = 0.9762458439949315
REAL = np.array([[-18.3617922001806, -1.3985262449809124, -54.866705726818], [-32.09880690850544, 47.2184015325075, 9.47764074028691], [115.77476247140888, 86.89078795711316, -40.81230881268615]])
AT_ENDS = [[-0.005459727201059019, -0.00957881993314865, 0.005117309749372354, -0.00042498931737436986, 0.014098506559502566, 0.0038416886950916533, -0.016390331545472165, 0.002844169681824414, -0.0018112274387013555], [-0.005459734253117143, -0.009578815538092726, 0.005117308300437957, -0.00042498758360674213, 0.014098504268823347, 0.003841688575830816, -0.01639033413246863, 0.002844172984156842, -0.001811225938788269]]


def scan(spark):
    d = np.array([-0.0034229667619783467, 0.0, 0.999994141632113])
    s0 = -d / np.linalg.norm(d) / WAVELENGTH
    return spark.createDataFrame([(0, np.linalg.inv(REAL).ravel().tolist(), tuple(map(float, s0)), 1, 0.0, 0.1)], "dataset int, a array<double>, s0 struct<x: double, y: double, z: double>, n_images int, osc_start double, osc_width double")


@pytest.mark.parametrize("varying,n,places", [
    (False, 464, {(-28, 14, 93): (3937.314, 91.352, 0.649), (-26, 14, 90): (3769.996, 214.530, 0.341), (-14, -30, -11): (2979.930, 3628.805, 0.877)}),
    (True, 451, {(-28, 14, 93): (3937.727, 90.932, 0.782), (-26, 14, 90): (3770.352, 214.153, 0.473), (-14, -30, -11): (2980.114, 3628.977, 0.943)}),
])
def test_rotation_scan(spark, varying, n, places):
    sets = scan(spark)
    points = None
    if varying:
        s0 = sets.first()["s0"]
        points = spark.createDataFrame([(0, k, a, s0) for k, a in enumerate(AT_ENDS)], "dataset int, pt int, a array<double>, s0 struct<x: double, y: double, z: double>")
    got = P.rotation_scan(sets, V.parts((1, 0, 0)), None, WAVELENGTH / 2, PANEL, points=points).toPandas()
    assert len(got) == n and not got.duplicated(["h", "k", "l"]).any()
    for hkl, (x, y, z) in places.items():
        row = got[(got["h"] == hkl[0]) & (got["k"] == hkl[1]) & (got["l"] == hkl[2])].iloc[0]
        assert (row["x_px"], row["y_px"], row["z_px"]) == pytest.approx((x, y, z), abs=1e-2)


def test_scan_points_of_each_model_stand_alone(spark):
    lists = {"identifier": ["e0", "e1", "e2"], "a": [[[1.0] * 9] * 3, [[1.0] * 9] * 2, []], "s0": [[[0.0, 0.0, float(k)] for k in range(3)], [[1.0, 2.0, 3.0]] * 3, []], "setting": [[], [[2.0] * 9] * 3, []]}
    rows = spark.createDataFrame(list(zip(*lists.values(), strict=True)), "identifier string, a array<array<double>>, s0 array<array<double>>, setting array<array<double>>")
    one = lambda name, value: F.struct(value.alias(name))
    experiments = rows.select("identifier", F.struct(F.array(F.lit(1), F.lit(2)).alias("image_range")).alias("scan"), one("A_at_scan_points", F.col("a")).alias("crystal"), one("s0_at_scan_points", F.col("s0")).alias("beam"), one("setting_rotation_at_scan_points", F.col("setting")).alias("goniometer"))
    points = scan_points(experiments)
    assert sorted((r["identifier"], r["pt"], r["a"] and r["a"][0], r["s0"] and r["s0"]["z"], r["setting"] and r["setting"][0]) for r in points.collect()) == [("e0", 0, 1, 0, None), ("e0", 1, 1, 1, None), ("e0", 2, 1, 2, None), ("e1", 0, None, 3, 2), ("e1", 1, None, 3, 2), ("e1", 2, None, 3, 2)]
    static = {"a1": F.lit("a"), "a2": F.lit("a"), "s0_1": F.lit(-1.0), "s0_2": F.lit(-1.0), "setting_1": F.lit("s"), "setting_2": F.lit("s")}
    flat = points.select(F.col("identifier").alias("dataset"), "pt", F.col("a")[0].cast("string").alias("a"), F.col("s0.z").alias("s0"), F.col("setting")[0].cast("string").alias("setting"))
    images = spark.createDataFrame([(d, k) for d in ("e0", "e1", "e2") for k in (0, 1)], "dataset string, image int")
    got = sorted(tuple(r) for r in P.with_scan_points(images, flat, static).select("dataset", "image", *static).collect())
    assert got == [("e0", k, "1.0", "1.0", k, k + 1, "s", "s") for k in (0, 1)] + [("e1", k, "a", "a", 3, 3, "2.0", "2.0") for k in (0, 1)] + [("e2", k, "a", "a", -1, -1, "s", "s") for k in (0, 1)]


def test_settings_of_a_scan_turn_the_crystal_outside(spark):
    turn = np.array([[0.0, -1, 0], [1, 0, 0], [0, 0, 1]]) @ np.array([[1, 0, 0], [0, 0.6, -0.8], [0, 0.8, 0.6]])
    sets = scan(spark)
    at = spark.createDataFrame([(0, k, None, None, turn.ravel().tolist()) for k in (0, 1)], "dataset int, pt int, a array<double>, s0 struct<x: double, y: double, z: double>, setting array<double>")
    asked = lambda **more: {(r["h"], r["k"], r["l"]): (round(r["x_px"], 6), round(r["z_px"], 6)) for r in P.rotation_scan(sets, V.parts((1, 0, 0)), more.pop("setting", None), 1.2, PANEL, **more).collect()}
    want = asked(setting=[F.lit(float(x)) for x in turn.ravel()])
    assert asked(points=at) == want and len(want) > 10 and asked() != want


def test_indices_are_those_of_a_brute_search(spark):
    """All indices of a cube, tried one by one: within dmin, and inside one Ewald sphere only."""
    rng = np.random.default_rng(2)
    rows, want = [], set()
    for n in range(6):
        a = np.linalg.inv(rng.normal(size=(3, 3)) * 3 + np.diag([14.0, 17.0, 21.0]))
        turn = 0.06 * rng.normal(size=3)
        b = (np.eye(3) + np.array([[0, -turn[2], turn[1]], [turn[2], 0, -turn[0]], [-turn[1], turn[0], 0]])) @ a
        s = [np.array([0.02 * n, -0.03, -1 / (1 + 0.1 * n)]) * f for f in (1, 1 + 1e-3 * (n % 2))]
        rows.append((n, a.ravel().tolist(), b.ravel().tolist(), *(dict(zip("xyz", map(float, v))) for v in s)))
        h = np.stack(np.meshgrid(*[np.arange(-16, 17)] * 3, indexing="ij"), -1).reshape(-1, 3)
        r1, r2 = h @ a.T, h @ b.T
        inside = [((r + v) ** 2).sum(1) < (v * v).sum() for r, v in ((r1, s[0]), (r2, s[1]))]
        hit = (inside[0] != inside[1]) & ((r1 * r1).sum(1) <= 1 / 1.7**2) & h.any(1)
        want |= {(n, *map(int, x)) for x in h[hit]}
    frame = spark.createDataFrame(rows, "n int, a1 array<double>, a2 array<double>, b1 struct<x: double, y: double, z: double>, b2 struct<x: double, y: double, z: double>")
    got = P.candidate_indices(frame, "a1", "a2", "b1", "b2", 1.7)
    found = {(r["n"], r["h"], r["k"], r["l"]) for r in got.select("n", "h", "k", "l").collect()}
    assert len(want) > 300 and want <= found and len(found) < 1.1 * len(want)
    ops = spark.createDataFrame([([1, 0, 0, 0, 1, 0, 0, 0, 1], [0.0, 0.0, 0.0]), ([1, 0, 0, 0, 1, 0, 0, 0, 1], [0.5, 0.5, 0.0]), ([-1, 0, 0, 0, 1, 0, 0, 0, -1], [0.0, 0.5, 0.0])], "r array<int>, t array<double>")
    absent = lambda h, k, l: (h + k) % 2 or (h == l == 0 and k % 2)  # noqa: E731, E741
    left = P.candidate_indices(frame, "a1", "a2", "b1", "b2", 1.7, operations=ops)
    assert {(r["n"], r["h"], r["k"], r["l"]) for r in left.collect()} == {x for x in found if not absent(*x[1:])} == {(r["n"], r["h"], r["k"], r["l"]) for r in P.without_absences(got, ops).collect()}


def test_assignment(spark):
    a = [-0.0134, -0.0227, -0.0009, -0.0053, 0.0030, -0.0140, 0.0203, -0.0098, -0.0036]
    points = [(-0.20806554291174043, -0.20006695964877577, 0.46900930253991086, 2.325651228282444), (-0.20711023322729, -0.1844213770514764, 0.47299170443928473, 2.360557813322331), (-0.24784778679168532, -0.10882416182889978, 0.47089025552307, 2.5612706773016787), (-0.20693750699327926, -0.1837374215284657, 0.4732856446956432, 4.620759194654988), (-0.24768402495471797, -0.11030902243741092, 0.4706897967841226, 4.751658888554562), (-0.565, 0.15, 0.027, 0.013)]
    rows = spark.createDataFrame([(k, 0, *p) for k, p in enumerate(points)], "id int, dataset int, x double, y double, z double, phi double")
    got = I.settle_duplicates(I.with_indices(rows, (F.col("x"), F.col("y"), F.col("z")), a, 0.2), ["dataset"]).orderBy("id").collect()
    assert [(r["h"], r["k"], r["l"]) for r in got] == [(22, -4, 5), (22, -4, 4), (22, -2, -1), (22, -4, 4), (22, -2, -1), (0, 0, 0)]
    assert I.indexed_fraction(spark.createDataFrame(got), ["dataset"]).first()["n_indexed"] == 5


def test_contest_in_row_order():
    rng = np.random.default_rng(4)
    for _ in range(50):
        n = rng.integers(2, 12)
        phi, lsq = rng.uniform(0, 3, n), rng.integers(0, 5, n) / 10
        alive = [True] * n
        for i in range(n):
            for j in range(i + 1, n):
                if alive[i] and alive[j] and abs(phi[i] - phi[j]) <= I.CLOSE_PHI:
                    alive[i if lsq[j] < lsq[i] else j] = False
        assert I.contest(np.arange(n), phi, lsq).tolist() == alive


def test_grid_cells(spark):
    rows = spark.createDataFrame([(0, 1, -0.2, 0.2, 0.25), (1, 1, -0.2, 0.1, 0.1)], "id int, dataset int, x double, y double, z double")
    cells = lambda *a: {r["cell"]: r["weight"] for r in I.grid_cells(rows, ["dataset"], (F.col("x"), F.col("y"), F.col("z")), *a).collect()}
    assert cells(2.0, 0.0, 64) == {80294: 1.0, 80752: 1.0}
    assert cells(2.0, 10.0, 64) == {80294: pytest.approx(0.86070797642505781), 80752: pytest.approx(0.70029752396813894)}
    assert cells(4.0, 10.0, 64) == {27501: pytest.approx(0.86070797642505781)}


@pytest.mark.parametrize("com,size,want", [
    ([[0.75] * 3, [0.1] * 3, [0.4] * 3], [8, 10, 10], [25.6, 102.4, -64.0]), ([[0.75] * 3, [0.1] * 3, [0.4] * 3], [8, 11, 10], [25.6, -64.0]), ([[0.75] * 3, [0.6] * 3, [0.405] * 3], [8, 10, 10], [-103.04, -64.0]),
])
def test_peak_vectors(com, size, want):
    v, _ = I.peak_vectors(np.array(com), np.array(size), 2, 3, 100)
    assert np.allclose(v, np.repeat(np.array(want)[:, None], 3, 1))


def test_candidates(spark):
    rows = spark.createDataFrame([(0, k, *map(float, v), 1) for k, v in enumerate([(10, 0, 0), (10, 1, 0), (0, 2.5, 0), (0, 0, 50)])], "dataset int, rank long, x double, y double, z double, volume long")
    got = I.candidate_lattices(rows, 10).orderBy("candidate").collect()
    cells = [cell(np.linalg.inv(np.array(r["setting"]).reshape(3, 3))) for r in got]
    assert np.allclose(cells, [(2.5, 10, 50, 90, 90, 90), (2.5, 10.0499, 50, 90, 90, 95.7106)], atol=1e-4)


def test_reduction():
    rng = np.random.default_rng(1)
    for _ in range(40):
        a = rng.normal(size=(3, 3)) * rng.uniform(3, 30, 3)[:, None]
        r = niggli(a)
        g = r @ r.T
        assert np.allclose(np.round(r @ np.linalg.inv(a)), r @ np.linalg.inv(a), atol=1e-6) and np.linalg.det(r) * np.linalg.det(a) > 0
        assert g[0, 0] <= g[1, 1] + 1e-6 <= g[2, 2] + 2e-6 and 2 * abs(g[1, 2]) <= g[1, 1] + 1e-6 and 2 * abs(g[0, 2]) <= g[0, 0] + 1e-6 and 2 * abs(g[0, 1]) <= g[0, 0] + 1e-6
        signs = [g[1, 2], g[0, 2], g[0, 1]]
        assert all(s > -1e-6 for s in signs) or all(s <= 1e-6 for s in signs)
    assert reduced_candidate(np.array([1.0, 0, 0]), np.array([2.0, 0.1, 0]), np.array([0, 0, 1.0])) is None


def test_absences(spark):
    doubled = np.linalg.inv(np.diag([20.0, 30.0, 40.0]))
    rows = spark.createDataFrame([(0, 2 * h, k, l) for h in range(1, 5) for k in range(4) for l in range(4)], "dataset int, h int, k int, l int")
    table = reindexings()
    patterns = spark.createDataFrame([(n, *map(int, v), m) for n, (v, m, _) in enumerate(table)], "pattern int, u int, v int, w int, m int")
    found = I.detected_pattern(I.residue_counts(rows, ["dataset"], patterns), ["dataset"]).first()["pattern"]
    assert table[found][:2] == ((1, 0, 0), 2)
    assert sorted(cell(np.linalg.inv(with_basis(doubled, table[found][2])))[:3]) == pytest.approx([10, 30, 40])


def test_scores_and_outliers(spark):
    rows = spark.createDataFrame([(0, 1, 2.0, 0.5, 100.0), (0, 2, 1.0, 0.5, 100.0), (0, 3, 1.0, 0.25, 400.0)], "dataset int, candidate int, rmsd double, fraction double, volume double")
    assert [(r["candidate"], r["score"]) for r in I.scored(rows, ["dataset"]).orderBy("rank").collect()] == [(2, 0.0), (1, 1.0), (3, 3.0)]
    assert I.best(rows, ["dataset"]).first()["candidate"] == 2
    values = spark.createDataFrame([(0, float(v)) for v in [*range(11), 500]], "dataset int, dx double")
    assert I.without_outliers(values, ["dataset"], ["dx"]).count() == 11
    q = five_number_quartiles(values, ["dataset"], ["dx"]).first()
    assert (q["q1"], q["q3"]) == (2.5, 8.5)


def test_transform_finds_the_period(spark):
    # points of a cubic lattice of 20 along x only
    rows = spark.createDataFrame([(k, 0, k / 20.0 - 0.2, 0.0, 0.0) for k in range(9)], "id int, dataset int, x double, y double, z double")
    cells = I.grid_cells(rows, ["dataset"], (F.col("x"), F.col("y"), F.col("z")), 2.0, 0.0, 32)
    power = I.power_map(cells, ["dataset"], 32, 3.0).toPandas()
    assert len(power) and (power["power"] > 0).all()


def test_contest_of_runs_is_that_of_all_rows(spark):
    rng = np.random.default_rng(8)
    rows = [(k, 0, float(p), float(q), 1, 2, 3) for k, (p, q) in enumerate(zip(rng.uniform(0, 12, 60), rng.integers(0, 9, 60) / 10, strict=True))]
    frame = spark.createDataFrame(rows, "id int, dataset int, phi double, lsq double, h int, k int, l int").repartition(3)
    got = {r["id"]: r["lsq"] is not None for r in I.settle_duplicates(frame, ["dataset"]).collect()}
    want = I.contest(*(np.array([r[c] for r in rows]) for c in (0, 2, 3)))
    assert [got[k] for k in range(60)] == want.tolist() and 3 < sum(got.values()) < 40


def test_steps_of_rays_are_not_copied_into_each_other(spark):
    vector = "struct<x: double, y: double, z: double>"
    rows = spark.createDataFrame([], f"a1 array<double>, a2 array<double>, s0_1 {vector}, s0_2 {vector}, image int, h int, k int, l int")
    filters = [n for n in P.rotation_rays(rows, 2.0, F.col("image") * 0.1, F.lit(0.1))._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in n]
    assert max(map(len, filters), default=0) < 2000


def test_voids_over_slabs_are_those_of_one(spark, monkeypatch):
    import numpy as np

    from brillouin.operators import indexing as I

    rng = np.random.default_rng(6)
    cells = spark.createDataFrame([(d, int(c)) for d in (None, 1, 2) for c in rng.choice(216, 70, replace=False)], "dataset int, cell long")
    whole = I.voids(cells, 6)
    assert "Join" not in whole._jdf.queryExecution().toString()
    monkeypatch.setattr(I, "SLAB", 72)
    key = lambda r: tuple((v is not None, v or 0) for v in r)
    assert sorted(map(key, I.voids(cells, 6).collect())) == sorted(map(key, whole.collect()))
