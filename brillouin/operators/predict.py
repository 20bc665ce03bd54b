"""Predicted reflections: Miller indices that can cross the Ewald sphere, the rays they give, where those meet the detector.

Everything is column expressions; the indices of an image come from three nested `explode(sequence)`, each cut to the
range in which the index can diffract.
"""

from __future__ import annotations

from math import pi

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import vec as V
from ..plans.scratch import written

HKL = ("h", "k", "l")


def _point(setting, h: Column, k: Column, l: Column) -> V.Vec:  # noqa: E741
    return V.apply(setting, (h.cast("double"), k.cast("double"), l.cast("double")))


def _range(low: Column, high: Column) -> Column:
    """Sequence of whole numbers, empty where low > high or a bound is null."""
    return F.when(low <= high, F.sequence(low.cast("int"), high.cast("int"))).otherwise(F.array().cast("array<int>"))


#: Bounds are widened by this before they are rounded: an index on a sphere is in.
EDGE = 1e-9


def _roots(rows: DataFrame, n: str, a: Column, b: Column, c: Column) -> DataFrame:
    """Adds __p and __q + n, the roots of a x^2 + 2 b x + c; null where it has none."""
    rows = V.with_step(rows, {f"__a{n}": a, f"__b{n}": b, f"__c{n}": c})
    d = F.col(f"__b{n}") * F.col(f"__b{n}") - F.col(f"__a{n}") * F.col(f"__c{n}")
    rows = V.with_step(rows, {f"__d{n}": F.when(d >= 0, F.sqrt(d))})
    rows = V.with_step(rows, {f"__p{n}": (-F.col(f"__b{n}") - F.col(f"__d{n}")) / F.col(f"__a{n}"), f"__q{n}": (-F.col(f"__b{n}") + F.col(f"__d{n}")) / F.col(f"__a{n}")})
    return rows.drop(*(f"__{x}{n}" for x in "abcd"))


def _whole(low: Column, high: Column, margin: int) -> Column:
    return _range(F.ceil(low - EDGE) - margin, F.floor(high + EDGE) + margin)


def absent(h: Column, k: Column, l: Column, operations: Column) -> Column:  # noqa: E741
    """Is some operation (r, t) such that h R = h and h . t is not whole? `operations` is an array of structs."""
    same = lambda o: (h * o["r"][0] + k * o["r"][3] + l * o["r"][6] == h) & (h * o["r"][1] + k * o["r"][4] + l * o["r"][7] == k) & (h * o["r"][2] + k * o["r"][5] + l * o["r"][8] == l)
    phase = lambda o: h * o["t"][0] + k * o["t"][1] + l * o["t"][2]
    return F.exists(operations, lambda o: same(o) & (F.abs(phase(o) - F.round(phase(o))) > 1e-6))


def candidate_indices(images: DataFrame, a1: str, a2: str, s0_1: str, s0_2: str, dmin: Column | float, *, margin: int = 0, operations: DataFrame | None = None) -> DataFrame:
    """A row for each image and index within dmin that lies inside just one of the image's two Ewald spheres, and for up to `margin` indices beside those along l.

    The h of an image are those whose plane meets the resolution sphere and an Ewald sphere, the k of an h those whose line along l does, both from the roots of a quadratic form;
    the l lie between the points where that line enters, and leaves, the two spheres. Indices that `operations` (see `without_absences`) make absent never become rows.
    """
    limit = dmin if isinstance(dmin, Column) else F.lit(float(dmin))
    rows = images.withColumns({"__r2": 1 / (limit * limit)})
    spheres = (("0", a1, None), ("1", a1, s0_1), ("2", a2, s0_2))
    made = ["__r2"]
    for n, setting, beam in spheres:
        # the three reciprocal axes, those of h and k and the sphere's centre without their part along l, and the plane's normal
        m = V.entries(F.col(setting))
        c = (m[2], m[5], m[8])
        real = tuple(F.col(f"__n{n}{x}") for x in "xyz")
        rows = V.with_step(rows, {f"__n{n}{x}": v for x, v in zip("xyz", V.real_space(F.col(setting))[0], strict=True)} | {f"__e{n}": V.norm2(c)})
        off = lambda v: V.sub(v, V.scale(c, V.dot(v, c) / F.col(f"__e{n}")))  # noqa: B023, E731
        parts = {f"__u{n}": off((m[0], m[3], m[6])), f"__v{n}": off((m[1], m[4], m[7]))} | ({f"__w{n}": off(V.parts(F.col(beam)))} if beam else {})
        size = V.norm(real)
        reach = V.norm(V.parts(F.col(beam))) if beam else 1 / limit
        middle = -V.dot(real, V.parts(F.col(beam))) if beam else F.lit(0.0)
        rows = rows.withColumns({name: V.vector(*v) for name, v in parts.items()} | {f"__low{n}": middle - size * reach, f"__high{n}": middle + size * reach})
        made += [*parts, f"__low{n}", f"__high{n}"]
    rows = written(rows.drop(*(f"__{x}{n}" if x == "e" else f"__n{n}{x}" for x in "exyz" for n in "012")))  # a row an image: what follows is not worked out from the matrices again and again
    low, high = F.greatest("__low0", F.least("__low1", "__low2")), F.least("__high0", F.greatest("__high1", "__high2"))
    rows = rows.withColumn("h", F.explode(_whole(low, high, margin)))
    h = F.col("h").cast("double")
    for n, _, beam in spheres:
        u, v = V.parts(F.col(f"__u{n}")), V.parts(F.col(f"__v{n}"))
        base = V.scale(u, h) if beam is None else V.add(V.scale(u, h), V.parts(F.col(f"__w{n}")))
        rows = _roots(rows, n, V.norm2(v), V.dot(v, base), V.norm2(base) - (F.col("__r2") if beam is None else V.norm2(V.parts(F.col(beam)))))
    # null where the plane misses a sphere: least and greatest pass over it
    rows = rows.where(F.col("__p0").isNotNull() & (F.col("__p1").isNotNull() | F.col("__p2").isNotNull()))
    rows = rows.withColumn("k", F.explode(_whole(F.greatest("__p0", F.least("__p1", "__p2")), F.least("__q0", F.greatest("__q1", "__q2")), margin))).drop(*(f"__{x}{n}" for x in "pq" for n in "012"), *(c for c in made if c != "__r2"))
    for n, setting, beam in spheres:
        m = V.entries(F.col(setting))
        step, base = (m[2], m[5], m[8]), _point(F.col(setting), F.col("h"), F.col("k"), F.lit(0))
        if beam is None:
            rows = _roots(rows, n, V.norm2(step), V.dot(step, base), V.norm2(base) - F.col("__r2"))
        else:
            s0 = V.parts(F.col(beam))
            rows = _roots(rows, n, V.norm2(step), V.dot(step, V.add(base, s0)), V.norm2(base) + 2 * V.dot(s0, base))
    rows = rows.where(F.col("__p0").isNotNull() & (F.col("__p1").isNotNull() | F.col("__p2").isNotNull()))
    single = F.col("__p1").isNull() | F.col("__p2").isNull()
    # a line that meets one sphere only is inside it from its entry to its exit
    entry = _range(F.greatest(F.ceil(F.col("__p0") - EDGE), F.ceil(F.least("__p1", "__p2") - EDGE) - margin), F.least(F.floor(F.col("__q0") + EDGE), F.floor(F.when(single, F.coalesce("__q1", "__q2")).otherwise(F.greatest("__p1", "__p2")) + EDGE) + margin))
    leave = _range(F.greatest(F.ceil(F.col("__p0") - EDGE), F.ceil(F.least("__q1", "__q2") - EDGE) - margin), F.least(F.floor(F.col("__q0") + EDGE), F.floor(F.greatest("__q1", "__q2") + EDGE) + margin))
    found = F.array_union(entry, leave)
    if operations is not None:
        rows = rows.join(F.broadcast(operations.agg(F.collect_list(F.struct("r", "t")).alias("__ops"))), how="cross")
        found = F.filter(found, lambda l: ~absent(F.col("h"), F.col("k"), l, F.col("__ops")))  # noqa: E741
    rows = rows.withColumn("l", F.explode(found)).drop("__r2", "__ops", *(f"__{x}{n}" for x in "pq" for n in "012"))
    return rows.where((F.col("h") != 0) | (F.col("k") != 0) | (F.col("l") != 0))


def without_absences(rows: DataFrame, operations: DataFrame) -> DataFrame:
    """Leaves out indices that an operation keeps but shifts by a fraction of a wave. `operations` (a space group's, 192 at most): r (nine whole numbers), t (three doubles).

    A row is absent if some operation has h R = h and h . t not whole.
    """
    ops = F.broadcast(operations.agg(F.collect_list(F.struct("r", "t")).alias("__ops")))
    return rows.join(ops, how="cross").where(~absent(*(F.col(c) for c in HKL), F.col("__ops"))).drop("__ops")


def with_scan_points(images: DataFrame, points: DataFrame, static: dict[str, Column]) -> DataFrame:
    """Adds the models at an image's start and end, such as a1, a2, s0_1, s0_2: for each model the static one where a dataset has none for both.

    `points`: dataset, pt and a model for each boundary of images, in columns a, s0 or setting. `static` names the columns to add.
    """
    w = Window.partitionBy("dataset").orderBy("pt")
    at = lambda model, side: f"{model}{side}" if model == "a" else f"{model}_{side}"
    models = [m for m in ("a", "s0", "setting") if m in points.columns and at(m, 1) in static]
    ends = [c for m in models for c in (F.col(m).alias(at(m, 1)), F.lead(m).over(w).alias(at(m, 2)))]
    rows = images.join(points.select("dataset", F.col("pt").alias("image"), *ends), ["dataset", "image"], "left")
    varying = {at(m, k): F.when(F.col(at(m, 1)).isNotNull() & F.col(at(m, 2)).isNotNull(), F.col(at(m, k))).otherwise(static[at(m, k)]) for m in models for k in (1, 2)}
    return rows.withColumns({c: varying.get(c, x) for c, x in static.items()})


def usable_scan_points(points: DataFrame, datasets: DataFrame) -> DataFrame:
    """Points of the datasets that have n_images + 1 of them; other datasets fall back to their static model."""
    n = points.groupBy("dataset").agg(F.count(F.lit(1)).alias("__n"))
    good = n.join(datasets.select("dataset", "n_images"), "dataset").where(F.col("__n") == F.col("n_images") + 1)
    return points.join(good.select("dataset"), "dataset", "left_semi")


def setting_at(fixed, rotation_axis, angle: Column, setting, a) -> list[Column]:
    """Setting matrix on the goniometer at an angle: S R(angle) F A."""
    turned = V.multiply(fixed, a)
    columns = [V.rotate((turned[k], turned[3 + k], turned[6 + k]), rotation_axis, angle) for k in range(3)]
    return V.multiply(setting, [columns[c][r] for r in range(3) for c in range(3)])


def rotation_rays(rows: DataFrame, dmin, phi_begin: Column, width: Column) -> DataFrame:
    """Rays of indices that cross the sphere while the models go from (a1, s0_1) to (a2, s0_2): adds s1, phi, entering.

    Each step has its own columns, so no expression is worked out more than once.
    """
    h = [F.col(c) for c in HKL]
    rows = V.with_step(rows, {"__r1": V.vector(*_point(F.col("a1"), *h)), "__r2": V.vector(*_point(F.col("a2"), *h))})
    r1, r2, b1, b2 = (F.col(c) for c in ("__r1", "__r2", "s0_1", "s0_2"))
    rows = V.with_step(rows, {"__step": V.vector(*V.sub(r2, r1)), "__f1": V.vector(*V.add(b1, r1)), "__f2": V.vector(*V.add(b2, r2)), "__n": V.norm2(r1)})
    step = F.col("__step")
    rows = V.with_step(rows, {"entering": V.norm(F.col("__f1")) >= V.norm(b1), "__out": V.norm(F.col("__f2")) >= V.norm(b2), "__a": V.norm2(step)})
    # a x^2 + 2 b x + c at the start, going on, and at the end, going back
    rows = V.with_step(rows, {"__b1": V.dot(F.col("__f1"), step), "__c1": F.col("__n") + 2 * V.dot(b1, r1), "__b2": -V.dot(F.col("__f2"), step), "__c2": V.norm2(r2) + 2 * V.dot(b2, r2)})
    rows = rows.where((F.col("entering") != F.col("__out")) & (F.col("__n") * dmin * dmin <= 1))
    for k in "12":
        d = F.col(f"__b{k}") * F.col(f"__b{k}") - F.col("__a") * F.col(f"__c{k}")
        rows = V.with_step(rows, {f"__d{k}": F.when(d >= 0, F.sqrt(d))})
        rows = V.with_step(rows, {f"__low{k}": F.try_divide(-F.col(f"__b{k}") - F.col(f"__d{k}"), "__a"), f"__high{k}": F.try_divide(-F.col(f"__b{k}") + F.col(f"__d{k}"), "__a")})
        rows = V.with_step(rows, {f"__x{k}": F.when(F.col(f"__low{k}").between(0, 1), F.col(f"__low{k}")).when(F.col(f"__high{k}").between(0, 1), F.col(f"__high{k}"))})
    rows = V.with_step(rows, {"__alpha": F.try_divide("__x1", F.col("__x1") + F.col("__x2"))})
    alpha, u1 = F.col("__alpha"), V.unit(b1)
    beam = V.scale(V.add(u1, V.scale(V.sub(V.unit(b2), u1), alpha)), (V.norm(b1) + V.norm(b2)) / 2)
    rows = V.with_step(rows, {"s1": V.vector(*V.add(V.add(r1, V.scale(step, alpha)), beam)), "phi": phi_begin + alpha * width})
    return rows.where(F.col("__alpha").isNotNull()).drop(*(c for c in rows.columns if c in {"__r1", "__r2", "__step", "__f1", "__f2", "__n", "__out", "__a", "__alpha"} or c[:-1] in {"__b", "__c", "__d", "__low", "__high", "__x"}))


def static_rays(rows: DataFrame, setting, s0, axis, dmin, phi_begin: Column, width: Column) -> DataFrame:
    """Rays of a still model turned about an axis: up to two for each index and turn, with phi in [phi_begin, phi_begin + width)."""
    r = _point(setting, *(F.col(c) for c in HKL))
    along = V.dot(r, axis)
    across = V.sub(r, V.scale(axis, along))
    side = V.cross(axis, across)
    # |s0 + r(phi)| = |s0|: p cos(phi) + q sin(phi) = t
    p, q = V.dot(s0, across), V.dot(s0, side)
    t = -(V.norm2(r) / 2 + V.dot(s0, axis) * along)
    size = F.hypot(p, q)
    spread = F.acos(F.when(F.abs(t) <= size, F.try_divide(t, size)))
    middle = F.atan2(q, p)
    rows = rows.where(V.norm2(r) * dmin * dmin <= 1).withColumn("__phi", F.explode(F.array(middle - spread, middle + spread)))
    turn = F.pmod(F.col("__phi") - phi_begin, F.lit(2 * pi)) + phi_begin
    rows = rows.withColumn("phi", turn).drop("__phi").where(F.col("phi") < phi_begin + width)
    s1 = V.add(V.rotate(r, axis, F.col("phi")), s0)
    return rows.withColumn("s1", V.vector(*s1)).withColumn("entering", G.entering(F.col("s1"), s0, axis))


def stills_rays(rows: DataFrame, setting, s0, dmin, tolerance: float, *, compat: bool = False) -> DataFrame:
    """Rays of a still: indices within dmin whose distance from the sphere is at most `tolerance` (`compat`: beyond it, as older results have it)."""
    r = _point(setting, *(F.col(c) for c in HKL))
    s1 = V.add(r, s0)
    far = F.abs(V.norm(s1) - V.norm(s0)) > tolerance
    rows = rows.where((V.norm2(r) * dmin * dmin <= 1) & (far if compat else ~far))
    return rows.withColumn("s1", V.vector(*V.scale(V.unit(s1), V.norm(s0))))


def polychromatic_rays(rows: DataFrame, setting, beam, lambda_min, lambda_max, dmin) -> DataFrame:
    """Rays of a still in a band of wavelengths: the wavenumber that puts the index on the sphere, if it lies in the band."""
    r = _point(setting, *(F.col(c) for c in HKL))
    u = V.unit(beam)
    wavenumber = F.try_divide(-V.norm2(r), 2 * V.dot(u, r))
    rows = rows.withColumn("wavelength", F.try_divide(F.lit(1.0), wavenumber)).where((V.norm2(r) * dmin * dmin <= 1) & F.col("wavelength").between(lambda_min, lambda_max))
    return rows.withColumn("s1", V.vector(*V.add(r, V.scale(u, wavenumber))))


def stills_indices(frames: DataFrame, setting: str, s0: str, dmin, tolerance: float) -> DataFrame:
    """Indices of a still between the shells |s0| - tolerance and |s0| + tolerance: their rays are those of `stills_rays`."""
    shells = {k: V.vector(*V.scale(F.col(s0), 1 + sign * tolerance / V.norm(F.col(s0)))) for k, sign in (("__s1", -1), ("__s2", 1))}
    rows = candidate_indices(frames.withColumns(shells), setting, setting, "__s1", "__s2", dmin, margin=1).drop("__s1", "__s2")
    return stills_rays(rows, F.col(setting), V.parts(F.col(s0)), dmin, tolerance)


def on_detector(rays: DataFrame, panel: dict, osc_start=None, osc_width=None, image_start: int = 1) -> DataFrame:
    """Rays that meet the panel: adds x_mm, y_mm, x_px, y_px, and z from phi (radians) if there is a scan.

    `panel`: fast, slow, origin, px, size (pixels), and mu, thickness of its sensor if it has one.
    """
    x, y = G.ray_on_panel(V.parts(F.col("s1")), panel["fast"], panel["slow"], panel["origin"])
    px, size = panel["px"], panel["size"]
    rows = rays.withColumns({"x_mm": x, "y_mm": y}).where(G.on_panel(F.col("x_mm"), F.col("y_mm"), px[0] * size[0], px[1] * size[1]))
    x, y = G.mm_to_px(F.col("x_mm"), F.col("y_mm"), *px, panel.get("mu"), panel.get("thickness"), panel["fast"], panel["slow"], panel["origin"])
    rows = rows.withColumns({"x_px": x, "y_px": y})
    if osc_width is None:
        return rows
    return rows.withColumn("z_px", image_start - 1 + (F.degrees("phi") - osc_start) / osc_width)


def rotation_scan(datasets: DataFrame, axis, setting, dmin: float, panel: dict, *, buffer: int = 0, points: DataFrame | None = None, fixed=None, operations: DataFrame | None = None) -> DataFrame:
    """Predictions of rotation scans. `datasets`: dataset, a (setting matrix at phi 0), s0, n_images, image_start, osc_start, osc_width (degrees).

    `points` has scan-varying a, s0 and setting at the boundaries of images; `buffer` images are added at each end of static scans; `setting` and `fixed`
    are the goniometer's matrices outside and inside the turn (None: the identity); indices that `operations` make absent are not predicted.
    """
    images = datasets.withColumn("image", F.explode(F.sequence(F.lit(-buffer), F.col("n_images") - 1 + buffer)))
    begin, width = F.radians(F.col("osc_start") + F.col("image") * F.col("osc_width")), F.radians("osc_width")
    identity = [F.lit(float(k % 4 == 0)) for k in range(9)]
    outside = V.matrix(V.entries(setting or identity))
    static = {"a1": F.col("a"), "a2": F.col("a"), "s0_1": F.col("s0"), "s0_2": F.col("s0"), "setting_1": outside, "setting_2": outside}
    rows = images.withColumns(static) if points is None else with_scan_points(images, usable_scan_points(points, datasets), static)
    turned = {f"a{k}": V.matrix(setting_at(fixed or identity, axis, begin + (width if k == 2 else 0), F.col(f"setting_{k}"), F.col(f"a{k}"))) for k in (1, 2)}
    # a row for each image, written once: the matrices are not worked out again for every index
    rows = written(rows.withColumns(turned).withColumns({"__begin": begin, "__width": width}).drop("setting_1", "setting_2"))
    begin, width = F.col("__begin"), F.col("__width")
    # each step is a table of its own: in one plan the expressions of all steps would be inlined into each other
    found = written(rotation_rays(written(candidate_indices(rows, "a1", "a2", "s0_1", "s0_2", dmin, operations=operations)), dmin, begin, width))
    found = found.withColumn("flags", F.lit(1).cast("long"))
    placed = on_detector(found, panel, F.col("osc_start"), F.col("osc_width"), 1)
    return placed.drop("a1", "a2", "s0_1", "s0_2", "a", "__begin", "__width")


def repredicted(rows: DataFrame, setting, s0, axis) -> DataFrame:
    """Rays of known indices on a rotating crystal: of the two solutions that of the observed `entering`, at the turn nearest `phi_obs`."""
    # steps of their own: nothing is worked out twice, and no expression grows with the ones before it
    steps = G.Steps(rows)
    steps.vector("r", _point(setting, *(F.col(c) for c in HKL)))
    r = steps.of("r")
    steps.scalars(along=V.dot(r, axis))
    steps.vector("across", V.sub(r, V.scale(axis, F.col("__along"))))
    across = steps.of("across")
    steps.scalars(p=V.dot(s0, across), q=V.dot(s0, V.cross(axis, across)), t=-(V.norm2(r) / 2 + V.dot(s0, axis) * F.col("__along")))
    steps.scalars(size=F.hypot(F.col("__p"), F.col("__q")), middle=F.atan2(F.col("__q"), F.col("__p")))
    steps.scalars(spread=F.acos(F.when(F.abs(F.col("__t")) <= F.col("__size"), F.try_divide(F.col("__t"), F.col("__size")))))
    for name, side in (("one", -1), ("two", 1)):
        steps.vector(name, V.add(V.rotate(r, axis, F.col("__middle") + side * F.col("__spread")), s0))
    rays = [steps.of("one"), steps.of("two")]
    steps.scalars(first=G.entering(rays[0], s0, axis) == F.col("entering"))
    steps.scalars(phi=F.when(F.col("__first"), F.col("__middle") - F.col("__spread")).otherwise(F.col("__middle") + F.col("__spread")))
    near = F.col("phi_obs") + F.pmod(F.col("__phi") - F.col("phi_obs") + pi, F.lit(2 * pi)) - pi
    s1 = F.when(F.col("__first"), V.vector(*rays[0])).otherwise(V.vector(*rays[1]))
    return steps.done(phi_cal=near, s1=F.when(F.col("__spread").isNotNull(), s1))


def repredicted_stills(rows: DataFrame, setting, s0) -> DataFrame:
    """Rays of known indices on a still: the point turned onto the sphere the shortest way, and `delpsi`, the angle of that turn."""
    q = _point(setting, *(F.col(c) for c in HKL))
    s = V.norm(s0)
    down = V.norm2(q) / (2 * s)
    foot = V.scale(V.unit(s0), -down)
    side = V.sub(q, V.scale(V.unit(s0), V.dot(q, V.unit(s0))))
    height = F.sqrt(F.when(V.norm2(q) - down * down >= 0, V.norm2(q) - down * down))
    on_sphere = V.add(foot, V.scale(V.unit(side), height))
    # signed by the side on which q lies
    turn = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), V.dot(q, on_sphere) / V.norm2(q))))
    sign = F.when(V.norm(V.add(q, s0)) > s, -1.0).otherwise(1.0)
    return rows.withColumns({"s1": V.vector(*V.add(on_sphere, s0)), "delpsi": sign * turn})
