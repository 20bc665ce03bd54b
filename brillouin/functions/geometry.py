"""Geometry of beam, detector, goniometer and scan as column expressions. Lengths in mm, wavelength in angstrom, angles in radians."""

from __future__ import annotations

from math import factorial, pi, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vec as V


def pixel_resolution(x: Column, y: Column, beam_x, beam_y, px_x, px_y, distance, wavelength) -> Column:
    """d of a pixel's centre from a flat detector across the beam; infinite in the beam centre (null there)."""
    r = F.hypot((x + 0.5 - beam_x) * px_x, (y + 0.5 - beam_y) * px_y)
    return F.when(r > 0, wavelength / (2 * F.sin(0.5 * F.atan(r / distance))))


def resolution_mask(valid: Column, d: Column, dmin: float = 0.0, dmax: float = 0.0) -> Column:
    """Valid pixels whose d lies in [dmin, dmax]; a bound of 0 is off, and the beam centre counts as d = infinity."""
    keep = valid
    if dmin > 0:
        keep = keep & F.coalesce(d >= dmin, F.lit(True))
    if dmax > 0:
        keep = keep & F.coalesce(d <= dmax, F.lit(False))
    return keep


def attenuation(cos_angle: Column, mu, thickness) -> Column:
    """Mean depth at which a ray is absorbed in a sensor."""
    path = thickness / cos_angle
    return 1 / mu - (path + 1 / mu) * F.exp(-mu * path)


def px_to_mm(px, py, px_x, px_y, mu=None, thickness=None, fast=None, slow=None, s1=None, cos_angle=None) -> tuple[Column, Column]:
    """Pixel to mm on the panel; with a sensor (mu, thickness), less the shift along the ray's projection."""
    x, y = px * px_x, py * px_y
    if mu is None:
        return x, y
    o = attenuation(cos_angle, mu, thickness)
    ray = V.unit(s1)
    return x - V.dot(ray, fast) * o, y - V.dot(ray, slow) * o


def mm_to_px(x_mm, y_mm, px_x, px_y, mu=None, thickness=None, fast=None, slow=None, origin=None) -> tuple[Column, Column]:
    """mm on the panel, where a ray from the crystal meets it, to the pixel that records the ray: with a sensor (mu, thickness) further along
    the ray's projection by the depth at which it is absorbed."""
    if mu is None:
        return x_mm / px_x, y_mm / px_y
    ray = V.unit(lab_point(x_mm, y_mm, fast, slow, origin))
    o = attenuation(F.abs(V.dot(ray, V.cross(V.parts(fast), V.parts(slow)))), mu, thickness)
    return (x_mm + V.dot(ray, fast) * o) / px_x, (y_mm + V.dot(ray, slow) * o) / px_y


def lab_point(x_mm: Column, y_mm: Column, fast, slow, origin) -> V.Vec:
    return V.add(V.add(V.scale(fast, x_mm), V.scale(slow, y_mm)), origin)


def diffracted(point, wavelength) -> V.Vec:
    """s1: the direction to a laboratory point, of length 1 / wavelength."""
    return V.scale(V.unit(point), 1 / wavelength if isinstance(wavelength, Column) else F.lit(1 / wavelength))


def rotation_angle(z: Column, image_start, osc_start, osc_width) -> Column:
    """phi in radians of a position in images; z counts from 0 at the first image of the array."""
    return F.radians((z + 1 - image_start) * osc_width + osc_start)


def reciprocal_point(s1, s0, axis, phi: Column, fixed=None, setting=None) -> V.Vec:
    """Reciprocal lattice point: F^-1 R(-phi) S^-1 (s1 - s0)."""
    r = V.sub(s1, s0)
    if setting is not None:
        r = V.apply(V.inverse(setting), r)
    r = V.rotate(r, axis, -phi)
    return r if fixed is None else V.apply(V.inverse(fixed), r)


def spot_rlp(x, y, z, *, fast, slow, origin, px, wavelength, s0, axis, image_start, osc_start, osc_width, mu=None, thickness=None, fixed=None, setting=None) -> tuple[V.Vec, V.Vec, tuple[Column, Column, Column]]:
    """rlp, s1 and (x mm, y mm, phi) of a spot in pixels and images."""
    flat = lab_point(x * px[0], y * px[1], fast, slow, origin)
    if mu is None:
        x_mm, y_mm = px_to_mm(x, y, *px)
    else:
        normal = V.cross(V.parts(fast), V.parts(slow))
        ray = V.unit(flat)
        x_mm, y_mm = px_to_mm(x, y, *px, mu, thickness, V.parts(fast), V.parts(slow), flat, F.abs(V.dot(ray, normal)))
    s1 = diffracted(lab_point(x_mm, y_mm, fast, slow, origin), wavelength)
    phi = rotation_angle(z, image_start, osc_start, osc_width)
    return reciprocal_point(s1, s0, axis, phi, fixed, setting), s1, (x_mm, y_mm, phi)


def kabsch(s, phi: Column, s1, s0, phi_c: Column, axis) -> tuple[Column, Column, Column, Column]:
    """e1, e2, e3 of the ray s at phi in the local frame of (s1, phi_c), and zeta."""
    e1 = V.unit(V.cross(s1, s0))
    e2 = V.unit(V.cross(s1, e1))
    length, delta = V.norm(s1), V.sub(s, s1)
    zeta = V.dot(V.unit(axis), e1)
    return V.dot(e1, delta) / length, V.dot(e2, delta) / length, zeta * (phi - phi_c), zeta


def zeta(s1, s0, axis) -> Column:
    return V.dot(V.unit(axis), V.unit(V.cross(s1, s0)))


def integrable(zeta: Column, min_zeta: float = 0.05) -> Column:
    """Reflections that do not lie along the rotation axis."""
    return F.coalesce(F.abs(zeta) >= min_zeta, F.lit(False))


def resolution_limit(asked: Column, wavelength: Column) -> Column:
    """The limit asked for, but not under half the wavelength, which is also what no request means."""
    return F.greatest(F.coalesce(asked, 0.5 * wavelength), 0.5 * wavelength)


def still_point(x, y, *, fast, slow, origin, px, wavelength, s0) -> tuple[V.Vec, V.Vec]:
    """Reciprocal lattice point and ray of a spot of a still: nothing is turned back."""
    s1 = diffracted(lab_point(x * px[0], y * px[1], fast, slow, origin), wavelength)
    return V.sub(s1, s0), s1


def variance_in_mm(var_x: Column, var_y: Column, var_z: Column, px, osc_width) -> tuple[Column, Column, Column]:
    """Variances in pixels and images as mm and radians: each by the square of its scale (no offset belongs to a variance)."""
    return var_x * px[0] ** 2, var_y * px[1] ** 2, var_z * F.radians(osc_width if isinstance(osc_width, Column) else F.lit(float(osc_width))) ** 2


def clamped_images(start: Column, end: Column, available: Column) -> tuple[Column, Column]:
    """First and last image (from 0) of a scan's image range (from 1), no further than the images there are."""
    return start - 1, F.least(end, available) - 1


def ray_on_panel(s1, fast, slow, origin) -> tuple[Column, Column]:
    """Where a ray meets the plane of a panel, in mm along fast and slow; null behind or beside it."""
    normal = V.cross(fast, slow)
    along = V.dot(s1, normal)
    t = F.when(V.dot(origin, normal) / along > 0, V.dot(origin, normal) / along)
    hit = V.sub(V.scale(s1, t), origin)
    return V.dot(hit, fast), V.dot(hit, slow)


def on_panel(x_mm, y_mm, width_mm, height_mm) -> Column:
    return F.coalesce((x_mm >= 0) & (x_mm <= width_mm) & (y_mm >= 0) & (y_mm <= height_mm), F.lit(False))


class Steps:
    """Working columns that are added to a table one step at a time, so that no expression holds the ones before it many times."""

    def __init__(self, rows: DataFrame):
        self.rows, self.made = rows, []

    def scalars(self, **columns: Column) -> None:
        self.rows = self.rows.withColumns({f"__{k}": c for k, c in columns.items()})
        self.made.extend(f"__{k}" for k in columns)

    def vector(self, name: str, value: V.Vec) -> None:
        self.scalars(**{f"{name}{c}": v for c, v in zip("xyz", value, strict=True)})

    def of(self, name: str) -> V.Vec:
        return tuple(F.col(f"__{name}{c}") for c in "xyz")

    def unit(self, name: str, value: V.Vec) -> None:
        """A vector of length 1 (null for the zero vector)."""
        self.vector(f"{name}_raw_", value)
        self.scalars(**{f"{name}_size": V.norm(self.of(f"{name}_raw_"))})
        self.vector(name, V.scale(self.of(f"{name}_raw_"), F.when(F.col(f"__{name}_size") > 0, 1 / F.col(f"__{name}_size"))))

    def done(self, **columns: Column) -> DataFrame:
        return self.rows.withColumns(columns).drop(*self.made)


def with_kabsch(rows: DataFrame, s, phi: Column, s1, phi_c: Column, s0, axis, names: tuple[str, str, str] = ("e1", "e2", "e3")) -> DataFrame:
    """`kabsch` as columns of a table, step by step."""
    steps = Steps(rows)
    steps.vector("s", s)
    steps.vector("c", s1)
    steps.unit("u", V.cross(steps.of("c"), s0))
    steps.unit("v", V.cross(steps.of("c"), steps.of("u")))
    steps.vector("d", V.sub(steps.of("s"), steps.of("c")))
    steps.scalars(length=V.norm(steps.of("c")), zeta=V.dot(V.unit(axis), steps.of("u")))
    values = (V.dot(steps.of("u"), steps.of("d")) / F.col("__length"), V.dot(steps.of("v"), steps.of("d")) / F.col("__length"), F.col("__zeta") * (phi - phi_c))
    return steps.done(**dict(zip(names, values, strict=True)))


def with_ray(rows: DataFrame, name: str, x: Column, y: Column, *, fast, slow, origin, px, wavelength) -> DataFrame:
    """Adds the columns name + x, y, z: the ray to a place in pixels on a panel without sensor."""
    steps = Steps(rows)
    steps.unit("p", lab_point(x * px[0], y * px[1], fast, slow, origin))
    return steps.done(**{f"{name}{c}": v / wavelength for c, v in zip("xyz", steps.of("p"), strict=True)})


BOX = ("x_min", "x_max", "y_min", "y_max", "z_min", "z_max")


def with_bounding_box(rows: DataFrame, s1: Column, phi: Column, s0, axis, delta_b, delta_m, *, fast, slow, origin, px, image_start, image_end, osc_start, osc_width) -> DataFrame:
    """Adds BOX, the pixels and images that a reflection reaches: the corners (+-delta_b, +-delta_b) on the sphere, phi +- delta_m / zeta.

    Every step has columns of its own: in one expression each would hold the ones before it many times.
    """
    steps = Steps(rows)
    step, vec_step, vector = steps.scalars, steps.vector, steps.of
    vec_step("s", V.parts(s1))
    vec_step("c", V.cross(vector("s"), s0))
    step(length=V.norm(vector("s")), across=V.norm(vector("c")))
    vec_step("u", V.scale(vector("c"), F.when(F.col("__across") > 0, 1 / F.col("__across"))))
    vec_step("w", V.cross(vector("s"), vector("u")))
    step(zeta=V.dot(V.unit(axis), vector("u")), deep=V.norm(vector("w")))
    corners = ((1, 1), (1, -1), (-1, 1), (-1, -1))
    length, reach = F.col("__length"), delta_b * F.col("__length")
    for n, (p, q) in enumerate(corners):
        vec_step(f"d{n}", V.add(V.scale(vector("u"), p * reach), V.scale(vector("w"), q * reach / F.col("__deep"))))
    for n in range(4):
        room = length * length - V.norm2(vector(f"d{n}"))
        step(**{f"a{n}": F.when(room >= 0, F.sqrt(room)) / length - V.dot(vector(f"d{n}"), vector("s")) / (length * length)})
    for n in range(4):
        vec_step(f"r{n}", V.add(V.scale(vector("s"), F.col(f"__a{n}")), vector(f"d{n}")))
    for n in range(4):
        x, y = ray_on_panel(vector(f"r{n}"), fast, slow, origin)
        step(**{f"x{n}": x / px[0], f"y{n}": y / px[1]})
    turn = F.when(F.abs("__zeta") > 1e-10, delta_m / F.col("__zeta"))
    step(z0=image_start - 1 + (F.degrees(phi + turn) - osc_start) / osc_width, z1=image_start - 1 + (F.degrees(phi - turn) - osc_start) / osc_width)
    clamp = lambda v, low, high: F.least(F.greatest(v, low), high)
    first, last = (v if isinstance(v, Column) else F.lit(v) for v in (image_start, image_end))
    xs, ys = ([f"__{c}{n}" for n in range(4)] for c in "xy")
    found = {
        "x_min": F.floor(F.least(*xs)), "x_max": F.ceil(F.greatest(*xs)), "y_min": F.floor(F.least(*ys)), "y_max": F.ceil(F.greatest(*ys)),
        "z_min": F.coalesce(clamp(F.floor(F.least("__z0", "__z1")), first - 1, last - 1), first), "z_max": F.coalesce(clamp(F.ceil(F.greatest("__z0", "__z1")), first, last), last),
    }
    return steps.done(**{k: c.cast("int") for k, c in found.items()})


def lorentz(s0, axis, s1) -> Column:
    return F.abs(V.dot(s1, V.cross(axis, s0))) / (V.norm(s0) * V.norm(s1))


def polarisation(s0, normal, fraction, s1) -> Column:
    across = V.dot(normal, s1) / V.norm(s1)
    along = V.dot(s1, s0) / (V.norm(s1) * V.norm(s0))
    return (1 - 2 * fraction) * (1 - across * across) + fraction * (1 + along * along)


def lp_factor(s0, normal, fraction, axis, s1) -> Column:
    return lorentz(s0, axis, s1) / polarisation(s0, normal, fraction, s1)


def erf(x: Column) -> Column:
    """Error function as a column: its power series near 0 (Horner), the continued fraction of erfc beyond; error below 1e-11."""
    a = F.abs(x)
    minus = -a * a
    zero = F.lit(0.0)
    # folds over literal arrays: nested expressions of this depth can't be compiled
    series = F.aggregate(F.array(*[F.lit(1 / (factorial(n) * (2 * n + 1))) for n in range(40, -1, -1)]), zero, lambda total, c: total * minus + c)
    tail = F.aggregate(F.array(*[F.lit(n / 2) for n in range(40, 0, -1)]), zero, lambda total, c: c / (F.greatest(a, F.lit(2.0)) + total))
    return F.signum(x) * F.when(a < 2.5, 2 / sqrt(pi) * a * series).otherwise(1 - F.exp(minus) / (sqrt(pi) * (a + tail)))


def partiality(phi: Column, phi_begin: Column, phi_end: Column, z: Column, sigma_m) -> Column:
    """Recorded share of a Gaussian rocking curve; all angles in the same unit as sigma_m."""
    c = F.abs(z) / (2**0.5 * sigma_m)
    return 0.5 * (erf(c * (phi_end - phi)) - erf(c * (phi_begin - phi)))


def entering(s1, s0, axis) -> Column:
    return V.dot(s1, V.cross(s0, axis)) < 0


def simple_panel(distance, beam_x, beam_y, px_x, px_y) -> dict[str, V.Vec]:
    """Axes of a panel across the beam: fast along x, slow along -y, beam along -z."""
    return {"fast": V.parts((1, 0, 0)), "slow": V.parts((0, -1, 0)), "origin": (-beam_x * px_x, beam_y * px_y, -distance)}
