"""Integration of predicted reflections: boxes, pixels of foreground and background, intensities, corrections.

`geometry`: fast, slow, origin, px, wavelength, s0, axis, image_start, image_end, osc_start, osc_width, and polarization_normal, polarization_fraction.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import vec as V
from ..plans.scratch import written
from . import background as B
from . import shoebox as X

#: Columns of a ray and its local frame, as numbers.
_RAY = ("s_x", "s_y", "s_z", "u_x", "u_y", "u_z", "v_x", "v_y", "v_z")


def ellipsoid(geometry: dict, delta_b: float, delta_m: float):
    """The foreground test of `shoebox.is_foreground` for arrays of pixels; the columns are _RAY, phi and zeta."""
    g = geometry
    fast, slow, origin = (np.array(g[k], float) for k in ("fast", "slow", "origin"))

    def test(x: np.ndarray, y: np.ndarray, frame: np.ndarray, c: dict[str, np.ndarray]) -> np.ndarray:
        faces = [np.radians(g["osc_start"] + (frame + k - (g["image_start"] - 1)) * g["osc_width"]) for k in (0, 1)]
        within = (np.minimum(*faces) < c["phi"]) & (c["phi"] < np.maximum(*faces))
        depth = np.where(within, 0.0, np.minimum(*((c["zeta"] * (a - c["phi"]) / delta_m) ** 2 for a in faces)))
        s, u, v = (np.stack([c[f"{n}_{k}"] for k in "xyz"], 1) for n in "suv")
        length = np.sqrt((s * s).sum(1))
        nearest = np.full(len(x), np.inf)
        for dx in (0, 1):
            for dy in (0, 1):
                p = ((x + dx) * g["px"][0])[:, None] * fast + ((y + dy) * g["px"][1])[:, None] * slow + origin
                off = p / np.sqrt((p * p).sum(1))[:, None] / g["wavelength"] - s
                nearest = np.minimum(nearest, (((u * off).sum(1) / length) ** 2 + ((v * off).sum(1) / length) ** 2) / delta_b**2)
        return nearest + depth <= 1

    return test


def with_frames(reflections: DataFrame, geometry: dict) -> DataFrame:
    """Adds _RAY and zeta of `s1`."""
    steps = G.Steps(reflections)
    steps.vector("s", V.parts(F.col("s1")))
    steps.unit("u", V.cross(steps.of("s"), geometry["s0"]))
    steps.unit("v", V.cross(steps.of("s"), steps.of("u")))
    columns = {f"{n}_{c}": v for n in "suv" for c, v in zip("xyz", steps.of(n), strict=True)}
    return steps.done(**columns, zeta=V.dot(V.unit(geometry["axis"]), steps.of("u")))


def integrate(reflections: DataFrame, frames: DataFrame, geometry: dict, *, sigma_b: float, sigma_m: float, n_sigma: float = 3.0, min_zeta: float = 0.05, n_frames: int | None = None) -> DataFrame:
    """A row for each reflection of `reflections` (refl_id, dataset, s1, phi in radians) that can be integrated, with its intensity, variance, background, partiality, LP factor
    and centroid. `frames` are dense; `n_frames` is how many there are where the scan claims more.

    Left out: reflections along the axis (`min_zeta`), without a box in the images, with a masked foreground pixel, without foreground, or without a
    valid Tukey background. A box meets its frames once; a row for each reflection and frame shuffles on.
    """
    g = geometry
    delta_b, delta_m = n_sigma * sigma_b, n_sigma * sigma_m
    # each step is a table of its own: one plan of all of them takes longer to compile than to run
    rows = written(with_frames(reflections, g).where(G.integrable(F.col("zeta"), min_zeta)))
    panel = {k: g[k] for k in ("fast", "slow", "origin", "px")}
    scan = {k: g[k] for k in ("image_start", "image_end", "osc_start", "osc_width")}
    rows = written(G.with_bounding_box(rows, F.col("s1"), F.col("phi"), g["s0"], g["axis"], delta_b, delta_m, **panel, **scan))
    first, last = G.clamped_images(F.lit(g["image_start"]), F.lit(g["image_end"]), F.lit(n_frames or g["image_end"]))
    boxes = rows.select("refl_id", "dataset", *G.BOX, "phi", "zeta", *_RAY).withColumns({"z_min": F.greatest("z_min", first), "z_max": F.least("z_max", last + 1)})
    parts = written(X.frame_sums(boxes, frames, ellipsoid(g, delta_b, delta_m), histogram=True))
    sums = X.totals(parts)
    hist = parts.select("refl_id", F.explode(F.arrays_zip("values", "counts")).alias("p")).groupBy("refl_id", F.col("p.values").alias("value")).agg(F.sum("p.counts").alias("cnt"))
    model = B.tukey(hist, ["refl_id"]).select("refl_id", "mean", "valid")
    sums, model = written(sums), written(model)
    out = rows.join(sums, "refl_id").join(model, "refl_id").where(X.success(F.col("ok"), F.col("n_fg"), F.col("valid"), F.lit(False)))
    out = X.with_centroid(B.net_intensity(out))
    angle = lambda z: F.radians(g["osc_start"] + (F.col(z) - (g["image_start"] - 1)) * g["osc_width"])
    lp = G.lp_factor(V.parts(g["s0"]), V.parts(g["polarization_normal"]), g["polarization_fraction"], V.parts(g["axis"]), tuple(F.col(f"s_{c}") for c in "xyz"))
    out = out.withColumns({"begin": angle("z_min"), "end": angle("z_max"), "lp": lp})
    out = out.withColumn("partiality", G.partiality(F.col("phi"), F.col("begin"), F.col("end"), F.col("zeta"), sigma_m))
    return out.drop("begin", "end", "valid", "ok", *_RAY, "x_moment", "y_moment", "frame_moment")
