"""Least squares over reflections for many models at a time: normal equations of blocks of rows, summed by model, and one small step a model.

Parameters: two tilts of the beam (mrad) and its wavenumber, three turns of the crystal (mrad, about x, y, z), the reciprocal metric
(11, 22, 33, 12, 13, 23; times 1e5), distance and two shifts of the detector (mm) and three tilts (mrad, about its normal, fast and slow
axes, through its centre).  Residuals are dx, dy (mm) and dphi (radians) of reflections whose indices are known.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import written

N = 18
#: Only the tilt of the beam out of the plane of spindle and beam is free by default.
FREE = (1, *range(3, N))
OBSERVED = ("h", "k", "l", "x_mm", "y_mm", "phi", "entering")

#: Parts of a model in an array column, and their numbers.
ARRAY = (("s0", 3), ("axis", 3), ("orientation", 9), ("shape", 9), ("fast", 3), ("slow", 3), ("origin", 3), ("centre", 2))


def part(model: Column, name: str) -> tuple[Column, ...] | list[Column]:
    """A part of a column of models as columns: a vector or the nine cells of a matrix."""
    at = sum(size for _, size in ARRAY[: [n for n, _ in ARRAY].index(name)])
    cells = [model[at + k] for k in range(dict(ARRAY)[name])]
    return cells if len(cells) == 9 else tuple(cells)


def with_setting(model: Column, setting: Column) -> Column:
    """Models with the orientation and shape of other setting matrices."""

    def run(models: pd.Series, settings: pd.Series) -> pd.Series:
        out = []
        for m, a in zip(models, settings, strict=True):
            base = Model.of_array(m)
            rest = {name: getattr(base, name) for name, _ in ARRAY if name not in ("orientation", "shape")}
            out.append(Model.of(np.asarray(a).reshape(3, 3), **rest).array())
        return pd.Series(out)

    return F.pandas_udf(run, "array<double>", F.PandasUDFType.SCALAR)(model, setting)


@dataclass(frozen=True)
class Model:
    """Beam, crystal and panel. `orientation` and `shape` multiply to the setting matrix."""

    s0: np.ndarray
    axis: np.ndarray
    orientation: np.ndarray
    shape: np.ndarray
    fast: np.ndarray
    slow: np.ndarray
    origin: np.ndarray
    centre: tuple[float, float] = (0.0, 0.0)  # of the panel, in mm along fast and slow

    @staticmethod
    def of(setting: np.ndarray, **rest) -> Model:
        q, r = np.linalg.qr(setting)
        flip = np.sign(np.diag(r))
        return Model(orientation=q * flip, shape=r * flip[:, None], **rest)

    def array(self) -> np.ndarray:
        """All numbers of the model, as a column of models holds them: ARRAY names the parts."""
        return np.concatenate([np.ravel(getattr(self, name)) for name, _ in ARRAY]).astype(float)

    @staticmethod
    def of_array(values) -> Model:
        values, parts, at = np.asarray(values, float), {}, 0
        for name, size in ARRAY:
            parts[name] = values[at : at + size].reshape(3, 3) if size == 9 else values[at : at + size]
            at += size
        return Model(**parts)

    def parameters(self) -> np.ndarray:
        g = self.shape.T @ self.shape
        p = np.zeros(N)
        p[2] = np.linalg.norm(self.s0)
        p[6:12] = 1e5 * np.array([g[0, 0], g[1, 1], g[2, 2], g[0, 1], g[0, 2], g[1, 2]])
        return p

    def at(self, p: np.ndarray) -> Model:
        """The model at parameters that are counted from this one."""
        u = self.s0 / np.linalg.norm(self.s0)
        across = np.cross(self.axis, u)
        across /= np.linalg.norm(across)
        beam = _turn(across, p[0] / 1e3) @ _turn(np.cross(u, across), p[1] / 1e3) @ u * p[2]
        turn = _turn(np.array([0.0, 0, 1]), p[5] / 1e3) @ _turn(np.array([0.0, 1, 0]), p[4] / 1e3) @ _turn(np.array([1.0, 0, 0]), p[3] / 1e3)
        a, b, c, d, e, f = p[6:12] / 1e5
        metric = np.array([[a, d, e], [d, b, f], [e, f, c]])
        normal = np.cross(self.fast, self.slow)
        tilt = _turn(normal, p[15] / 1e3) @ _turn(self.fast, p[16] / 1e3) @ _turn(self.slow, p[17] / 1e3)
        pivot = self.origin + self.centre[0] * self.fast + self.centre[1] * self.slow
        fast, slow = tilt @ self.fast, tilt @ self.slow
        moved = pivot + p[12] * normal + p[13] * self.fast + p[14] * self.slow
        return replace(self, s0=beam, orientation=turn @ self.orientation, shape=np.linalg.cholesky(metric).T, fast=fast, slow=slow, origin=moved - self.centre[0] * fast - self.centre[1] * slow)

    @property
    def setting(self) -> np.ndarray:
        return self.orientation @ self.shape

    def _met(self, rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Reciprocal point, phi and diffracted ray of each row: the solution of its `entering`, at the turn nearest the observed phi; NaN without one."""
        r = rows[["h", "k", "l"]].to_numpy(float) @ self.setting.T
        along = r @ self.axis
        across = r - along[:, None] * self.axis
        side = np.cross(self.axis, across)
        p, q = across @ self.s0, side @ self.s0
        t = -((r * r).sum(1) / 2 + along * (self.axis @ self.s0))
        with np.errstate(invalid="ignore", divide="ignore"):
            spread, middle = np.arccos(t / np.hypot(p, q)), np.arctan2(q, p)
            both = []
            for k in (-1, 1):
                phi = middle + k * spread
                s1 = along[:, None] * self.axis + across * np.cos(phi)[:, None] + side * np.sin(phi)[:, None] + self.s0
                both.append((phi, s1, s1 @ np.cross(self.s0, self.axis) < 0))
            first = both[0][2] == rows["entering"].to_numpy(bool)
            phi = np.where(first, both[0][0], both[1][0])
            s1 = np.where(first[:, None], both[0][1], both[1][1])
            seen = rows["phi"].to_numpy(float)
            return r, seen + np.mod(phi - seen + np.pi, 2 * np.pi) - np.pi, s1

    def predicted(self, rows: pd.DataFrame) -> np.ndarray:
        """x mm, y mm and phi of each row."""
        _, phi, s1 = self._met(rows)
        normal = np.cross(self.fast, self.slow)
        with np.errstate(invalid="ignore", divide="ignore"):
            hit = s1 * (self.origin @ normal / (s1 @ normal))[:, None] - self.origin
        return np.stack([hit @ self.fast, hit @ self.slow, phi], 1)

    def residuals(self, rows: pd.DataFrame) -> np.ndarray:
        return self.predicted(rows) - rows[["x_mm", "y_mm", "phi"]].to_numpy(float)


def _turn(axis: np.ndarray, angle: float) -> np.ndarray:
    x, y, z = axis / np.linalg.norm(axis)
    k = np.array([[0, -z, y], [z, 0, -x], [-y, x, 0]])
    return np.eye(3) + np.sin(angle) * k + (1 - np.cos(angle)) * k @ k


def gradients(model: Model, p: np.ndarray, rows: pd.DataFrame, free: tuple[int, ...] = FREE) -> np.ndarray:
    """Derivative of each residual by each free parameter; others are 0. Shape: rows, 3, N.

    Setting matrix, beam and panel are differentiated by the parameters once a model (central differences), residuals by these in closed form, since phi follows
    from r.r / 2 + (R r).s0 = 0: no parameter costs a prediction of all rows.
    """
    out = np.zeros((len(rows), 3, N))
    now = model.at(p)
    r, phi, s1 = now._met(rows)
    axis, fast, slow, origin = now.axis, now.fast, now.slow, now.origin
    normal = np.cross(fast, slow)
    cos, sin = np.cos(phi)[:, None], np.sin(phi)[:, None]

    def back(v: np.ndarray) -> np.ndarray:
        """Turned by -phi about the axis."""
        along = (v @ axis)[..., None] * axis
        return along + (v - along) * cos - np.cross(axis, v) * sin

    rho = s1 - now.s0
    tangent = np.cross(axis, rho)
    speed = (tangent @ now.s0)[:, None]
    by_r, by_s0 = (r + back(now.s0[None])) / speed, rho / speed  # minus phi's derivatives
    depth = s1 @ normal
    scale = origin @ normal / depth
    to_r, to_s0, share = [], [], []
    for v in (fast, slow):
        q = s1 @ v / depth
        g = scale[:, None] * (v - q[:, None] * normal)
        turn = (g * tangent).sum(1)[:, None]
        to_r.append(back(g) - turn * by_r)
        to_s0.append(g - turn * by_s0)
        share.append(q)
    to_r, to_s0 = np.stack([*to_r, -by_r], 1), np.stack([*to_s0, -by_s0], 1)
    hkl = rows[["h", "k", "l"]].to_numpy(float)
    to_setting = (to_r[..., None] * hkl[:, None, None, :]).reshape(len(rows), 3, 9)
    for k in free:
        step = np.zeros(N)
        step[k] = 1e-4 * max(1.0, abs(p[k]) * 1e-2) if k != 2 else 1e-6
        above, below = model.at(p + step), model.at(p - step)
        change = lambda f: (f(above) - f(below)) / (2 * step[k])  # noqa: B023, E731
        if k < 3:
            out[:, :, k] = to_s0 @ change(lambda m: m.s0)
        elif k < 12:
            out[:, :, k] = to_setting @ change(lambda m: m.setting.ravel())
        else:
            turned = s1 @ change(lambda m: np.cross(m.fast, m.slow))
            reach = change(lambda m: m.origin @ np.cross(m.fast, m.slow))
            for n, name in enumerate(("fast", "slow")):
                moved = s1 @ change(lambda m: getattr(m, name))  # noqa: B023
                out[:, n, k] = share[n] * reach + scale * (moved - share[n] * turned) - change(lambda m: m.origin @ getattr(m, name))  # noqa: B023
    return out


# --- many models at a time --------------------------------------------------------------------------------------------

#: Rows of a block, models whose state is broadcast, sums of a model: J'J, J'r, the squares of each residual, rows.
BLOCK, STATES = 4096, 10_000
SUMS = N * N + N + 4
_STATE = "model array<double>, p array<double>, trial array<double>, damp double, sums array<double>, done boolean"


def _packed(names: list[str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Rows of a batch by key, in blocks: (*key, data), data row after row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, rows in batch.groupby(names, dropna=False, sort=False):
                data = rows[list(OBSERVED)].to_numpy(np.float64)
                out += [(*key, data[k : k + BLOCK].ravel()) for k in range(0, len(data), BLOCK)]
            if out:
                yield pd.DataFrame(out, columns=[*names, "data"])

    return run


def _block_sums(free: tuple[int, ...]):
    def sums(model: list, trial: list, data: list) -> np.ndarray:
        rows = pd.DataFrame(np.asarray(data).reshape(-1, len(OBSERVED)), columns=list(OBSERVED))
        base, p, total = Model.of_array(model), np.asarray(trial), np.zeros(SUMS)
        try:
            r = base.at(p).residuals(rows)
            good = np.isfinite(r).all(1)
            j = gradients(base, p, rows[good], free).reshape(-1, N)
        except np.linalg.LinAlgError:  # no cell has this metric: the trial fits no row
            return total
        r = r[good]
        total[: N * N], total[N * N : -4] = (j.T @ j).ravel(), j.T @ r.ravel()
        total[-4:-1], total[-1] = (r * r).sum(0), len(r)
        return total

    def run(model: pd.Series, trial: pd.Series, data: pd.Series) -> pd.Series:
        return pd.Series([sums(*x) for x in zip(model, trial, data, strict=True)])

    return run


def _advanced(free: tuple[int, ...], tol: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A model's next state from the sums at its trial: the trial is taken if it fits better, damping falls or rises, and the next trial follows."""
    at = list(free)

    def step(p: np.ndarray, trial: np.ndarray, damp: float, old: np.ndarray | None, new: np.ndarray) -> tuple:
        done = False
        if old is None or new[-1] >= old[-1] and new[-4:-1].sum() < old[-4:-1].sum():
            if old is not None:
                done, damp = old[-4:-1].sum() - new[-4:-1].sum() <= tol * old[-4:-1].sum(), damp / 10
            p, old = trial, new
        else:
            damp *= 10
            done = damp > 1e8
        a, g = old[: N * N].reshape(N, N)[np.ix_(at, at)], old[N * N : -4][at]
        if not old[-1] or not np.isfinite(a).all():
            return p, p, damp, old, True
        scale = np.maximum(np.diag(a), 1e-12 * max(np.diag(a).max(), 1e-300))
        trial = p.copy()
        trial[at] -= np.linalg.lstsq(a + damp * np.diag(scale), g, rcond=None)[0]
        return p, trial, damp, old, bool(done)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            made = [step(np.asarray(p), np.asarray(t), d, None if o is None else np.asarray(o), np.zeros(SUMS) if n is None else np.asarray(n)) for p, t, d, o, n in zip(*(rows[c] for c in ("p", "trial", "damp", "sums", "new")), strict=True)]
            for k, name in enumerate(("p", "trial", "damp", "sums", "done")):
                rows[name] = [m[k] for m in made]
            yield rows.drop(columns="new")

    return run


def _ended(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        sums = [np.asarray(s) for s in rows.pop("sums")]
        models = [Model.of_array(m).at(np.asarray(p)) for m, p in zip(rows.pop("model"), rows.pop("p"), strict=True)]
        rows["model"], rows["setting"] = [m.array() for m in models], [m.setting.ravel() for m in models]
        rows["n"] = [int(s[-1]) for s in sums]
        mean = np.array([s[-4:-1] / s[-1] if s[-1] else np.full(3, np.nan) for s in sums]).reshape(-1, 3)
        rows["rmsd_x"], rows["rmsd_y"], rows["rmsd_phi"], rows["rmsd_xy"] = *np.sqrt(mean.T), np.sqrt(mean[:, 0] + mean[:, 1])
        yield rows


def fitted(rows: DataFrame, models: DataFrame, key: list[str], *, free: tuple[int, ...] = FREE, rounds: int = 10, tol: float = 1e-6) -> DataFrame:
    """(*key, model, setting, n, rmsd_x, rmsd_y, rmsd_phi, rmsd_xy): every model of `models` (*key, model) refined against its rows, all at the same time.

    Rows (*key and OBSERVED) are packed once into blocks. A round joins the blocks with the models that still move, sums their normal equations by model,
    and takes or refuses each model's trial step (Levenberg-Marquardt, at most `rounds` trials); models at rest leave the join. The
    state is a table of a row a model, written every round.

    Defined cases: rows whose residuals are not finite count for nothing; a step that loses rows is refused; a model without rows stays as it is, with n = 0 and
    null root mean squares; rows without a model are not read; an empty table of models gives an empty table.
    """
    kinds = ", ".join(f"`{k}` {models.schema[k].dataType.simpleString()}" for k in key)
    seen = rows.select(*key, *(F.col(c).cast("double").alias(c) for c in OBSERVED))
    blocks = written(seen.hint("rebalance", *key).sortWithinPartitions(*key).mapInPandas(_packed(key), f"{kinds}, data array<double>"))
    start = F.pandas_udf(lambda models: models.map(lambda m: Model.of_array(m).parameters()), "array<double>", F.PandasUDFType.SCALAR)
    state = models.select(*key, "model", start("model").alias("p")).select(*key, "model", "p", F.col("p").alias("trial"), F.lit(1e-3).alias("damp"), F.lit(None).cast("array<double>").alias("sums"), F.lit(False).alias("done"))
    state = written(state)
    summed = F.pandas_udf(_block_sums(free), "array<double>", F.PandasUDFType.SCALAR)
    for _ in range(rounds + 1):
        moving = state.where("NOT done")
        n = moving.count()
        if not n:
            break
        trial = moving.select(*key, "model", "trial")
        each = blocks.join(F.broadcast(trial) if n <= STATES else trial, key).select(*key, F.posexplode(summed("model", "trial", "data")).alias("at", "s"))
        sums = each.groupBy(*key, "at").agg(F.sum("s").alias("s")).groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "s"))), lambda x: x["s"]).alias("new"))  # SUMS numbers
        names = [*key, "model", "p", "trial", "damp", "sums", "done"]
        state = written(moving.join(sums, key, "left").select(*names, "new").mapInPandas(_advanced(free, tol), f"{kinds}, {_STATE}").union(state.where("done").select(*names)))
    out = state.select(*key, "model", "p", "sums").mapInPandas(_ended, f"{kinds}, model array<double>, setting array<double>, n long, rmsd_x double, rmsd_y double, rmsd_phi double, rmsd_xy double")
    return out.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("rmsd_x", "rmsd_y", "rmsd_phi", "rmsd_xy")})
