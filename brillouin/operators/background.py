"""Background models over pixel histograms: rows (key columns, value, cnt), as many as there are distinct values."""

from __future__ import annotations

from math import lgamma

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bins of the bounded histogram, and the share of overflow beyond which an estimate is refused.
BINS, MAX_OVERFLOW = 256, 0.25
#: Fixed values of the robust fit: Huber's constant, tolerance, iterations, pixels needed.
HUBER, TOLERANCE, MAX_ITERATIONS, MIN_PIXELS = 1.345, 1e-3, 100, 10


def histogram(pixels: DataFrame, key: list[str], value: Column) -> DataFrame:
    """Counts of each value; negative values are left out."""
    return pixels.withColumn("value", value).where(F.col("value") >= 0).groupBy(*key, "value").agg(F.count(F.lit(1)).alias("cnt"))


def merged(*histograms: DataFrame, key: list[str]) -> DataFrame:
    """Sum of partial histograms."""
    rows = histograms[0]
    for other in histograms[1:]:
        rows = rows.unionByName(other)
    return rows.groupBy(*key, "value").agg(F.sum("cnt").alias("cnt"))


def tukey(hist: DataFrame, key: list[str], num_bins: int | None = BINS) -> DataFrame:
    """Mean of the values inside Tukey's fences (1.5 IQR): key, n, overflow, q1, q3, n_in, sum_in, mean, valid.

    Quartiles are the first values whose cumulative count reaches (n + 3) div 4 and (3 n + 1) div 4. With a bound on the bins, values from
    `num_bins` on are overflow: they count for n, and too many of them, or an upper fence outside the bins, make the estimate invalid.
    """
    inside = F.lit(True) if num_bins is None else F.col("value") < num_bins
    whole = Window.partitionBy(*key)
    rows = hist.withColumn("n", F.sum("cnt").over(whole))
    rows = rows.withColumn("cum", F.sum("cnt").over(whole.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)))
    at = lambda k: F.min(F.when(inside & (F.col("cum") >= k), F.col("value"))).over(whole)
    rows = rows.withColumns({"q1": at(F.expr("(n + 3) div 4")), "q3": at(F.expr("(3 * n + 1) div 4"))})
    if num_bins is not None:
        rows = rows.withColumns({c: F.coalesce(c, F.lit(num_bins)) for c in ("q1", "q3")})
    spread = F.col("q3") - F.col("q1")
    good = inside & (F.col("value") >= F.col("q1") - 1.5 * spread) & (F.col("value") <= F.col("q3") + 1.5 * spread)
    out = rows.groupBy(*key).agg(
        F.max("n").alias("n"), F.coalesce(F.sum(F.when(~inside, F.col("cnt"))), F.lit(0)).alias("overflow"), F.max("q1").alias("q1"), F.max("q3").alias("q3"),
        F.coalesce(F.sum(F.when(good, F.col("cnt"))), F.lit(0)).alias("n_in"), F.coalesce(F.sum(F.when(good, F.col("cnt") * F.col("value"))), F.lit(0)).alias("sum_in"),
    )
    fits = F.lit(True) if num_bins is None else (F.col("overflow") <= MAX_OVERFLOW * F.col("n")) & (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")) < num_bins)
    valid = (F.col("n_in") > 0) & fits
    return out.withColumn("mean", F.when(valid, F.col("sum_in").cast("double") / F.col("n_in"))).withColumn("valid", valid)


def _log_factorial(k: np.ndarray) -> np.ndarray:
    return np.array([lgamma(x + 1.0) for x in k])


def _pdf(mu: np.ndarray, k: np.ndarray) -> np.ndarray:
    out = np.exp(np.maximum(k, 0) * np.log(mu) - mu - _log_factorial(np.maximum(k, 0)))
    return np.where(k < 0, 0.0, out)


def _cdf(mu: np.ndarray, k: np.ndarray) -> np.ndarray:
    term = np.exp(-mu)
    total, top = term.copy(), int(max(k.max(), 0))
    for j in range(1, top + 1):
        term = term * mu / j
        total += np.where(j <= k, term, 0.0)
    return np.where(k < 0, 0.0, total)


def _expected(mu: np.ndarray, c: float) -> tuple[np.ndarray, np.ndarray]:
    """Expectation of Huber's psi of the Pearson residual of a Poisson variable, and of psi times the score."""
    sd = np.sqrt(mu)
    low, high = np.floor(mu - c * sd), np.floor(mu + c * sd)
    at_low, at_high = _pdf(mu, low), _pdf(mu, high)
    below = _cdf(mu, low)
    above = 1.0 - _cdf(mu, high)
    first = c * (above - below) + mu / sd * (at_low - at_high)
    between = _cdf(mu, high - 1) - below + at_low
    second = c * (at_low + at_high) + mu**2 / sd**3 * (between / mu + _pdf(mu, low - 1) - at_low - _pdf(mu, high - 1) + at_high)
    return first, second


def robust_means(group: np.ndarray, value: np.ndarray, count: np.ndarray, groups: int, num_bins: int | None = BINS) -> np.ndarray:
    """Robust Poisson means of many histograms at once (NaN: no estimate): iteratively reweighted least squares on the log mean."""
    over = np.zeros(groups)
    if num_bins is not None:
        high = value >= num_bins
        over = np.bincount(group[high], count[high], groups)
        group, value, count = group[~high], value[~high], count[~high]
    n = np.bincount(group, count, groups) + over
    order = np.lexsort((value, group))
    group, value, count = group[order], value[order], count[order]
    cum = np.cumsum(count)
    first = np.searchsorted(group, np.arange(groups))
    before = np.concatenate([[0], cum])[first]
    reach = cum - before[group] >= np.floor(n / 2)[group] + 1
    median = np.ones(groups)
    hit = np.flatnonzero(reach)[::-1]
    median[group[hit]] = value[hit]  # the first that reaches it comes last here
    beta = np.log(np.where(median == 0, 1.0, median))
    usable = (n >= MIN_PIXELS) & (over <= MAX_OVERFLOW * n)
    open_, done = usable.copy(), np.zeros(groups, bool)
    for _ in range(MAX_ITERATIONS):
        if not open_.any():
            break
        mu = np.exp(np.where(open_, beta, 0.0))
        sd = np.sqrt(mu)
        first_moment, second = _expected(mu, HUBER)
        psi = np.clip((value - mu[group]) / sd[group], -HUBER, HUBER)
        score = (np.bincount(group, count * psi, groups) + over * HUBER - n * first_moment) * sd
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(open_, score / (n * second * mu * mu / sd), 0.0)
        size = np.sqrt(step**2 / np.maximum(beta**2, 1e-10))
        beta = beta + np.where(np.isfinite(step), step, 0.0)
        stop = open_ & (~np.isfinite(step) | (size < TOLERANCE))
        done |= stop & np.isfinite(step)
        open_ &= ~stop
    good = done & usable & (np.abs(beta) < 300)
    return np.where(good, np.exp(np.where(good, beta, 0.0)), np.nan)


def glm(hist: DataFrame, key: list[str], num_bins: int | None = BINS, buckets: int | None = None) -> DataFrame:
    """Robust Poisson background of each key: key, n, mean, sum (mean times n), valid. Whole buckets of keys are fitted at once."""
    kinds = ", ".join(f"`{k}` {hist.schema[k].dataType.simpleString()}" for k in key)

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        code, first = rows.groupby(key, sort=False, dropna=False).ngroup().to_numpy(), ~rows.duplicated(key)
        out = rows.loc[first, key].reset_index(drop=True)
        count = rows["cnt"].to_numpy(float)
        mean = robust_means(code, rows["value"].to_numpy(float), count, len(out), num_bins)
        out["n"] = np.bincount(code, count, len(out)).astype(np.int64)
        out["mean"], out["sum"], out["valid"] = mean, mean * out["n"], np.isfinite(mean)
        return out[[*key, "n", "mean", "sum", "valid"]]

    n = buckets or int(hist.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64(*key), F.lit(n)).alias("__bucket")
    fitted = hist.groupBy(bucket).applyInPandas(fit, f"{kinds}, n long, mean double, sum double, valid boolean")
    return fitted.withColumns({c: F.when(F.col("valid"), F.col(c)) for c in ("mean", "sum")})


def overflow_guard(fitted: DataFrame) -> DataFrame:
    """One row: reflections whose overflow is over the limit, and the worst share. Raise on it in the driver."""
    share = F.col("overflow") / F.col("n")
    return fitted.agg(F.count_if(share > MAX_OVERFLOW).alias("n_over"), F.max(share).alias("worst"))


def net_intensity(rows: DataFrame) -> DataFrame:
    """Adds intensity, variance, sigma and background_sigma from foreground (fg_sum, n_fg) and background (mean, n_bg)."""
    under = F.col("n_fg") * F.col("mean")
    ratio = F.when(F.col("n_bg") > 0, F.col("n_fg").cast("double") / F.col("n_bg")).otherwise(0.0)
    rows = rows.withColumn("intensity", F.col("fg_sum") - under)
    rows = rows.withColumn("variance", F.abs("intensity") + F.abs(under) * (1 + ratio))
    return rows.withColumns({"sigma": F.sqrt("variance"), "background_sigma": F.sqrt(F.abs(under) * (1 + ratio))})


def intensity_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.min("intensity").alias("min_intensity"), F.max("intensity").alias("max_intensity"), F.avg("intensity").alias("mean_intensity"), F.avg("sigma").alias("mean_sigma"),
        F.avg("mean").alias("mean_background"), F.avg(F.when(F.col("sigma") > 0, F.col("intensity") / F.col("sigma"))).alias("mean_i_over_sigma"),
    )
