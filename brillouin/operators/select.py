"""Order statistics and samples of groups of any size, without a sort of a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.scratch import written

#: Buckets of an interval in a pass, rows of an interval that are ranked in one task, intervals that are broadcast, parts of a group that are cut by rank on their own.
BUCKETS, SMALL, INTERVALS, PARTS = 1 << 12, 10_000, 100_000, 64


def at_ranks(values: DataFrame, key: list[str], column: str, ranks: DataFrame) -> DataFrame:
    """`ranks` (*key, name, at) with `value`, the value at place `at` (from 0) of the group's values in ascending order. Exact.

    A pass cuts every interval that holds a wanted place into BUCKETS equal parts, counts rows in them (partial sums in tasks), and keeps the
    parts with the places; it ends where a part has one value or at most SMALL rows, which are ranked. Values are finite.
    """
    names = [f"__k{k}" for k in range(len(key))]
    v = written(values.select(*(F.col(k).alias(n) for k, n in zip(key, names, strict=True)), F.col(column).cast("double").alias("__v")).where("__v IS NOT NULL AND NOT isnan(__v)"))
    whole = v.groupBy(*names).agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"), F.count(F.lit(1)).alias("__n"))
    same = lambda a, b, columns=names: _all(a[c].eqNullSafe(b[c]) for c in columns)
    wanted = ranks.select(*(F.col(k).alias(n) for k, n in zip(key, names, strict=True)), "name", F.col("at").cast("long").alias("__at"))
    w, g = wanted.alias("w"), whole.alias("g")
    open_ = written(w.join(g, same(w, g)).where("__at >= 0 AND __at < __n").select("w.*", "__lo", "__hi", "__n"))
    settled = None
    edges = [*names, "__lo", "__hi"]
    while True:
        small = open_.where(f"__lo = __hi OR __n <= {SMALL}")
        done = small.where("__lo = __hi").select(*names, "name", F.col("__lo").alias("value"))
        few = small.where("__lo < __hi")
        inside = _within(v, few.select(*edges).distinct(), names)
        ranked = inside.withColumn("__at", F.row_number().over(Window.partitionBy(*edges).orderBy("__v")).cast("long") - 1)
        f, r = few.alias("f"), ranked.alias("r")
        done = done.union(f.join(r, same(f, r, [*edges, "__at"])).select(*(f"f.{n}" for n in names), "name", F.col("__v").alias("value")))
        settled = done if settled is None else settled.union(done)
        large = open_.where(f"__lo < __hi AND __n > {SMALL}")
        if large.isEmpty():
            break
        # halves, so that the width of an interval never overflows
        share = F.try_divide(F.col("__v") / 2 - F.col("__lo") / 2, F.col("__hi") / 2 - F.col("__lo") / 2)
        bucket = F.when(F.col("__v") == F.col("__hi"), BUCKETS - 1).otherwise(F.least(F.floor(F.coalesce(share, F.lit(0.0)) * BUCKETS), F.lit(BUCKETS - 1)))
        cells = _within(v, large.select(*edges).distinct(), names).groupBy(*edges, bucket.alias("__b")).agg(F.min("__v").alias("__low"), F.max("__v").alias("__high"), F.count(F.lit(1)).alias("__c"))
        cells = cells.withColumn("__before", F.sum("__c").over(Window.partitionBy(*edges).orderBy("__b")) - F.col("__c"))  # BUCKETS rows
        a, c = large.alias("a"), cells.alias("c")
        hit = a.join(c, same(a, c, edges) & (F.col("__at") >= F.col("__before")) & (F.col("__at") < F.col("__before") + F.col("__c")))
        open_ = written(hit.select(*(f"a.{n}" for n in names), "name", (F.col("__at") - F.col("__before")).alias("__at"), F.col("__low").alias("__lo"), F.col("__high").alias("__hi"), F.col("__c").alias("__n")))
    return settled.select(*(F.col(n).alias(k) for k, n in zip(key, names, strict=True)), "name", "value")


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _within(v: DataFrame, intervals: DataFrame, names: list[str]) -> DataFrame:
    """Values inside each interval: (*names, __lo, __hi, __v)."""
    v, i = v.alias("v"), (F.broadcast(intervals) if intervals.count() <= INTERVALS else intervals).alias("i")
    return v.join(i, _all(F.col(f"v.{n}").eqNullSafe(F.col(f"i.{n}")) for n in names) & F.col("v.__v").between(F.col("i.__lo"), F.col("i.__hi"))).select("i.*", "v.__v")


def five_number_quartiles(rows: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """(*key, column, q1, q3) for each column: medians of the lower and the upper half, the middle value in both. Nulls and NaN don't count."""
    long = rows.select(*key, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])).alias("x")).select(*key, "x.column", "x.v").where("v IS NOT NULL AND NOT isnan(v)")
    group = [*key, "column"]
    half, start = F.ceil(F.col("n") / 2), F.floor(F.col("n") / 2)
    middle = F.floor(half / 2)
    # an odd half has its middle twice
    places = [F.struct(F.lit(f"{q}{side}").alias("name"), (base + middle - F.when(half % 2 == 0, side).otherwise(0)).alias("at")) for q, base in (("q1", F.lit(0)), ("q3", start)) for side in (0, 1)]
    ranks = long.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).select(*group, F.explode(F.array(*places)).alias("p")).select(*group, "p.name", "p.at")
    found = at_ranks(long, group, "v", ranks)
    mean = lambda q: F.avg(F.when(F.col("name").startswith(q), F.col("value"))).alias(q)
    return found.groupBy(*group).agg(mean("q1"), mean("q3"))


def least_rows(rows: DataFrame, key: list[str], order: list[Column], n: Column) -> DataFrame:
    """The first `n` rows of each group in `order`. Parts of a group are cut to n first, so no task ranks a whole group."""
    part = F.pmod(F.xxhash64(*order), F.lit(PARTS))
    rows = rows.withColumns({"__n": n, "__part": part})
    for group in ([*key, "__part"], key):
        rows = rows.withColumn("__row", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("__row") <= F.col("__n"))
    return rows.drop("__n", "__part", "__row")
