r"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

Every document draws an exponential key, -ln(u) / weight, from the hash of its id; within a source, documents are
taken in the order of their keys, which is weighted sampling without replacement.  A source's budget is first spent on
complete epochs (every document once each); what is left goes down the order until a prefix sum
reaches it, and the document at the edge gives the words that are still wanted.

Targets share the words of all sources by weight, none above `max_epochs` times its source.  With sources
sorted by cap / weight, let level(i) be what a unit of weight gets when all sources before i stand at their caps; the
level after resharing is the largest of these.

A source is never sorted in one task: its documents are dealt into ranges of the key (more of them where there are more rows; the result
is the same), a small table has the words of each (source, range), and the prefix sum of a document is that of its range plus the
one within the range.  Only the table of the sources, a row each, is sorted as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import own_names, without

#: Least ranges of the key that a source is dealt into, rows of all sources for each of them, and how densely they lie at the start (about the mean weight).
RANGES, RANGE_ROWS, SPREAD = 128, 1 << 16, 3.0
#: Words, and where a text can be cut between them (behind each word).
WORD, BEHIND_WORD = r"[^\x20\x09-\x0D]+", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """Quality weight of a document, 1 to 4: one more each for 50 words, a usual word length, a closing full stop."""
    chars = F.length(text)
    closing = F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))
    checks = (size >= 50, (chars >= 4 * size) & (chars <= 12 * size), closing.endswith(".") | closing.endswith("!") | closing.endswith("?"))
    return sum((F.when(c, 1).otherwise(0) for c in checks), F.lit(1))


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) from the hash of a key."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)


def _targets(sizes: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """A row for each source: key, source_size, target. Sources have one row each here."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    t = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long"))
    t = t.withColumn("cap", F.lit(max_epochs) * F.col("source_size"))
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), zero)).cast("double") / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), zero))
    t = t.withColumn("level", level)
    return t.withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.max("level").over(everything))).select("key", "source_size", "target")


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, weight: Column | None = None, seed: int = 17) -> DataFrame:
    """All rows of `docs` with size, source_size, target and taken (words, repeats counted).

    `weights` go to the sources in code-point order, null last, and repeat. `weight` is a document's quality
    weight (positive; default: `quality_weight`). A source's `taken` adds up to its target, rounded down. Rows are counted when the
    function is called.

    Defined cases: a null text has no words and nothing is taken of it; null is a source of its own; rows that
    repeat an id draw the same key and are taken by size, then text; an empty table gives an empty table; other
    columns pass through, but for those named like a result column, which it replaces.
    """
    docs = without(docs, "size", "source_size", "target", "taken")
    draw, part, key, before, tie = own_names(docs, "draw", "range", "source", "before", "tie")
    text = F.col(text_col).cast("string")
    ranges = max(RANGES, docs.count() // RANGE_ROWS)
    base = docs.withColumn("size", word_count(text))
    base = base.withColumn(draw, -F.log(uniform(F.col(id_col), seed)) / (quality_weight(text, F.col("size")) if weight is None else weight))
    base = base.withColumn(tie, F.xxhash64(text))
    base = base.withColumn(part, F.least(F.floor((1 - F.exp(-SPREAD * F.col(draw))) * ranges), F.lit(ranges - 1)).cast("int"))
    base = base.withColumn(key, F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("")))

    parts = base.groupBy(F.col(key).alias("key"), F.col(part).alias("range")).agg(F.sum("size").alias("words"))
    sizes = parts.groupBy("key").agg(F.sum("words").alias("source_size")).withColumn("source", F.when(F.col("key") != "", F.substring("key", 2, 1 << 30)))
    upto = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn(before, F.coalesce(F.sum("words").over(upto), F.lit(0))).drop("words")
    plan = starts.join(_targets(sizes, weights, max_epochs), "key").select(F.col("key").alias(key), F.col("range").alias(part), before, "source_size", "target")

    within = Window.partitionBy(key, part).orderBy(draw, id_col, "size", tie).rowsBetween(Window.unboundedPreceding, -1)
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div source_size")).otherwise(0)
    left = budget - epochs * F.col("source_size") - F.col(before) - F.coalesce(F.sum("size").over(within), F.lit(0))
    taken = (epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))).cast("long")
    out = base.join(plan, [key, part]).withColumn("taken", taken)
    return out.select(*docs.columns, "size", "source_size", "target", "taken")


def expanded(mixed: DataFrame, columns: list[str], *, text_col: str = "text") -> DataFrame:
    """The documents of the mix: a row for each time a document is taken; the last of its rows has the words still wanted."""
    (turn,) = own_names(mixed, "turn")
    turns = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("taken") - 1) / F.col("size")).cast("long")))
    rows = mixed.where(F.col("taken") > 0).withColumn(turn, turns)
    wanted = F.least(F.col("size"), F.col("taken") - F.col(turn) * F.col("size"))
    cut = F.array_join(F.slice(F.split(text_col, BEHIND_WORD), F.lit(1), wanted.cast("int")), "")
    return rows.withColumn(text_col, F.when(wanted < F.col("size"), cut).otherwise(F.col(text_col))).select(*columns)
