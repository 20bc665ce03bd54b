"""Sharding by weighted rendezvous hashing.

Every shard draws an exponential variate from the hash of (record key, shard), divided by its weight; the smallest
wins.  A shard's draws do not depend on the other shards, so one more shard only takes records
into itself, about its share of them, and no other record moves.

Slots number the rows of a shard without a gap, in the order of a hash of the row.  No shard is numbered in one task, and no row that
repeats is sorted with its equals: equal rows are counted first, shards are cut into ranges of the hash (more of them where there are more rows),
the table of range sizes gives each range its first slot, and only ranges are sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import own_names, written

#: Different rows that a range of a shard holds on average at most.
RANGE_ROWS = 1 << 17
#: Bits of a hash that are used.
BITS = 52


def _hash(text: Column) -> Column:
    """The first BITS bits of a text's MD5, as a long."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def _key_text(key: Column) -> Column:
    return F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit(""))


def rendezvous(key: Column, weights: Sequence[float], seed: int = 0) -> Column:
    """Shard (0 to len(weights) - 1) of a key: an int. A null key is a key of its own; a weight of 0 takes nothing."""
    used = [(s, w) for s, w in enumerate(weights) if w > 0]
    if not used:
        raise ValueError("no shard has a positive weight")

    def draw(shard: int, weight: float) -> Column:
        return -F.log((_hash(F.concat(F.lit(f"{seed}:{shard}:"), _key_text(key))).cast("double") + 0.5) / float(1 << BITS)) / F.lit(float(weight))

    draws = [F.struct(draw(s, w).alias("draw"), F.lit(s).alias("shard")) for s, w in used]
    return (F.least(*draws) if len(draws) > 1 else draws[0])["shard"].cast("int")


def shard_records(docs: DataFrame, *, shards: int = 24, key_col: str = "doc_id", text_col: str = "text", weights: Sequence[float] | None = None, overhead: int = 8, range_rows: int = RANGE_ROWS, seed: int = 0) -> DataFrame:
    """A row for each row of `docs`: the key, size, text_crc32, law, shard, slot, grown_shard.

    `size` is the UTF-8 bytes of the text plus `overhead`; `law` is always `key`: key and shard count decide. `slot`
    runs from 0 in each shard; `grown_shard` is the shard with one more shard (of the mean weight). The count of different rows runs
    when the function is called.

    Defined cases: a null text has no bytes (crc32 0); null keys share a shard; rows with the same key share a
    shard and get slots of their own, equal rows next to each other; an empty table gives an empty table; other columns are not read.
    """
    weights = [1.0] * shards if weights is None else list(weights)
    if len(weights) != shards:
        raise ValueError("a weight for each shard is needed")
    place, part, first, copies, n = own_names(docs.select(key_col), "place", "range", "first", "copies", "n")
    raw = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8")
    rows = docs.select(F.col(key_col), (F.length(raw).cast("long") + overhead).alias("size"), F.crc32(raw).alias("text_crc32"))
    kinds = rows.groupBy(key_col, "size", "text_crc32").agg(F.count(F.lit(1)).alias(copies))
    key = F.col(key_col)
    kinds = kinds.withColumns({"shard": rendezvous(key, weights, seed), "grown_shard": rendezvous(key, [*weights, sum(weights) / len(weights)], seed)})
    kinds = written(kinds.withColumn(place, _hash(F.concat_ws(":", F.lit("slot"), _key_text(key), F.col("size"), F.col("text_crc32")))))

    bits = min(BITS, max(0, (kinds.count() // (shards * range_rows)).bit_length()))
    kinds = kinds.withColumn(part, F.shiftright(place, BITS - bits))
    sizes = kinds.groupBy("shard", part).agg(F.sum(copies).alias(n))  # a row for range_rows / 2 rows or so, or for each shard
    before = Window.partitionBy("shard").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(first))
    own = Window.partitionBy("shard", part).orderBy(place, key, "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    placed = kinds.withColumn(n, F.coalesce(F.sum(copies).over(own), F.lit(0))).join(starts, ["shard", part])
    slots = F.sequence(F.lit(0).cast("long"), F.col(copies) - 1)
    numbered = placed.select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col(first) + F.col(n)).alias(first), "grown_shard", F.explode(slots).alias("slot"))
    return numbered.select(key_col, "size", "text_crc32", "law", "shard", (F.col("slot") + F.col(first)).alias("slot"), "grown_shard")
