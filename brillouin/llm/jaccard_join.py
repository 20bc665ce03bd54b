r"""Exact n-gram Jaccard join with set-relation skipping.

A document is the set of its word n-grams (as 64-bit hashes).  Equal sets are collapsed first; what is left is
joined as follows, all of it exact for the given threshold.

1. Order. Shingles are ordered by (how often their cell of a counter table occurs, hash), rare ones first. The table grows with
   the corpus and only changes speed; a task's count of a cell goes up to 255.
   Two sets over the threshold share a shingle among the first n - ceil(t n) + 1 of each (prefix filter).
2. Index. The prefix entries (shingle, set, size, position) are shuffled by shingle: the index lists. A list is sorted by size, then
   position, so sets of one size are a block in order of position. A set skips every block whose size rules the threshold out, or whose
   first position does; in the other blocks it stops at the last position that leaves enough shingles for the threshold.
3. Short lists give candidate pairs. Lists of more than `SHORT` sets are families of near copies (positions skip nothing there): their sets are
   linked into families, and a family is joined block against block (`BLOCK` sets), every pair once however many lists it shares.
4. Answers. In a family's block pair, the overlaps of a set with all others are derived from those of the
   set before it, by the index lists of the shingles in which the two differ.  Only links that join two groups leave a
   task, so a family of n sets gives fewer than n links for each of its block pairs.
5. Candidate pairs are verified on the whole texts; links and forests give the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components, forest
from .shared import Chunk, chunks, mixed, tidied, written

#: log2 of the least and most counter cells and of those on a page; characters of a corpus for a cell.
LEAST_BITS, MOST_BITS, PAGE_BITS, CELL_CHARS = 20, 24, 14, 128
#: Sets of a short list; sets and shingles of a family's block.
SHORT, BLOCK, BLOCK_SHINGLES = 48, 1024, 800_000
#: Ids of candidates that are broadcast to their texts (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1 << 20

_FOLD = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(chunk: Chunk, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the n-word shingles of all texts, text by text in ascending order, and each text's offsets.

    A text of fewer words has its whole word sequence as its one shingle; a text without words has none.
    """
    starts, ends, first = chunk.words()
    words = chunk.hashes(starts, ends, lower=True)
    count = np.diff(first)
    row = np.repeat(np.arange(chunk.n), count)
    with np.errstate(over="ignore"):
        full = max(0, len(words) - n + 1)
        value = np.zeros(full, np.uint64)
        for k in range(n):
            value = value * _FOLD + words[k : k + full]
        inside = np.flatnonzero(row[:full] == row[n - 1 :][:full]) if full else np.zeros(0, np.int64)
        short = np.flatnonzero((count > 0) & (count < n))
        whole = np.zeros(len(short), np.uint64)
        for k in range(n - 1):
            there = count[short] > k
            whole[there] = whole[there] * _FOLD + words[first[short[there]] + k]
        value = mixed(np.concatenate([value[inside], whole * _FOLD + count[short].astype(np.uint64)]))
    owner = np.concatenate([row[inside], short])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.searchsorted(owner[new], np.arange(chunk.n + 1))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values of each text, modulo 2**64."""
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return total[offsets[1:]] - total[offsets[:-1]]


def counter_bits(docs: DataFrame, text: str) -> int:
    """log2 of the counter cells for these documents."""
    chars = docs.agg(F.sum(F.length(text)).alias("n")).first()["n"] or 0
    return min(MOST_BITS, max(LEAST_BITS, (chars // CELL_CHARS).bit_length()))


def _signatures(n: int, bits: int):
    """Rows (id, size, two 64-bit sums that stand for the set), then the task's counter pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                value, offsets = shingle_sets(chunk, n)
                at, count = np.unique((value >> np.uint64(64 - bits)).astype(np.int64), return_counts=True)
                cells[at] += count.astype(np.uint32)
                with np.errstate(over="ignore"):
                    other = mixed(value ^ _FOLD)
                m = chunk.n
                yield pa.RecordBatch.from_pydict({"id": batch.column(0).slice(chunk.first, m).cast(pa.int64()), "n": np.diff(offsets).astype(np.int64), "s1": _sums(value, offsets).view(np.int64), "s2": _sums(other, offsets).view(np.int64), "page": pa.nulls(m, pa.int32()), "counts": pa.nulls(m, pa.binary())})
        one = pa.nulls(1, pa.int64())
        for page in range(1 << bits - PAGE_BITS):
            part = np.minimum(cells[page << PAGE_BITS : (page + 1) << PAGE_BITS], 255).astype(np.uint8)
            if part.any():
                yield pa.RecordBatch.from_pydict({"id": one, "n": one, "s1": one, "s2": one, "page": pa.array([page], pa.int32()), "counts": pa.array([part.tobytes()], pa.binary())})

    return run


def _summed_page(pages: pa.Table) -> pa.Table:
    total = np.zeros(1 << PAGE_BITS, np.int64)
    for data in pages.column("counts"):
        raw = data.as_py()
        total += np.frombuffer(raw, np.uint8 if len(raw) == len(total) else "<u4")
    return pa.table({"page": pages.column("page")[:1], "counts": pa.array([np.minimum(total, 2**32 - 1).astype("<u4").tobytes()], pa.binary())})


def _cell_ranks(rows: DataFrame, bits: int) -> np.ndarray:
    """How common each cell is over all documents, 0 to 255 on a logarithmic scale: 2 ** bits bytes, 16 MB at most."""
    pages = rows.where(F.col("page").isNotNull()).select("page", "counts")
    salted = pages.groupBy("page", (F.spark_partition_id() % 16).alias("salt")).applyInArrow(_summed_page, "page int, counts binary")
    out = np.zeros(1 << bits, np.uint8)
    for page in salted.groupBy("page").applyInArrow(_summed_page, "page int, counts binary").toLocalIterator():
        count = np.frombuffer(page["counts"], "<u4")
        out[page["page"] << PAGE_BITS : (page["page"] + 1) << PAGE_BITS] = np.minimum(255, 8 * np.log2(1.0 + count))
    return out


def _prefixes(n: int, num: int, den: int, bits: int, shared):
    """(id, size, positions and hashes of the prefix), a row for each text with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                value, offsets = shingle_sets(chunk, n)
                size = np.diff(offsets)
                owner = np.repeat(np.arange(chunk.n), size)
                order = np.lexsort((value, cells[(value >> np.uint64(64 - bits)).astype(np.int64)], owner))
                at = np.arange(len(value)) - offsets[owner]
                length = size - (num * size + den - 1) // den + 1
                kept = np.flatnonzero(at < length[owner])
                per_text = np.where(size > 0, length, 0)
                ends = np.concatenate([[0], np.cumsum(per_text)])
                some = np.flatnonzero(size > 0)
                data = value[order][kept].view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(ends[np.concatenate([some, [chunk.n]])].astype(np.int32)), pa.array(data))
                yield pa.RecordBatch.from_pydict({"id": batch.column(0).slice(chunk.first, chunk.n).cast(pa.int64()).take(pa.array(some)), "size": size[some].astype(np.int32), "prefix": lists})

    return run


def _ratio_ok(small: np.ndarray, large: np.ndarray, num: int, den: int) -> np.ndarray:
    return den * small >= num * large


def _lists(num: int, den: int):
    """Candidate pairs of short lists, chains of long ones. The rows come sorted by (shingle, size, position, id)."""

    def pairs_of(token: np.ndarray, ids: np.ndarray, size: np.ndarray, pos: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        if not len(token):
            return
        edge = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1], [True]]))
        length = np.diff(edge)
        listed = np.repeat(length, length)
        left = np.repeat(edge[1:], length) - np.arange(len(token)) - 1  # entries of the list behind this one
        near = np.flatnonzero((listed > SHORT) & (left > 0))
        near = near[_ratio_ok(size[near], size[near + 1], num, den)]
        yield ids[near], ids[near + 1], np.ones(len(near), bool)

        # blocks: entries of a list with sets of one size, in order of position
        start = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (size[1:] != size[:-1])]))
        block = np.searchsorted(start, np.arange(len(token)), "right") - 1
        last = np.searchsorted(start, np.repeat(edge[1:], length)) - 1  # last block of an entry's list
        wide = int(pos.max()) + 2
        place = block * wide + pos
        here, step = np.flatnonzero((listed <= SHORT) & (left > 0)), 0
        while len(here):
            b = block[here] + step
            here = here[b <= last[here]]
            b = block[here] + step
            small, large = size[here], size[start[b]]
            fits = _ratio_ok(small, large, num, den)
            here, b, small, large = here[fits], b[fits], small[fits], large[fits]
            need = -(-num * (small + large) // (num + den))  # shingles in common
            low = np.where(step == 0, here + 1, start[b])
            high = np.searchsorted(place, b * wide + np.clip(large - need, -1, wide - 2), "right")
            n = np.where(small - pos[here] >= need, np.maximum(high - low, 0), 0)
            i = np.repeat(here, n)
            j = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
            yield ids[i], ids[j], np.zeros(len(i), bool)
            step += 1

    def chain(ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        near = np.flatnonzero(_ratio_ok(size[:-1], size[1:], num, den))
        return ids[near], ids[near + 1], np.ones(len(near), bool)

    def emitted(found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
        a, b, family = found
        real = a != b
        if real.any():
            a, b = a[real], b[real]
            yield pa.RecordBatch.from_pydict({"a": np.minimum(a, b), "b": np.maximum(a, b), "family": family[real]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 4  # the list that is not yet at its end
        end: tuple[int, np.ndarray, np.ndarray] | None = None  # of a long list: shingle, id and size of its last entry
        for batch in batches:
            rows = [np.concatenate([h, c.to_numpy(zero_copy_only=False).astype(np.int64)]) for h, c in zip(held, batch.columns, strict=True)]
            if not len(rows[0]):
                continue
            if end:
                more = int(np.searchsorted(rows[0], end[0], "right"))
                ids, size = np.concatenate([end[1], rows[1][:more]]), np.concatenate([end[2], rows[2][:more]])
                yield from emitted(chain(ids, size))
                end = (end[0], ids[-1:], size[-1:])
                rows = [x[more:] for x in rows]
                if not len(rows[0]):
                    held = rows
                    continue
                end = None
            last = int(np.searchsorted(rows[0], rows[0][-1]))
            for found in pairs_of(*(x[:last] for x in rows)):
                yield from emitted(found)
            held = [x[last:] for x in rows]
            if len(held[0]) > SHORT:
                yield from emitted(chain(held[1], held[2]))
                end = (int(held[0][0]), held[1][-1:], held[2][-1:])
                held = [x[:0] for x in held]
        for found in pairs_of(*held):
            yield from emitted(found)

    return run


def linked_forest(ids: np.ndarray, value: np.ndarray, offsets: np.ndarray, num: int, den: int, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Forest of the links within some sets; with `side`, only pairs of different sides are compared.

    Sets are taken by size. The overlaps of a set come from those of the set before it where fewer shingles
    differ than the set has. Lists are read whole, so that overlaps stay right for the sets to come; sizes cut what is tested.
    """
    size = np.diff(offsets)
    order = np.argsort(size, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    token, dense = np.unique(value, return_inverse=True)
    owner = rank[np.repeat(np.arange(len(size)), size)]
    by_list = np.lexsort((owner, dense))
    posting, start = owner[by_list], np.searchsorted(dense[by_list], np.arange(len(token) + 1))
    sizes = size[order]

    def added(tokens: np.ndarray) -> np.ndarray:
        length = start[tokens + 1] - start[tokens]
        at = np.repeat(start[tokens] - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
        return np.bincount(posting[at], minlength=len(sizes))

    left, right = [], []
    before = overlap = None
    for i, k in enumerate(order.tolist()):
        mine = dense[offsets[k] : offsets[k + 1]]
        more = fewer = None
        if before is not None:
            more, fewer = np.setdiff1d(mine, before, assume_unique=True), np.setdiff1d(before, mine, assume_unique=True)
        if more is not None and len(more) + len(fewer) < len(mine):
            overlap = overlap + added(more) - added(fewer)
        else:
            overlap = added(mine)
        before = mine
        low = int(np.searchsorted(den * sizes[:i], num * sizes[i]))  # sets before are no larger
        both = overlap[low:i]
        hit = low + np.flatnonzero((den + num) * both >= num * (sizes[low:i] + sizes[i]))
        if side is not None:
            hit = hit[side[order[hit]] != side[k]]
        left.append(np.full(len(hit), k))
        right.append(order[hit])
    a, b = np.concatenate(left), np.concatenate(right)
    return forest(ids[a], ids[b]) if len(a) else (ids[:0], ids[:0])


def _family_links(n: int, num: int, den: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids = group.column("id").to_numpy()
        block = group.column("block").to_numpy()
        values, sizes = [], []
        for part in group.column("text").chunks:
            for chunk in chunks(part):
                value, offsets = shingle_sets(chunk, n)
                values.append(value)
                sizes.append(np.diff(offsets))
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        one = group.column("i")[0].as_py() == group.column("j")[0].as_py()
        a, b = linked_forest(ids, np.concatenate(values), offsets, num, den, None if one else block)
        return pa.table({"a": a, "b": b})

    return run


def _verified(n: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for name in ("text_a", "text_b"):
                mine = []
                for chunk in chunks(batch.column(batch.schema.get_field_index(name))):
                    value, offsets = shingle_sets(chunk, n)
                    mine += np.split(value, offsets[1:-1])
                sets.append(mine)
            both = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*sets, strict=True)], np.int64)
            size = np.array([len(x) + len(y) for x, y in zip(*sets, strict=True)], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array((den + num) * both >= num * size, pa.bool_()))

    return run


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    r"""(id, n_shingles, component_id) for each row: documents linked, directly or over others, at a Jaccard index >= threshold.

    A-Z are lower-cased, words are `[^\x20\x09-\x0D]+`; `threshold` is (numerator, denominator), compared in integers.
    `component_id` is the smallest id of the component.

    Defined cases: a text without words (null, empty, white space) has no shingles and is linked with nothing; a text
    of fewer than n words is one shingle; equal sets are linked; a row with a null id gets a null component and is linked with nothing; rows
    that repeat an id are placed by their own text (the table is written once more with numbered rows then); an empty table gives an
    empty table; other columns are not read. Ids are whole numbers. The join runs when the function is called.
    """
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    if given.where("id IS NOT NULL").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return _components(given, n, *threshold).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
    keyed = written(given.withColumn("row", F.monotonically_increasing_id()))
    rows = written(_components(keyed.select(F.when(F.col("id").isNotNull(), F.col("row")).alias("id"), "text"), n, *threshold).withColumnRenamed("id", "row"))
    nameless = rows.where("row IS NULL").select(F.lit(None).cast("long").alias("id"), "n", F.lit(None).cast("long").alias("component"))
    named = keyed.where("id IS NOT NULL").select("row", "id").join(rows, "row")
    least = named.groupBy("component").agg(F.min("id").alias("least"))
    out = named.join(least, "component").select("id", "n", F.col("least").alias("component")).union(nameless)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def _components(given: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(id, n, component) of rows (id, text) whose ids are different or null."""
    spark = given.sparkSession
    bits = counter_bits(given, "text")
    rows = written(given.mapInArrow(tidied(_signatures(n, bits)), "id long, n long, s1 long, s2 long, page int, counts binary"))
    shared = spark.sparkContext.broadcast(_cell_ranks(rows, bits))
    sets = rows.where(F.col("page").isNull()).select("id", "n", "s1", "s2")
    real = sets.where("n > 0 AND id IS NOT NULL")
    groups = written(real.groupBy("n", "s1", "s2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    reps = groups.select(F.col("rep").alias("id"), F.col("n").cast("int").alias("size"))

    entries = given.where("id IS NOT NULL").mapInArrow(tidied(_prefixes(n, num, den, bits, shared)), "id long, size int, prefix array<long>").join(reps, ["id", "size"], "left_semi")
    entries = entries.select("id", "size", F.posexplode("prefix").alias("pos", "token"))
    lists = entries.select("token", "id", "size", "pos").repartition("token").sortWithinPartitions("token", "size", "pos", "id")
    found = written(lists.mapInArrow(tidied(_lists(num, den)), "a long, b long, family boolean").distinct())

    # texts are read once for all candidates, which are representatives
    pairs = found.where("NOT family").select("a", "b")
    member = written(components(found.where("family").select("a", "b")).withColumnRenamed("node", "id"))
    wanted = written(pairs.select(F.explode(F.array("a", "b")).alias("id")).union(member.select("id")).distinct())
    few = wanted.count() <= BROADCAST_IDS
    involved = written(given.join(F.broadcast(wanted) if few else wanted, "id", "left_semi"))
    links = _pair_links(pairs, involved, n, num, den).union(_family_forests(member, involved, reps, n, num, den))
    joined = components(links)
    named = groups.join(joined.withColumnRenamed("node", "rep"), "rep", "left").select("n", "s1", "s2", F.coalesce("component", "rep").alias("component"))
    # sets that only one row has are their own; the others look their component up
    out = sets.join(named, ["n", "s1", "s2"], "left")
    return out.select("id", "n", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))


def _pair_links(pairs: DataFrame, involved: DataFrame, n: int, num: int, den: int) -> DataFrame:
    one = pairs.join(involved.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    two = one.join(involved.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return two.select("a", "b", "text_a", "text_b").mapInArrow(tidied(_verified(n, num, den)), "a long, b long")


def _family_forests(member: DataFrame, involved: DataFrame, reps: DataFrame, n: int, num: int, den: int) -> DataFrame:
    total = member.join(reps, "id").groupBy("component").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    member = member.join(total, "component").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    placed = involved.join(member, "id").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keyed = placed.select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "text")
    return keyed.groupBy("component", "i", "j").applyInArrow(_family_links(n, num, den), "a long, b long")
