"""Toxicity by class-conditional Kneser-Ney models.

Two pairs of models, each of toxic and of ordinary texts: one over words, counted once in each document, and one of order `ORDER` over letters.  In both the
classes share the backoff, which comes from continuation counts of both together, so an expression that neither class knows well is about as
likely in both.  A word's evidence is its log-likelihood in the toxic model minus that in the ordinary one.  Log-likelihoods are always compared
for equal lengths: a text has the difference a letter over all its letters, and the largest difference a word over its windows of `WINDOWS` words.
A logistic curve with factors that cannot be negative turns these into the score; it is fitted on the labelled texts that were not counted.

The models are one table that grows with the corpus.  Words and letter groups are counted exactly over all labelled texts of the counting part;
continuation counts, shared probabilities and the evidence of each group follow by aggregations, windows over a context and joins of
one order with the next.  For a group or word that the models have not seen the ratio depends on its context alone, because
the shared backoff cancels.  Tasks get the table by a broadcast while it has at most `BROADCAST` rows (checked), and otherwise by a join: texts are
packed into blocks with the different keys that they need, and each block gets these.  Both ways give the same scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Chunk, chunks, mixed, own_names, with_columns, written

#: Letters of a group, discount, words of the windows.
ORDER, DISCOUNT, WINDOWS = 4, 0.75, (1, 4)
#: Rows of a model that are broadcast (16 bytes each), bytes of text in a block of the other way, groups that a counting task holds.
BROADCAST, BLOCK_BYTES, HELD = 1 << 21, 1 << 24, 1 << 22
#: Marks the keys of contexts and of words among those of groups; key of every word that is not in the table.
CONTEXT, WORD = 1 << 8 * ORDER, 1 << 62
UNSEEN = WORD - 1
#: Width, lowest and highest value of the calibration counts' bins for each statistic.
BINS = ((0.2, -2.0, 2.0), (0.2, -2.0, 10.0), (0.2, -2.0, 10.0))
#: The curve without labels: its constant and factors, and how far labels may draw each.
CURVE, DRAWN = (-14.0, 1.0, 4.0, 0.5), (5.0, 3.0, 2.0, 2.0)
#: Share of labels of each class that the curve takes for wrong, so that these do not flatten it.
NOISE = 0.02

# Bytes: a-z, every byte of other scripts; anything else parts words.
_SYMBOL = np.full(256, 0x20, np.uint8)
_SYMBOL[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_SYMBOL[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_SYMBOL[0x80:] = np.arange(0x80, 0x100)


def _symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all texts with one space before each word, one behind each text and ORDER - 1 before it; offsets of the texts."""
    text = _SYMBOL[data]
    lead = np.zeros(len(data), bool)  # of two bytes that make a Latin letter; the second one stands for it, in lower case
    lead[:-1] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0xBF)
    upper = np.flatnonzero(lead) + 1
    upper = upper[(data[upper] <= 0x9E) & (data[upper] != 0x97)]
    text[upper] += 0x20
    text[lead] = 0  # goes
    text = np.insert(text, offsets[1:], 0x20)
    ends = offsets + np.arange(len(offsets))
    keep = text != 0
    keep[1:] &= (text[1:] != 0x20) | (text[:-1] != 0x20)
    ends = np.concatenate([[0], np.cumsum(keep)])[ends]
    return np.insert(text[keep], np.repeat(ends[:-1], ORDER - 1), 0x20), ends + np.arange(len(ends)) * (ORDER - 1)


def _groups(text: np.ndarray, order: int) -> np.ndarray:
    """The last `order` symbols at each place, packed; the first places have shorter groups."""
    x = text.astype(np.uint64)
    out = x.copy()
    for k in range(1, order):
        out[k:] |= x[:-k] << np.uint64(8 * k)
    return out


def _word_keys(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the words of all texts, the place of each one's first letter, and that behind the last."""
    letter = text != 0x20
    starts = np.flatnonzero(letter & np.concatenate([[True], ~letter[:-1]]))
    stops = np.flatnonzero(letter & np.concatenate([~letter[1:], [True]])) + 1
    return (Chunk(text, ends, 0).hashes(starts, stops) >> np.uint64(2)) | np.uint64(WORD), starts, stops


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group, toxic, ordinary): what this task has counted; words under their keys, once in a text."""
    held: list[tuple[np.ndarray, ...]] = []

    def merged() -> tuple[np.ndarray, ...]:
        group, toxic, ordinary = (np.concatenate(x) for x in zip(*held, strict=True))
        value, inverse = np.unique(group, return_inverse=True)
        return value, *(np.bincount(inverse, weights=x, minlength=len(value)).astype(np.int64) for x in (toxic, ordinary))

    def out() -> pa.RecordBatch:
        group, toxic, ordinary = merged()
        return pa.RecordBatch.from_pydict({"group": group.view(np.int64), "toxic": toxic, "ordinary": ordinary})

    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for chunk in chunks(batch.column(0)):
            text, ends = _symbols(chunk.data, chunk.offsets)
            group = _groups(text, ORDER)
            inside = np.arange(len(text)) - np.repeat(ends[:-1], np.diff(ends)) >= ORDER - 1
            owner = np.repeat(toxic[chunk.first : chunk.first + chunk.n], np.diff(ends))[inside]
            value, inverse = np.unique(group[inside], return_inverse=True)
            held.append((value, *(np.bincount(inverse[of], minlength=len(value)) for of in (owner, ~owner))))
            word, starts, _ = _word_keys(text, ends)
            own = np.searchsorted(ends, starts, "right") - 1
            order = np.lexsort((own, word))
            word, own = word[order], own[order]
            once = np.concatenate([[True], (word[1:] != word[:-1]) | (own[1:] != own[:-1])])[: len(word)]
            value, inverse = np.unique(word[once], return_inverse=True)
            of = toxic[chunk.first + own[once]]
            held.append((value, *(np.bincount(inverse[x], minlength=len(value)) for x in (of, ~of))))
        if len(held) > 16:
            held = [merged()]
            if len(held[0][0]) > HELD:
                yield out()
                held = []
    if held:
        yield out()


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(key, value) from exact counts (group, toxic, ordinary): the log-ratio of the classes' probabilities of each seen group's last letter, and
    under the key of each context (its symbols + CONTEXT) the one of all letters unseen after it.

    No window holds more than the 256 symbols that can follow a context.
    """

    def last(group: Column, k: int) -> Column:
        return group.bitwiseAND(F.lit((1 << 8 * k) - 1))

    levels = {ORDER: counts.select("group")}
    for k in range(ORDER - 1, 0, -1):  # continuation counts: different letters before a group
        levels[k] = levels[k + 1].groupBy(last(F.col("group"), k).alias("group")).agg(F.count(F.lit(1)).alias("n"))
    everything, context = Window.partitionBy(F.lit(0)), Window.partitionBy(F.shiftright("group", 8))
    lower = levels[1].select("group", ((F.col("n") + 0.5) / (F.sum("n").over(everything) + 0.5 * F.count(F.lit(1)).over(everything))).alias("p"))
    for k in range(2, ORDER):
        total, kinds = F.sum("n").over(context), F.count(F.lit(1)).over(context)
        here = levels[k].select("group", last(F.col("group"), k - 1).alias("end"), (F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) / total).alias("own"), (DISCOUNT * kinds / total).alias("left"))
        lower = here.join(lower.select(F.col("group").alias("end"), "p"), "end").select("group", (F.col("own") + F.col("left") * F.col("p")).alias("p"))
    sides = []
    for name in ("toxic", "ordinary"):
        total, kinds = F.sum(name).over(context), F.count(F.when(F.col(name) > 0, 1)).over(context)
        sides += [(F.greatest(F.col(name) - DISCOUNT, F.lit(0.0)) / F.greatest(total, F.lit(1))).alias(f"own_{name}"), F.when(total > 0, DISCOUNT * kinds / total).otherwise(1.0).alias(f"left_{name}")]
    top = counts.select("group", last(F.col("group"), ORDER - 1).alias("end"), *sides).join(lower.select(F.col("group").alias("end"), "p"), "end")
    seen = F.log((F.col("own_toxic") + F.col("left_toxic") * F.col("p")) / (F.col("own_ordinary") + F.col("left_ordinary") * F.col("p")))
    unseen = top.groupBy((F.shiftright("group", 8) + CONTEXT).alias("key")).agg(F.log(F.first("left_toxic") / F.first("left_ordinary")).alias("value"))
    return top.select(F.col("group").alias("key"), seen.alias("value")).union(unseen)


def word_evidence(counts: DataFrame) -> DataFrame:
    """(key, value) from exact counts (group, toxic, ordinary) of words: the log-ratio of the classes' probabilities of each word, and under UNSEEN that of all others.

    Both classes back off to the number of classes that have a word.
    """
    own = counts.agg(*(f(c).alias(f"{n}_{c}") for c in ("toxic", "ordinary") for n, f in (("all", F.sum), ("kinds", lambda c: F.count(F.when(F.col(c) > 0, 1)))))).first()
    kinds = max((own["kinds_toxic"] or 0) + (own["kinds_ordinary"] or 0), 1)
    shared = ((F.col("toxic") > 0).cast("int") + (F.col("ordinary") > 0).cast("int")) / float(kinds)
    sides, left = [], []
    for name in ("toxic", "ordinary"):
        total = own[f"all_{name}"] or 0
        left.append(DISCOUNT * own[f"kinds_{name}"] / total if total else 1.0)
        sides.append(F.greatest(F.col(name) - DISCOUNT, F.lit(0.0)) / float(max(total, 1)) + left[-1] * shared)
    unseen = counts.sparkSession.createDataFrame([(UNSEEN, log(left[0] / left[1]))], "key long, value double")
    return counts.select(F.col("group").alias("key"), F.log(sides[0] / sides[1]).alias("value")).union(unseen)


class Model:
    """Values by key, all of them exact: a hash table whose buckets are runs of sorted arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        cell = self._cell(keys)
        order = np.argsort(cell, kind="stable")
        self.keys, self.values = keys[order].astype(np.uint64), values[order].astype(np.float32)
        self.start = np.searchsorted(cell[order], np.arange((1 << self.bits) + 1)).astype(np.int32)

    def _cell(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values (0 where there is none), and which keys have none."""
        out, missing = np.zeros(len(keys), np.float32), np.ones(len(keys), bool)
        if not len(self.keys):
            return out, missing
        cell = self._cell(keys)
        at, end, todo = self.start[cell], self.start[cell + 1], None
        while True:
            here = at if todo is None else at[todo]
            mine = keys if todo is None else keys[todo]
            same = self.keys[np.minimum(here, len(self.keys) - 1)] == mine
            same &= here < (end if todo is None else end[todo])
            hit = np.flatnonzero(same) if todo is None else todo[same]
            out[hit], missing[hit] = self.values[at[hit]], False
            at += 1
            todo = np.flatnonzero(missing & (at < end))
            if not len(todo):
                return out, missing

    def words(self, text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each word of all texts: evidence of its letters, their number (with the space behind), its evidence as a word; and the words before each text (and in all)."""
        group = _groups(text, ORDER)
        x, missing = self.find(group)
        other = np.flatnonzero(missing)
        x[other] = self.find(_context(group[other]))[0]
        total = np.concatenate([[0.0], np.cumsum(x, dtype=np.float64)])
        keys, starts, stops = _word_keys(text, ends)
        stops = np.minimum(stops + 1, len(x))
        value, missing = self.find(keys)
        value[missing] = self.find(np.array([UNSEEN], np.uint64))[0][0]
        return total[stops] - total[starts], stops - starts, value.astype(np.float64), np.searchsorted(starts, ends)


def _context(group: np.ndarray) -> np.ndarray:
    return (group >> np.uint64(8)) + np.uint64(CONTEXT)


def _best_windows(value: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """For each text the largest mean of `size` values in a row; of all its values if they are fewer (as if zeros followed), 0 without any."""
    n = np.diff(first)
    out = np.zeros(len(n))
    total = np.concatenate([[0.0], np.cumsum(value)])
    start = np.arange(len(value))
    owner = np.repeat(np.arange(len(n)), n)
    end = np.minimum(start + size, first[1:][owner]) if len(value) else start
    whole = (end - start == size) | (start == first[:-1][owner]) if len(value) else np.zeros(0, bool)
    sums = (total[end] - total[start])[whole] / size
    out[n > 0] = np.maximum.reduceat(sums, np.searchsorted(np.flatnonzero(whole), first[:-1][n > 0])) if len(sums) else 0
    return out


def statistic(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text: log-likelihood ratio a letter over the whole text, and the largest a word over its windows of each of WINDOWS words; 0 without words."""
    text, ends = _symbols(data, offsets)
    if not len(text):
        return np.zeros((len(offsets) - 1, len(BINS)))
    letters, length, value, first = model.words(text, ends)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole = np.bincount(owner, weights=letters, minlength=len(first) - 1) / np.maximum(np.bincount(owner, weights=length, minlength=len(first) - 1), 1)
    return np.stack([whole, *(_best_windows(value, first, size) for size in WINDOWS)], axis=1)


def _rows(model: Model, text: pa.Array, rest: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(text):
        x = statistic(model, chunk.data, chunk.offsets)
        yield with_columns(rest.slice(chunk.first, chunk.n), **{f"x{k}": np.ascontiguousarray(x[:, k]) for k in range(x.shape[1])})


def _by_broadcast(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _rows(shared.value, batch.column(batch.num_columns - 1), batch.select(list(range(batch.num_columns - 1))))

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rows, keys): a compressed block of rows, its last column the text, and the different keys that its texts need."""
    held: list[pa.RecordBatch] = []
    keys, size = np.zeros(0, np.uint64), 0

    def out() -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            for part in held:
                writer.write_batch(part)
        return pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([keys.view(np.int64)], pa.list_(pa.int64()))], ["rows", "keys"])

    for batch in batches:
        for chunk in chunks(batch.column(batch.num_columns - 1)):
            text, ends = _symbols(chunk.data, chunk.offsets)
            group = np.unique(_groups(text, ORDER))
            keys = np.unique(np.concatenate([keys, group, _context(group), _word_keys(text, ends)[0], np.array([UNSEEN], np.uint64)]))
            held.append(batch.slice(chunk.first, chunk.n))
            size += len(chunk.data)
            if size >= BLOCK_BYTES:
                yield out()
                held, keys, size = [], np.zeros(0, np.uint64), 0
    if held:
        yield out()


def _by_block(left: pa.Table, right: pa.Table) -> pa.Table:
    model = Model(right.column("key").to_numpy(), right.column("value").to_numpy())
    out = []
    for data in left.column("rows"):
        for batch in pa.ipc.open_stream(data.as_buffer()):
            out += _rows(model, batch.column(batch.num_columns - 1), batch.select(list(range(batch.num_columns - 1))))
    return pa.Table.from_batches(out)


def _statistics(rows: DataFrame, model: DataFrame, shared) -> DataFrame:
    """The columns of `rows` but its last, the text, and its statistics; `shared` is the broadcast model, or None."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1]) + "".join(f", x{k} double" for k in range(len(BINS)))
    if shared is not None:
        return rows.mapInArrow(_by_broadcast(shared), schema)
    blocks = written(rows.mapInArrow(_blocks, "rows binary, keys array<long>").withColumn("block", F.monotonically_increasing_id()))
    found = blocks.select(F.col("block").alias("of"), F.explode("keys").alias("key")).join(model, "key").select("of", "key", "value")
    return blocks.select("block", "rows").groupBy("block").cogroup(found.groupBy("of")).applyInArrow(_by_block, schema)


def fit_curve(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Constant and factors of the logistic curve for n texts of statistics x and label y, drawn to CURVE where there are few. No factor is negative."""
    start, hold = np.array(CURVE), 1 / np.array(DRAWN) ** 2
    full = np.concatenate([np.ones((len(x), 1)), x], axis=1)

    def seen(beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of a label 1, and its slope."""
        p = 1 / (1 + np.exp(-np.clip(full @ beta, -60, 60)))
        return NOISE + (1 - 2 * NOISE) * p, (1 - 2 * NOISE) * p * (1 - p)

    def loss(beta: np.ndarray) -> float:
        q = seen(beta)[0]
        return float(-(n * (y * np.log(q) + (1 - y) * np.log(1 - q))).sum() + (hold * (beta - start) ** 2).sum() / 2)

    beta, free = start.copy(), np.ones(len(start), bool)
    while True:
        for _ in range(100):
            q, slope = seen(beta)
            g = (full.T @ (n * (y - q) * slope / (q * (1 - q))) - hold * (beta - start))[free]
            step = np.zeros(len(beta))
            step[free] = np.linalg.solve(((full * (n * slope**2 / (q * (1 - q)))[:, None]).T @ full + np.diag(hold))[np.ix_(free, free)], g)
            while loss(beta + step) > loss(beta) and np.abs(step).max() > 1e-9:
                step /= 2
            beta = beta + step
            if np.abs(step).max() < 1e-8:
                break
        below = np.flatnonzero(beta[1:] < 0) + 1
        if not len(below):
            return beta
        free[below], beta[below] = False, 0.0  # a likelihood that speaks for toxic can't speak against it


def train(labelled: DataFrame, text: str, toxic: str, part: Column) -> tuple[DataFrame, object, np.ndarray]:
    """Model table, its broadcast (None if it is too large) and curve from labelled texts; those where `part` is 0 (of 0 to 4) fit the curve, the others are counted."""
    rows = labelled.where(F.col(text).isNotNull() & F.col(toxic).isNotNull())
    one = (F.col(toxic) > 0).cast("int")
    counts = rows.where(part != 0).select(F.col(text), one).mapInArrow(_count, "group long, toxic long, ordinary long")
    counts = written(counts.groupBy("group").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")))
    model = written(kneser_ney(counts.where(F.col("group") < WORD)).union(word_evidence(counts.where(F.col("group") >= WORD))))
    shared = None
    if model.count() <= BROADCAST:
        table = model.toArrow()
        shared = labelled.sparkSession.sparkContext.broadcast(Model(table.column("key").to_numpy(), table.column("value").to_numpy()))
    tried = _statistics(rows.where(part == 0).select(one.alias("y"), F.col(text).alias("text")), model, shared)
    binned = [F.floor(F.greatest(F.least(F.col(f"x{k}"), F.lit(high)), F.lit(low)) / width).alias(f"b{k}") for k, (width, low, high) in enumerate(BINS)]
    bins = sorted(tried.groupBy(*binned, "y").agg(F.count(F.lit(1)).alias("n")).collect())  # a fixed number of bins at most
    x = np.array([[(r[f"b{k}"] + 0.5) * b[0] for k, b in enumerate(BINS)] for r in bins], np.float64).reshape(-1, len(BINS))
    y, n = (np.array([r[k] for r in bins], np.float64) for k in ("y", "n"))
    return model, shared, fit_curve(x, y, n)


def score_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic", threshold: float = 0.7) -> DataFrame:
    """(id, held_out, score, predicted) for each row of `docs`.

    Labels are learnt only from rows whose crc32 of the id as text, modulo 3, is not 1. `score` is between 0 and 1.

    Defined cases: a null or empty text, or one without letters, has no evidence for either class (statistic 0); a null id
    is held out and is never learnt from; repeated rows of documents or labels count each time they join; without usable labels the curve
    and an even model remain; an empty table gives an empty table; other columns are not read.
    """
    (name,) = own_names(docs, "text")
    crc = F.crc32(F.col("id").cast("string").cast("binary"))
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias(name))
    seen = given.where(F.pmod(crc, F.lit(3)) != 1)
    marks = labels.select(F.col(id_col).alias("id"), F.col(toxic_col).alias("toxic")).where("toxic IS NOT NULL")
    part = F.pmod(F.floor(crc / 3), F.lit(5))
    # labels have no size bound, so they are never broadcast
    model, shared, curve = train(seen.join(marks.where(F.pmod(crc, F.lit(3)) != 1).hint("merge"), "id"), name, "toxic", part)
    found = _statistics(given.select("id", F.coalesce(F.pmod(crc, F.lit(3)) == 1, F.lit(True)).alias("held_out"), name), model, shared)
    odds = sum((float(b) * F.col(f"x{k}") for k, b in enumerate(curve[1:])), F.lit(float(curve[0])))
    scored = found.select("id", "held_out", (1 / (1 + F.exp(-odds))).alias("score"))
    return scored.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
