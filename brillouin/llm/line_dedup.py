"""Line dedup with two Bloom filters.

Pass 1 reads every text and keeps, for each task, two bit arrays: cells of keys seen once and cells of
keys seen (at least) twice.  The arrays of all tasks are merged page by page in a shuffle of fixed-size
pages: a cell counts as seen twice if a task saw it twice or if two tasks saw it.  A key can only occur
in two documents if all its cells are in the second array, so no repeat is missed.  Pass 2 lets only
the suspected keys through; they alone shuffle, as 128-bit BLAKE2b digests with their doc_id, and are
counted exactly.  Lines of a confirmed key stay in the largest doc_id that holds it and go elsewhere.

The arrays have `CELLS_A_KEY` cells for each line that can count, from a first count of lines and characters, between
2 ** LEAST_BITS and 2 ** MOST_BITS; at most 128 MB of bits are broadcast.  When a corpus has over 2 ** MOST_BITS / CELLS_A_KEY keys,
more keys are suspected and more digests shuffle; the result stays exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Chunk, by_chunk, chunks, mixed, own_names, tidied, with_columns, without, written

#: Cells of each Bloom filter for a key, log2 of the least and most cells, cells that a key takes, log2 of the cells of a page.
CELLS_A_KEY, LEAST_BITS, MOST_BITS, BLOOM_CELLS, PAGE_BITS = 4, 20, 30, 2, 18


def _keys(chunk: Chunk, min_chars: int) -> dict[str, np.ndarray]:
    """Lines of the chunk, with those long enough to count."""
    starts, ends, first = chunk.lines()
    a, b = chunk.stripped(starts, ends)
    points = chunk.code_points()
    counted = np.flatnonzero(points[b] - points[a] >= min_chars)
    row = np.searchsorted(first, counted, "right") - 1
    return {"starts": starts, "ends": ends, "first": first, "counted": counted, "row": row, "a": a[counted], "b": b[counted], "hash": chunk.hashes(a[counted], b[counted], lower=True)}


def _once_per_text(row: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Index of the first line with each (text, hash)."""
    order = np.lexsort((hashes, row))
    new = np.ones(len(order), bool)
    new[1:] = (row[order][1:] != row[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    return np.sort(order[new])


def _cells(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The cells of each hash: a list of arrays."""
    with np.errstate(over="ignore"):
        return [(mixed(hashes + np.uint64(k * 0x632BE59BD9B4E019 % 2**64)) >> np.uint64(64 - bits)).astype(np.int64) for k in range(BLOOM_CELLS)]


def filter_bits(docs: DataFrame, text: str = "text", min_chars: int = 20) -> int:
    """log2 of the cells of a filter for these documents: no key is shorter than `min_chars`, and no line has more than one."""
    chars = F.length(F.col(text).cast("string"))
    lines = 1 + F.regexp_count(F.col(text).cast("string"), F.lit("\n"))
    row = docs.select(F.sum(F.least(lines, F.floor((chars + 1) / (min_chars + 1)))).alias("n")).first()
    return min(MOST_BITS, max(LEAST_BITS, (CELLS_A_KEY * (row["n"] or 0)).bit_length()))


def _set(bits: np.ndarray, cells: np.ndarray) -> None:
    cells = np.sort(cells)
    at = cells >> 3
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else at
    if len(first):
        bits[at[first]] |= np.bitwise_or.reduceat(np.uint8(128) >> (cells & 7).astype(np.uint8), first)


def _get(bits: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (bits[cells >> 3] & (np.uint8(128) >> (cells & 7).astype(np.uint8))) != 0


def _thin(bits: np.ndarray) -> bytes:
    """A page as it is, or places and values of its bytes where few are not 0."""
    some = np.flatnonzero(bits)
    return bits.tobytes() if 3 * len(some) >= len(bits) else some.astype("<u2").tobytes() + bits[some].tobytes()


def _wide(data: bytes, size: int) -> np.ndarray:
    if len(data) == size:
        return np.frombuffer(data, np.uint8)
    n, out = len(data) // 3, np.zeros(size, np.uint8)
    out[np.frombuffer(data, "<u2", n)] = np.frombuffer(data, np.uint8, n, 2 * n)
    return out


def _page_bytes(bits: int) -> int:
    return (1 << min(PAGE_BITS, bits)) // 8


def _filters(text: str, min_chars: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = twice = None
        for batch in batches:
            for chunk in chunks(batch.column(batch.schema.get_field_index(text))):
                lines = _keys(chunk, min_chars)
                hashes = lines["hash"][_once_per_text(lines["row"], lines["hash"])]
                if not len(hashes):
                    continue
                if once is None:
                    once, twice = np.zeros(1 << bits - 3, np.uint8), np.zeros(1 << bits - 3, np.uint8)
                distinct, count = np.unique(hashes, return_counts=True)
                cells = _cells(distinct, bits)
                again = (count > 1) | np.logical_and.reduce([_get(once, c) for c in cells])
                _set(twice, np.concatenate([c[again] for c in cells]))
                _set(once, np.concatenate(cells))
        if once is None:
            return
        size = _page_bytes(bits)
        for page in range(len(once) // size):
            part = slice(page * size, (page + 1) * size)
            if once[part].any():
                yield pa.RecordBatch.from_pydict({"page": pa.array([page], pa.int32()), "once": pa.array([_thin(once[part])], pa.binary()), "twice": pa.array([_thin(twice[part])], pa.binary())})

    return run


def _merging(size: int):
    def merged(pages: pa.Table) -> pa.Table:
        once, twice = np.zeros(size, np.uint8), np.zeros(size, np.uint8)
        for a, b in zip(pages.column("once"), pages.column("twice"), strict=True):
            a, b = _wide(a.as_py(), size), _wide(b.as_py(), size)
            twice |= b | (once & a)
            once |= a
        return pa.table({"page": pages.column("page")[:1], "once": pa.array([_thin(once)], pa.binary()), "twice": pa.array([_thin(twice)], pa.binary())})

    return merged


_PAGE = "page int, once binary, twice binary"


def seen_twice(docs: DataFrame, text: str = "text", min_chars: int = 20, bits: int | None = None) -> tuple[np.ndarray, int]:
    """The second Bloom filter over all lines, as packed bits, and the log2 of its cells (None: `filter_bits`).

    Pages are merged in two steps (by page and a salt, then by page), so that no task reads the pages of all tasks.
    """
    bits = filter_bits(docs, text, min_chars) if bits is None else bits
    size = _page_bytes(bits)
    pages = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(tidied(_filters("text", min_chars, bits)), _PAGE)
    salted = pages.groupBy("page", (F.spark_partition_id() % 16).alias("salt")).applyInArrow(_merging(size), _PAGE)
    out = np.zeros((1 << bits) // 8, np.uint8)
    for page in salted.groupBy("page").applyInArrow(_merging(size), _PAGE).select("page", "twice").toLocalIterator():
        out[page["page"] * size : (page["page"] + 1) * size] = _wide(page["twice"], size)
    return out, bits


def _suspects(min_chars: int, bits: int, shared):
    def work(chunk: Chunk, rows: pa.RecordBatch) -> pa.RecordBatch | None:
        lines = _keys(chunk, min_chars)
        twice = shared.value
        suspected = np.ones(len(lines["hash"]), bool)
        for c in _cells(lines["hash"], bits):
            suspected &= _get(twice, c)
        at = np.flatnonzero(suspected)
        at = at[_once_per_text(lines["row"][at], lines["hash"][at])]
        if not len(at):
            return None
        raw = chunk.data.tobytes()
        digests = [blake2b(raw[a:b].lower(), digest_size=16).digest() for a, b in zip(lines["a"][at].tolist(), lines["b"][at].tolist(), strict=True)]
        return pa.RecordBatch.from_pydict({"id": rows.column(0).take(pa.array(lines["row"][at])), "hash": pa.array(lines["hash"][at].view(np.int64)), "digest": pa.array(digests, pa.binary())})

    return by_chunk(work, "text")


def _kept(text: str, drop: str, names: tuple[str, str, str], min_chars: int):
    def work(chunk: Chunk, rows: pa.RecordBatch) -> pa.RecordBatch:
        dropped = rows.column(rows.schema.get_field_index(drop))
        first = chunk.lines()[2]
        n_lines = np.diff(first)
        n_dropped = np.zeros(chunk.n, np.int64)
        texts = rows.column(rows.schema.get_field_index(text)).fill_null("")
        if dropped.null_count < len(dropped):
            lines = _keys(chunk, min_chars)
            length = dropped.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            # (row, hash) pairs to drop, against those of the lines
            pairs = np.rec.fromarrays([np.repeat(np.arange(chunk.n), length), dropped.flatten().to_numpy(zero_copy_only=False).view(np.uint64)], names="r,h")
            here = np.rec.fromarrays([lines["row"], lines["hash"]], names="r,h")
            gone = lines["counted"][np.isin(here, pairs)] if len(pairs) else np.zeros(0, np.int64)
            n_dropped = np.bincount(np.searchsorted(first, gone, "right") - 1, minlength=chunk.n)
            changed = np.flatnonzero(n_dropped)
            if len(changed):
                new = texts.to_pylist()
                drop_line = np.zeros(first[-1], bool)
                drop_line[gone] = True
                for i in changed.tolist():
                    parts = new[i].split("\n")
                    new[i] = "\n".join(p for p, out in zip(parts, drop_line[first[i] : first[i + 1]].tolist(), strict=True) if not out)
                texts = pa.array(new, texts.type)
        keep = [k for k, name in enumerate(rows.schema.names) if name != drop]
        return with_columns(rows.select(keep), **{names[0]: n_lines, names[1]: n_dropped, names[2]: texts})

    return by_chunk(work, text)


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3, bits: int | None = None, names: tuple[str, str, str] = ("n_lines", "n_dropped", "kept_text")) -> DataFrame:
    r"""All rows of `docs` with three more columns: lines before, lines dropped, and the text that is left.

    A line's key is the line without white space ([\x20\x09-\x0D]) at both ends and with A-Z in lower case.
    Keys of at least `min_chars` code points that at least `min_docs` documents hold lose all their lines
    except in the largest id that holds them. `bits`: log2 of the filters' cells (None: by the size of the corpus). The counts run
    when the function is called. Lines of a text are told apart by 64-bit hashes, keys of the corpus by 128-bit digests.

    Defined cases: a null or empty text is one empty line; a null id counts as a document of its own and as the
    smallest id; rows that repeat an id count as documents each and are treated alike; within
    a document a key counts once; an empty table gives an empty table; other columns pass through, but for those
    named like a result column, which it replaces.
    """
    spark = docs.sparkSession
    docs = without(docs, *names)
    (drop,) = own_names(docs, "drop")
    twice, bits = seen_twice(docs, text_col, min_chars, bits)
    shared = spark.sparkContext.broadcast(twice)  # 2 ** MOST_BITS bits at most
    kind = docs.schema[id_col].dataType.simpleString()
    suspects = written(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_suspects(min_chars, bits, shared), f"id {kind}, hash long, digest binary"))
    # written, so that the join below has two plain sides and Spark can split a key that very many documents hold
    confirmed = written(suspects.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keeper")).where(F.col("n") >= min_docs))
    elsewhere: Column = ~F.col("id").eqNullSafe(F.col("keeper"))
    drops = suspects.join(confirmed, "digest").where(elsewhere).groupBy("id").agg(F.collect_set("hash").alias(drop))
    joined = docs.join(drops, docs[id_col].eqNullSafe(drops["id"]), "left").drop(drops["id"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{names[0]}` long, `{names[1]}` long, `{names[2]}` string"
    return joined.mapInArrow(_kept(text_col, drop, names, min_chars), schema)
