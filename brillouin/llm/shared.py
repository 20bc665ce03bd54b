"""Helpers shared by the corpus operators: byte-level text arrays and columns.

Texts are handled in Arrow batches inside tasks.  A batch is cut into chunks of about
`CHUNK_BYTES` bytes (always whole texts), and each chunk is worked on with numpy over its UTF-8
bytes, so memory is bounded by the chunk or by the longest single text.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..plans.scratch import written

__all__ = ["Chunk", "by_chunk", "chunks", "lists", "mixed", "own_names", "table", "tidied", "with_columns", "without", "written"]

#: Bytes of text that are worked on at a time.
CHUNK_BYTES = 1 << 20

#: The white space of words and of line ends: \x20 and \x09-\x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z to a-z, other bytes as they are.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

# Odd base of the polynomial hash modulo 2**64, and its inverse.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def without(df: DataFrame, *names: str) -> DataFrame:
    """`df` without its columns of these names (compared without case): result columns take their place."""
    taken = {n.lower() for n in names}
    return df.drop(*(c for c in df.columns if c.lower() in taken))


def own_names(df: DataFrame, *names: str) -> list[str]:
    """Working column names that no column of `df` has (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        new = f"__{name}"
        while new.lower() in taken:
            new = "_" + new
        taken.add(new.lower())
        out.append(new)
    return out


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n + 1:
        with np.errstate(over="ignore"):
            for k, base in enumerate((_BASE, _INVERSE)):
                table = np.full(max(n + 1, CHUNK_BYTES + 1), base, np.uint64)
                table[0] = 1
                _powers[k] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of 64-bit hashes (the splitmix64 constants)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Chunk:
    """The UTF-8 bytes of consecutive texts. Null texts are empty."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data = data
        self.offsets = offsets  # of each text, and the end; int64
        self.first = first  # row in the batch
        self.n = len(offsets) - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the words of all texts, and for each text the index of its first word (and the end)."""
        data, offsets = self.data, self.offsets
        space = _SPACE[data]
        before = np.empty(len(data), bool)
        before[1:] = space[:-1]
        after = np.empty(len(data), bool)
        after[:-1] = space[1:]
        full = offsets[1:] > offsets[:-1]
        before[offsets[:-1][full]] = True
        after[offsets[1:][full] - 1] = True
        starts = np.flatnonzero(~space & before)
        ends = np.flatnonzero(~space & after) + 1
        return starts, ends, np.searchsorted(starts, offsets)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the lines of all texts (an empty text has one), and each text's first line (and the end)."""
        breaks = np.flatnonzero(self.data == 10)
        row = np.searchsorted(self.offsets, breaks, "right") - 1
        count = 1 + np.bincount(row, minlength=self.n)
        first = np.concatenate([[0], np.cumsum(count)])
        starts = np.empty(first[-1], np.int64)
        ends = np.empty(first[-1], np.int64)
        at = np.arange(len(breaks)) + row  # line that the break ends
        starts[first[:-1]] = self.offsets[:-1]
        starts[at + 1] = breaks + 1
        ends[at] = breaks
        ends[first[1:] - 1] = self.offsets[1:]
        return starts, ends, first

    def stripped(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The spans without white space at both ends; start = end where nothing is left."""
        solid = np.flatnonzero(~_SPACE[self.data])
        if not len(solid):
            return starts, starts.copy()
        a, b = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
        some = b > a
        return np.where(some, solid[np.minimum(a, len(solid) - 1)], starts), np.where(some, solid[b - 1] + 1, starts)

    def code_points(self) -> np.ndarray:
        """Code points before each byte (and in all)."""
        return np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])

    def hashes(self, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
        """64-bit hashes of the spans; equal bytes have equal hashes in all chunks."""
        data = _LOWER[self.data] if lower else self.data
        power, inverse = _power_tables(len(data))
        with np.errstate(over="ignore"):
            total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=total[1:])
            return mixed((total[ends] - total[starts]) * inverse[starts])


def chunks(texts: pa.Array) -> Iterator[Chunk]:
    """The texts of an Arrow string column in chunks."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        yield Chunk(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], at)
        at = to


def give_back() -> None:
    """Returns freed memory to the system, power tables included: Python workers outlive their task, and their allocators keep what was freed."""
    _powers[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not the GNU library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A function for mapInArrow that gives memory back at the end of each task."""

    @functools.wraps(run)
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return work


def by_chunk(work: Callable[[Chunk, pa.RecordBatch], pa.RecordBatch | None], text: str) -> Callable:
    """A function for mapInArrow: `work` gets each chunk of the column `text` with the rows it came from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(batch.schema.get_field_index(text))):
                out = work(chunk, batch.slice(chunk.first, chunk.n))
                if out is not None:
                    yield out

    return tidied(run)


def with_columns(batch: pa.RecordBatch, **columns: pa.Array | np.ndarray) -> pa.RecordBatch:
    """The batch with columns added at its end."""
    arrays, names = list(batch.columns), list(batch.schema.names)
    for name, values in columns.items():
        names.append(name)
        arrays.append(values if isinstance(values, pa.Array) else pa.array(values))
    return pa.RecordBatch.from_arrays(arrays, names)


def lists(counts: np.ndarray, values: np.ndarray) -> pa.Array:
    """List column from the length of each list and all values in order."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
