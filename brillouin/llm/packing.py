"""Packing token streams into training windows by order-preserving dynamic programming.

Each task reads its documents in order as one stream of ids and cuts it into windows of at most `window` ids.
Cuts are allowed at document ends (free), at sentence ends (`SENTENCE`) and, inside a sentence longer than a
window, at any multiple of the window (`INSIDE`).  The cost of a window is what it occupies: `window` ids
padded, or its own length where that is a power of two.  With

    cost(i) = penalty(i) + min(window + min{cost(j): i - window <= j < i}, 2**k + cost(i - 2**k))

the inner minimum runs over a sliding range of j, so a monotone queue gives it in constant time.  The stream
is handled in blocks; the last windows of a block are cut again with the next block, so memory is bounded by the
block or the longest document.  Nothing shuffles, and only the last windows of a task can be short: those are cut
into powers of two where that is cheaper than padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import chunks, tidied
from .tokenizing import word_ids

#: Ids that a cut costs at a sentence end, inside a sentence, and ids of a block.
SENTENCE, INSIDE, BLOCK = 16, 64, 1 << 20
#: Powers of two tried for windows in the middle of the stream (the smaller ones only at its end).
MIDDLE = (9, 10, 11)


def candidates(doc_ends: np.ndarray, sentence_ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where the stream may be cut (0 first, its end last), and what each cut costs."""
    at = np.union1d(np.concatenate([[0], doc_ends]), sentence_ends)
    wide = np.flatnonzero(np.diff(at) > window)
    if len(wide):
        at = np.union1d(at, np.concatenate([np.arange(at[k] + window, at[k + 1], window) for k in wide]))
    penalty = np.full(len(at), INSIDE)
    penalty[np.isin(at, sentence_ends, assume_unique=True)] = SENTENCE
    penalty[np.searchsorted(at, doc_ends)] = 0
    return at, penalty


def best_cuts(at: np.ndarray, penalty: np.ndarray, window: int, powers: tuple[int, ...]) -> list[int]:
    """Cut positions of least cost; the last is the end of the stream."""
    short: dict[int, list[tuple[int, int]]] = {}
    for k in powers:
        if 1 << k < window:
            j = np.searchsorted(at, at - (1 << k))
            for i in np.flatnonzero((at[j] == at - (1 << k)) & (at >= 1 << k)).tolist():
                short.setdefault(i, []).append((int(j[i]), 1 << k))
    positions, costs = at.tolist(), penalty.tolist()
    cost, back = [0] * len(positions), [0] * len(positions)
    queue, head = [0], 0
    for i in range(1, len(positions)):
        low = positions[i] - window
        while positions[queue[head]] < low:
            head += 1
        j = queue[head]
        c = cost[j] + window
        if i in short:
            for other, size in short[i]:
                if cost[other] + size < c:
                    j, c = other, cost[other] + size
        c += costs[i]
        cost[i], back[i] = c, j
        while len(queue) > head and cost[queue[-1]] >= c:
            queue.pop()
        queue.append(i)
    cuts, i = [], len(positions) - 1
    while i:
        cuts.append(positions[i])
        i = back[i]
    return cuts[::-1]


def split_tail(start: int, end: int, window: int) -> list[int]:
    """Cuts of the last window: powers of two where they cost less than its padding."""
    n = end - start
    if n & (n - 1) and (n.bit_count() - 1) * INSIDE < window - n:
        out = []
        for k in range(n.bit_length() - 1, -1, -1):
            if n >> k & 1:
                start += 1 << k
                out.append(start)
        return out
    return [end]


class _Stream:
    """Documents of a task that are not yet packed."""

    def __init__(self, window: int, closing: np.ndarray):
        self.window, self.closing, self.next_id = window, closing, 0
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple[object, int, int, int]] = []  # id, ids before, ids here, ids in all
        self.n = 0

    def add(self, doc_id: object, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.docs.append((doc_id, 0, len(ids), len(ids)))
        self.n += len(ids)

    def pack(self, last: bool) -> dict[str, list] | None:
        """Pieces of the windows that are settled; all of them at the end."""
        if not self.n:
            return None
        ids = np.concatenate(self.ids)
        ends = np.cumsum([d[2] for d in self.docs])
        sentences = np.flatnonzero(self.closing[np.minimum(ids, len(self.closing) - 1)]) + 1
        cuts = best_cuts(*candidates(ends, sentences[sentences < len(ids)], self.window), self.window, tuple(range(12)) if last else MIDDLE)
        if last:
            cuts[-1:] = split_tail(cuts[-2] if len(cuts) > 1 else 0, cuts[-1], self.window)
        else:
            cuts = cuts[:-3]
        if not cuts:
            return None
        done = cuts[-1]
        starts = np.concatenate([[0], ends[:-1]])
        edge = np.union1d(starts[starts < done], np.concatenate([[0], cuts]))
        a, b = edge[:-1], edge[1:]
        doc = np.searchsorted(starts, a, "right") - 1
        win = np.searchsorted(cuts, a, "right")
        first = np.concatenate([[0], cuts])[win]
        raw = memoryview(np.ascontiguousarray(ids.astype("<u4"))).cast("B")
        owners = [self.docs[k] for k in doc.tolist()]
        out = {
            "doc_id": [o[0] for o in owners],
            "start": (a - starts[doc] + np.array([o[1] for o in owners])),
            "length": b - a,
            "ids_crc32": [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)],
            "doc_tokens": [o[3] for o in owners],
            "sequence_id": win + self.next_id,
            "offset": a - first,
        }
        self.next_id += len(cuts)
        k = int(np.searchsorted(ends, done, "right"))
        rest = self.docs[k:]
        if rest:
            gone = done - int(starts[k])
            rest[0] = (rest[0][0], rest[0][1] + gone, rest[0][2] - gone, rest[0][3])
        self.docs, self.ids, self.n = rest, [ids[done:]], len(ids) - done
        return out


def pack_sequences(docs: DataFrame, *, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = 4096, end_id: int = 2, block: int = BLOCK) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of the tokenizer file `tokenizer` (without special tokens), then `end_id`.
    Documents keep their order within a task; `sequence_id` is the task's number times 2**33 plus a count.
    A sequence is padded to `window` unless its length is a power of two.

    Defined cases: null and empty texts are the one id `end_id`; rows that repeat an id are documents of
    their own; null ids pass through; an empty table gives an empty table; other columns are not read.
    """
    if window < 2:
        raise ValueError("window must be at least 2")
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer)
        stream = _Stream(window, words.closing)
        stream.next_id = TaskContext.get().partitionId() << 33
        end = np.array([end_id], "<u4").tobytes()

        def rows(last: bool) -> Iterator[pa.RecordBatch]:
            if got := stream.pack(last):
                yield pa.RecordBatch.from_pydict({id_col: pa.array(got.pop("doc_id"), id_type), **{k: pa.array(np.asarray(v, np.int64)) for k, v in got.items()}})

        for batch in batches:
            id_type = batch.column(0).type
            for chunk in chunks(batch.column(1)):
                ids = batch.column(0).slice(chunk.first, chunk.n).to_pylist()
                raw, at = chunk.data.tobytes(), chunk.offsets.tolist()
                for doc_id, data in zip(ids, words.encode([raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]), strict=True):
                    stream.add(doc_id, np.frombuffer(data + end, "<u4"))
                    if stream.n >= block:
                        yield from rows(False)
        if stream.n:
            yield from rows(True)

    schema = f"`{id_col}` {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(tidied(run), schema)
