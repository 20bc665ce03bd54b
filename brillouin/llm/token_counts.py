"""Token counts of a unigram vocabulary by a Viterbi pass that keeps counts only.

An Aho-Corasick automaton over the vocabulary lists every piece that ends at each place of a word; dynamic programming carries
the best score and its number of pieces, never the pieces.  Ties are those of the tokenizer: among equal scores the piece
that starts first wins.  A character that no single piece covers is unknown: it scores `UNKNOWN` below the worst piece, and counts
as its UTF-8 bytes (byte fallback), a run of unknown characters together.

A text is split at white space and every word gets the mark U+2581 in front, so words are independent and
a task remembers the counts of the words it has met, in a bounded cache.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import chunks, own_names, with_columns, without

#: Words that a Python worker keeps; the cache is emptied when it is full.
CACHE_WORDS = 500_000
#: What an unknown character scores below the worst piece.
UNKNOWN = 10.0
MARK = "▁"


@lru_cache(1)
def vocabulary(path: str) -> tuple[tuple[str, float], ...]:
    """Pieces and scores of a sentencepiece model file: its ordinary pieces that have the word mark at their start only."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.vocab_size()) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
    return tuple((p, model.get_score(i)) for i in ids if MARK not in (p := model.id_to_piece(i))[1:] and model.get_score(i) > -1e8)


class PieceCounts:
    """Number of pieces of words."""

    def __init__(self, pieces: tuple[tuple[str, float], ...]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for piece, _ in pieces if len(piece) == 1}
        self.unknown = min(score for _, score in pieces) - UNKNOWN
        self.cache: dict[bytes, int] = {}

    def count(self, word: str) -> int:
        """Pieces of one word; the mark is put in front here."""
        text = MARK + word
        n = len(text)
        best = [0.0] + [float("-inf")] * n
        pieces = [0] * (n + 1)
        single, end = self.single, 0
        for last, (length, score) in self.automaton.iter(text):
            while end < last:  # places where no piece ends
                end += 1
                self._unknown(text, end, best, pieces)
            if end == last:
                end += 1
                self._unknown(text, end, best, pieces)
            here = last + 1
            start = here - length
            value = best[start] + score
            # longer pieces come first and win ties; an unknown character has the shortest start of all
            if value > best[here] or (value == best[here] and text[last] not in single and length > 1):
                best[here], pieces[here] = value, pieces[start] + 1
        while end < n:
            end += 1
            self._unknown(text, end, best, pieces)
        return pieces[n]

    def _unknown(self, text: str, end: int, best: list[float], pieces: list[int]) -> None:
        if text[end - 1] not in self.single:
            best[end] = best[end - 1] + self.unknown
            pieces[end] = pieces[end - 1] + len(text[end - 1].encode("utf-8", "replace"))

    def of_texts(self, texts: list[list[bytes]]) -> list[int]:
        new = set().union(*texts).difference(self.cache)
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache.clear()
            new = set().union(*texts)
        count, cache = self.count, self.cache
        for word in new:
            cache[word] = count(word.decode("utf-8", "replace"))
        get = cache.__getitem__
        return [sum(map(get, words)) for words in texts]


@lru_cache(1)
def _counts(path: str) -> PieceCounts:
    """One for each Python worker and file."""
    return PieceCounts(vocabulary(path))


def count_tokens(docs: DataFrame, *, vocabulary_file: str, text_col: str = "text", name: str = "n_tokens") -> DataFrame:
    """All rows of `docs` with n_words (words between ASCII white space) and the number of unigram tokens of the whole text.

    Defined cases: null, empty and blank texts have no tokens; an empty table gives an empty table; repeated rows are counted
    each; other columns pass through, but for those named like a result column, which it replaces.
    """
    docs = without(docs, "n_words", name)
    (text,) = own_names(docs, "text")
    given = docs.withColumn(text, F.col(text_col).cast("string"))
    width = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(vocabulary_file)
        for batch in batches:
            for chunk in chunks(batch.column(width)):
                raw, at = chunk.data.tobytes(), chunk.offsets.tolist()
                words = [raw[a:b].split() for a, b in zip(at[:-1], at[1:], strict=True)]
                yield with_columns(batch.slice(chunk.first, chunk.n).select(list(range(width))), n_words=np.array([len(w) for w in words], np.int64), **{name: np.array(counts.of_texts(words), np.int64)})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", n_words long, `{name}` long"
    return given.mapInArrow(run, schema)
