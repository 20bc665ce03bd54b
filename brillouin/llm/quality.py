r"""Quality rules joined by weak supervision.

Each rule votes good or bad, or abstains.  The rules are tight enough to be wrong now and then; what a vote is worth is estimated.
One pass counts how often each pattern of votes occurs (at most `3 ** len(RULES)` patterns, whatever the corpus is) in the documents
that pass the base filter, expectation-maximisation on these counts estimates the share of good documents and each rule's accuracy in
good and in bad ones, and a document's verdict is the posterior probability that it is good given its votes: the bad vote of a
poor rule is outvoted, that of a good rule is not.  The rules are conditionally independent given the class (the
Dawid-Skene model with abstention as a third vote).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Chunk, by_chunk, mixed, own_names, with_columns, without

#: Rule: (name, feature, good from, good to, bad below, bad above). It votes good inside the first range, bad outside the second.
RULES = (
    ("symbols", "symbols_per_word", 0.0, 0.03, 0.0, 0.10),
    ("repeats", "repeat_share", 0.0, 0.05, 0.0, 0.10),
    ("lines", "dup_line_share", 0.0, 0.05, 0.0, 0.20),
    ("length", "word_length", 4.0, 7.0, 3.5, 7.5),
    ("letters", "wordless_share", 0.0, 0.02, 0.0, 0.08),
    ("short", "short_share", 0.18, 0.45, 0.10, 0.48),
    ("stops", "words_per_stop", 5.0, 25.0, 3.0, 50.0),
)
#: Votes (bad, abstains, good) of a rule in bad and in good documents before EM, and how many documents this belief is worth.
START, STRENGTH = ((0.35, 0.15, 0.5), (0.005, 0.095, 0.9)), 20.0
#: A good vote or an abstention is at most so many times likelier in a good document.
GOOD_VOTE = 8.0

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0x80, 0x100)]] = True

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_row(total: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return total[offsets[1:]] - total[offsets[:-1]]


def _sum(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(flags)])


def features(chunk: Chunk) -> dict[str, np.ndarray]:
    """Base counts and rule features of each text."""
    starts, ends, first = chunk.words()
    n_words = np.diff(first)
    points = chunk.code_points()
    length = points[ends] - points[starts]
    symbols = _per_row(_sum(_SYMBOL[chunk.data]), chunk.offsets)

    # words covered by windows of three words that the text holds twice
    row = np.repeat(np.arange(chunk.n), n_words)
    hashes = chunk.hashes(starts, ends)
    covered = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes) > 2:
        with np.errstate(over="ignore"):
            base = np.uint64(0xD6E8FEB86659FD93)
            window = mixed((hashes[:-2] * base + hashes[1:-1]) * base + hashes[2:])
        inside = np.flatnonzero(row[:-2] == row[2:])
        with np.errstate(over="ignore"):
            key = mixed(window[inside] + row[inside].astype(np.uint64) * base)
        order = np.argsort(key)
        equal = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(order), bool)
        twice[1:] |= equal
        twice[:-1] |= equal
        at = inside[order[twice]]
        step = np.bincount(at, minlength=len(covered) + 3) - np.bincount(at + 3, minlength=len(covered) + 3)
        covered = (np.cumsum(step)[: len(covered)] > 0).astype(np.int64)
    repeated = _per_row(_sum(covered[: len(hashes)]), first)

    # lines with a word
    a, b, lines = chunk.lines()
    counted = np.flatnonzero(np.searchsorted(starts, b) > np.searchsorted(starts, a))
    of = np.searchsorted(lines, counted, "right") - 1
    with np.errstate(over="ignore"):
        key = mixed(chunk.hashes(a[counted], b[counted]) + of.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    n_lines = np.bincount(of, minlength=chunk.n)
    distinct = np.bincount(of[np.unique(key, return_index=True)[1]], minlength=chunk.n)

    words, wordly = np.maximum(n_words, 1), _sum(_LETTER[chunk.data])
    stops = _sum(_STOP[chunk.data[ends - 1]]) if len(ends) else np.zeros(1, np.int64)
    return {
        "n_words": n_words,
        "word_chars": _per_row(_sum(length), first),
        "n_symbols": symbols,
        "n_dup_lines": n_lines - distinct,
        "n_repeat_words": repeated,
        "symbols_per_word": symbols / words,
        "repeat_share": repeated / words,
        "dup_line_share": (n_lines - distinct) / np.maximum(n_lines, 1),
        "word_length": _per_row(_sum(length), first) / words,
        "wordless_share": _per_row(_sum(wordly[ends] == wordly[starts]), first) / words,
        "short_share": _per_row(_sum(length <= 3), first) / words,
        "words_per_stop": n_words / np.maximum(_per_row(stops, first), 0.5),
    }


def votes(values: dict[str, np.ndarray]) -> np.ndarray:
    """Pattern of each text: a base-3 number with a digit for each rule (0 bad, 1 abstains, 2 good); all abstain without words."""
    pattern = np.zeros(len(values["n_words"]), np.int64)
    some = values["n_words"] > 0
    for _, name, good_from, good_to, bad_below, bad_above in RULES:
        x = values[name]
        vote = np.where((x >= good_from) & (x <= good_to), 2, np.where((x < bad_below) | (x > bad_above), 0, 1))
        pattern = pattern * 3 + np.where(some, vote, 1)
    return pattern


def _digits(patterns: np.ndarray) -> np.ndarray:
    return np.stack([patterns // 3 ** (len(RULES) - 1 - k) % 3 for k in range(len(RULES))], 1)


def posterior(patterns: np.ndarray, prior: float, tables: np.ndarray) -> np.ndarray:
    """Probability that a document with these votes is good."""
    digit = _digits(patterns)
    ratio = np.log(tables[1] / tables[0])
    odds = np.log(prior / (1 - prior)) + sum(ratio[k][digit[:, k]] for k in range(len(RULES)))
    return 1 / (1 + np.exp(-odds))


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, tol: float = 1e-9) -> tuple[float, np.ndarray]:
    """Share of good documents, and `tables[class, rule, vote]`: the probability of each vote in bad and in good documents, by EM.

    Without documents it returns the start, START. A rule stays a rule: EM may not turn a bad vote into
    a sign of a good document (it may come to say nothing), nor a good vote or an abstention into a proof.
    """
    prior, tables = 0.85, np.repeat(np.array(START)[:, None], len(RULES), 1)
    digit = _digits(patterns)
    weight = counts.astype(float)
    if not weight.sum():
        return prior, tables
    for _ in range(rounds):
        good = posterior(patterns, prior, tables)
        new = np.empty_like(tables)
        for c, share in enumerate((1 - good, good)):
            for k in range(len(RULES)):
                seen = np.bincount(digit[:, k], weights=weight * share, minlength=3) + STRENGTH * np.array(START[c])
                new[c, k] = seen / seen.sum()
        new[1, :, 0] = np.minimum(new[1, :, 0], new[0, :, 0])
        new[0, :, 2] = np.maximum(new[0, :, 2], new[1, :, 2] / GOOD_VOTE)
        new[0, :, 1] = np.clip(new[0, :, 1], new[1, :, 1] / GOOD_VOTE, new[1, :, 1] * GOOD_VOTE)
        new /= new.sum(2, keepdims=True)
        new_prior = float(np.clip((weight @ good + 1) / (weight.sum() + 2), 0.05, 0.98))
        done = abs(new_prior - prior) + np.abs(new - tables).max() < tol
        prior, tables = new_prior, new
        if done:
            break
    return prior, tables


def accuracies(prior: float, tables: np.ndarray) -> np.ndarray:
    """Probability that a rule is right where it votes."""
    right = prior * tables[1, :, 2] + (1 - prior) * tables[0, :, 0]
    voted = prior * (tables[1, :, 0] + tables[1, :, 2]) + (1 - prior) * (tables[0, :, 0] + tables[0, :, 2])
    return right / voted


def base_failed(values: dict[str, np.ndarray]) -> np.ndarray:
    """Under 50 words, or over half of them in repeated windows."""
    return (values["n_words"] < 50) | (100 * values["n_repeat_words"] > 50 * values["n_words"])


def _pattern_counts(docs: DataFrame, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    def work(chunk: Chunk, _: pa.RecordBatch) -> pa.RecordBatch:
        values = features(chunk)
        pattern, n = np.unique(votes(values)[~base_failed(values)], return_counts=True)
        return pa.RecordBatch.from_pydict({"pattern": pattern, "n": n})

    counted = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(by_chunk(work, "text"), "pattern long, n long")
    rows = sorted(counted.groupBy("pattern").agg(F.sum("n").alias("n")).collect())  # 3 ** len(RULES) rows at most
    return np.array([r["pattern"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64)


def rate_quality(docs: DataFrame, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    r"""All rows of `docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, quality, kept.

    Words are `[^\x20\x09-\x0D]+`. `base_failed`: under 50 words, or over half of the words lie in repeated
    three-word windows. `quality` is the posterior probability, by what the documents that are not base_failed tell about the rules;
    `kept` needs it to be at least `threshold`, and not base_failed. Words, lines and windows are compared by 64-bit hashes.

    Defined cases: null and empty texts have no words, so they fail and every rule abstains; a repeated row
    counts each time; an empty table gives an empty table; other columns pass through, but for those named like
    a result column, which it replaces.
    """
    docs = without(docs, *BASE, "base_failed", "quality", "kept")
    patterns, counts = _pattern_counts(docs, text_col)
    prior, tables = fit(patterns, counts)

    def work(chunk: Chunk, rows: pa.RecordBatch) -> pa.RecordBatch:
        values = features(chunk)
        failed = base_failed(values)
        good = posterior(votes(values), prior, tables)
        return with_columns(rows, **{k: values[k].astype(np.int64) for k in BASE}, base_failed=failed, quality=good, kept=~failed & (good >= threshold))

    (text,) = own_names(docs, "text")
    given = docs.withColumn(text, F.col(text_col).cast("string"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema) + "".join(f", {k} long" for k in BASE) + ", base_failed boolean, quality double, kept boolean"
    return given.mapInArrow(by_chunk(work, text), schema).drop(text)
