"""Small corpora with the cases that every operator must settle."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, size string, kept string"


def words(rng, n):
    return " ".join(rng.choice("al be ce do en fa go hu in jo ka lo mi no op".split()) + rng.choice("ra te li mo nu ped gar sel".split()) for _ in range(n))


def prose(rng, n):
    out = words(rng, n).split()
    for k in range(9, len(out), 10):
        out[k] += "."
    return " ".join(out).replace(". ", ".\n", 2)


def awkward(seed=5, n=60):
    """Documents with nulls in every column, empty and blank texts, a very long one, exact and near copies, repeated rows, clashing columns."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(30, 160)) for _ in range(n)]
    shared = "A line that many documents hold in common."
    for k in range(0, n, 4):
        texts[k] += "\n  " + (shared.upper() if k % 8 else shared) + "\t\n" + shared
    texts += [None, "", "   \n\t", "one", "one two", "\n\n\n", texts[3], texts[3], texts[5].replace("al", "AL"), texts[7] + " alra alte", "Ünï çödé 日本語 😀 text. " * 20, prose(rng, 30_000)]
    rows = [(k, t, "en", f"s{k % 3}" if k % 7 else None, None if t is None else len(t), "x", "y", "z") for k, t in enumerate(texts)]
    rows += [rows[2], rows[2], (None, texts[1], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return rows
