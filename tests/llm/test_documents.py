"""Document operators against brute force, on small corpora with awkward rows."""

import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from brillouin.llm import jaccard_join, line_dedup, mixing, packing, quality, sharding, token_counts, toxicity
from brillouin.llm.queries import oracle_sql

from .corpus import SCHEMA, awkward, prose, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


OPERATORS = {
    "quality": lambda d: quality.rate_quality(d),
    "lines": lambda d: line_dedup.dedup_lines(d, bits=16),
    "shards": lambda d: sharding.shard_records(d),
    "mix": lambda d: mixing.mix_sources(d),
    "jaccard": lambda d: jaccard_join.jaccard_components(d),
    "tokens": lambda d: token_counts.count_tokens(d, vocabulary_file=public_tokenizers.path("piece_bpe_32k.model")),
    "pack": lambda d: packing.pack_sequences(d, tokenizer=public_tokenizers.path("word_bpe_49k.json")),
    "toxicity": lambda d: toxicity.score_toxicity(d, d.select("doc_id", F.lit(1).alias("toxic")).where("doc_id % 3 = 0")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows_and_empty_tables(docs, name):
    got = OPERATORS[name](docs)
    n = got.count()
    assert n >= docs.count() if name == "pack" else n == docs.count()
    empty = OPERATORS[name](docs.limit(0))
    assert empty.columns == got.columns and empty.count() == 0
    nothing = OPERATORS[name](docs.withColumn("text", F.lit(None).cast("string")))
    assert nothing.count() == docs.count()


def base_counts(text):
    text = text or ""
    found = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(found[i : i + 3]) for i in range(len(found) - 2))
    repeated = {j for i in range(len(found) - 2) if windows[tuple(found[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


def test_quality_counts(spark):
    rows = [r[:2] for r in awkward()] + [(900, "a b c a b c d\nx\nx\n \n \nx"), (901, "#| <x> & 100% " * 30), (902, "same same same same"), (903, "é ü 😀")]
    got = quality.rate_quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r["text"], *(r[k] for k in quality.BASE)) for r in got) == Counter((t, *base_counts(t)) for _, t in rows)
    for r in got:
        n = r["n_words"]
        assert r["base_failed"] == (n < 50 or 100 * r["n_repeat_words"] > 50 * n)
        assert not (r["kept"] and r["base_failed"]) and 0 <= r["quality"] <= 1


def test_quality_keeps_prose_and_rejects_junk(spark):
    import random

    rng = random.Random(1)
    rows = [(k, prose(rng, 120), 1) for k in range(200)]
    rows += [(1000 + k, " | ".join(words(rng, 90).split()), 0) for k in range(15)] + [(2000 + k, " ".join(w + rng.choice(["%%%", "###", "&&&"]) for w in words(rng, 90).split()), 0) for k in range(15)]
    got = quality.rate_quality(spark.createDataFrame(rows, "doc_id long, text string, good int")).collect()
    assert all(r["kept"] == bool(r["good"]) for r in got)


def test_em_finds_the_accuracies():
    rng = np.random.default_rng(0)
    k, n = len(quality.RULES), 20_000
    good = rng.random(n) < 0.8
    bad_vote = np.where(good[:, None], 0.01, 0.4) > rng.random((n, k))
    digits = np.where(bad_vote, 0, 2)
    patterns, counts = np.unique(digits @ 3 ** np.arange(k - 1, -1, -1), return_counts=True)
    prior, tables = quality.fit(patterns, counts)
    assert abs(prior - good.mean()) < 0.03
    assert np.allclose(tables[0, :, 0], 0.4, atol=0.06) and np.allclose(tables[1, :, 0], 0.01, atol=0.01)
    assert quality.fit(patterns[:0], counts[:0])[0] > 0


def test_poor_rules_are_outvoted_and_good_ones_are_not():
    """Rule 0 is nearly always right, rule 1 fires in both classes alike, the others are fair."""
    rng = np.random.default_rng(7)
    k, n = len(quality.RULES), 40_000
    good = rng.random(n) < 0.9
    fires = np.tile([0.0005, 0.05, *[0.01] * (k - 2)], (n, 1))
    fires[~good] = [0.9, 0.05, *[0.4] * (k - 2)]
    patterns, counts = np.unique(np.where(rng.random((n, k)) < fires, 0, 2) @ 3 ** np.arange(k - 1, -1, -1), return_counts=True)
    prior, tables = quality.fit(patterns, counts)
    assert abs(prior - good.mean()) < 0.02
    assert np.allclose(tables[0, :, 0], [0.9, 0.05, *[0.4] * (k - 2)], atol=0.06) and np.allclose(tables[1, :, 0], [0.0005, 0.05, *[0.01] * (k - 2)], atol=0.01)

    def verdict(*votes):
        return quality.posterior(np.array([votes]) @ 3 ** np.arange(k - 1, -1, -1), prior, tables)[0]

    assert verdict(2, 0, *[2] * (k - 2)) > 0.9  # one bad vote of a poor rule
    assert verdict(0, *[1] * (k - 1)) < 0.5  # one of a good rule, all others abstain
    assert verdict(2, 0, 0, 0, *[2] * (k - 4)) < 0.5  # several fair rules agree
    assert quality.accuracies(prior, tables)[0] > quality.accuracies(prior, tables)[1]


def test_verdict_is_no_all_must_pass_filter(spark):
    import random

    rng = random.Random(11)
    rows = [(k, prose(rng, 120), 1) for k in range(300)]
    twice = prose(rng, 8)
    rows += [(500 + k, prose(rng, 100) + "\n" + twice + "\n" + twice, 1) for k in range(12)]  # one rule votes bad: repeated windows
    rows += [(1000 + k, " ".join(w + rng.choice(["%%%", "###", "&&&", ""]) * 2 for w in words(rng, 90).split()), 0) for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, good int")
    got = {r["doc_id"]: r for r in quality.rate_quality(frame).collect()}
    assert all(got[k]["kept"] == bool(y) for k, _, y in rows)
    import pyarrow as pa

    from brillouin.llm.shared import chunks

    values = quality.features(next(chunks(pa.array([r[1] for r in rows if r[2] and r[0] >= 500]))))
    assert (quality._digits(quality.votes(values)) == 0).any(1).sum() >= 6


def kept_lines(rows, min_chars=20, min_docs=3):
    holders = defaultdict(list)
    key = lambda line: lower(line.strip(SPACE))
    for k, (d, t) in enumerate(rows):
        for line in {key(x) for x in (t or "").split("\n")}:
            if len(line) >= min_chars:
                holders[line].append((d is not None, d or 0))
    keeper = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for d, t in rows:
        parts = (t or "").split("\n")
        left = [p for p in parts if keeper.get(key(p), (d is not None, d or 0)) == (d is not None, d or 0)]
        out.append((d, len(parts), len(parts) - len(left), "\n".join(left)))
    return out


@pytest.mark.parametrize("bits", [8, 26])
def test_line_dedup(spark, bits):
    rows = [r[:2] for r in awkward()]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), bits=bits)
    assert Counter(tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()) == Counter(kept_lines(rows))


def test_bloom_filters_grow_with_the_keys(spark):
    """Of keys seen once, few are suspected, whatever their number is."""
    for n in (2_000, 400_000):
        docs = spark.range(n // 20).select(F.concat_ws("\n", *[F.concat(F.lit(f"line {k} of the document with number "), F.col("id").cast("string")) for k in range(19)], F.lit("a line that all of the documents share")).alias("text")).repartition(4)
        twice, bits = line_dedup.seen_twice(docs)
        assert bits == line_dedup.filter_bits(docs) and (1 << bits) >= 4 * n and len(twice) == (1 << bits) // 8
        chunk = next(line_dedup.chunks(__import__("pyarrow").array([docs.orderBy(F.rand(1)).first()["text"] for _ in range(5)] + ["\n".join(f"another line {k} that nobody has seen" for k in range(5000))])))
        keys = line_dedup._keys(chunk, 20)
        suspected = np.logical_and.reduce([line_dedup._get(twice, c) for c in line_dedup._cells(keys["hash"], bits)])
        shared = keys["hash"] == keys["hash"][19]
        assert suspected[shared].all() and suspected[~shared].mean() < 0.05


def test_pages_of_a_filter_round_trip():
    rng = np.random.default_rng(0)
    for share in (0, 0.01, 0.5):
        page = (rng.random(1 << 15) < share).astype(np.uint8) * rng.integers(1, 255, 1 << 15).astype(np.uint8)
        assert (line_dedup._wide(line_dedup._thin(page), len(page)) == page).all()
    bits, cells = np.zeros(1 << 10, np.uint8), rng.integers(0, 1 << 13, 300)
    line_dedup._set(bits, cells)
    assert (np.flatnonzero(np.unpackbits(bits)) == np.unique(cells)).all() and line_dedup._get(bits, cells).all()


def test_rendezvous(spark):
    rows = [r[:2] for r in awkward(n=500)]
    got = sharding.shard_records(spark.createDataFrame(rows, "doc_id long, text string"), shards=24).collect()
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 24) and 0 <= r["shard"] < 24
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)
    assert len({(r["doc_id"], r["shard"]) for r in got}) == len({r["doc_id"] for r in got})
    moved = sum(r["grown_shard"] == 24 for r in got) / len(got)
    assert 0 < moved < 0.1


def test_shards_of_rows_that_repeat(spark, monkeypatch):
    """A third of all rows is one row; ranges of few rows give the same slots as one range."""
    rows = [(k, f"text {k}") for k in range(200)] + [(7, "hot")] * 100 + [(None, None)] * 3
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    one = Counter(map(tuple, sharding.shard_records(frame, shards=5).collect()))
    many = Counter(map(tuple, sharding.shard_records(frame, shards=5, range_rows=2).collect()))
    assert one == many and sum(one.values()) == len(rows)
    by = defaultdict(list)
    for doc_id, _, _, _, shard, slot, grown in one:
        by[shard].append(slot)
        text = "" if doc_id is None else f"k{doc_id}"
        draws = [int(__import__("hashlib").md5(f"0:{s}:{text}".encode()).hexdigest()[:13], 16) for s in range(6)]
        assert (shard, grown) == (draws.index(max(draws[:5])), draws.index(max(draws)))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_weighted_shards(spark):
    ids = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    got = sharding.shard_records(ids, shards=4, weights=[1, 2, 0, 5]).groupBy("shard").count().collect()
    share = {r["shard"]: r["count"] / 20_000 for r in got}
    assert 2 not in share and abs(share[3] - 5 / 8) < 0.02 and abs(share[1] - 2 / 8) < 0.02
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("id"), [0, 0])


def test_mixing(spark, docs, monkeypatch):
    got = mixing.mix_sources(docs.drop("n_words", "size", "kept")).toPandas()
    size = {}
    for s, g in got.groupby("source", dropna=False):
        size[s if isinstance(s, str) else None] = int(g["size"].sum())
        target = g["target"].iloc[0]
        assert g["taken"].sum() == int(target) and target <= 3 * g["size"].sum() + 1e-6
        assert (g["taken"] <= 3 * g["size"]).all() and (g["taken"] >= 0).all()
        assert g["taken"].max() == 0 or (g["taken"] // g["size"].where(g["size"] > 0)).max() - (g["taken"] // g["size"].where(g["size"] > 0)).min() <= 1
    assert abs(sum({s: g["target"].iloc[0] for s, g in got.groupby("source", dropna=False)}.values()) - got["size"].sum()) < 1e-6
    monkeypatch.setattr(mixing, "RANGES", 3)
    monkeypatch.setattr(mixing, "RANGE_ROWS", 5)
    again = mixing.mix_sources(docs.drop("n_words", "size", "kept").repartition(7)).toPandas()
    key = ["doc_id", "text", "taken"]
    assert Counter(map(str, got[key].values.tolist())) == Counter(map(str, again[key].values.tolist()))
    out = mixing.expanded(mixing.mix_sources(docs.select("doc_id", "text", "source")), ["doc_id", "text", "source"]).toPandas()
    assert sum(len(WORD.findall(t)) for t in out["text"]) == got["taken"].sum()


def test_mixing_targets_stop_at_three_epochs(spark):
    rows = [(k, "w " * 10, "a") for k in range(100)] + [(100 + k, "w " * 10, "c") for k in range(2)] + [(200, "w w", None)]
    got = {r["source"]: r["target"] for r in mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got["c"] == 60 and got[None] == 6 and abs(got["a"] - (1022 - 66)) < 1e-9


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_sql_of_queries(spark, tmp_path, name):
    from brillouin.llm.queries import queries

    rows = [r for r in awkward() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    frame = spark.createDataFrame(rows, SCHEMA).select("doc_id", "text", "lang", "source", "n_chars")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    rng = np.random.default_rng(8)
    base = rng.normal(size=(30, 64))
    vectors = [(k, v.tolist(), k % 3 or None) for k, v in enumerate(np.concatenate([base, base + 0.15 * rng.normal(size=base.shape), base[:5]]).astype("f4"))]
    vectors += [(900, None, 1), (901, [0.0] * 64, 2), (902, [float("nan")] * 64, 1), (903, [None] + [1.0] * 63, 1)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    hosts = ["a.example.org", "B.example.com", "c.net", "d.c.net", "e.com:80", "lone"]
    pages = [(k, f"http://{h}/{part}{k}?q#f", "".join(f'<p><a href="http://{hosts[(k * m) % 6]}/x">t</a></p>' for m in (1, 2, 3))) for k, (h, part) in enumerate((h, part) for h in hosts for part in ("es/", "en/1", "fr/", "de/", ""))]
    pages += [(900, None, "<a href='http://c.net'>"), (901, "no url", None), (902, "x://c.net", ""), (None, "http://lone/", None), (3, pages[3][1], pages[3][2])]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = queries()[name](spark, str(tmp_path))
    with duckdb.connect() as c:
        for table in ("documents", "embeddings", "pages"):
            c.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
        cursor = c.execute(oracle_sql()[name])
        names = [d[0] for d in cursor.description]
        want = Counter(cursor.fetchall())
    assert Counter(tuple(r) for r in got.select(*names).collect()) == want


def brute_components(rows, n, num, den):
    sets = {}
    for d, t in rows:
        w = WORD.findall(lower(t or ""))
        sets[d] = frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) * den >= num * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize("n,num,den", [(4, 85, 100), (5, 80, 100)])
def test_jaccard_join(spark, n, num, den):
    import random

    rng = random.Random(n)
    rows = list({r[0]: r[:2] for r in awkward() if r[0] is not None}.values())
    base = words(rng, 120).split()
    for k in range(300):  # a family larger than a short list and a block
        copy = list(base)
        for _ in range(rng.randint(0, 8)):
            copy[rng.randrange(len(copy))] = words(rng, 1)
        rows.append((1000 + k, " ".join(copy[rng.randint(0, 6) :])))
    for k in range(40):
        rows.append((2000 + k, words(rng, rng.randint(0, 6))))
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), n=n, threshold=(num, den))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == brute_components(rows, n, num, den)


def test_jaccard_join_of_repeated_and_null_ids(spark):
    """Rows are placed by their own text, whatever the ids are; two texts that share an id are not linked by it."""
    import random

    rng = random.Random(2)
    a, b, c = (words(rng, 60) for _ in range(3))
    rows = [(3, a), (4, b), (5, a), (5, b), (6, c), (6, c), (7, c + " more"), (None, a), (None, None), (8, ""), (8, None), (9, "one two")]
    got = Counter(tuple(r) for r in jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    n = 56
    assert got == Counter({(3, n, 3): 1, (5, n, 3): 1, (4, n, 4): 1, (5, n, 4): 1, (6, n, 6): 2, (7, n + 1, 6): 1, (None, n, None): 1, (None, 0, None): 1, (8, 0, 8): 2, (9, 1, 9): 1})


def test_block_skips_lose_no_pair():
    """Candidates of random index lists: all pairs that size and position allow, and no others."""
    import pyarrow as pa

    rng = np.random.default_rng(6)
    num, den = 80, 100
    for _ in range(20):
        rows = sorted({(int(t), int(s), int(p), k) for k, (t, s, p) in enumerate(zip(rng.integers(0, 12, 200), rng.integers(1, 40, 200), rng.integers(0, 12, 200), strict=True)) if p < s})
        batch = pa.RecordBatch.from_pydict({"token": [r[0] for r in rows], "id": [r[3] for r in rows], "size": pa.array([r[1] for r in rows], pa.int32()), "pos": pa.array([r[2] for r in rows], pa.int32())})
        got = Counter((r["a"], r["b"]) for part in jaccard_join._lists(num, den)(iter([batch.slice(0, 70), batch.slice(70)])) for r in part.to_pylist())
        want = Counter()
        for x, (t, s, p, k) in enumerate(rows):
            for u, z, q, m in rows[x + 1 :]:
                if t == u and den * s >= num * z and (num + den) * min(s - p, z - q) >= num * (s + z):
                    want[min(k, m), max(k, m)] += 1
        assert got == want


def test_overlaps_from_similar_sets():
    rng = np.random.default_rng(3)
    base = rng.choice(10_000, 80, replace=False)
    sets = []
    for _ in range(120):
        s = base.copy()
        s[rng.integers(0, 80, 10)] = rng.choice(10_000, 10)
        sets.append(np.unique(s[: rng.integers(60, 80)]).astype(np.uint64))
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    a, b = jaccard_join.linked_forest(np.arange(120), np.concatenate(sets), offsets, 80, 100)
    label = np.arange(120)
    label[a] = b
    want = brute_components([(k, " ".join(f"t{x}" for x in s)) for k, s in enumerate(sets)], 1, 80, 100)
    assert {k: int(label[k]) for k in range(120)} == {k: v[1] for k, v in want.items()}


def test_token_counts(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    vocabulary = [("<unk>", 0.0), *token_counts.vocabulary(path)]
    exact = Tokenizer(models.Unigram(vocabulary, 0, False))
    exact.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    rows = [r[:2] for r in awkward()] + [(77, "Thbleing 1234567 aaaaaaaaaaaa !!!??? 日本語テキスト 😀😀x ñandú")]
    got = token_counts.count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary_file=path).collect()
    for r in got:
        found = WORD.findall(r["text"] or "")
        coded = [exact.encode(w, add_special_tokens=False) for w in found]
        n = sum(len(token.encode()) if i == 0 else 1 for e in coded for i, token in zip(e.ids, e.tokens, strict=True))
        assert (r["n_words"], r["n_tokens"]) == (len(found), n)


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    exact = Tokenizer.from_file(path)
    odd = "It's O'Neil's “quoted” İstanbul ΣΊΣΥΦΟΣ <|endoftext|> éclair 3.14 x\x00y naïve ÇA_VA ß÷× \x1c  end"
    rows = [(k, t) for k, (_, t, *_) in enumerate(awkward(n=40))] + [(500, odd), (501, "word " * 30_000), (502, "a" * 50_000)]
    got = packing.pack_sequences(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), tokenizer=path, window=512, block=4096).toPandas()
    ids = {d: np.array(exact.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for d, t in rows}
    at = Counter()
    for r in got.sort_values(["doc_id", "start"]).itertuples():
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert r.start == at[r.doc_id] and r.doc_tokens == len(ids[r.doc_id]) and zlib.crc32(piece.tobytes()) == r.ids_crc32
        at[r.doc_id] += r.length
    assert at == {d: len(x) for d, x in ids.items()}
    padded = total = 0
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert (g["offset"].to_numpy() == np.concatenate([[0], g["length"].cumsum().to_numpy()[:-1]])).all()
        n = int(g["length"].sum())
        assert n <= 512
        padded += n if n & (n - 1) == 0 else 512
        total += n
    assert padded / total < 1.03


def test_best_cuts_are_best():
    rng = np.random.default_rng(2)
    for _ in range(30):
        at = np.unique(np.concatenate([[0], rng.integers(1, 120, 25), [120]]))
        at = at[np.concatenate([[True], np.diff(at) <= 16])] if (np.diff(at) <= 16).all() else np.arange(0, 121, 4)
        penalty = rng.integers(0, 6, len(at))
        cost = {0: 0}
        for i in range(1, len(at)):
            cost[i] = penalty[i] + min(cost[j] + (n if n & (n - 1) == 0 and n >= 1 else 16) for j in range(i) if (n := at[i] - at[j]) <= 16)
        cuts = packing.best_cuts(at, penalty, 16, tuple(range(12)))
        edges = [0, *cuts]
        spent = sum((n if n & (n - 1) == 0 else 16) + penalty[np.searchsorted(at, b)] for a, b in zip(edges[:-1], edges[1:], strict=True) for n in [b - a])
        assert spent == cost[len(at) - 1]


def letter_counts(texts):
    """Brute-force counts of letter groups, on ASCII words."""
    found = Counter()
    for t in texts:
        line = " " * (toxicity.ORDER - 1) + " ".join(re.findall("[a-z]+", t.lower())) + " "
        found.update(line[i : i + toxicity.ORDER] for i in range(len(line) - toxicity.ORDER + 1))
    return found


def packed_key(group):
    return int.from_bytes(group.encode(), "big")


def brute_kneser_ney(bad, good):
    """P(last letter | context) in each class of every group, straight from the definition."""
    lower = {toxicity.ORDER: {*bad, *good}}
    counts = {}
    for k in range(toxicity.ORDER - 1, 0, -1):
        lower[k] = {g[1:] for g in lower[k + 1]}
        counts[k] = Counter(g[1:] for g in lower[k + 1])

    def backoff(g):
        if len(g) == 1:
            return (counts[1].get(g, 0) + 0.5) / (sum(counts[1].values()) + 0.5 * len(counts[1]))
        after = {h: n for h, n in counts[len(g)].items() if h[:-1] == g[:-1]}
        total = sum(after.values())
        return max(after.get(g, 0) - 0.75, 0) / total + 0.75 * len(after) / total * backoff(g[1:])

    def probability(found, g):
        after = {h: n for h, n in found.items() if h[:-1] == g[:-1] and n > 0}
        total = sum(after.values())
        return max(found.get(g, 0) - 0.75, 0) / max(total, 1) + (0.75 * len(after) / total if total else 1.0) * backoff(g[1:])

    return {g: (probability(bad, g), probability(good, g)) for g in lower[toxicity.ORDER]}


def counted(spark, texts):
    rows = [(t, int(y)) for t, y in texts]
    parts = spark.createDataFrame(rows, "text string, y int").repartition(3).mapInArrow(toxicity._count, "group long, toxic long, ordinary long")
    return parts.groupBy("group").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def test_kneser_ney_probabilities(spark):
    texts = [("Vile scum, you vile scum!", 1), ("scum of the earth", 1), ("calm meadow of the earth", 0), ("the meadow is calm and the earth is calm", 0), ("x", 0)]
    bad, good = (letter_counts(t for t, y in texts if y == k) for k in (1, 0))
    counts = counted(spark, texts).where(F.col("group") < toxicity.WORD)
    assert {r["group"]: (r["toxic"], r["ordinary"]) for r in counts.collect()} == {packed_key(g): (bad[g], good[g]) for g in {*bad, *good}}
    got = {r["key"]: r["value"] for r in toxicity.kneser_ney(counts).collect()}
    want = brute_kneser_ney(bad, good)
    for g, (p, q) in want.items():
        assert got[packed_key(g)] == pytest.approx(np.log(p / q), abs=1e-9)
    assert {k for k in got if k < toxicity.CONTEXT} == {packed_key(g) for g in want}
    for c in {g[:-1] for g in want}:
        assert toxicity.CONTEXT + packed_key(c) in got
        for k in (0, 1):  # what is left for letters unseen after this context
            assert sum(p[k] for g, p in want.items() if g[:-1] == c) <= 1 + 1e-9


def test_model_finds_every_key():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 1 << 40, 50_000)).astype(np.uint64)
    values = rng.normal(size=len(keys)).astype(np.float32)
    model = toxicity.Model(keys, values)
    got, missing = model.find(keys)
    assert (got == values).all() and not missing.any()
    got, missing = model.find(np.setdiff1d(rng.integers(0, 1 << 40, 1000).astype(np.uint64), keys))
    assert missing.all() and not got.any()
    assert toxicity.Model(keys[:0], values[:0]).find(keys)[1].all()


def brute_statistic(texts, asked):
    """Statistics of `asked` from the definition: letters by `brute_kneser_ney`, words once a text."""
    split = lambda t: re.findall("[a-z]+", t.lower())
    letters = brute_kneser_ney(*(letter_counts(t for t, y in texts if y == k) for k in (1, 0)))
    counts = [Counter(w for t, y in texts if y == k for w in set(split(t))) for k in (1, 0)]
    kinds = sum(map(len, counts))

    def word(w):
        sides = []
        for c in counts:
            total = sum(c.values())
            sides.append(max(c[w] - 0.75, 0) / total + 0.75 * len(c) / total * (sum(w in c for c in counts) / kinds if w in {*counts[0], *counts[1]} else 1))
        return np.log(sides[0] / sides[1])

    for t in asked:
        words = split(t)
        line = "   " + " ".join(words) + " "
        groups = [line[i : i + 4] for i in range(len(line) - 3)]
        ratios = [np.log(letters[g][0] / letters[g][1]) for g in groups]
        value = [word(w) for w in words]
        best = [max(sum(value[k : k + n]) for k in range(max(1, len(value) - n + 1))) / n for n in toxicity.WINDOWS]
        yield [sum(ratios) / len(groups), *best]


def test_toxicity_statistics_are_those_of_the_definition(spark):
    import pyarrow as pa

    from brillouin.llm.shared import chunks

    texts = [("Vile scum, you vile scum!", 1), ("scum of the earth", 1), ("calm meadow of the earth", 0), ("the meadow is calm and the earth is calm", 0), ("x", 0), ("you earth", 0)]
    counts = counted(spark, texts).persist()
    table = toxicity.kneser_ney(counts.where(F.col("group") < toxicity.WORD)).union(toxicity.word_evidence(counts.where(F.col("group") >= toxicity.WORD))).toPandas()
    model = toxicity.Model(table["key"].to_numpy(), table["value"].to_numpy())
    asked = ["vile scum of the meadow", "the earth", "scum", *(t for t, _ in texts), "is calm meadow of the earth and the earth is vile"]
    known = letter_counts(t for t, _ in texts)
    asked = [t for t in asked if set(letter_counts([t])) <= set(known)]
    chunk = next(chunks(pa.array([*asked, "", "12 !"])))
    got = toxicity.statistic(model, chunk.data, chunk.offsets)
    assert len(asked) > 6 and np.allclose(got[:-2], list(brute_statistic(texts, asked)), atol=1e-5) and not got[-2:].any()


def test_toxicity_hears_the_whole_text_and_its_windows(spark):
    import pyarrow as pa

    from brillouin.llm.shared import chunks

    counts = counted(spark, [("vile scum " * 50, 1), ("calm meadow " * 50, 0)]).persist()
    table = toxicity.kneser_ney(counts.where(F.col("group") < toxicity.WORD)).union(toxicity.word_evidence(counts.where(F.col("group") >= toxicity.WORD))).toPandas()
    model = toxicity.Model(table["key"].to_numpy(), table["value"].to_numpy())
    chunk = next(chunks(pa.array(["vile scum vile", "vile scum vile" + " calm meadow" * 500, "calm meadow"])))
    short, long, clean = toxicity.statistic(model, chunk.data, chunk.offsets)
    assert short[0] > 0 > max(long[0], clean[0]) and short[1] == long[1] > 0 > clean[1]  # no window of a clean text is cut off at 0


def test_toxicity_is_decided_by_the_likelihoods(spark):
    rng = np.random.default_rng(3)
    toxic = rng.random(4000) < 0.2
    x = np.stack([rng.normal(size=4000) * 0.05, np.where(toxic, 6.0, 2.0) + rng.normal(size=4000) * 0.5, rng.normal(size=4000)], 1)
    flipped = np.where(rng.random(4000) < 0.03, ~toxic, toxic)
    curve = toxicity.fit_curve(np.concatenate([x, x]), np.concatenate([flipped, flipped]).astype(float), np.ones(8000))
    hits = lambda b: (1 / (1 + np.exp(-(b[0] + x @ b[1:]))) >= 0.7)
    assert (curve[1:] >= 0).all() and hits(curve)[toxic].mean() > 0.97 and not hits(curve)[~toxic].any()
    against = toxicity.fit_curve(-x, flipped.astype(float), np.ones(4000))  # evidence the wrong way round does not count
    assert (against[1:] >= 0).all()
    assert not hits(np.array([curve[0], curve[1], 0, curve[3]])).any()  # without the window's likelihoods nothing is found


def test_toxicity_of_large_models_is_the_same(spark, monkeypatch):
    rows = [(k, ("vile scum " if k % 5 == 0 else "calm meadow ") * (k % 7 + 1) + prose(__import__("random").Random(k), 40)) for k in range(300)] + [(900, None), (901, "")]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(300)], "doc_id long, toxic int")
    want = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, labels).collect()}
    monkeypatch.setattr(toxicity, "BROADCAST", 0)
    monkeypatch.setattr(toxicity, "BLOCK_BYTES", 4000)
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, labels).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want)


def test_toxicity_held_out(spark):
    import random

    rng = random.Random(0)
    bad = ["grobnik", "zzorp", "quargle", "vexitor"]
    rows, labels = [], []
    for k in range(1500):
        text, toxic = prose(rng, rng.randint(20, 200)), k % 8 == 0
        if toxic:
            w = text.split(" ")
            for _ in range(4):
                w.insert(rng.randrange(len(w) + 1), rng.choice(bad) + rng.choice(["", ",", "s"]))
            text = " ".join(w)
        rows.append((k, text))
        labels.append((k, int(toxic)))
    got = toxicity.score_toxicity(spark.createDataFrame([*rows, (5000, None), (5001, "")], "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).toPandas().set_index("doc_id")
    assert (got["held_out"] == [zlib.crc32(str(d).encode()) % 3 == 1 for d in got.index]).all()
    y = got.index.map(dict(labels))
    held = got[got["held_out"] & y.notna()]
    t = y[got["held_out"] & y.notna()].to_numpy() == 1
    assert (held["predicted"][t] == 1).mean() > 0.95 and (held["predicted"][~t] == 1).mean() < 0.02
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.7)).all() and got.loc[[5000, 5001], "predicted"].sum() == 0


def test_tasks_give_their_memory_back():
    import pyarrow as pa

    from brillouin.llm import shared

    batch = pa.RecordBatch.from_pydict({"text": ["one two", None, "three"]})
    held = []

    def work(chunk, rows):
        chunk.hashes(*chunk.words()[:2])
        held.append(len(shared._powers[0]))
        return rows

    assert [b.to_pydict() for b in shared.by_chunk(work, "text")(iter([batch, batch]))] == [batch.to_pydict()] * 2
    assert held == [shared.CHUNK_BYTES + 1] * 2 and [len(p) for p in shared._powers] == [1, 1]
