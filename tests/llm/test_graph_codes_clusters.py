"""Host ranks, vector codes and clusters against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brillouin.llm import clustering, code_compression
from brillouin.llm.clustering import cluster_vectors, leading, nearest
from brillouin.llm.code_compression import CoverTree, compress_vectors
from brillouin.llm.integer_vectors import largest, squared_distances
from brillouin.llm.link_trust import filter_urls, host_ranks

INF, NAN = float("inf"), float("nan")


def lloyd(x, centres, rounds):
    """Plain Lloyd rounds in Python integers."""
    far = lambda: ((x[:, None].astype(object) - centres[None].astype(object)) ** 2).sum(2)
    for _ in range(rounds):
        at = far().argmin(1)
        centres = np.array([[int(s) // int((at == k).sum()) for s in x[at == k].astype(object).sum(0)] if (at == k).any() else c for k, c in enumerate(centres.tolist())], object).reshape(centres.shape)
    d = far()
    return d.argmin(1), d.min(1), centres


def vectors(dims, n=150, seed=3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(9, dims))
    x = np.concatenate([centre[rng.integers(0, 9, n)] + 0.2 * rng.normal(size=(n, dims)), np.repeat(centre[:2], 40, 0), rng.integers(-2, 3, (n // 2, dims)) / 4]).astype(np.float32)
    return [(int(k) * 3, v.tolist(), k % 4 if k % 5 else None) for k, v in enumerate(rng.permutation(x))]


def odd(dims):
    return [(5001, None, 1), (5002, [None] + [1.0] * (dims - 1), 1), (5003, [NAN] + [1.0] * (dims - 1), 1), (5004, [INF] + [0.0] * (dims - 1), 2), (5005, [0.0] * dims, None), (5006, [3e38] + [-3e38] * (dims - 1), 7), (None, [0.5] * dims, 1), (None, [0.25] * dims, 1), (0, [0.125] * dims, 2), (0, [0.125] * dims, 2)]


def whole(x, scale, dims):
    return np.clip(np.floor(np.array(x, np.float32).astype(float) * scale), -largest(dims), largest(dims)).astype(np.int64)


SCHEMA = "vec_id long, embedding array<float>, label int"


def test_clusters_are_those_of_plain_lloyd_rounds(spark, monkeypatch):
    monkeypatch.setattr(clustering, "SHARE", 0.5)
    rows = vectors(8) + odd(8) + [(6001, [1.0] * 7, 1), (6002, [], 1), (6003, [1.0] * 9, 3)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("cluster", F.lit("mine")).withColumn("inertia", F.lit(None).cast("int"))
    got = cluster_vectors(frame.repartition(5), dims=8, clusters=12, rounds=3, scale=64)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    kept = [r for r in rows if r[1] is not None and len(r[1]) == 8 and None not in r[1] and np.isfinite(r[1]).all()]
    x = whole([r[1] for r in kept], 64, 8)
    draw = [hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "~" for r in kept]
    order = sorted(range(len(kept)), key=lambda k: (draw[k], x[k].tolist()))[:12]
    at, far, centres = lloyd(x, x[order], 3)
    digest = [hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest() for c in centres]
    want = [(kept[k][0], at[k], int(far[k]), int(far[at == at[k]].sum()), int(far.sum()), digest[at[k]]) for k in range(len(kept))]
    key = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted((tuple(v if v is None or isinstance(v, str) else int(v) for v in w) for w in want), key=key)


def test_clusters_of_nothing_of_one_and_of_text_ids(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert cluster_vectors(none).count() == 0 and compress_vectors(none).count() == 0
    one = spark.createDataFrame([("a", [0.5] * 64, "x")], "vec_id string, embedding array<double>, label string")
    assert [tuple(r)[:5] for r in cluster_vectors(one).collect()] == [("a", 0, 0, 0, 0)]
    assert [tuple(r)[:4] for r in compress_vectors(one).collect()] == [("a", "00000000", 0, 0)]


def test_bounds_leave_out_most_centroids_and_never_the_nearest():
    rng = np.random.default_rng(8)
    basis = rng.normal(size=(5, 64))
    x = (256 * (rng.normal(size=(3000, 5)) @ basis + 0.05 * rng.normal(size=(3000, 64)))).astype(np.int64)
    mean, moments = x.mean(0), np.cov(x.T)
    axes = np.linalg.eigh(moments)[1][:, ::-1]
    axes = axes[:, :16]
    centroids = np.concatenate([x[:40], x[:3]])  # with ties
    at, far, compared = nearest(x, leading(x, mean, axes).astype(np.float32).astype(float), centroids, leading(centroids, mean, axes))
    exact = squared_distances(x, centroids)
    assert (at == exact.argmin(1)).all() and (far == exact.min(1)).all() and compared < exact.size / 8


@pytest.mark.parametrize("dims", [8, 6])
def test_codes_are_those_of_plain_lloyd_rounds(spark, dims):
    rows = vectors(dims) + odd(dims) + [(6001, [1.0] * 4, 1), (6002, [], 1), (6003, [0.5] * 4, None)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("code", F.lit("mine"))
    got = compress_vectors(frame.repartition(4), entries=20, rounds=3, scale=32)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    kept = [r for r in rows if r[1] is not None and None not in r[1] and np.isfinite(r[1]).all()]
    found = []
    for length in {len(r[1]) for r in kept}:
        own = [r for r in kept if len(r[1]) == length]
        x = whole([r[1] for r in own], 32, length).reshape(len(own), length)
        order = sorted(range(len(own)), key=lambda k: (own[k][0] is None, own[k][0] or 0, x[k].tolist()))[:20]
        x = np.concatenate([x, np.zeros((len(x), -length % 4), np.int64)], 1)
        parts = [lloyd(p, p[order], 3) for p in np.split(x, 4, axis=1)]
        digest = hashlib.sha256(",".join(str(int(v)) for _, _, c in parts for e in c for v in e).encode()).hexdigest()
        found += [(r[0], "".join(f"{p[0][k]:02x}" for p in parts), sum(int(p[1][k]) for p in parts), r[2], digest) for k, r in enumerate(own)]
    limit = (1 << 63) - 1
    want = [(i, c, e, min(limit, sum(f[2] for f in found if f[3] == label)), d) for i, c, e, label, d in found]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("leaf", [8, 1])
def test_cover_trees_assign_whole_subtrees(monkeypatch, leaf):
    monkeypatch.setattr(code_compression, "LEAF", leaf)
    rng = np.random.default_rng(4)
    centre = rng.integers(-4000, 4000, (30, 16))
    rows = np.concatenate([centre[rng.integers(0, 30, 2000)] + rng.integers(-30, 31, (2000, 16)), np.repeat(centre[:1], 500, 0)])
    tree, place = CoverTree.build(rows)
    assert (tree.points[place] == rows).all() and tree.weights.sum() == len(rows)
    for node in tree.nodes:  # covered, and nested in the parent
        inside = tree.points[node["lo"] : node["hi"]]
        assert np.sqrt(squared_distances(inside, tree.points[[node["centre"]]]).max()) <= node["radius"] * (1 + 1e-12)
        if node["parent"] >= 0:
            up = tree.nodes[node["parent"]]
            assert up["lo"] <= node["lo"] < node["hi"] <= up["hi"] and node["radius"] <= up["radius"] / 2
    entries = np.concatenate([centre, centre[:2], rng.integers(-4000, 4000, (40, 16))])
    total, n, groups, points, single = tree.assign(entries)
    exact = squared_distances(rows, entries).argmin(1)
    label, far = tree.labels(entries)
    assert (label[place] == exact).all() and (far[place] == squared_distances(rows, entries).min(1)).all()
    assert all((total[k] == rows[exact == k].sum(0)).all() and n[k] == (exact == k).sum() for k in range(len(entries)))
    assert len(points) < len(tree.points) / 10 and len(groups) < len(tree.points) / 10


def test_distances_are_exact_at_any_size():
    x = np.array([[largest(3)] * 3, [-largest(3)] * 3, [1, 2, 3]])
    assert squared_distances(x, x).tolist() == [[int(sum((int(a) - int(b)) ** 2 for a, b in zip(p, q, strict=True))) for q in x] for p in x]


RULES = (("allow", "org/"), ("block", "a.org/x/"), ("block", "a.org/x/y"), ("allow", "a.org/x/y"), ("block", "bad.com/"))


def ranks(seeds, links, damping=0.85, rounds=20):
    unit = 1 << 20
    own = {h: (a * unit, b * unit) for h, a, b in seeds if a + b}
    now = dict(own)
    for _ in range(rounds):
        new = {h: [np.floor(v * (1 - damping)) for v in x] for h, x in own.items()}
        for (s, d), w in links.items():
            for a, b, k, whole in ((s, d, 0, sum(v for (p, _), v in links.items() if p == s)), (d, s, 1, sum(v for (_, q), v in links.items() if q == d))):
                new.setdefault(b, [0, 0])[k] += np.floor(now.get(a, (0, 0))[k] * (damping * w / whole))
        now = {h: tuple(x) for h, x in new.items() if sum(x)}
    return {h: (int(a), int(b)) for h, (a, b) in now.items()}


def test_ranks_are_those_of_plain_rounds(spark):
    rng = random.Random(2)
    hosts = [f"h{k}" for k in range(30)]
    links = {}
    for _ in range(90):
        a, b = rng.sample(hosts, 2)
        links[a, b] = rng.randint(1, 9)
    seeds = [(h, rng.randint(0, 3), rng.randint(0, 2)) for h in hosts[:8]]
    got = host_ranks(spark.createDataFrame(seeds, "host string, allowed long, blocked long"), spark.createDataFrame([(a, b, w) for (a, b), w in links.items()], "src string, dst string, weight long"))
    assert {r["host"]: (r["trust"], r["distrust"]) for r in got.collect()} == ranks(seeds, links)


def test_urls_are_judged_by_rules_and_by_their_hosts_links(spark):
    link = lambda *hosts: "".join(f'<p><A class=x\nHREF = "https://{h}/p?q">x</a>' for h in hosts)
    pages = [
        (1, "http://Good.ORG/", link("friend.net", "FRIEND.net", "good.org")),
        (2, "http://good.org/2", link("friend.net")),
        (3, "https://friend.net/?a=://b.org/", link("friend2.net")),
        (4, "http://farm.net/p", link("bad.com", "www.bad.com")),
        (5, "http://bad.com/1", link("good.org")),
        (6, "http://www.bad.com/2#x", None),
        (7, "http://farm2.net/", "<area href='//farm.net'>" + link("farm.net")),
        (8, "http://friend2.net", ""),
        (9, "http://alone.net/x/y", "<p>https://bad.com</p><link href='http://bad.com/'><abbr href='http://bad.com/'>"),
        (10, "http://a.org/x/yes", ""),
        (11, "http://s.a.org/x/z?/x/y", ""),
        (12, "http://notbad.com/", ""),
        (13, "http://x.org", ""),
        (14, None, link("bad.com")),
        (15, "no url", None),
        (None, "http://good.org/2", link("friend.net")),
        (16, "http://" + "long." * 20_000 + "org/" + "p" * 100_000, "<a " * 50_000),
    ]
    frame = spark.createDataFrame([(*p, "mine", "x") for p in pages], "page_id long, url string, html string, verdict string, host string")
    got = {r["page_id"]: r for r in filter_urls(frame, RULES).collect()}
    assert len(got) == len(pages) and filter_urls(frame.limit(0), RULES).count() == 0
    assert {k: (got[k]["rule"], got[k]["verdict"]) for k in (1, 2, 5, 6, 10, 11, 13, 14, 15, 16)} == {
        1: ("org/", "allow"), 2: ("org/", "allow"), 5: ("bad.com/", "block"), 6: ("bad.com/", "block"), 10: ("a.org/x/y", "block"), 11: ("a.org/x/", "block"), 13: (None, "allow"), 14: (None, "allow"), 15: (None, "allow"), 16: ("org/", "allow"),
    }
    assert {k: got[k]["verdict"] for k in (3, 4, 7, 8, 9, 12)} == {3: "allow", 4: "block", 7: "block", 8: "allow", 9: "allow", 12: "allow"}
    assert got[3]["trust"] > 0 == got[3]["distrust"] and got[8]["trust"] > 0 and got[7]["distrust"] > got[7]["trust"] == 0 and got[9]["trust"] == got[9]["distrust"] == 0
    assert (got[3]["host"], got[3]["path"], got[1]["host"], got[8]["path"], got[15]["host"], got[15]["path"], got[11]["path"]) == ("friend.net", "/", "good.org", "", "", "", "/x/z")
