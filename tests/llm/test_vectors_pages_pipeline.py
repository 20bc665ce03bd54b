"""Vector join and page extraction against brute force; the pipeline stage by stage."""

import html as entities
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from brillouin.llm import embedding_join
from brillouin.llm.wrapper import Page, _Tree, extract_text, induce, main_text, match

from .corpus import awkward, prose


@pytest.mark.parametrize("block,fan_out", [(2048, 16), (20, 2)])
def test_epsilon_grid_join(spark, monkeypatch, block, fan_out):
    monkeypatch.setattr(embedding_join, "BLOCK", block)
    monkeypatch.setattr(embedding_join, "FAN_OUT", fan_out)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 8))
    x = np.concatenate([rng.normal(size=(150, 8)), *(b + 0.15 * rng.normal(size=(6, 8)) for b in base), np.repeat(base[:1], 30, 0)]).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(9000, None), (9001, [0.0] * 8), (9002, [float("nan")] + [1.0] * 7), (9003, [None] + [1.0] * 7), (9004, []), (9005, [float("inf")] * 8), (None, x[0].tolist()), (9006, [1.0, 2.0]), (9007, [2.0, 4.0])]
    got = {r["vec_id"]: r for r in embedding_join.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    label = np.arange(len(u))
    while True:
        new = np.minimum(label, np.where(near, label[None], len(u)).min(1))
        if (new == label).all():
            break
        label = new
    for k in range(len(u)):
        assert (got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) == (near[k].sum(), label[k], label[k] == k)
    for k in (9000, 9001, 9002, 9003, 9004, 9005):
        assert (got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) == (0, k, True)
    assert got[9007]["component_id"] == 9006 and got[9006]["n_links"] == 1 and got[None]["n_links"] == 0


def test_epsilon_grid_join_of_nothing(spark):
    assert embedding_join.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def site(kind, i, body):
    menu = f'<div class="site-header"><a href="/">Home {i}</a></div><ul class="menu"><li><a href=x>Link {i}</a></li></ul><div class="cookie-notice">We use cookies</div>'
    if kind == "article":
        main = f"<nav>{i}</nav><!-- ad {i} --><article><h1>Title {i}</h1>{body}</article><aside>See {i}</aside>"
    elif kind == "div":
        main = f'<div id="wrap"><div class="content"><h1>Title {i}</h1>{body}<div class="share">Share</div></div><div class="sidebar"><p>Popular {i}</p></div></div>'
    elif kind == "main":
        main = f'<div class="x1"><p>Welcome to our site.</p></div><main><h1>Title {i}</h1>{body}<section class="comments"><p>Reader {i}: nice</p></section></main>'
    else:
        main = f'<table><tr><td class="nav">links {i}</td><td class="c2"><h1>Title {i}</h1>{body}</td></tr></table><div class="zz">What we are about, on every page.</div>'
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{menu}{main}<form><input>Subscribe</form><footer>&copy; {i}"


KINDS = ["article", "div", "main", "table"]


@pytest.mark.parametrize("kind", KINDS)
def test_wrapper(kind):
    bodies = ["".join(f"<p>Part {j} of {i} &amp; <b>more\n words</b>&nbsp;here." + ("</p>" if j % 2 else "") for j in range(3 + i % 3)) for i in range(9)]
    pages = [site(kind, i, b) for i, b in enumerate(bodies)]
    path, constants = induce(pages[:8])
    want = "\n".join(["Title 8", *(f"Part {j} of 8 & more words here." for j in range(5))])
    assert main_text(pages[8], path, set(constants)) == want


def test_simple_tree_matching_aligns_equal_parts():
    a, b = (_Tree(Page(f"<div><p>same</p><p>{x}</p></div><ul><li>1</li></ul>")) for x in ("one", "two"))
    pairs = match(a, b)
    assert len(pairs) == len(a.label) and all(a.label[x] == b.label[y] for x, y in pairs.items())


def test_extract_text(spark):
    rows = [((n + 1) * 100 + i, f"http://{kind}.example.org/{i}", site(kind, i, f"<p>Body {i}.</p>")) for n, kind in enumerate(KINDS) for i in range(12)]
    rows += [(1, None, "<p>No host"), (2, "http://article.example.org/z", None), (3, "http://article.example.org/e", ""), (4, "not a url", "<b>plain &lt;text&gt; <br> here"), (5, "http://x.org", "<!-- never closed"), (6, "http://y.org", "<p>" + "long text. " * 50_000), rows[0]]
    frame = spark.createDataFrame([(*r, "mine") for r in rows], "page_id long, url string, html string, n_chars string")
    got = extract_text(frame).collect()
    assert len(got) == len(rows) and extract_text(frame.limit(0)).count() == 0
    by = {r["page_id"]: r["text"] for r in got}
    for n in range(4):
        for i in range(12):
            if n or i:
                assert by[(n + 1) * 100 + i] == f"Title {i}\nBody {i}."
    assert (by[1], by[2], by[3], by[4], by[5]) == ("No host", "", "", "plain <text> here", "")
    assert len(by[6]) == 50_000 * len("long text. ") - 1 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert entities.unescape("&amp;") == "&"


def test_wrappers_come_from_all_pages_of_hosts_of_any_size(spark):
    own = [f"<p>Words {i} of its own, {j}.</p>" for i in range(40) for j in range(2)]

    def page(i, template, extra=""):
        return f'<html><body><{template}><h1>Title {i}</h1>{own[2 * i]}{own[2 * i + 1]}<p>Written in {template} for you.</p>{extra}</{template}></body></html>'

    rows = [(i, "http://two.org/", page(i, "article")) for i in range(2)]  # no tree alignment below six pages
    rows += [(10 + i, "http://large.org/", page(i, "article")) for i in range(30)]
    rows += [(60 + i, "http://large.org/", page(30 + i, "main")) for i in range(3)]  # a layout that a sample can miss
    rows += [(90 + i, "http://copy.org/", page(7, "article", f"<p>Version {i}</p>")) for i in range(9)]  # one article, nine times
    got = {r["page_id"]: r["text"] for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k, _, _ in rows[:35]:
        i = k if k < 10 else k - 10 if k < 60 else k - 30
        shared = "" if 10 <= k < 60 else "\nWritten in article for you." if k < 10 else "\nWritten in main for you."  # two or three pages do not make it template
        assert got[k] == f"Title {i}\nWords {i} of its own, 0.\nWords {i} of its own, 1." + shared
    assert all("Title 7" in got[90 + i] and "Words 7 of its own, 0." in got[90 + i] for i in range(9))


@pytest.mark.parametrize("words", [200, 60, 20, 5])
@pytest.mark.parametrize("headed", [False, True])
def test_template_may_outweigh_the_article(spark, words, headed):
    template = [" ".join(f"template{j}word{w}" for w in range(30)) + "." for j in range(10)]
    bodies = [[" ".join(f"own{i}part{p}word{w}" for w in range(words)) + "." for p in range(2)] for i in range(12)]

    def page(i):
        own = "".join(f"<p>{b}</p>" for b in bodies[i])
        title = f"<h1>Title {i}</h1>" if headed else ""
        return f'<html><body><div class="a"><div class="z">{"".join(f"<p>{t}</p>" for t in template)}</div><div class="y">{title}{own}</div></div></body></html>'

    rows = [(i, "http://heavy.org/", page(i)) for i in range(12)]
    got = {r["page_id"]: r["text"] for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: "\n".join([*([f"Title {i}"] if headed else []), *bodies[i]]) for i in range(12)}


@pytest.mark.parametrize("n", [2, 12])
def test_articles_keep_the_headings_they_share(n):
    pages = [f"<html><body><div class=a><div class=menu>Menu</div><div class=b><h1>Dish {i}</h1><h2>Summary</h2><p>This is dish {i}, of its own.</p><h2>Method</h2><p>Cook {i} in {i + 3} pots.</p></div></div>" for i in range(n)]
    path, constants = induce(pages)
    for i in range(n):
        assert main_text(pages[i], path, set(constants)) == f"Dish {i}\nSummary\nThis is dish {i}, of its own.\nMethod\nCook {i} in {i + 3} pots."


def test_wrappers_are_those_of_a_plain_alignment_of_all_pages(spark):
    """The wrapper by definition: every page aligned with the reference, texts counted one by one, the slot from what is left."""
    rng = __import__("random").Random(7)
    template = ["We write about the world, every day of the year.", "Read our terms before you go on, please.", "All the pictures are our own work, or licensed."]
    pages = []
    for i in range(14):
        own = "".join(f"<p>{prose(rng, rng.randint(8, 40))}</p>" for _ in range(rng.randint(2, 5)))
        lead = f"<p>{template[0]}</p>" if rng.random() < 0.95 else ""
        pages.append(f"<html><body><div class=k><div class=m><p>{template[1]}</p><p>{template[2]}</p></div><div class=n>{lead}{own}</div></div></body></html>")
    parsed = [Page(p) for p in pages]
    reference = sorted(parsed, key=lambda p: len(p.tag))[(len(pages) - 1) // 2]
    a, shared, seen = _Tree(reference), {}, 0
    for page in parsed:
        b = _Tree(page)
        texts = {a.text[x] for x, y in match(a, b).items() if a.text[x] and a.text[x] == b.text[y]}
        if len(texts) < len({t for t in b.text if t}):  # not the reference itself
            seen += 1
            for t in texts:
                shared[t] = shared.get(t, 0) + 1
    constant = {t for t, n in shared.items() if n >= 0.8 * seen}
    want = ["\n".join(text for _, text, _ in p.blocks if text not in constant) for p in parsed]
    assert constant == set(template)
    got = extract_text(spark.createDataFrame([(i, "http://plain.org/", p) for i, p in enumerate(pages)], "page_id long, url string, html string")).orderBy("page_id").collect()
    assert [r["text"] for r in got] == want


def test_tree_matching_of_deep_and_wide_pages():
    deep = "<div>" * 3000 + "same"
    assert len(match(_Tree(Page(deep)), _Tree(Page(deep)))) == 3001
    began, deeper = time.time(), Page("<div><section>" * 5000 + "same")
    assert len(deeper.tag) == 10_001 and max(map(len, deeper.path)) < 5000
    assert len(match(_Tree(deeper), _Tree(Page("<div><section>" * 5000 + "other")))) == 10_001 and time.time() - began < 20
    wide = [_Tree(Page("".join(f"<p>{i}</p>" for i in range(n, 100)))) for n in (0, 40)]
    assert {wide[0].text[x] for x, y in match(*wide).items() if wide[0].text[x] == wide[1].text[y]} >= {str(i) for i in range(40, 100)}


def test_long_tables_are_aligned_in_seconds():
    pages = ["<table>" + "".join(f"<tr><td>{i * 7919 % 1000}</td><td>{k} of {i}</td></tr>" for i in range(k, 5000)) + "</table>" for k in (0, 3)]
    began = time.time()
    a, b = (_Tree(Page(p)) for p in pages)
    pairs = match(a, b)
    assert time.time() - began < 30 and len(pairs) > 14_000
    assert sum(a.text[x] == b.text[y] != "" for x, y in pairs.items()) > 4500  # rows moved by three places


def test_simple_tree_matching_against_brute_force():
    """The weight of the alignment is that of the textbook recursion on small random trees."""
    import random

    rng = random.Random(3)

    def tree(depth=0):
        tag = rng.choice(["div", "ul", "section"])
        inside = "".join(tree(depth + 1) for _ in range(rng.randint(0, 3))) if depth < 3 else ""
        return f"<{tag}>{rng.choice(['', 'a', 'b'])}{inside}</{tag}>"

    def best(a, x, b, y):
        if a.label[x] != b.label[y]:
            return 0.0
        left, right = a.children[x], b.children[y]
        table = [[0.0] * (len(right) + 1) for _ in range(len(left) + 1)]
        for i, p in enumerate(left, 1):
            for j, q in enumerate(right, 1):
                table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + best(a, p, b, q))
        return 1.0 + 0.5 * (a.text[x] == b.text[y] != "") + table[-1][-1]

    for _ in range(60):
        a, b = (_Tree(Page("".join(tree() for _ in range(3)))) for _ in "ab")
        pairs = match(a, b)
        assert sum(1.0 + 0.5 * (a.text[x] == b.text[y] != "") for x, y in pairs.items()) == best(a, 0, b, 0)
        above = {c: k for t in (a,) for k in range(len(t.label)) for c in t.children[k]}
        assert all(pairs[above[x]] in range(len(b.label)) and y in b.children[pairs[above[x]]] for x, y in pairs.items() if x)


def test_wrapper_decides_where_markup_names_nothing():
    """Ablation: without its wrapper a page keeps the template's texts and takes the wrong part."""
    def page(i):
        links = "".join(f"<p>Other story number {i * 31 + k} that is not this page's own</p>" for k in range(2))
        body = "".join(f"<p>Sentence {k} of story {i}, with words enough to be the longest part of all.</p>" for k in range(6))
        return f'<body><div class="qa"><p>Welcome to our pages.</p></div><div class="qb"><p>You read the daily paper.</p><h1>Story {i}</h1>{body}<div><p>Written by the desk.</p></div></div><div class="qc">{links}</div>'

    pages = [page(i) for i in range(12)]
    path, constants = induce(pages)
    for i, html in enumerate(pages):
        want = "\n".join([f"Story {i}", *(f"Sentence {k} of story {i}, with words enough to be the longest part of all." for k in range(6))])
        assert main_text(html, path, set(constants)) == want != main_text(html, None, set())


def test_pipeline_stages(spark, tmp_path):
    import random

    import corpus_pipeline as P
    from brillouin.llm import quality

    from .test_documents import WORD, brute_components, kept_lines

    rng = random.Random(9)
    rows = [(k, prose(rng, rng.randint(60, 150)), "en", f"s{k % 3}", 0) for k in range(60)]
    rows += [(100 + k, rows[k][1] + " alra", "en", "s0", 0) for k in range(5)] + [(200 + k, " | ".join(prose(rng, 80).split()), "en", "s1", 0) for k in range(4)]
    rows = [(d, t + "\nA line that many documents hold in common." if d % 5 == 0 else t, lang, s, len(t)) for d, t, lang, s, _ in rows] + [(300, "short", "en", "s2", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert [n for n, _ in P.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "mixing", "packing"]
    seen = [docs]
    for k, (_, stage) in enumerate(P.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, seen[-1], str(tmp_path)).write.parquet(path)
        seen.append(spark.read.parquet(path))
        if k < 4:
            assert seen[-1].columns == docs.columns
    texts = lambda d: {r["doc_id"]: r["text"] for r in d.collect()}
    kept = {r["doc_id"] for r in quality.rate_quality(docs).where("kept").collect()}
    first = texts(seen[1])
    assert set(first) == kept and not any(200 <= d < 204 or d == 300 for d in kept) and len(kept) == 65
    second = texts(seen[2])
    assert second == {d: t for d, _, _, t in kept_lines(list(first.items()))}
    third = texts(seen[3])
    groups = brute_components(list(second.items()), 5, 80, 100)
    assert set(third) == {d for d, (_, c) in groups.items() if c == d} and len(third) < len(second)
    fourth = seen[4].collect()
    words = sum(len(WORD.findall(t)) for t in third.values())
    assert abs(sum(len(WORD.findall(r["text"])) for r in fourth) - words) <= 3
    assert all(third[r["doc_id"]].startswith(r["text"]) and r["n_chars"] == len(r["text"]) for r in fourth)
    assert seen[5].agg(F.sum("length")).first()[0] == seen[5].where("start = 0").agg(F.sum("doc_tokens")).first()[0]


def test_pipeline_stages_of_awkward_rows(spark, tmp_path):
    """Nulls, repeated rows and ids, ties, clashing columns; each stage on the same rows, and on none."""
    import corpus_pipeline as P

    from .corpus import SCHEMA
    from .test_documents import WORD, brute_components

    docs = spark.createDataFrame(awkward(), SCHEMA).withColumn("row", F.lit(1)).withColumn("key", F.lit("k")).withColumn("taken", F.lit("t"))
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    given = docs.collect()
    for name, stage in P.STAGES:
        got = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert got.columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
        rows = got.collect()
        if name == "quality rules":
            assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in given if len(WORD.findall(r["text"] or "")) >= 50} and len(rows) > 20
        elif name == "line dedup":
            assert len(rows) == len(given) and all(r["key"] == "k" and r["row"] == 1 and r["n_chars"] == len(r["text"]) for r in rows)
        elif name == "n-gram Jaccard join":
            numbered = list(enumerate(given))
            component = {k: c for k, (_, c) in brute_components([(k, r["text"]) for k, r in numbered], 5, 80, 100).items()}
            assert len(rows) == len(set(component.values()))
            least = {}
            for k, r in numbered:
                mine = (r["doc_id"] is None, r["doc_id"] or 0)
                least[component[k]] = min(least.get(component[k], mine), mine)
            assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted(least.values())
        elif name == "mixing":
            assert all(r["taken"] == "t" and WORD.search(r["text"]) for r in rows)


def test_long_lists_align_far_from_the_diagonal():
    from brillouin.llm.wrapper import Page, _Tree, match

    page = lambda *texts: _Tree(Page("<html><body><div>" + "".join(f"<p>{t}</p>" for t in texts) + "</div></body></html>"))
    menu = [f"entry {n}" for n in range(60)]
    a, b = page("a", *menu, *(f"x{n}" for n in range(20))), page("b", *(f"y{n}" for n in range(20)), *menu, "c")
    pairs = match(a, b)
    assert sum(a.text[k] == b.text[pairs[k]] for k in pairs if a.text[k].startswith("entry")) == 60
