"""Main text of web pages by wrapper induction.

Pages of a host that are built alike (the same paths of containers) are a layout.  The DOM tree of every page is aligned by
simple tree matching with a page of median size of its layout and with that of its host's most common layout.  Texts that
nearly all pages of a layout share with such a reference, at the aligned node, are template.  The wrapper of a layout is the place
that holds the varying text of all its pages (an article or main element, or else the deepest element with most of it) and the
template texts.  All texts take part in the alignment but those of scripts, styles and the like.  Every page is then read through its layout's
wrapper: blocks at that place, without the template texts and without what its markup itself names as no part of an article (elements and roles
of HTML, and the parts of a page that `OTHER_WORDS` lists).  A page that does not have the place of its wrapper is read by its own varying text.

Subtrees that are equal are aligned without a look inside.  Lists of children of up to `FULL` are aligned exactly; of longer ones equal ends first, and
then within `BAND` places of the diagonal, twice as many and so on until no partner farther off can matter, so pages that are alike cost about their length.
"""

from __future__ import annotations

import html as entities
import pickle
import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import scratch_dir
from .shared import own_names, with_columns, without, written

#: Share of a layout's pages that makes a text constant, and share of the texts and their characters in the slot of the varying text that makes a page
#: a revision of the reference (two versions of one article don't tell what is template).
CONSTANT, REVISION = 0.8, 0.5
#: Pages that have to share a text for it to be left out inside the slot that holds the article.
MANY = 6
#: Counts that a task holds before it hands them on.
HELD = 1 << 16
#: Children that are aligned without a band, and places from the diagonal that longer lists begin with; depth from which paths name elements by a digest.
FULL, BAND, DEPTH = 32, 12, 128
#: An element holds the article if it has this share of the varying text of the element around it.
MOST = 0.7

# Elements of HTML by how they stand in a text, and words in class and id that name other parts of a page.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes plaintext script style textarea title xmp".split())
OTHER_PARTS = frozenset("aside button canvas datalist dialog footer form head iframe menu nav noscript object optgroup option select svg template".split())
OTHER_WORDS = frozenset("ad ads advert advertisement banner breadcrumb comment comments cookie footer form menu nav navigation notice promo related replies share sidebar sponsored".split())
OTHER_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"})}
CONTAINERS = frozenset("article aside body center div footer form header hgroup html main nav section".split())
_SCOPE = frozenset("table td th caption button object html body".split())
_IN_HEAD = frozenset("title meta link style script base noscript template".split())

_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+|[^>]*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Page:
    """Block elements of a page (parent, tag, path, left out?) and its blocks of text (element, text, characters in links)."""

    def __init__(self, source: str):
        self.parent: list[int] = [-1]
        self.tag: list[str] = ["#page"]
        self.label: list[str] = [""]
        self.path: list[str] = [""]
        self.depth: list[int] = [0]
        self.out: list[bool] = [False]
        self.blocks: list[tuple[int, str, int]] = []
        self._text: list[str] = []
        self._linked = 0
        self._stack: list[tuple[str, int, bool]] = [("#page", 0, False)]  # tag, block element, left out?
        self._opened: Counter[str] = Counter()  # tags on the stack
        self._read(source)

    def _grow(self, parent: int, label: str) -> None:
        """One more element. Paths of the deep name it by a digest below the element at DEPTH, so that none is long."""
        self.parent.append(parent)
        self.label.append(label)
        self.tag.append(label.partition(".")[0])
        self.depth.append(self.depth[parent] + 1)
        above = self.path[parent]
        if self.depth[parent] > DEPTH:
            above, last = above.rpartition(">")[::2]
            label = f"{label.partition('.')[0]}.{_digest(last, label)}"
        self.path.append(f"{above}>{label}")

    def _flush(self) -> None:
        if self._text:
            text = " ".join(entities.unescape("".join(self._text)).split())
            if text:
                self.blocks.append((self._stack[-1][1], text, self._linked))
            self._text, self._linked = [], 0

    def _pop(self, depth: int) -> None:
        if any(t in BLOCKS for t, _, _ in self._stack[depth:]):
            self._flush()
        self._opened.subtract(t for t, _, _ in self._stack[depth:])
        del self._stack[depth:]

    def _close_open(self, wanted: set[str], scope: frozenset[str] | set[str]) -> None:
        if not any(self._opened[t] for t in wanted):
            return None
        for k in range(len(self._stack) - 1, 0, -1):
            if self._stack[k][0] in wanted:
                return self._pop(k)
            if self._stack[k][0] in scope:
                return None
        return None

    def _open(self, tag: str, attributes: str) -> None:
        if tag not in _IN_HEAD and tag != "head" and self._opened["head"]:
            self._close_open({"head"}, frozenset())
        if tag in BLOCKS:
            self._close_open({"p"}, _SCOPE)
        if tag in CLOSES:
            self._close_open(*CLOSES[tag])
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if attributes else {}
        names = [x.lower() for x in _NAME_WORD.findall(f"{found.get('class', '')} {found.get('id', '')}")]
        above = self._stack[-1][2]
        out = above or tag in OTHER_PARTS or found.get("role", "").lower() in OTHER_ROLES or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "") or bool(re.search(r"(?:^|\s)hidden(?:\s|$)", attributes))
        if tag not in ("html", "body", "main", "article"):
            out = out or not OTHER_WORDS.isdisjoint(names)
        inside = self._opened["article"] or self._opened["main"]
        if (tag == "header" or "header" in names) and tag not in ("html", "body", "main", "article") and not re.fullmatch("h[1-6]", tag) and not inside:
            out = True
        element = self._stack[-1][1]
        if tag in BLOCKS:
            self._flush()
            label = f"{tag}.{'.'.join(names)}" if names else tag
            self._grow(element, label)
            self.out.append(out)
            element = len(self.tag) - 1
        if tag not in VOID:
            self._stack.append((tag, element, out))
            self._opened[tag] += 1

    def _read(self, source: str) -> None:
        at = 0
        while at < len(source):
            m = _MARKUP.search(source, at)
            self._put(source[at : m.start() if m else len(source)])
            if not m:
                break
            at = m.end()
            if m[1]:
                tag = m[1].lower()
                if self._opened[tag]:
                    self._pop(next(k for k in range(len(self._stack) - 1, 0, -1) if self._stack[k][0] == tag))
            elif m[2]:
                tag = m[2].lower()
                if tag == "br":
                    self._put(" ")
                    continue
                if tag in RAW:
                    end = re.compile(rf"</{tag}\b[^>]*>|\Z", re.I).search(source, at)
                    at = end.end()
                    continue
                self._open(tag, m[3] or "")
        self._flush()

    def _put(self, text: str) -> None:
        _, element, out = self._stack[-1]
        if text and (not out or self.out[element]):  # the text of an inline element that is out goes, that of a block stays with it
            self._text.append(text)
            if any(t == "a" for t, _, _ in self._stack[-3:]):
                self._linked += len(text)

    def packed(self) -> bytes:
        return pickle.dumps((self.parent, self.label, self.out, self.blocks))

    @classmethod
    def unpacked(cls, data: bytes) -> Page:
        page = cls.__new__(cls)
        parent, labels, page.out, page.blocks = pickle.loads(data)
        page.parent, page.tag, page.label, page.path, page.depth = [-1], ["#page"], [""], [""], [0]
        for above, label in zip(parent[1:], labels[1:], strict=True):
            page._grow(above, label)
        return page

    def layout(self) -> int:
        """Digest of the paths of the containers outside articles."""
        outer, found = [True], set()
        for k in range(1, len(self.tag)):
            outer.append(outer[self.parent[k]] and self.tag[self.parent[k]] != "article" and self.tag[k] in CONTAINERS)
            if outer[k]:
                found.add(self.path[k])
        return int.from_bytes(blake2b("\n".join(sorted(found)).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)

    def inside(self, path: str) -> list[bool]:
        """For each element: does it lie in an element at `path`?"""
        found = [False] * len(self.tag)
        for k in range(len(found)):
            found[k] = self.path[k] == path or (k > 0 and found[self.parent[k]])
        return found


def _digest(path: str, text: str) -> str:
    return blake2b(f"{path}\n{text}".encode("utf-8", "replace"), digest_size=12).hexdigest()


class _Tree:
    def __init__(self, page: Page):
        self.label = page.label
        self.children: list[list[int]] = [[] for _ in page.tag]
        for k in range(1, len(page.tag)):
            self.children[page.parent[k]].append(k)
        own = defaultdict(list)
        for k, text, _ in page.blocks:
            own[k].append(text)
        self.text = ["\n".join(own[k]) for k in range(len(page.tag))]
        self.subtree, self.weight = [""] * len(page.tag), [0.0] * len(page.tag)  # what is in it, and its weight if all of it is aligned
        for k in range(len(page.tag) - 1, -1, -1):
            self.subtree[k] = _digest(self.label[k], "\n".join([self.text[k], *(self.subtree[c] for c in self.children[k])]))
            self.weight[k] = 1.0 + 0.5 * (self.text[k] != "") + sum(self.weight[c] for c in self.children[k])


class _Lists:
    """Which children of two nodes can be aligned: (i, [j, ...]) in order, without the equal ends."""

    def __init__(self, a: _Tree, x: int, b: _Tree, y: int, band: int):
        self.left, self.right = a.children[x], b.children[y]
        n, m = len(self.left), len(self.right)
        self.head = self.tail = 0
        if max(n, m) > FULL:
            while self.head < min(n, m) and a.subtree[self.left[self.head]] == b.subtree[self.right[self.head]]:
                self.head += 1
            while self.tail < min(n, m) - self.head and a.subtree[self.left[-1 - self.tail]] == b.subtree[self.right[-1 - self.tail]]:
                self.tail += 1
        self.rows: list[tuple[int, list[int]]] = []
        self.far: list[tuple[int, list[int]]] = []  # partners beyond the band
        n, m = n - self.head - self.tail, m - self.head - self.tail
        by_label: dict[str, list[int]] = defaultdict(list)
        for j in range(self.head, self.head + m):
            by_label[b.label[self.right[j]]].append(j)
        for i in range(self.head, self.head + n):
            found = by_label.get(a.label[self.left[i]], [])
            if max(n, m) > FULL:
                at = self.head + (i - self.head) * m // max(n, 1)
                low, high = bisect_left(found, at - band), bisect_left(found, at + band + 1)
                if high - low < len(found):
                    self.far.append((i, found[:low] + found[high:]))
                found = found[low:high]
            if found:
                self.rows.append((i, found))

    def bound(self, a: _Tree, b: _Tree) -> float:
        """No chain with a pair beyond the band is heavier than this."""
        p, q = (np.array([t.weight[k] for k in side[self.head : len(side) - self.tail]]) for t, side in ((a, self.left), (b, self.right)))
        before_p, before_q = np.concatenate([[0.0], p.cumsum()]), np.concatenate([[0.0], q.cumsum()])
        most = 0.0
        for i, js in self.far:
            i, j = i - self.head, np.array(js) - self.head
            around = np.minimum(before_p[i], before_q[j]) + np.minimum(before_p[-1] - before_p[i + 1], before_q[-1] - before_q[j + 1])
            most = max(most, float((around + np.minimum(p[i], q[j])).max()))
        return most


def match(a: _Tree, b: _Tree) -> dict[int, int]:
    """Simple tree matching: nodes of `a` and the nodes of `b` they are aligned with; equal texts align first. The band of a long list grows until no
    partner beyond it can be in a heavier alignment."""
    bands: dict[tuple[int, int], int] = {}
    while True:
        pairs, narrow = _matched(a, b, bands)
        if not narrow:
            return pairs
        bands |= {lists: 2 * bands.get(lists, BAND) for lists in narrow}


def _matched(a: _Tree, b: _Tree, bands: dict[tuple[int, int], int]) -> tuple[dict[int, int], list[tuple[int, int]]]:
    """The alignment within these bands, and the lists for which a wider band could give a heavier one."""
    if a.label[0] != b.label[0]:
        return {}, []
    narrow: list[tuple[int, int]] = []
    # pairs of nodes that can be aligned and have children to align, parents first
    lists: dict[tuple[int, int], _Lists] = {}
    todo = [(0, 0)]
    for x, y in todo:
        if a.subtree[x] == b.subtree[y] or not a.children[x] or not b.children[y]:
            continue
        here = lists[x, y] = _Lists(a, x, b, y, bands.get((x, y), BAND))
        todo.extend((here.left[i], here.right[j]) for i, js in here.rows for j in js)
    below: dict[tuple[int, int], float] = {}  # weight of the children's alignment
    chains: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def weight(x: int, y: int) -> float:
        if a.subtree[x] == b.subtree[y]:
            return a.weight[x]
        return 1.0 + 0.5 * (a.text[x] == b.text[y] and a.text[x] != "") + below.get((x, y), 0.0)

    for (x, y), here in reversed(lists.items()):
        # the heaviest chain of pairs that grows on both sides: best[j] is the heaviest that ends at j or before
        ends: list[int] = []
        best: list[float] = []
        back: list[tuple | None] = []
        for i, js in here.rows:
            new = []
            for j in js:
                k = bisect_left(ends, j) - 1
                new.append((j, (best[k] if k >= 0 else 0.0) + weight(here.left[i], here.right[j]), (back[k] if k >= 0 else None, i, j)))
            for j, w, chain in new:
                k = bisect_right(ends, j)
                if k and best[k - 1] >= w:
                    continue
                if k and ends[k - 1] == j:
                    k -= 1
                    best[k], back[k] = w, chain
                else:
                    ends.insert(k, j)
                    best.insert(k, w)
                    back.insert(k, chain)
                stop = k + 1
                while stop < len(ends) and best[stop] <= w:
                    stop += 1
                del ends[k + 1 : stop], best[k + 1 : stop], back[k + 1 : stop]
        if here.far and here.bound(a, b) > (best[-1] if best else 0.0) + 1e-9:
            narrow.append((x, y))
        n, m = len(here.left), len(here.right)
        chain = [(i, i) for i in range(here.head)] + [(n - 1 - t, m - 1 - t) for t in range(here.tail)]
        at = back[-1] if back else None
        while at is not None:
            at, i, j = at
            chain.append((i, j))
        chains[x, y] = [(here.left[i], here.right[j]) for i, j in chain]
        below[x, y] = (best[-1] if best else 0.0) + sum(a.weight[here.left[i]] for i in (*range(here.head), *range(n - here.tail, n)))

    pairs: dict[int, int] = {}
    open_pairs = [(0, 0)]
    while open_pairs:
        x, y = open_pairs.pop()
        pairs[x] = y
        open_pairs.extend(zip(a.children[x], b.children[y], strict=True) if a.subtree[x] == b.subtree[y] else chains.get((x, y), ()))
    return pairs, narrow


def _counts(page: Page, k: int, text: str, linked: int) -> bool:
    return not page.out[k] and 2 * linked <= len(text)


def content_path(pages: list[Page], constants: set[str]) -> str:
    """Path of the element that holds the varying text of these pages."""
    own: Counter[str] = Counter()
    for page in pages:
        for k, text, linked in page.blocks:
            if _counts(page, k, text, linked) and _digest(page.path[k], text) not in constants:
                own[page.path[k]] += len(text)
    return _heaviest(own)


def _heaviest(own: Counter[str]) -> str:
    """Path of the element that holds most of the text, from the characters right at each path."""
    mass: Counter[str] = Counter()
    for path, n in own.items():
        while n > 0:
            mass[path] += n
            if not path:
                break
            path = path.rpartition(">")[0]
    if not mass:
        return ""
    # the outermost article or main element with most of the text, or else go down as long as one child has most of it
    named = [p for p in mass if re.match(r"(?:article|main)(?:\.|$)", p.rpartition(">")[2])]
    named = [p for p in named if mass[p] >= 0.3 * mass[""]]
    for kind in ("article", "main"):
        if mine := [p for p in named if re.match(rf"{kind}(?:\.|$)", p.rpartition(">")[2])]:
            return min(mine, key=lambda p: (-mass[p], len(p), p))
    at = ""
    while True:
        below = [p for p in mass if p.rpartition(">")[0] == at and p != at and p.rpartition(">")[2].partition(".")[0] not in ("p", "li", "h1", "h2", "h3", "td", "blockquote", "pre")]
        best = max(below, key=lambda p: (mass[p], p), default=None)
        if best is None or mass[best] < MOST * mass[at]:
            return at
        at = best


class _Reference:
    """A page that others are aligned with."""

    def __init__(self, page: Page):
        self.tree = _Tree(page)
        self.digests: dict[int, list[str]] = defaultdict(list)
        for k, text, _ in page.blocks:
            self.digests[k].append(_digest(page.path[k], text))
        self.texts = {text for _, text, _ in page.blocks}
        self.heading = next((text for k, text, _ in page.blocks if page.tag[k] == "h1" and not page.out[k]), None)
        self.all = {d for ds in self.digests.values() for d in ds}


def _revision(page: Page, reference: _Reference, equal: set[int]) -> bool:
    """Is the page another version of the reference's article? `equal` are its elements whose text is that of their partner.

    What counts is where the pages agree: in the slot that holds most of the text in which they differ, two articles differ nearly everywhere and two versions of one
    hardly anywhere. Text outside the slot, however much there is, says nothing. Pages with different main headings have different articles.
    """
    counted = [(k, len(text)) for k, text, linked in page.blocks if _counts(page, k, text, linked)]
    varying: Counter[str] = Counter()
    for k, n in counted:
        if k not in equal:
            varying[page.path[k]] += n
    if not varying:
        return True
    heading = next((text for k, text, _ in page.blocks if page.tag[k] == "h1" and not page.out[k]), None)
    if heading is not None and reference.heading is not None and heading != reference.heading:
        return False
    inside = page.inside(_heaviest(varying))
    within = [(k, n) for k, n in counted if inside[k]]
    same = [n for k, n in within if k in equal]
    return len(same) >= REVISION * len(within) and sum(same) >= REVISION * sum(n for _, n in within)


def evidence(page: Page, references: list[_Reference | None]) -> Counter[str]:
    """What a page says about its layout: "v" + reference where it is no revision of that, "e" + reference + digest for each text
    they share, "m" + path for characters at a path, "d" + digest + path for those of texts that a reference has."""
    found: Counter[str] = Counter()
    tree = _Tree(page)
    for n, reference in enumerate(references):
        if reference is None:
            continue
        equal = [(x, y) for x, y in match(reference.tree, tree).items() if reference.tree.text[x] and reference.tree.text[x] == tree.text[y]]
        if _revision(page, reference, {y for _, y in equal}):
            continue
        found[f"v{n}"] += 1
        for digest in {d for x, _ in equal for d in reference.digests[x]}:
            found[f"e{n}{digest}"] += 1
    known = [r for r in references if r is not None]
    for k, text, linked in page.blocks:
        if _counts(page, k, text, linked):
            found[f"m{page.path[k]}"] += len(text)
            if any(text in r.texts for r in known) and any((digest := _digest(page.path[k], text)) in r.all for r in known):
                found[f"d{digest}{page.path[k]}"] += len(text)
    return found


def settled(found: Counter[str]) -> tuple[str, list[str]]:
    """Wrapper from the evidence of all pages of a layout: the path of the content, and digests of the constant texts that MANY pages share."""
    constants = {key[2:] for key, n in found.items() if key[0] == "e" and n >= CONSTANT * found[f"v{key[1]}"]}
    own = Counter({key[1:]: n for key, n in found.items() if key[0] == "m"})
    for key, n in found.items():
        if key[0] == "d" and key[1:25] in constants:
            own[key[25:]] -= n
    shared = {key[2:] for key, n in found.items() if key[0] == "e" and n >= max(MANY, CONSTANT * found[f"v{key[1]}"])}
    return _heaviest(own), sorted(shared)


def induce(sources: list[str]) -> tuple[str, list[str]]:
    """Wrapper of pages of one layout."""
    pages = [Page(s) for s in sources]
    first = _Reference(sorted(pages, key=lambda p: len(p.tag))[(len(pages) - 1) // 2])
    return settled(sum((evidence(p, [first]) for p in pages), Counter()))


def main_text(source: str | Page, path: str | None, constants: set[str]) -> str:
    """Text of a page read through a wrapper (path None: none is known)."""
    page = source if isinstance(source, Page) else Page(source)
    if path is None or (path and path not in page.path):
        path = content_path([page], constants)
    inside = page.inside(path)
    return "\n".join(text for k, text, _ in page.blocks if inside[k] and not page.out[k] and (page.tag[k] in HEADINGS or _digest(page.path[k], text) not in constants))


def _parsed(html: str, width: int, layout: str, nodes: str, page: str):
    """The first columns with the layout, the number of elements and the packed page (null without a page)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                pages = [None if h is None else Page(h) for h in part.column(batch.schema.get_field_index(html)).to_pylist()]
                columns = {layout: pa.array([p and p.layout() for p in pages], pa.int64()), nodes: pa.array([p and len(p.tag) for p in pages], pa.int32()), page: pa.array([p and p.packed() for p in pages], pa.binary())}
                yield with_columns(part.select(list(range(width))), **columns)

    return run


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, layout, key, n) from (host, layout, page, own, other): the evidence of all pages of a task."""
    held: dict[tuple[str, int], Counter[str]] = defaultdict(Counter)

    def out() -> pa.RecordBatch:
        rows = [(h, g, k, n) for (h, g), found in held.items() for k, n in found.items()]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.string(), pa.int64(), pa.string(), pa.int64()))], ["host", "layout", "key", "n"])

    known: dict[bytes, _Reference] = {}
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            for host, group, page, *references in zip(*(c.to_pylist() for c in batch.slice(lo, 256).columns), strict=True):
                for r in references:
                    if r is not None and r not in known:
                        if len(known) >= 256:
                            known.clear()
                        known[r] = _Reference(Page.unpacked(r))
                held[host, group].update(evidence(Page.unpacked(page), [r and (known.get(r) or _Reference(Page.unpacked(r))) for r in references]))
            if sum(map(len, held.values())) > HELD:
                yield out()
    yield out()


def _settle(rows: pa.Table) -> pa.Table:
    path, constants = settled(Counter(dict(zip(rows.column("key").to_pylist(), rows.column("n").to_pylist(), strict=True))))
    return pa.table({"host": rows.column("host")[:1], "layout": rows.column("layout")[:1], "path": [path], "constants": pa.array([constants], pa.list_(pa.string()))})


def extract_text(pages: DataFrame, *, url_col: str = "url", html_col: str = "html", text_name: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """All rows of `pages` with two more columns: the main text, and n_chars, its code points. `keep` names the columns that stay (None: all).

    Blocks are joined by a line feed; white space inside a block is one space; character references are decoded. Inside the slot that holds the article a text
    goes only if at least MANY pages, and nearly all of the layout, have it at the same place; headings always stay.

    Defined cases: a null or empty page has an empty text; a null url, or one without a host, belongs to the host "";
    broken markup is closed where the next element ends it; repeated pages count once in a wrapper; an empty table gives an empty table;
    other columns pass through, but for those named like a result column, which it replaces.
    """
    pages = without(pages, text_name, "n_chars")
    page_columns = [c for c in pages.columns if keep is None or c in keep]
    host, order, layout, nodes, page, row, path, constants = own_names(pages, "host", "order", "layout", "nodes", "page", "row", "path", "constants")
    spark, width = pages.sparkSession, len(page_columns)
    source = F.col(html_col).cast("string")
    given = pages.withColumn(row, source).withColumn(host, F.lower(F.coalesce(F.regexp_extract(F.col(url_col).cast("string"), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))).withColumn(order, F.xxhash64(source))
    given = given.select(*page_columns, host, order, row)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema[:-1])
    parsed = given.mapInArrow(_parsed(row, width + 2, layout, nodes, page), f"{schema}, {layout} long, {nodes} int, {page} binary")
    scratch = scratch_dir(spark)  # every page with its parts: compressed well, as it is the largest table
    parsed.withColumn(row, F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(scratch)
    laid = spark.read.schema(f"{schema}, {layout} long, {nodes} int, {page} binary, {row} long").parquet(scratch)

    # different pages, one of median size for each layout, and that of the host's most common layout
    named = laid.where(F.col(layout).isNotNull()).select(*(F.col(c).alias(n) for c, n in ((host, "host"), (order, "order"), (layout, "layout"), (nodes, "nodes"), (row, "row"))))
    page_key = ["host", "layout", "order", "nodes"]
    chosen = written(named.groupBy(*page_key).agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("copies")))
    repeated = written(named.join(chosen.where("copies > 1"), page_key).where("row > first").select("row"))
    sizes = chosen.groupBy("host", "layout").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("nodes", 0.5).alias("nodes"))
    layouts = written(chosen.join(sizes, ["host", "layout", "nodes"]).groupBy("host", "layout").agg(F.first("n").alias("n"), F.min_by("first", "order").alias("typical")))
    main = layouts.groupBy("host").agg(F.max_by("typical", F.struct("n", "layout")).alias("main"))
    wanted = layouts.join(main, "host").select("host", "layout", F.explode(F.array(F.struct(F.lit(0).alias("which"), F.expr("if(n > 1, typical, NULL)").alias("row")), F.struct(F.lit(1).alias("which"), F.expr("nullif(main, typical)").alias("row")))).alias("r")).select("host", "layout", "r.which", "r.row")
    stored = laid.select(F.col(row).alias("row"), F.col(page).alias("page"))
    references = written(wanted.where("row IS NOT NULL").join(stored, "row").groupBy("host", "layout").agg(F.first(F.expr("if(which = 0, page, NULL)"), True).alias("own"), F.first(F.expr("if(which = 1, page, NULL)"), True).alias("other")))
    pages_of = laid.where(F.col(layout).isNotNull()).select(F.col(host).alias("host"), F.col(layout).alias("layout"), F.col(page).alias("page"), F.col(row).alias("row"))
    one_each = pages_of.join(repeated, "row", "left_anti").join(references, ["host", "layout"], "left").select("host", "layout", "page", "own", "other")
    counted = one_each.mapInArrow(_gather, "host string, layout long, key string, n long").groupBy("host", "layout", "key").agg(F.sum("n").alias("n"))
    wrappers = written(counted.groupBy("host", "layout").applyInArrow(_settle, "host string, layout long, path string, constants array<string>"))
    joined = laid.join(wrappers.select(F.col("host").alias(host), F.col("layout").alias(layout), F.col("path").alias(path), F.col("constants").alias(constants)), [host, layout], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {name: batch.schema.get_field_index(name) for name in (page, path, constants, host, layout)}
            known: dict[tuple[str, int], set[str]] = {}
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = []
                for data, w, c, *who in zip(*(part.column(at[name]).to_pylist() for name in (page, path, constants, host, layout)), strict=True):
                    own = known.get(tuple(who))
                    if own is None:
                        own = known[tuple(who)] = set(c or ())
                    texts.append(main_text(Page.unpacked(data), w, own) if data else "")
                rest = part.select(list(range(width)))
                yield with_columns(rest, **{text_name: pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    columns = [*page_columns, host, layout, page, path, constants]
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in page_columns) + f", `{text_name}` string, n_chars long"
    return joined.select(*columns).mapInArrow(run, schema)
