"""Operator 10: main text of HTML pages by inferred wrappers.

Pages of one host share a template. Each page becomes a nested stream of block
tags and texts; equal neighbours (also sequences of two or three) fold into
repeated groups. The wrapper of a host is a union-free expression over such
streams, inferred by iterative alignment: the stream of the next page is
aligned with the wrapper, what only one side has becomes optional, an optional
item beside its like becomes a repeated group, and texts that differ become
slots. A page whose shape the wrapper has met only adds its texts.

The wrapper then says which text slots are main text: those under the article
or main element, or, where the template has none, those in the smallest
container that holds all the varying text; menus, headers, footers, sidebars,
notices, adverts, forms, comments and the like are left out by the elements on
their path. An element whose class, id or role is the name of such a part is
left out; one that only has a word of it in its name ("related-work") is left
out if its texts repeat from page to page of a host whose pages differ.
Headings, body and html are never left out by a name.

Pages are sorted by host over range partitions, so a host with a third of all
pages spreads over tasks; a task holds ``CHUNK`` pages (or ``CHUNK_BYTES``) at a
time and one wrapper.

Defined cases: null html is empty; a null url is a host of its own; a page
without main text gives an empty string; repeated rows give equal results; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelab.llm.common import small_batches

CHUNK, CHUNK_BYTES = 256, 8 << 20

BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
                   "h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre search section summary table tbody td tfoot th "
                   "thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
#: Elements that never hold main text.
LEFT_OUT = frozenset("head nav header footer aside form script style noscript template textarea title select button dialog menu search iframe object "
                     "svg math canvas audio video datalist input label".split())
#: Words of class and id attributes, and roles, that mark boilerplate; a name of such words alone is sure to.
HINTS = frozenset("ad ads adv advert advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
                  "notification alert popup modal overlay newsletter subscribe subscription signup login sidebar menu nav navbar navigation breadcrumb "
                  "breadcrumbs footer header masthead comment comments commentlist disqus replies reply respond share sharing social related recommended "
                  "recommendations widget pagination pager skip toolbar contentinfo complementary search".split())
#: Reader comments: one of these words, beside words for their container alone.
COMMENTS = frozenset("comment comments commentlist disqus replies".split())
CONTAINERS = frozenset("area block body box container feed holder list panel post reader section thread user wrap wrapper".split())
MAIN = frozenset(("article", "main"))
#: Elements nested deeper lie side by side at this depth: a page's depth bounds no recursion.
DEPTH = 150
#: Sequences whose alignment needs a larger table become one repeated group of their labels.
ALIGN_CELLS = 1 << 20
#: Elements that a hint says nothing about.
UNMARKED = frozenset("html body h1 h2 h3 h4 h5 h6".split())
#: What a start tag ends when it is still open: paragraphs end at blocks, items at their like.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
         "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"), "body": ("head",)}
_SCOPE = frozenset("table ul ol dl div article section main body html nav aside footer header form".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*>)|<[!?/][^>]*>", re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-zA-Z]+")


class Element:
    __slots__ = ("tag", "label", "out", "main", "hinted", "items")

    def __init__(self, tag: str, label: str, out: bool, main: bool, hinted: bool = False):
        self.tag, self.label, self.out, self.main, self.hinted, self.items = tag, label, out, main, hinted, []


def _describe(tag: str, attrs: str, parent: Element) -> Element:
    names: list[list[str]] = []
    if "=" in attrs:
        for _, a, b, c in _ATTR.findall(attrs):
            names += [[w.lower() for w in _WORD.findall(name)] for name in (a or b or c).split()]
    words = {w for name in names for w in name}
    free = tag in UNMARKED or HINTS.isdisjoint(words)
    marked = not free and any(name and (HINTS.issuperset(name) or _of_comments(name)) for name in names)
    holds = tag in MAIN or ("main" in words and tag in ("div", "section") and any("main" in name and HINTS.isdisjoint(name) for name in names))
    out = tag in LEFT_OUT or marked or (parent.out and not (tag in MAIN))
    return Element(tag, ".".join([tag, *sorted(words), *["!"] * marked]), out, (parent.main or bool(holds)) and not out, not free)


def _of_comments(name: list[str]) -> bool:
    return not COMMENTS.isdisjoint(name) and all(w in COMMENTS or w in CONTAINERS for w in name)


def parse(page: str) -> Element:
    """The page as nested block elements; an item is an Element or a block of text."""
    root = Element("", "", False, False)
    stack, text, inline_out = [root], [], []

    def flush() -> None:
        if text:
            block = " ".join(entities.unescape("".join(text)).split())
            if block and len(stack) <= DEPTH:
                stack[-1].items.append(block)
            elif block:  # a block of its own at the last level, in page order
                e = stack[-1]
                stack[DEPTH - 1].items.append(Element(e.tag, e.label, e.out, e.main, e.hinted))
                stack[DEPTH - 1].items[-1].items.append(block)
            text.clear()

    def close(names, scope=_SCOPE) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                flush()
                del stack[i:]
                return
            if stack[i].tag in scope:
                return

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        stop = m.start() if m else end
        if stop > at and not inline_out:
            text.append(page[at:stop])
        if not m:
            break
        at = m.end()
        name = m[2]
        if not name:
            continue
        tag = name.lower()
        if m[1]:
            if tag in BLOCKS:
                inline_out.clear()
                if tag == "p":
                    flush()
                close((tag,), frozenset() if tag in MAIN or tag in ("body", "html") else MAIN - {tag})
            elif inline_out and inline_out[-1] == tag:
                inline_out.pop()
            continue
        if tag in RAW:  # its content is not markup
            close_at = re.compile(f"</{tag}", re.I).search(page, at)
            at = close_at.start() if close_at else end
            if tag not in BLOCKS:
                at = page.find(">", at) + 1 or end
                continue
            at = page.find(">", at) + 1 or end
            continue
        if tag == "br":
            if not inline_out:
                text.append(" ")
            continue
        if tag in BLOCKS:
            inline_out.clear()
            flush()
            if tag in MAIN or tag == "body":
                close(("head",), frozenset())
            close(("p",))
            if tag in _ENDS:
                close(_ENDS[tag], _SCOPE - set(_ENDS[tag]))
            if tag not in VOID:
                e = _describe(tag, m[3], stack[-1])
                if len(stack) < DEPTH:
                    stack[-1].items.append(e)
                stack.append(e)
        elif tag not in VOID and tag in LEFT_OUT and not m[3].endswith("/>"):
            inline_out.append(tag)
    flush()
    return root


class Node:
    """One item of a wrapper: a text slot (label '') or an element with items."""

    __slots__ = ("label", "items", "optional", "repeated", "out", "main", "hinted", "value", "pages", "chars", "texts")

    def __init__(self, label: str, out: bool, main: bool, hinted: bool = False):
        self.label, self.out, self.main, self.hinted, self.items = label, out, main, hinted, []
        self.optional = self.repeated = False
        self.value, self.pages, self.chars = None, 0, 0
        self.texts = None  # hash of a page's texts in this slot, False where pages differ


def template(e: Element) -> Node:
    """The expression of a single page: equal neighbours folded into groups."""
    node = Node(e.label, e.out, e.main, e.hinted)
    for x in e.items:
        node.items.append(Node("", e.out, e.main) if isinstance(x, str) else template(x))
    node.items = fold(node.items)
    return node


def fold(items: list[Node]) -> list[Node]:
    """Squares of up to three items become one repeated sequence."""
    for width in (1, 2, 3):
        out: list[Node] = []
        for x in items:
            out.append(x)
            while len(out) >= 2 * width and all(a.label == b.label for a, b in zip(out[-2 * width:-width], out[-width:])):
                for a, b in zip(out[-2 * width:-width], out[-width:]):
                    merge(a, b)
                    a.repeated = True
                del out[-width:]
        items = out
    return items


def merge(a: Node, b: Node) -> None:
    """Generalise ``a`` so that it also covers ``b`` (of the same label)."""
    a.repeated |= b.repeated
    a.optional |= b.optional
    if a.items or b.items:
        a.items = align(a.items, b.items)


def align(xs: list[Node], ys: list[Node]) -> list[Node]:
    """Longest common subsequence of labels; the rest is optional, then folded again. Very long unlike sequences become one group."""
    if [x.label for x in xs] == [y.label for y in ys]:
        for x, y in zip(xs, ys):
            merge(x, y)
        return xs
    n, m = len(xs), len(ys)
    if n * m > ALIGN_CELLS:
        return _group([*xs, *ys])
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if xs[i].label == ys[j].label else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and xs[i].label == ys[j].label:
            merge(xs[i], ys[j])
            out.append(xs[i])
            i, j = i + 1, j + 1
        elif j >= m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            xs[i].optional = True
            out.append(xs[i])
            i += 1
        else:
            ys[j].optional = True
            out.append(ys[j])
            j += 1
    return fold(out)


def _group(items: list[Node]) -> list[Node]:
    """One repeated sequence of optional items, one of each label: covers any order of them."""
    first: dict[str, Node] = {}
    for x in items:
        if x.label in first:
            merge(first[x.label], x)
        else:
            first[x.label] = x
    for x in first.values():
        x.optional = x.repeated = True
    return list(first.values())


def shape(e: Element) -> tuple:
    """What two pages must share to be read alike by a wrapper: the folded labels."""
    out: list = []
    for x in e.items:
        s = "" if isinstance(x, str) else (x.label, shape(x))
        if not out or out[-1] != s:
            out.append(s)
    return tuple(out)


class Wrapper:
    """The expression of one host, and which of its slots hold main text."""

    def __init__(self) -> None:
        self.root: Node | None = None
        self.shapes: set = set()
        self.learned = 0
        self.left_out: set[int] = set()

    def learn(self, page: Element) -> None:
        s = shape(page)
        if s not in self.shapes:
            self.shapes.add(s)
            new = template(page)
            if self.root is None:
                self.root = new
            else:
                merge(self.root, new)
        on_page: dict[int, tuple[Node, list[str]]] = {}
        for slot, block in read(self.root, page):
            on_page.setdefault(id(slot), (slot, []))[1].append(block)
            slot.pages += 1
            slot.chars += len(block)
            if slot.value is None:
                slot.value = block
            elif slot.value != block:
                slot.value = False  # a slot: its text varies

        self.learned += 1
        for slot, blocks in on_page.values():
            texts = hash(tuple(blocks))
            slot.texts = texts if slot.texts is None or slot.texts == texts else False

    def repeating(self) -> set[int]:
        """Slots of hinted elements whose texts repeat, on a host whose pages differ."""
        found: set[int] = set()
        if self.learned > 1 and any(s.texts is False for s in leaves(self.root)):
            stack = [self.root]
            while stack:
                node = stack.pop()
                slots = [s for s in leaves(node) if not s.out] if node.hinted else []
                if slots and all(s.pages > 1 and s.texts is not False for s in slots):
                    found.update(id(s) for s in slots)
                else:
                    stack += [c for c in node.items if c.label]
        return found

    def main_slots(self) -> set[int]:
        self.left_out = self.repeating()
        slots = [s for s in leaves(self.root) if not s.out and id(s) not in self.left_out]
        under = {id(s) for s in slots if s.main}
        if under:
            return under
        kept = {id(s) for s in slots}
        varying = lambda n: sum(s.chars for s in leaves(n) if id(s) in kept and (s.value is False or s.pages == 1))
        node, total = self.root, varying(self.root)
        while total:
            child = max((c for c in node.items if c.label), key=varying, default=None)
            if child is None or child.repeated or varying(child) < total or not any(c.label for c in child.items):
                break
            node = child
        return {id(s) for s in leaves(node) if id(s) in kept}


def leaves(node: Node) -> Iterator[Node]:
    for x in node.items:
        if x.label:
            yield from leaves(x)
        else:
            yield x


def read(node: Node, e: Element) -> Iterator[tuple[Node, str]]:
    """(slot, block) of the page's texts, in page order, by the wrapper's expression."""
    k, items = 0, node.items
    for x in e.items:
        label = "" if isinstance(x, str) else x.label
        n = len(items)
        for step in range(n):  # onwards from the last match, and round for repeated sequences
            at = (k + step) % n
            if items[at].label == label:
                k = at
                if label:
                    yield from read(items[at], x)
                else:
                    yield items[at], x
                break


def main_text(wrapper: Wrapper, slots: set[int], page: Element) -> str:
    found = list(read(wrapper.root, page))
    blocks = [b for s, b in found if id(s) in slots]
    if not blocks and any(b for s, b in found if not s.out and id(s) not in wrapper.left_out):  # a page unlike its host's others
        own = Wrapper()
        own.learn(page)
        mine = own.main_slots()
        blocks = [b for s, b in read(own.root, page) if id(s) in mine]
    return "\n\n".join(blocks)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    host, wrapper, held, held_bytes = object(), Wrapper(), [], 0

    def done() -> pa.RecordBatch:
        pages = [parse(h) for _, _, h in held]
        for p in pages:
            wrapper.learn(p)
        slots = wrapper.main_slots()
        texts = [main_text(wrapper, slots, p) for p in pages]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in held], id_type), pa.array([x[1] for x in held], pa.string()),
                                           pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                          ["page_id", "url", "text", "n_chars"])

    id_type = None
    for batch in batches:
        id_type = batch.schema.field("page_id").type
        for h, i, u, doc in zip(*(batch.column(c) for c in ("host", "page_id", "url", "html"))):
            h, doc = h.as_py(), doc.as_py() or ""
            if held and (h != host or len(held) >= CHUNK or held_bytes >= CHUNK_BYTES):
                yield done()
                held, held_bytes = [], 0
            if h != host:
                host, wrapper = h, Wrapper()
            held.append((i.as_py(), u.as_py(), doc))
            held_bytes += len(doc)
    if held:
        yield done()


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    small_batches(pages.sparkSession)
    id_type = pages.schema["page_id"].dataType.simpleString()
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    rows = (pages.select("page_id", "url", "html", host.alias("host")).withColumn("at", F.xxhash64("page_id"))
            .repartitionByRange("host", "at").sortWithinPartitions("host", "at").drop("at"))
    return rows.mapInArrow(_extract, f"page_id {id_type}, url string, text string, n_chars long")
