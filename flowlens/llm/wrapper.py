"""Main-text extraction by wrapper induction.

Every page is parsed into a DOM tree; its elements are slots, named by the path
of signatures from the root (siblings with the same tag and class are one
repeated slot). A host's wrapper comes from all its pages: for each slot, in how
many different pages it occurs, which texts it held in how many of them, and how
much of it is links. Texts that nearly all pages of a slot hold are template;
varying slots are content unless they are links or stand in page furniture
(navigation, footers, adverts, forms and so on).

Pages of a host can have several layouts, so slots are counted three times: over
the host, and over the pages with the same elements in the upper levels (two
depths). A text is template where one of these says so, and the finest one with
enough pages decides on links.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: A text is constant when in this share of a slot's pages, which are MIN_PAGES or more (equal pages count once).
CONSTANT = 0.8
MIN_PAGES = 4
#: Constant text may be this share of a content slot's text; beyond it the
#: pages are copies of one article and nothing in the slot is template.
MAX_TEMPLATE = 0.4
#: Constant text may be this share of a layout's text; beyond it the layout is
#: that of copies of one page, and only the other counts decide.
MAX_CONSTANT = 0.5
#: Share of link text from which a list or block counts as links.
LINK_SHARE = 0.6
#: Levels of the tree whose elements outside the main element tell layouts apart.
LAYOUT_DEPTHS = (3, 5)

# Fixed values of HTML: kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
FURNITURE = frozenset("nav footer aside form button menu dialog fieldset input head".split())
MAIN = frozenset("article main".split())
#: Elements that end an open element of the second kind.
CLOSES = {
    **{t: {"p"} for t in "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 "
       "h6 header hr main menu nav ol p pre section table ul".split()},
    "li": {"p", "li"}, "dt": {"p", "dt", "dd"}, "dd": {"p", "dt", "dd"}, "tr": {"p", "tr", "td", "th"},
    "td": {"p", "td", "th"}, "th": {"p", "td", "th"}, "option": {"option"}, "tbody": {"p", "tr", "td", "th", "thead"},
}
#: Elements that such closing doesn't reach beyond.
SCOPE = frozenset("html body article main section div ul ol dl table nav aside footer header form td th li blockquote".split())
#: Words of class, id and role that mark furniture wherever they stand in a name,
STRONG = frozenset("ad ads adv advert advertisement adverts banner sponsor sponsored promo promotion cookie cookies consent "
                   "gdpr popup modal overlay sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs "
                   "disqus comments newsletter subscribe subscription signup login widget toolbar complementary contentinfo "
                   "pagination pager".split())
#: those that do so as a whole name or at its end (a share-price is no share, a notice-period no notice),
MARKS = STRONG | frozenset("notice notices alert footer masthead share sharing social related recommended comment replies "
                           "search skip".split())
#: and whole names: the header of a post holds its title.
NAMES = frozenset("header site-header page-header top-header main-header".split())


def marks_furniture(value: str) -> bool:
    """Whether a class, id or role says that its element is furniture."""
    for name in value.split():
        words = re.split(r"[^a-z]+", name.strip("-_"))
        if name in NAMES or words[-1] in MARKS or words[0] in MARKS and len(words) == 1 or not STRONG.isdisjoint(words):
            return True
        # a number or a side at the end is no word of its own
        if len(words) > 1 and words[-1] in ("", "top", "bottom", "left", "right", "box", "wrap", "wrapper", "container", "area", "block", "bar", "section") \
                and words[-2] in MARKS:
            return True
    return False


TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s>/]*)[^>]*(?:>|\Z)"
                   r"|<([a-zA-Z][^\s>/]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
SPACES = re.compile(r"\s+")


class Node:
    """An element: signature, tag, marks (furniture by its attributes), children
    (nodes and strings)."""

    __slots__ = ("tag", "sign", "marked", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag = tag
        found = [v.strip("\"'").lower() for _, v in ATTRIBUTE.findall(attributes)] if attributes else []
        self.sign = " ".join([tag, *(re.sub(r"\d+", "#", v) for v in found)])
        self.marked = any(map(marks_furniture, found))
        self.children: list = []


class _Open:
    """The open elements of a page, the root first, with the places of each tag,
    of blocks and of SCOPE elements, so that no tag looks through them all."""

    def __init__(self, root: Node):
        self.stack, self.places = [root], {}

    def push(self, node: Node) -> None:
        for key in self._keys(node.tag):
            self.places.setdefault(key, []).append(len(self.stack))
        self.stack.append(node)

    def close(self, place: int) -> None:
        while len(self.stack) > place:
            for key in self._keys(self.stack.pop().tag):
                self.places[key].pop()

    def last(self, *keys: str) -> int:
        """The innermost place of these keys, 0 for none."""
        return max((p[-1] for p in map(self.places.get, keys) if p), default=0)

    @staticmethod
    def _keys(tag: str) -> list[str]:
        return [tag, *(["#block"] if tag not in INLINE else []), *(["#scope"] if tag in SCOPE else [])]


def parse(page: str) -> Node:
    """The DOM tree of a page, however deep; broken markup gives some tree, never an error."""
    root = Node("#root")
    open_, at, n = _Open(root), 0, len(page)
    stack = open_.stack
    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            stack[-1].children.append(page[at:])
            break
        if m.start() > at:
            stack[-1].children.append(page[at:m.start()])
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            place = open_.last(tag)
            # an inline end tag never closes a block
            if place and (tag not in INLINE or place > open_.last("#block")):
                open_.close(place)
        elif m[2]:
            tag = m[2].lower()
            ends = CLOSES.get(tag, ())
            while (place := open_.last(*ends)) and place >= open_.last("#scope"):
                open_.close(place)
                if tag not in ("tr", "td", "th", "tbody"):
                    break
            node = Node(tag, m[3])
            stack[-1].children.append(node)
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else n
            elif tag not in VOID and not m[3].endswith("/"):
                open_.push(node)
    return root


def clean(text: str) -> str:
    return SPACES.sub(" ", entities.unescape(text)).strip()


def matching(left: list, right: list, weight) -> list[tuple[int, int]]:
    """Simple tree matching of two ordered child lists: the pairs (i, j) of an
    order-keeping matching of the largest total weight (0: not the same kind)."""
    table = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    own = [[weight(a, b) for b in right] for a in left]
    for i in range(len(left) - 1, -1, -1):
        for j in range(len(right) - 1, -1, -1):
            w = own[i][j]
            table[i][j] = max(table[i + 1][j], table[i][j + 1], table[i + 1][j + 1] + w if w else 0)
    pairs, i, j = [], 0, 0
    while i < len(left) and j < len(right):
        w = own[i][j]
        if w and table[i][j] == table[i + 1][j + 1] + w:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif table[i][j] == table[i + 1][j]:
            i += 1
        else:
            j += 1
    return pairs


def digest(*parts: object) -> int:
    """A signed 64-bit hash of the parts."""
    raw = "\0".join(map(str, parts)).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


class Slot:
    """A slot of a page: path hash, parent (None for the root), characters and those in links."""

    __slots__ = ("path", "tag", "parent", "depth", "main", "off", "chars", "links", "below", "texts")

    def __init__(self, path: int, tag: str, parent: Slot | None, main: bool, off: bool):
        self.path, self.tag, self.parent, self.main, self.off = path, tag, parent, main, off
        self.depth = parent.depth + 1 if parent else 0
        self.chars, self.links, self.below, self.texts = 0, 0, {}, {}

    def dense(self) -> bool:
        """Whether the slot is links by this page alone."""
        return is_links(self.chars, self.links)


def is_links(chars: float, links: float) -> bool:
    return chars > 0 and links > LINK_SHARE * chars


#: Elements that can be judged as links. A paragraph is prose, however much of it is a link.
BLOCKS = frozenset("ul ol div section table nav li".split())


class Page:
    """A parsed page: its slots (parents first), the blocks of text outside
    furniture in order, as (slot, text), and its layouts, the host's (0) first."""

    def __init__(self, page: str):
        root = Slot(digest("#root"), "#root", None, False, False)
        self.slots, self.blocks = [root], []
        self._walk(parse(page), root)
        for slot in reversed(self.slots[1:]):
            slot.parent.chars += slot.chars
            slot.parent.links += slot.chars if slot.tag == "a" else slot.links
        upper = [s for s in self.slots if not s.off and not s.main and s.tag not in INLINE]
        self.layouts = [0, *(digest(k, *sorted(s.path for s in upper if s.depth <= k)) for k in LAYOUT_DEPTHS)]
        for slot, text in self.blocks:
            slot.texts[digest(text)] = len(text)

    def _walk(self, tree: Node, root: Slot) -> None:
        run: list[str] = []

        def flush(slot: Slot) -> None:
            text = clean("".join(run))
            run.clear()
            if text:
                self.blocks.append((slot, text))

        # (children left, slot, slot of the block around)
        stack = [(iter(tree.children), root, root)]
        while stack:
            children, slot, block = stack[-1]
            for child in children:
                if isinstance(child, str):
                    slot.chars += len(child)
                    if not slot.off:
                        run.append(child)
                    continue
                if child.tag in RAW:
                    continue
                if child.tag in VOID:
                    if child.tag != "wbr" and not slot.off:
                        flush(block)
                    continue
                inner = slot.below.get(child.sign)
                if inner is None:
                    off = slot.off or child.tag in FURNITURE or child.marked or child.tag == "header" and not slot.main
                    inner = Slot(digest(slot.path, child.sign), child.tag, slot, slot.main or child.tag in MAIN, off)
                    slot.below[child.sign] = inner
                    self.slots.append(inner)
                inline = child.tag in INLINE
                if not inline and not slot.off:
                    flush(block)
                stack.append((iter(child.children), inner, block if inline else inner))
                break
            else:
                stack.pop()
                if slot is block and not slot.off:
                    flush(block)

    def counts(self) -> Iterator[tuple]:
        """(layout, slot, text, characters, those in links, characters of texts,
        links by this page, main) of each slot (text null) and each text of it
        (the rest of the row only has its characters)."""
        for slot in self.slots:
            if slot.off or not slot.texts and slot.tag not in BLOCKS:
                continue
            dense = int(slot.dense()) if slot.tag in BLOCKS else None
            for layout in self.layouts:
                yield layout, slot.path, None, slot.chars, slot.links, sum(slot.texts.values()), dense, int(slot.main)
                for text, size in slot.texts.items():
                    yield layout, slot.path, text, 0, 0, size, None, None


def induce(pages: list[str]) -> list[str]:
    """The wrapper of a host from all its pages, in one process (``wrappers`` does
    the same for a table): the entries that ``_Known`` reads."""
    slots: dict[tuple, list] = {}
    texts: dict[tuple, list] = {}
    for page in dict.fromkeys(pages):
        for layout, path, text, chars, links, size, dense, main in Page(page).counts():
            if text is None:
                s = slots.setdefault((layout, path), [0, 0, 0, 0, set(), main])
                s[:4] = s[0] + 1, s[1] + chars, s[2] + links, s[3] + size
                s[4] |= {dense}
            else:
                t = texts.setdefault((layout, path, text), [0, 0])
                t[:] = t[0] + 1, t[1] + size
    out = []
    for (layout, path), (n, chars, links, *_) in slots.items():
        if len(slots[0, path][4]) > 1 and (layout == 0 or n >= MIN_PAGES):
            out.append(f"{layout}:{path}:{'+' if is_links(chars, links) else '-'}")
    template: dict[tuple, list] = {}
    for (layout, path, text), (n, size) in texts.items():
        of = slots[layout, path]
        if of[0] >= MIN_PAGES and n >= CONSTANT * of[0]:
            template.setdefault((layout, path), []).append((text, size))
    total: dict[int, list] = {}
    for (layout, path), s in slots.items():
        t = total.setdefault(layout, [0, 0])
        t[:] = t[0] + s[3], t[1] + sum(size for _, size in template.get((layout, path), ()))
    for (layout, path), found in template.items():
        s = slots[layout, path]
        if s[5] and sum(size for _, size in found) > MAX_TEMPLATE * s[3]:
            continue
        if layout and total[layout][1] > MAX_CONSTANT * total[layout][0]:
            continue
        out += [f"{layout}:{path}:{text}" for text, _ in found]
    return sorted(out)


class _Known:
    """A wrapper: template texts as (layout, slot, text), and link verdicts of
    (layout, slot) where the pages of a host differ."""

    __slots__ = ("template", "links")

    def __init__(self, entries: list[str]):
        self.template, self.links = set(), {}
        for entry in entries:
            layout, path, what = entry.split(":")
            if what in "+-":
                self.links[int(layout), int(path)] = what == "+"
            else:
                self.template.add((int(layout), int(path), int(what)))


def extract(page: str, wrapper: _Known | None) -> str:
    """The main text of a page: blocks in order, joined by one space.

    Where the page has a main element, only its text counts.
    """
    tree = Page(page)
    fine = tree.layouts[::-1]
    off: dict[int, bool] = {}
    for slot in tree.slots:
        links = False
        if slot.tag in BLOCKS and not slot.off:
            known = wrapper.links if wrapper else {}
            links = next((known[k, slot.path] for k in fine if (k, slot.path) in known), slot.dense())
        off[id(slot)] = slot.off or links or bool(slot.parent) and off[id(slot.parent)]
    template = wrapper.template if wrapper else ()
    blocks = []
    for slot, text in tree.blocks:
        if off[id(slot)]:
            continue
        if template:
            hashed = digest(text)
            if any((k, slot.path, hashed) in template for k in fine):
                continue
        blocks.append((slot.main, text))
    if any(main for main, _ in blocks):
        blocks = [b for b in blocks if b[0]]
    return " ".join(text for _, text in blocks)


def host_of(url: "F.Column"):
    """The host of a URL, null where there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", F.lower(host))


_COUNTS = "host string, layout long, slot long, text long, n double, chars double, links double, size double, dense int, main int"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("host", pa.string()), *[(n, pa.int64()) for n in ("layout", "slot", "text")],
                        *[(n, pa.float64()) for n in ("n", "chars", "links", "size")],
                        ("dense", pa.int32()), ("main", pa.int32())])
    for batch in batches:
        rows: list[tuple] = []
        for host, page, copies in zip(*[batch.column(i) for i in range(3)]):
            host, part = host.as_py(), 1 / copies.as_py()
            for layout, slot, text, chars, links, size, dense, main in Page(page.as_py()).counts():
                rows.append((host, layout, slot, text, part, chars * part, links * part, size * part, dense, main))
            if len(rows) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def wrappers(df: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(wrapper_host, wrapper: entries joined by spaces) of every host that has entries.

    All pages are counted; of a page that a host holds c times, each counts 1/c.
    Only counts and hashes are shuffled, pre-aggregated, and texts of fewer than
    MIN_PAGES pages end there.
    """
    pages = df.where(F.col(html).isNotNull()).select(host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
    pages = pages.where(F.col("host").isNotNull() & (F.col("html") != "")).withColumn("h", F.xxhash64("html"))
    copies = written(pages.groupBy(F.col("host").alias("__host"), F.col("h").alias("__h")).agg(
        F.count(F.lit(1)).alias("copies")).where("copies > 1"))
    weighted = pages.join(copies, (F.col("host") == F.col("__host")) & (F.col("h") == F.col("__h")), "left").select(
        "host", "html", F.coalesce("copies", F.lit(1)).alias("copies"))
    keys = ["host", "layout", "slot"]
    # parts of pages sum up to whole ones but for rounding
    few = 1e-6
    counts = written(weighted.mapInArrow(_count, _COUNTS).groupBy(*keys, "text").agg(
        *[F.sum(c).alias(c) for c in ("n", "chars", "links", "size")], F.min("dense").alias("lo"),
        F.max("dense").alias("hi"), F.max("main").alias("main")).where(
        F.col("text").isNull() | (F.col("n") >= MIN_PAGES - few)))
    slots = counts.where("text is null").drop("text")
    dense = (F.col("chars") > 0) & (F.col("links") > LINK_SHARE * F.col("chars"))
    mixed = slots.where("layout = 0 and lo < hi").select("host", "slot")
    links = (slots.join(mixed, ["host", "slot"], "left_semi").where((F.col("layout") == 0) | (F.col("n") >= MIN_PAGES - few))
             .select(*keys, F.when(dense, "+").otherwise("-").alias("what")))
    of = slots.select(*keys, F.col("n").alias("pages"), F.col("size").alias("all"), "main")
    # few texts are in most pages of a slot
    found = (counts.where("text is not null").drop("main").join(of, keys)
             .where((F.col("pages") >= MIN_PAGES - few) & (F.col("n") >= CONSTANT * F.col("pages") - few))
             .groupBy(*keys).agg(F.collect_list("text").alias("texts"), F.sum("size").alias("constant"),
                                 F.first("all").alias("all"), F.first("main").alias("main")))
    found = written(found)
    alike = (found.groupBy("host", "layout").agg(F.sum("constant").alias("constant"))
             .join(slots.groupBy("host", "layout").agg(F.sum("size").alias("all")), ["host", "layout"])
             .where((F.col("layout") != 0) & (F.col("constant") > MAX_CONSTANT * F.col("all"))).select("host", "layout"))
    template = (found.where((F.col("main") == 0) | (F.col("constant") <= MAX_TEMPLATE * F.col("all")))
                .join(alike, ["host", "layout"], "left_anti")
                .select(*keys, F.explode(F.col("texts").cast("array<string>")).alias("what")))
    return (links.unionByName(template).select("host", F.concat_ws(":", "layout", "slot", "what").alias("entry"))
            .groupBy(F.col("host").alias("wrapper_host")).agg(
                F.concat_ws(" ", F.sort_array(F.collect_list("entry"))).alias("wrapper")))


def _texts(pages: pa.Array, known: pa.Array) -> Iterator[str]:
    read: dict[str, _Known] = {}
    for page, wrapper in zip(pages, known):
        page, wrapper = page.as_py() or "", wrapper.as_py()
        if wrapper is not None and wrapper not in read:
            if len(read) > 1000:
                read.clear()
            read[wrapper] = _Known(wrapper.split())
        yield extract(page, read.get(wrapper)) if page else ""


def main_texts(df: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of ``df``: page_id, url, text, n_chars.

    A null or empty page has an empty text. Pages without a host (a null or
    odd URL) have no wrapper and are judged by their own elements alone, as are
    hosts with fewer than MIN_PAGES different pages as far as constant texts go. Repeated pages get equal rows; an empty table gives an empty
    result. Pages move only where the wrappers of all hosts are too large to be
    broadcast, which their written size decides.
    """
    known = written(wrappers(df, url, html))

    @F.arrow_udf("string")
    def texts(pages: pa.Array, wrapper: pa.Array) -> pa.Array:
        return pa.array(_texts(pages, wrapper), pa.string())

    pages = df.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    joined = pages.withColumn("host", host_of(F.col("url"))).join(
        known, F.col("host") == F.col("wrapper_host"), "left")
    return joined.select("page_id", "url", texts("html", "wrapper").alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long"))
