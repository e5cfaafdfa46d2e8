"""Main text of web pages by wrapper induction over the pages of a host.

A page is parsed into a tree of its block elements; the texts between block borders are its leaves. Pages of a host that
use the same block tags are of one layout. Each page is aligned with its layout's pivot, the page of smallest id that has
a text, by simple tree matching: two elements match if their tags do, and matched elements align their children in order
so that most elements match. A pivot leaf whose text recurs unchanged on nearly all other pages of the layout is template;
leaves whose text varies are slots of content. What no pivot has is found by place: a text that recurs under the same path
of tags on nearly all pages that have this path, of the layout or of the host, is template too. Equal pages count once, so
copies of an article never turn it into template.

From a page's leaves go: those in elements that are no article by kind, name or role, blocks or not (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles, comments), and template leaves. A class, id or element name of which
only a part is such a word is a vote, and loses it where the element holds most of the page's text. Where an article element
holds at least half of the text left, what is outside it goes; elsewhere leaves that are mostly links and no paragraphs. If
only template would remain, it is content (a host of one article).

Defined cases: null or empty html gives an empty text. A page without a host in its url has no pivot and no template.
Repeated rows and null page_ids give one row each. A host of very many pages is spread by the join's skew handling.
"""

from __future__ import annotations

import functools
import html as references
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beaconlake.llm.common import bounded_batches, hold, tidy
from beaconlake.session import written

#: Characters of pages and their pivots whose leaves are held together, and shapes and matches that a task remembers.
RUN, SHAPES, MATCHES = 1 << 20, 100_000, 500_000
#: Other pages that must show a leaf unchanged, and their share among the pages that have the leaf.
TEMPLATE_PAGES = 3
TEMPLATE_SHARE = 0.9

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>|<[!?/][^>]*>|<[a-zA-Z!?/][^<>]*\Z", re.S
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Attributes of elements inside a line that can make them noise; most have none of them.
TELLING = re.compile(r"\b(?:class|id|hidden|aria-hidden|style|role)\b", re.I)
NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Element kinds of HTML, and names and roles by which page parts are commonly marked.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript object ol optgroup"
    " option p pre section select summary svg table tbody td template tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes".split())
SPACING = frozenset("br img input wbr".split())
DROPPED = frozenset(
    "head nav footer aside form script style noscript template iframe object svg button select dialog menu fieldset".split()
)
MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie"
    " cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup"
    " promo related reply replies respond share sharing sidebar sidebars skip social sponsor sponsored subscribe toolbar"
    " widget widgets".split()
)
#: Parts of a name that count as the whole of it: what readers write may be longer than the article.
READERS = frozenset("comment comments disqus reply replies respond".split())
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation note search toolbar".split())
#: Open elements that a new one of these kinds closes.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
}
LISTS = frozenset("ul ol dl table menu select div section article body".split())


class Element:
    __slots__ = ("tag", "kids", "noise", "main", "marks", "path")

    def __init__(self, tag: str, noise: bool, main: bool, marks: tuple[int, ...] = (), above: int = 0):
        self.tag, self.noise, self.main, self.marks, self.kids = tag, noise, main, marks, []
        self.path = (above * 1_000_003 + zlib.crc32(tag.encode())) & (2**63 - 1)  # a hash of the tags from the root on


class Leaf:
    __slots__ = ("text", "links", "noise", "main", "marks", "paragraph", "number", "path")

    def __init__(self, text: str, links: int, within: Element):
        self.text, self.links, self.noise, self.main = text, links, within.noise, within.main
        self.marks, self.paragraph, self.number, self.path = within.marks, within.tag == "p", -1, within.path


def _is_noise(tag: str, attributes: str, within: Element) -> bool | None:
    """Whether an element is no part of an article; None if part of a name says so, which is but a vote."""
    if tag in DROPPED or (tag == "header" and not within.main):
        return True
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} if attributes.strip() else {}
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
        return True
    if found.get("role", "").lower() in ROLES:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    names = f"{found.get('class', '')} {found.get('id', '')} {tag if '-' in tag else ''}".split()
    vote: bool | None = False
    for name in names:
        parts = [n.lower() for n in NAMES.findall(name)]
        if parts and all(n in MARKED for n in parts) or any(n in READERS for n in parts):
            return True
        if any(n in MARKED for n in parts):
            vote = None
    return vote


def parsed(page: str) -> tuple[Element, list[Leaf]]:
    """The tree of block elements, and its leaves in page order."""
    root = Element("#page", False, False)
    stack, leaves = [root], []
    text: list[str] = []
    link_text, depth_of_link, votes = 0, 0, 0
    inline: list[tuple[str, int, bool]] = []  # open elements inside a line: name, blocks around them, and whether they are noise

    def flush() -> None:
        nonlocal link_text
        shown = " ".join(references.unescape("".join(text)).split())
        if shown:
            leaf = Leaf(shown, link_text, stack[-1])
            leaf.number = len(leaves)
            leaves.append(leaf)
            stack[-1].kids.append(leaf)
        text.clear()
        link_text = 0

    at, size = 0, len(page)
    while at < size:
        found = TOKEN.search(page, at)
        piece = page[at : found.start() if found else size]
        if piece and not (inline and inline[-1][2]):
            text.append(piece)
            if depth_of_link:
                link_text += len(piece)
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if not found[1]:
            if tag in RAW:
                closing = re.compile(f"</{tag}\\b[^>]*>", re.I).search(page, at)
                at = closing.end() if closing else size
            elif tag in BLOCKS or "-" in tag:
                flush()
                closed = CLOSES.get(tag, frozenset()) | {"p"}
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in closed:
                        del stack[i:]
                    elif stack[i].tag in LISTS:
                        break
                inline = [x for x in inline if x[1] <= len(stack)]
                if tag not in VOID and not found[3].endswith("/"):
                    top = stack[-1]
                    main = top.main or tag in ("article", "main") or 'role="main"' in found[3]
                    noise = _is_noise(tag, found[3], top)
                    votes += noise is None
                    marks = (*top.marks, votes) if noise is None else top.marks
                    own = Element(tag, top.noise or bool(noise) or bool(inline and inline[-1][2]), main, marks, top.path)
                    top.kids.append(own)
                    stack.append(own)
            elif tag in SPACING:
                text.append(" ")
            elif tag not in VOID:
                if tag == "a":
                    depth_of_link = 1
                if not found[3].endswith("/"):
                    hidden = bool(inline and inline[-1][2]) or (bool(TELLING.search(found[3])) and _is_noise(tag, found[3], stack[-1]) is True)
                    inline.append((tag, len(stack), hidden))
        elif tag in BLOCKS or "-" in tag:
            flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            inline = [x for x in inline if x[1] <= len(stack)]
        else:
            if tag == "a":
                depth_of_link = 0
            for i in range(len(inline) - 1, -1, -1):
                if inline[i][0] == tag:
                    del inline[i:]
                    break
    flush()
    # a vote counts against an element that holds no more than half of what is left without it
    weight = [0] * (votes + 1)
    for leaf in leaves:
        if not leaf.noise:
            weight[0] += len(leaf.text)
            for mark in leaf.marks:
                weight[mark] += len(leaf.text)
    for leaf in leaves:
        leaf.noise = leaf.noise or any(2 * weight[mark] <= weight[0] for mark in leaf.marks)
    return root, leaves


class Matcher:
    """Simple tree matching; sizes of matches are kept for shapes already met. Trees of any depth are walked without recursion."""

    def __init__(self):
        self.shapes: dict[tuple, int] = {}
        self.sizes: list[int] = []
        self.kids: list[tuple[int, ...]] = []
        self.labels: list[str] = []
        self.matched: dict[tuple[int, int], int] = {}

    def _shapes(self, root) -> dict[int, int]:
        """The shape of each node of a tree, by the node's identity."""
        order, stack = [], [root]
        while stack:
            node = stack.pop()
            order.append(node)
            if not isinstance(node, Leaf):
                stack.extend(node.kids)
        out: dict[int, int] = {}
        for node in reversed(order):
            key = ("#text",) if isinstance(node, Leaf) else (node.tag, *[out[id(kid)] for kid in node.kids])
            if key not in self.shapes:
                self.shapes[key] = len(self.shapes)
                self.labels.append(key[0])
                self.kids.append(key[1:])
                self.sizes.append(1 + sum(self.sizes[k] for k in key[1:]))
            out[id(node)] = self.shapes[key]
        return out

    def shape(self, node) -> int:
        """A number that trees of equal tags and form share."""
        return self._shapes(node)[id(node)]

    def _known(self, a: int, b: int) -> int | None:
        if a == b:
            return self.sizes[a]
        return self.matched.get((a, b)) if self.labels[a] == self.labels[b] else 0

    def size(self, a: int, b: int) -> int:
        """Elements of the largest match of two shapes."""
        stack = [(a, b)]
        while stack:
            x, y = stack[-1]
            if self._known(x, y) is not None:
                stack.pop()
                continue
            open_pairs = [(p, q) for p in set(self.kids[x]) for q in set(self.kids[y]) if self._known(p, q) is None]
            if open_pairs:
                stack.extend(open_pairs)
            else:
                self.matched[x, y] = 1 + self._table(self.kids[x], self.kids[y])[-1][-1]
        return self._known(a, b)

    def _table(self, a: tuple[int, ...], b: tuple[int, ...]) -> list[list[int]]:
        """Sizes of the largest matches of first kids; ``size`` has been called for all pairs, or is now."""
        table = [[0] * (len(b) + 1)]
        for x in a:
            above, row = table[-1], [0]
            for j, y in enumerate(b):
                known = self._known(x, y)
                row.append(max(above[j + 1], row[j], above[j] + (self.size(x, y) if known is None else known)))
            table.append(row)
        return table

    def align(self, a, b, out: dict[int, int]) -> None:
        """Numbers of b's leaves to numbers of the leaves of a that they match; a and b match themselves."""
        shapes = self._shapes(a) | self._shapes(b)
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            if isinstance(a, Leaf):
                out[b.number] = a.number
                continue
            left, right = [shapes[id(k)] for k in a.kids], [shapes[id(k)] for k in b.kids]
            first = 0
            while first < min(len(left), len(right)) and left[first] == right[first]:
                stack.append((a.kids[first], b.kids[first]))
                first += 1
            last = 0
            while last < min(len(left), len(right)) - first and left[-1 - last] == right[-1 - last]:
                stack.append((a.kids[-1 - last], b.kids[-1 - last]))
                last += 1
            left, right = left[first : len(left) - last], right[first : len(right) - last]
            table = self._table(tuple(left), tuple(right))
            i, j = len(left), len(right)
            while i and j:
                gain = self.size(left[i - 1], right[j - 1])
                if gain and table[i][j] == table[i - 1][j - 1] + gain:
                    stack.append((a.kids[first + i - 1], b.kids[first + j - 1]))
                    i, j = i - 1, j - 1
                elif table[i][j] == table[i - 1][j]:
                    i -= 1
                else:
                    j -= 1


@functools.lru_cache(maxsize=64)
def _pivot(page: str):
    return parsed(page)


hold("pivots", _pivot.cache_clear)

LEAVES = "array<struct<text: string, node: int, same: boolean, path: bigint>>"
LEAF_TYPE = pa.list_(pa.struct([("text", pa.string()), ("node", pa.int32()), ("same", pa.bool_()), ("path", pa.int64())]))


def content(page: str, pivot: str | None, matcher: Matcher) -> list[dict]:
    """Leaves that may be content: text, the pivot leaf they match (-1: none), whether that has the same text, and path."""
    root, leaves = parsed(page)
    node: dict[int, int] = {}
    if pivot == page:  # its leaves are those of the pivot, and no evidence about them
        return [{"text": x.text, "node": x.number, "same": None, "path": x.path} for x in _chosen(leaves)]
    if pivot is not None:
        base, base_leaves = _pivot(pivot)
        if len(matcher.shapes) > SHAPES or len(matcher.matched) > MATCHES:
            matcher.__init__()
        matcher.align(base, root, node)
    out = []
    for leaf in _chosen(leaves):
        at = node.get(leaf.number, -1)
        out.append({"text": leaf.text, "node": at, "same": at >= 0 and base_leaves[at].text == leaf.text, "path": leaf.path})
    return out


def _chosen(leaves: list[Leaf]) -> list[Leaf]:
    """Leaves that are no noise: those in article elements, if they hold most of the text; else those that are not mostly
    links, or paragraphs."""
    kept = [leaf for leaf in leaves if not leaf.noise]
    own = [leaf for leaf in kept if leaf.paragraph or 2 * leaf.links <= len(leaf.text)]
    inside = [leaf for leaf in kept if leaf.main]
    return inside if inside and 2 * sum(len(x.text) for x in inside) >= sum(len(x.text) for x in {*own, *inside}) else own


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages with their leaves, in runs of about RUN characters: a leaf takes many times its text while it is an object."""
    matcher = Matcher()
    for batch in batches:
        kept = batch.select(["page_id", "url", "host", "layout", "copy"])

        def run(first: int, rows: list[list[dict]]) -> pa.RecordBatch:
            columns = kept.slice(first, len(rows)).columns
            return pa.RecordBatch.from_arrays([*columns, pa.array(rows, LEAF_TYPE)], names=[*kept.schema.names, "leaves"])

        first, rows, size = 0, [], 0
        for page, pivot in zip(batch.column("html"), batch.column("pivot")):
            page, pivot = page.as_py() or "", pivot.as_py()
            rows.append(content(page, pivot, matcher))
            size += len(page) + len(pivot or "")
            if size >= RUN:
                yield run(first, rows)
                first, rows, size = first + len(rows), [], 0
        if rows:
            yield run(first, rows)


def _recurring():
    """Whether a text counted on ``pages`` of the ``having`` pages that have its path recurs on nearly all others."""
    others, rest = F.col("pages") - 1, F.col("having") - 1
    return (others >= TEMPLATE_PAGES) & (others >= TEMPLATE_SHARE * rest)


def _by_place(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Marks (of a path and a text) that are template, of each layout of a host and of each host."""
    own = ["host", "layout", "path"]
    seen = leaves.select("host", "layout", "copy", F.col("leaf.path").alias("path"), F.xxhash64("leaf.path", "leaf.text").alias("mark"))
    seen = seen.where(F.col("host").isNotNull())
    marks = seen.distinct().groupBy(*own, "mark").agg(F.count("*").alias("pages"))
    paths = seen.drop("mark").distinct().groupBy(own).agg(F.count("*").alias("having"))
    # a text of too few pages of all layouts together is no template of any
    marks = marks.withColumn("all", F.sum("pages").over(Window.partitionBy("host", "path", "mark")))
    marks = written(marks.where(F.col("all") > TEMPLATE_PAGES), "page-marks")
    paths = written(paths, "page-paths")
    found = []
    for group in (["host", "layout"], ["host"]):
        having = paths.groupBy(*group, "path").agg(F.sum("having").alias("having"))
        counts = marks.groupBy(*group, "path", "mark").agg(F.sum("pages").alias("pages")).join(having, [*group, "path"])
        found.append(counts.where(_recurring()).groupBy(group).agg(F.collect_set("mark").alias("_".join(["marks", *group]))))
    return found[0], found[1]


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    bounded_batches(pages.sparkSession)
    url = F.col("url").cast("string")
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    typed = pages.select(
        F.col("page_id").cast("long").alias("page_id"), url.alias("url"), F.col("html").cast("string").alias("html")
    ).withColumn("host", F.when(host != "", host)).withColumn("copy", F.xxhash64("html"))
    tags = F.array_distinct(F.regexp_extract_all(F.lower("html"), F.lit("<([a-z][a-z0-9]*)"), 1))
    blocks = F.array_sort(F.array_intersect(tags, F.array(*[F.lit(t) for t in sorted(BLOCKS)])))
    typed = typed.withColumn("layout", F.xxhash64(blocks))
    bare = F.trim(F.regexp_replace("html", r"<[^>]*>|\s+", "")) == ""
    first = F.min(F.struct(bare.alias("bare"), F.col("page_id").isNull().alias("late"), "page_id", "html")).alias("first")
    pivots = typed.where(F.col("host").isNotNull() & F.col("html").isNotNull()).groupBy("host", "layout").agg(first)
    # As stored tables, pivots and templates have a size that Spark knows: small ones are broadcast and no page is moved.
    pivots = written(pivots.select("host", "layout", F.col("first.html").alias("pivot")), "page-pivots")
    joined = typed.join(pivots, ["host", "layout"], "left")
    rows = written(
        joined.select("page_id", "url", "host", "layout", "copy", "html", "pivot").mapInArrow(
            tidy(_aligned), f"page_id long, url string, host string, layout long, copy long, leaves {LEAVES}"
        ),
        "page-leaves",
    )
    leaves = rows.select("host", "layout", "copy", F.explode("leaves").alias("leaf"))
    # one row for each pivot leaf and distinct page; then counts for each pivot leaf
    seen = leaves.where("leaf.node >= 0 and leaf.same is not null")
    seen = seen.groupBy("host", "layout", F.col("leaf.node").alias("node"), "copy").agg(F.max("leaf.same").alias("same"))
    counts = seen.groupBy("host", "layout", "node").agg(F.count("*").alias("pages"), F.count_if("same").alias("same"))
    constant = counts.where((F.col("same") >= TEMPLATE_PAGES) & (F.col("same") >= TEMPLATE_SHARE * F.col("pages")))
    templates = constant.groupBy("host", "layout").agg(F.collect_set("node").alias("template"))  # at most the pivot's leaves
    of_layout, of_host = _by_place(leaves)
    templates = templates.join(of_layout, ["host", "layout"], "full")
    named = rows.join(written(templates, "page-templates"), ["host", "layout"], "left").join(written(of_host, "page-marks"), "host", "left")

    def holds(column: str, value):  # lists are looked through where they lie: a joined one would be built for each leaf
        return F.coalesce(F.array_contains(column, value), F.lit(False))

    def varies(x):
        mark = F.xxhash64(x["path"], x["text"])
        return ~(holds("template", x["node"]) | holds("marks_host_layout", mark) | holds("marks_host", mark))

    varying = F.filter("leaves", varies)
    shown = F.when(F.size(varying) > 0, varying).otherwise(F.col("leaves"))
    text = F.array_join(F.transform(shown, lambda x: x["text"]), "\n\n")
    return named.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
