"""Main text of web pages by a site style tree.

All pages of a host are merged into one tree. An element of the tree stands for one place in the layout: its parent's
place, the sequence of the parent's children, and its number among them. Elements with children have presentation styles (the
sequences of children seen there), text leaves have contents; how evenly the pages of the host are spread over them is an
entropy. A place that always looks and reads the same tells nothing (importance 0), one that differs from page to page is what
the page is about (importance 1). An element's composite importance mixes its own presentation with that of what is below it:

    own = 1 - sum(c ln c) / (m ln m)        for c of m pages in each of l styles
    imp = (1 - g^l) own + g^l sum(c / m * mean of imp over the children of the style)
    leaf = 1 - sum(ln c) / (l ln m)         for c of m pages with each of l contents

As a place is a hash of the way to it, the merge is an aggregation. The importances of a branch are summed up by pointer
doubling: each round, every element takes over the sum at the elements that its pointer reaches and the pointer's own pointer, so
a tree of depth d takes log2(d) joins, however deep the worst page is nested. Branches below the threshold leave each page.

Entropy needs pages to compare, and it cannot tell reader comments from an article. Elements that name themselves as something else than
the article (by tag, role, class or id) go on every host; on hosts with fewer than ``min_pages`` different pages they alone decide.
Pages with the same source count once. Text directly in a page's ``article`` or ``main`` is only taken out when an element in
between with a class, id or role of its own is unimportant: copies of an article must not turn it into layout.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioworks.llm.common import parts
from folioworks.session import materialise

SLICE_BYTES, TEXT_ROWS = 4 << 20, 64
DAMPING, THRESHOLD, MIN_PAGES = 0.9, 0.75, 8

# Elements by the part they play in a page.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol option optgroup p pre search section select summary table tbody td tfoot th "
    "thead tr ul svg math canvas object video audio button".split()
)
NOT_TEXT = frozenset("nav footer aside form dialog menu search select button svg math canvas object video audio fieldset option optgroup".split())
INLINE_NOT_TEXT = frozenset("label datalist output progress meter map".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
NAMES = frozenset(
    "nav navbar navigation menu submenu header masthead topbar toolbar footer sidebar sidebars aside rail notice notices cookie cookies consent gdpr "
    "banner banners ad ads advert adverts advertisement advertisements adsense sponsor sponsored promo promos promotion comment comments "
    "commentlist commentform respond replies disqus discussion share sharing social related breadcrumb breadcrumbs newsletter subscribe "
    "subscription popup modal overlay login signup search searchform widget widgets pagination pager paywall skip".split()
)
HEADS = frozenset(("header", "hgroup"))
LANDMARKS = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An opening tag ends an open element of the first set, unless one of the second lies between.
CLOSES = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu", "dir"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr",)), frozenset(("table",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "tbody": (frozenset(("thead", "tbody", "tfoot")), frozenset(("table",))),
    "tfoot": (frozenset(("thead", "tbody", "tfoot")), frozenset(("table",))),
    "option": (frozenset(("option",)), frozenset(("select", "optgroup"))),
}

_MARKUP = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)|[!?/])")
_TAG_END = re.compile(r"""=\s*(["'])|>""")
_ATTRIBUTE = re.compile(r"""(?i)(?<![^\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/"'>]|$)""")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|$)", re.IGNORECASE) for name in RAW}
_DIGITS = re.compile(r"\d+")
_NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_STATE = re.compile(r"(?i)(?<!\S)(?:has|with|without|no|is|show|hide|allow)[-_]\S*")  # what an element has, not what it is
_HOST = re.compile(r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


# -- pages as trees ------------------------------------------------------------------------------------------------


@dataclass
class Tree:
    """Elements and text leaves of a page in document order; node 0 is the body."""

    parent: list[int] = field(default_factory=lambda: [-1])
    label: list[str] = field(default_factory=lambda: ["body"])
    tag: list[str] = field(default_factory=lambda: ["body"])
    text: list[str] = field(default_factory=lambda: [""])
    named: list[bool] = field(default_factory=lambda: [False])  # has a class, id or role
    other: list[bool] = field(default_factory=lambda: [False])  # says that it is no part of the article

    def add(self, parent: int, label: str, tag: str, text: str = "", named: bool = False, other: bool = False) -> int:
        for column, value in zip((self.parent, self.label, self.tag, self.text, self.named, self.other), (parent, label, tag, text, named, other)):
            column.append(value)
        return len(self.parent) - 1

    def children(self) -> list[list[int]]:
        below: list[list[int]] = [[] for _ in self.parent]
        for node in range(1, len(self.parent)):
            below[self.parent[node]].append(node)
        return below


def _tag_end(source: str, at: int) -> int:
    """The place of the ``>`` that ends a tag; one inside a quoted value does not, unless the quote never ends."""
    first = None
    while (stop := _TAG_END.search(source, at)) is not None:
        if stop[1] is None:
            return stop.start()
        if first is None:
            first = stop.end()
        at = source.find(stop[1], stop.end()) + 1
        if not at:
            end = source.find(">", first)
            return end if end >= 0 else len(source)
    return len(source)


def _attributes(source: str) -> tuple[str, bool, set[str]]:
    """Label of class, id and role without numbers, whether the element is hidden or of another role, and words of its names."""
    label, other, words = [], False, set()
    for name, *values in _ATTRIBUTE.findall(source):
        name, value = name.lower(), html.unescape("".join(values))
        if name in ("class", "id", "role"):
            label.append(f"{name}={_DIGITS.sub('0', ' '.join(value.split()))}")
            if name == "role":
                other |= value.strip().lower() in ROLES
            else:
                words |= {w.lower() for w in _NAME.findall(_STATE.sub(" ", value))}
        elif name == "hidden":
            other = True
        elif name == "aria-hidden":
            other |= value.strip().lower() == "true"
        else:
            other |= "display:none" in value.replace(" ", "").lower()
    return " ".join(label), other, words


def parse(source: str) -> Tree:
    """The block elements of a page and the text in them, in one pass without recursion.

    Inline elements are part of the text around them; a line break is white space. Tags that are left open, cross each other or end
    with the page are closed as browsers do it.
    """
    tree = Tree()
    stack, opened = [0], {"body": 1}
    run: list[str] = []
    hidden, depth = "", 0  # an inline element whose text does not count, and how often its tag is open in it
    heads = 0  # articles around the present place: a header in one is its own
    at, size = 0, len(source)

    def flush() -> None:
        if run:
            text = " ".join("".join(run).split())
            run.clear()
            if text:
                tree.add(stack[-1], "#", "#", text)

    def close() -> None:
        nonlocal hidden, heads
        flush()
        hidden = ""
        tag = tree.tag[stack.pop()]
        opened[tag] -= 1
        heads -= tag in LANDMARKS

    while at < size:
        found = _MARKUP.search(source, at)
        stop = found.start() if found else size
        if stop > at and not hidden:
            piece = source[at:stop]
            run.append(html.unescape(piece) if "&" in piece else piece)
        if not found:
            break
        at = found.end()
        if found[1]:
            # A comment; "<!-->" and "<!--->" are whole ones.
            if source.startswith((">", "->"), at):
                at = source.index(">", at) + 1
            else:
                end = source.find("-->", at)
                at = end + 3 if end >= 0 else size
            continue
        end = _tag_end(source, at) if found[3] else source.find(">", at)
        end = size if end < 0 else end
        inside, at = source[at:end], end + 1
        if not found[3]:
            continue
        tag = found[3].lower()
        if found[2]:
            if hidden:
                depth -= tag == hidden
                if not depth:
                    hidden = ""
                if tag == "br" or tag not in opened:
                    continue
            if tag in BLOCKS and tag != "body" and opened.get(tag):
                while tree.tag[stack[-1]] != tag:
                    close()
                close()
            elif tag in BLOCKS:
                flush()  # it ends nothing, but it does part texts
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(source, at)
            at = end.start() if end else size
            continue
        if tag in ("br", "hr"):
            run.append(" ")
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if hidden:
            if tag == hidden:
                depth += 1
            if tag not in BLOCKS:
                continue
        if tag in ("html", "head", "body"):
            continue
        interesting = inside and ("=" in inside or "hidden" in inside)
        label, other, words = _attributes(inside) if interesting else ("", False, ())
        if tag not in BLOCKS:
            if not hidden and (other or tag in INLINE_NOT_TEXT or (words and not words.isdisjoint(NAMES))):
                hidden, depth = tag, 1
            continue
        flush()
        if opened.get("p"):
            while tree.tag[stack[-1]] != "p":
                close()
            close()
        if tag in HEADINGS and tree.tag[stack[-1]] in HEADINGS:
            close()
        if tag in CLOSES:
            ends, walls = CLOSES[tag]
            if any(opened.get(e) for e in ends):
                place = len(stack) - 1
                while place and tree.tag[stack[place]] not in ends and tree.tag[stack[place]] not in walls:
                    place -= 1
                if tree.tag[stack[place]] in ends:
                    while len(stack) > place:
                        close()
        own_head = heads and (tag in HEADS or "header" in words)
        other = other or tag in NOT_TEXT or (tag in HEADS and not heads)
        other = other or bool(words) and tag not in LANDMARKS and not own_head and not words.isdisjoint(NAMES)
        other = other or bool(words) and tag == "article" and not words.isdisjoint(("comment", "comments", "ad", "ads", "related", "promo", "teaser"))
        node = tree.add(stack[-1], f"{tag} {label}" if label else tag, tag, "", bool(label), other)
        stack.append(node)
        opened[tag] = opened.get(tag, 0) + 1
        heads += tag in LANDMARKS
    while stack:
        close()
    return tree


def host_of(url: str | None) -> str:
    found = _HOST.match((url or "").strip())
    return found[1].lower() if found else ""


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def places(tree: Tree, host: str) -> tuple[list[int], list[int], list[int]]:
    """For every node its place in the host's tree, the hash of its style or content, and its number of children."""
    below = tree.children()
    key, value = [0] * len(below), [0] * len(below)
    key[0] = xxhash.xxh64_intdigest(host, seed=1)
    for node, kids in enumerate(below):
        if tree.tag[node] == "#":
            value[node] = xxhash.xxh64_intdigest(tree.text[node], seed=2)
            continue
        style = xxhash.xxh64_intdigest("\n".join(tree.label[k] for k in kids), seed=key[node])
        value[node] = style
        for number, kid in enumerate(kids):
            key[kid] = xxhash.xxh64_intdigest(number.to_bytes(4, "little"), seed=style)
    return [_signed(k) for k in key], [_signed(v) for v in value], [len(k) for k in below]


def blocks(tree: Tree, importance: dict[int, float], threshold: float = THRESHOLD) -> list[str]:
    """Texts of the article, in page order; ``importance`` holds the page's nodes that are below the threshold.

    A branch goes as a whole when most of the text in it is unimportant, too: a frame that never changes may hold anything.
    """
    n = len(tree.parent)
    leaf = [tag == "#" for tag in tree.tag]
    size = [len(text) for text in tree.text]
    weight = [0 if i in importance else size[i] for i in range(n)]
    frames = [tag in LANDMARKS for tag in tree.tag]  # holds an article
    for node in range(n - 1, 0, -1):
        size[tree.parent[node]] += size[node]
        weight[tree.parent[node]] += weight[node]
        frames[tree.parent[node]] |= frames[node]
    gone, plain, landmark = [False] * n, [False] * n, [""] * n
    kept: dict[str, list[str]] = {"article": [], "main": [], "": []}
    for node in range(1, n):
        up, tag = tree.parent[node], tree.tag[node]
        landmark[node] = "article" if "article" in (landmark[up], tag) else "main" if tag == "main" else landmark[up]
        plain[node] = tag in LANDMARKS or (plain[up] and not tree.named[node])
        named_other = tree.other[node] and (tag == "article" or not frames[node])
        dull = importance.get(node, 1.0) < threshold and not frames[node] and not plain[node] and 2 * weight[node] < size[node]
        gone[node] = gone[up] or named_other or dull
        if leaf[node] and not gone[node]:
            kept[landmark[node]].append(tree.text[node])
    return kept["article"] or kept["main"] or kept[""]


# -- jobs ----------------------------------------------------------------------------------------------------------


def _page_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["host", "page", "keys", "styles", "kids", "ups", "depth"]
    lists = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
    for whole in batches:
        for batch in parts(whole, "html", SLICE_BYTES):
            rows = []
            for url, source in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
                host = host_of(url)
                tree = parse(source or "")
                level = [0] * len(tree.parent)
                for node in range(1, len(level)):
                    level[node] = level[tree.parent[node]] + 1
                rows.append((*_identity(host, source or ""), *places(tree, host), tree.parent, max(level)))
            if rows:
                kinds = [pa.int64(), pa.int64(), *lists, pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _identity(host: str, source: str) -> tuple[int, int]:
    """A page by its host and its source: equal ones get one answer."""
    return _signed(xxhash.xxh64_intdigest(host, seed=1)), _signed(xxhash.xxh64_intdigest(source, seed=3))


def style_tree(pages: DataFrame, damping: float = DAMPING, min_pages: int = MIN_PAGES) -> tuple[DataFrame, DataFrame]:
    """``(key, importance)`` of every place that ``min_pages`` pages or more share, and the pages with their places."""
    schema = "host bigint, page bigint, keys array<bigint>, styles array<bigint>, kids array<int>, ups array<int>, depth int"
    found = pages.select("url", "html").mapInArrow(_page_places, schema)
    rest = [c for c in found.columns if c not in ("host", "page")]
    found = found.groupBy("host", "page").agg(F.any_value(F.struct(*rest)).alias("r")).select("host", "page", "r.*")
    found = materialise(found, "page-places")

    node = F.explode(F.arrays_zip("keys", "styles", "kids", "ups"))
    nodes = found.select("keys", "styles", "kids", node.alias("n"))
    up = F.col("n.ups") + 1
    nodes = nodes.select(
        F.col("n.keys").alias("key"), F.col("n.styles").alias("style"), F.col("n.kids").alias("kids"),
        F.when(up > 0, F.get("keys", F.col("n.ups"))).alias("up"), F.when(up > 0, F.get("styles", F.col("n.ups"))).alias("up_style"),
        F.when(up > 0, F.get("kids", F.col("n.ups"))).alias("up_kids"),
    )
    seen = nodes.groupBy("key", "style").agg(
        F.count(F.lit(1)).alias("c"), *(F.any_value(c).alias(c) for c in ("kids", "up", "up_style", "up_kids"))
    )
    seen = materialise(seen, "page-styles")
    c = F.col("c").cast("double")
    elements = seen.groupBy("key").agg(
        F.sum(c).alias("m"), F.count(F.lit(1)).alias("l"), F.sum(c * F.ln(c)).alias("even"), F.sum(F.ln(c)).alias("logs"),
        F.sum(F.when(c == 1, 1.0).otherwise(0.0)).alias("single"), F.max("kids").alias("kids"),
        *(F.any_value(x).alias(x) for x in ("up", "up_style", "up_kids")),
    ).where("m >= 2")
    # A style of one page has children of one page, whose importance is 1; they are counted here and need no rows.
    shrink = F.pow(F.lit(damping), F.col("l"))
    own = (1 - shrink) * (1 - F.col("even") / (F.col("m") * F.ln("m"))) + shrink * F.col("single") / F.col("m")
    leaf = 1 - F.col("logs") / (F.col("l") * F.ln("m"))
    elements = materialise(
        elements.select("key", "m", "up", "up_style", "up_kids", shrink.alias("shrink"), F.when(F.col("kids") == 0, leaf).otherwise(own).alias("imp")), "elements"
    )
    styles = seen.where("c >= 2").select(F.col("key").alias("up"), F.col("style").alias("up_style"), "c")
    share = styles.join(elements.select(F.col("key").alias("up"), F.col("m").alias("up_m"), "shrink"), "up")
    share = materialise(share.select("up", "up_style", (F.col("shrink") * F.col("c") / F.col("up_m")).alias("share")), "style-shares")
    edges = elements.select("key", "m", "imp", "up", "up_style", "up_kids").join(share, ["up", "up_style"], "left")
    now = materialise(edges.select("key", "m", "imp", "up", (F.col("share") / F.col("up_kids")).alias("w")), "importance")
    deepest = found.agg(F.max("depth")).first()[0] or 0
    for _ in range(int(deepest).bit_length()):
        given = now.where("up IS NOT NULL").groupBy(F.col("up").alias("key")).agg(F.sum(F.col("w") * F.col("imp")).alias("given"))
        above = now.where("up IS NOT NULL").select(F.col("key").alias("up"), F.col("up").alias("next"), F.col("w").alias("next_w"))
        now = now.join(materialise(given, "given"), "key", "left").join(above, "up", "left")
        now = materialise(
            now.select("key", "m", (F.col("imp") + F.coalesce("given", F.lit(0.0))).alias("imp"), F.col("next").alias("up"), (F.col("w") * F.col("next_w")).alias("w")),
            "importance",
        )
    return now.where(F.col("m") >= min_pages).select("key", F.round("imp", 9).alias("importance")), found


def _identities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the identity of their page, the source compressed for the way to its importances."""
    pack = zstandard.ZstdCompressor(level=3).compress
    names = ["host", "page", "page_id", "url", "packed"]
    for whole in batches:
        for batch in parts(whole, "html", SLICE_BYTES):
            urls, sources = (batch.column(c).to_pylist() for c in ("url", "html"))
            pairs = [_identity(host_of(u), s or "") for u, s in zip(urls, sources)]
            both = [pa.array(c, pa.int64()) for c in zip(*pairs)] if pairs else [pa.array([], pa.int64())] * 2
            packed = pa.array([pack((s or "").encode()) for s in sources], pa.binary())
            yield pa.RecordBatch.from_arrays([*both, batch.column("page_id"), batch.column("url"), packed], names=names)


def _texts(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for whole in batches:
        for start in range(0, whole.num_rows, TEXT_ROWS):
            batch = whole.slice(start, TEXT_ROWS)
            texts = []
            for source, known in zip(batch.column("packed"), batch.column("known").to_pylist()):
                importance = {k["node"]: k["importance"] for k in known or ()}
                texts.append("\n\n".join(blocks(parse(unpack(source.as_buffer()).decode()), importance, threshold)))
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])


def main_text(
    pages: DataFrame, threshold: float = THRESHOLD, damping: float = DAMPING, min_pages: int = MIN_PAGES,
    key: str = "page_id", url: str = "url", source: str = "html",
) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``; the blocks of the text are parted by an empty line.

    A null or empty source gives an empty text, and so does a page that is all layout. Pages without a host (null or odd
    addresses) are compared with each other. Rows that repeat get the same answer each, and count as one page of their host.
    An empty table gives no rows. Other columns are not read. The key may be of any type.
    """
    rows = pages.select(pages[key].alias("page_id"), pages[url].alias("url"), pages[source].alias("html"))
    importances, found = style_tree(rows, damping, min_pages)
    node = found.select("host", "page", F.posexplode("keys").alias("node", "key"))
    known = node.join(importances.where(F.col("importance") < threshold), "key")
    known = known.groupBy("host", "page").agg(F.collect_list(F.struct("node", "importance")).alias("known"))
    known = materialise(known, "page-importances")
    id_type = rows.schema["page_id"].dataType.simpleString()
    marked = rows.mapInArrow(_identities, f"host bigint, page bigint, page_id {id_type}, url string, packed binary")
    # One form of join at every size; a page that very many rows repeat can be split.
    joined = marked.join(known.hint("merge"), ["host", "page"], "left").select("page_id", "url", "packed", "known")
    result = joined.mapInArrow(lambda b: _texts(b, threshold), f"page_id {id_type}, url string, text string, n_chars bigint")
    return result.select(F.col("page_id").alias(key), F.col("url").alias(url), "text", "n_chars")
