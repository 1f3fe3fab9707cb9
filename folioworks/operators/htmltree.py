"""Per-page helper run inside Arrow batches: a tolerant tree on the stdlib parser, selectors, Markdown."""

from __future__ import annotations

import re
from collections import defaultdict
from html.parser import HTMLParser

# Fixed values of HTML: elements without content, and what an opening tag ends implicitly.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ENDS_P = BLOCK - frozenset("dd dt li tbody td tfoot th thead tr".split())
CELLS = frozenset(("td", "th"))
ROWS = CELLS | {"tr"}
IMPLIED_END = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "td": (CELLS, frozenset(("tr", "table"))),
    "th": (CELLS, frozenset(("tr", "table"))),
    "tr": (ROWS, frozenset(("table",))),
    "tbody": (ROWS | {"thead", "tbody", "tfoot"}, frozenset(("table",))),
    "tfoot": (ROWS | {"thead", "tbody", "tfoot"}, frozenset(("table",))),
    "option": (frozenset(("option",)), frozenset(("select",))),
}
P_SCOPE = frozenset(("table", "td", "th", "caption", "button"))
# A stray closing tag must not end an element of a higher rank.
RANK = {"div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180, "tfoot": 180, "table": 190, "body": 200, "html": 220}

# Tags as nearly all are written; any other goes the way of the standard parser, as do elements that hold raw text.
PLAIN_OPEN = re.compile(r'<([a-zA-Z][a-zA-Z0-9]*)((?: [a-z][a-z0-9-]*="[^"&<>]*")*)>')
PLAIN_ATTR = re.compile(r' ([a-z][a-z0-9-]*)="([^"]*)"')
PLAIN_CLOSE = re.compile(r"</([a-zA-Z][a-zA-Z0-9]*)>")
RAW = frozenset("iframe noembed noframes noscript plaintext script style textarea title xmp".split())

SCRIPT_RESIDUE = re.compile(r"<script.*?</script>", re.S | re.I)


class Node:
    __slots__ = ("tag", "attrs", "kids", "up")

    def __init__(self, tag, attrs=(), up=None):
        self.tag, self.attrs, self.kids, self.up = tag, {k: v or "" for k, v in attrs}, [], up

    def walk(self):
        """Descendant elements in document order."""
        todo = [k for k in reversed(self.kids) if isinstance(k, Node)]
        while todo:
            node = todo.pop()
            yield node
            todo.extend(k for k in reversed(node.kids) if isinstance(k, Node))

    def text(self):
        out, todo = [], list(reversed(self.kids))
        while todo:
            kid = todo.pop()
            if isinstance(kid, str):
                out.append(kid)
            elif kid.tag not in ("script", "style"):
                todo.extend(reversed(kid.kids))
        return "".join(out)

    def html(self):
        out, todo = [], [self]
        while todo:
            item = todo.pop()
            if isinstance(item, tuple):
                out.append(item[0])
            elif isinstance(item, str):
                out.append(item.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;"))
            else:
                attrs = "".join(f' {k}="{_attr(v)}"' for k, v in item.attrs.items())
                if item.tag in VOID:
                    out.append(f"<{item.tag}{attrs}/>")
                else:
                    out.append(f"<{item.tag}{attrs}>")
                    todo.append((f"</{item.tag}>",))
                    raw = item.tag in ("script", "style")
                    todo.extend((k,) if raw and isinstance(k, str) else k for k in reversed(item.kids))
        return "".join(out)


def _attr(value):
    return value.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root")
        self.open = defaultdict(int)
        self.pieces = []
        self.nodes = []  # elements in document order

    def updatepos(self, i, j):  # line numbers are not needed
        return j

    def parse_starttag(self, i):
        found = None if self.cdata_elem else PLAIN_OPEN.match(self.rawdata, i)
        if found is None or (tag := found[1].lower()) in RAW:
            return super().parse_starttag(i)
        self.lasttag = tag
        self.handle_starttag(tag, PLAIN_ATTR.findall(found[2]) if found[2] else ())
        return found.end()

    def parse_endtag(self, i):
        found = None if self.cdata_elem else PLAIN_CLOSE.match(self.rawdata, i)
        if found is None:
            return super().parse_endtag(i)
        self.handle_endtag(found[1].lower())
        return found.end()

    def _end(self, tags, scope):
        """Leave the outermost open element of ``tags`` that lies within ``scope``."""
        if not any(self.open[tag] for tag in tags):
            return
        node, leave = self.at, None
        while node.up is not None and node.tag not in scope:
            if node.tag in tags:
                leave = node
            node = node.up
        if leave is not None:
            self._leave(leave)

    def _leave(self, node):
        """Go back to the parent of ``node``, an open element."""
        while self.at is not node:
            self.open[self.at.tag] -= 1
            self.at = self.at.up
        self.open[node.tag] -= 1
        self.at = node.up

    def _flush(self):
        if self.pieces:
            self.at.kids.append("".join(self.pieces))
            self.pieces = []

    def close(self):
        super().close()
        self._flush()

    def handle_starttag(self, tag, attrs):
        self._flush()
        if self.open["p"] and tag in ENDS_P:
            self._end(frozenset(("p",)), P_SCOPE)
        if tag in IMPLIED_END:
            self._end(*IMPLIED_END[tag])
        node = Node(tag, attrs, self.at)
        self.at.kids.append(node)
        self.nodes.append(node)
        if tag not in VOID:
            self.at = node
            self.open[tag] += 1

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag):
        if not self.open[tag]:
            return
        self._flush()
        if self.at.tag == tag:
            self.open[tag] -= 1
            self.at = self.at.up
            return
        node, rank = self.at, RANK.get(tag, 100)
        while node.up is not None and node.tag != tag and RANK.get(node.tag, 100) <= rank:
            node = node.up
        if node.tag == tag and node.up is not None:
            self._leave(node)

    def handle_data(self, data):
        self.pieces.append(data)


def _built(html):
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder


def parse(html):
    return _built(html).root


# ---- selectors: tag, .class, #id, [attr], [attr=value], descendants and comma lists

_COMPOUND = re.compile(r"""([a-zA-Z][\w-]*|\*)|\.([\w-]+)|#([\w-]+)|\[\s*([\w-]+)\s*(?:=\s*["']?([^"'\]]*)["']?)?\s*\]""")


def compile_selector(text):
    groups = []
    for group in text.split(","):
        steps = []
        for compound in re.findall(r"(?:\[[^\]]*\]|[^\s\[])+", group):
            tests = _COMPOUND.findall(compound)
            steps.append(tests)
        groups.append(steps)
    return groups


def _fits(node, tests):
    for tag, cls, ident, attr, value in tests:
        if tag and tag != "*" and node.tag != tag.lower():
            return False
        if cls and cls not in node.attrs.get("class", "").split():
            return False
        if ident and node.attrs.get("id") != ident:
            return False
        if attr and (attr not in node.attrs or (value and node.attrs[attr] != value)):
            return False
    return True


def _matches(node, steps):
    if not _fits(node, steps[-1]):
        return False
    left, up = len(steps) - 2, node.up
    while left >= 0 and up is not None:
        if _fits(up, steps[left]):
            left -= 1
        up = up.up
    return left < 0


def select(root, groups):
    return (n for n in root.walk() if any(_matches(n, steps) for steps in groups))


class Page:
    """A parsed page whose elements are listed by tag and class once, so that each selector looks at few."""

    def __init__(self, html):
        built = _built(html)
        self.root, self.nodes = built.root, built.nodes
        self.lists = defaultdict(list)
        for node in self.nodes:
            self.lists[node.tag].append(node)
            if names := node.attrs.get("class"):
                for name in set(names.split()):
                    self.lists["." + name].append(node)

    def free(self):
        """Undo the links from child to parent, so that the tree goes with its last use and not with a search for cycles."""
        for node in self.nodes:
            node.up = None

    def select(self, groups):
        if len(groups) > 1:
            return select(self.root, groups)
        (steps,) = groups
        names = [f".{cls}" if cls else tag.lower() for tag, cls, *_ in steps[-1] if cls or tag not in ("", "*")]
        if not names:
            return select(self.root, groups)
        few = min((self.lists.get(n, []) for n in names), key=len)
        return (n for n in few if _matches(n, steps))


# ---- Markdown


def drop_noise(node):
    """Remove scripts and styles, and CDATA text, below ``node``."""
    for el in [node, *node.walk()]:
        kept = []
        for kid in el.kids:
            if isinstance(kid, str):
                if "CDATA" in kid:
                    continue
                if "<" in kid:
                    kid = SCRIPT_RESIDUE.sub("", kid)
            elif kid.tag in ("script", "style"):
                continue
            kept.append(kid)
        el.kids = kept


def _squeeze(text):
    """Blanks to one blank, a run with a line break to one line break."""
    if "\n" in text or "\r" in text:
        text = re.sub(r"[ \t\r\n]*[\r\n][ \t\r\n]*", "\n", text)
    if "  " in text or "\t" in text:
        text = re.sub(r"[ \t]+", " ", text)
    return text


def _is_block(kid):
    return isinstance(kid, Node) and kid.tag in BLOCK


def _glue(left, right):
    """Join two pieces; the line breaks where they meet are shared, not added up."""
    a, b = left.rstrip("\n"), right.lstrip("\n")
    breaks = max(len(left) - len(a), len(right) - len(b))
    return a + "\n" * breaks + b


def _children(node, inline=False, pre=False):
    out, kids = "", node.kids
    for i, kid in enumerate(kids):
        if isinstance(kid, str):
            if not pre:
                kid = _squeeze(kid)
                if _is_block(node) or node.tag == "#root":
                    if i == 0 or _is_block(kids[i - 1]):
                        kid = kid.lstrip()
                    if i == len(kids) - 1 or _is_block(kids[i + 1]):
                        kid = kid.rstrip()
                kid = kid.replace("*", "\\*").replace("_", "\\_")
            out += kid
        else:
            out = _glue(out, _convert(kid, inline, pre))
    return out


def _around(text, mark):
    core = text.strip()
    if not core:
        return text
    head, tail = text[: len(text) - len(text.lstrip())], text[len(text.rstrip()) :]
    return (" " if head else "") + mark + core + mark + (" " if tail else "")


def _link(node, text):
    href, title = node.attrs.get("href"), node.attrs.get("title")
    core = text.strip()
    if not core or not href:
        return text
    if core.replace("\\_", "_").replace("\\*", "*") == href and not title:
        return text.replace(core, f"<{href}>")
    quoted = title.replace('"', '\\"') if title else None
    tail = f' "{quoted}"' if quoted else ""
    return text.replace(core, f"[{core}]({href}{tail})", 1)


def _list(node):
    lines, n = [], int(node.attrs["start"]) if node.attrs.get("start", "").isdigit() else 1
    for kid in node.kids:
        if isinstance(kid, str):
            continue
        if kid.tag in ("ul", "ol"):
            lines.append("  " + _list(kid).strip("\n").replace("\n", "\n  "))
            continue
        mark = f"{n}. " if node.tag == "ol" else "- "
        n += 1
        body = _children(kid).strip()
        lines.append(mark + re.sub(r"\n(?!\n)", "\n" + " " * len(mark), body))
    return "\n\n" + "\n".join(lines) + "\n\n"


def _table(node):
    rows = []
    for tr in node.walk():
        if tr.tag == "tr":
            cells = [k for k in tr.kids if isinstance(k, Node) and k.tag in CELLS]
            rows.append([re.sub(r"\s*\n\s*", " ", _children(c, True)).strip() for c in cells])
    if not rows:
        return ""
    lines = ["| " + " | ".join(r) + " |" for r in rows]
    lines.insert(1, "| " + " | ".join(["---"] * len(rows[0])) + " |")
    return "\n\n" + "\n".join(lines) + "\n\n"


def _convert(node, inline=False, pre=False):
    tag = node.tag
    if tag in ("script", "style"):
        return ""
    if tag == "br":
        return " " if inline else "  \n"
    if tag == "hr":
        return "\n\n---\n\n"
    if tag == "img":
        alt, title = node.attrs.get("alt", ""), node.attrs.get("title")
        return alt if inline else f"![{alt}]({node.attrs.get('src', '')}" + (f' "{title}")' if title else ")")
    if tag in ("ul", "ol"):
        return _list(node)
    if tag == "table":
        return _table(node)
    heading = tag in HEADINGS
    text = _children(node, inline or heading or tag in CELLS, pre or tag in ("pre", "code"))
    if heading:
        text = re.sub(r"\s+", " ", text).strip()
        return f"\n\n{'#' * int(tag[1])} {text}\n\n" if text else ""
    if tag in ("b", "strong"):
        return _around(text, "**")
    if tag in ("i", "em"):
        return _around(text, "*")
    if tag == "a":
        return _link(node, text)
    if tag == "code" and not pre:
        return _around(text, "`")
    if tag == "pre":
        return "\n\n```\n" + text + "\n```\n\n"
    if tag == "blockquote":
        body = text.strip()
        return "\n\n> " + body.replace("\n", "\n> ") + "\n\n" if body else ""
    if tag in BLOCK and not inline:
        body = text.strip("\n ")
        return f"\n\n{body}\n\n" if body else ""
    return text


def to_markdown(node, paragraphs_first=True):
    """``(text, spaced)``; ``spaced`` tells that the spacing rules apply. Changes the tree below ``node``."""
    drop_noise(node)
    if not paragraphs_first:
        return _wrap(node).strip(), True
    found = [n for n in node.walk() if n.tag == "p"]
    texts = [t for t in (p.text().strip() for p in found) if t]
    if not texts:
        return _wrap(node).strip(), False
    for up in {id(p.up): p.up for p in found}.values():
        up.kids = [k for k in up.kids if isinstance(k, str) or k.tag != "p"]
    return "\n\n".join([*texts, *filter(None, [_wrap(node).strip()])]), True


def _wrap(node):
    return _children(node) if node.tag == "#root" else _convert(node)
