"""Pattern-based extraction for simple tags; anything needing selectors goes through ``operators.extract``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioworks.functions.text import (
    clean_text,
    let,
    regex_all,
    regex_first,
    strip_noise_text,
    strip_tags,
    strip_ws,
    unescape_html,
)

# Tag shapes used by the native path.
# A value in double quotes, in single quotes, or in none (then up to a blank, inside the tag).
IN_TAG = "(?=[^<>]*>)"
VALUE = rf"""(?:"([^"]*)"|'([^']*)'|([^\s"'<>]+){IN_TAG})"""
HREF = rf"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*{VALUE}"""
LINK_ATTR = rf"""(?i)\s(href|src)\s*=\s*{VALUE}"""
ANCHOR = rf"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*{VALUE}[^>]*>(.*?)</a\s*>"""
P_OPEN = r"(?i)<p(?:\s[^>]*)?>"
P_END = (
    r"(?is)<(?:/(?:p|article|section|main|body|html|div|td|li|blockquote)"
    r"|(?:ul|ol|dl|table|div|blockquote|pre|hr|form|h[1-6]|article|section|footer|nav)\b).*$"
)
HIDDEN = r"(?is)<style\b[^>]*>.*?</style\s*>|<!--.*?-->"


def visible(html: Column | str) -> Column:
    """Page source without scripts, CDATA, styles and comments."""
    return F.regexp_replace(strip_noise_text(html), HIDDEN, "")


def article_of(html: Column | str) -> Column:
    """The first whole ``article`` element, whatever its attributes; a page without one is given back whole."""
    found = regex_first(html, r"(?is)<article(?:\s[^>]*)?>.*?</article\s*>", 0)
    return F.when(found != "", found).otherwise(F.col(html) if isinstance(html, str) else html)


def tag_text(html: Column | str, tag: str) -> Column:
    """Cleaned text of the first ``tag``, ``""`` when absent."""
    inner = regex_first(html, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>")
    return clean_text(unescape_html(strip_tags(inner)))


def tag_attr(html: Column | str, tag: str, attr: str) -> Column:
    return regex_first(html, rf"""(?is)<{tag}\s[^>]*?\b{attr}\s*=\s*"([^"]*)\"""")


def paragraphs(html: Column | str) -> Column:
    """Texts of all paragraphs in order, blank ones left out; an open ``p`` ends where the next block starts."""
    parts = F.split(visible(html), P_OPEN, -1)
    inner = F.transform(
        F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda x: strip_ws(unescape_html(strip_tags(F.regexp_replace(x, P_END, "")))),
    )
    return F.filter(inner, lambda x: x != "")


def _value(match: Column, pattern: str, first: int = 1) -> Column:
    """The attribute value of a match, whichever way it is quoted; the groups of the other ways are empty."""
    alone = pattern.replace(IN_TAG, "")  # the match ends with the value, not with its tag
    double, single, bare = (regex_first(match, alone, first + i) for i in range(3))
    return let(double, lambda value: F.when(value != "", value).otherwise(F.concat(single, bare)))


def hrefs(html: Column | str) -> Column:
    """All link targets in order, as written."""
    return F.transform(regex_all(strip_noise_text(html), HREF, 0), lambda a: _value(a, HREF))


def anchors(html: Column | str) -> Column:
    """All links in order as ``struct<href, title>``. The page is scanned once, then only its links."""
    return F.transform(
        regex_all(strip_noise_text(html), ANCHOR, 0),
        lambda a: F.struct(
            unescape_html(_value(a, ANCHOR), attribute=True).alias("href"),
            strip_ws(unescape_html(strip_tags(regex_first(a, ANCHOR, 4)))).alias("title"),
        ),
    )


def link_attrs(html: Column | str) -> Column:
    """Every ``href`` and ``src`` in order as ``struct<attr, raw>``."""
    return F.transform(
        regex_all(strip_noise_text(html), LINK_ATTR, 0),
        lambda a: F.struct(
            F.lower(regex_first(a, LINK_ATTR.replace(IN_TAG, ""), 1)).alias("attr"),
            unescape_html(_value(a, LINK_ATTR, 2), attribute=True).alias("raw"),
        ),
    )


def first_list(html: Column | str) -> Column:
    """Source of the first ``ul`` with all lists inside it, ``""`` when there is none; one left open reaches to the end."""
    none = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit(0).alias("first"), F.lit(0).alias("last"))

    def step(seen: Column, part: Column) -> Column:
        tag = F.substring(part, 1, 5)
        opens, closes = tag.rlike(r"(?i)^<ul[\s>]"), tag.rlike(r"(?i)^</ul[\s>]")
        at, depth = seen["at"] + 1, seen["depth"]
        inside = (depth > 0) & (seen["last"] == 0)
        return F.struct(
            at.alias("at"),
            F.when(opens, depth + 1).when(closes & (depth > 0), depth - 1).otherwise(depth).alias("depth"),
            F.when(opens & (seen["first"] == 0), at).otherwise(seen["first"]).alias("first"),
            F.when(closes & inside & (depth == 1), at).otherwise(seen["last"]).alias("last"),
        )

    def cut(parts: Column, found: Column) -> Column:
        last = F.when(found["last"] == 0, F.size(parts) + 1).otherwise(found["last"])
        return F.when(found["first"] > 0, F.array_join(F.slice(parts, found["first"], last - found["first"]), "")).otherwise(F.lit(""))

    return let(
        F.split(html, r"(?i)(?=</?ul[\s>])"),
        lambda parts: let(F.aggregate(parts, none, step), lambda found: cut(parts, found)),
    )
