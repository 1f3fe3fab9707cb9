"""Text cleaning, escaping, counting and list rendering as column expressions."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of HTML entities as the standard library lists them: with a semicolon, and the old ones that do without.
NAMED = json.dumps(html5)
OLD = "|".join(sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True))
# Numbers 128 to 159 stand for characters of Windows-1252.
WINDOWS = [bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(128, 160)]

# Script elements, and commented CDATA residue and bare CDATA sections.
SCRIPT = r"(?is)<script\b[^>]*>.*?</script\s*>"
CDATA_PATTERNS = (r"(?s)//\s*<!\s*\[CDATA\[.*?\]\]>\s*//?", r"(?s)<!\[CDATA\[.*?\]\]>")

# The white space that text is trimmed and collapsed by, Unicode included.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# A run of it that is not one plain blank already.
RUN = f" ?[{WHITE_SPACE[1:]}][{WHITE_SPACE}]*| {{2,}}[{WHITE_SPACE}]*"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def strip_ws(c: Column | str) -> Column:
    """Trim every kind of white space, not just blanks."""
    return F.btrim(col_(c), F.lit(WHITE_SPACE))


def clean_text(c: Column | str, preserve_formatting: bool = False) -> Column:
    """Collapse white space; with ``preserve_formatting`` keep line breaks, at most two in a row.

    Missing text becomes ``""``.
    """
    text = F.coalesce(col_(c), F.lit(""))
    if preserve_formatting:
        text = F.regexp_replace(text, r"[ \t]+", " ")
        text = F.regexp_replace(text, f"\n[{WHITE_SPACE}]*\n[{WHITE_SPACE}]*\n", "\n\n")
        return strip_ws(text)
    return F.trim(F.regexp_replace(text, RUN, " "))


def strip_token(c: Column | str, token: str) -> Column:
    """Remove every occurrence of a literal."""
    return F.replace(col_(c), F.lit(token), F.lit(""))


def split_n(c: Column | str, sep: str, n: int) -> Column:
    """Split on a literal into at most ``n`` parts; the last keeps the rest."""
    return F.split(col_(c), r"\Q" + sep + r"\E", n)


def last_segment(c: Column | str, sep: str = "/") -> Column:
    return F.substring_index(col_(c), sep, -1)


def pad2(c: Column | str) -> Column:
    """Zero-pad to two digits; longer values stay whole."""
    text = col_(c).cast("string")
    return F.when(F.length(text) >= 2, text).otherwise(F.lpad(text, 2, "0"))


def regex_first(c: Column | str, pattern: str, group: int = 1) -> Column:
    """First match of a group, ``""`` when there is none."""
    return F.regexp_extract(col_(c), pattern, group)


def regex_all(c: Column | str, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(col_(c), F.lit(pattern), group)


def regex_sub(c: Column | str, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(col_(c), pattern, replacement)


def parse_count(c: Column | str) -> Column:
    """First run of digits as a number, else 0."""
    return F.coalesce(F.regexp_extract(col_(c), r"(\d+)", 1).try_cast("bigint"), F.lit(0).cast("bigint"))


def default_if_blank(c: Column | str, default: Column | str) -> Column:
    fallback = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(F.when(strip_ws(c) != "", col_(c)), fallback)


def preview(c: Column | str, n: int) -> Column:
    return F.substring(col_(c), 1, n)


def escape_html(c: Column | str) -> Column:
    out = col_(c)
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return out


def _character(code: Column) -> Column:
    """The character with a number; one that cannot be gives the replacement character."""
    usual = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    windows = F.element_at(F.array(*map(F.lit, WINDOWS)), F.least(F.greatest(code, F.lit(128)), F.lit(159)).cast("int") - 127)
    bad = code.isNull() | (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    return F.when(bad, "\ufffd").when(code.between(128, 159), windows).otherwise(usual)


def unescape_html(c: Column | str, attribute: bool = False) -> Column:
    """Named and numbered entities decoded. In an attribute an old name without its semicolon stays as it is
    before ``=``, a letter or a digit, so that addresses like ``?a=1&copy=2`` keep their parameters."""
    names = F.from_json(F.lit(NAMED), "map<string,string>")
    old = f"^(?:{OLD})" + ("(?![=A-Za-z0-9])" if attribute else "")

    def decoded(part: Column) -> Column:
        def rest(head: Column) -> Column:
            return F.substr(part, F.length(head) + 1)

        def numbered(number: Column) -> Column:
            hexes, digits = regex_first(number, "[xX]0*([0-9a-fA-F]+)"), regex_first(number, "^#([0-9]+)")
            hexed = F.when(F.length(hexes) <= 8, F.conv(F.when(F.length(hexes) <= 8, hexes), 16, 10).try_cast("bigint"))
            code = F.when(digits != "", digits.try_cast("bigint")).otherwise(hexed)
            return F.when(number != "", F.concat(let(code, _character), rest(number))).otherwise(let(full, named))

        def named(full: Column) -> Column:
            value = F.when(full != "", F.element_at(names, full))
            return let(value, lambda v: F.when(v.isNotNull(), F.concat(v, rest(full))).otherwise(let(short, unclosed)))

        def unclosed(short: Column) -> Column:
            return F.when(short != "", F.concat(F.element_at(names, short), rest(short))).otherwise(F.concat(F.lit("&"), part))

        full, short = regex_first(part, "^[A-Za-z][A-Za-z0-9]*;", 0), regex_first(part, old, 0)
        return let(regex_first(part, "^#(?:[xX][0-9a-fA-F]+|[0-9]+);?", 0), numbered)

    def joined(parts: Column) -> Column:
        coded = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
        return F.concat(parts[0], F.array_join(F.transform(coded, decoded), ""))

    return let(col_(c), lambda text: F.when(F.contains(text, F.lit("&")), let(F.split(text, "&"), joined)).otherwise(text))


def escape_quotes(c: Column | str) -> Column:
    """Escape for a double-quoted front-matter value; the escape sign itself is escaped too."""
    return F.replace(F.replace(col_(c), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def unescape_quotes(c: Column | str) -> Column:
    """Undo :func:`escape_quotes`: drop one escape sign in front of any character."""
    return F.regexp_replace(col_(c), r"(?s)\\(.)", "$1")


def strip_tags(c: Column | str) -> Column:
    return F.regexp_replace(col_(c), r"<[^>]*>", "")


def strip_noise_text(c: Column | str) -> Column:
    """Drop scripts and CDATA; the CDATA patterns are tried only on text that mentions it."""

    def dropped(text: Column) -> Column:
        bare = rest = F.regexp_replace(text, SCRIPT, "")
        for pattern in CDATA_PATTERNS:
            rest = F.regexp_replace(rest, pattern, "")
        return F.when(F.contains(text, F.lit("CDATA")), rest).otherwise(bare)

    return let(col_(c), dropped)


def parse_signature(c: Column | str) -> Column:
    """``"date | author"`` to a struct; without a separator everything is the author."""
    parts = split_n(c, " | ", 2)
    both = F.size(parts) == 2
    return F.struct(
        F.when(both, clean_text(parts[0])).otherwise(F.lit("")).alias("date"),
        F.when(both, clean_text(F.get(parts, 1))).otherwise(clean_text(c)).alias("author"),
    )


def normalise_categories(c: Column | str) -> Column:
    """Clean every entry and drop the blank ones; order and repeats stay."""
    return F.filter(F.transform(F.coalesce(col_(c), F.array().cast("array<string>")), lambda x: clean_text(x)), lambda x: x != "")


def list_literal(c: Column | str) -> Column:
    """Render ``['a', 'b']``; an item holding ``'`` but no ``"`` is quoted with ``"``."""

    def item(x: Column) -> Column:
        safe = F.replace(x, F.lit("\\"), F.lit("\\\\"))
        double = F.contains(x, F.lit("'")) & ~F.contains(x, F.lit('"'))
        single = F.concat(F.lit("'"), F.replace(safe, F.lit("'"), F.lit("\\'")), F.lit("'"))
        return F.when(double, F.concat(F.lit('"'), safe, F.lit('"'))).otherwise(single)

    return F.concat(F.lit("["), F.array_join(F.transform(col_(c), item), ", "), F.lit("]"))


# One list item: single-quoted, double-quoted or bare.
LIST_ITEM = r"""'[^'\\]*(?:\\.[^'\\]*)*'|"[^"\\]*(?:\\.[^"\\]*)*"|[^,\s'"][^,]*"""


def parse_list_literal(c: Column | str) -> Column:
    """Read the inside of a list literal; a comma within quotes does not split."""

    def item(x: Column) -> Column:
        quoted = x.rlike(r"""(?s)^(?:'.*'|".*")$""")
        inner = F.substring(x, F.lit(2), F.length(x) - 2)
        return F.when(quoted, unescape_quotes(inner)).otherwise(strip_ws(x))

    return F.filter(F.transform(regex_all(c, LIST_ITEM, 0), item), lambda x: x != "")


def to_record_json(df: DataFrame, out: str = "record") -> DataFrame:
    """Whole rows as JSON text; null fields are written, too."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(out))


def from_record_json(df: DataFrame, schema: str, record: str = "record") -> DataFrame:
    """JSON text back to columns; text that is not JSON gives nulls."""
    return df.select(F.from_json(record, schema).alias("_r")).select("_r.*")
