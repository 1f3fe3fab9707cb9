"""The link graph and link rewriting, without a callback: explode, look up, rebuild."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.functions import html as H
from folioworks.functions.text import col_, regex_all, regex_first
from folioworks.functions.urls import HAS_SCHEME, Site, normalise_url, relative_path, resolve_url, url_fragment, url_host
from folioworks.operators.joins import resolve_links

# What stands before a link target in either syntax, which characters it may hold, and what stands behind it.
# Attributes come in double quotes, single quotes or none; the space around the equals sign is bounded, as a look-behind must be.
HREF = r"(?<![\w-])(?i:href)\s{0,9}=\s{0,9}"
SYNTAX = {
    "markdown": ((r"\]\(", r"[^)]*", r"\)"),),
    "html": ((HREF + '"', r'[^"]*', '"'), (HREF + "'", r"[^']*", "'"), (HREF, r"""[^\s"'>]*""", r"[\s>]")),
}


def link_regex(site: Site, syntax: str) -> str:
    """Pattern of the target of an internal link, without what stands around it.

    Look-behinds of attributes are dozens of trials a character; the look-ahead before them, which every form implies, leaves them to the few
    places where such a link can begin.
    """
    forms = [f"(?<={start})(?:{site.link_pattern}{body})(?={end})" for start, body, end in SYNTAX[syntax]]
    return forms[0] if len(forms) == 1 else f"(?=[h/])(?={site.link_pattern})(?:{'|'.join(forms)})"


def rewrite_links(
    docs: DataFrame,
    url_map: DataFrame,
    site: Site,
    syntax: str = "markdown",
    key: str = "url",
    text: str = "content",
    path: str = "file_path",
    target_path: str = "file_path",
    into: str | None = None,
) -> DataFrame:
    """Internal links whose page is in ``url_map(url, target_path)`` become relative paths; others stay.

    The new text replaces ``text``, or goes to the column ``into`` next to it. Of several paths of one URL the least counts.

    Links of a document travel through the lookup with a key of their own row (``key``, path and a hash of the text) and
    come back to it in one left join: rows that share a key keep their own links, rows that are equal share them, and
    null keys stay. The list rebuilt per document is bounded by its own text. A fragment is kept behind the new path.
    """
    pattern = link_regex(site, syntax)
    # One struct as key: its equality treats nulls as equal.
    keyed = docs.withColumn("_row", F.struct(F.col(key).alias("key"), F.col(path).alias("path"), F.xxhash64(text).alias("text")))
    found = keyed.select(
        "_row", F.col(path).alias("_here"), F.posexplode(regex_all(text, pattern, 0)).alias("_pos", "_raw")
    ).withColumn("_url", normalise_url("_raw", site))
    targets = url_map.select(F.col("url").alias("_url"), F.col(target_path).alias("_there"))
    new = F.concat(relative_path("_there", "_here"), url_fragment("_raw"))
    per_row = (
        resolve_links(found, targets, "_url")
        .select("_row", "_pos", F.coalesce(new, "_raw").alias("_to"))  # one target per place: equal rows repeat it
        .groupBy("_row")
        .agg(F.array_sort(F.collect_set(F.struct("_pos", "_to"))).alias("_links"))
    )
    parts = F.split(text, pattern, -1)
    tail = F.zip_with(
        F.slice(parts, F.lit(2), F.size(parts) - 1),
        F.col("_links._to"),
        lambda part, to: F.concat(to, part),
    )
    rebuilt = F.when(F.col("_links").isNull(), F.col(text)).otherwise(F.concat(parts[0], F.array_join(tail, "")))
    return keyed.join(per_row, "_row", "left").withColumn(into or text, rebuilt).drop("_row", "_links")


def rewrite_markdown_links(docs: DataFrame, url_map: DataFrame, site: Site, **names: str) -> DataFrame:
    return rewrite_links(docs, url_map, site, "markdown", **names)


def rewrite_html_links(docs: DataFrame, url_map: DataFrame, site: Site, **names: str) -> DataFrame:
    return rewrite_links(docs, url_map, site, "html", **names)


def link_kind(raw: Column | str, base: Column | str, site: Site | None = None) -> Column:
    """``relative``, ``internal`` (same host as the page, or the site) or ``external``."""
    host = F.regexp_replace(url_host(resolve_url(base, raw)), r"^www\.", "")
    own = F.lit(site.host) if site else F.regexp_replace(url_host(base), r"^www\.", "")
    absolute = col_(raw).rlike(HAS_SCHEME) | F.startswith(col_(raw), F.lit("//"))
    return F.when(~absolute, "relative").when(host == own, "internal").otherwise("external")


def classify_links(docs: DataFrame, site: Site | None = None, key: str = "page_id", html: str = "html") -> DataFrame:
    """Every ``href`` and ``src`` in order: ``(key, pos, attr, raw, kind, absolute)``."""
    found = docs.select(key, "url", F.posexplode(H.link_attrs(html)).alias("pos", "l"))
    return found.select(
        key,
        "pos",
        "l.attr",
        "l.raw",
        link_kind(F.col("l.raw"), F.col("url"), site).alias("kind"),
        resolve_url(F.col("url"), F.col("l.raw")).alias("absolute"),
    )


def link_edges(posts: DataFrame, site: Site, text: str = "content") -> DataFrame:
    """Markdown links as edges: ``(src_url, pos, anchor_text, target_url, is_internal)``."""
    pattern = r"\[([^\]\n]*)\]\(([^)\s]*)\)"
    found = posts.select(F.col("url").alias("src_url"), F.posexplode(regex_all(text, pattern, 0)).alias("pos", "l"))
    target = normalise_url(resolve_url(F.col("src_url"), regex_first("l", pattern, 2)), site)
    return found.select(
        "src_url",
        "pos",
        regex_first("l", pattern, 1).alias("anchor_text"),
        target.alias("target_url"),
        F.startswith(target, F.lit(site.base_url + site.section)).alias("is_internal"),
    )
