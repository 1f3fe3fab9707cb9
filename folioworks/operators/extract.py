"""Selector-based extraction: one parse per page inside an Arrow batch, everything after it on the JVM."""

from __future__ import annotations

import gc
import sys
from collections.abc import Mapping
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from folioworks.functions import html as H
from folioworks.functions.dates import parse_archive_date
from folioworks.functions.text import clean_text, let, normalise_categories, parse_count, parse_signature, strip_noise_text, strip_token
from folioworks.functions.urls import resolve_url
from folioworks.operators.htmltree import Page, compile_selector, select, to_markdown
from folioworks.operators.markdown import space_blocks

# Where a blog page keeps its parts. Pass another mapping for another page layout.
POST_SELECTORS = {
    "title": ".journal-entry h2.title a",
    "content": ".journal-entry .body",
    "author": ".journal-entry-tag-post-body .posted-by a",
    "date": ".journal-entry-tag-post-title .posted-on",
    "post_id": ".journal-entry[id]",
    "categories": ".journal-entry-tag-post-body-line2 .posted-in .tag-element a",
    "comments_count": ".post-comments a",
    "comments": ".comment-wrapper .comment",
    "comment_body": ".body",
    "comment_signature": ".signature",
}

MARKDOWN = T.StructType().add("text", T.StringType()).add("spaced", T.BooleanType())


def _field_type(mode):
    if isinstance(mode, Mapping):
        return T.ArrayType(_schema(mode))
    return {"texts": T.ArrayType(T.StringType()), "markdown": MARKDOWN}.get(mode, T.StringType())


def _schema(fields):
    return T.StructType([T.StructField(name, _field_type(mode)) for name, (_, mode) in fields.items()])


_selector = lru_cache(maxsize=256)(compile_selector)


def _compiled(fields):
    return [
        (name, _selector(sel) if sel else None, _compiled(mode) if isinstance(mode, Mapping) else mode)
        for name, (sel, mode) in fields.items()
    ]


def _read(root, find, fields):
    """Values of ``fields``; ``find`` gives the matches of a selector below ``root``."""
    out, first = {}, {}  # first matches by selector, looked up once until a field changes the tree
    for name, groups, mode in fields:
        if isinstance(mode, list):
            out[name] = [_read(n, partial(select, n), mode) for n in find(groups)]
            continue
        if mode == "texts":
            out[name] = [n.text() for n in find(groups)]
            continue
        if groups is not None and id(groups) not in first:
            first[id(groups)] = next(iter(find(groups)), None)
        node = root if groups is None else first[id(groups)]
        if node is None:
            out[name] = None
        elif mode == "text":
            out[name] = node.text()
        elif mode == "html":
            out[name] = node.html()
        elif mode == "markdown":
            out[name] = dict(zip(("text", "spaced"), to_markdown(node)))
            first.clear()
        else:
            out[name] = node.attrs.get(mode.removeprefix("attr:"))
    return out


def html_fields(html: Column | str, fields: Mapping) -> Column:
    """Struct of the selected fields plus ``error``.

    ``fields`` maps a name to ``(selector, mode)``. Modes: ``text``, ``html``, ``markdown`` and
    ``attr:<name>`` read the first match, ``texts`` reads all, and a nested mapping makes an array with
    one struct per match, its selectors (``None`` = the match itself) relative to it. ``markdown`` prunes
    the tree, so list it after the modes that read the same part. A page that cannot be read gets a
    null for every field and the reason in ``error``.
    """
    plan = _compiled(fields)
    schema = T.StructType([*_schema(fields).fields, T.StructField("error", T.StringType())])
    arrow = to_arrow_type(schema)

    @F.arrow_udf(schema)
    def run(pages: pa.Array) -> pa.Array:
        sys.setrecursionlimit(50_000)
        rows, collects = [], gc.isenabled()
        gc.disable()  # trees are taken apart here; searching all rows of the batch for cycles again and again costs a sixth
        try:
            for page in pages:
                try:
                    tree = Page(page.as_py())
                    rows.append(_read(tree.root, tree.select, plan))
                    tree.free()
                except Exception as problem:  # one bad page must not fail the batch
                    rows.append({"error": f"{type(problem).__name__}: {problem}"})
            return pa.array(rows, type=arrow)
        finally:
            if collects:
                gc.enable()

    # Nondeterministic keeps the optimiser from running the parse again in a pushed-down filter.
    return run.asNondeterministic()(F.col(html) if isinstance(html, str) else html)


def select_html(pages: DataFrame, fields: Mapping, html: str = "html") -> DataFrame:
    """Every column of ``pages`` but the source, plus one column per selected field and ``error``."""
    keep = [c for c in pages.columns if c != html]
    parsed = pages.select(*keep, html_fields(html, fields).alias("_f"))
    return parsed.select(*keep, "_f.*")


def extract_field(pages: DataFrame, selector: str, name: str = "value", html: str = "html") -> DataFrame:
    """Cleaned text of the first match, ``""`` when absent."""
    out = select_html(pages, {name: (selector, "text")}, html)
    return out.withColumn(name, clean_text(name))


def extract_post_id(pages: DataFrame, selector: str = POST_SELECTORS["post_id"], html: str = "html") -> DataFrame:
    out = select_html(pages, {"post_id": (selector, "attr:id")}, html)
    return out.withColumn("post_id", F.nullif(strip_token("post_id", "item"), F.lit("")))


def extract_categories(pages: DataFrame, selector: str = POST_SELECTORS["categories"], html: str = "html") -> DataFrame:
    out = select_html(pages, {"categories": (selector, "texts")}, html)
    return out.withColumn("categories", normalise_categories("categories"))


def _comment_fields(sel: Mapping) -> dict:
    return {
        "id": (None, "attr:id"),
        "signature": (sel["comment_signature"], "text"),
        "content_html": (sel["comment_body"], "html"),
        "content": (sel["comment_body"], "markdown"),
    }


def _comments(c: Column | str) -> Column:
    """Raw comment fields to comments; the signature is read in a first step so it is split once."""

    def signed(x: Column) -> Column:
        sign = parse_signature(F.coalesce(x["signature"], F.lit("")))
        return F.struct(x["id"].alias("id"), sign.alias("sign"), x["content"].alias("md"), x["content_html"].alias("html"))

    def comment(x: Column) -> Column:
        return F.struct(
            F.coalesce(strip_token(x["id"], "comment"), F.lit("")).alias("id"),
            x["sign"]["author"].alias("author"),
            parse_archive_date(x["sign"]["date"]).alias("date"),
            space_blocks(x["md"]).alias("content"),
            F.coalesce(x["html"], F.lit("")).alias("content_html"),
        )

    return F.transform(F.transform(F.col(c) if isinstance(c, str) else c, signed), comment)


def extract_comments(pages: DataFrame, selectors: Mapping = POST_SELECTORS, html: str = "html") -> DataFrame:
    """``comments`` as array of struct<id, author, date, content, content_html>."""
    out = select_html(pages, {"comments": (selectors["comments"], _comment_fields(selectors))}, html)
    return out.withColumn("comments", _comments("comments"))


def extract_posts(
    pages: DataFrame,
    selectors: Mapping = POST_SELECTORS,
    domains: tuple[str, str] | None = None,
    html: str = "html",
) -> DataFrame:
    """Full post records, with ``status`` ``ok`` or ``failed`` and ``error``.

    ``pages`` needs ``url`` and the page source; its other columns are kept. ``domains`` is
    ``(old, new)``, replaced in every text column.
    """
    fields = {
        "title": (selectors["title"], "text"),
        "author": (selectors["author"], "text"),
        "date": (selectors["date"], "text"),
        "post_id": (selectors["post_id"], "attr:id"),
        "categories": (selectors["categories"], "texts"),
        "comments_count": (selectors["comments_count"], "text"),
        "content_html": (selectors["content"], "html"),
        "comments": (selectors["comments"], _comment_fields(selectors)),
        "content": (selectors["content"], "markdown"),
    }
    keep = [c for c in pages.columns if c not in ("url", html)]
    rec = pages.select(*keep, "url", html, html_fields(html, fields).alias("f")).select(*keep, "url", html, "f.*")
    rec = rec.withColumn("date", clean_text("date"))  # a step of its own, since the date parse reads it often
    posts = rec.select(
        *keep,
        F.nullif(strip_token("post_id", "item"), F.lit("")).alias("post_id"),
        "url",
        clean_text("title").alias("title"),
        clean_text("author").alias("author"),
        parse_archive_date("date").alias("date"),
        space_blocks("content").alias("content"),
        F.coalesce("content_html", F.lit("")).alias("content_html"),
        normalise_categories("categories").alias("categories"),
        parse_count(F.coalesce("comments_count", F.lit(""))).alias("comments_count"),
        _comments("comments").alias("comments"),
        F.current_timestamp().alias("extracted_at"),
        F.col(html).alias("raw_html"),
        F.when(F.col("error").isNull(), "ok").otherwise("failed").alias("status"),
        "error",
    )
    return migrate_domain(posts, ["title", "content", "content_html", "raw_html", "comments"], *domains) if domains else posts


def migrate_domain(df: DataFrame, cols: list[str], old: str, new: str) -> DataFrame:
    """Literal replacement in text columns and in the text fields of arrays of struct."""

    def swap(x: Column) -> Column:
        return F.replace(x, F.lit(old), F.lit(new))

    def each(names):
        return lambda x: F.struct(*(swap(x[n]).alias(n) for n in names))

    changed = {}
    for name in cols:
        kind = df.schema[name].dataType
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            changed[name] = F.transform(name, each(kind.elementType.names))
        else:
            changed[name] = swap(F.col(name))
    return df.withColumns(changed)


def split_outcome(posts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(posts that were read, failures). Both read ``posts``, so give it a written table, not a pending parse."""
    ok = F.col("status") == "ok"
    return posts.where(ok), posts.where(~ok).select("url", "error")


def extract_links(pages: DataFrame, section: str | None = None, key: str = "page_id", html: str = "html") -> DataFrame:
    """Links of a page in order: ``(key, url, pos, href, title, target)``.

    ``section`` limits them to the list following the ``h3`` with exactly that text: the next ``ul``
    sibling, or the first ``ul`` in the next ``div``.
    """
    if section is None:
        source = F.col(html)
    else:
        heading = rf"(?is)^.*?<h3(?:\s[^>]*)?>\s*\Q{section}\E\s*</h3\s*>"
        # A heading that was found leaves a shorter text.
        after = let(F.regexp_replace(html, heading, ""), lambda x: F.when(F.length(x) < F.length(html), x).otherwise(F.lit("")))
        # Up to the next heading of the same rank the first list wins, whether wrapped in a div or not.
        scope = F.regexp_replace(after, r"(?is)<h3[\s>].*$", "")
        source = H.first_list(scope)
    # The outer form, since before the inner one the optimiser tests the size of the list, which finds all links a second time.
    links = pages.select(key, "url", F.posexplode_outer(H.anchors(source)).alias("pos", "link")).where("pos IS NOT NULL")
    return links.select(
        key, "url", "pos", "link.href", "link.title", resolve_url(F.col("url"), F.col("link.href")).alias("target")
    )


def extract_paragraphs(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per non-empty paragraph: ``(key, pos, text)``."""
    return pages.select(key, F.posexplode(H.paragraphs(html)).alias("pos", "text"))


def join_paragraphs(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Paragraphs joined by a blank line. Built within the row, so nothing is shuffled or regrouped."""
    return pages.select(key, F.array_join(H.paragraphs(html), "\n\n").alias("text"))


def strip_noise(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, strip_noise_text(col))
