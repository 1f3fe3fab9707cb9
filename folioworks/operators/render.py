"""Render posts and index lines as text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.functions.dates import is_iso_date, long_date, month_label, xml_date
from folioworks.functions.text import (
    col_,
    default_if_blank,
    escape_html,
    escape_quotes,
    list_literal,
    normalise_categories,
)
from folioworks.functions.urls import base_name, site_url
from folioworks.operators.aggregates import collect_comments


def _blank(c: Column | str) -> Column:
    return F.coalesce(col_(c), F.lit("")) == ""


def _some(c: Column | str) -> Column:
    return ~_blank(c)


def _lines(*parts: Column | str) -> Column:
    """Lines joined by a line break; a null part is no line."""
    return F.concat_ws("\n", *(F.lit(p) if isinstance(p, str) else p for p in parts))


def _per_comment(comments: Column, block) -> Column:
    return F.array_join(F.transform(comments, block), "")


# ---- the plain layout: a heading, bold labels, numbered comments


def post_head() -> Column:
    """Everything in front of the comments."""
    cats = F.concat(F.lit("**Categories:** "), F.array_join("categories", ", "))
    return F.concat(
        F.lit("# "), F.col("title"), F.lit("\n\n"),
        _lines(
            F.concat(F.lit("**Author:** "), F.col("author")),
            F.concat(F.lit("**Date:** "), F.col("date")),
            F.when(F.size("categories") > 0, cats),
            F.concat(F.lit("**URL:** "), F.col("url")),
        ),
        F.lit("\n\n---\n\n"), F.col("content"),
    )


def _post_comments_head(n: Column) -> Column:
    return F.concat(F.lit("\n\n## Comments ("), n.cast("string"), F.lit(")\n\n"))


def _post_comment(c: Column, number: Column) -> Column:
    return F.concat(
        F.lit("### Comment "), number.cast("string"),
        F.lit("\n**Author:** "), c["author"], F.lit("\n**Date:** "), c["date"],
        F.lit("\n\n"), c["content"], F.lit("\n\n---\n\n"),
    )


def render_post_markdown(posts: DataFrame, out: str = "markdown") -> DataFrame:
    """Posts carrying their comments as an array get the whole text in ``out``."""
    blocks = F.array_join(F.transform("comments", lambda c, i: _post_comment(c, i + 1)), "")
    n = F.size("comments")
    return posts.withColumn(
        out, F.concat(post_head(), F.when(n > 0, F.concat(_post_comments_head(n), blocks)).otherwise(F.lit("")))
    )


# ---- the site layout: front matter, then the post, then signed comments


def site_head(default_author: str, comments_count: Column | None = None) -> Column:
    author = F.when(_blank("author"), F.lit(default_author)).otherwise(F.col("author"))
    title = F.when(_blank("title"), F.lit("Untitled")).otherwise(escape_quotes("title"))
    from_path = F.nullif(F.regexp_extract("file_path", r"(\d{4}-\d{2}-\d{2})", 1), F.lit(""))
    date = F.when(_blank("date"), from_path).otherwise(F.col("date"))
    return _lines(
        "---",
        F.concat(F.lit('title: "'), title, F.lit('"')),
        F.concat(F.lit('author: "'), escape_quotes(author), F.lit('"')),
        F.when(is_iso_date(date), F.concat(F.lit("date: "), date)).when(
            date.isNotNull(), F.concat(F.lit('date: "'), escape_quotes(date), F.lit('"'))
        ),
        F.when(F.size("categories") > 0, F.concat(F.lit("categories: "), list_literal("categories"))),
        F.when(_some("url"), F.concat(F.lit('original_url: "'), escape_quotes("url"), F.lit('"'))),
        *([] if comments_count is None else [F.concat(F.lit("comments_count: "), comments_count.cast("string"))]),
        "layout: post",
        "---",
        "",
        F.when(_some("content"), F.concat(F.col("content"), F.lit("\n"))),
    )


SITE_COMMENTS_HEAD = "\n\n## Comments\n\n---\n"


def _site_comment(c: Column) -> Column:
    return F.concat(
        F.lit("\n"),
        _lines(
            F.when(_some(c["author"]), F.concat(F.lit("**Author:** "), c["author"])),
            F.when(_some(c["date"]), F.concat(F.lit("**Date:** "), c["date"])),
            "",
            F.when(_some(c["content"]), c["content"]),
            "",
            "---",
            "",
        ),
    )


def render_site_markdown(posts: DataFrame, default_author: str, out: str = "markdown", carry_count: bool = False) -> DataFrame:
    """As :func:`render_post_markdown` in the site layout; needs ``file_path`` for undated posts.

    With ``carry_count`` the front matter names the number of comments, which the text alone cannot always tell.
    """
    n = F.coalesce(F.size("comments"), F.lit(0)) if carry_count else None
    tail = F.concat(F.lit(SITE_COMMENTS_HEAD), _per_comment(F.col("comments"), _site_comment))
    return posts.withColumn(
        out, F.concat(site_head(default_author, n), F.when(F.size("comments") > 0, tail).otherwise(F.lit("")))
    )


# ---- either layout in segments, for comments kept as a table of their own


def render_segments(
    posts: DataFrame,
    comments: DataFrame,
    layout: str = "site",
    default_author: str = "Unknown",
    key: str = "url",
    chunk: int = 100,
) -> DataFrame:
    """``(key, seg_no, markdown)``; the segments of a post in order are its whole text.

    ``comments`` holds ``(key, comment_no, author, date, content)``. Segment 0 is the post, each further
    one at most ``chunk`` comments, so a post with millions of comments is spread over many rows.
    """
    per_post = comments.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    head = post_head() if layout == "post" else site_head(default_author)
    opening = _post_comments_head(F.col("_n")) if layout == "post" else F.lit(SITE_COMMENTS_HEAD)
    first = posts.join(per_post, key, "left").select(
        key,
        F.lit(0).cast("bigint").alias("seg_no"),
        F.concat(head, F.when(F.col("_n").isNotNull(), opening).otherwise(F.lit(""))).alias("markdown"),
    )

    def block(c: Column) -> Column:
        return _post_comment(c, c["comment_no"]) if layout == "post" else _site_comment(c)

    chunks = collect_comments(comments.select(key, "comment_no", "author", "date", "content"), key, chunk=chunk)
    rest = chunks.select(
        key, (F.col("chunk_no") + 1).alias("seg_no"), _per_comment(F.col("comments"), block).alias("markdown")
    )
    return first.unionByName(rest.join(posts.select(key), key, "left_semi"))


# ---- index entries, lines and listings


def index_entry(posts: DataFrame) -> DataFrame:
    """Narrow projection for indexes."""
    return posts.select(
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("date", F.lit("")).alias("date"),
        F.coalesce("author", F.lit("")).alias("author"),
        normalise_categories("categories").alias("categories"),
        F.coalesce("comments_count", F.lit(0)).cast("bigint").alias("comments_count"),
        "file_path",
        "url",
    )


def master_entry(posts: DataFrame) -> DataFrame:
    """Entry of the master index: the archive directory instead of the file."""
    return index_entry(posts.withColumn("file_path", F.col("archive_path"))).withColumnRenamed(
        "file_path", "archive_path"
    )


def index_line(base: str = "/archive") -> Column:
    """``- [title](url) (N comments) - *a, b*``; a blank title shows the file name."""
    n = F.col("comments_count")
    return F.concat(
        F.lit("- ["), F.trim(default_if_blank("title", base_name("file_path"))),
        F.lit("]("), site_url("file_path", base), F.lit(")"),
        F.when(n > 0, F.concat(F.lit(" ("), n.cast("string"), F.lit(" comments)"))).otherwise(F.lit("")),
        F.when(F.size("categories") > 0, F.concat(F.lit(" - *"), F.array_join("categories", ", "), F.lit("*")))
        .otherwise(F.lit("")),
    )


def site_listing(entries: DataFrame, title: str, intro: str = "", base: str = "/archive") -> DataFrame:
    """All lines of the index page as ``(part, date, url, line)``; sort by part, date descending, url."""
    count = entries.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(0).alias("part"),
        F.lit("").alias("date"),
        F.lit("").alias("url"),
        F.concat(
            F.lit(f"---\ntitle: {title}\nlayout: home\n---\n\nThis archive preserves "),
            F.col("n").cast("string"),
            F.lit(f" posts and their comments.\n{chr(10) + intro + chr(10) if intro else ''}"),
        ).alias("line"),
    )
    return count.unionByName(entries.select(F.lit(1).alias("part"), "date", "url", index_line(base).alias("line")))


def month_heading() -> Column:
    return F.concat(
        F.lit("    <h2>"), month_label("month"), F.lit(" ("), F.col("posts").cast("string"), F.lit(" posts)</h2>")
    )


def month_index_block() -> Column:
    """HTML block of one post in the month index; title, date and path are escaped."""
    path, n = escape_html("archive_path"), F.col("comments_count")
    count = F.when(n > 0, F.concat(F.lit(" ("), n.cast("string"), F.lit(" comments)"))).otherwise(F.lit(""))
    return F.concat(
        F.lit('    <div class="post">\n        <div class="post-title">'), escape_html("title"),
        F.lit('</div>\n        <div class="post-meta">'), escape_html("date"), count,
        F.lit('</div>\n        <div class="post-links">\n            <a href="'), path,
        F.lit('/raw.html" class="html-link">View HTML</a>\n            <a href="'), path,
        F.lit('/content.md" class="md-link">View Markdown</a>\n        </div>\n    </div>'),
    )


def month_listing(posts: DataFrame) -> DataFrame:
    """Headings and blocks as ``(month, part, date, url, line)``; months descending, dates ascending within."""
    heads = posts.groupBy("month").agg(F.count(F.lit(1)).alias("posts")).select(
        "month", F.lit(0).alias("part"), F.lit("").alias("date"), F.lit("").alias("url"), month_heading().alias("line")
    )
    return heads.unionByName(
        posts.select("month", F.lit(1).alias("part"), "date", "url", month_index_block().alias("line"))
    )


def month_page(posts: DataFrame, title: str) -> DataFrame:
    """The whole month index as ``(place, month, part, date, url, line)``: opening, listing, closing."""
    name = escape_html(F.lit(title))
    span = posts.agg(F.count(F.lit(1)).alias("n"), F.min("month").alias("lo"), F.max("month").alias("hi"))
    opening = F.concat(
        F.lit('<!DOCTYPE html>\n<html lang="en">\n<head>\n    <meta charset="UTF-8">\n    <title>'), name,
        F.lit("</title>\n</head>\n<body>\n    <h1>"), name, F.lit('</h1>\n    <div class="stats">\n        Total Posts: '),
        F.col("n").cast("string"),
        F.lit("<br>\n        Date Range: "),
        F.coalesce(F.concat("lo", F.lit(" to "), "hi"), F.lit("N/A")),
        F.lit("\n    </div>"),
    )

    def edge(place: int, line: Column) -> DataFrame:
        return span.select(
            F.lit(place).alias("place"), F.lit("").alias("month"), F.lit(0).alias("part"),
            F.lit("").alias("date"), F.lit("").alias("url"), line.alias("line"),
        )

    body = month_listing(posts).select(F.lit(1).alias("place"), "*")
    return edge(0, opening).unionByName(body).unionByName(edge(2, F.lit("</body>\n</html>")))


def post_view(posts: DataFrame, site_lang: str = "") -> DataFrame:
    """What a post page shows; unset parts are null."""
    return posts.select(
        "url",
        escape_html("title").alias("title"),
        long_date("date").alias("shown_date"),
        xml_date("date").alias("xml_date"),
        F.nullif("author", F.lit("")).alias("author"),
        F.when(F.size("categories") > 0, F.array_join("categories", ", ")).alias("categories"),
        F.nullif("url", F.lit("")).alias("original_url"),
        default_if_blank("lang", default_if_blank(F.lit(site_lang), "en")).alias("lang"),
    )
