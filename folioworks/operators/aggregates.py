"""Counts and roll-ups. All of them combine on the map side; none collects a group of unknown size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.functions.text import col_, pad2
from folioworks.functions.urls import url_host

TOKEN_BREAK = r"[^\p{L}\p{N}_]+"


def count_posts(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_posts"))


def archive_month(archive_path: Column | str) -> Column:
    """``posts/Y/M/...`` to ``YYYY-MM``."""
    parts = F.split(col_(archive_path), "/")
    return F.concat(F.get(parts, 1), F.lit("-"), pad2(F.get(parts, 2)))


def posts_by_month(posts: DataFrame) -> DataFrame:
    return posts.groupBy("month").agg(F.count(F.lit(1)).alias("posts"))


def archive_range(posts: DataFrame) -> DataFrame:
    """``first to last`` month, ``N/A`` for an empty archive."""
    span = posts.agg(F.min("month").alias("lo"), F.max("month").alias("hi"), F.count(F.lit(1)).alias("total_posts"))
    return span.select(
        F.coalesce(F.concat("lo", F.lit(" to "), "hi"), F.lit("N/A")).alias("date_range"), "total_posts"
    )


def run_summary(log: DataFrame, by: tuple[str, ...] = (), status: str = "status") -> DataFrame:
    """Successes, errors, total and success rate in percent, ``N/A`` when nothing ran."""
    ok = F.col(status) == "ok"
    out = log.groupBy(*by).agg(F.count_if(ok).alias("successes"), F.count_if(~ok).alias("errors"))
    total = F.col("successes") + F.col("errors")
    rate = F.round(F.lit(100.0) * F.col("successes") / F.nullif(total, F.lit(0)), 1)
    return out.withColumn("total", total).withColumn(
        "success_rate", F.coalesce(F.concat(rate.cast("string"), F.lit("%")), F.lit("N/A"))
    )


def comment_counts(posts: DataFrame) -> DataFrame:
    return posts.select("url", F.size("comments").cast("bigint").alias("comments"))


COMMENTS_HEADING = r"\n\n## Comments(?:\n\n---\n| \(\d+\)\n\n)"


def comment_counts_in_text(files: DataFrame, key: str = "file_path", text: str = "text") -> DataFrame:
    """Comments of a rendered text, in either layout: the number its front matter carries, else those after the last comments heading.

    Without a carried number, comments of the site layout count by their author's name, those before a comment that holds the
    layout's heading itself are not seen, and such a heading in the body of a post without comments is taken for theirs.
    """
    body = F.col(text)
    front = F.when(F.startswith(body, F.lit("---\n")), F.substring_index(body, "\n---\n", 1))
    carried = F.get(F.reverse(F.regexp_extract_all(front, F.lit(r"(?m)^comments_count: (\d+)$"), 1)), 0).cast("bigint")
    parts = F.split(body, COMMENTS_HEADING, -1)
    tail = F.when(F.size(parts) > 1, F.element_at(parts, -1)).otherwise(F.lit(""))
    numbered = F.size(F.regexp_extract_all(tail, F.lit(r"(?m)^### Comment \d+$"), 0))
    signed = F.size(F.regexp_extract_all(tail, F.lit(r"(?m)^\*\*Author:\*\* "), 0))
    seen = F.when(numbered > 0, numbered).otherwise(signed).cast("bigint")
    return files.select(key, F.coalesce(carried, seen).alias("comments_count"))


def collect_comments(comments: DataFrame, key: str = "url", ordinal: str = "comment_no", chunk: int = 100) -> DataFrame:
    """Comments as ordered arrays of at most ``chunk``: ``(key, chunk_no, comments)``.

    A post with more comments gets several rows, so no array outgrows its bound and nothing is left out.
    """
    rest = [c for c in comments.columns if c not in (key, ordinal)]
    return (
        comments.groupBy(key, F.floor((F.col(ordinal) - 1) / chunk).alias("chunk_no"))
        .agg(F.array_sort(F.collect_list(F.struct(ordinal, *rest))).alias("comments"))
    )


def month_groups(posts: DataFrame, tie: str = "url") -> DataFrame:
    """Posts of each month in date order, kept flat: the group is a run of rows, not an array."""
    return posts.select("month", "date", "title", "archive_path", "comments_count", tie).orderBy("month", "date", tie)


def completion(manifest: DataFrame, completed: DataFrame, key: str = "url") -> DataFrame:
    """Completed, remaining and total URLs of the manifest."""
    urls = manifest.select(key).distinct()
    done = completed.select(key).distinct().withColumn("_done", F.lit(1))
    return urls.join(done, key, "left").agg(
        F.count(F.lit(1)).alias("total_posts"),
        F.count("_done").alias("completed_count"),
        F.count_if(F.col("_done").isNull()).alias("remaining_count"),
    )


def count_changed(df: DataFrame, before: str, after: str) -> DataFrame:
    return df.agg(
        F.count_if(~F.col(before).eqNullSafe(F.col(after))).alias("changed"), F.count(F.lit(1)).alias("total")
    )


def category_counts(posts: DataFrame) -> DataFrame:
    return (
        posts.select(F.explode("categories").alias("category"))
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("posts"))
    )


def archive_by(posts: DataFrame, by: str) -> DataFrame:
    """Post counts per ``week`` (its Monday), ``month`` or ``initial`` of the title."""
    day = F.try_to_date("date", "yyyy-MM-dd")
    if by == "initial":
        bucket = F.upper(F.substring(F.regexp_replace("title", r"^[^\p{L}\p{N}_]+", ""), 1, 1))
        rows = posts
    elif by in ("week", "month"):
        rows = posts.where(F.col("date").rlike(r"^\d{4}-\d{2}-\d{2}$"))
        bucket = F.date_format(F.date_trunc(by, day), "yyyy-MM-dd" if by == "week" else "yyyy-MM")
    else:
        raise ValueError(f"unknown roll-up {by!r}")
    return rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("posts"))


def term_postings(posts: DataFrame, key: str = "url", text: str = "content") -> DataFrame:
    """Inverted index: ``(term, key, n)``. The key is part of the group, so a frequent term is spread out."""
    terms = posts.select(key, F.explode(F.split(F.lower(text), TOKEN_BREAK)).alias("term")).where(F.col("term") != "")
    return terms.groupBy("term", key).agg(F.count(F.lit(1)).alias("n"))


def find_posts(
    postings: DataFrame, posts: DataFrame, term: str, category: str | None = None, key: str = "url"
) -> DataFrame:
    """Posts holding a term, optionally within one category, with the term's count.

    ``postings`` is the whole index as rows or, better, what ``postings.scan_term`` reads of the stored one.
    """
    rows = posts.where(F.array_contains("categories", category)) if category else posts
    return rows.join(postings.where(F.col("term") == term.lower()).select(key, "n"), key)


def links_per_host(links: DataFrame, target: str = "target") -> DataFrame:
    return (
        links.groupBy(url_host(target).alias("host"))
        .agg(F.count(F.lit(1)).alias("links"), F.min(target).alias("first_target"))
    )
