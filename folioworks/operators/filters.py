"""Row filters; rejected rows are kept in a table of their own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.functions.urls import MALFORMED


def internal_links(links: DataFrame, prefix: str, col: str = "href") -> DataFrame:
    return links.where(F.startswith(F.col(col), F.lit(prefix)))


def split_malformed(links: DataFrame, col: str = "href", token: str = MALFORMED) -> tuple[DataFrame, DataFrame]:
    """(well-formed links, rejects)."""
    bad = F.contains(F.col(col), F.lit(token))
    return links.where(~bad), links.where(bad)


def drop_blank(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, (F.coalesce(F.col(c), F.lit("")) != "" for c in cols)))


def has_front_matter(files: DataFrame, text: str = "text") -> DataFrame:
    return files.where(F.col(text).rlike(r"(?s)^---\n.*?\n---"))


def dated_only(df: DataFrame, path: str = "archive_path") -> DataFrame:
    """Posts whose archive directory holds a year and a month."""
    return df.where(F.size(F.split(path, "/")) >= 3)


def matches_url_pattern(df: DataFrame, pattern: str, col: str = "url") -> DataFrame:
    return df.where(F.col(col).rlike(pattern))


def has_comments(df: DataFrame) -> DataFrame:
    return df.where(F.col("comments_count") > 0)


def changed(df: DataFrame, before: str | Column, after: str | Column) -> DataFrame:
    old = F.col(before) if isinstance(before, str) else before
    new = F.col(after) if isinstance(after, str) else after
    return df.where(~old.eqNullSafe(new))
