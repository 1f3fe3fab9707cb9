"""Orders and limits. Dates sort as text, so ISO dates come before raw ones and blanks are last when descending."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioworks.functions.text import preview


def newest_first(posts: DataFrame, tie: str = "url") -> DataFrame:
    """Global sort; the tie-breaker makes it total and lets the range exchange split a date shared by many posts."""
    return posts.orderBy(F.desc("date"), tie)


def months_desc(groups: DataFrame) -> DataFrame:
    return groups.orderBy(F.desc("month"))


def sort_within_month(posts: DataFrame, tie: str = "url") -> DataFrame:
    """Months descending, ascending by date within a month."""
    return posts.orderBy(F.desc("month"), "date", tie)


def take_first(remaining: DataFrame, n: int | None, order: str = "pos") -> DataFrame:
    """The first ``n`` rows in manifest order; 0 or ``None`` keeps all."""
    return remaining.orderBy(order).limit(n) if n else remaining


def latest(posts: DataFrame, n: int = 20, tie: str = "url") -> DataFrame:
    return newest_first(posts, tie).limit(n)


def sample_rows(links: DataFrame, n: int = 5, order: tuple[str, ...] = ("page_id", "pos"), width: int = 50) -> DataFrame:
    """The first rows for a look, with long titles cut."""
    return links.orderBy(*order).limit(n).withColumn("title", preview("title", width))
