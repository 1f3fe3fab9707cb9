"""Joins and set operations.

No side is hinted for broadcast: the optimiser does it when the size it knows is under the threshold,
and otherwise shuffles and splits skewed partitions of the large side at run time. All lookups below are
joins that allow that split (inner, left outer, left anti), with one row per key on the small side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def remaining(manifest: DataFrame, completed: DataFrame, key: str = "url") -> DataFrame:
    """Manifest rows not yet completed; order column and repeats stay."""
    return manifest.join(completed.select(key).distinct(), key, "left_anti")


def resolve_links(links: DataFrame, url_map: DataFrame, key: str = "url") -> DataFrame:
    """Every link with the path of its target, null when the target is not in the map.

    A key that the map holds several times counts once, with its least row.
    """
    return links.join(one_per_key(url_map, key), key, "left")


def one_per_key(lookup: DataFrame, key: str = "url") -> DataFrame:
    """The least row of each key. A lookup that is aggregated by the key already is not moved again."""
    rest = [c for c in lookup.columns if c != key]
    best = lookup.groupBy(key).agg(F.min(F.struct(*rest)).alias("_r"))
    return best.select(*(F.col(c) if c == key else F.col(f"_r.{c}").alias(c) for c in lookup.columns))


def with_post_data(url_map: DataFrame, posts: DataFrame, key: str = "archive_path") -> DataFrame:
    shared = [c for c in posts.columns if c != key and c in url_map.columns]
    return url_map.join(posts.drop(*shared), key, "inner")


def merge_completed(old: DataFrame, new: DataFrame, key: str = "url") -> DataFrame:
    """Union as a set of keys."""
    return old.select(key).union(new.select(key)).distinct()


def distinct_urls(links: DataFrame, key: str = "url") -> DataFrame:
    return links.select(key).distinct()


def url_map(posts: DataFrame, **paths) -> DataFrame:
    """One row per URL with the given path columns; rows without a URL are left out."""
    named = posts.where(F.coalesce("url", F.lit("")) != "").select("url", *(c.alias(n) for n, c in paths.items()))
    return named.groupBy("url").agg(*(F.min(n).alias(n) for n in paths))
