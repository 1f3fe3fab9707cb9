"""Reports that check the archive against itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def comment_count_check(posts: DataFrame) -> DataFrame:
    """Posts whose declared comment count differs from the comments found."""
    found = F.size("comments").cast("bigint")
    return posts.where(F.col("comments_count") != found).select(
        "url", F.col("comments_count").alias("declared"), found.alias("found")
    )


def broken_links(edges: DataFrame, url_map: DataFrame) -> DataFrame:
    """Internal edges whose target is not in the archive."""
    known = url_map.select(F.col("url").alias("target_url"))
    return edges.where("is_internal").join(known, "target_url", "left_anti").select(*edges.columns)


def reconcile(index: DataFrame, posts: DataFrame, key: str = "file_path") -> DataFrame:
    """Paths the index and the corpus do not hold equally often.

    Both sides are tagged and counted in one aggregation, so a path repeated many times is combined
    before the shuffle and no join is needed.
    """
    tagged = index.select(key, F.lit(1).alias("i"), F.lit(0).alias("p")).unionByName(
        posts.select(key, F.lit(0).alias("i"), F.lit(1).alias("p"))
    )
    both = tagged.groupBy(key).agg(F.sum("i").alias("in_index"), F.sum("p").alias("in_posts"))
    status = (
        F.when(F.col("in_posts") == 0, "missing_file").when(F.col("in_index") == 0, "not_indexed").otherwise("repeated")
    )
    return both.where("in_index <> in_posts").withColumn("status", status)
