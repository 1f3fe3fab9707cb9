"""Order-dependent work without putting a whole group into one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioworks.session import materialise


def first_seen(df: DataFrame, key: str = "url", order: Sequence[str] = ("page_id", "pos")) -> DataFrame:
    """The first row per key in document order.

    A minimum over ``struct(order, rest)`` rather than a window: every task first reduces its own rows
    to one per key, so a URL that fills a third of the table costs one row per task in the shuffle.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    best = df.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("_r"))
    return best.select(*(F.col(c) if c == key else F.col(f"_r.{c}").alias(c) for c in df.columns))


def prefix_scan(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    sums: Mapping[str, Column] | None = None,
    position: str = "position",
    total: str | None = None,
) -> DataFrame:
    """Row number, group size and running sums per group, in two levels.

    ``bucket`` cuts each group into short consecutive ranges and must never decrease along ``order``.
    Counts and sums per range come from a partial aggregation; a window over those few rows gives every
    range its start values; a second window numbers the rows within one range. The largest unit a task
    sorts is therefore a range, not a group, however uneven the groups are.
    """
    sums = dict(sums or {})
    columns = df.columns
    # One struct as key: its equality treats nulls as equal, so rows with a null key are kept.
    keyed = df.withColumn("_k", F.struct(*group, bucket.alias("_b")))
    for name, value in sums.items():
        keyed = keyed.withColumn(f"_v_{name}", value)
    per = keyed.groupBy("_k").agg(
        F.count(F.lit(1)).alias("_n"), *(F.sum(f"_v_{name}").alias(f"_t_{name}") for name in sums)
    )
    owner = F.struct(*(F.col(f"_k.{g}") for g in group))
    whole = Window.partitionBy(owner)
    before = whole.orderBy("_k._b").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select(
        "_k",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.sum("_n").over(whole).alias("_size"),
        *(F.coalesce(F.sum(f"_t_{name}").over(before), F.lit(0)).alias(f"_s_{name}") for name in sums),
    )
    within = Window.partitionBy("_k").orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    return keyed.join(starts, "_k").select(
        *columns,
        (F.col("_start") + F.row_number().over(within)).alias(position),
        *([F.col("_size").alias(total)] if total else []),
        *((F.col(f"_s_{name}") + F.sum(f"_v_{name}").over(upto)).alias(name) for name in sums),
    )


def number_comments(
    comments: DataFrame, key: str = "url", order: str = "turn", width: int = 4096, name: str = "comment_no"
) -> DataFrame:
    """Ordinal 1..n of a comment in its post; ``order`` is a whole number unique within the post."""
    return prefix_scan(comments, [key], [order], F.floor(F.col(order) / width), position=name)


def ranged(df: DataFrame, group: Sequence[str], order: Sequence[str], ranges: int | None = None, name: str = "_range") -> DataFrame:
    """``df`` with the number of its range of the whole order ``(group, order)``, by which :func:`prefix_scan` can cut groups.

    The borders are quantiles that Spark samples over all columns of the order, so ranges hold about as many rows each whether a group is large or
    many rows share its first column. The numbered rows are written once: their borders must be the same wherever they are read.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(ranges, *group, *order).withColumn(name, F.spark_partition_id())
    return materialise(cut, "ranges")


def positions(
    log: DataFrame,
    run: str = "run",
    order: Sequence[str] = ("ts", "event_id"),
    ranges: int | None = None,
) -> DataFrame:
    """Item i of N within a run: adds ``seq`` and ``run_size``."""
    cut = ranged(log, [run], order, ranges)
    return prefix_scan(cut, [run], order, F.col("_range"), position="seq", total="run_size").drop("_range")


def checkpoints(
    log: DataFrame,
    every: int = 50,
    run: str = "run",
    order: Sequence[str] = ("ts", "event_id"),
    status: str = "status",
    ranges: int | None = None,
) -> DataFrame:
    """Running success and error totals of a run, sampled at every ``every``-th item."""
    ok = F.col(status) == "ok"
    scanned = prefix_scan(
        ranged(log, [run], order, ranges),
        [run],
        order,
        F.col("_range"),
        sums={"successes": F.when(ok, 1).otherwise(0), "errors": F.when(ok, 0).otherwise(1)},
        position="seq",
        total="run_size",
    )
    return scanned.where(F.col("seq") % every == 0).select(run, "seq", "run_size", "successes", "errors")
