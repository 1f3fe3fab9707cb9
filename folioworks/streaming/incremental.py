"""Resume, duplicate detection and live progress as streams.

Exactly-once rests on the checkpoint plus batch-numbered output folders: a batch that runs again after a
failure overwrites its own folder. What earlier batches saw is kept by key in the state store, where a batch looks
up its own keys only; ``stream_extract`` alone reads the folders of earlier batches.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioworks.operators.extract import POST_SELECTORS, extract_posts
from folioworks.operators.joins import remaining

PAGE_SCHEMA = "page_id bigint, url string, html string"


# Keyed state lives in RocksDB, on the executors' disks and in the checkpoint, with one change log per batch.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def read_page_stream(
    spark: SparkSession, table: str, schema: str = PAGE_SCHEMA, files_per_batch: int = 1000
) -> DataFrame:
    """Pages of ``table``, a folder of part files or a single file, as they arrive."""
    # A stream takes a plain path for a folder; a pattern that only this name fits is right for both.
    table = table.rstrip("/")
    only = f"{table[:-1]}[{table[-1]}]" if table[-1].isalnum() else table
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(only)


def _earlier(spark: SparkSession, out: str, batch: int, schema: str) -> DataFrame:
    """Rows of batches before ``batch``."""
    try:
        rows = spark.read.schema(schema).option("basePath", out).parquet(out)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return rows.where(F.col("batch_id") < batch)


def _start(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    conf = stream.sparkSession.conf
    before = {key: conf.get(key, None) for key in STATE_CONF}
    for key, value in STATE_CONF.items():
        conf.set(key, value)
    try:  # the query takes its own copy of the settings
        return (
            stream.writeStream.foreachBatch(each)
            .outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for key, value in before.items():
            if value is None:
                conf.unset(key)
            else:
                conf.set(key, value)


def stream_extract(
    pages: DataFrame,
    out: str,
    checkpoint: str,
    selectors: Mapping = POST_SELECTORS,
    completed: DataFrame | None = None,
    extract: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Read the new pages into post records under ``out``; a later run takes up where this one ended.

    Pages whose URL is in ``completed`` or in the output of an earlier batch are left out before the
    costly parse. Of a URL that comes several times the page with the least ``page_id`` is read, whether its repeats arrive in
    one batch or, in that order, in several. Results are partitioned by batch.
    """
    spark = pages.sparkSession
    work = extract or (lambda df: extract_posts(df, selectors))

    def each(batch: DataFrame, number: int) -> None:
        todo = remaining(batch, _earlier(spark, out, number, "url string, status string, batch_id bigint").where("status = 'ok'"))
        if completed is not None:
            todo = remaining(todo, completed)
        # Found on the two narrow columns; what is left after the parse are rows that repeat both.
        first = todo.groupBy(F.col("url").alias("_url")).agg(F.min("page_id").alias("_page"))
        wins = F.col("url").eqNullSafe(F.col("_url")) & F.col("page_id").eqNullSafe(F.col("_page"))
        work(todo.join(first, wins, "left_semi")).dropDuplicates(["url"]).write.mode("overwrite").parquet(f"{out}/batch_id={number}")

    return _start(pages, each, checkpoint)


def stream_dedupe(
    links: DataFrame, out: str, checkpoint: str, key: str = "url", order: tuple[str, ...] = ("page_id", "pos")
) -> StreamingQuery:
    """Write each key once: the first batch that holds it wins, and in it the least row by ``order``.

    A streaming aggregate keeps, by key, its first row and the times of the first and last batch that held it. A task combines
    its rows of a key before they meet the state, so a URL that fills a third of the stream is one row per task there,
    and a batch touches the state of its own keys only, however many came before. A key is new as long as all its rows
    came in one batch: the batch time is part of the checkpoint, so a batch that runs again gives the same rows.
    """
    rest = [c for c in links.columns if c not in (key, *order)]
    best = F.struct(F.col("_at"), *order, *rest)
    state = (
        links.withColumn("_at", F.current_timestamp())
        .groupBy(key)
        .agg(F.min(best).alias("_first"), F.max("_at").alias("_last"))
        .where("_first._at = _last")
        .select(*(F.col(c) if c == key else F.col(f"_first.{c}").alias(c) for c in links.columns))
    )

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={number}")

    return _start(state, each, checkpoint, "update")


def dedupe_within_watermark(links: DataFrame, ts: str, delay: str, key: str = "url") -> DataFrame:
    """Native variant with bounded state, for links that carry an event time."""
    return links.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def stream_progress(results: DataFrame, out: str, checkpoint: str, status: str = "status") -> StreamingQuery:
    """Counts per status, updated with every batch.

    Each batch adds one row per status; :func:`read_progress` sums them up.
    """

    def each(batch: DataFrame, number: int) -> None:
        counts = batch.groupBy(status).agg(F.count(F.lit(1)).alias("n"))
        counts.coalesce(1).write.mode("overwrite").parquet(f"{out}/batch_id={number}")

    return _start(results, each, checkpoint)


def read_progress(spark: SparkSession, out: str, status: str = "status") -> DataFrame:
    rows = spark.read.schema(f"{status} string, n bigint, batch_id bigint").option("basePath", out).parquet(out)
    return rows.groupBy(status).agg(F.sum("n").alias("n"))


def live_progress(results: DataFrame, status: str = "status") -> DataFrame:
    """The same totals as a streaming aggregate for an update-mode sink."""
    return results.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def stream_totals(results: DataFrame, out: str, checkpoint: str, status: str = "status") -> StreamingQuery:
    """Running totals per status: each batch writes the totals it changed; :func:`read_totals` takes the last of each."""

    def each(batch: DataFrame, number: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(f"{out}/batch_id={number}")

    return _start(live_progress(results, status), each, checkpoint, "update")


def read_totals(spark: SparkSession, out: str, status: str = "status") -> DataFrame:
    rows = spark.read.schema(f"{status} string, n bigint, batch_id bigint").option("basePath", out).parquet(out)
    return rows.groupBy(status).agg(F.max_by("n", "batch_id").alias("n"))
