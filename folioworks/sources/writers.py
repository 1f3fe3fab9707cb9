"""Writers. Tables go through Spark's committers; one-file-per-post exports run inside tasks."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioworks.functions.dates import stamp
from folioworks.functions.urls import Site, post_archive_path
from folioworks.operators.aggregates import count_posts
from folioworks.operators.filters import changed, drop_blank
from folioworks.operators.ordering import newest_first
from folioworks.operators.render import master_entry
from folioworks.session import materialise, qualified, shuffles_freed
from folioworks.sources.readers import completed_generation, scan_completed


def write_manifest(df: DataFrame, path: str, source_url: str) -> None:
    """Rows under ``posts`` in manifest order and a one-row header (date, total, source) under ``header``."""
    df.select("pos", "url", "path", "title").orderBy("pos").write.json(f"{path}/posts")
    header = stamp(count_posts(df).withColumn("source_url", F.lit(source_url)), "extraction_date", text=True)
    header.write.json(f"{path}/header")


def write_manifest_document(df: DataFrame, path: str, source_url: str) -> None:
    """The manifest as one JSON document ``manifest.json`` below ``path``, header first, then the posts by ``pos``, which is unique.

    One file is written by one task, row by row; :func:`write_manifest` is the form for many tasks.
    """
    spark = df.sparkSession
    head = stamp(count_posts(df).withColumn("source_url", F.lit(source_url)), "extraction_date", text=True)
    opening = F.concat(F.regexp_replace(F.to_json(F.struct("extraction_date", "total_posts", "source_url")), r"\}$", ""), F.lit(', "posts": ['))
    first = df.agg(F.min("pos")).scalar()
    post = F.to_json(F.struct("url", "path", "title"), {"ignoreNullFields": "false"})
    posts = df.select(F.struct(F.lit(1).alias("part"), "pos").alias("segment"), F.concat(F.when(F.col("pos") == first, "\n").otherwise(",\n"), post).alias("markdown"))

    def edge(rows: DataFrame, part: int, text) -> DataFrame:
        return rows.select(F.struct(F.lit(part).alias("part"), F.lit(0).cast(df.schema["pos"].dataType).alias("pos")).alias("segment"), text.alias("markdown"))

    whole = edge(head, 0, opening).union(posts).union(edge(spark.range(1), 2, F.lit("\n]}\n")))
    export_files(whole.withColumn("file_path", F.lit("manifest.json")), path, segment="segment")


def write_posts(df: DataFrame, path: str, site: Site = Site(), form: str = "parquet", mode: str = "append") -> None:
    """Post records with a URL, partitioned by the year and month of that URL (``0`` when undated).

    The rebalance keeps every task from writing a small file into every month, and splits a month that
    outgrows the advisory size.
    """

    def part(i: int):
        return F.coalesce(F.regexp_extract("url", site.dated_pattern, i).try_cast("int"), F.lit(0))

    rows = drop_blank(df, ["url"]).drop("raw_html").withColumns({"year": part(1), "month": part(2)})
    writer = rows.hint("rebalance", "year", "month").write.mode(mode).partitionBy("year", "month").format(form)
    with shuffles_freed(df.sparkSession):
        (writer.option("compression", "zstd") if form == "parquet" else writer).save(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str = "url", buckets: int = 1024) -> None:
    """A table bucketed and sorted by ``key``.

    Pages, manifest, completed URLs and posts kept this way, with the same number of buckets, join on the
    key without moving page sources or texts through a shuffle.
    """
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)


def write_raw_html(posts: DataFrame, path: str, mode: str = "append") -> None:
    """Page sources in a table of their own, so that they stay out of every later shuffle."""
    drop_blank(posts, ["url"]).select("url", "raw_html").write.mode(mode).parquet(path)


def write_post_markdown(rendered: DataFrame, path: str, mode: str = "append") -> None:
    """Rendered text as ``(archive_path, markdown)`` rows."""
    rendered.select("archive_path", "markdown").write.mode(mode).parquet(path)


def write_site_markdown(rendered: DataFrame, path: str, mode: str = "append") -> None:
    """Rendered text as ``(file_path, markdown)`` rows."""
    rendered.select("file_path", "markdown").write.mode(mode).parquet(path)


def export_files(df: DataFrame, root: str, path: str = "file_path", text: str = "markdown", segment: str | None = None) -> None:
    """One file per ``path`` below ``root``, a shared folder in the default file system or an address of a store that Arrow knows.

    A path with a dot segment would leave ``root`` and ends the job. A file is written under a private name and moved into place at its end, so a task that runs again
    replaces it with the same text. With ``segment`` a file's rows are brought together, sorted and
    streamed out one by one; no file is held in memory.
    """
    root = qualified(df.sparkSession, root)
    rows = df.select(path, text, *([segment] if segment else []))
    if segment:
        rows = rows.repartition(path).sortWithinPartitions(path, segment)

    def save(part) -> None:
        store, top = pafs.FileSystem.from_uri(root) if ":/" in root else (pafs.LocalFileSystem(), root)
        out, made = None, None
        for row in part:
            if out is None or row[0] != out[0]:
                _finish(store, out)
                if {".", ".."} & set(row[0].split("/")):
                    raise ValueError(f"path {row[0]!r} leaves the folder")
                target = f"{top}/{row[0].lstrip('/')}"
                if made != (made := target.rsplit("/", 1)[0]):  # files of one folder come one after another
                    store.create_dir(made, recursive=True)
                draft = f"{target}.{uuid.uuid4().hex}"
                out = (row[0], target, draft, store.open_output_stream(draft))
            out[3].write(row[1].encode())
        _finish(store, out)

    rows.foreachPartition(save)


def _finish(store: pafs.FileSystem, out) -> None:
    if out is not None:
        out[3].close()
        store.move(out[2], out[1])


def export_archive(posts: DataFrame, root: str, site: Site = Site()) -> None:
    """Per post a directory with ``data.json``, ``content.md`` and ``raw.html``. ``posts`` needs ``markdown``."""
    kept = drop_blank(posts, ["url"]).withColumn("_dir", post_archive_path("url", site))
    record = [c for c in posts.columns if c not in ("markdown", "status", "error")]
    files = {
        "data.json": F.to_json(F.struct(*record), {"ignoreNullFields": "false"}),
        "content.md": F.col("markdown"),
        "raw.html": F.coalesce("raw_html", F.lit("")),
    }
    each = F.array(*(F.struct(F.lit(name).alias("name"), text.alias("text")) for name, text in files.items()))
    flat = kept.select("_dir", F.explode(each).alias("f"))
    export_files(flat.select(F.concat_ws("/", "_dir", "f.name").alias("file_path"), F.col("f.text").alias("markdown")), root)


def write_master_index(posts: DataFrame, path: str, source_site: str) -> None:
    """Summary entries newest first under ``posts``, header under ``header``. Totals count what is archived."""
    entries = master_entry(posts)
    newest_first(entries).write.json(f"{path}/posts")
    header = stamp(count_posts(entries).withColumn("source_site", F.lit(source_site)), "archive_created", text=True)
    header.write.json(f"{path}/header")


def append_completed(results: DataFrame, path: str) -> None:
    """Append the successes to the log of the last snapshot; earlier rows are never rewritten and readers drop repeats."""
    last = completed_generation(results.sparkSession, path)
    rows = stamp(results.where("status = 'ok'").select("url"), "completed_at")
    rows.write.mode("append").parquet(f"{path}/log-{last}")


def compact_completed(spark: SparkSession, path: str) -> int:
    """Write a new snapshot of all completed URLs, each once with its first time, and return its number.

    A snapshot counts from the moment it is whole; one that broke off is overwritten by the next call, and until then readers
    keep to the one before. Appends and compactions of one log take turns. Folders of lower numbers are read no more and may be deleted.
    """
    last = completed_generation(spark, path)
    scan_completed(spark, path).write.mode("overwrite").parquet(f"{path}/snapshot-{last + 1}")
    return last + 1


def write_listing(lines: DataFrame, order: list, path: str) -> None:
    """Ordered text: part files follow each other in the given order."""
    lines.orderBy(*order).select("line").write.text(path)


def write_rewritten_links(pairs: DataFrame, path: str, before: str = "content", after: str = "rewritten") -> None:
    """Write only the documents whose text changed, with the new text.

    ``pairs`` carries both texts in one row, as ``rewrite_links(..., into=...)`` gives them.
    """
    changed(pairs, before, after).drop(before).withColumnRenamed(after, before).write.mode("overwrite").parquet(path)


def update_archive(pairs: DataFrame, path: str, before: str = "content", after: str = "rewritten", key: str = "url") -> None:
    """Put the changed texts of ``pairs`` into the archive that :func:`write_posts` wrote to ``path``.

    Only the month partitions that hold a changed document are written again, with their other rows as they were; the files of all other
    partitions stay. A row is changed when key and text are those of ``pairs``, which may have been read from the archive itself; rows that
    repeat both change alike. A dynamic overwrite keeps its files aside until all of them are written, so no file is read after it was replaced.
    """
    spark = pairs.sparkSession
    month = ["year", "month"]
    found = changed(pairs, before, after).select(F.col(key).alias("_key"), F.col(before).alias("_old"), F.col(after).alias("_new"))
    found = found.where("_key IS NOT NULL").select("_key", F.xxhash64("_old").alias("_hash"), "_new")
    # Written as they come: rows that repeat meet where the texts move to the rows of the archive.
    texts = materialise(found, "new-texts", compression="zstd")
    new = texts.groupBy("_key", "_hash").agg(F.min("_new").alias("_new"))
    archive = spark.read.parquet(path)
    keyed = archive.withColumns({"_key": F.col(key), "_hash": F.xxhash64(before)})
    # Months are found on narrow columns; there are few, and a partition filter made of them prunes the read.
    months = keyed.select("_key", "_hash", *month).join(texts.select("_key", "_hash"), ["_key", "_hash"], "left_semi").select(*month).distinct()
    months = materialise(months, "changed-months")
    rows = keyed.join(months, month, "left_semi").join(new.hint("merge"), ["_key", "_hash"], "left")  # texts unpack to many times their files
    rows = rows.withColumn(before, F.coalesce("_new", before)).select(*archive.columns).hint("rebalance", *month)
    with shuffles_freed(spark):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*month).parquet(path, compression="zstd")
