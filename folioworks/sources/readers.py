"""Readers. Files are listed and parsed by Spark; nothing is read on the driver."""

from __future__ import annotations

import os
import re
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioworks.functions.text import col_
from folioworks.operators.windows import prefix_scan
from folioworks.session import materialise, qualified

MANIFEST_SCHEMA = (
    "extraction_date string, total_posts bigint, source_url string, "
    "posts array<struct<url: string, path: string, title: string>>"
)
COMMENT = "struct<id: string, author: string, date: string, content: string, content_html: string>"
POST_SCHEMA = (
    "post_id string, url string, title string, author string, date string, content string, content_html string, "
    f"categories array<string>, comments_count bigint, comments array<{COMMENT}>, extracted_at string, raw_html string"
)


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages as ``(page_id, url, html)``."""
    return spark.read.parquet(path)


def packed(files: DataFrame, per_task: int = 1000) -> DataFrame:
    """A scan of small files with up to about ``per_task`` of them in a task, none left out.

    Spark reckons every file as ``spark.sql.files.openCostInBytes``, so it gives a task a few small files only; each of these tasks costs more
    than its files and, before a shuffle, leaves a block for every task behind it. Files of that size or more stay as dealt.
    """
    spark = files.sparkSession
    most, least = (
        spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(f"spark.sql.files.{name}"))
        for name in ("maxPartitionBytes", "openCostInBytes")
    )
    parts = files.rdd.getNumPartitions()
    wanted = max(2 * spark.sparkContext.defaultParallelism, -(-parts * max(most // max(least, 1), 1) // per_task))
    return files.coalesce(wanted) if wanted < parts else files


# Rows and bytes of a batch of files, directories dealt out at least before tasks walk them, files read by a task.
BATCH_FILES, BATCH_BYTES, DEALT, FILES_PER_TASK = 500, 4 << 20, 256, 1000
# What Java leaves as it is in the path of a URI; other ASCII characters are escaped.
ESCAPED = re.compile(r"[\x00-\x7f]")
PLAIN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_.!~*'():@&=+$,;/")


def _escaped(path: str) -> str:
    return ESCAPED.sub(lambda m: m[0] if m[0] in PLAIN else f"%{ord(m[0]):02X}", path)


def _store(root: str) -> tuple[pafs.FileSystem, str]:
    return (pafs.LocalFileSystem(), root) if root.startswith("/") else pafs.FileSystem.from_uri(root)


def _is_folder(root: str) -> bool:
    """Whether Arrow knows the store and finds a folder there."""
    try:
        store, top = _store(root)
        return store.get_file_info(top).type == pafs.FileType.Directory
    except (pa.ArrowException, OSError, ValueError):
        return False


def _hidden(name: str) -> bool:
    """Names that Spark leaves out of a listing."""
    return name.startswith(".") or name.endswith("._COPYING_") or name.startswith("_") and "=" not in name


def _entries(store: pafs.FileSystem, folder: str) -> Iterator[tuple[str, bool, int]]:
    if isinstance(store, pafs.LocalFileSystem):  # one entry at a time, however many there are
        with os.scandir(folder) as found:
            for e in found:
                yield e.name, e.is_dir(), 0 if e.is_dir() else e.stat().st_size
    else:
        for f in store.get_file_info(pafs.FileSelector(folder)):
            yield f.base_name, f.type == pafs.FileType.Directory, -1 if f.size is None else f.size


def _walked(root: str, folders: Iterable[str], name: str, most: int | None = None) -> Iterator[tuple[str, bool, int]]:
    """``(path below root, whether a folder, bytes)`` of all files whose name matches; with ``most`` the walk ends when so many folders wait,
    and gives these, too."""
    store, top = _store(root)
    wanted, waiting = re.compile(name, re.DOTALL), deque(folders)
    while waiting and (most is None or len(waiting) < most):
        folder = waiting.popleft()
        for entry, inner, size in _entries(store, f"{top}/{folder}".rstrip("/")):
            path = f"{folder}/{entry}" if folder else entry
            if inner and not _hidden(entry):
                waiting.append(path)
            elif not inner and wanted.fullmatch(entry) and not _hidden(entry):
                yield path, False, size
    yield from ((path, True, 0) for path in waiting)


LISTED = "below string, folder boolean, size bigint"


def _batches(rows: Iterable[tuple[str, bool, int]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[str, bool, int]] = []

    def made() -> pa.RecordBatch:
        kinds = (pa.string(), pa.bool_(), pa.int64())
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), kinds)], ["below", "folder", "size"])

    for row in rows:
        held.append(row)
        if len(held) == 10_000:
            yield made()
            held.clear()
    if held:
        yield made()


def listed_files(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``(below, size)`` of all files below ``root`` whose name matches the pattern, written to the shared folder.

    One task walks the first levels until there are folders to deal out, then many tasks walk those. No list of files is held in memory.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            yield from _batches(_walked(root, [""], name, DEALT))

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _batches(_walked(root, batch.column("below").to_pylist(), name))

    begun = materialise(spark.range(0, 1, 1, 1).mapInArrow(first, LISTED), "file-list-begun")
    dealt = begun.where("folder").select("below").repartition(4 * spark.sparkContext.defaultParallelism, F.xxhash64("below"))
    found = begun.where("not folder").unionByName(dealt.mapInArrow(rest, LISTED))
    return materialise(found.select("below", "size"), "file-list")


def whole_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Every file below a folder whose name matches ``glob``: ``(file, value)``, the file as Spark names it in ``_metadata.file_path`` and its text.

    Files are listed and read by tasks, some thousand small ones each: Spark's own list lies in the driver's memory, about a kilobyte a
    file, and its readers take milliseconds to open one. A store that Arrow does not know, or a path that is no folder, is left to Spark.
    """
    root = qualified(spark, path).rstrip("/") or "/"
    if not _is_folder(root):
        files = packed(spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob))
        return files.select(F.col("_metadata.file_path").alias("file"), "value")
    found = listed_files(spark, root, spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern())
    found = found.where("size <> 0")  # Spark reads no empty file
    n, size = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-n // FILES_PER_TASK), -(-size // most))
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    top_uri = ("file:" + _escaped(root) if root.startswith("/") else where.toUri().toString()).rstrip("/")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _store(root)
        names: list[str] = []
        texts: list[bytes] = []

        def made() -> pa.RecordBatch:
            # Bytes that are no UTF-8 pass as they are, as Spark's reader lets them.
            values = pa.array(texts, pa.binary()).cast(pa.string(), safe=False)
            return pa.record_batch([pa.array(names, pa.string()), values], ["file", "value"])

        held = 0
        for batch in batches:
            for below in batch.column("below").to_pylist():
                with store.open_input_stream(f"{top.rstrip('/')}/{below}") as stream:
                    texts.append(stream.read())
                names.append(f"{top_uri}/{_escaped(below)}")
                held += len(texts[-1])
                if held >= BATCH_BYTES or len(names) == BATCH_FILES:
                    yield made()
                    held = names.clear() or texts.clear() or 0
        if names:
            yield made()

    return found.select("below").repartition(tasks, F.xxhash64("below")).mapInArrow(read, "file string, value string")


def scan_page_files(spark: SparkSession, path: str, glob: str = "*.html", base_url: str | None = None) -> DataFrame:
    """Saved pages, one file per page: ``(page_id, url, html)``.

    The URL is the path below the folder after ``base_url``, or the file's full path without it. ``page_id`` is taken from a digest
    of the path below the folder, so a page keeps its number when others come or the folder moves, and no page source
    leaves its task. Two of 10^8 pages share one of the 60-bit numbers with a chance below 1 %; the flows know a
    page by its URL as well, so such a pair stays two pages.
    """
    top = qualified(spark, path).rstrip("/") + "/"
    place = F.url_decode(F.regexp_replace(F.col("file"), r"\+", "%2B"))
    below = F.substring(place, F.locate(top, place) + F.lit(len(top)), F.length(place))
    files = whole_files(spark, path, glob).select(F.col("file").alias("_file"), below.alias("_below"), F.col("value").alias("html"))
    number = F.conv(F.substring(F.sha2("_below", 256), 1, 15), 16, 10).cast("bigint")
    url = F.concat(F.lit(base_url.rstrip("/") + "/"), "_below") if base_url else F.col("_file")
    return files.select(number.alias("page_id"), url.alias("url"), "html")


SPREAD = "spark.folioworks.spread"


def spread(df: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """Deal ``df`` by ``key`` into as many parts as the caller asks for, here or in the setting ``spark.folioworks.spread``.

    Without either the input stays as it is. The setting is for inputs of few row groups, whose pages a single task would parse.
    """
    parts = parts or int(df.sparkSession.conf.get(SPREAD, "0"))
    # Hashed by another function than joins use, else an earlier join on the key absorbs the step and is coalesced.
    return df.repartition(parts, F.xxhash64(key)) if parts else df


def scan_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest posts with their place: ``(pos, url, path, title)``.

    Reads JSON documents with a header and one nested list of any shape, each document in one task. For large ones see
    :func:`scan_manifest_split`, for the row form :func:`scan_manifest_rows`.
    """
    nested = spark.read.schema(MANIFEST_SCHEMA).json(path, multiLine=True)
    return nested.select(F.posexplode("posts").alias("pos", "p")).select("pos", "p.*")


POST_OPENS = r'(?s)(?:^\s*,|"posts"\s*:\s*\[)\s*(\{.*)'


def scan_manifest_split(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`scan_manifest` for large documents: each is cut at its closing braces and read by many tasks.

    Spark splits a text at a one-byte separator wherever a task's range of the file begins. A brace closes a post if an even number of
    quotes stands before it in the document; the pieces of a post with braces in its strings are put together again.
    Posts must be flat objects in the last list of the header; anything else ends the job.
    """
    piece = F.col("value")
    rows = spark.read.text(path, lineSep="}").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),  # rises along a block, which lies in one task
        piece.alias("piece"),
        F.regexp_count(F.regexp_replace(piece, r"\\.", ""), F.lit('"')).alias("quotes"),
    )
    scan = {"group": ["file"], "order": ["place"], "bucket": F.col("block")}
    quoted = prefix_scan(rows, **scan, sums={"before": F.col("quotes")}, position="_n")
    closes = quoted.withColumn("closes", (F.col("before") % 2 == 0).cast("int")).drop("_n", "before", "quotes")
    placed = prefix_scan(closes, **scan, sums={"upto": F.col("closes")}, position="_n")
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("_n", "piece"))), lambda p: p["piece"])
    whole = placed.groupBy("file", (F.col("upto") - F.col("closes")).alias("pos")).agg(F.array_join(pieces, "}").alias("text"))
    post = F.concat(F.regexp_extract("text", POST_OPENS, 1), F.lit("}"))
    posts = whole.where(F.col("text").rlike(POST_OPENS)).select("pos", F.from_json(post, "url string, path string, title string", {"mode": "FAILFAST"}).alias("p"))
    return posts.select("pos", "p.*")


def scan_manifest_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("pos bigint, url string, path string, title string").json(f"{path}/posts")


def archive_relative_dir(path: Column | str, root: str) -> Column:
    """Directory of a file relative to the archive root."""
    tail = F.substring_index(col_(path), "/" + root.rstrip("/").rsplit("/", 1)[-1] + "/", -1)
    return F.regexp_replace(tail, r"/?[^/]*$", "")


def category_name(c: Column) -> Column:
    named = F.when(F.startswith(c, F.lit("{")), F.get_json_object(c, "$.name"))
    return F.coalesce(named, c)


def scan_post_archive(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(post records with ``archive_path``, unreadable files) of a tree of ``data.json`` files.

    A category may be a string or an object, of which the name counts; an object without one stays as its text.
    """
    files = whole_files(spark, root, "data.json").select(archive_relative_dir("file", root).alias("archive_path"), F.col("value").alias("source"))
    shape = POST_SCHEMA + ", _corrupt_record string"
    raw = files.withColumn("r", F.from_json("source", shape, {"mode": "PERMISSIVE"})).select("archive_path", "source", "r.*")
    good = F.col("_corrupt_record").isNull()
    posts = raw.where(good).drop("_corrupt_record", "source")
    posts = posts.withColumns({
        "categories": F.transform(F.coalesce("categories", F.array().cast("array<string>")), category_name),
        "comments": F.coalesce("comments", F.array().cast(f"array<{COMMENT}>")),
        "comments_count": F.coalesce("comments_count", F.lit(0)).cast("bigint"),
        **{c: F.coalesce(c, F.lit("")) for c in ("url", "title", "author", "date", "content", "content_html", "raw_html")},
    })
    return posts, raw.where(~good).select("archive_path", "source")


def scan_posts(spark: SparkSession, path: str) -> DataFrame:
    """Post records from the columnar archive."""
    return spark.read.parquet(path)


def scan_markdown_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Markdown files of one directory: ``(file_path, text)``, the path as ``<folder name>/<file>``."""
    name = folder.rstrip("/").rsplit("/", 1)[-1]
    return packed(spark.read.text(folder, wholetext=True, pathGlobFilter="*.md")).select(
        F.concat(F.lit(name + "/"), F.url_decode(F.regexp_replace(F.col("_metadata.file_name"), r"\+", "%2B"))).alias("file_path"),
        F.col("value").alias("text"),
    )


COMPLETED_SCHEMA = "url string, completed_at timestamp"


def completed_generation(spark: SparkSession, path: str) -> int:
    """Number of the last whole snapshot of a completed log, 0 before the first. Only folder names are listed."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/snapshot-*/_SUCCESS")
    found = done.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(done) or []
    return max((int(f.getPath().getParent().getName().rsplit("-", 1)[-1]) for f in found), default=0)


def _rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_completed(spark: SparkSession, path: str) -> DataFrame:
    """Completed URLs, each once; empty when nothing was written yet.

    Reads the last snapshot (see ``compact_completed``) and what was appended since, however many appends came before.
    """
    last = completed_generation(spark, path)
    rows = _rows(spark, f"{path}/log-{last}", COMPLETED_SCHEMA)
    if last:
        rows = rows.unionByName(_rows(spark, f"{path}/snapshot-{last}", COMPLETED_SCHEMA))
    return rows.groupBy("url").agg(F.min("completed_at").alias("completed_at"))
