"""Queries over whole flows, written tables and streams."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from folioworks.functions import text as X
from folioworks.operators import extract as E
from folioworks.operators import render as R
from folioworks.plans import archive
from folioworks.plans import views as V
from folioworks.plans.links_catalog import LOOKED_UP, MD_TEXT, md_map
from folioworks.plans.pages_catalog import H1, LINKS, TITLE
from folioworks.plans.posts_catalog import (
    INDEX_LINE,
    POST_TEXT,
    SITE_TEXT,
    rel_sql,
)
from folioworks.plans.registry import Tables, query
from folioworks.plans.views import AUTHOR, LINKED, MANIFEST, POSTS, SITE
from folioworks.session import fresh_path
from folioworks.operators import links as L
from folioworks.sources import readers, writers
from folioworks.streaming import incremental as S

# ---- flows


@query(
    f"""WITH {V.INDEX_LINKS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY page_id, pos) AS rn FROM index_links)
    SELECT '{SITE.base_url}' || path AS url, path, title, page_id, pos FROM ranked WHERE rn = 1"""
)
def manifest_build(t):
    """Index pages to manifest: section, internal, well-formed, first seen."""
    good, _ = archive.build_manifest(V.index_pages(t), SITE, "Entries by Title")
    return good.withColumn("pos", F.col("pos").cast("bigint"))


@query("SELECT doc_id AS page_id, 0 AS pos, '/blog/NaN/NaN/NaN/x.html' AS href FROM documents")
def manifest_rejects(t):
    _, bad = archive.build_manifest(V.index_pages(t), SITE, "Entries by Title")
    return bad.withColumn("pos", F.col("pos").cast("bigint"))


DONE_LINES = MD_TEXT.format(LOOKED_UP)


@query(f"WITH {LINKED}, {V.extracted_sql(DONE_LINES)} SELECT url, file_path, {SITE_TEXT} AS markdown FROM extracted WHERE doc_id % 3 <> 0")
def site_archive(t):
    """Pages not completed -> records -> front-matter Markdown -> links rewritten."""
    pages = V.blog_pages(t, V.linked(t))
    return archive.site_archive(pages, V.manifest(t), V.completed(t), SITE, AUTHOR).files


@contextmanager
def bucketed(spark, **tables):
    """Tables of the session that are bucketed by ``url`` alike, for as long as the block lasts; their files stay."""
    names = {key: f"{key}_{uuid.uuid4().hex[:12]}" for key in tables}
    for key, df in tables.items():
        writers.write_bucketed(df, names[key], fresh_path(spark, key), buckets=BUCKETS)
    try:
        yield {key: spark.table(name) for key, name in names.items()}
    finally:
        for name in names.values():
            spark.sql(f"DROP TABLE {name}")


BUCKETS = 32


@query(f"WITH {LINKED}, {V.extracted_sql(DONE_LINES)} SELECT url, file_path, {SITE_TEXT} AS markdown FROM extracted WHERE doc_id % 3 <> 0")
def site_archive_bucketed(t):
    """The same flow over bucketed tables: no page source moves before it is read into a record."""
    with bucketed(t.spark, pages=V.blog_pages(t, V.linked(t)), manifest=V.manifest(t), completed=V.completed(t)) as b:
        return archive.site_archive(b["pages"], b["manifest"], b["completed"], SITE, AUTHOR).files


@query(f"WITH {LINKED}, {V.extracted_sql('content')} SELECT url, title, date, file_path, comments_count FROM extracted")
def site_archive_runs(t):
    """A run over half of the manifest, its successes appended, then a run over the rest: the index covers both.

    Every page comes a second time, empty and with a later number, which gives no record.
    """
    done = fresh_path(t.spark, "completed")
    manifest, pages = V.manifest(t), V.blog_pages(t)
    again = pages.withColumns({"page_id": F.col("page_id") + 1_000_000_000_000, "html": F.lit("<html></html>")})
    pages = pages.unionByName(again)
    one = archive.site_archive(pages, manifest.where("pos % 2 = 0"), readers.scan_completed(t.spark, done), SITE, AUTHOR)
    writers.append_completed(one.outcomes, done)
    two = archive.site_archive(pages, manifest, readers.scan_completed(t.spark, done), SITE, AUTHOR, earlier=one.entries)
    return two.entries.select("url", "title", "date", "file_path", "comments_count")


def stored(t: Tables):
    """Linked posts as stored records with a page source."""
    return V.linked(t).drop("archive_path", "month").withColumn("raw_html", F.col("content"))


NEAR = rel_sql("goal_archive || '/content.md'", "archive_path || '/content.md'", "linked", "*")
NEAR_LINES = MD_TEXT.format("CASE WHEN doc_id % 12 = 0 THEN link ELSE rel || frag END")


@query(
    f"""WITH {LINKED}, {NEAR}, moved AS (SELECT * REPLACE ({NEAR_LINES} AS content) FROM rel)
    SELECT url, archive_path, {POST_TEXT} AS markdown FROM moved"""
)
def local_archive_markdown(t):
    """Stored records -> numbered-comment Markdown with links relative to each post's directory."""
    return archive.local_archive(stored(t), SITE, "Archive").markdown.select("url", "archive_path", "markdown")


@query(f"WITH {POSTS} SELECT title, url, author, date, array_to_string(categories, '|') AS categories, comments_count, archive_path FROM posts")
def local_archive_index(t):
    got = archive.local_archive(stored(t), SITE, "Archive").master_index
    return got.withColumn("categories", F.array_join("categories", "|"))


@query(
    f"""WITH {POSTS} SELECT place, month, count(*) AS n FROM (
      SELECT 1 AS place, month FROM posts WHERE month IS NOT NULL UNION ALL
      SELECT DISTINCT 1, month FROM posts WHERE month IS NOT NULL UNION ALL SELECT 0, '' UNION ALL SELECT 2, '') GROUP BY 1, 2"""
)
def month_page_rows(t):
    page = archive.local_archive(stored(t), SITE, "Archive").month_page
    return page.groupBy("place", "month").agg(F.count(F.lit(1)).alias("n"))


SIGNED = "len(list_filter(comments, lambda c: c.author <> ''))"
PARSED = f"""parsed AS (SELECT * REPLACE (CASE WHEN title = '' THEN 'Untitled' ELSE title END AS title,
  CASE WHEN doc_id % 50 = 0 OR doc_id % 13 = 0 THEN '' ELSE iso END AS date, {SIGNED} AS comments_count) FROM posts)"""


@query(
    f"""WITH {POSTS}, {PARSED} SELECT 1 AS part, date, url, {INDEX_LINE} AS line FROM parsed UNION ALL
    SELECT 0, '', '', '---' || chr(10) || 'title: Archive' || chr(10) || 'layout: home' || chr(10) || '---' || chr(10) || chr(10) ||
    'This archive preserves ' || count(*) || ' posts and their comments.' || chr(10) FROM parsed"""
)
def rebuild_index(t):
    """Index page from the rendered corpus alone."""
    files = R.render_site_markdown(V.posts(t), AUTHOR, "text").select("file_path", "text")
    return archive.rebuild_index(files, AUTHOR, "Archive").orderBy("part", F.desc("date"), "url")


# ---- written tables, read back


@query(f"WITH {MANIFEST} SELECT pos, url, path, title, (SELECT count(*) FROM manifest) AS total, true AS dated FROM manifest")
def manifest_table(t):
    path = fresh_path(t.spark, "manifest")
    writers.write_manifest(V.manifest(t), path, SITE.base_url)
    header = t.spark.read.schema("total_posts bigint, extraction_date string").json(f"{path}/header")
    dated = header.select(F.col("extraction_date").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$")).scalar()
    rows = readers.scan_manifest_rows(t.spark, path)
    return rows.withColumn("total", header.select("total_posts").scalar()).withColumn("dated", dated)


@query(
    f"""WITH {POSTS} SELECT url, title, len(comments)::BIGINT AS n_comments, CASE WHEN doc_id % 50 = 0 THEN 0 ELSE year(day) END AS year,
    CASE WHEN doc_id % 50 = 0 THEN 0 ELSE month(day) END AS month FROM posts"""
)
def post_table(t):
    path = fresh_path(t.spark, "posts")
    writers.write_posts(V.posts(t).drop("month"), path)
    return readers.scan_posts(t.spark, path).select(
        "url", "title", F.size("comments").cast("bigint").alias("n_comments"),
        F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"),
    )


@query(f"WITH {POSTS} SELECT url, md5(content) AS digest FROM posts")
def raw_html_table(t):
    path = fresh_path(t.spark, "raw")
    writers.write_raw_html(V.posts(t).withColumnRenamed("content", "raw_html"), path)
    return t.spark.read.parquet(path).select("url", F.md5("raw_html").alias("digest"))


@query(f"WITH {POSTS} SELECT file_path AS place, md5({SITE_TEXT}) AS digest FROM posts UNION ALL SELECT archive_path, md5({POST_TEXT}) FROM posts")
def markdown_tables(t):
    site, post = fresh_path(t.spark, "site-md"), fresh_path(t.spark, "post-md")
    writers.write_site_markdown(R.render_site_markdown(V.posts(t), AUTHOR), site)
    writers.write_post_markdown(R.render_post_markdown(V.posts(t)), post)
    one = t.spark.read.parquet(site).select(F.col("file_path").alias("place"), F.md5("markdown").alias("digest"))
    return one.unionByName(
        t.spark.read.parquet(post).select(F.col("archive_path").alias("place"), F.md5("markdown").alias("digest"))
    )


@query(f"WITH {POSTS} SELECT url, archive_path AS folder FROM posts")
def archive_folders(t):
    """Folder of a record from the place of its file."""
    place = F.concat(F.lit("file:/store/site_archive/"), "archive_path", F.lit("/data.json"))
    return V.posts(t).select("url", readers.archive_relative_dir(place, "/store/site_archive").alias("folder"))


@query(
    f"""WITH {POSTS} SELECT archive_path, url, title, array_to_string(categories, '|') AS categories, comments_count,
    len(comments)::BIGINT AS n_comments, md5(content) AS digest FROM posts"""
)
def post_files(t):
    """One ``data.json`` per post, categories as objects, read back from the tree of files."""
    root = fresh_path(t.spark, "post-files")
    full = R.render_post_markdown(V.posts(t)).withColumn("raw_html", F.col("content"))
    full = full.withColumn("categories", F.transform("categories", lambda c: F.struct(c.alias("name"))))
    writers.export_archive(full, root)
    good, _ = readers.scan_post_archive(t.spark, root)
    return good.select(
        "archive_path", "url", "title", F.array_join("categories", "|").alias("categories"), "comments_count",
        F.size("comments").cast("bigint").alias("n_comments"), F.md5("content").alias("digest"),
    )


@query(f"WITH {POSTS} SELECT file_path, md5({SITE_TEXT}) AS digest FROM posts")
def markdown_files(t):
    """One Markdown file per post, read back from its folder."""
    root = fresh_path(t.spark, "site-files")
    writers.export_files(R.render_site_markdown(V.posts(t), AUTHOR), root)
    return readers.scan_markdown_posts(t.spark, f"{root}/_posts").select("file_path", F.md5("text").alias("digest"))


FILE_ID = "('0x' || substr(sha256('p' || page_id || '.html'), 1, 15))::BIGINT"


@query(
    f"""WITH {V.INDEX_LINKS}, saved AS (SELECT * REPLACE ({FILE_ID} AS page_id) FROM index_links),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY page_id, pos) AS rn FROM saved)
    SELECT '{SITE.base_url}' || path AS url, path, title, page_id, pos FROM ranked WHERE rn = 1"""
)
def manifest_from_files(t):
    """Index pages saved as files, read back with their numbers, to manifest."""
    root = fresh_path(t.spark, "saved-pages")
    saved = V.index_pages(t).select(F.format_string("p%d.html", "page_id").alias("file_path"), F.col("html").alias("markdown"))
    writers.export_files(saved, root)
    pages = readers.scan_page_files(t.spark, root, base_url=SITE.base_url + "/index")
    good, _ = archive.build_manifest(pages, SITE, "Entries by Title")
    return good.withColumn("pos", F.col("pos").cast("bigint"))


@query(f"WITH {MANIFEST} SELECT row_number() OVER (ORDER BY pos) - 1 AS pos, url, path, title FROM manifest")
def manifest_document(t):
    """One JSON document with a header and a nested list, its posts in order, read by several tasks."""
    path = fresh_path(t.spark, "manifest-document")
    writers.write_manifest_document(V.manifest(t), path, SITE.base_url)
    return readers.scan_manifest_split(t.spark, f"{path}/manifest.json")


@query(f"WITH {POSTS} SELECT title, url, date, comments_count, archive_path, (SELECT count(*) FROM posts) AS total FROM posts")
def master_index_table(t):
    path = fresh_path(t.spark, "master")
    writers.write_master_index(V.posts(t), path, SITE.base_url)
    total = t.spark.read.schema("total_posts bigint").json(f"{path}/header").select("total_posts").scalar()
    shape = "title string, url string, date string, comments_count bigint, archive_path string"
    return t.spark.read.schema(shape).json(f"{path}/posts").withColumn("total", total)


@query(f"WITH {POSTS} SELECT url FROM posts WHERE doc_id % 4 <> 0")
def completed_table(t):
    """Two runs append their successes; the reader gives each URL once."""
    path = fresh_path(t.spark, "completed")
    status = F.when(F.col("doc_id") % 4 == 0, "failed").otherwise("ok")
    results = V.post_dates(t).select("url", status.alias("status"), "doc_id")
    nothing = readers.scan_completed(t.spark, path)
    writers.append_completed(results.where("doc_id % 2 = 1").join(nothing, "url", "left_anti"), path)
    writers.append_completed(results, path)
    return readers.scan_completed(t.spark, path).select("url")


@query(f"WITH {POSTS} SELECT url, doc_id % 3 <> 2 AS in_snapshot FROM posts")
def completed_snapshots(t):
    """Appends with two compactions between them; the last snapshot holds what was appended before it."""
    path = fresh_path(t.spark, "completed")
    results = V.post_dates(t).select("url", F.lit("ok").alias("status"), (F.col("doc_id") % 3).alias("part"))
    for part in (0, 1):
        writers.append_completed(results.where(F.col("part") <= part), path)
        last = writers.compact_completed(t.spark, path)
    writers.append_completed(results.where("part = 2"), path)
    held = t.spark.read.parquet(f"{path}/snapshot-{last}").select("url", F.lit(True).alias("held"))
    rows = readers.scan_completed(t.spark, path).join(held, "url", "left")
    return rows.select("url", F.coalesce("held", F.lit(False)).alias("in_snapshot"))


@query(
    f"""WITH {POSTS}, l AS (SELECT {INDEX_LINE} AS line FROM posts UNION ALL SELECT unnest(['---', 'title: Archive', 'layout: home', '---', '',
    'This archive preserves ' || (SELECT count(*) FROM posts) || ' posts and their comments.', ''])) SELECT line, count(*) AS n FROM l GROUP BY 1"""
)
def listing_lines(t):
    path = fresh_path(t.spark, "listing")
    writers.write_listing(R.site_listing(R.index_entry(V.posts(t)), "Archive"), ["part", F.desc("date"), "url"], path)
    return t.spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {LINKED} SELECT url, md5({DONE_LINES}) AS digest FROM linked WHERE doc_id % 12 <> 0")
def rewritten_table(t):
    """Only the documents whose links changed are written."""
    path = fresh_path(t.spark, "rewritten")
    pairs = L.rewrite_markdown_links(V.linked(t), md_map(t), SITE, into="rewritten")
    writers.write_rewritten_links(pairs.select("url", "content", "rewritten"), path)
    return t.spark.read.parquet(path).select("url", F.md5("content").alias("digest"))


@query(f"WITH {LINKED} SELECT url, month, md5({DONE_LINES}) AS digest FROM linked")
def rewritten_archive(t):
    """The stored archive after its links were rewritten in place, all of it read back."""
    path = fresh_path(t.spark, "posts")
    writers.write_posts(V.linked(t).withColumnRenamed("month", "label"), path)
    pairs = L.rewrite_markdown_links(readers.scan_posts(t.spark, path), md_map(t), SITE, into="rewritten")
    writers.update_archive(pairs.select("url", "content", "rewritten"), path)
    return readers.scan_posts(t.spark, path).select("url", F.col("label").alias("month"), F.md5("content").alias("digest"))


# ---- streams


def page_titles(pages):
    got = E.select_html(pages, {"title": ("head title", "text"), "h1": ("article h1", "text")})
    return got.select(
        "page_id", "url", X.clean_text("title").alias("title"), X.clean_text("h1").alias("h1"),
        F.when(F.col("error").isNull(), "ok").otherwise("failed").alias("status"),
    )


@query(f"SELECT page_id, url, {TITLE} AS title, {H1} AS h1, 'ok' AS status FROM pages")
def stream_extract(t):
    """Two runs over the same folder; the second finds nothing new."""
    out, state = fresh_path(t.spark, "extract"), fresh_path(t.spark, "extract-state")
    for _ in range(2):
        pages = S.read_page_stream(t.spark, f"{t.folder}/pages.parquet")
        S.stream_extract(pages, out, state, extract=page_titles).awaitTermination()
    return t.spark.read.parquet(out).select("page_id", "url", "title", "h1", "status")


@query(f"SELECT page_id, url, {TITLE} AS title, {H1} AS h1, 'ok' AS status FROM pages")
def stream_extract_part_files(t):
    """A table of several part files in which every page comes twice, read one file a batch: each URL gives one record."""
    table, out, state = (fresh_path(t.spark, name) for name in ("page-parts", "extract", "extract-state"))
    t.pages.unionByName(t.pages).repartition(4, F.rand(1)).write.parquet(table)
    pages = S.read_page_stream(t.spark, table, files_per_batch=1)
    S.stream_extract(pages, out, state, extract=page_titles).awaitTermination()
    return t.spark.read.parquet(out).select("page_id", "url", "title", "h1", "status")


@query(
    f"""WITH {LINKS} SELECT href AS url, page_id, pos FROM
    (SELECT *, row_number() OVER (PARTITION BY href ORDER BY page_id, pos) AS rn FROM links) WHERE rn = 1"""
)
def stream_dedupe(t):
    out, state = fresh_path(t.spark, "dedupe"), fresh_path(t.spark, "dedupe-state")
    found = E.extract_links(S.read_page_stream(t.spark, f"{t.folder}/pages.parquet"))
    links = found.select(F.col("href").alias("url"), "page_id", F.col("pos").cast("bigint").alias("pos"))
    S.stream_dedupe(links, out, state).awaitTermination()
    return t.spark.read.parquet(out).select("url", "page_id", "pos")


@query(
    f"""WITH {LINKS} SELECT href AS url, page_id, pos FROM
    (SELECT *, row_number() OVER (PARTITION BY href ORDER BY page_id % 4, page_id, pos) AS rn FROM links) WHERE rn = 1"""
)
def stream_dedupe_runs(t):
    """A folder that grows by a part before every run of the stream, beside a table of a similar name; the last run finds nothing new."""
    table, out, state = (fresh_path(t.spark, name) for name in ("link-parts", "dedupe", "dedupe-state"))
    found = E.extract_links(t.pages).select(F.col("href").alias("url"), "page_id", F.col("pos").cast("bigint").alias("pos"))
    found.select("url", F.lit(-1).cast("bigint").alias("page_id"), "pos").write.parquet(f"{table}_old")
    for part in (0, 1, 2, 3, None):
        if part is not None:
            found.where(F.col("page_id") % 4 == part).write.mode("append").parquet(table)
        links = S.read_page_stream(t.spark, table, "url string, page_id bigint, pos bigint")
        S.stream_dedupe(links, out, state).awaitTermination()
    return t.spark.read.parquet(out).select("url", "page_id", "pos")


EVENT_STATUS = "SELECT CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status, count(*) AS n FROM events GROUP BY 1"


@query(EVENT_STATUS)
def stream_totals(t):
    """Running totals of a table that arrives in two parts, kept by an update-mode aggregate."""
    table, out, state = (fresh_path(t.spark, name) for name in ("event-parts", "totals", "totals-state"))
    status = F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("status")
    for part in (0, 1):
        t.events.where(F.col("event_id") % 2 == part).write.mode("append").parquet(table)
        events = S.read_page_stream(t.spark, table, t.events.schema)
        S.stream_totals(events.select(status), out, state).awaitTermination()
    return S.read_totals(t.spark, out)


@query(EVENT_STATUS)
def stream_progress(t):
    out, state = fresh_path(t.spark, "progress"), fresh_path(t.spark, "progress-state")
    events = S.read_page_stream(t.spark, f"{t.folder}/events.parquet", t.events.schema)
    status = F.when(F.col("event_type") == "error", "error").otherwise("ok")
    S.stream_progress(events.select(status.alias("status")), out, state).awaitTermination()
    return S.read_progress(t.spark, out)
