"""The four flows from pages to archive, each a chain of operators over whole tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioworks.functions.urls import Site, post_archive_path, post_file_path
from folioworks.operators import render as R
from folioworks.operators.aggregates import archive_month, comment_counts_in_text
from folioworks.operators.extract import POST_SELECTORS, extract_links, extract_posts, split_outcome
from folioworks.operators.filters import dated_only, internal_links, split_malformed
from folioworks.operators.frontmatter import parse_front_matter
from folioworks.operators.joins import remaining, url_map
from folioworks.operators.links import rewrite_html_links, rewrite_markdown_links
from folioworks.operators.ordering import newest_first
from folioworks.operators.windows import first_seen
from folioworks.session import materialise


def build_manifest(pages: DataFrame, site: Site, section: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(manifest, rejects) of index pages: internal, well-formed, first-seen links.

    The manifest is ``(url, path, title, page_id, pos)``; ``page_id, pos`` is its order.
    """
    good, bad = split_malformed(internal_links(extract_links(pages, section), site.section))
    rows = good.select(F.col("target").alias("url"), F.col("href").alias("path"), "title", "page_id", "pos")
    return first_seen(rows, "url", ["page_id", "pos"]), bad.select("page_id", "pos", "href")


@dataclass(frozen=True)
class SiteArchive:
    """What one run of the site flow gives: files and failures of this run, index entries of the whole archive, and
    ``(url, status)`` of every page read, to be appended to the completed URLs."""

    files: DataFrame
    entries: DataFrame
    failures: DataFrame
    outcomes: DataFrame


def wanted_pages(pages: DataFrame, manifest: DataFrame, completed: DataFrame) -> DataFrame:
    """The page of each URL of the manifest that is not completed: the one with the least ``page_id``, which is unique, or without any.

    Which pages these are is found on ``url`` and ``page_id`` alone; page sources go through one semi-join. Where pages, manifest and completed
    URLs are tables bucketed by ``url`` alike (see ``write_bucketed``), that join and those before it move nothing.
    """
    urls = remaining(manifest.select("url").distinct(), completed)
    first = pages.select("url", "page_id").join(urls, "url", "left_semi").groupBy("url").agg(F.min("page_id").alias("_page"))
    first = first.withColumnRenamed("url", "_url")
    # Written so that the URL is the only join key: a key of two columns would not fit the buckets.
    other = F.coalesce(F.col("page_id").bitwiseXOR(F.col("_page")), F.when(F.col("_page").isNotNull(), 1).otherwise(0))
    return pages.join(first, (F.col("url") == F.col("_url")) & (other == 0), "left_semi")


def site_archive(
    pages: DataFrame,
    manifest: DataFrame,
    completed: DataFrame,
    site: Site,
    default_author: str,
    selectors: Mapping = POST_SELECTORS,
    domains: tuple[str, str] | None = None,
    earlier: DataFrame | None = None,
) -> SiteArchive:
    """Read the pages of the manifest that are not completed into linked Markdown files.

    Completed pages are left out before the parse. The records are written once to the shared folder,
    since files, entries and failures all read them. Links resolve against the whole manifest. Of several pages with
    one URL the one that :func:`wanted_pages` takes is read. ``earlier`` holds the entries of former runs;
    an entry of this run takes the place of an earlier one with its URL.
    """
    records = materialise(extract_posts(wanted_pages(pages, manifest, completed), selectors, domains).drop("raw_html"), "records")
    ok, failures = split_outcome(records)
    posts = ok.withColumn("file_path", post_file_path("url", site))
    paths = url_map(manifest.select("url"), file_path=post_file_path("url", site))
    text = R.render_site_markdown(posts, default_author).select("url", "file_path", "markdown")
    files = rewrite_markdown_links(text, paths, site, text="markdown")
    entries = R.index_entry(posts)
    if earlier is not None:
        entries = entries.unionByName(earlier.join(entries.select("url"), "url", "left_anti"))
    return SiteArchive(files, entries, failures, records.select("url", "status"))


@dataclass(frozen=True)
class LocalArchive:
    """Rewritten texts and indexes of the directory-per-post archive."""

    markdown: DataFrame
    html: DataFrame
    master_index: DataFrame
    month_page: DataFrame


def local_archive(posts: DataFrame, site: Site, title: str) -> LocalArchive:
    """Post-pass over stored records (with ``raw_html``): rewrite links in both forms, build both indexes."""
    placed = posts.withColumn("archive_path", post_archive_path("url", site))
    md, html = (F.concat("archive_path", F.lit(name)) for name in ("/content.md", "/raw.html"))
    md_map, html_map = (url_map(placed, path=p) for p in (md, html))
    text = R.render_post_markdown(placed).select("url", "archive_path", md.alias("path"), "markdown")
    page = placed.select("url", "archive_path", html.alias("path"), "raw_html")
    names = {"path": "path", "target_path": "path"}
    dated = dated_only(placed).withColumn("month", archive_month("archive_path")).where(
        F.col("month").rlike(r"^\d{4}-\d{2}$")
    )
    return LocalArchive(
        rewrite_markdown_links(text, md_map, site, text="markdown", **names),
        rewrite_html_links(page, html_map, site, text="raw_html", **names),
        newest_first(R.master_entry(placed)),
        R.month_page(dated, title),
    )


def rebuild_index(files: DataFrame, default_author: str, title: str, base: str = "/archive", intro: str = "") -> DataFrame:
    """Index page lines from a corpus of Markdown files ``(file_path, text)``."""
    posts = parse_front_matter(files, default_author).withColumnRenamed("original_url", "url")
    counts = comment_counts_in_text(files)
    return R.site_listing(posts.join(counts, "file_path"), title, intro, base)
