"""Queries over the manifest, the link graph, the processing log and the roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioworks.functions.text import regex_first
from folioworks.operators import aggregates as A
from folioworks.operators import filters as P
from folioworks.operators import joins as J
from folioworks.operators import links as L
from folioworks.operators import ordering as O
from folioworks.operators import postings as N
from folioworks.operators import qa as Q
from folioworks.operators import windows as W
from folioworks.plans import views as V
from folioworks.plans.posts_catalog import rel_sql
from folioworks.plans.registry import query
from folioworks.sources.readers import spread
from folioworks.plans.views import LINKED, LOG, MANIFEST, POSTS, SITE
from folioworks.session import fresh_path

REPLACED = "CASE WHEN doc_id % 12 = 0 THEN link ELSE {} || frag END"
LOOKED_UP = REPLACED.format("string_split(goal_file, '/')[2]")
MD_TEXT = "content || chr(10) || '[see](' || {} || ') and [out](http://other.example/blog/a.html) end'"


def md_map(t):
    return J.url_map(V.posts(t), file_path=F.col("file_path"))


# ---- manifest


@query(f"WITH {MANIFEST} SELECT pos, url, title FROM manifest WHERE url NOT IN (SELECT url FROM completed)")
def remaining_urls(t):
    return J.remaining(V.manifest(t), V.completed(t)).select("pos", "url", "title")


@query(f"WITH {MANIFEST} SELECT pos, url FROM manifest WHERE url NOT IN (SELECT url FROM completed) ORDER BY pos LIMIT 25")
def first_remaining(t):
    return O.take_first(J.remaining(V.manifest(t), V.completed(t)).select("pos", "url"), 25)


@query(f"WITH {MANIFEST} SELECT DISTINCT url FROM (SELECT url FROM completed UNION ALL SELECT url FROM manifest WHERE pos % 2 = 0)")
def completed_union(t):
    return J.merge_completed(V.completed(t), V.manifest(t).where("pos % 2 = 0"))


@query(
    f"""WITH {MANIFEST}, u AS (SELECT DISTINCT url FROM manifest)
    SELECT count(*) AS total_posts, count(c.url) AS completed_count, count(*) - count(c.url) AS remaining_count
    FROM u LEFT JOIN completed c ON u.url = c.url"""
)
def completion(t):
    return A.completion(V.manifest(t), V.completed(t))


@query(f"WITH {MANIFEST} SELECT url, min(pos) AS pos, min_by(path, pos) AS path, min_by(title, pos) AS title FROM manifest GROUP BY url")
def manifest_first_seen(t):
    return W.first_seen(V.manifest(t), "url", ["pos"])


# ---- links


@query(
    f"""WITH {LINKED} SELECT url AS src_url, 0 AS pos, 'see' AS anchor_text,
      replace(replace(link, 'http://www.', 'http://'), '#c1', '') AS target_url, true AS is_internal FROM linked UNION ALL
    SELECT url, 1, 'out', 'http://other.example/blog/a.html', false FROM linked"""
)
def link_edges(t):
    return L.link_edges(V.linked(t), SITE).withColumn("pos", F.col("pos").cast("bigint"))


@query(
    f"""WITH {LINKED} SELECT url, 0 AS pos, CASE WHEN doc_id % 12 <> 0 THEN goal_file END AS target_path FROM linked UNION ALL
    SELECT url, 1, NULL FROM linked"""
)
def resolved_links(t):
    edges = L.link_edges(V.linked(t), SITE).select(F.col("src_url").alias("src"), "pos", F.col("target_url").alias("url"))
    got = J.resolve_links(edges, md_map(t).withColumnRenamed("file_path", "target_path"))
    return got.select(F.col("src").alias("url"), F.col("pos").cast("bigint").alias("pos"), "target_path")


@query(
    f"""WITH {LINKED} SELECT url AS src_url, 0 AS pos, replace(link, '#c1', '') AS target_url
    FROM linked WHERE doc_id % 12 = 0"""
)
def broken_links(t):
    got = Q.broken_links(L.link_edges(V.linked(t), SITE), md_map(t))
    return got.select("src_url", F.col("pos").cast("bigint").alias("pos"), "target_url")


@query(f"WITH {LINKED} SELECT url, {MD_TEXT.format(LOOKED_UP)} AS content FROM linked")
def link_rewrite_md(t):
    return L.rewrite_markdown_links(V.linked(t), md_map(t), SITE).select("url", "content")


@query(f"WITH {LINKED} SELECT url, {MD_TEXT.format(LOOKED_UP)} AS content FROM linked")
def link_rewrite_repeats(t):
    """A map that holds a second, later path for every other URL: the least path counts, and no link takes its neighbour's."""
    paths = md_map(t)
    again = paths.where(F.xxhash64("url") % 2 == 0).withColumn("file_path", F.concat(F.lit("zzz/"), "file_path"))
    return L.rewrite_markdown_links(V.linked(t), again.unionByName(paths), SITE).select("url", "content")


HTML_KEEP = "url, content, link, frag, doc_id"


@query(
    f"""WITH {LINKED}, {rel_sql("goal_archive || '/raw.html'", "archive_path || '/raw.html'", "linked", HTML_KEEP)}
    SELECT url, content || chr(10) || '<a href="' || {REPLACED.format("rel")} || '">see</a> <a href="http://other.example/blog/a.html">out</a> end' AS content FROM rel"""
)
def link_rewrite_html(t):
    page = F.concat("archive_path", F.lit("/raw.html"))
    docs = V.linked(t, html=True).withColumn("here", page)
    paths = J.url_map(V.posts(t), there=page)
    return L.rewrite_html_links(docs, paths, SITE, path="here", target_path="there").select("url", "content")


QUOTED = "<a title=x HREF = {0}%1$s{0}>see</a> <a data-href={0}/blog/x.html{0} href={0}http://other.example/blog/a.html{0}>out</a>"


@query(
    f"""WITH {LINKED}, {rel_sql("goal_archive || '/raw.html'", "archive_path || '/raw.html'", "linked", HTML_KEEP)}, q AS
    (SELECT url, CASE doc_id % 3 WHEN 0 THEN chr(34) WHEN 1 THEN chr(39) ELSE '' END AS q, {REPLACED.format("rel")} AS new FROM rel)
    SELECT url, '<a title=x HREF = ' || q || new || q || '>see</a> <a data-href=' || q || '/blog/x.html' || q || ' href=' || q
    || 'http://other.example/blog/a.html' || q || '>out</a>' AS content FROM q"""
)
def link_rewrite_quoting(t):
    """Attributes in double quotes, single quotes and none."""
    page = F.concat("archive_path", F.lit("/raw.html"))
    found = regex_first("content", r'<a href="([^"]*)">see</a>', 1)
    double, single, bare = (F.format_string(QUOTED.format(mark), found) for mark in ('"', "'", ""))
    content = F.when(F.col("doc_id") % 3 == 0, double).when(F.col("doc_id") % 3 == 1, single).otherwise(bare)
    docs = V.linked(t, html=True).withColumns({"here": page, "content": content})
    return L.rewrite_html_links(docs, J.url_map(V.posts(t), there=page), SITE, path="here", target_path="there").select("url", "content")


def both_texts(t):
    return L.rewrite_markdown_links(V.linked(t), md_map(t), SITE, into="rewritten").select("url", "content", "rewritten")


@query(f"WITH {LINKED} SELECT url, {MD_TEXT.format(LOOKED_UP)} AS content FROM linked WHERE doc_id % 12 <> 0")
def changed_docs(t):
    return P.changed(both_texts(t), "content", "rewritten").select("url", F.col("rewritten").alias("content"))


@query(f"WITH {LINKED} SELECT count(*) FILTER (WHERE doc_id % 12 <> 0) AS changed, count(*) AS total FROM linked")
def count_changed(t):
    return A.count_changed(both_texts(t), "content", "rewritten")


@query(
    f"""WITH {LINKED} SELECT doc_id AS page_id, 0 AS pos, link AS raw, 'internal' AS kind FROM linked UNION ALL
    SELECT doc_id, 1, 'http://other.example/blog/a.html', 'external' FROM linked"""
)
def classified_links(t):
    docs = V.linked(t, html=True).select(F.col("doc_id").alias("page_id"), "url", F.col("content").alias("html"))
    return L.classify_links(docs, SITE).select("page_id", F.col("pos").cast("bigint").alias("pos"), "raw", "kind")


@query(f"WITH {POSTS} SELECT archive_path, url, title, comments_count FROM posts")
def with_post_data(t):
    posts = V.posts(t).select("archive_path", "url", "title", "comments_count")
    return J.with_post_data(J.url_map(posts, archive_path=F.col("archive_path")), posts).select(
        "archive_path", "url", "title", "comments_count"
    )


# ---- checks


@query(f"WITH {POSTS} SELECT url, comments_count AS declared, len(comments)::BIGINT AS found FROM posts WHERE comments_count <> len(comments)")
def comment_count_check(t):
    return Q.comment_count_check(V.posts(t))


@query(
    f"""WITH {POSTS} SELECT file_path, CASE WHEN doc_id % 31 = 0 THEN 0 WHEN doc_id % 29 = 0 THEN 2 ELSE 1 END AS in_index,
      CASE WHEN doc_id % 37 = 0 THEN 0 ELSE 1 END AS in_posts,
      CASE WHEN doc_id % 37 = 0 THEN 'missing_file' WHEN doc_id % 31 = 0 THEN 'not_indexed' ELSE 'repeated' END AS status
    FROM posts WHERE CASE WHEN doc_id % 31 = 0 THEN 0 WHEN doc_id % 29 = 0 THEN 2 ELSE 1 END <> CASE WHEN doc_id % 37 = 0 THEN 0 ELSE 1 END"""
)
def index_reconcile(t):
    posts = V.posts(t).select("doc_id", "file_path")
    listed = posts.where("doc_id % 31 <> 0")
    index = listed.unionByName(listed.where("doc_id % 29 = 0"))
    return Q.reconcile(index, posts.where("doc_id % 37 <> 0"))


# ---- processing log


@query(
    f"""WITH {LOG} SELECT run, count(*) FILTER (WHERE status = 'ok') AS successes, count(*) FILTER (WHERE status <> 'ok') AS errors, count(*) AS total,
    round(100.0::DOUBLE * count(*) FILTER (WHERE status = 'ok') / count(*), 1)::VARCHAR || '%' AS success_rate FROM log GROUP BY run"""
)
def crawl_summary(t):
    return A.run_summary(V.log(t), ("run",))


CHECKED = """SELECT run, seq, run_size, sum(CASE WHEN status = 'ok' THEN 1 ELSE 0 END) OVER w AS successes,
  sum(CASE WHEN status = 'ok' THEN 0 ELSE 1 END) OVER w AS errors FROM log WINDOW w AS (PARTITION BY run ORDER BY seq ROWS UNBOUNDED PRECEDING)"""


@query(f"WITH {LOG} SELECT run, seq, run_size, successes::BIGINT AS successes, errors::BIGINT AS errors FROM ({CHECKED}) WHERE seq % 50 = 0")
def crawl_checkpoints(t):
    return W.checkpoints(V.log(t), 50)


@query(f"WITH {LOG} SELECT run, event_id, seq, run_size FROM log")
def crawl_positions(t):
    return W.positions(V.log(t)).select("run", "event_id", "seq", "run_size")


# ---- roll-ups


@query(f"WITH {POSTS} SELECT category, count(*) AS posts FROM (SELECT unnest(categories) AS category FROM posts) GROUP BY 1")
def category_counts(t):
    return A.category_counts(V.posts(t))


@query(f"WITH {POSTS} SELECT strftime(date_trunc('week', day), '%Y-%m-%d') AS bucket, count(*) AS posts FROM posts WHERE date = iso GROUP BY 1")
def archive_by_week(t):
    return A.archive_by(V.posts(t), "week")


@query(f"WITH {POSTS} SELECT substr(iso, 1, 7) AS bucket, count(*) AS posts FROM posts WHERE date = iso GROUP BY 1")
def archive_by_month(t):
    return A.archive_by(V.posts(t), "month")


@query(rf"WITH {POSTS} SELECT upper(substr(regexp_replace(title, '^[^\p{{L}}\p{{N}}_]+', ''), 1, 1)) AS bucket, count(*) AS posts FROM posts GROUP BY 1")
def archive_by_initial(t):
    return A.archive_by(V.posts(t), "initial")


POSTINGS = r"""terms AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}_]+')) AS term FROM documents),
  postings AS (SELECT term, doc_id, count(*) AS n FROM terms WHERE term <> '' GROUP BY 1, 2)"""


@query(f"WITH {POSTINGS} SELECT term, doc_id, n FROM postings")
def term_postings(t):
    return A.term_postings(spread(t.documents, "doc_id"), "doc_id", "text")


def term_index(t):
    path = fresh_path(t.spark, "term-index")
    N.write_term_index(A.term_postings(spread(t.documents, "doc_id"), "doc_id", "text"), path, "doc_id", block=256)
    return path


@query(f"WITH {POSTS}, {POSTINGS} SELECT p.doc_id, p.url, n FROM posts p JOIN postings g ON g.doc_id = p.doc_id WHERE g.term = 'the' AND list_contains(categories, 'en')")
def term_lookup(t):
    """One term's postings out of the written index, within a category."""
    found = N.unpacked(N.scan_term(t.spark, term_index(t), "The"), "doc_id")
    return A.find_posts(found, V.posts(t), "The", "en", "doc_id").select("doc_id", "url", "n")


@query(f"WITH {POSTINGS} SELECT term, doc_id, n FROM postings WHERE term = 'and' ORDER BY n DESC, doc_id LIMIT 20")
def term_top(t):
    """The documents that hold a term most often, by way of the block maxima."""
    return N.top_posts(N.scan_term(t.spark, term_index(t), "and"), 20, "doc_id")


@query(f"""WITH {POSTINGS}, d AS (SELECT term, count(*) AS posts, sum(n) AS uses, max(n) AS max_n FROM postings GROUP BY 1)
    SELECT term, posts, uses::BIGINT AS uses, max_n FROM d""")
def term_index_totals(t):
    """The whole index read back: documents, uses and highest count per term."""
    blocks = t.spark.read.parquet(term_index(t))
    uses = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, n: a + n)
    return blocks.groupBy("term").agg(F.sum("posts").alias("posts"), F.sum(uses).alias("uses"), F.max("max_n").alias("max_n"))
