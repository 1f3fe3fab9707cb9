"""Views derived from the given tables, once for Spark and once as SQL common table expressions.

``posts``: documents as blog posts, their order's date as publication date, every line after the first
as a comment. ``linked``: posts with an internal and an external link appended. ``threads``:
conversations as a comment table of its own. ``log``: events as a processing log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.functions.text import escape_html
from folioworks.functions.urls import Site, post_archive_path, post_file_path
from folioworks.operators.aggregates import archive_month
from folioworks.plans.registry import Tables
from folioworks.sources.readers import spread

SITE = Site()
AUTHOR = "Site Author"


def post_dates(t: Tables) -> DataFrame:
    """``(doc_id, url, iso, long)`` of every document."""
    orders = t.orders.selectExpr("o_orderkey AS doc_id", "o_orderdate AS day")
    return t.documents.select("doc_id").join(orders, "doc_id").selectExpr(
        "doc_id",
        """CASE WHEN doc_id % 50 = 0 THEN concat('http://site.example/blog/doc-', doc_id, '.html')
           ELSE concat('http://site.example/blog/', date_format(day, 'yyyy/M/d'), '/doc-', doc_id, '.html') END AS url""",
        "date_format(day, 'yyyy-MM-dd') AS iso",
        "date_format(day, 'EEEE, MMMM d, yyyy \\'at\\' HH:mm') AS long",
    )


def posts(t: Tables, dates: DataFrame | None = None) -> DataFrame:
    """Columns that ``dates`` has beyond those of :func:`post_dates` are kept at the end."""
    dates = dates or post_dates(t)
    more = [c for c in dates.columns if c not in ("doc_id", "url", "iso", "long")]
    return (
        spread(t.documents.join(dates, "doc_id"), "doc_id")
        .selectExpr("*", "substring_index(text, '\\n', 1) AS head", "split(text, '\\n', -1) AS lines")
        .selectExpr(
            "doc_id",
            "url",
            """CASE WHEN doc_id % 11 = 0 THEN '' WHEN doc_id % 7 = 0 THEN concat('"', head, '"') ELSE head END AS title""",
            "CASE WHEN doc_id % 9 = 0 THEN '' ELSE source END AS author",
            "CASE WHEN doc_id % 50 = 0 THEN '' WHEN doc_id % 13 = 0 THEN long ELSE iso END AS date",
            """CASE WHEN doc_id % 5 = 0 THEN cast(array() AS array<string>)
               WHEN doc_id % 17 = 0 THEN array(source, lang, "What's Next?") ELSE array(source, lang) END AS categories""",
            "text AS content",
            "lang",
            "source",
            "cast(size(lines) - 1 + if(doc_id % 10 = 0, 1, 0) AS bigint) AS comments_count",
            """transform(slice(lines, 2, greatest(size(lines) - 1, 0)), (x, i) -> struct(string(i + 1) AS id,
               if((i + 1) % 3 = 2, '', source) AS author, if((i + 1) % 2 = 0, '', iso) AS date, x AS content)) AS comments""",
            *more,
        )
        .withColumns({
            "file_path": post_file_path("url", SITE),
            "archive_path": post_archive_path("url", SITE),
        })
        .withColumn("month", F.when(F.col("doc_id") % 50 != 0, archive_month("archive_path")))
    )


POSTS = """
posts0 AS (
  SELECT d.doc_id, d.text AS content, d.lang, d.source, o.o_orderdate AS day,
         string_split(d.text, chr(10)) AS lines,
         string_split(d.text, chr(10))[1] AS head,
         strftime(o.o_orderdate, '%Y-%m-%d') AS iso
  FROM documents d JOIN orders o ON d.doc_id = o.o_orderkey),
posts AS (
  SELECT doc_id, content, lang, source, lines, iso, day,
    CASE WHEN doc_id % 50 = 0 THEN 'http://site.example/blog/doc-' || doc_id || '.html'
         ELSE 'http://site.example/blog/' || strftime(day, '%Y/%-m/%-d') || '/doc-' || doc_id || '.html' END AS url,
    CASE WHEN doc_id % 11 = 0 THEN '' WHEN doc_id % 7 = 0 THEN '"' || head || '"' ELSE head END AS title,
    CASE WHEN doc_id % 9 = 0 THEN '' ELSE source END AS author,
    CASE WHEN doc_id % 50 = 0 THEN '' WHEN doc_id % 13 = 0 THEN strftime(day, '%A, %B %-d, %Y at %H:%M') ELSE iso END AS date,
    CASE WHEN doc_id % 5 = 0 THEN []::VARCHAR[]
         WHEN doc_id % 17 = 0 THEN [source, lang, 'What''s Next?'] ELSE [source, lang] END AS categories,
    len(lines) - 1 + CASE WHEN doc_id % 10 = 0 THEN 1 ELSE 0 END AS comments_count,
    list_transform(lines[2:], lambda x, i: {'id': i::VARCHAR,
        'author': CASE WHEN i % 3 = 2 THEN '' ELSE source END,
        'date': CASE WHEN i % 2 = 0 THEN '' ELSE iso END,
        'content': x}) AS comments,
    CASE WHEN doc_id % 50 = 0 THEN '_posts/misc-doc-' || doc_id || '.md'
         ELSE '_posts/' || iso || '-doc-' || doc_id || '.md' END AS file_path,
    CASE WHEN doc_id % 50 = 0 THEN 'posts/doc-' || doc_id
         ELSE 'posts/' || strftime(day, '%Y/%-m/%-d') || '/doc-' || doc_id END AS archive_path,
    CASE WHEN doc_id % 50 <> 0 THEN substr(iso, 1, 7) END AS month
  FROM posts0)
"""


def linked(t: Tables, html: bool = False) -> DataFrame:
    """Posts with ``content`` extended by an internal and an external link; every 12th target is missing."""
    n = t.documents.select(F.count(F.lit(1))).scalar()
    goal = post_dates(t).selectExpr("doc_id AS goal", "url AS goal_url")
    tail = (
        """'\\n<a href="', link, '">see</a> <a href="http://other.example/blog/a.html">out</a> end'"""
        if html
        else """'\\n[see](', link, ') and [out](http://other.example/blog/a.html) end'"""
    )
    # Goals are found on narrow rows, so that texts move once.
    base = posts(t, post_dates(t).withColumn("goal", (F.col("doc_id") * 7 + 3) % n).join(goal, "goal").drop("goal"))
    made = base.selectExpr(
        "* EXCEPT (goal_url)",
        """concat(CASE WHEN doc_id % 12 = 0 THEN concat('http://site.example/blog/2000/1/1/gone-', doc_id, '.html')
           WHEN doc_id % 9 = 0 THEN replace(goal_url, 'http://', 'http://www.') ELSE goal_url END,
           if(doc_id % 10 = 0, '#c1', '')) AS link""",
    )
    return made.withColumn("content", F.expr(f"concat(content, {tail})")).drop("link")


LINKED = (
    POSTS
    + """,
linked AS (
  SELECT p.*, g.file_path AS goal_file, g.archive_path AS goal_archive, g.url AS goal_url,
    CASE WHEN p.doc_id % 10 = 0 THEN '#c1' ELSE '' END AS frag,
    CASE WHEN p.doc_id % 12 = 0 THEN 'http://site.example/blog/2000/1/1/gone-' || p.doc_id || '.html'
         WHEN p.doc_id % 9 = 0 THEN replace(g.url, 'http://', 'http://www.') ELSE g.url END ||
    CASE WHEN p.doc_id % 10 = 0 THEN '#c1' ELSE '' END AS link
  FROM posts p JOIN posts g ON g.doc_id = (p.doc_id * 7 + 3) % (SELECT count(*) FROM documents))
"""
)


def threads(t: Tables) -> DataFrame:
    """Turns of the conversations as comments on the post of the same number."""
    urls = post_dates(t).selectExpr("doc_id AS conv_id", "url", "iso")
    return t.conversations.join(urls, "conv_id").selectExpr(
        "url",
        "turn",
        "if(turn % 3 = 2, '', role) AS author",
        "if(turn % 2 = 0, '', iso) AS date",
        "text AS content",
    )


THREADS = (
    POSTS
    + """,
threads AS (
  SELECT p.url, c.turn, row_number() OVER (PARTITION BY p.url ORDER BY c.turn) AS comment_no,
    CASE WHEN c.turn % 3 = 2 THEN '' ELSE c.role END AS author,
    CASE WHEN c.turn % 2 = 0 THEN '' ELSE p.iso END AS date, c.text AS content
  FROM conversations c JOIN posts p ON p.doc_id = c.conv_id)
"""
)


def manifest(t: Tables) -> DataFrame:
    """Manifest in order, with every 4th post listed again at the end."""
    n = t.documents.select(F.count(F.lit(1))).scalar()
    rows = posts(t).select(F.col("doc_id").alias("pos"), "url", F.col("archive_path").alias("path"), "title")
    again = rows.where(F.col("pos") % 4 == 0).withColumn("pos", F.col("pos") + n)
    return rows.unionByName(again)


def completed(t: Tables) -> DataFrame:
    return post_dates(t).where("doc_id % 3 = 0").select("url")


MANIFEST = (
    POSTS
    + """,
manifest AS (
  SELECT doc_id AS pos, url, archive_path AS path, title FROM posts UNION ALL
  SELECT doc_id + (SELECT count(*) FROM documents), url, archive_path, title FROM posts WHERE doc_id % 4 = 0),
completed AS (SELECT url FROM posts WHERE doc_id % 3 = 0)
"""
)


def log(t: Tables) -> DataFrame:
    return t.events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("run"),
        "ts",
        "event_id",
        F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("status"),
    )


LOG = """
log AS (
  SELECT strftime(ts, '%Y-%m-%d') AS run, ts, event_id,
    CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status,
    row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d') ORDER BY ts, event_id) AS seq,
    count(*) OVER (PARTITION BY strftime(ts, '%Y-%m-%d')) AS run_size
  FROM events)
"""


def blog_pages(t: Tables, source: DataFrame | None = None) -> DataFrame:
    """Posts as blog pages in the layout the default selectors read: ``(page_id, url, html)``."""
    p = source or posts(t)
    lines = F.split("content", "\n", -1)

    def comment(c: Column) -> Column:
        return F.concat(
            F.lit('<div class="comment-wrapper"><div class="comment" id="comment'), c["id"],
            F.lit('"><div class="body">'), escape_html(c["content"]), F.lit('</div><div class="signature">'),
            F.when(c["date"] != "", F.concat(c["date"], F.lit(" at 10:15 | "))).otherwise(F.lit("")),
            F.when(c["author"] != "", c["author"]).otherwise(F.lit("Guest")), F.lit("</div></div></div>"),
        )

    html = F.concat(
        F.lit('<html><head><script>//<![CDATA[\nvar a = "</p>";\n//]]></script></head><body><div class="journal-entry" id="item'),
        F.col("doc_id"), F.lit('"><h2 class="title"><a href="#">'), escape_html("title"),
        F.lit('</a></h2><div class="journal-entry-tag-post-title"><span class="posted-on">'), F.col("date"),
        F.lit('</span></div><div class="body">'),
        F.array_join(F.transform(lines, lambda x: F.concat(F.lit("<p>"), escape_html(x), F.lit("</p>"))), "\n"),
        F.lit('</div><div class="journal-entry-tag-post-body"><span class="posted-by">by <a>'), F.col("author"),
        F.lit('</a></span></div><div class="journal-entry-tag-post-body-line2"><span class="posted-in">in '),
        F.array_join(
            F.transform("categories", lambda x: F.concat(
                F.lit('<span class="tag-element"><a>'), escape_html(x), F.lit("</a></span>"))), " "),
        F.lit('</span></div><div class="post-comments"><a>'), F.col("comments_count"),
        F.lit(' Comments</a></div></div><div class="journal-comment-area">'),
        F.array_join(F.transform("comments", comment), "\n"), F.lit("</div></body></html>"),
    )
    return p.select(F.col("doc_id").alias("page_id"), "url", html.alias("html"))


# Posts as they come back out of the blog pages, and the same with links.
def extracted_sql(source: str) -> str:
    body = """array_to_string(list_filter(list_transform(string_split({}, chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10) || chr(10))"""
    md = r"trim(regexp_replace(replace(replace(c.content, '*', '\*'), '_', '\_'), '[ \t]+', ' ', 'g'))"
    return rf"""
extracted AS (
  SELECT * REPLACE ({body.format(source)} AS content, trim(regexp_replace(title, '\s+', ' ', 'g')) AS title,
    CASE WHEN doc_id % 50 = 0 THEN '' ELSE iso END AS date,
    list_transform(comments, lambda c: {{'id': c.id, 'author': CASE WHEN c.author = '' THEN 'Guest' ELSE c.author END,
      'date': c.date, 'content': {md}}}) AS comments)
  FROM linked)
"""


def index_pages(t: Tables) -> DataFrame:
    """Every document as an index page listing one link per line; many pages share their links."""
    lines = F.split("text", "\n", -1)

    def entry(line: Column, i: Column) -> Column:
        return F.concat(
            F.lit('<li><a href="/blog/'), F.col("doc_id") % 50, F.lit("/"), i, F.lit('.html">'),
            escape_html(line), F.lit("</a></li>"),
        )

    html = F.concat(
        F.lit('<html><body><h3>Latest</h3><ul><li><a href="/blog/latest.html">New</a></li></ul><h3>Entries by Title</h3><div><ul>'),
        F.lit('<li><a href="/blog/NaN/NaN/NaN/x.html">Bad</a></li><li><a href="/about">About</a></li>'),
        F.array_join(F.transform(lines, entry), ""),
        F.lit('</ul></div><h3>Other</h3><ul><li><a href="/blog/other.html">Other</a></li></ul></body></html>'),
    )
    docs = spread(t.documents, "doc_id")
    return docs.select(F.col("doc_id").alias("page_id"), F.lit(SITE.base_url + "/index/").alias("url"), html.alias("html"))


INDEX_LINKS = r"""
lines AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS i, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
index_links AS (SELECT doc_id AS page_id, i + 2 AS pos, '/blog/' || (doc_id % 50) || '/' || i || '.html' AS path, trim(line) AS title FROM lines)
"""
