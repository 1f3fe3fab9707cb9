"""Queries over posts: paths, dates, rendering, front matter, indexes, extraction from blog pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioworks.functions import dates as D
from folioworks.functions import text as X
from folioworks.functions import urls as U
from folioworks.operators import aggregates as A
from folioworks.operators import extract as E
from folioworks.operators import filters as P
from folioworks.operators import ordering as O
from folioworks.operators import render as R
from folioworks.operators import windows as W
from folioworks.operators.frontmatter import parse_front_matter
from folioworks.plans import views as V
from folioworks.plans.registry import query
from folioworks.plans.views import AUTHOR, POSTS, SITE, THREADS
from folioworks.session import materialise


def big(name: str):
    return F.col(name).cast("bigint").alias(name)


# ---- paths and URLs


@query(f"WITH {POSTS} SELECT url, file_path FROM posts")
def post_file_paths(t):
    return V.post_dates(t).select("url", U.post_file_path("url", SITE).alias("file_path"))


@query(f"WITH {POSTS} SELECT url, archive_path FROM posts")
def post_archive_paths(t):
    return V.post_dates(t).select("url", U.post_archive_path("url", SITE).alias("archive_path"))


SITE_URL = """CASE WHEN doc_id % 50 = 0 THEN '/archive/misc-doc-' || doc_id || '/'
  ELSE '/archive/' || strftime(day, '%Y/%m/%d') || '/doc-' || doc_id || '/' END"""


@query(f"WITH {POSTS} SELECT url, {SITE_URL} AS site_url FROM posts")
def post_site_urls(t):
    return V.post_dates(t).select("url", U.site_url(U.post_file_path("url", SITE)).alias("site_url"))


@query(
    f"""WITH {POSTS} SELECT url, '/' || array_to_string(list_concat(
      list_transform(categories, lambda c: trim(regexp_replace(lower(c), '[^a-z0-9]+', '-', 'g'), '-')),
      CASE WHEN doc_id % 50 = 0 THEN ['misc-doc-' || doc_id]
      ELSE [strftime(day, '%Y'), strftime(day, '%m'), strftime(day, '%d'), 'doc-' || doc_id] END), '/') || '/' AS permalink FROM posts"""
)
def post_permalinks(t):
    return V.posts(t).select("url", U.permalink("categories", "file_path").alias("permalink"))


RELATIVE = """
 repeat('../', (len(ca) - k)::INT) || array_to_string(ta[k + 1:], '/')"""


def rel_sql(goal: str, here: str, source: str, keep: str) -> str:
    """Relative path of ``goal`` from the file ``here`` for every row of ``source``."""
    return f"""
    r0 AS (SELECT {keep}, string_split({goal}, '/') AS ta, string_split({here}, '/')[:-2] AS ca FROM {source}),
    r1 AS (SELECT *, len(list_filter(range(1, least(len(ta) - 1, len(ca)) + 1), lambda i: ta[1:i] = ca[1:i])) AS k FROM r0),
    rel AS (SELECT *, {RELATIVE} AS rel FROM r1)"""


@query(
    f"""WITH {V.LINKED}, {rel_sql("goal_archive || '/content.md'", "archive_path || '/content.md'", "linked", "url")}
    SELECT url, rel FROM rel"""
)
def relative_paths(t):
    n = t.documents.select(F.count(F.lit(1))).scalar()
    here = V.post_dates(t).select("doc_id", "url", F.concat(U.post_archive_path("url", SITE), F.lit("/content.md")).alias("here"))
    goal = here.select(F.col("doc_id").alias("goal"), F.col("here").alias("there"))
    pairs = here.withColumn("goal", (F.col("doc_id") * 7 + 3) % n).join(goal, "goal")
    return pairs.select("url", U.relative_path("there", "here").alias("rel"))


# ---- scalar helpers


@query(f"WITH {POSTS} SELECT url, CASE WHEN doc_id % 50 = 0 THEN '' ELSE iso END AS day, date FROM posts")
def parse_dates(t):
    return V.posts(t).select("url", D.parse_archive_date("date").alias("day"), "date")


@query(f"WITH {POSTS} SELECT url, strftime(day, '%b %Y') AS month, strftime(day, '%B %-d, %Y') AS shown FROM posts WHERE doc_id % 50 <> 0")
def date_labels(t):
    dated = V.posts(t).where("month IS NOT NULL")
    return dated.select(
        "url", D.month_label("month").alias("month"), D.long_date(D.parse_archive_date("date")).alias("shown")
    )


@query(f"WITH {POSTS} SELECT url, date FROM posts WHERE regexp_full_match(date, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')")
def iso_dates(t):
    return V.posts(t).where(D.is_iso_date("date")).select("url", "date")


@query(
    f"""WITH {POSTS}, s AS (SELECT url, CASE WHEN doc_id % 4 = 0 THEN '  ' || source || ' ' ELSE long || ' |  ' || source || ' | x' END AS s,
      doc_id, source, long FROM (SELECT *, strftime(day, '%A, %B %-d, %Y at %H:%M') AS long FROM posts))
    SELECT url, CASE WHEN doc_id % 4 = 0 THEN '' ELSE long END AS date,
      CASE WHEN doc_id % 4 = 0 THEN source ELSE source || ' | x' END AS author FROM s"""
)
def parse_signatures(t):
    long = V.post_dates(t).select("doc_id", "url", "long").join(t.documents.select("doc_id", "source"), "doc_id")
    text = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("  "), "source", F.lit(" "))).otherwise(
        F.concat("long", F.lit(" |  "), "source", F.lit(" | x"))
    )
    got = long.select("url", X.parse_signature(text).alias("s"))
    return got.select("url", "s.date", "s.author")


@query(
    f"""WITH {POSTS} SELECT url, coalesce(try_cast(regexp_extract(content, '([0-9]+)', 1) AS BIGINT), 0) AS n_text,
    comments_count AS n_label FROM posts"""
)
def parse_counts(t):
    label = F.concat(F.lit("Comments ("), F.col("comments_count"), F.lit(")"))
    return V.posts(t).select("url", X.parse_count("content").alias("n_text"), X.parse_count(label).alias("n_label"))


@query(
    f"""WITH {POSTS} SELECT url, trim(regexp_replace(content, '\\s+', ' ', 'g')) AS cleaned,
    regexp_replace(regexp_replace(regexp_replace(content || chr(10) || chr(10) || ' ' || chr(10) || chr(10) || 'end  of', '[ \\t]+', ' ', 'g'),
      '\\n\\s*\\n\\s*\\n+', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g') AS kept FROM posts"""
)
def cleaned_text(t):
    padded = F.concat("content", F.lit("\n\n \n\nend  of"))
    return V.posts(t).select(
        "url", X.clean_text("content").alias("cleaned"), X.clean_text(padded, preserve_formatting=True).alias("kept")
    )


@query(
    rf"""WITH {POSTS} SELECT url, replace(replace(url, '/blog/', ''), '.html', '') AS no_token, split_part(url, '/', -1) AS last,
    CASE WHEN url LIKE '%/blog/doc-%' THEN '' ELSE lpad(split_part(url, '/', 6), 2, '0') END AS padded,
    CASE WHEN strip_accents(trim(title)) = '' THEN 'none' ELSE title END AS titled,
    substr(content, 1, 50) AS start, replace(replace(title, '\', '\\'), '"', '\"') AS escaped, title AS unescaped,
    replace(replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;') AS html,
    regexp_replace(regexp_extract(url, '//[^/]*([^?#]*)', 1), '[0-9]+', 'N', 'g') AS path, len(regexp_extract_all(content, '\n')) AS breaks FROM posts"""
)
def text_helpers(t):
    dated = U.matches_dated("url", SITE)
    month = F.regexp_extract("url", SITE.dated_pattern, 2)
    return V.posts(t).select(
        "url",
        X.strip_token(X.strip_token("url", "/blog/"), ".html").alias("no_token"),
        X.last_segment("url").alias("last"),
        F.when(dated, X.pad2(month)).otherwise(F.lit("")).alias("padded"),
        X.default_if_blank("title", "none").alias("titled"),
        X.preview("content", 50).alias("start"),
        X.escape_quotes("title").alias("escaped"),
        X.unescape_quotes(X.escape_quotes("title")).alias("unescaped"),
        X.escape_html("title").alias("html"),
        X.regex_sub(U.url_path("url"), r"\d+", "N").alias("path"),
        F.size(X.regex_all("content", "\n", 0)).cast("bigint").alias("breaks"),
    )


@query(
    f"""WITH {POSTS} SELECT url, '[' || array_to_string(list_transform(categories,
      lambda c: CASE WHEN contains(c, '''') THEN '"' || c || '"' ELSE '''' || c || '''' END), ', ') || ']' AS literal,
      array_to_string(categories, '|') AS back FROM posts"""
)
def category_literals(t):
    lit = X.list_literal("categories")
    return V.posts(t).select(
        "url", lit.alias("literal"),
        F.array_join(X.parse_list_literal(F.regexp_extract(lit, r"^\[(.*)\]$", 1)), "|").alias("back"),
    )


@query(f"WITH {POSTS} SELECT url, title, comments_count, array_to_string(categories, '|') AS categories FROM posts")
def record_json(t):
    """Encode to JSON and decode again."""
    shape = "url string, title string, comments_count bigint, categories array<string>"
    packed = X.to_record_json(V.posts(t).select("url", "title", "comments_count", "categories"))
    back = X.from_record_json(packed, shape)
    return back.withColumn("categories", F.array_join("categories", "|"))


@query(
    f"""WITH {POSTS} SELECT url, replace(title, 'the', 'THE') AS title, replace(content, 'the', 'THE') AS content,
    array_to_string(list_transform(comments, lambda c: replace(c.content, 'the', 'THE')), '|') AS comments FROM posts"""
)
def migrate_domain(t):
    """Literal replacement in text columns and in the comments."""
    moved = E.migrate_domain(V.posts(t).select("url", "title", "content", "comments"), ["title", "content", "comments"], "the", "THE")
    return moved.withColumn("comments", F.array_join(F.col("comments.content"), "|"))


# ---- filters


@query(
    f"""WITH {POSTS} SELECT path, malformed FROM (
      SELECT replace(url, 'http://site.example', '') AS path, false AS malformed FROM posts UNION ALL
      SELECT '/blog/NaN/NaN/NaN/doc-' || doc_id || '.html', true FROM posts WHERE doc_id % 25 = 0)"""
)
def malformed_urls(t):
    good = V.post_dates(t).select(U.url_path("url").alias("href"))
    odd = V.post_dates(t).where("doc_id % 25 = 0").select(F.concat(F.lit("/blog/NaN/NaN/NaN/doc-"), F.col("doc_id"), F.lit(".html")).alias("href"))
    kept, rejects = P.split_malformed(good.unionByName(odd))
    return kept.withColumn("malformed", F.lit(False)).unionByName(rejects.withColumn("malformed", F.lit(True))).withColumnRenamed("href", "path")


@query(f"WITH {POSTS} SELECT url, title, author FROM posts WHERE title <> '' AND author <> ''")
def without_blanks(t):
    return P.drop_blank(V.posts(t), ["title", "author"]).select("url", "title", "author")


@query(f"WITH {POSTS} SELECT url, archive_path FROM posts WHERE doc_id % 50 <> 0")
def dated_posts(t):
    return P.dated_only(V.posts(t)).select("url", "archive_path")


@query(f"WITH {POSTS} SELECT url FROM posts WHERE doc_id % 50 <> 0")
def dated_urls(t):
    return P.matches_url_pattern(V.post_dates(t), SITE.dated_pattern).select("url")


@query(f"WITH {POSTS} SELECT url, comments_count FROM posts WHERE comments_count > 0")
def posts_with_comments(t):
    return P.has_comments(V.posts(t)).select("url", "comments_count")


# ---- rendering; the SQL builds the text line by line

POST_HEAD = """'# ' || title || chr(10) || chr(10) || '**Author:** ' || author || chr(10) || '**Date:** ' || date || chr(10) ||
  CASE WHEN len(categories) > 0 THEN '**Categories:** ' || array_to_string(categories, ', ') || chr(10) ELSE '' END ||
  '**URL:** ' || url || chr(10) || chr(10) || '---' || chr(10) || chr(10) || content"""


def post_comment_sql(c: str, i: str) -> str:
    return f"""'### Comment ' || {i} || chr(10) || '**Author:** ' || {c}.author || chr(10) || '**Date:** ' || {c}.date || chr(10) || chr(10) ||
      {c}.content || chr(10) || chr(10) || '---' || chr(10) || chr(10)"""


POST_TEXT = f"""{POST_HEAD} || CASE WHEN len(comments) > 0 THEN
  chr(10) || chr(10) || '## Comments (' || len(comments) || ')' || chr(10) || chr(10) ||
  array_to_string(list_transform(comments, lambda c, i: {post_comment_sql("c", "i")}), '') ELSE '' END"""


@query(f"WITH {POSTS} SELECT url, {POST_TEXT} AS markdown FROM posts")
def render_post_md(t):
    return R.render_post_markdown(V.posts(t)).select("url", "markdown")


SITE_DATE = "CASE WHEN date <> '' THEN date WHEN doc_id % 50 <> 0 THEN iso END"
SITE_HEAD = rf"""concat_ws(chr(10), '---',
  'title: "' || CASE WHEN title = '' THEN 'Untitled' ELSE replace(replace(title, '\', '\\'), '"', '\"') END || '"',
  'author: "' || CASE WHEN author = '' THEN '{AUTHOR}' ELSE author END || '"',
  CASE WHEN regexp_full_match({SITE_DATE}, '\d{{4}}-\d{{2}}-\d{{2}}') THEN 'date: ' || {SITE_DATE} ELSE 'date: "' || {SITE_DATE} || '"' END,
  CASE WHEN len(categories) > 0 THEN 'categories: [' || array_to_string(list_transform(categories,
    lambda x: CASE WHEN contains(x, '''') THEN '"' || x || '"' ELSE '''' || x || '''' END), ', ') || ']' END,
  'original_url: "' || url || '"', 'layout: post', '---', '', CASE WHEN content <> '' THEN content || chr(10) END)"""


def site_comment_sql(c: str) -> str:
    return f"""chr(10) || concat_ws(chr(10), CASE WHEN {c}.author <> '' THEN '**Author:** ' || {c}.author END,
      CASE WHEN {c}.date <> '' THEN '**Date:** ' || {c}.date END, '', CASE WHEN {c}.content <> '' THEN {c}.content END, '', '---', '')"""


SITE_COMMENTS_HEAD = "chr(10) || chr(10) || '## Comments' || chr(10) || chr(10) || '---' || chr(10)"
SITE_TEXT = f"""{SITE_HEAD} || CASE WHEN len(comments) > 0 THEN {SITE_COMMENTS_HEAD} ||
  array_to_string(list_transform(comments, lambda c: {site_comment_sql("c")}), '') ELSE '' END"""


@query(f"WITH {POSTS} SELECT file_path, {SITE_TEXT} AS markdown FROM posts")
def render_site_md(t):
    return R.render_site_markdown(V.posts(t), AUTHOR).select("file_path", "markdown")


def segments_sql(head: str, opening: str, block: str) -> str:
    return f"""WITH {THREADS},
    blocks AS (SELECT url, ((comment_no - 1) // 3) + 1 AS seg_no, comment_no, {block} AS b FROM threads c)
    SELECT url, 0 AS seg_no, {head} || CASE WHEN n IS NOT NULL THEN {opening} ELSE '' END AS markdown
    FROM posts LEFT JOIN (SELECT url AS u, count(*) AS n FROM threads GROUP BY 1) ON u = url
    UNION ALL SELECT url, seg_no, string_agg(b, '' ORDER BY comment_no) FROM blocks GROUP BY 1, 2"""


@query(
    segments_sql(
        POST_HEAD,
        "chr(10) || chr(10) || '## Comments (' || n || ')' || chr(10) || chr(10)",
        post_comment_sql("c", "comment_no"),
    )
)
def render_post_segments(t):
    comments = W.number_comments(V.threads(t))
    return R.render_segments(V.posts(t), comments, "post", chunk=3)


@query(segments_sql(SITE_HEAD, SITE_COMMENTS_HEAD, site_comment_sql("c")))
def render_site_segments(t):
    comments = W.number_comments(V.threads(t))
    return R.render_segments(V.posts(t), comments, "site", AUTHOR, chunk=3)


@query(
    f"""WITH {POSTS} SELECT url AS original_url, file_path, CASE WHEN title = '' THEN 'Untitled' ELSE title END AS title,
    CASE WHEN author = '' THEN '{AUTHOR}' ELSE author END AS author,
    CASE WHEN doc_id % 50 = 0 OR doc_id % 13 = 0 THEN '' ELSE iso END AS date, array_to_string(categories, '|') AS categories FROM posts"""
)
def front_matter_roundtrip(t):
    """Parsing what was rendered gives the fields back."""
    files = R.render_site_markdown(V.posts(t), AUTHOR, "text")
    return parse_front_matter(files, AUTHOR).withColumn("categories", F.array_join("categories", "|"))


@query(f"WITH {POSTS} SELECT file_path FROM posts WHERE doc_id % 3 <> 0")
def files_with_front_matter(t):
    text = F.when(F.col("doc_id") % 3 == 0, F.col("content")).otherwise(F.col("text"))
    files = R.render_site_markdown(V.posts(t), AUTHOR, "text").withColumn("text", text)
    return P.has_front_matter(files).select("file_path")


# ---- index


@query(
    f"""WITH {POSTS} SELECT title, date, author, array_to_string(categories, '|') AS categories, comments_count, file_path, url FROM posts"""
)
def index_entries(t):
    return R.index_entry(V.posts(t)).withColumn("categories", F.array_join("categories", "|"))


@query(f"WITH {POSTS} SELECT title, url, author, date, array_to_string(categories, '|') AS categories, comments_count, archive_path FROM posts")
def master_index(t):
    return O.newest_first(R.master_entry(V.posts(t))).withColumn("categories", F.array_join("categories", "|"))


INDEX_LINE = f"""'- [' || CASE WHEN trim(title) = '' THEN CASE WHEN doc_id % 50 = 0 THEN 'misc-' ELSE iso || '-' END || 'doc-' || doc_id ELSE trim(title) END ||
  '](' || {SITE_URL} || ')' || CASE WHEN comments_count > 0 THEN ' (' || comments_count || ' comments)' ELSE '' END ||
  CASE WHEN len(categories) > 0 THEN ' - *' || array_to_string(categories, ', ') || '*' ELSE '' END"""


@query(f"WITH {POSTS} SELECT url, {INDEX_LINE} AS line FROM posts")
def index_lines(t):
    return O.newest_first(V.posts(t)).select("url", R.index_line().alias("line"))


@query(
    f"""WITH {POSTS} SELECT 1 AS part, date, url, {INDEX_LINE} AS line FROM posts UNION ALL
    SELECT 0, '', '', '---' || chr(10) || 'title: Archive' || chr(10) || 'layout: home' || chr(10) || '---' || chr(10) || chr(10) ||
    'This archive preserves ' || count(*) || ' posts and their comments.' || chr(10) FROM posts"""
)
def site_index_page(t):
    return R.site_listing(R.index_entry(V.posts(t)), "Archive").orderBy("part", F.desc("date"), "url")


@query(f"WITH {POSTS} SELECT url, date, title FROM posts ORDER BY date DESC, url LIMIT 20")
def latest_20(t):
    return O.latest(V.posts(t).select("url", "date", "title"), 20)


@query(f"WITH {POSTS} SELECT date, url FROM posts")
def newest_first(t):
    return O.newest_first(V.posts(t).select("date", "url"))


@query(f"WITH {POSTS} SELECT count(*) AS total_posts FROM posts")
def count_posts(t):
    return A.count_posts(V.post_dates(t))


@query(f"WITH {POSTS} SELECT month, count(*) AS posts FROM posts WHERE month IS NOT NULL GROUP BY 1")
def posts_by_month(t):
    return O.months_desc(A.posts_by_month(P.dated_only(V.posts(t))))


@query(f"WITH {POSTS} SELECT coalesce(min(month) || ' to ' || max(month), 'N/A') AS date_range, count(*) AS total_posts FROM posts")
def archive_range(t):
    return A.archive_range(V.posts(t))


@query(f"WITH {POSTS} SELECT month, date, title, archive_path, comments_count, url FROM posts WHERE month IS NOT NULL")
def month_groups(t):
    return A.month_groups(P.dated_only(V.posts(t)))


@query(f"WITH {POSTS} SELECT month, date, url FROM posts WHERE month IS NOT NULL")
def sorted_within_months(t):
    return O.sort_within_month(P.dated_only(V.posts(t)).select("month", "date", "url"))


def escaped(c: str) -> str:
    return f"""replace(replace(replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&#39;')"""


@query(
    f"""WITH {POSTS} SELECT month, 1 AS part, date, url, concat_ws(chr(10), '    <div class="post">', '        <div class="post-title">' || {escaped('title')} || '</div>',
      '        <div class="post-meta">' || {escaped('date')} || CASE WHEN comments_count > 0 THEN ' (' || comments_count || ' comments)' ELSE '' END || '</div>',
      '        <div class="post-links">', '            <a href="' || {escaped('archive_path')} || '/raw.html" class="html-link">View HTML</a>',
      '            <a href="' || {escaped('archive_path')} || '/content.md" class="md-link">View Markdown</a>', '        </div>', '    </div>') AS line
    FROM posts WHERE month IS NOT NULL UNION ALL
    SELECT month, 0, '', '', '    <h2>' || strftime(min(day), '%b %Y') || ' (' || count(*) || ' posts)</h2>' FROM posts WHERE month IS NOT NULL GROUP BY month"""
)
def month_blocks(t):
    return R.month_listing(P.dated_only(V.posts(t))).orderBy(F.desc("month"), "part", "date", "url")


@query(
    f"""WITH {POSTS} SELECT url, replace(replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;') AS title,
    CASE WHEN date = iso THEN strftime(day, '%B %-d, %Y') END AS shown_date, CASE WHEN date = iso THEN iso || 'T00:00:00+00:00' END AS xml_date,
    nullif(author, '') AS author, CASE WHEN len(categories) > 0 THEN array_to_string(categories, ', ') END AS categories, url AS original_url, lang FROM posts"""
)
def post_view(t):
    return R.post_view(V.posts(t))


@query(f"WITH {POSTS} SELECT url, len(comments)::BIGINT AS comments FROM posts")
def comment_counts(t):
    return A.comment_counts(V.posts(t))


@query(f"WITH {POSTS} SELECT url, len(list_filter(comments, lambda c: c.author <> ''))::BIGINT AS site, len(comments)::BIGINT AS post FROM posts")
def comment_counts_in_text(t):
    """Counted from either rendered layout; the site layout shows only comments with an author."""
    both = R.render_post_markdown(R.render_site_markdown(V.posts(t), AUTHOR, "s"), "p").select(
        "url", F.explode(F.create_map(F.lit("site"), "s", F.lit("post"), "p")).alias("layout", "text")
    ).withColumn("file_path", F.concat_ws(" ", "layout", "url"))
    found = A.comment_counts_in_text(both).select(
        F.substring_index("file_path", " ", 1).alias("layout"), F.substring_index("file_path", " ", -1).alias("url"), "comments_count"
    )
    return found.groupBy("url").pivot("layout", ["site", "post"]).agg(F.sum("comments_count"))


@query(f"WITH {POSTS} SELECT url, len(comments)::BIGINT AS site, len(list_filter(comments, lambda c: c.author <> ''))::BIGINT AS signed FROM posts")
def comment_counts_carried(t):
    """Counts that the front matter carries, with unsigned comments, and for bodies that hold a comments heading with the plain layout."""
    p = V.posts(t).withColumn("content", F.concat("content", F.lit("\n\n## Comments\n\n---\n\n**Author:** body\n")))
    bare = R.render_site_markdown(p.withColumn("comments", F.filter("comments", lambda c: c["author"] != "")), AUTHOR, "bare")
    both = R.render_site_markdown(p, AUTHOR, "site", carry_count=True).join(bare.where("size(comments) > 0").select("url", "bare"), "url", "left")
    signed = A.comment_counts_in_text(both, "url", "bare").select("url", F.coalesce("comments_count", F.lit(0)).cast("bigint").alias("signed"))
    return A.comment_counts_in_text(both, "url", "site").select("url", F.col("comments_count").alias("site")).join(signed, "url")


@query(f"WITH {THREADS} SELECT url, turn, comment_no, author FROM threads")
def comments_numbered(t):
    return W.number_comments(V.threads(t)).select("url", "turn", "comment_no", "author")


@query(
    f"""WITH {THREADS} SELECT url, (comment_no - 1) // 3 AS chunk_no, count(*) AS n, string_agg(content, '|' ORDER BY comment_no) AS joined
    FROM threads GROUP BY 1, 2"""
)
def comments_collected(t):
    chunks = A.collect_comments(W.number_comments(V.threads(t)), chunk=3)
    return chunks.select(
        "url", "chunk_no", F.size("comments").cast("bigint").alias("n"), F.array_join("comments.content", "|").alias("joined")
    )


# ---- extraction from blog pages

MD = r"trim(regexp_replace(replace(replace({}, '*', '\*'), '_', '\_'), '[ \t]+', ' ', 'g'))"
PARAS = "array_to_string(list_filter(list_transform(lines, lambda x: trim(x)), lambda x: x <> ''), chr(10) || chr(10))"


@query(
    f"""WITH {POSTS} SELECT doc_id::VARCHAR AS post_id, url, {{clean}} AS title, author,
    CASE WHEN doc_id % 50 = 0 THEN '' ELSE iso END AS date, {PARAS} AS content, array_to_string(categories, '|') AS categories,
    comments_count, len(comments)::BIGINT AS n_comments, 'ok' AS status FROM posts""".replace(
        "{clean}", r"trim(regexp_replace(title, '\s+', ' ', 'g'))"
    )
)
def extract_posts(t):
    """Whole records from blog pages."""
    got = E.extract_posts(V.blog_pages(t))
    return got.select(
        "post_id", "url", "title", "author", "date", "content", F.array_join("categories", "|").alias("categories"),
        "comments_count", F.size("comments").cast("bigint").alias("n_comments"), "status",
    )


@query(
    f"""WITH {POSTS}, c AS (SELECT url, iso, generate_subscripts(comments, 1) AS i, unnest(comments) AS c FROM posts)
    SELECT url, i AS comment_no, c.id AS id, CASE WHEN c.author = '' THEN 'Guest' ELSE c.author END AS author, c.date AS date, {MD.format("c.content")} AS content,
    '<div class="body">' || replace(replace(replace(c.content, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</div>' AS content_html FROM c"""
)
def extract_comments(t):
    """Comment table keyed by post and ordinal."""
    got = E.extract_comments(V.blog_pages(t)).select("url", F.posexplode("comments").alias("pos", "c"))
    return got.select("url", (F.col("pos") + 1).cast("bigint").alias("comment_no"), "c.*")


@query(f"WITH {POSTS} SELECT url, doc_id::VARCHAR AS post_id FROM posts")
def extract_post_ids(t):
    return E.extract_post_id(V.blog_pages(t)).select("url", "post_id")


@query(f"WITH {POSTS} SELECT url, generate_subscripts(categories, 1) - 1 AS pos, unnest(categories) AS category FROM posts")
def extract_categories(t):
    got = E.extract_categories(V.blog_pages(t))
    return got.select("url", F.posexplode("categories").alias("pos", "category")).withColumn("pos", F.col("pos").cast("bigint"))


@query(
    f"""WITH {POSTS} SELECT url, CASE WHEN doc_id % 20 = 0 THEN 'failed' ELSE 'ok' END AS outcome FROM posts"""
)
def extraction_outcomes(t):
    """A page without a source is a failure and does not stop the others."""
    pages = V.blog_pages(t).withColumn("html", F.when(F.col("page_id") % 20 != 0, F.col("html")))
    parsed = materialise(E.extract_posts(pages).select("url", "status", "error"), "outcomes")
    ok, failed = E.split_outcome(parsed)
    return ok.select("url", F.lit("ok").alias("outcome")).unionByName(failed.select("url", F.lit("failed").alias("outcome")))
