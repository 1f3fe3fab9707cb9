"""Queries over the page table: links, fields, paragraphs, Markdown."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioworks.functions import html as H
from folioworks.functions import text as X
from folioworks.functions.urls import relative_url
from folioworks.operators import aggregates as A
from folioworks.operators import extract as E
from folioworks.operators import filters as P
from folioworks.operators import links as L
from folioworks.operators import ordering as O
from folioworks.operators import joins as J
from folioworks.operators import windows as W
from folioworks.operators.markdown import html_to_markdown
from folioworks.plans.registry import Tables, query
from folioworks.sources.readers import scan_pages

# ---- SQL pieces

NOISE = (
    r"regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b[^>]*>.*?</script\s*>', '', 'g'), "
    r"'(?s)//\s*<!\s*\[CDATA\[.*?\]\]>\s*//?', '', 'g'), '(?s)<!\[CDATA\[.*?\]\]>', '', 'g')"
)
VISIBLE = rf"regexp_replace({NOISE}, '(?is)<style\b[^>]*>.*?</style\s*>|<!--.*?-->', '', 'g')"


def unescaped(x: str) -> str:
    """The entities that the pages use; ``&amp;`` last, so that nothing is decoded twice."""
    known = {"lt": 60, "gt": 62, "quot": 34, "#39": 39, "apos": 39, "nbsp": 160, "copy": 169, "middot": 183, "mdash": 8212, "amp": 38}
    for name, code in known.items():
        x = f"replace({x}, '&{name};', chr({code}))"
    return x


def stripped(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def tagless(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]*>', '', 'g')"


def clean(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


LINKS = rf"""
anchors AS (
  SELECT page_id, url,
    regexp_extract_all({NOISE}, '(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"[^>]*>(.*?)</a\s*>', 1) AS hs,
    regexp_extract_all({NOISE}, '(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"[^>]*>(.*?)</a\s*>', 2) AS ts
  FROM pages),
links0 AS (SELECT page_id, url, generate_subscripts(hs, 1) - 1 AS pos, unnest(hs) AS h, unnest(ts) AS t FROM anchors),
links AS (
  SELECT page_id, url, pos, {unescaped("h")} AS href, {stripped(unescaped(tagless("t")))} AS title,
    regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) || h AS target
  FROM links0)
"""

# What ends an open paragraph, stated here on its own.
P_STOP = (
    r"(?is)<(/(p|td|li|div|main|body|html|article|section|blockquote)"
    r"|(h[1-6]|hr|ul|ol|dl|pre|div|nav|form|table|footer|article|section|blockquote)\b).*$"
)
PARAS = rf"""
paras AS (
  SELECT page_id, list_filter(list_transform(
    string_split_regex({VISIBLE}, '(?i)<p(?:\s[^>]*)?>')[2:],
    lambda x: {stripped(unescaped(tagless("regexp_replace(x, '" + P_STOP + "', '')")))}), lambda x: x <> '') AS ps
  FROM pages)
"""

TITLE = clean(unescaped(tagless(r"regexp_extract(html, '(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>', 1)")))
H1 = clean(unescaped(tagless(r"regexp_extract(html, '(?is)<h1(?:\s[^>]*)?>(.*?)</h1\s*>', 1)")))


def links(t: Tables):
    return E.extract_links(t.pages)


@query("SELECT page_id, url, length(html) AS n_chars FROM pages")
def page_scan(t):
    return scan_pages(t.spark, f"{t.folder}/pages.parquet").select(
        "page_id", "url", F.length("html").cast("bigint").alias("n_chars")
    )


@query(f"WITH {LINKS} SELECT page_id, pos, href, title FROM links")
def page_links(t):
    return links(t).select("page_id", F.col("pos").cast("bigint").alias("pos"), "href", "title")


@query(f"WITH {LINKS} SELECT page_id, pos, href, title FROM links")
def page_links_any_quoting(t):
    """Pages whose targets stand in double quotes, single quotes or none give the links of the pages as they are."""
    ways = F.when(F.col("page_id") % 3 == 0, F.lit('HREF = "$1"')).when(F.col("page_id") % 3 == 1, "href='$1'").otherwise("href=$1")
    quoted = t.pages.withColumn("html", F.regexp_replace("html", F.lit('href="([^"]*)"'), ways))
    return E.extract_links(quoted).select("page_id", F.col("pos").cast("bigint").alias("pos"), "href", "title")


@query(f"WITH {LINKS} SELECT page_id, pos, href FROM links")
def nested_list_links(t):
    """All links of a section's list, those in lists inside it too; the list after it is left out."""
    items = F.transform(H.hrefs("html"), lambda h: F.concat(F.lit('<li><a href="'), h, F.lit('">x</a></li>')))
    inner = F.array_join(F.slice(items, 2, 1 << 30), "</ul></li><li><ul>")
    page = F.concat(
        F.lit('<ul><li><a href="/before">x</a></ul><h3>Here</h3><div><ul>'), F.coalesce(F.get(items, F.lit(0)), F.lit("")),
        F.lit("<li><UL class='in'>"), inner, F.lit('</ul></li></ul></div><ul><li><a href="/after">x</a></li></ul>'),
    )
    got = E.extract_links(t.pages.select("page_id", "url", page.alias("html")), "Here")
    return got.select("page_id", F.col("pos").cast("bigint").alias("pos"), "href")


@query(
    f"""WITH {LINKS} SELECT page_id, pos, CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href
    ELSE '/base/' || ltrim(href, '/') END AS link FROM links"""
)
def page_links_behind_base(t):
    return links(t).select("page_id", F.col("pos").cast("bigint").alias("pos"), relative_url("href", "/base/").alias("link"))


@query(f"WITH {LINKS} SELECT page_id, pos, target FROM links")
def page_links_resolved(t):
    return links(t).select("page_id", F.col("pos").cast("bigint").alias("pos"), "target")


@query(f"WITH {LINKS} SELECT page_id, pos, href FROM links WHERE href LIKE '/th%'")
def internal_page_links(t):
    return P.internal_links(links(t), "/th").select("page_id", F.col("pos").cast("bigint").alias("pos"), "href")


@query(
    f"""WITH {LINKS} SELECT href, page_id, pos, title FROM
    (SELECT *, row_number() OVER (PARTITION BY href ORDER BY page_id, pos) AS rn FROM links) WHERE rn = 1"""
)
def unique_links_first_seen(t):
    rows = links(t).select("href", "page_id", F.col("pos").cast("bigint").alias("pos"), "title")
    return W.first_seen(rows, "href", ["page_id", "pos"])


@query(f"WITH {LINKS} SELECT DISTINCT href AS url FROM links")
def distinct_link_urls(t):
    return J.distinct_urls(links(t).select(F.col("href").alias("url")))


def host_report(pages):
    """Links -> absolute form -> first occurrence -> links per host."""
    found = E.extract_links(E.strip_noise(pages, "html")).select("target", "page_id", "pos")
    return A.links_per_host(W.first_seen(found, "target", ["page_id", "pos"]))


@query(
    f"""WITH {LINKS} SELECT lower(regexp_extract(target, '^[a-zA-Z]+://([^/?#]*)', 1)) AS host,
    count(*) AS links, min(target) AS first_target FROM (SELECT DISTINCT target FROM links) GROUP BY 1"""
)
def links_per_host(t):
    return host_report(t.pages)


@query(f"WITH {LINKS} SELECT page_id, pos, href, substr(title, 1, 50) AS title FROM links ORDER BY page_id, pos LIMIT 5")
def link_sample(t):
    rows = links(t).select("page_id", F.col("pos").cast("bigint").alias("pos"), "href", "title")
    return O.sample_rows(rows, 5)


@query(
    rf"""WITH {LINKS}, c AS (SELECT page_id, url,
      regexp_extract_all({NOISE}, '(?i)\s(href|src)\s*=\s*"([^"]*)"', 1) AS a,
      regexp_extract_all({NOISE}, '(?i)\s(href|src)\s*=\s*"([^"]*)"', 2) AS v FROM pages),
    d AS (SELECT page_id, url, generate_subscripts(a, 1) - 1 AS pos, lower(unnest(a)) AS attr, unnest(v) AS raw FROM c)
    SELECT page_id, pos, attr, raw, CASE WHEN NOT regexp_matches(raw, '^([a-zA-Z][a-zA-Z0-9+.-]*:|//)') THEN 'relative'
      WHEN regexp_extract(raw, '//([^/?#]*)', 1) = regexp_extract(url, '//([^/?#]*)', 1) THEN 'internal' ELSE 'external' END AS kind,
      regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) || raw AS absolute FROM d"""
)
def page_classified_links(t):
    return L.classify_links(t.pages).withColumn("pos", F.col("pos").cast("bigint"))


@query(f"SELECT page_id, {TITLE} AS title, {H1} AS h1, regexp_extract(html, '<html lang=\"([^\"]*)\"', 1) AS lang FROM pages")
def page_titles(t):
    return t.pages.select(
        "page_id", H.tag_text("html", "title").alias("title"), H.tag_text("html", "h1").alias("h1"),
        H.tag_attr("html", "html", "lang").alias("lang"),
    )


@query(
    f"""WITH {PARAS}, {LINKS} SELECT p.page_id, {TITLE} AS title, {H1} AS h1, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
    len(ps) AS n_paragraphs, ps[1] AS first_paragraph, (SELECT count(*) FROM links l WHERE l.page_id = p.page_id) AS n_links
    FROM pages p JOIN paras USING (page_id)"""
)
def page_fields(t):
    """One parse per page serves every selector."""
    fields = {
        "title": ("head title", "text"),
        "h1": ("article h1", "text"),
        "lang": ("html[lang]", "attr:lang"),
        "paragraphs": ("article p", "texts"),
        "links": ("nav li a[href]", {"href": (None, "attr:href"), "title": (None, "text")}),
    }
    got = E.select_html(t.pages, fields)
    texts = F.filter(F.transform("paragraphs", X.strip_ws), lambda x: x != "")
    return got.select(
        "page_id", X.clean_text("title").alias("title"), X.clean_text("h1").alias("h1"), "lang",
        F.size(texts).cast("bigint").alias("n_paragraphs"), F.get(texts, 0).alias("first_paragraph"),
        F.size("links").cast("bigint").alias("n_links"),
    )


@query(f"SELECT page_id, {H1} AS value FROM pages")
def page_field_by_selector(t):
    return E.extract_field(t.pages, "article h1").select("page_id", "value")


@query(f"WITH {PARAS} SELECT page_id, generate_subscripts(ps, 1) - 1 AS pos, unnest(ps) AS text FROM paras")
def page_paragraphs(t):
    return E.extract_paragraphs(t.pages).withColumn("pos", F.col("pos").cast("bigint"))


@query(f"WITH {PARAS} SELECT page_id, array_to_string(ps, chr(10) || chr(10)) AS text FROM paras")
def page_text(t):
    return E.join_paragraphs(t.pages)


@query(f"SELECT page_id, length({NOISE}) AS n_chars, md5({NOISE}) AS digest FROM pages")
def page_noise_stripped(t):
    return E.strip_noise(t.pages, "html").select(
        "page_id", F.length("html").cast("bigint").alias("n_chars"), F.md5("html").alias("digest")
    )


MD_ESCAPED_H1 = rf"replace(replace({H1}, '*', '\*'), '_', '\_')"


@query(
    f"""WITH {PARAS} SELECT page_id, array_to_string(list_concat(ps, ['# ' || {MD_ESCAPED_H1}]), chr(10) || chr(10)) AS markdown
    FROM pages JOIN paras USING (page_id)"""
)
def page_markdown(t):
    """Article body: paragraph texts first, then what is left."""
    body = t.pages.select("page_id", H.article_of("html").alias("body"))
    return html_to_markdown(body, "body").select("page_id", "markdown")


SHOWN = tagless("regexp_replace(x, '" + P_STOP + "', '')")
BOLD = rf"""
bold AS (
  SELECT page_id, list_filter(list_transform(
    string_split_regex({VISIBLE}, '(?i)<p(?:\s[^>]*)?>')[2:],
    lambda x: CASE WHEN x LIKE '<b>%' THEN '**' ELSE '' END ||
      replace(replace({stripped(unescaped(SHOWN))}, '*', '\*'), '_', '\_') ||
      CASE WHEN x LIKE '<b>%' THEN '**' ELSE '' END), lambda x: x <> '' AND x <> '****') AS ps
  FROM pages)
"""


@query(
    f"""WITH {BOLD} SELECT page_id, '# ' || {MD_ESCAPED_H1} || chr(10) || chr(10) ||
    array_to_string(ps, chr(10) || chr(10)) AS markdown FROM pages JOIN bold USING (page_id)"""
)
def page_markdown_in_order(t):
    body = t.pages.select("page_id", H.article_of("html").alias("body"))
    return html_to_markdown(body, "body", mode="document_order").select("page_id", "markdown")
