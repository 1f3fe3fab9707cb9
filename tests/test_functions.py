"""Column functions against plain Python."""

import os.path
import re
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from folioworks.functions import dates as D
from folioworks.functions import html as H
from folioworks.functions import text as X
from folioworks.functions import urls as U

SITE = U.Site()


def column(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def test_clean_text(spark):
    values = ["  a \t b\n\nc ", "a  b", "", None, "x  y   z", " lead", " \n ", "plain words stay"]
    want = [re.sub(r"\s+", " ", (v or "").strip()) for v in values]
    assert column(spark, values, X.clean_text) == want


def test_clean_text_keeps_breaks(spark):
    def plain(t):
        t = re.sub(r"[ \t]+", " ", t or "")
        return re.sub(r"\n\s*\n\s*\n+", "\n\n", t).strip()

    values = ["a  b\n\n\n\nc", "a\n \n\n \nb\t\tc", "\n\na\nb\n", "", None, "a\n\nb"]
    assert column(spark, values, lambda c: X.clean_text(c, preserve_formatting=True)) == [plain(v) for v in values]


def test_parse_count(spark):
    assert column(spark, ["12 Comments", "none", "", "a 7 b 9", None], X.parse_count) == [12, 0, 0, 7, 0]


def test_signature(spark):
    values = ["May 1, 2011 at 19:28 | Ann B | C", "Ann only", "", "a |b", " | Ann"]
    got = [tuple(r) for r in column(spark, values, X.parse_signature)]
    assert got == [("May 1, 2011 at 19:28", "Ann B | C"), ("", "Ann only"), ("", ""), ("", "a |b"), ("", "Ann")]


DATES = {
    "Wednesday, October 16, 2013 at 14:55": "2013-10-16",
    "march 3, 2011 at 19:28": "2011-03-03",
    "March 31, 2011": "2011-03-31",
    "2016-2-3": "2016-02-03",
    "2016-02-03": "2016-02-03",
    "February 30, 2011": "February 30, 2011",
    "Funday, May 1, 2011": "Funday, May 1, 2011",
    "Monday, Foo 1, 2011": "Monday, Foo 1, 2011",
    "2016-13-03": "2016-13-03",
    "soon at noon": "soon at noon",
    "": "",
}


def test_archive_dates(spark):
    assert column(spark, list(DATES), D.parse_archive_date) == list(DATES.values())


def test_date_labels(spark):
    assert column(spark, ["2011-03-01", "x"], D.long_date) == ["March 1, 2011", None]
    assert column(spark, ["2011-03-01", ""], D.xml_date) == ["2011-03-01T00:00:00+00:00", None]
    assert column(spark, ["2011-03"], D.month_label) == ["Mar 2011"]


HREFS = (
    "/blog/a.html", "//cdn.example/x.js", "https://o.example/y", "mailto:a@b.example", "#top", "?q=1", "", "c.html",
    "../up.html", "./here.html", "../../../too/far", "a/./b/../c", "/x/../y/", "..", ".", "d/?q=/../z", "/a/b/.",
)
BASES = ("http://site.example/blog/2011/1/post.html?x=1#f", "http://site.example", "https://site.example/dir/")


@pytest.mark.parametrize("base", BASES)
def test_resolve_url_like_urljoin(spark, base):
    got = column(spark, list(HREFS), lambda c: U.resolve_url(F.lit(base), c))
    assert dict(zip(HREFS, got)) == {h: urljoin(base, h) for h in HREFS}


def test_normalise_url(spark):
    values = [
        "http://site.example/blog/a.html#c1", "https://www.site.example/blog/a.html", "/blog/a.html", "//site.example/blog/a.html",
        "http://www.site.example", "http://site.example.evil/blog/a.html", "http://other.example/blog/#x",
    ]
    assert column(spark, values, lambda c: U.normalise_url(c, SITE)) == [
        "http://site.example/blog/a.html"] * 4 + [
        "http://site.example", "http://site.example.evil/blog/a.html", "http://other.example/blog/"]


def test_relative_path_like_relpath(spark):
    paths = ["a.md", "_posts/a.md", "_posts/b.md", "posts/2011/1/2/x/content.md", "posts/2011/1/3/y/content.md", "posts/2012/z.md"]
    pairs = [(t, c) for t in paths for c in paths]
    df = spark.createDataFrame(pairs, "t string, c string")
    for row in df.select("t", "c", U.relative_path("t", "c").alias("r")).collect():
        assert row.r == os.path.relpath(row.t, os.path.dirname(row.c) or ".")


def test_file_paths(spark):
    urls = [
        "http://site.example/blog/2016/3/30/post-slug.html", "http://site.example/blog/2016/12/1/a_b-c.html",
        "http://site.example/blog/just-do.html", "http://site.example/blog/2016/3/x.html",
    ]
    assert column(spark, urls, U.post_file_path) == [
        "_posts/2016-03-30-post-slug.md", "_posts/2016-12-01-a_b-c.md", "_posts/misc-just-do.md", "_posts/misc-x.md"]
    assert column(spark, urls[:1], U.post_archive_path) == ["posts/2016/3/30/post-slug"]


def test_site_url_needs_a_numeric_date(spark):
    files = ["_posts/2016-03-30-post-slug.md", "_posts/misc-a-b-c-d.md", "_posts/short.md"]
    assert column(spark, files, U.site_url) == [
        "/archive/2016/03/30/post-slug/", "/archive/misc-a-b-c-d/", "/archive/short/"]


def test_list_literal_like_python(spark):
    lists = [["a", "b"], ["What's Next?"], [], ['say "hi"', "it's \"x\""], ["a, b"], ["back\\slash"]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, v array<string>")
    lit = X.list_literal("v")
    back = X.parse_list_literal(F.regexp_extract(lit, r"(?s)^\[(.*)\]$", 1))
    for row in df.select("v", lit.alias("lit"), back.alias("back")).collect():
        assert row.lit == repr(row.v)
        assert row.back == row.v


def test_escape_html(spark):
    text = """a & <b> "c" 'd'"""
    assert column(spark, [text], X.escape_html) == ["a &amp; &lt;b&gt; &quot;c&quot; &#39;d&#39;"]
    assert column(spark, [text], lambda c: X.unescape_html(X.escape_html(c))) == [text]


def test_unescape_html_like_python(spark):
    import html

    values = ["a &amp;lt; b", "cut&amp", "&lt;p&gt &quot;x&quot; &#39;y&apos;", "&copy;&middot;&nbsp;.", "no & entity",
              "a &mdash; b &hellip;&rsquo;&#8217;&#x2019;&copy2 &notit; &#128; &#0; &#xFFFFFFFFFFFF; &nosuch; &#; &", "", None]
    assert column(spark, values, X.unescape_html) == [v and html.unescape(v) for v in values]


def test_links_in_any_quoting(spark):
    from folioworks.functions import html as H

    page = (
        """<a href='/a'>A</a><a class=x href=/b>B</a><a data-href="no" href="/c?x=1&copy=2&lt=3&amp;d=4">C</a>"""
        "<a HREF = /d>D</a> src = prose <img src=i.png>"
    )
    want = ["/a", "/b", "/c?x=1&copy=2&lt=3&d=4", "/d"]
    assert [a.href for a in column(spark, [page], H.anchors)[0]] == want
    assert [(a.attr, a.raw) for a in column(spark, [page], H.link_attrs)[0]] == [*(("href", w) for w in want), ("src", "i.png")]


def test_first_list_with_lists_inside(spark):
    from folioworks.functions import html as H

    pages = ["</ul>x<ul>1<ul>2</ul>3</ul>4<ul>5</ul>", "<UL class=a>1<ul>2", "none", "", None]
    assert column(spark, pages, H.first_list) == ["<ul>1<ul>2</ul>3", "<UL class=a>1<ul>2", "", "", ""]


def test_large_odd_pages_are_read_in_linear_time():
    import time

    from folioworks.operators.htmltree import parse, to_markdown

    began = time.process_time()
    parse("<div>" * 60_000)
    to_markdown(parse("<p>x</p>" * 50_000))
    assert time.process_time() - began < 10


def test_paragraphs(spark):
    html = '<script>var t="</p>";</script><article><p> <b>one<br><p>two &amp; 2</p><p> </p><p>three<ul><li>x</li></ul></article>'
    assert column(spark, [html], H.paragraphs) == [["one", "two & 2", "three"]]


def test_noise(spark):
    values = [
        "a<SCRIPT type=x>var t='</p>';\n</script>b", "a//<![CDATA[\nx\n//]]>//b", "a<![CDATA[ x ]]>b", "plain",
        "a// <! [CDATA[x]]> //b", "<scripted>kept</scripted>",
    ]
    assert column(spark, values, X.strip_noise_text) == ["ab", "ab", "ab", "plain", "ab", "<scripted>kept</scripted>"]


def test_relative_url(spark):
    values = ["/a/b", "a", "http://x.example/"]
    assert column(spark, values, lambda c: U.relative_url(c, "/base/")) == ["/base/a/b", "/base/a", "http://x.example/"]
    assert column(spark, values[:2], U.relative_url) == ["/a/b", "/a"]


def test_record_json_and_stamp(spark):
    df = spark.createDataFrame([("u", None, ["a"])], "url string, title string, categories array<string>")
    packed = X.to_record_json(df)
    assert packed.first().record == '{"url":"u","title":null,"categories":["a"]}'
    assert X.from_record_json(packed, "url string, title string, categories array<string>").first() == df.first()
    assert re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", D.stamp(df, "at", text=True).first()["at"])


def test_article_of(spark):
    pages = ['<p>a</p><article class="x"\n id=y><p>b</p></article ><p>c</p>', "<ARTICLE>b</ARTICLE><article>c</article>",
             "<articles>no</articles><p>whole</p>", "<article>open", "", None]
    got = spark.createDataFrame(list(enumerate(pages)), "i int, html string").orderBy("i").select(H.article_of("html").alias("x")).collect()
    assert [r.x for r in got] == ['<article class="x"\n id=y><p>b</p></article >', "<ARTICLE>b</ARTICLE>", *pages[2:]]
