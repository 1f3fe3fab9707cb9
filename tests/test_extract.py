"""Selector extraction and Markdown on small hand-written pages."""

import pytest
from pyspark.sql import functions as F

from folioworks.operators import extract as E
from folioworks.operators.htmltree import compile_selector, parse, select, to_markdown
from folioworks.operators.markdown import html_to_markdown, space_text

PAGE = """<html><head><title>t</title></head><body>
<div class="journal-entry" id="item77">
 <div class="journal-entry-tag journal-entry-tag-post-title"><span class="posted-on">Thursday, March 31, 2011 at 16:23</span></div>
 <h2 class="title"><a href="#"> On "quotes"&nbsp; and   spaces </a></h2>
 <div class="body"><script>//<![CDATA[ x </p> //]]></script><p>First old.example line</p><ul><li>one</li><li>two</li></ul><p>Second</div>
 <div class="journal-entry-tag-post-body"><span class="posted-by"><a>Ann</a></span></div>
 <div class="journal-entry-tag-post-body-line2"><span class="posted-in"><span class="tag-element"><a>Tips</a></span>
 <span class="tag-element"><a> </a></span><span class="tag-element"><a>What's Next?</a></span><span class="tag-element"><a>Tips</a></span></span></div>
 <div class="post-comments"><a>2 Comments</a></div>
</div>
<div class="comment-wrapper"><div class="comment" id="comment5"><div class="body">Nice<br/>see old.example</div>
 <div class="signature">April 1, 2011 at 09:10 | Bob | B</div></div></div>
<div class="comment-wrapper"><div class="comment"><div class="signature">Guest</div></div></div>
</body></html>"""

BARE = "<html><body><div class='journal-entry'><h2 class='title'>no link</h2></div></body>"


@pytest.fixture(scope="module")
def posts(spark):
    pages = spark.createDataFrame(
        [(1, "http://site.example/blog/2011/3/31/a.html", PAGE), (2, "http://site.example/blog/b.html", BARE), (3, "u", None)],
        "page_id long, url string, html string",
    )
    got = E.extract_posts(pages, domains=("old.example", "new.example")).collect()
    return {r.page_id: r for r in got}


def test_full_record(posts):
    p = posts[1]
    assert (p.post_id, p.title, p.author, p.date) == ("77", 'On "quotes" and spaces', "Ann", "2011-03-31")
    assert p.categories == ["Tips", "What's Next?", "Tips"]
    assert p.comments_count == 2
    assert p.content == "First new.example line\n\nSecond\n\n- one\n\n- two"
    assert p.content_html.startswith('<div class="body"><script>') and "new.example" in p.content_html
    assert p.status == "ok" and p.error is None


def test_comments(posts):
    first, second = posts[1].comments
    assert (first.id, first.author, first.date) == ("5", "Bob | B", "2011-04-01")
    assert first.content == "Nice  \nsee new.example"
    assert first.content_html == '<div class="body">Nice<br/>see new.example</div>'
    assert tuple(second) == ("", "Guest", "", "", "")


def test_missing_parts_are_blank(posts):
    p = posts[2]
    assert (p.post_id, p.title, p.author, p.date, p.content, p.content_html) == (None, "", "", "", "", "")
    assert (p.categories, p.comments_count, p.comments) == ([], 0, [])


def test_unreadable_page_is_a_failure(posts):
    assert posts[3].status == "failed" and posts[3].error


def names(html, selector):
    return [n.attrs.get("id") for n in select(parse(html), compile_selector(selector))]


def test_selectors():
    html = '<div id=a class="x y"><p id=b class=x><i id=c data-k="v"></i></p></div><p id=d></p>'
    assert names(html, "p") == ["b", "d"]
    assert names(html, "div p") == ["b"]
    assert names(html, ".x.y") == ["a"]
    assert names(html, "div .x [data-k=v]") == ["c"]
    assert names(html, "#d, i") == ["c", "d"]
    assert names(html, "p i b") == []


def md(html, first=True):
    return to_markdown(parse(html), first)[0]


@pytest.mark.parametrize(
    "html, want",
    [
        ("<h2>A  b</h2>text", "## A b\n\ntext"),
        ("a <b>bold</b>, <em>it</em> and <code>x</code>", "a **bold**, *it* and `x`"),
        ('<a href="http://h.example/">go</a> <a href="http://h.example/">http://h.example/</a>', "[go](http://h.example/) <http://h.example/>"),
        ('<img src="i.png" alt="pic" title="T">', '![pic](i.png "T")'),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", "- a\n- b\n\n  - c"),
        ("<ol><li>a</li><li>b</li></ol>", "1. a\n2. b"),
        ("<blockquote>q<br>r</blockquote>", "> q  \n> r"),
        ("<table><tr><th>h<th>i<tr><td>1<td>2</table>", "| h | i |\n| --- | --- |\n| 1 | 2 |"),
        ("<pre>a\n  b</pre>", "```\na\n  b\n```"),
        ("one<hr>two", "one\n\n---\n\ntwo"),
        ("2*3_4", r"2\*3\_4"),
        ("x<style>p{}</style><script>y</script>z", "xz"),
    ],
)
def test_markdown_elements(html, want):
    assert md(html) == want


def test_paragraphs_come_first():
    html = "<h1>T</h1><p>a<p>b <i>c</i></p><script>d</script>"
    assert to_markdown(parse(html)) == ("a\n\nb c\n\n# T", True)
    assert md(html, first=False) == "# T\n\na\n\nb *c*"


def test_deep_nesting_does_not_overflow(spark):
    html = "<b>" * 3000 + "x" + "<p>tail"
    df = spark.createDataFrame([(html,)], "html string")
    assert html_to_markdown(df, "html").first().markdown.startswith("tail")


def test_spacing(spark):
    text = "a\n1. x\n2. y\n- z\nb\nOR\nc\n\n\n\nd"
    got = spark.range(1).select(space_text(F.lit(text))).first()[0]
    assert got == "a\n\n1. x\n\n2. y\n\n- z\nb\n\nOR\n\nc\n\nd"


INDEX = """<h3>Entries by Week</h3><ul><li><a href="/blog/w.html">w</a></li></ul>
<h3> Entries by Title </h3><div><ul><li><a href="/blog/2011/1/2/a.html"> A </a></li><li><a href="/blog/NaN/NaN/NaN/n.html">N</a></li>
<li><a href="/about">x</a></li><li><a href="/blog/2011/1/2/a.html">again</a></li></ul></div><h3>Z</h3><ul><li><a href="/blog/z.html">z</a></li></ul>"""


def test_manifest(spark):
    from folioworks.functions.urls import Site
    from folioworks.plans.archive import build_manifest

    pages = spark.createDataFrame([(0, "http://site.example/blog-archive/", INDEX)], "page_id long, url string, html string")
    good, bad = build_manifest(pages, Site(), "Entries by Title")
    assert [tuple(r)[:3] for r in good.collect()] == [("http://site.example/blog/2011/1/2/a.html", "/blog/2011/1/2/a.html", "A")]
    assert [r.href for r in bad.collect()] == ["/blog/NaN/NaN/NaN/n.html"]
    none, _ = build_manifest(pages, Site(), "No such section")
    assert none.count() == 0


def test_plain_tags_build_the_tree_of_the_standard_parser(monkeypatch):
    import re

    from folioworks.operators import htmltree

    pages = (
        '<DIV class="a b a"><p id="x">1<p>2</P><br><img src="u"/>&amp;<a href="?a=1&amp;b">t</a></div></div>z',
        '<script>if (a < b) "<p>"</script><style><b></style><title>a<b>c</title><textarea><p></textarea><p  class="q">',
        "<ul><li>1<li>2<ul><li>3</ul></ul><table><tr><td>a<td>b</table><p a=\"1\" a=\"2\">x</p ><b/>y</x>",
        '<a href="1\n2" title="<">k</a><p class="">e</p><',
    )

    def seen():
        built = [htmltree.Page(p) for p in pages]
        return [(b.root.html(), {k: [n.html() for n in v] for k, v in b.lists.items()}) for b in built]

    fast = seen()
    never = re.compile("(?!)")
    monkeypatch.setattr(htmltree, "PLAIN_OPEN", never)
    monkeypatch.setattr(htmltree, "PLAIN_CLOSE", never)
    assert fast == seen()


def test_section_links_are_found_once(spark):
    """The page is read once for its links, and not again for each use of a step."""
    page = '<h3>A</h3><ul><li><a href="/z">z</a></ul><h3 x> B </h3><div><ul><li><a href="/blog/a?x=1&copy=2">1 &lt; 2 &amp;copy</a><ul><li><a href=\'/b\'>&#60;&Eacute&nosuch;</a></ul></ul></div>'
    pages = spark.createDataFrame([(1, "http://s.example/i/", page), (2, "u", None), (3, "u", "<h3>C</h3>")], "page_id long, url string, html string")
    links = E.extract_links(pages, "B")
    got = [(r.page_id, r.pos, r.href, r.title) for r in links.orderBy("pos").collect()]
    assert got == [(1, 0, "/blog/a?x=1&copy=2", "1 < 2 &copy"), (1, 1, "/b", "<\u00c9&nosuch;")]
    plan = links._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and plan.count("regexp_replace(html") == 1
