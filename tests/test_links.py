"""Link rewriting over rows that share a key or have none."""

from folioworks.functions.urls import Site
from folioworks.operators.links import rewrite_links

SITE = Site(base_url="http://site.example", section="/blog/")


def test_rows_that_share_a_key_keep_their_own_links(spark):
    a, b, c = (f"http://site.example/blog/2011/{m}/1/{n}.html" for m, n in ((1, "a"), (2, "b"), (3, "c")))
    docs = spark.createDataFrame(
        [(a, "posts/a.md", f"to [b]({b}) end"), (a, "posts/a.md", f"to [c]({c}) end"), (None, "posts/n.md", f"x [b]({b})"),
         (None, "posts/n.md", f"x [b]({b})"), (b, "posts/b.md", "none"), (c, "posts/c.md", None)],
        "url string, file_path string, content string",
    )
    urls = spark.createDataFrame([(b, "posts/b.md"), (c, "posts/c.md")], "url string, file_path string")
    got = sorted((r.url or "", r.content or "") for r in rewrite_links(docs, urls, SITE).collect())
    texts = [t for _, t in got]
    assert len(got) == 6 and texts.count("x [b](b.md)") == 2
    assert [t for u, t in got if u == a] == ["to [b](b.md) end", "to [c](c.md) end"]
    assert [t for u, t in got if u in (b, c)] == ["none", ""]


def test_html_links_are_found_in_time(spark):
    """A look-behind tried at every character took about ten seconds a million characters and pass."""
    import time

    from pyspark.sql import functions as F

    goal = "http://site.example/blog/2011/2/1/b.html"
    text = "where the horse hears of the house, it has its /blogs " * 40_000
    forms = ((f'<a href="{goal}#c">', '<a href="b.html#c">'), (f"<a HREF = '{goal}'>", "<a HREF = 'b.html'>"), ("<a href=/blog/2011/2/1/b.html>", "<a href=b.html>"))
    forms += tuple((s, s) for s in (f'<a data-href="{goal}">', f'<a href="{goal}', f"{goal}", "href=/blog/gone.html>"))
    docs = spark.range(1).select(
        F.lit("x").alias("url"), F.lit("a.html").alias("file_path"), F.concat(F.repeat(F.lit(text), 1), F.lit("".join(s for s, _ in forms))).alias("content")
    )
    urls = spark.createDataFrame([(goal, "b.html")], "url string, file_path string")
    start = time.perf_counter()
    (got,) = rewrite_links(docs, urls, SITE, "html").collect()
    assert got.content == text + "".join(s for _, s in forms)
    assert time.perf_counter() - start < 12
