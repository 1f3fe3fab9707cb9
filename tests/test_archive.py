"""Rendering, front matter, link rewriting, windows, files and streams."""

import itertools
import json

import pytest
from pyspark.sql import functions as F

from folioworks.functions.urls import Site, post_archive_path, post_file_path
from folioworks.operators import aggregates as A
from folioworks.operators import links as L
from folioworks.operators import qa as Q
from folioworks.operators import render as R
from folioworks.operators import windows as W
from folioworks.operators.frontmatter import parse_front_matter
from folioworks.operators.joins import url_map
from folioworks.plans.archive import local_archive, rebuild_index
from folioworks.sources import readers, writers
from folioworks.streaming import incremental as S

SITE = Site()
COMMENTS = "array<struct<id: string, author: string, date: string, content: string>>"
SHAPE = f"url string, title string, author string, date string, categories array<string>, content string, comments_count long, comments {COMMENTS}"

NASTY = ['"X" and "Y"', 'tail\\', "it's: a - b", "", '\\"', "# no", "---", "ünï", "a\\\"b"]


@pytest.fixture(scope="module")
def posts(spark):
    data = [
        (
            f"http://site.example/blog/2011/{i + 1}/2/p{i}.html" if i % 3 else f"http://site.example/blog/p{i}.html",
            title,
            "" if i % 2 else "Ann",
            "" if i == 4 else f"2011-0{i + 1}-02",
            [[], ["What's Next?", "a, b"], ["x"]][i % 3],
            f"Body {i} with [link](http://www.site.example/blog/2011/2/2/p1.html#c2) and [gone](/blog/none.html).",
            2,
            [("1", "Bob", "2011-01-01", "hi"), ("2", "", "", "")][: i % 3],
        )
        for i, title in enumerate(NASTY)
    ]
    df = spark.createDataFrame(data, SHAPE)
    return df.withColumns({"file_path": post_file_path("url", SITE), "archive_path": post_archive_path("url", SITE)})


def test_post_layout(posts):
    text = R.render_post_markdown(posts.where("title = '---'")).first().markdown
    assert text.startswith("# ---\n\n**Author:** Ann\n**Date:** 2011-07-02\n**URL:** ")
    text = R.render_post_markdown(posts.where("title like 'it%'")).first().markdown
    assert text.endswith(
        "\n\n## Comments (2)\n\n### Comment 1\n**Author:** Bob\n**Date:** 2011-01-01\n\nhi\n\n---\n\n"
        "### Comment 2\n**Author:** \n**Date:** \n\n\n\n---\n\n"
    )


def test_site_layout(posts):
    text = R.render_site_markdown(posts.where("title like 'it%'"), "Site").first().markdown
    head, body = text.split("layout: post\n---\n\n")
    assert head.startswith('---\ntitle: "it\'s: a - b"\nauthor: "Ann"\ndate: 2011-03-02\ncategories: [\'x\']\noriginal_url: "http')
    assert body.endswith("\n\n\n## Comments\n\n---\n\n**Author:** Bob\n**Date:** 2011-01-01\n\nhi\n\n---\n\n\n\n---\n")


def test_front_matter_roundtrip(posts):
    files = R.render_site_markdown(posts, "Site", "text")
    got = {r.original_url: r for r in parse_front_matter(files, "Site").collect()}
    for p in posts.collect():
        r = got[p.url]
        assert r.title == (p.title or "Untitled")
        assert r.author == (p.author or "Site")
        assert r.categories == p.categories
        dated = p.url.count("/") > 4
        assert r.date == (p.date or ("2011-05-02" if dated else ""))


def test_front_matter_shapes(spark):
    texts = [
        "---\ntitle: Bare title \ndate: \"2011-02-03\"\n---\nbody", "no front matter", "---\nauthor: \"A\"\n---\n",
        "---\ntitle: \"T\"\ncategories: [\"What's Next?\", 'b', c]\n---\n",
    ]
    df = spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "file_path string, text string")
    got = {r.file_path: r for r in parse_front_matter(df, "Default").collect()}
    assert set(got) == {"f0", "f2", "f3"}
    assert (got["f0"].title, got["f0"].date, got["f0"].author) == ("Bare title", "2011-02-03", "Default")
    assert got["f2"].title == "Untitled"
    assert got["f3"].categories == ["What's Next?", "b", "c"]


def test_rewrite_links_and_again(posts):
    paths = url_map(posts, file_path=F.col("file_path"))
    once = L.rewrite_markdown_links(posts, paths, SITE)
    for r in once.collect():
        assert "[link](2011-02-02-p1.md#c2) and [gone](/blog/none.html)." in r.content
    twice = L.rewrite_markdown_links(once, paths, SITE)
    assert sorted(r.content for r in twice.collect()) == sorted(r.content for r in once.collect())


def test_rewrite_keeps_documents_without_links(spark, posts):
    plain = spark.createDataFrame([("u1", "f", "no links"), ("u2", "f", None)], "url string, file_path string, content string")
    got = L.rewrite_markdown_links(plain, url_map(posts, file_path=F.col("file_path")), SITE).collect()
    assert {(r.url, r.content) for r in got} == {("u1", "no links"), ("u2", None)}


def test_local_archive(posts):
    stored = posts.drop("file_path", "archive_path").withColumn(
        "raw_html", F.concat(F.lit('<a href="http://site.example/blog/2011/2/2/p1.html">x</a>'), F.lit("<p>"))
    )
    out = local_archive(stored, SITE, "Archive")
    html = {r.url: r.raw_html for r in out.html.collect()}
    assert html["http://site.example/blog/2011/3/2/p2.html"] == '<a href="../../../2/2/p1/raw.html">x</a><p>'
    assert html["http://site.example/blog/p0.html"] == '<a href="../2011/2/2/p1/raw.html">x</a><p>'
    lines = [r.line for r in out.month_page.orderBy("place", F.desc("month"), "part", "date", "url").collect()]
    assert "Date Range: 2011-02 to 2011-09" in lines[0] and lines[1] == "    <h2>Sep 2011 (1 posts)</h2>"
    assert lines[-1] == "</body>\n</html>"
    assert out.master_index.first().date == "2011-09-02"


def test_month_page_escapes_what_it_shows(spark):
    row = ("2011-02", "2011-02-02", "u", """<b> & "c" 'd'</b>""", "/2011/2/a&b", 2)
    posts = spark.createDataFrame([row], "month string, date string, url string, title string, archive_path string, comments_count int")
    opening, _, block, _ = (r.line for r in R.month_page(posts, "A <&> B").orderBy("place", "part").collect())
    assert "<title>A &lt;&amp;&gt; B</title>" in opening and "<h1>A &lt;&amp;&gt; B</h1>" in opening
    assert '<div class="post-title">&lt;b&gt; &amp; &quot;c&quot; &#39;d&#39;&lt;/b&gt;</div>' in block
    assert 'href="/2011/2/a&amp;b/raw.html"' in block and 'href="/2011/2/a&amp;b/content.md"' in block and "(2 comments)" in block


def test_prefix_scan_equals_plain_counting(spark):
    data = [("hot" if i % 3 else None, i * 7 % 1000, i, i % 5 == 0) for i in range(1000)]
    df = spark.createDataFrame(data, "g string, t long, i long, bad boolean")
    got = W.prefix_scan(df, ["g"], ["t", "i"], F.floor(F.col("t") / 10), {"bads": F.col("bad").cast("int")}, "pos", "n").collect()
    assert len(got) == 1000
    for g, part in itertools.groupby(sorted(data, key=lambda r: (str(r[0]), r[1], r[2])), key=lambda r: r[0]):
        part = list(part)
        want, bads = {}, 0
        for pos, row in enumerate(part, 1):
            bads += row[3]
            want[row[2]] = (pos, len(part), bads)
        assert {r.i: (r.pos, r.n, r.bads) for r in got if r.g == g} == want


def test_positions_within_one_instant(spark):
    """A burst at one instant is numbered by the rest of the order."""
    df = spark.range(500).selectExpr("'r' AS run", "timestamp'2024-01-01' AS ts", "id AS event_id")
    got = W.positions(df)
    assert all(r.seq == r.event_id + 1 and r.run_size == 500 for r in got.collect())


def test_one_instant_spreads_over_ranges(spark):
    """Ranges follow the rows, not the clock: a burst is cut like any other run, and a range may end one run and begin the next."""
    df = spark.range(20_000).selectExpr("if(id < 100, null, if(id < 200, 'a', 'r')) AS run", "timestamp'2024-01-01' AS ts", "id AS event_id")
    cut = W.ranged(df, ["run"], ["ts", "event_id"], ranges=16)
    sizes = [r["count"] for r in cut.groupBy("_range").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 5_000
    got = W.positions(df, ranges=16)
    assert got.columns == ["run", "ts", "event_id", "seq", "run_size"]
    starts = {None: (0, 100), "a": (100, 100), "r": (200, 19_800)}
    rows = got.collect()
    assert len(rows) == 20_000 and all((r.event_id - r.seq + 1, r.run_size) == starts[r.run] for r in rows)
    assert W.positions(df.where("false")).count() == 0


def test_first_seen_on_a_hot_key(spark):
    df = spark.createDataFrame([("u" if i % 3 else f"v{i}", 100 - i, i) for i in range(100)], "url string, page_id long, pos long")
    got = {r.url: r.page_id for r in W.first_seen(df).collect()}
    assert got["u"] == 2 and len(got) == 35


def test_collect_comments_is_bounded_and_whole(spark):
    df = spark.createDataFrame([("hot", i, f"c{i}") for i in range(1, 251)], "url string, comment_no long, content string")
    got = A.collect_comments(df, chunk=100).orderBy("chunk_no").collect()
    assert [len(r.comments) for r in got] == [100, 100, 50]
    assert [c.content for r in got for c in r.comments] == [f"c{i}" for i in range(1, 251)]


def test_segments_join_to_the_whole_text(posts):
    posts = posts.withColumn("comments", F.transform("comments", lambda c: c))
    comments = posts.select("url", F.posexplode("comments").alias("p", "c")).select("url", (F.col("p") + 1).cast("long").alias("comment_no"), "c.*")
    for layout, whole in (("post", R.render_post_markdown(posts)), ("site", R.render_site_markdown(posts, "Site"))):
        parts = R.render_segments(posts, comments, layout, "Site", chunk=1).collect()
        for r in whole.collect():
            text = "".join(s.markdown for s in sorted((s for s in parts if s.url == r.url), key=lambda s: s.seg_no))
            assert text == r.markdown


def test_summary_and_counts_when_empty(spark, posts):
    log = spark.createDataFrame([], "status string")
    assert A.run_summary(log).first().success_rate == "N/A"
    assert A.archive_range(posts.where("false").withColumn("month", F.lit("x"))).first().date_range == "N/A"


def test_reconcile(spark):
    index = spark.createDataFrame([("a",), ("b",), ("b",)], "file_path string")
    files = spark.createDataFrame([("b",), ("c",)], "file_path string")
    got = {r.file_path: r.status for r in Q.reconcile(index, files).collect()}
    assert got == {"a": "missing_file", "b": "repeated", "c": "not_indexed"}


# ---- files


def test_manifest_document(spark, tmp_path):
    doc = {"extraction_date": "2020-01-01", "total_posts": 2, "source_url": "s", "posts": [
        {"url": "u1", "path": "/1", "title": "ü"}, {"url": "u2", "path": "/2", "title": "b"}]}
    file = tmp_path / "manifest.json"
    file.write_text(json.dumps(doc, indent=2), encoding="utf-8")
    assert [tuple(r) for r in readers.scan_manifest(spark, str(file)).orderBy("pos").collect()] == [(0, "u1", "/1", "ü"), (1, "u2", "/2", "b")]


def test_split_manifest_document(spark, tmp_path):
    """A document cut into many parts reads like one: braces, quotes, backslashes and separators inside strings, any spacing."""
    titles = ['plain', 'a } b', '}}{{', '"}"', '\\', '\\"}', '"posts": [{', ', {"url": "x"}', 'ü日本😀}', '', None, '],', ' "', 'x' * 300]
    posts = [{"url": f"u{i}", "path": f"/{i}", "title": titles[i % len(titles)]} for i in range(700)]
    doc = {"extraction_date": "2020 }", "total_posts": 700, "source_url": 's"posts": [{', "posts": posts}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for name, style in (("wide", {"indent": 2}), ("tight", {"separators": (",", ":")}), ("escaped", {"ensure_ascii": False})):
        file = tmp_path / f"{name}.json"
        file.write_text(json.dumps(doc, **style), encoding="utf-8")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "997b")
        try:
            got = readers.scan_manifest_split(spark, str(file)).orderBy("pos").collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert [tuple(r) for r in got] == [(i, p["url"], p["path"], p["title"]) for i, p in enumerate(posts)]
    whole = readers.scan_manifest(spark, str(tmp_path / "wide.json")).orderBy("pos").collect()
    assert whole == got
    (tmp_path / "none.json").write_text(json.dumps({"total_posts": 0, "posts": []}))
    assert readers.scan_manifest_split(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "cut.json").write_text('{"posts": [{"url": {"nested": 1}, "path": "p"}]}')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        readers.scan_manifest_split(spark, str(tmp_path / "cut.json")).collect()


def test_written_manifest_document(spark, tmp_path):
    rows = [(0, "u", "/p", 'a "}'), (1, "v", None, ""), (7, "w", "/q", "é")]
    writers.write_manifest_document(spark.createDataFrame(rows, "pos long, url string, path string, title string"), str(tmp_path / "m"), "http://s")
    doc = json.loads((tmp_path / "m" / "manifest.json").read_text(encoding="utf-8"))
    assert (doc["total_posts"], doc["source_url"]) == (3, "http://s") and doc["extraction_date"]
    assert [(p["url"], p["path"], p["title"]) for p in doc["posts"]] == [r[1:] for r in rows]
    writers.write_manifest_document(spark.createDataFrame([], "pos long, url string, path string, title string"), str(tmp_path / "n"), "http://s")
    assert json.loads((tmp_path / "n" / "manifest.json").read_text())["posts"] == []


def test_archive_files_roundtrip(spark, posts, tmp_path):
    root = str(tmp_path / "archive")
    full = R.render_post_markdown(posts.withColumn("raw_html", F.lit("<p>é\r\n</p>")).drop("file_path", "archive_path"))
    writers.export_archive(full, root, SITE)
    broken = tmp_path / "archive" / "posts" / "bad"
    broken.mkdir()
    (broken / "data.json").write_text("{not json")
    good, bad = readers.scan_post_archive(spark, root)
    got = {r.url: r for r in good.collect()}
    want = {r.url: r for r in full.withColumn("d", post_archive_path("url", SITE)).collect()}
    assert set(got) == set(want)
    for url, r in got.items():
        assert (r.title, r.categories, len(r.comments), r.archive_path) == (
            want[url].title, want[url].categories, len(want[url].comments), want[url].d)
        folder = tmp_path / "archive" / r.archive_path
        assert (folder / "content.md").read_text(encoding="utf-8") == want[url].markdown
        assert (folder / "raw.html").read_bytes() == "<p>é\r\n</p>".encode()
    assert [r.archive_path for r in bad.collect()] == ["posts/bad"]


def test_site_files_to_index(spark, posts, tmp_path):
    writers.export_files(R.render_site_markdown(posts, "Site"), str(tmp_path))
    (tmp_path / "_posts" / "notes.txt").write_text("skip me")
    files = readers.scan_markdown_posts(spark, str(tmp_path / "_posts"))
    assert {r.file_path for r in files.collect()} == {r.file_path for r in posts.collect()}
    lines = rebuild_index(files, "Site", "Archive").orderBy("part", F.desc("date"), "url").collect()
    assert "preserves 9 posts" in lines[0].line
    assert lines[1].line.startswith("- [a\\\"b](/archive/2011/09/02/p8/) (1 comments)")
    out = tmp_path / "index"
    writers.write_listing(rebuild_index(files, "Site", "Archive"), ["part", F.desc("date"), "url"], str(out))
    text = "".join(p.read_text() for p in sorted(out.glob("part-*")))
    assert text.startswith("---\ntitle: Archive\n") and text.count("\n- [") == 9


def test_segment_export_streams_one_file(spark, tmp_path):
    df = spark.createDataFrame([("d/x.md", 2, "b"), ("d/y.md", 0, "Y"), ("d/x.md", 0, "a"), ("d/x.md", 1, "-")], "file_path string, seg_no long, markdown string")
    writers.export_files(df, str(tmp_path), segment="seg_no")
    assert (tmp_path / "d/x.md").read_text() == "a-b" and sorted(p.name for p in (tmp_path / "d").iterdir()) == ["x.md", "y.md"]


def test_completed_starts_empty(spark, tmp_path):
    assert readers.scan_completed(spark, str(tmp_path / "none")).count() == 0


def test_completed_log_is_compacted(spark, tmp_path):
    path = str(tmp_path / "done")

    def append(*urls):
        writers.append_completed(spark.createDataFrame([(u, "ok") for u in urls] + [("bad", "failed")], "url string, status string"), path)

    for i in range(5):
        append("a", "b", f"u{i}")
    first = {r.url: r.completed_at for r in readers.scan_completed(spark, path).collect()}
    assert writers.compact_completed(spark, path) == 1
    append("a", "late")
    got = {r.url: r.completed_at for r in readers.scan_completed(spark, path).collect()}
    assert set(got) == set(first) | {"late"} and all(got[u] == first[u] for u in first)
    # Nothing of the appends before the snapshot is read again.
    assert {f.rsplit("/", 2)[1] for f in readers.scan_completed(spark, path).inputFiles()} == {"snapshot-1", "log-1"}
    # A snapshot that broke off does not count, and the next one takes its place.
    (tmp_path / "done" / "snapshot-2").mkdir()
    (tmp_path / "done" / "snapshot-2" / "part-0.parquet").write_bytes(b"broken")
    assert readers.scan_completed(spark, path).count() == len(got)
    assert writers.compact_completed(spark, path) == 2
    assert {r.url: r.completed_at for r in readers.scan_completed(spark, path).collect()} == got
    assert writers.compact_completed(spark, str(tmp_path / "new")) == 1 and readers.scan_completed(spark, str(tmp_path / "new")).count() == 0


def test_page_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.html").write_text("<p>x</p>\n<p>y</p>")
    assert [r.html for r in readers.scan_page_files(spark, str(tmp_path)).collect()] == ["<p>x</p>\n<p>y</p>"]


def test_small_files_share_tasks(spark, tmp_path):
    for i in range(120):
        (tmp_path / f"p{i}.html").write_text(str(i))
        (tmp_path / f"p{i}.md").write_text(str(i))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        for files, text in ((readers.scan_page_files(spark, str(tmp_path)), "html"), (readers.scan_markdown_posts(spark, str(tmp_path)), "text")):
            assert files.rdd.getNumPartitions() < 20
            assert sorted(r[text] for r in files.collect()) == sorted(map(str, range(120)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_page_files_keep_their_numbers(spark, tmp_path):
    """Numbers depend on the path below the folder alone: other pages and another place of the folder do not change them."""
    for place, names in (("one", ("a b+c é.html", "sub/x.html")), ("two/two", ("a b+c é.html", "new.html", "sub/x.html", "sub/two/x.html"))):
        for name in names:
            file = tmp_path / place / name
            file.parent.mkdir(parents=True, exist_ok=True)
            file.write_text(name)
    one, two = ({r.url: r for r in readers.scan_page_files(spark, str(tmp_path / p), base_url="http://s.example/").collect()} for p in ("one", "two/two"))
    assert {u: r.html for u, r in two.items()} == {f"http://s.example/{n}": n for n in ("a b+c é.html", "new.html", "sub/x.html", "sub/two/x.html")}
    assert all(two[u].page_id == r.page_id for u, r in one.items()) and len({r.page_id for r in two.values()}) == 4
    assert all(0 <= r.page_id < 2**60 for r in two.values())


def test_files_are_listed_and_read_by_tasks(spark, tmp_path, monkeypatch):
    """Every file below a folder comes as Spark's own reader gives it, though no list of the files is made in the driver."""
    names = [f"{'abc'[i % 3]}/d{i % 40}/p {i}%+é'#.html" for i in range(300)] + ["top.html", "_no/x.html", ".no.html", "a/_y.html", "k=v/_z=1.html", "a/x.htm"]
    for i, name in enumerate(names):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"" if i == 5 else b"\xff\r\n" + str(i).encode() * i)
    (tmp_path / "l.html").symlink_to(tmp_path / "top.html")
    own = spark.read.text(str(tmp_path), wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.html")
    want = sorted(map(tuple, own.select("_metadata.file_path", F.hex("value")).collect()))
    for dealt in (1, 20):  # folders go to tasks at once or after some levels
        monkeypatch.setattr(readers, "DEALT", dealt)
        got = readers.whole_files(spark, str(tmp_path), "*.html")
        assert not any(f.endswith(".html") for f in got.inputFiles())
        assert sorted(map(tuple, got.select("file", F.hex("value")).collect())) == want
    (tmp_path / "none").mkdir()
    assert readers.whole_files(spark, str(tmp_path / "none"), "*.html").count() == 0


def test_page_files_are_no_list_of_the_driver(spark, tmp_path):
    for i in range(30):
        (tmp_path / f"p{i}.html").write_text(f"<p>{i}</p>")
    pages = readers.scan_page_files(spark, str(tmp_path), base_url="http://s.example")
    assert not any(f.endswith(".html") for f in pages.inputFiles())
    assert {r.url: r.html for r in pages.collect()} == {f"http://s.example/p{i}.html": f"<p>{i}</p>" for i in range(30)}


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    from folioworks.operators.joins import remaining

    pages = spark.createDataFrame([(f"u{i}", "<p>") for i in range(20)], "url string, html string")
    for name, df in (("t_pages", pages), ("t_done", pages.limit(5).select("url"))):
        writers.write_bucketed(df, name, str(tmp_path / name), buckets=4)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = remaining(spark.table("t_pages"), spark.table("t_done"))
        assert "Exchange" not in left._jdf.queryExecution().executedPlan().toString()
        assert left.count() == 15
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        spark.sql("DROP TABLE t_pages")
        spark.sql("DROP TABLE t_done")


# ---- streams


def write_pages(spark, folder, ids):
    data = [(i, f"http://site.example/blog/p{i % 7}.html", f"<html><h1>t{i}</h1></html>") for i in ids]
    spark.createDataFrame(data, S.PAGE_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_stream_extract_resumes(spark, tmp_path):
    pages, out, state = (str(tmp_path / n) for n in ("pages", "out", "state"))
    done = spark.createDataFrame([("http://site.example/blog/p3.html",)], "url string")

    def run():
        S.stream_extract(S.read_page_stream(spark, pages), out, state, completed=done).awaitTermination()
        return sorted(r.page_id for r in spark.read.parquet(out).collect())

    write_pages(spark, pages, range(5))
    assert run() == [0, 1, 2, 4]
    assert run() == [0, 1, 2, 4]
    write_pages(spark, pages, range(4, 10))  # 7, 8 and 9 repeat URLs that are there already
    assert run() == [0, 1, 2, 4, 5, 6]


def test_stream_dedupe_across_batches(spark, tmp_path):
    pages, out, state = (str(tmp_path / n) for n in ("pages", "out", "state"))
    for start in (0, 5, 10):
        write_pages(spark, pages, range(start, start + 5))
        links = S.read_page_stream(spark, pages).selectExpr("url", "page_id", "0L AS pos")
        S.stream_dedupe(links, out, state).awaitTermination()
    assert sorted(r.page_id for r in spark.read.parquet(out).collect()) == list(range(7))


def test_stream_progress_adds_up(spark, tmp_path):
    pages, out, state = (str(tmp_path / n) for n in ("pages", "out", "state"))
    for start in (0, 10):
        write_pages(spark, pages, range(start, start + 10))
        stream = S.read_page_stream(spark, pages).selectExpr("if(page_id % 4 = 0, 'failed', 'ok') AS status")
        S.stream_progress(stream, out, state).awaitTermination()
    assert {r.status: r.n for r in S.read_progress(spark, out).collect()} == {"failed": 5, "ok": 15}


def test_stream_reads_its_own_table_only(spark, tmp_path):
    write_pages(spark, str(tmp_path / "pages"), range(3))
    write_pages(spark, str(tmp_path / "pages_old"), range(50, 60))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    S.stream_extract(S.read_page_stream(spark, str(tmp_path / "pages")), out, state).awaitTermination()
    assert sorted(r.page_id for r in spark.read.parquet(out).collect()) == [0, 1, 2]


def test_stream_dedupe_keeps_its_state_by_key(spark, tmp_path):
    table, out, state = (str(tmp_path / n) for n in ("links", "out", "state"))

    def run():
        links = S.read_page_stream(spark, table, "url string, page_id bigint, pos bigint", files_per_batch=1)
        query = S.stream_dedupe(links, out, state)
        query.awaitTermination()
        return query

    want = {}
    for part in range(25):
        rows = [(None if i % 11 == 0 else f"u{(i * 7 + part) % 60}", part * 100 + 50 - i, i) for i in range(40)]
        for url, page, pos in sorted(rows, key=lambda r: r[1:]):
            want.setdefault(url, (page, pos))
        spark.createDataFrame(rows, "url string, page_id bigint, pos bigint").coalesce(1).write.mode("append").parquet(table)
    query = run()
    batches = [p for p in query.recentProgress if p.numInputRows]
    assert len(batches) == 25
    # The plan of a batch holds its own file and the state, whatever was written before.
    assert all(len(p.sources) == 1 and p.numInputRows == 40 for p in batches)
    assert max(p.stateOperators[0].numRowsUpdated for p in batches) <= 38
    assert "RocksDB" in "".join(batches[-1].stateOperators[0].customMetrics) or batches[-1].stateOperators[0].customMetrics.keys() & {"rocksdbPutCount"}

    def got():
        rows = spark.read.parquet(out).collect()
        assert len(rows) == len(want)
        return {r.url: (r.page_id, r.pos) for r in rows}

    assert got() == want
    run()
    assert got() == want
    # The last batch again, as after a failure between its output and its commit.
    last = max(int(p.name) for p in (tmp_path / "state" / "commits").iterdir() if p.name.isdigit())
    for name in (str(last), f".{last}.crc"):
        (tmp_path / "state" / "commits" / name).unlink(missing_ok=True)
    run()
    assert got() == want


def test_stored_index_reads_one_folder(spark, tmp_path):
    from folioworks.operators import postings as N
    from folioworks.operators.aggregates import term_postings

    texts = [(f"k{i:03}", "the " * (i % 9 + 1) + f"word{i % 40}") for i in range(300)]
    rows = term_postings(spark.createDataFrame(texts, "url string, content string"))
    path = str(tmp_path / "index")
    N.write_term_index(rows, path, block=16, buckets=8)
    blocks = N.scan_term(spark, path, "The", buckets=8)
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "PushedFilters: [IsNotNull(term), EqualTo(term,the)]" in plan
    assert {r[0] for r in blocks.selectExpr("array_sort(keys) = keys AND array_max(counts) = max_n AND size(keys) = posts").collect()} == {True}
    assert sorted(map(tuple, N.unpacked(blocks).select("url", "n").collect())) == [(u, t.count("the")) for u, t in texts]
    want = sorted(((u, t.count("the")) for u, t in texts), key=lambda r: (-r[1], r[0]))
    for k in (1, 20, 1000):
        assert [(r.url, r.n) for r in N.top_posts(blocks, k).collect()] == want[:k]
    assert N.unpacked(N.scan_term(spark, path, "absent", buckets=8)).collect() == []


def test_archive_update_leaves_other_months_alone(spark, tmp_path):
    path = tmp_path / "posts"
    rows = [(f"http://x.example/blog/2020/{m}/1/p{i}.html", f"text {m} {i}", "t") for m in (1, 2, 3) for i in range(4)]
    rows += [("http://x.example/blog/misc.html", "undated", "t"), rows[0]]
    posts = spark.createDataFrame(rows, "url string, content string, title string")
    writers.write_posts(posts, str(path))
    files = lambda: {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}
    before = files()
    pairs = posts.selectExpr("url", "content", "if(url LIKE '%/2/1/p1.html' OR url LIKE '%/1/1/p0.html', upper(content), content) AS rewritten")
    writers.update_archive(pairs, str(path))
    after = files()
    kept = {k: v for k, v in before.items() if "month=3" in k or "month=0" in k}
    assert kept and kept.items() <= after.items() and not {k for k in before if "month=1" in k or "month=2" in k} & after.keys()
    got = sorted((r.url, r.content, r.title) for r in readers.scan_posts(spark, str(path)).collect())
    assert got == sorted((u, c.upper() if "/2/1/p1" in u or "/1/1/p0" in u else c, t) for u, c, t in rows)
    writers.update_archive(pairs.where("false"), str(path))
    assert files() == after


def test_wanted_pages_moves_no_source_between_buckets(spark, tmp_path):
    from folioworks.plans.archive import wanted_pages

    pages = [(i, f"u{i % 20}", f"<p>{i}") for i in range(60)] + [(None, "n1", "<p>null"), (None, "u3", "<p>null"), (5, None, "<p>")]
    tables = {
        "w_pages": spark.createDataFrame(pages, "page_id bigint, url string, html string"),
        "w_manifest": spark.createDataFrame([(f"u{i}",) for i in range(15)] + [("n1",), (None,)], "url string"),
        "w_done": spark.createDataFrame([("u1",), ("u2",)], "url string"),
    }
    want = sorted([(i, f"u{i}") for i in range(15) if i not in (1, 2)] + [(-1, "n1")])
    rows = wanted_pages(*tables.values()).collect()
    assert sorted((-1 if r.page_id is None else r.page_id, r.url) for r in rows) == want
    for name, df in tables.items():
        writers.write_bucketed(df, name, str(tmp_path / name), buckets=4)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = wanted_pages(*(spark.table(name) for name in tables))
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        assert sorted((-1 if r.page_id is None else r.page_id, r.url) for r in found.collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        for name in tables:
            spark.sql(f"DROP TABLE {name}")


def test_postings_are_made_once_for_an_index(spark, tmp_path):
    from folioworks.operators import postings as N

    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(n):
        made.add(1)
        return n

    rows = spark.range(40).select("id", counted("id").alias("n")).select(F.concat(F.lit("t"), F.col("n") % 2).alias("term"), F.col("id").alias("doc"), "n")
    N.write_term_index(rows, str(tmp_path / "index"), "doc", block=8, buckets=4)
    assert made.value == 40
    assert N.unpacked(N.scan_term(spark, str(tmp_path / "index"), "t1", 4), "doc").count() == 20


def test_archive_rewritten_from_its_own_texts(spark, tmp_path):
    """Pairs read from the archive itself; changed months are not written a second time beside it."""
    from pathlib import Path

    from folioworks.session import shared_dir

    path = str(tmp_path / "posts")
    urls = [f"http://site.example/blog/2011/{m}/1/{n}.html" for m in (1, 2) for n in "ab"]
    writers.write_posts(spark.createDataFrame([(u, f"text {u}") for u in urls], "url string, content string"), path)
    shared = Path(shared_dir(spark).removeprefix("file://"))
    before = set(shared.glob("changed-partitions-*"))
    new = F.when(F.col("url").like("%/1/1/%"), F.lit("new")).otherwise(F.col("content"))
    pairs = readers.scan_posts(spark, path).select("url", "content", new.alias("rewritten"))
    writers.update_archive(pairs, path)
    got = {r.url: r.content for r in readers.scan_posts(spark, path).collect()}
    assert got == {u: "new" if "/1/1/" in u else f"text {u}" for u in urls}
    assert set(shared.glob("changed-partitions-*")) == before


def test_archive_update_moves_new_texts_once(spark, tmp_path, monkeypatch):
    """Changed texts are written as they come, small, and rows that repeat meet later; of several new texts the least counts."""
    import pyarrow.parquet as pq

    plans = {}

    def noted(df, name, **options):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return materialise(df, name, **options)

    materialise = writers.materialise
    path, table = str(tmp_path / "posts"), str(tmp_path / "pairs")
    rows = [(f"http://x.example/blog/2020/{1 + i % 3}/1/p{i}.html", f"text {i}") for i in range(12)] + [("http://x.example/blog/2020/1/1/p0.html", "text 0")]
    writers.write_posts(spark.createDataFrame(rows, "url string, content string"), path)
    changes = [(u, c, f"{new} {c}") for u, c in rows if u.endswith(("p0.html", "p4.html")) for new in ("b", "a")] + [(None, "x", "y")]
    spark.createDataFrame(changes, "url string, content string, rewritten string").write.parquet(table)
    monkeypatch.setattr(writers, "materialise", noted)
    writers.update_archive(spark.read.parquet(table), path)
    assert "Exchange" not in plans["new-texts"]
    got = sorted((r.url, r.content) for r in readers.scan_posts(spark, path).collect())
    assert got == sorted((u, f"a {c}" if c in ("text 0", "text 4") else c) for u, c in rows)
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in tmp_path.glob("posts/*/month=1/*.parquet")} == {"ZSTD"}
