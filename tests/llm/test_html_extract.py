"""The site style tree against a recursive version, article texts against known ones, and odd pages."""

import html
import math
import random
import re
import time
from collections import Counter, defaultdict

import pytest
from conftest import SMALL

from folioworks.llm import html_extract as he
from folioworks.llm.queries import QUERIES

PAGES = "page_id bigint, url string, html string, host bigint, page bigint, known string, text string, node int"
WORDS = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("n", "r", "st", "l")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "k", "t", 3) for r in rows], PAGES)


def found(df):
    return sorted(((r.page_id, r.url, r.text, r.n_chars) for r in df.collect()), key=repr)


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


def site(rng, pages, host="http://site.example"):
    """Pages whose layout has no telling names: what belongs to the article shows in comparison only."""
    menu = [sentence(rng, 2) for _ in range(6)]
    adverts = [sentence(rng, 8) for _ in range(3)]
    rows, texts = [], {}
    for i in range(pages):
        article = [sentence(rng, rng.randint(5, 40)) for _ in range(rng.randint(2, 6))]
        body = "".join(f"<p>{a[:9]}<i>{a[9:]}</i>" for a in article)
        items = "".join(f"<li><a href='/{j}'>{m}</a></li>" for j, m in enumerate(menu))
        source = (
            f"<html><head><title>x{i}</title></head><body><div class=k1><ul>{items}</ul></div><div id=v{i}><div class='m4'>{body}</div></div>"
            f"<div class=r7><div>{rng.choice(adverts)}</div></div><div>All rights of {host}</div>"
        )
        rows.append((i, f"{host}/{i}", source))
        texts[i] = "\n\n".join(article)
    return rows, texts


def merged(rows, damping):
    """Importances by merging trees recursively, one host at a time; keyed like the operator's places."""
    hosts = defaultdict(dict)
    for _, url, source in rows:
        hosts[he.host_of(url)][source or ""] = None
    out = {}
    for host, sources in hosts.items():
        trees = [he.parse(s) for s in sources]

        def walk(members, key_of):
            """Importance of a place from the (tree, node) pairs that share it."""
            m = len(members)
            below = [[k for k in range(1, len(t.parent)) if t.parent[k] == n] for t, n in members]
            if members[0][0].tag[members[0][1]] == "#":
                counts = Counter(t.text[n] for t, n in members).values()
                imp = 1.0 if m == 1 else 1 - sum(map(math.log, counts)) / (len(counts) * math.log(m))
            else:
                styles = defaultdict(list)
                for (t, n), kids in zip(members, below):
                    styles[tuple(t.label[k] for k in kids)].append((t, kids))
                counts = [len(v) for v in styles.values()]
                own = 1.0 if m == 1 else -sum(c / m * math.log(c / m, m) for c in counts)
                rest = 0.0
                for group in styles.values():
                    width = len(group[0][1])
                    part = [walk([(t, kids[i]) for t, kids in group], key_of) for i in range(width)]
                    rest += len(group) / m * (sum(part) / width if width else (1.0 if len(group) == 1 else 0.0))
                imp = (1 - damping ** len(styles)) * own + damping ** len(styles) * rest
            out[key_of(*members[0])] = (m, imp)
            return imp

        keys = {id(t): he.places(t, host)[0] for t in trees}
        walk([(t, 0) for t in trees], lambda t, n: keys[id(t)][n])
    return out


def test_tree_against_a_recursive_merge(spark):
    rng = random.Random(4)
    rows = site(rng, 14)[0] + site(rng, 5, "https://other.example:8080")[0]
    rows += [(90 + i, None, f"<div><p>a<p>{i % 2}<div><div><b>x{i % 3}</b></div></div></div>") for i in range(6)]
    rows += rows[:4]  # pages of the same source count once
    want = {k: imp for k, (m, imp) in merged(rows, 0.9).items() if m >= 2 }
    leaves = he.style_tree(frame(spark, rows).repartition(3), min_pages=2)[0].collect()
    got = {r.key: r.importance for r in leaves}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-6 for k in got)


def test_layout_without_names_is_found_by_comparison(spark):
    rows, texts = site(random.Random(1), 60)
    got = {r[0]: r[2] for r in found(he.main_text(frame(spark, rows)))}
    assert got == texts
    # The same pages alone on their hosts: nothing to compare.
    alone = [(i, f"http://h{i}.example/", s) for i, _, s in rows[:5]]
    got = {r[0]: r[2] for r in found(he.main_text(frame(spark, alone)))}
    assert all(texts[i] in got[i] and "All rights" in got[i] for i in range(5))


def test_query_on_the_given_pages(spark):
    rows = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    want = []
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]
        pieces = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)\b[^>]*>", article)]
        text = "\n\n".join(x for x in pieces if x)
        want.append((r.page_id, r.url, text, len(text)))
    df = QUERIES["op12_main_text"](spark, SMALL)
    assert df.columns == ["page_id", "url", "text", "n_chars"]
    assert found(df) == sorted(want, key=repr)


def test_what_is_no_article_goes_by_name(spark):
    source = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="with-sidebar no-ads">
    <header><p>Site</p></header><nav><a href=/>Home</a></nav><div class="cookie-notice">We use cookies</div>
    <main><div class="breadcrumbs">Home / News</div><article class="post has-comments"><header><h1>Title&nbsp;&amp more</h1></header>
    <p>First <b>bold</b>, <span class="adSlot">Buy</span>then<br>next.<!-- <p>no</p> --><p>Second &lt;p&gt;
    <script>document.write("<p>no</p></article>")</script><blockquote>Quoted</blockquote>
    <ul><li>one<li>two</ul><table><tr><td>1<td>2</table><form><p>Your name <input></form><aside>See also</aside><footer>By X</footer>
    <div hidden>secret</div><p style="display: none">none</p><section id="comments"><article class=comment><p>Nice!</p></article></section>
    </article></main><div class=sidebar><p>Links</p></div><div role=complementary>More</div><footer>&copy; us</footer></body></html>"""
    (row,) = he.main_text(frame(spark, [(1, "http://a.example/1", source)])).collect()
    assert row.text.split("\n\n") == ["Title & more", "First bold, then next.", "Second <p>", "Quoted", "one", "two", "1", "2"]
    assert row.n_chars == len(row.text)


def test_copies_of_an_article_are_no_layout(spark):
    source = "<nav>Menu {0}</nav><article><h1>Same title</h1><p>Same words in every copy.</p></article><footer>Page {0}</footer>"
    rows = [(i, f"http://copies.example/{i}", source.format(i)) for i in range(40)]
    assert {r[2] for r in found(he.main_text(frame(spark, rows)))} == {"Same title\n\nSame words in every copy."}


ODD = [None, "", " \n", "plain text & more", "<p>", "<", "<p", "</p></div>", "<!--", "<script>x", "<p>a<p", "&#0;&amp", "<p title='x>y'>z", "<p title='x>y"]


def test_odd_pages(spark):
    long = "<p>" + "word " * 400_000 + "</p>"
    rows = [(i, None, s) for i, s in enumerate(ODD)] + [(None, "no address", "<p>b</p>")] * 3 + [(7, "http://a.example", long)] * 2
    got = found(he.main_text(frame(spark, rows).repartition(3)))
    assert len(got) == len(rows) and {r[2] for r in got if r[0] is None} == {"b"}
    text = {r[0]: r[2] for r in got if r[1] is None}
    assert [text[i] for i in (0, 1, 2, 3, 12)] == ["", "", "", "plain text & more", "z"]
    assert [r[3] for r in got if r[1] == "http://a.example"] == [400_000 * 5 - 1] * 2
    assert he.main_text(frame(spark, []).limit(0)).collect() == []


@pytest.mark.parametrize(
    "source",
    ["<div>" * 60_000 + "x", "<p>a" * 32_000, '<a href="' * 50_000, "<li>" * 50_000, "<b>" * 60_000 + "</i>" * 60_000, "<td><div>" * 30_000,
     "<span class=ad>" * 40_000 + "</p>" * 40_000, "<" * 100_000, "<a b='" * 40_000 + '"'],
    ids=range(9),
)
def test_parsing_is_linear(source):
    start = time.perf_counter()
    he.blocks(he.parse(source), {})
    assert time.perf_counter() - start < 5
