"""The filter audit against a plain walk over all orders, its merges against sets, and odd rows."""

import random
import re
from itertools import permutations

import duckdb
from conftest import SMALL

from folioworks.llm import filter_audit as fa
from folioworks.llm.queries import ORACLES, QUERIES

DOCS = "doc_id bigint, text string, lang string, id bigint, part string, fails int, digest string, place bigint, good int, n int"
LABELS = "doc_id bigint, quality int, toxic int, text string"
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "p", 2, "d", 3, 4, 5) for r in rows], DOCS)


def walked(docs, labels):
    """Every order applied to every part, document by document."""
    smallest = {}
    for key, text, _ in docs:
        if key is not None:
            smallest[text or ""] = min(key, smallest.get(text or "", key))
    good = {k for k, q, _ in labels if q == 1}
    toxic = {k for k, _, t in labels if t == 1}
    out = {}
    for part in {lang or "" for _, _, lang in docs}:
        rows = []
        for key, text, lang in docs:
            if (lang or "") != part:
                continue
            text = text or ""
            words = re.findall("[^\x20\x09-\x0d]+", text)
            fails = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
            fails += "C" * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text)) + "D" * bool(re.search("[#$%&*|]", text))
            fails += "E" * (key is not None and key > smallest[text])
            rows.append((fails, key in good if key is not None else False, key in toxic if key is not None else False))
        shapley = dict.fromkeys("ABCDE", 0)
        held = {}
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                shapley[f] += len(gone)
                held["".join(order), step] = (
                    len(left), len(gone), sum(f in r[0] for r in rows) - len(gone), sum(r[0] == f for r in rows),
                    sum(r[1] for r in gone), sum(r[2] for r in gone),
                )
        out |= {(part, o, s): (*v, shapley[o[s - 1]]) for (o, s), v in held.items()}
    return out


def found(df):
    rows = df.select(*COLUMNS).collect()
    got = {tuple(r[:3]): tuple(r[3:]) for r in rows}
    assert len(got) == len(rows)
    return got


def test_merges_against_sets():
    random.seed(3)
    for _ in range(400):
        lists = [sorted(random.sample(range(200), random.choice([0, 1, 5, 60, 180]))) for _ in range(random.randint(0, 5))]
        assert fa.union(lists) == sorted(set().union(*lists))
        for a in lists:
            for b in lists:
                assert fa.difference(a, b) == sorted(set(a) - set(b))
                assert fa.common(a, b) == len(set(a) & set(b))
    ids = list(range(0, 1000, 3))
    for start in (0, 1, 7, 333, 334):
        for value in range(-1, 1005):
            assert fa.gallop(ids, start, value) == next((i for i in range(start, len(ids)) if ids[i] >= value), len(ids) if start < len(ids) else start)


def test_query_against_a_plain_walk_and_sql(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    df = QUERIES["op13_filter_audit"](spark, SMALL)
    want = walked(docs, labels)
    assert found(df) == want
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    cursor = con.execute(ORACLES["op13_filter_audit"])
    assert [d[0] for d in cursor.description] == df.columns
    assert {r[:3]: r[3:] for r in cursor.fetchall()} == want


def test_odd_rows_and_small_blocks(spark):
    random.seed(8)
    texts = [None, "", " \n", "Ab " * 300, "ab " * 30, "#", "word " * 150_000, " ".join(f"w{i}" for i in range(250)), "É 日本 😀", "x y   z"]
    docs = [(random.choice([None, -3, *range(60)]), random.choice(texts), random.choice([None, "", "en", "de"])) for _ in range(400)]
    docs += [(7, "same", "en")] * 50 + [(None, "same", "en")] * 50
    labels = [(random.choice([None, *range(60)]), random.choice([0, 1, None]), random.choice([0, 1, None])) for _ in range(90)]
    rated = spark.createDataFrame([(*r, "t") for r in labels], LABELS)
    labels = [r for r in labels if r[0] is not None]
    want = walked(docs, labels)
    for block in (7, 1 << 16):
        assert found(fa.audit(frame(spark, docs).repartition(3), rated, block_rows=block)) == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert fa.audit(frame(spark, []).limit(0), none).collect() == []
    assert found(fa.audit(frame(spark, [(1, "a", "en"), (2, "a", None)]), none)) == walked([(1, "a", "en"), (2, "a", None)], [])
