"""The operators of the training-data part against plain brute force, and their handling of odd rows."""

import hashlib
import random
import re
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from conftest import SMALL  # noqa: E402

import corpus_pipeline  # noqa: E402
from folioworks.llm import byte_bpe, chat, line_rules, lm_score, mixing, quality, simhash, substring, token_files, topk  # noqa: E402
from folioworks.llm.queries import QUERIES  # noqa: E402
from folioworks.session import fresh_path  # noqa: E402

# What training must add to word frequencies, in nats a word, on half of the smallest table.
LM_GAIN = 0.05
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, h bigint, v int, fp bigint, tie bigint, unit string"
LONG = " ".join(f"w{i % 977} x{i}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(45))
ODD = [
    (1, f"a b {PASSAGE} c", "en", "s0"),
    (2, f"{PASSAGE} tail", "en", "s0"),
    (3, f"{PASSAGE} tail", "en", None),
    (4, None, None, "s1"),
    (5, "", "en", "s1"),
    (6, " \n\t ", "en", "s1"),
    (None, f"null key {PASSAGE}", "en", "s2"),
    (7, LONG, "en", "s2"),
    (8, LONG, "en", "s2"),
    (9, f"x y z {PASSAGE} again {PASSAGE}", "en", "s0"),
    (9, f"x y z {PASSAGE} again {PASSAGE}", "en", "s0"),
    (10, "un mot été là 日本語 😀 ¿qué?", "fr", "s3"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(*r, None if r[1] is None else len(r[1]), 1, 2, 3, 4, "u") for r in ODD]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r.doc_id, r.text) for r in rows)


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def test_simhash(spark, texts, odd, empty):
    got = {r.doc_id: r for r in QUERIES["op1_simhash"](spark, SMALL).collect()}
    prints = {k: plain_fingerprint(t) for k, t in texts}
    root = {k: k for k in prints}
    changed = True
    while changed:
        changed = False
        for a in root:
            for b in root:
                if root[b] < root[a] and (prints[a] ^ prints[b]).bit_count() <= 3:
                    root[a], changed = root[b], True
    assert {k: (r.fingerprint, r.component_id) for k, r in got.items()} == {k: (f"{prints[k]:016x}", root[k]) for k in prints}
    rows = simhash.near_duplicates(odd, 3, 3).collect()
    assert len(rows) == len(ODD)
    ids = {r.doc_id: r for r in rows}
    assert ids[4].fingerprint == ids[5].fingerprint == ids[6].fingerprint == "0" * 16
    assert ids[5].component_id == 4 and ids[8].component_id == 7
    kept = simhash.drop_near_duplicates(odd)
    ids_kept = [r.doc_id for r in kept.collect()]
    assert kept.columns == odd.columns and len(ids_kept) == len(set(ids_kept)) and set(ids_kept) == {r.component_id for r in rows}
    assert simhash.near_duplicates(empty, 3, 3).count() == simhash.drop_near_duplicates(empty).count() == 0


def test_pigeonring_finds_every_pair(spark):
    rnd = random.Random(3)
    base = [rnd.getrandbits(64) for _ in range(40)]
    values = {b ^ sum(1 << i for i in rnd.sample(range(64), rnd.randint(0, 5))) for b in base for _ in range(8)}
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in values)
    frame = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    for distance in (1, 2, 3):
        got = sorted(map(tuple, simhash.near_pairs(frame, distance).collect()))
        assert got == [(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= distance]


def test_probes_of_prints_are_never_broadcast(spark):
    """The 68 probes of a fingerprint come out of an explode, which Spark sizes as if it made one row of one."""
    prints = spark.range(5000).select(F.xxhash64("id").alias("fp"))
    pairs = simhash.near_pairs(prints, 3)
    assert pairs.collect() is not None
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_lm_score(spark, texts, odd, empty):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    even, other = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    table = lm_score.code_table(even)
    counts = np.zeros(lm_score.CODES)

    def plain_codes(text):
        out = []
        for w in (text or "").encode().lower().split():
            h = sum((b + 1) * pow(lm_score.BASE, i, 1 << 64) for i, b in enumerate(w)) % (1 << 64)
            out.append(((h ^ h >> 29) * lm_score.MIX) % (1 << 64) >> 49)
        return out

    for k, t in texts:
        if k % 2 == 0:
            np.add.at(counts, plain_codes(t), 1)
    odd_texts = ["", None, " \t\n", "one", " Ünï  CODE\x0bx\x00y ", "w" * 600_000 + " " * 300_000 + "tail", LONG]
    flat, n = lm_score.coded([t if t is None else t.encode() for t in odd_texts])
    assert [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == [plain_codes(t) for t in odd_texts]
    assert (lm_score.frequencies(table) == counts).all()

    def mean(state):
        return lm_score.pseudo_likelihood(other, state).agg(F.sum("log_likelihood") / F.sum("n_tokens")).first()[0]

    # Better than the frequencies of words, from which training starts, and by what a word-by-word computation says.
    state = lm_score.train_on(table)
    assert mean(state) > mean(lm_score.Network.start(counts).state) + LM_GAIN
    net, base = lm_score.Network(state), lm_score.BRANCHES
    for r in lm_score.pseudo_likelihood(other.limit(5), state).collect():
        words = plain_codes(dict(texts)[r.doc_id])
        total = 0.0
        for i, c in enumerate(words):
            near = [words[i + s] % lm_score.NEAR if 0 <= i + s < len(words) else lm_score.EDGE for s in lm_score.SIDES]
            out = np.tanh(sum(net.side[j][x] for j, x in enumerate(near))) @ net.out
            high, mid, low = c // base**2, c // base % base, c % base
            steps = [(net.given0[0], high), (net.given1[high], mid), (net.given2[c // base], low)]
            for level, (given, digit) in enumerate(steps):
                logits = out[level * base : (level + 1) * base] + given
                total += logits[digit] - np.log(np.exp(logits).sum())
        assert r.n_tokens == len(words) and r.log_likelihood == pytest.approx(total, rel=1e-3, abs=1e-2)
    flat, n = lm_score.coded([b"one two three four five"])
    around, every = lm_score.neighbours(flat, n)[:, 2:3], np.arange(lm_score.CODES, dtype=np.int16)
    assert np.exp(net.forward(np.repeat(around, lm_score.CODES, axis=1), every)).sum() == pytest.approx(1, abs=1e-3)
    rows = lm_score.score_documents(odd).collect()
    assert len(rows) == len(ODD) and all(r.mean_log_likelihood is None and r.n_tokens == 0 for r in rows if r.doc_id in (4, 5, 6))
    assert len({r.log_likelihood for r in rows if r.doc_id == 9}) == 1
    assert lm_score.score_documents(empty).count() == 0


def test_lm_scores_do_not_depend_on_the_layout(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    one = lm_score.code_table(docs.coalesce(1).orderBy("doc_id"))
    many = lm_score.code_table(docs.repartition(7).union(docs.where("doc_id % 3 = 0")))
    words = int(one.agg(F.sum("_n")).first()[0])
    for block_words in (words, words // 11):
        states = []
        for table in (one, many.dropDuplicates()):
            states.append(lm_score.train_on(table, block_words=block_words))
        assert (states[0] == states[1]).all()
    # A state says the same of a gradient that a finite difference does.
    net = lm_score.Network(states[0].astype(np.float64))
    flat, n = lm_score.coded([b"some words that stand beside each other in one text"])
    around = lm_score.neighbours(flat, n)
    moved, squares = lm_score.Network(net.state.copy()), lm_score.Network(np.zeros_like(net.state))
    moved.learn(around, flat, 1.0, squares)
    for at in np.argsort(-squares.state)[:20]:
        losses = []
        for step in (1e-5, -1e-5):
            state = net.state.copy()
            state[at] += step
            losses.append(-lm_score.Network(state).forward(around, flat).mean())
        assert (losses[0] - losses[1]) / 2e-5 == pytest.approx(np.sign(net.state[at] - moved.state[at]) * np.sqrt(squares.state[at]), rel=1e-3)


def test_byte_bpe(spark, odd, empty):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = byte_bpe.Codec(ranks, public_tokenizers.PATTERN)
    rnd = random.Random(1)
    pieces = ["a", "B", " ", "  ", "\n", ".", ",", "!", "'s", "'", "é", " ", "1", "ß", "the", " of", "\t", "😀", "<|endoftext|>", "\x00"]
    samples = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 25))) for _ in range(3000)] + [LONG]
    ids, ends = codec.encode(pa.array(samples))
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == [plain.encode_ordinary(s) for s in samples]
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = byte_bpe.encode_decode(odd, path, public_tokenizers.PATTERN).collect()
    assert sorted(str(r.decoded) for r in rows) == sorted(t or "" for _, t, *_ in ODD)
    split = next(r for r in rows if r.doc_id == 10)
    assert split.starts == sorted(split.starts) and split.starts[-1] < len(split.decoded)
    digests = byte_bpe.encode_decode(odd, path, public_tokenizers.PATTERN, output="digest").collect()
    assert {r.decoded_sha256 for r in digests} == {hashlib.sha256((t or "").encode()).hexdigest() for _, t, *_ in ODD}
    assert byte_bpe.encode_decode(empty, path, public_tokenizers.PATTERN).count() == 0


def test_token_files(spark, texts, odd, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    want, at = [], 0
    for key, text in texts:
        ids = [*plain.encode(text, add_special_tokens=False).ids, 1]
        want.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, QUERIES["op4_token_files"](spark, SMALL).collect())) == want
    names = ["<|endoftext|> a", "A<|endoftext|>b C", "<|ENDOFTEXT|> Word", "x <|startoftext|>.<|endoftext|> Y", "<| not one |>", "İI ǅ ß"]
    special = spark.createDataFrame(list(enumerate(names)), "doc_id bigint, text string")
    folder = fresh_path(spark, "special-shards")
    reader = token_files.TokenReader(folder, token_files.write_shards(special, folder, path).collect())
    assert [reader.get(i)[0].tolist() for i in range(len(names))] == [[*plain.encode(t, add_special_tokens=False).ids, 1] for t in names]
    assert reader.get(0)[0].tolist() == [49407, 320, 1]
    folder = fresh_path(spark, "odd-shards")
    manifest = token_files.write_shards(odd, folder, path, shards=3)
    rows = token_files.read_documents(manifest, folder).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in rows) == sorted((k is not None, k or 0) for k, *_ in ODD)
    assert {r.n_tokens for r in rows if r.doc_id in (4, 5, 6)} == {1} and rows[0].start is not None
    reader = token_files.TokenReader(folder, manifest.collect())
    assert len(reader.get(9)) == 2 and reader.get(77) == []
    assert reader.get(2)[0].tolist() == [*plain.encode(ODD[1][1], add_special_tokens=False).ids, 1]
    assert token_files.read_documents(token_files.write_shards(empty, fresh_path(spark, "none"), path), "nowhere").count() == 0


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(0).integers(-(2**62), 2**62, 20_000))
    assert sorted(token_files.PerfectHash.build(keys).slots(keys)) == list(range(len(keys)))


def test_mixing(spark, odd, empty):
    rows = [(i, "w " * 10, "big" if i % 5 else "small") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    planned = mixing.plan(docs, repeats=2.0).collect()
    weight = {r.source: r.weight for r in planned}
    assert weight["small"] == pytest.approx(0.4, abs=1e-3)
    taken = defaultdict(int)
    for r in planned:
        taken[r.source] += r.copies * r.n_tokens
    assert abs(taken["small"] - 2000) <= 10 and abs(taken["big"] - 3000) <= 10
    even = {r.source: r.weight for r in mixing.plan(docs, entropy_share=1.0).collect()}
    assert even["small"] == pytest.approx(0.5, abs=1e-3)
    assert mixing.blocks(mixing.plan(docs, repeats=2.0)).where("source = 'small'").select("block").distinct().count() == 2
    assert mixing.mix(odd).columns == odd.columns and mixing.mix(odd).count() > 0
    bare = spark.createDataFrame([(1, "a b c", "s"), (2, "", "none"), (3, None, "none")], "doc_id bigint, text string, source string")
    assert [r.doc_id for r in mixing.mix(bare).collect()] == [1]
    assert mixing.mix(empty).count() == mixing.blocks(mixing.plan(empty)).count() == 0


def test_line_rules(spark, texts, odd, empty):
    got = {r.doc_id: r for r in QUERIES["op6_line_rules"](spark, SMALL).collect()}
    word = re.compile(r"[^\x20\x09-\x0D]+")
    for key, text in texts:
        words, at = word.findall(text), defaultdict(list)
        for i in range(len(words) - 4):
            at[tuple(words[i : i + 5])].append(i)
        covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
        lines = [x for x in text.split("\n") if word.search(x)]
        r = got[key]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), sum(map(text.count, "#*$%&|<>")), len(lines) - len(set(lines)), len(covered)
        )
        assert r.base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
    line = "This very line stands in every document of the host, as navigation does."
    letters = [["".join(chr(97 + int(c)) for c in f"{i:02d}{j:02d}") for j in range(40)] for i in range(60)]
    own = [(i, f"{line}\n" + " ".join(letters[i] if i % 2 else letters[i][:1]), "s") for i in range(60)]
    docs = spark.createDataFrame(own, "doc_id bigint, text string, source string")
    kept = {r.doc_id: r.kept for r in line_rules.line_verdicts(docs).collect()}
    assert kept == {i: bool(i % 2) for i in range(60)}
    assert all(line not in r.text for r in line_rules.without_frequent_lines(docs).collect())
    copies = [(i, f"{line}\n" + " ".join(letters[0][:9]), "s") for i in range(100)] + [(200, " ".join(letters[1]) + f"\n{line}", "t")] * 50
    copies += [(300 + i, f"{line}\n" + " ".join(letters[i]), "u") for i in range(20)] + [(None, f"{line}\n" + " ".join(letters[30][:9]), "u")] * 9
    docs = spark.createDataFrame(copies, "doc_id bigint, text string, source string")
    gone = {(r.doc_id, r.n_line_words) for r in line_rules.line_verdicts(docs).collect()}
    # A hundred documents of one text count (with both lines), fifty rows of one document do not; rows without a key are the 21st document.
    words = len(line.split())
    assert gone == {(i, words + 9) for i in range(100)} | {(200, 0)} | {(300 + i, words) for i in range(20)} | {(None, words)}
    # The verdict of every document of the given table, counted out line by line.
    read = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source").collect()]

    def plainly(x):
        return re.sub("[\x20\x09-\x0d]+", " ", re.sub("[0-9]", "0", x.lower())).strip(" ")

    holders, hosts = defaultdict(set), defaultdict(set)
    for key, text, host in read:
        hosts[host].add(key)
        for x in (text or "").split("\n"):
            if word.search(x):
                holders[host, plainly(x)].add(key)
    for key, text, host in read:
        limit = max(20, int(len(hosts[host]) * line_rules.LINE_SHARE))
        lost = sum(len(word.findall(x)) for x in (text or "").split("\n") if word.search(x) and len(holders[host, plainly(x)]) > limit)
        r = got[key]
        assert r.n_line_words == lost
        assert r.kept == (not r.base_failed and r.n_words - lost >= line_rules.KEPT_SHARE * r.n_words)
    rows = line_rules.line_verdicts(odd).collect()
    assert len(rows) == len(ODD) and not any(r.kept for r in rows if r.doc_id in (4, 5, 6))
    assert line_rules.line_verdicts(empty).count() == 0


def test_top_k(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.floor(256 * np.array([r.embedding for r in rows], np.float64)).astype(np.int64)
    want = set()
    for i in np.flatnonzero(ids % 50 == 0):
        scores = x @ x[i]
        order = [j for j in np.lexsort((ids, -scores)) if j != i][:5]
        want |= {(int(ids[i]), n, int(ids[j]), int(scores[j])) for n, j in enumerate(order, 1)}
    assert set(map(tuple, QUERIES["op7_top_k"](spark, SMALL).collect())) == want
    frame = spark.createDataFrame([(r.vec_id, [float(v) * (1 + r.vec_id % 7) for v in r.embedding]) for r in rows], "vec_id bigint, embedding array<double>")
    small = topk.top_k(frame, bucket_rows=7, block_rows=3, tile_bytes=40 * 8 * len(rows[0].embedding))
    x = np.floor(256 * np.array([[float(v) * (1 + r.vec_id % 7) for v in r.embedding] for r in rows])).astype(np.int64)
    best = {int(ids[i]): sorted((int(s) for j, s in enumerate(x @ x[i]) if j != i), reverse=True)[:5] for i in np.flatnonzero(ids % 50 == 0)}
    got = defaultdict(list)
    for r in sorted(small.collect()):
        got[r.query_id].append(r.score)
    assert got == best
    odd = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [0.5, 0.5]), (None, [9.0, 9.0]), (5, [0.5, 0.5]), (6, [1.0, 1.0, 1.0])]
    frame = spark.createDataFrame([(*r, 1) for r in odd], "vec_id bigint, embedding array<double>, label int")
    assert sorted(map(tuple, topk.top_k(frame).collect())) == [(0, 1, 4, 98304), (0, 2, 5, 98304)]
    assert topk.top_k(frame.where("false")).count() == 0
    # Components of 1e300 are finite but have no integer products; an id of many vectors takes one place, as a query and as a result.
    rng = np.random.default_rng(7)
    many = [(i % 37 if i % 3 else 50, [float(v) for v in rng.integers(-9, 9, 4)]) for i in range(600)] + [(50, [1e300] * 4), (3, [1e300] * 4), (9, []), (100, [])]
    best = defaultdict(dict)
    for q, qx in many:
        for i, x in many:
            if q % 50 == 0 and i != q and len(x) == len(qx) and 1e300 not in (*qx, *x):
                score = sum(int(256 * a) * int(256 * b) for a, b in zip(qx, x))
                best[q][i] = max(score, best[q].get(i, score))
    want = sorted((q, n, i, s) for q, by in best.items() for n, (s, i) in enumerate(sorted(((s, i) for i, s in by.items()), key=lambda r: (-r[0], r[1]))[:5], 1))
    got = topk.top_k(spark.createDataFrame(many, "vec_id bigint, embedding array<double>"), bucket_rows=5, block_rows=2, tile_bytes=32 * 30)
    assert sorted(map(tuple, got.collect())) == want


def test_substring(spark, texts, odd, empty):
    def brute(rows):
        seen, out = {}, {}
        for key, text in rows:
            words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
            gone = [False] * len(words)
            for i in range(len(words) - 19):
                if seen.setdefault(tuple(words[i : i + 20]), (key, i)) != (key, i):
                    gone[i : i + 20] = [True] * 20
            kept = [w for w, g in zip(words, gone) if not g]
            out[key] = (len(words), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
        return out

    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op8_substring"](spark, SMALL).collect()}
    assert got == brute(texts)
    unique = {k: t for k, t, *_ in ODD}
    want = brute(sorted(unique.items(), key=lambda x: (x[0] is not None, x[0] or 0)))
    rows = substring.remove_repeats(odd).collect()
    assert len(rows) == len(ODD) and {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == want
    cut = substring.remove_repeats(odd, output="documents")
    assert cut.columns == odd.columns
    by = {r.doc_id: r.text for r in cut.collect()}
    assert by[2] == "tail" and by[8] == "" and by[7] == LONG and by[4] is None and by[9] == "x y z again "
    assert substring.remove_repeats(empty).count() == 0


def test_rows_with_places_are_never_broadcast(spark, odd):
    found = substring.repeated_spans(odd, 20)
    assert found.count() > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_quality(spark, odd, empty):
    rnd = random.Random(5)
    vocabulary = [f"word{i}" for i in range(300)]

    def text(i):
        words = [rnd.choice(vocabulary) for _ in range(60)]
        if i % 4 == 0:
            words = [w.upper() + "!!" for w in words]
        if i % 4 == 1:
            words[5:5] = ["vile", "slur"]
        return " ".join(words)

    docs = spark.createDataFrame([(i, text(i)) for i in range(1200)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0), int(i % 4 == 1)) for i in range(800)], "doc_id bigint, quality int, toxic int")
    held = [r for r in quality.classify(docs, labels).collect() if r.doc_id >= 800]
    right = sum(r.accepted == (r.doc_id % 4 > 1) for r in held)
    assert right / len(held) > 0.95
    grade = {g: np.mean([r.expected_grade for r in held if min(r.doc_id % 4, 2) == g]) for g in (0, 1, 2)}
    assert grade[1] < grade[0] < grade[2]
    marks = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1), (2, None, 0), (77, 0, 1)], labels.schema)
    assert len(quality.classify(odd, marks).collect()) == len(ODD)
    assert quality.keep_accepted(odd, marks.where("false")).columns == odd.columns
    assert quality.classify(empty, marks).count() == 0


def test_chat(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", "yo"), (1, 2, "bob", "yo"), (1, 3, None, None),
            (None, 0, "ann", "alone"), (2, 0, "system", "only"), (3, None, "cy", "late"), (3, 700, "cy", "far")]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "conv_id bigint, turn bigint, role string, text string, mask int")
    got = {(r.conv_id, r.perspective, r.piece): r for r in chat.rotate(frame).collect()}
    assert set(got) == {(1, "ann", 0), (1, "bob", 0), (None, "ann", 0), (3, "cy", None), (3, "cy", 2)}
    bob = got[1, "bob", 0]
    assert bob.n_turns == 5 and bob.n_own == 2
    assert [bob.text[m.start : m.end] for m in bob.mask] == ["yo<|im_end|>"] * 2
    assert bob.text.startswith("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>user name=ann\nhi < |im_end|><|im_end|>\n")
    assert chat.rotate(frame.where("false")).count() == 0


def test_pipeline(spark, texts):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    out = corpus_pipeline.run(spark, SMALL)
    assert 0 < out.count() <= 2 * len(texts)
    text_of = dict(texts)
    for r in out.limit(50).collect():
        kept = iter(text_of[r.doc_id].split())
        assert all(w in kept for w in r.decoded.split())  # what stays is the text's words in order
