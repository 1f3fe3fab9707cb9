"""Removal of repeated word passages over a compacted De Bruijn graph of the corpus.

An edge of the graph is a window of ``k`` words, a node the ``k - 1`` words between two windows. The steps:

1. Per document, windows that follow each other and share their minimizer (the least hash of the short word
   sequences in them) form a run, a nonbranching path of the graph found without any exchange. A window that
   occurs twice has the same minimizer hash at both places, so only runs whose minimizer hash occurs twice stay.
2. Equal runs are one class with a count and a first place. Where every occurrence of one class is followed by the
   same class, and every occurrence of that is preceded by the first, the node between them does not branch: a
   join of neighbouring runs and a count find these nodes, and the runs between branching nodes become one path.
3. An occurrence of a path away from its first place is a repeated span. Its words are compared, by a digest,
   with those at the source coordinates before anything is removed.
4. Runs of different content under one minimizer may still share windows (at the ends of passages). Their windows
   are compared one by one, for the first place of each class only.

A place is (document key, text hash, first word), so that rows sharing a key but not a text stay apart; null keys
come first. Rows that repeat both key and text are one document and get the same answer.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioworks.llm.common import as_bytes, parts, spread_out
from folioworks.session import materialise

# A slice of words takes many times its size, in lists and in arrays.
SLICE_BYTES = 1 << 20
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = 0x9E3779B97F4A7C15 | 1
RUNS = "h bigint, run bigint, doc bigint, v int, start int, n int"
PLACE = ["doc", "v", "start"]


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        made = self[word] = xxhash.xxh64_intdigest(word)
        return made


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def runs_of(words: np.ndarray, ends: np.ndarray, k: int, m: int) -> tuple[np.ndarray, ...]:
    """Runs of the documents whose hashed words lie one after another in ``words``, each up to its place in ``ends``:
    minimizer hash (48 bits), run hash, document number, first window, number of windows."""
    total, width = len(words), k - m + 1
    empty = np.empty(0, np.int64)
    if total < k:
        return empty, empty, empty, empty, empty
    # Sums of word times power make the hash of any span: difference of two sums, moved back to power zero.
    power = np.cumprod(np.full(total + 1, BASE, np.uint64)) * np.uint64(pow(BASE, -1, 2**64))
    back = np.cumprod(np.full(total + 1, pow(BASE, -1, 2**64), np.uint64)) * np.uint64(BASE)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * power[:-1])])
    grams = _mix((sums[m:] - sums[:-m]) * back[: total - m + 1])
    # Hash above, place below: the least of a window is its minimizer, and tells where it is.
    low = np.uint64(0xFFFF)
    marked = (grams & ~low) | (np.arange(len(grams), dtype=np.uint64) & low)
    least, span = marked, 1
    while 2 * span <= width:
        least, span = np.minimum(least[:-span], least[span:]), 2 * span
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    owner, _ = spread_out(np.diff(ends, prepend=0))
    inside = owner[: total - k + 1] == owner[k - 1 :]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | ~inside[:-1]
    new &= inside
    first = np.flatnonzero(new)
    if not len(first):
        return empty, empty, empty, empty, empty
    stop = np.flatnonzero(inside[first[0] :] & np.append(new[first[0] + 1 :] | ~inside[first[0] + 1 :], True)) + first[0] + 1
    n = stop - first
    content = _mix((sums[stop + k - 1] - sums[first]) * back[first] + n.astype(np.uint64))
    doc = owner[first]
    begin = ends[doc] - np.diff(ends, prepend=0)[doc]
    return (least[first] >> np.uint64(16)).astype(np.int64), content.view(np.int64), doc, first - begin, n


def _runs(source: DataFrame, k: int, m: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for piece in parts(batch, "text", SLICE_BYTES):
                split = [t.split() if t else [] for t in as_bytes(piece.column("text"))]
                ends = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))
                words = np.fromiter((hashes[w] for doc in split for w in doc), np.uint64, int(ends[-1]) if len(ends) else 0)
                h, content, doc, start, n = runs_of(words, ends, k, m)
                yield pa.record_batch({
                    "h": h, "run": content, "doc": piece.column("doc").take(pa.array(doc)),
                    "v": piece.column("v").take(pa.array(doc)), "start": start.astype(np.int32), "n": n.astype(np.int32),
                })

    return source.mapInArrow(run, RUNS)


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _source(documents: DataFrame, key: str, text: str) -> DataFrame:
    v = F.xxhash64(documents[text]).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
    return documents.select(documents[key].cast("bigint").alias("doc"), v.alias("v"), documents[text].alias("text"))


def _same_document(left: DataFrame, right: DataFrame) -> Column:
    return left["doc"].eqNullSafe(right["doc"]) & (left["v"] == right["v"])


def repeated_spans(documents: DataFrame, k: int = 20, m: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans that start elsewhere earlier: ``doc, v, start, n`` (windows) with ``source`` (place) and ``digest`` of the
    source's words, which the words of the span must have before they are removed."""
    source = _source(documents, key, text)
    runs = _runs(source, k, m)
    # A written list of hashes leaves the join two plain exchanges, so that Spark can split a frequent hash; dealt anew
    # by place before repeats go, else the repeats would bind the join to one task per hash.
    often = materialise(runs.groupBy("h").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("h"), "often")
    kept = runs.join(often, "h", "left_semi").repartition(*PLACE)
    runs = materialise(kept.distinct(), "runs")

    place = F.struct(*PLACE)
    classes = runs.groupBy("h", "run").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("occ"), F.min("n").alias("size"))
    classes = materialise(classes, "run-classes")
    again = classes.where("occ > 1").select("h", "run", "first", "occ")
    # Rows with places unpack to ten times their files and more, by whose size Spark would broadcast them: such joins sort and merge.
    placed = materialise(runs.join(again.hint("merge"), ["h", "run"]).select(*PLACE, "n", "first", "occ"), "repeated-runs")

    # A class goes on the path of the class before it if all occurrences of both are neighbours.
    ahead = placed.select(
        "doc", "v", (F.col("start") + F.col("n")).alias("start"), F.col("n").alias("n_a"), F.col("first").alias("first_a"), F.col("occ").alias("occ_a")
    )
    meets = ahead.alias("a").hint("merge").join(
        placed.alias("b"),
        F.col("a.doc").eqNullSafe(F.col("b.doc")) & (F.col("a.v") == F.col("b.v")) & (F.col("a.start") == F.col("b.start")),
    )
    follows = F.struct(F.col("first_a.doc").alias("doc"), F.col("first_a.v").alias("v"), (F.col("first_a.start") + F.col("n_a")).alias("start"))
    joined = (
        meets.where(F.col("first").eqNullSafe(follows) & (F.col("occ_a") == F.col("occ")))
        .groupBy("first").agg(F.count(F.lit(1)).alias("met"), F.max("occ").alias("occ"))
        .where("met = occ").select(F.col("first").alias("place"), F.lit(True).alias("joined"))
    )
    heads = classes.where("occ > 1").select(F.col("first").alias("place"))
    heads = heads.join(joined, "place", "left").select("place.*", F.col("joined").isNull().alias("head"))
    along = Window.partitionBy("doc", "v").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)  # one document each
    path = F.last(F.when(F.col("head"), F.col("start")), ignorenulls=True).over(along)
    paths = heads.withColumn("path", path).select(F.struct(*PLACE).alias("first"), "path")
    spans = (
        placed.join(paths, "first")
        .groupBy("doc", "v", (F.col("start") - F.col("first.start") + F.col("path")).alias("start"),
                 F.struct(F.col("first.doc").alias("doc"), F.col("first.v").alias("v"), F.col("path").alias("start")).alias("source"))
        .agg(F.sum("n").cast("int").alias("n"))
    )
    spans = materialise(spans.where(~F.col("source").eqNullSafe(F.struct(*PLACE))), "path-spans")

    mixed = classes.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("h")
    mixed = materialise(mixed, "mixed-hashes")
    open_runs = classes.join(mixed, "h", "left_semi").select("first.*", F.col("size").alias("n"), F.lit(True).alias("each"))
    wanted = spans.select("source.*", "n").distinct().withColumn("each", F.lit(False)).union(open_runs)
    lists = wanted.groupBy("doc", "v").agg(F.collect_list(F.struct("start", "n", "each")).alias("wanted"))
    there = source.join(lists, _same_document(source, lists)).select(source["doc"], source["v"], "text", "wanted")
    digests = materialise(_digests(there, k).distinct(), "digests")

    one = digests.where("each")
    # Written first, so that Spark can split a window that very many classes share.
    firsts = one.groupBy("digest").agg(F.min(place).alias("source"), F.count(F.lit(1)).alias("times")).where("times > 1")
    firsts = materialise(firsts.drop("times"), "first-windows")
    single = one.hint("merge").join(firsts, "digest").where(~F.col("source").eqNullSafe(place)).select(*PLACE, "n", "source", "digest")
    proof = digests.where("not each").select(F.struct(*PLACE).alias("source"), "n", "digest")
    return spans.hint("merge").join(proof, ["source", "n"]).select(*PLACE, "n", "source", "digest").union(single)


def _digests(rows: DataFrame, k: int) -> DataFrame:
    """Digest of each wanted span, or of each of its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in parts(batch, "text", SLICE_BYTES):
                out = []
                for doc, v, text, wanted in zip(
                    piece.column("doc").to_pylist(), piece.column("v").to_pylist(),
                    as_bytes(piece.column("text")), piece.column("wanted").to_pylist(),
                ):
                    words = text.split()
                    for w in wanted:
                        low, high = w["start"], w["start"] + w["n"]
                        if w["each"]:
                            out += [(doc, v, at, 1, True, _digest(words[at : at + k])) for at in range(low, high)]
                        else:
                            out.append((doc, v, low, w["n"], False, _digest(words[low : high + k - 1])))
                if out:
                    names = ["doc", "v", "start", "n", "each", "digest"]
                    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return rows.mapInArrow(run, "doc bigint, v int, start int, n int, each boolean, digest binary")


def _marked(words: list[bytes], spans: list[dict], k: int) -> np.ndarray:
    """True for the words to remove. A span whose words are not those of its source is left alone."""
    edge = np.zeros(len(words) + 1, np.int64)
    for s in spans:
        low, high = s["start"], s["start"] + s["n"] + k - 1
        if _digest(words[low:high]) == s["digest"]:
            edge[low] += 1
            edge[high] -= 1
    return np.cumsum(edge[:-1]) > 0


def _kept_pieces(text: str, gone: np.ndarray) -> Iterator[str]:
    """What stays of ``text``: every kept word with the space after it."""
    starts = [w.start() for w in WORD.finditer(text)] + [len(text)]
    yield text[: starts[0]]
    for i, drop in enumerate(gone):
        if not drop:
            yield text[starts[i] : starts[i + 1]]


def remove_repeats(
    documents: DataFrame, k: int = 20, m: int = 8, key: str = "doc_id", text: str = "text", output: str = "digest"
) -> DataFrame:
    """Remove each word covered by a window of ``k`` words whose sequence also starts earlier (smaller key, or same
    document and earlier start); windows are judged on the input.

    ``output`` is ``digest`` (key, ``n_words``, ``n_removed``, ``kept_sha256`` of the kept words joined by a space) or
    ``documents``: all columns of the input, the text without the removed words; texts that lose none stay as they are.
    One row per input row. A null text has no words (and stays null); a text under ``k`` words loses none; a text that
    loses all is empty. Repeated rows and null keys: see the module. Clashing names of other columns do no harm.
    """
    spans = repeated_spans(documents, k, m, key, text)
    spans = spans.groupBy("doc", "v").agg(F.collect_list(F.struct("start", "n", "digest")).alias("spans"))
    if output == "digest":
        source = _source(documents, key, text)

        def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in parts(batch, "text", SLICE_BYTES):
                    n, removed, sha = [], [], []
                    for t, found in zip(as_bytes(piece.column("text")), piece.column("spans").to_pylist()):
                        words = t.split() if t else []
                        n.append(len(words))
                        if found:
                            gone = _marked(words, found, k)
                            words = [w for w, drop in zip(words, gone.tolist()) if not drop]
                        removed.append(n[-1] - len(words))
                        sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
                    yield pa.record_batch({key: piece.column("doc"), "n_words": pa.array(n, pa.int64()),
                                           "n_removed": pa.array(removed, pa.int64()), "kept_sha256": sha})

        rows = source.join(spans, _same_document(source, spans), "left").select(source["doc"], "text", "spans")
        return rows.mapInArrow(digest, f"`{key}` bigint, n_words bigint, n_removed bigint, kept_sha256 string")

    @F.arrow_udf("string")
    def shorter(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for t, spans_of in zip(texts.to_pylist(), found.to_pylist()):
            if t is not None and spans_of:
                t = "".join(_kept_pieces(t, _marked(t.encode().split(), spans_of, k)))
            out.append(t)
        return pa.array(out, pa.string())

    names = documents.columns
    inner = documents.select(
        *(documents[c].alias(f"c{i}") for i, c in enumerate(names)), documents[key].cast("bigint").alias("doc"),
        F.xxhash64(documents[text]).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("v"),
    )
    body = f"c{names.index(text)}"
    rows = inner.join(spans, _same_document(inner, spans), "left").withColumn(body, shorter(body, "spans"))
    return rows.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)))
