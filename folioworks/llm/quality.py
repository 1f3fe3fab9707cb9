"""Quality classifier: ordinal regression with cumulative links on hashed text.

One weight per hashed feature gives a text its score ``s``; ordered thresholds ``t`` turn it into grades:
``P(grade <= j) = sigmoid(t[j] - s)``. All grades share the weights. The expected grade and the probability of the
top grade serve selection.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.llm.common import as_bytes, parts, spread_out

SLICE_BYTES = 4 << 20
FEATURE_BITS = 18
SHAPES = 1 << 12
SHARES = (0.02, 0.1, 0.3, 0.5, 0.7, 0.9)
UPPER = [bytes([c]) for c in range(65, 91)]
# The labelled rows a fit reads at most: those with the least hash of their key.
FIT_ROWS = 20_000
FIT_SEED = 17


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, scores: np.ndarray) -> np.ndarray:
        """``P(grade > j)`` per text and threshold."""
        return _sigmoid(scores[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class WordCodes(dict):
    """Feature of the lower-case word below, class of its outline above."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        bare = word.strip(b".,;:!?\"'()").lower()
        outline = re.sub(rb"(.)\1+", rb"\1\1", re.sub(rb"[a-z\x80-\xff]", b"a", re.sub(rb"[A-Z]", b"A", re.sub(rb"[0-9]", b"0", word))))
        made = self[word] = zlib.crc32(bare) % (1 << FEATURE_BITS) | (zlib.crc32(outline[:12]) % SHAPES) << FEATURE_BITS
        return made


def features(texts: list[bytes | None], codes: WordCodes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text, text after text, and the end of each: its words (case and outer marks aside), and
    for every outline of words, repeated lines, repeated words, symbols and capitals, how large a share of it they are."""
    split = [t.split() if t else [] for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    flat = np.fromiter((codes[w] for doc in split for w in doc), np.int64, int(counts.sum()))
    owner, _ = spread_out(counts)
    size = np.int64(1 << FEATURE_BITS)
    words = np.unique(owner * size + (flat & (size - 1)))
    shapes, times = np.unique(owner * np.int64(SHAPES) + (flat >> FEATURE_BITS), return_counts=True)
    of, shape = shapes // SHAPES, shapes % SHAPES
    whole, level = np.arange(len(texts)), [times / np.maximum(counts[of], 1)]
    own, kind = [of], [shape]
    n_words = np.maximum(counts, 1)
    distinct = np.bincount(words // size, minlength=len(texts))
    stats = [
        np.fromiter((_repeated_lines(t) for t in texts), np.float64, len(texts)),
        np.where(counts > 20, 1 - distinct / n_words, 0),
        np.fromiter((sum(t.count(c) for c in b"#*$%&|<>!") if t else 0 for t in texts), np.float64, len(texts)) / n_words,
        np.fromiter((sum(map(t.count, UPPER)) if t else 0 for t in texts), np.float64, len(texts)) / n_words,
    ]
    for number, stat in enumerate(stats):
        own.append(whole), kind.append(np.full(len(texts), SHAPES + number)), level.append(stat)
    of, shape, share = np.concatenate(own), np.concatenate(kind), np.concatenate(level)
    extra = [
        of[share >= least] * size + (shape[share >= least] * 2654435761 + at * 40503) % size
        for at, least in enumerate(SHARES)
    ]
    every = np.unique(np.concatenate([words, *extra]))
    return (every % size).astype(np.int32), np.searchsorted(every // size, np.arange(len(texts)), side="right")


def _repeated_lines(text: bytes | None) -> float:
    lines = [line for line in (text or b"").split(b"\n") if line.strip()]
    return 1 - len(set(lines)) / len(lines) if lines else 0.0


def graded(labels: DataFrame) -> DataFrame:
    """``doc_id, grade``: 0 harmful, 1 poor, 2 good. Marks that are null are left out; of several the lowest holds."""
    grade = F.when(F.col("toxic") == 1, 0).when((F.col("toxic") == 0) & (F.col("quality") == 0), 1).when(
        (F.col("toxic") == 0) & (F.col("quality") == 1), 2
    )
    rows = labels.select("doc_id", grade.alias("grade")).where("doc_id is not null and grade is not null")
    return rows.groupBy("doc_id").agg(F.min("grade").alias("grade"))


def fit(
    documents: DataFrame, ratings: DataFrame, grades: int = 3, key: str = "doc_id", text: str = "text",
    rows: int = FIT_ROWS, steps: int = 120, ridge: float = 1.0, least_texts: int = 4,
) -> OrdinalModel:
    """Fit on at most ``rows`` rated texts, the ones whose key has the least hash (a documented bound: features of these
    rows come to the driver, about a kilobyte each). Of several texts under one key the one with the least hash is taken.
    Features of fewer than ``least_texts`` texts get no weight.

    Without any rated text the model is neutral: every text gets the same probabilities, the top grade one half.
    """
    chosen = ratings.select(F.col(key).alias("_key"), "grade").orderBy(F.xxhash64("_key"), "_key").limit(rows)
    texts = documents.select(documents[key].alias("_key"), documents[text].alias("_text"))
    rated = texts.join(F.broadcast(chosen), "_key").groupBy("_key").agg(
        F.min(F.struct(F.xxhash64("_text").alias("hash"), "_text", "grade")).alias("r")
    ).select("r._text", "r.grade")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in batches:
            for piece in parts(batch, "_text", SLICE_BYTES):
                found, ends = features(as_bytes(piece.column("_text")), codes)
                lists = [x.tobytes() for x in np.split(found, ends[:-1])]
                yield pa.record_batch({"grade": piece.column("grade"), "found": pa.array(lists, pa.binary())})

    got = rated.mapInArrow(run, "grade int, found binary").toArrow()
    order = np.lexsort([[hash_of(f) for f in got["found"].to_pylist()]]) if got.num_rows else np.empty(0, int)
    got = got.take(pa.array(order))
    lists = [np.frombuffer(f, np.int32) for f in got["found"].to_pylist()]
    return train(lists, got["grade"].to_numpy().astype(np.int64), grades, steps, ridge, least_texts)


def hash_of(found: bytes) -> int:
    return zlib.crc32(found)


def train(
    lists: list[np.ndarray], grade: np.ndarray, grades: int, steps: int, ridge: float, least_texts: int
) -> OrdinalModel:
    """Full-batch fit of weights and thresholds with momentum; each weight is scaled by how often its feature occurs."""
    size = 1 << FEATURE_BITS
    weights = np.zeros(size)
    if not len(lists):
        return OrdinalModel(weights.astype(np.float32), np.arange(2.0 - grades, 1.0))
    flat, counts = np.concatenate(lists), np.fromiter(map(len, lists), np.int64, len(lists))
    often = np.bincount(flat, minlength=size)
    kept = (often >= least_texts) & (often <= 0.98 * len(lists))
    owner = np.repeat(np.arange(len(lists)), counts)[kept[flat]]
    flat = flat[kept[flat]]
    n = len(lists)
    share = np.array([(np.count_nonzero(grade <= j) + 0.5) / (n + 1) for j in range(grades - 1)])
    thresholds = np.maximum.accumulate(np.log(share / (1 - share)) + 1e-3 * np.arange(grades - 1))
    scale = 1 / np.sqrt(often + ridge)
    moved, moved_t = np.zeros(size), np.zeros(grades - 1)
    rows = np.arange(n)
    for step in range(steps):
        scores = np.bincount(owner, weights=weights[flat], minlength=n)
        up = np.concatenate([_sigmoid(thresholds[None, :] - scores[:, None]), np.ones((n, 1))], axis=1)
        down = np.concatenate([np.zeros((n, 1)), up[:, :-1]], axis=1)
        p = np.maximum(up[rows, grade] - down[rows, grade], 1e-9)
        slope = up * (1 - up)
        slope_low = down * (1 - down)
        error = (slope[rows, grade] - slope_low[rows, grade]) / p  # d loss / d score
        gradient = np.bincount(flat, weights=error[owner], minlength=size) + ridge * weights
        gradient_t = np.zeros(grades - 1)
        for j in range(grades - 1):
            gradient_t[j] = -np.sum(((grade == j) * slope[:, j] - (grade == j + 1) * slope[:, j]) / p)
        rate = 0.5 / np.sqrt(1 + step / 40)
        moved = 0.8 * moved - 0.2 * rate * scale * gradient / np.sqrt(1 + np.abs(gradient))
        moved_t = 0.8 * moved_t - 0.2 * rate * gradient_t / (n**0.5 + np.abs(gradient_t))
        weights += moved
        thresholds = np.maximum.accumulate(thresholds + moved_t)
    return OrdinalModel(weights.astype(np.float32), thresholds)


def score(documents: DataFrame, model: OrdinalModel, text: str = "text", name: str = "rating") -> DataFrame:
    """``documents`` with a struct of ``expected_grade`` and ``top_probability``. The model travels with the tasks; its
    size is fixed by the number of features (one megabyte)."""
    weights, thresholds = model.weights, model.thresholds

    @F.arrow_udf("struct<expected_grade: double, top_probability: double>")
    def run(texts: pa.Array) -> pa.Array:
        codes, expected, top = WordCodes(), [], []
        for piece in parts(pa.record_batch({"t": texts}), "t", SLICE_BYTES):
            found, ends = features(as_bytes(piece.column("t")), codes)
            sums = np.concatenate([[0.0], np.cumsum(weights[found], dtype=np.float64)])
            scores = sums[ends] - sums[np.concatenate([[0], ends[:-1]])]
            above = OrdinalModel(weights, thresholds).above(scores)
            expected.append(above.sum(axis=1))
            top.append(above[:, -1])
        both = [np.round(np.concatenate(x), 9) if x else np.empty(0) for x in (expected, top)]
        return pa.StructArray.from_arrays([pa.array(b, pa.float64()) for b in both], ["expected_grade", "top_probability"])

    return documents.withColumn(name, run(documents[text]))


def accepted(rating: Column, least: float = 0.5) -> Column:
    """At least the probability, to six digits: one that misses it by the rounding of the fit is a tie, and accepted."""
    return F.round(rating["top_probability"], 6) >= least


def classify(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """``key, expected_grade, top_probability, accepted`` for every row, by a model fitted on its rated rows.

    One row per input row, repeated rows included. A null or empty text has no features and gets the probabilities of
    score zero; a null key is scored like any other and takes no part in the fit. Other columns are not read.
    """
    model = fit(documents, graded(labels), key=key, text=text)
    rated = score(documents.select(documents[key].alias(key), documents[text].alias("_text")), model, "_text")
    return rated.select(key, "rating.expected_grade", "rating.top_probability", accepted(F.col("rating"), least).alias("accepted"))


def keep_accepted(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``documents`` that the classifier accepts, all their columns. Nulls, empty texts, repeated rows and empty
    tables: as in :func:`classify`; without any label every row is accepted."""
    model = fit(documents, graded(labels), key=key, text=text)
    names = documents.columns
    inner = documents.select(*(documents[c].alias(f"c{i}") for i, c in enumerate(names)))
    rated = score(inner, model, f"c{names.index(text)}").where(accepted(F.col("rating"), least))
    return rated.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)))
