"""SimHash near-duplicates, candidates by pigeonring filtering.

A fingerprint is cut into as many segments as there may be differing bits, plus one, and the segments are laid
in a ring. If two fingerprints differ in at most ``d`` bits, then some segment begins a chain in which every
prefix of ``l`` segments differs in at most ``l * d / (d + 1)`` bits, that is ``l - 1`` of them: the first segment
agrees, the first two differ in one bit at most, and so on around the ring. Pairs are met on the first two
segments together, so a bucket is as narrow as two segments and not one; the rest of the chain is checked
before the full distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.llm.common import as_bytes
from folioworks.llm.components import components
from folioworks.session import materialise

BITS = 64
BLOCK = 1 << 15


def fingerprint(text: bytes | None, shingle: int, seed: int = 42) -> int:
    """The fingerprint of one text. Shingles are hashed block by block, so a long text needs little memory."""
    words = text.lower().split() if text else []  # bytes: lowers A-Z only, parts at the six ASCII spaces
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    for low in range(0, n, BLOCK):
        high = min(n, low + BLOCK)
        columns = [words[low + j : high + j] for j in range(shingle)] if len(words) >= shingle else [[b" ".join(words)]]
        hashes = [xxhash.xxh64_intdigest(s, seed) for s in map(b" ".join, zip(*columns))]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprints(documents: DataFrame, shingle: int, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``documents`` with its fingerprint as a signed 64-bit integer."""

    @F.arrow_udf("bigint")
    def run(texts: pa.Array) -> pa.Array:
        made = np.fromiter((fingerprint(t, shingle) for t in as_bytes(texts)), np.uint64, len(texts))
        return pa.array(made.view(np.int64))

    return documents.withColumn(name, run(documents[text]))


def _segments(distance: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    edges = [BITS * i // (distance + 1) for i in range(distance + 2)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


def _segment(value: Column, part: tuple[int, int]) -> Column:
    low, width = part
    return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))


def near_pairs(prints: DataFrame, distance: int) -> DataFrame:
    """``(u, v)`` with ``u < v``: all pairs of the distinct values of ``fp`` within ``distance`` bits, each once."""
    ring = _segments(distance)
    m = len(ring)
    if m == 1:
        return prints.select(F.col("fp").alias("u"), F.col("fp").alias("v")).where(F.lit(False))

    def key(start: int, flip: int = 0) -> Column:
        first, second = ring[start], ring[(start + 1) % m]
        two = F.shiftleft(_segment(F.col("fp"), first), second[1]).bitwiseOR(
            _segment(F.col("fp"), second).bitwiseXOR(F.lit(flip))
        )
        return F.struct(F.lit(start).alias("s"), two.alias("k"))

    flips = [[0, *(1 << b for b in range(ring[(i + 1) % m][1]))] for i in range(m)]
    index = prints.select(F.col("fp").alias("u"), F.explode(F.array(*(key(i) for i in range(m)))).alias("e"))
    probe = prints.select(
        F.col("fp").alias("v"), F.explode(F.array(*(key(i, f) for i in range(m) for f in flips[i]))).alias("e")
    )
    index = index.select("u", F.col("e.s").alias("start"), F.col("e.k").alias("at"))
    probe = probe.select("v", F.col("e.s").alias("start"), F.col("e.k").alias("at"))
    apart = F.col("u").bitwiseXOR(F.col("v"))
    bits = [F.bit_count(_segment(apart, part)) for part in ring]

    def chain(start: int) -> Column:
        """Every prefix of the chain from ``start`` keeps within its share of the distance."""
        sums = [reduce(lambda a, b: a + b, [bits[(start + j) % m] for j in range(n)]) for n in range(1, m + 1)]
        return reduce(lambda a, b: a & b, [total <= (n * distance) // m for n, total in enumerate(sums, 1)])

    viable = F.lit(False)
    for i in reversed(range(m)):  # only the first start that holds counts, so no pair comes twice
        viable = F.when(chain(i), F.col("start") == i).otherwise(viable)
    # Spark takes neither side for larger than ``prints``, as an explode counts for nothing, and would send the probes to the driver.
    pairs = index.hint("merge").join(probe, ["start", "at"]).where((F.col("u") < F.col("v")) & viable)
    return pairs.where(F.bit_count(apart) <= distance).select("u", "v")


def groups(rows: DataFrame, distance: int, key: Column) -> DataFrame:
    """``(fp, least)``: for every fingerprint of ``rows`` the least ``key`` of its group; null keys count last."""
    ends = materialise(rows.groupBy("fp").agg(F.min(key).alias("own")), "fingerprints")
    roots = components(near_pairs(ends.select("fp"), distance)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    rooted = materialise(ends.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    least = materialise(rooted.groupBy("root").agg(F.min("own").alias("least")), "group-least")
    return rooted.select("fp", "root").join(least, "root").select("fp", "least")


def near_duplicates(
    documents: DataFrame, shingle: int = 3, distance: int = 3, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per input row: ``key``, ``fingerprint`` (16 hexadecimal digits) and ``component_id``, the least key
    that can be reached over fingerprints differing in at most ``distance`` bits, the row's own included.

    A null or empty text, or one of spaces only, has fingerprint zero and is linked like any other. Rows with
    equal fingerprints are one node, so repeated rows and groups of copies of any size cost one node. A null key
    is passed on and never a component's id unless all its keys are null. Other columns are not read.
    """
    source = documents.select(documents[key].alias(key), documents[text].alias("_text"))
    rows = materialise(with_fingerprints(source, shingle, "_text", "fp").select(key, "fp"), "simhash")
    least = groups(rows, distance, F.col(key))
    return rows.join(least, "fp").select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least").alias("component_id")
    )


def drop_near_duplicates(documents: DataFrame, shingle: int = 3, distance: int = 3, key: str = "doc_id") -> DataFrame:
    """The rows of ``documents``, all columns, of which one stays per group: the least key, of equal keys any one row.

    The rows are written once with a row number, so that the choice holds however often a task runs.
    """
    columns = documents.columns
    inner = documents.select(*(documents[c].alias(f"c{i}") for i, c in enumerate(columns)))
    at, text = f"c{columns.index(key)}", f"c{columns.index('text')}"
    numbered = with_fingerprints(inner, shingle, text, "fp").withColumn("row", F.monotonically_increasing_id())
    table = materialise(numbered, "simhash-rows")
    # Null keys last: a struct is compared field by field and false comes before true.
    rank = F.struct(F.col(at).isNull().alias("none"), F.col(at).alias("key"), F.col("row").alias("row"))
    kept = groups(table.select(at, "row", "fp"), distance, rank).select(F.col("least.row").alias("row")).distinct()
    left = table.join(kept, "row", "left_semi")
    return left.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(columns)))
