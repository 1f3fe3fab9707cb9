"""Mixing sources to target weights by temperature, with DataFrame functions only.

A source with the share ``p`` of all tokens gets the weight ``p ** a``, normalised. The exponent ``a`` between 0 (all
alike) and 1 (as they come) is found by repeated section until the mix has a target entropy or repeats no
source more often than a limit. A source is then drawn in blocks: every full block is all its documents in a
permutation of its own, and the last block is cut where the source's budget ends.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.llm.common import words_of
from folioworks.operators.windows import prefix_scan
from folioworks.session import materialise

CUTS = 64
ROUNDS = 5
RANGE_BITS = 10


def _measures(shares: DataFrame, exponents: Column, repeat_of: float) -> DataFrame:
    """Entropy of the mix and its largest repetition, for every exponent of a grid, in one aggregation."""
    grid = shares.where("share > 0").select("share", F.explode(exponents).alias("a"))
    powered = grid.withColumn("w", F.pow("share", "a"))
    sums = powered.groupBy("a").agg(
        F.sum("w").alias("z"), F.sum(F.col("w") * F.log("w")).alias("wlogw"), F.max(F.col("w") / F.col("share")).alias("most")
    )
    return sums.select("a", (F.log("z") - F.col("wlogw") / F.col("z")).alias("entropy"), (F.col("most") / F.col("z") * repeat_of).alias("repeats"))


def exponent(shares: DataFrame, ratio: float = 1.0, entropy: float | None = None, repeats: float | None = None) -> float:
    """The largest exponent whose mix has at least ``entropy``, or the least whose mix takes no source more than ``repeats``
    times; ``ratio`` is the budget over all tokens.

    Entropy falls and repetition falls as the exponent grows, so each round tests the inner cuts of the interval at
    once and keeps the part where the answer lies: one number per cut comes to the driver. A target out of
    reach gives the nearer end of the interval.
    """
    low, high = 0.0, 1.0

    def good(row) -> bool:
        return row["entropy"] >= entropy - 1e-12 if repeats is None else row["repeats"] <= repeats + 1e-12

    for _ in range(ROUNDS):
        step = (high - low) / CUTS
        cuts = F.array(*(F.lit(low + i * step) for i in range(CUTS + 1)))
        rows = sorted(_measures(shares, cuts, ratio).collect(), key=lambda r: r["a"])
        if not rows:
            return 1.0
        fine = [r["a"] for r in rows if good(r)]
        if repeats is None:
            low = max(fine, default=0.0)
            high = min(low + step, 1.0)
        else:
            high = min(fine, default=1.0)
            low = max(high - step, 0.0)
    return low if repeats is None else high


def plan(
    documents: DataFrame, budget: int | None = None, entropy_share: float = 0.95, repeats: float | None = None,
    seed: int = 5, key: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """``key, tie, source, n_tokens, times, weight, copies``: how often each document is taken.

    The entropy target is a share of the entropy of equal weights. Rows that repeat key and text are one document that is
    drawn together (``times`` rows). Tokens are words. A null source is a source; a null text has no tokens. The
    running sum that cuts the last block is made per range of the permutation, never over a source in one task.
    """
    rows = documents.select(
        documents[key].alias("key"), F.xxhash64(documents[text]).alias("tie"), documents[source].alias("source"),
        F.size(words_of(documents[text])).cast("bigint").alias("n_tokens"),
    )
    rows = materialise(rows.groupBy("key", "tie", "source").agg(F.max("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("times")), "mix-documents")
    sizes = rows.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("times")).alias("tokens"))
    sizes = materialise(sizes, "mix-sources")
    total, n = sizes.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.count(F.when(F.col("tokens") > 0, 1))).first()
    budget = total if budget is None else budget
    shares = sizes.withColumn("share", F.col("tokens") / F.lit(max(total, 1)))
    target = None if repeats is not None else entropy_share * math.log(max(n, 1))
    a = exponent(shares, budget / max(total, 1), target, repeats)
    powered = shares.withColumn("w", F.when(F.col("share") > 0, F.pow("share", F.lit(a))).otherwise(F.lit(0.0)))
    z = powered.agg(F.sum("w")).first()[0] or 1.0
    weights = powered.select(
        F.col("source").alias("of"), "tokens", (F.col("w") / F.lit(z)).alias("weight"),
        F.round(F.col("w") / F.lit(z) * F.lit(budget)).cast("bigint").alias("target"),
    )
    weights = weights.withColumn("full", F.when(F.col("tokens") > 0, F.expr("target div tokens")).otherwise(F.lit(0)))
    weights = materialise(weights.withColumn("rest", F.col("target") - F.col("full") * F.col("tokens")), "mix-weights")

    mixed = rows.join(weights, F.col("source").eqNullSafe(F.col("of"))).drop("of", "target", "tokens")
    # The block that is cut has the number of the full ones before it, and so a permutation of its own.
    mixed = mixed.withColumn("at", F.xxhash64("key", "tie", "full", F.lit(seed)))
    scanned = prefix_scan(
        mixed, ["source"], ["at", "key", "tie"], F.shiftright("at", 64 - RANGE_BITS),
        sums={"upto": F.col("n_tokens") * F.col("times")}, position="place",
    )
    # Nothing left to take is no block: a source without tokens has weight 0 and gives no rows.
    copies = F.col("full") + F.when((F.col("rest") > 0) & (F.col("upto") <= F.col("rest")), 1).otherwise(0)
    return scanned.select("key", "tie", "source", "n_tokens", "times", "weight", copies.alias("copies"))


def blocks(planned: DataFrame, seed: int = 5, key: str = "doc_id") -> DataFrame:
    """One row per taken copy: ``key, source, block, place, n_tokens, weight``. Sorting a block of a source by ``place``
    gives its permutation."""
    taken = planned.where("copies > 0").withColumn("block", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int"))))
    taken = taken.withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    place = F.xxhash64("key", "tie", "block", F.lit(seed))
    return taken.select(F.col("key").alias(key), "source", "block", place.alias("place"), "n_tokens", F.round("weight", 9).alias("weight"))


def mix(documents: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``documents``, all columns, as often as the mix takes them.

    Rows that repeat are taken alike, a null key or source is one like any other, a source of texts without words has weight
    0 and gives no rows. An empty table gives an empty mix.
    """
    planned = plan(documents, key=key, text=text, **options).where("copies > 0").select("key", "tie", F.col("source").alias("of"), "copies")
    names = documents.columns
    inner = documents.select(*(documents[c].alias(f"c{i}") for i, c in enumerate(names)))
    at = {c: f"c{i}" for i, c in enumerate(names)}
    inner = inner.withColumn("tie", F.xxhash64(at[text]))
    joined = inner.join(
        planned, inner[at[key]].eqNullSafe(planned["key"]) & (inner["tie"] == planned["tie"])
        & inner[at[options.get("source", "source")]].eqNullSafe(planned["of"]),
    )
    taken = joined.withColumn("block", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return taken.select(*(F.col(at[c]).alias(c) for c in names))
