"""Exact top-k inner products over norm buckets.

Vectors are ordered by length into shelves of bounded bytes, longest first, and a shelf into buckets. No product of a query with a bucket can
pass the product of the query's length and the bucket's greatest length; against the query's k-th best score so far
this gives a cosine threshold for the bucket. Above one, the bucket is skipped. A low threshold prunes by length
(vectors of the bucket that are too short), a high one by coordinate: the coordinate in which the query is
largest bounds, together with the threshold, where a candidate's can lie. What is left is multiplied out exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioworks.session import materialise

BUCKET_ROWS = 4096
BLOCK_ROWS = 1024
# Vectors of a shelf and queries of a tile, as 64-bit numbers: what a task holds of either.
TILE_BYTES = 32 << 20
# Cosine threshold from which the coordinate bound prunes more than it costs.
COORDINATE_FROM = 0.6
SLACK = 1e-9
# Length of an integer vector up to which all products are whole numbers of 64 bits.
LONGEST = float(2**31)
RESULT = "query_id bigint, vec_id bigint, score bigint"


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``id, x, dim, norm`` with ``x = floor(scale * component)``; equal rows once, rows that take no part left out."""
    value = F.col("embedding")
    sound = F.forall(value, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    rows = vectors.select(vectors["vec_id"].alias("id"), vectors["embedding"].alias("embedding"))
    # Products of longer vectors would not fit the score's type.
    small = F.forall(value, lambda c: F.abs(c.cast("double") * scale) < LONGEST)
    rows = rows.where("id is not null and embedding is not null").where(sound).where(small)
    rows = rows.select("id", F.transform(value, lambda c: F.floor(c.cast("double") * scale)).alias("x")).distinct()
    square = F.aggregate("x", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    return rows.select("id", "x", F.size("x").alias("dim"), F.sqrt(square).alias("norm")).where(F.col("norm") < LONGEST)


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors: in floating point where every sum is exact, else in integers."""
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(queries.shape[1], 1)
    if bound < 2**53:
        return np.rint(queries.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    if bound < 2**63:
        return queries @ rows.T
    return queries.astype(object) @ rows.T.astype(object)


def best_of_bucket(ids, x, norms, q_ids, q, q_norms, least, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query's place, id, score)`` of the best ``k`` ids of one bucket, longest vectors first, for a block of queries: exact among
    what can still reach the queries' thresholds ``least``."""
    unit = x / np.maximum(norms, 1e-300)[:, None]
    floor = least - np.abs(least) * SLACK
    with np.errstate(divide="ignore", invalid="ignore"):
        need = least / (q_norms * norms[0]) * (1 - np.sign(least) * SLACK)  # cosine threshold of this bucket
    need = np.where(np.isnan(need), -np.inf, need)
    out = []

    def keep(i: int, at: np.ndarray, scores: np.ndarray) -> None:
        good = (ids[at] != q_ids[i]) & (scores >= floor[i])
        at, scores = at[good], scores[good]
        order = np.lexsort((ids[at], -scores))
        _, first = np.unique(ids[at][order], return_index=True)  # an id of several vectors counts once, by its best
        order = order[np.sort(first)[:k]]
        out.append((np.full(len(order), i), ids[at][order], scores[order]))

    by_length = np.flatnonzero(need < COORDINATE_FROM)
    if len(by_length):
        every = products(q[by_length], x)
        for i, scores in zip(by_length, every):
            n = len(ids)
            if least[i] > 0 and q_norms[i] > 0:  # norms fall along the bucket
                n = int(np.searchsorted(-norms, -least[i] / q_norms[i] * (1 - SLACK), side="right"))
            keep(i, np.arange(n), scores[:n])
    for i in np.flatnonzero((need >= COORDINATE_FROM) & (need <= 1)) if x.shape[1] else ():
        f = int(np.argmax(np.abs(q[i])))
        c, t = q[i][f] / q_norms[i], need[i]
        spread = np.sqrt(max(0.0, 1 - t * t) * max(0.0, 1 - c * c))
        low = c * t - spread - 1e-7 if c > -t else -1.0
        high = c * t + spread + 1e-7 if c < t else 1.0
        at = np.flatnonzero((unit[:, f] >= low) & (unit[:, f] <= high))
        if len(at):
            keep(i, at, products(q[i : i + 1], x[at])[0])
    return tuple(np.concatenate([o[j] for o in out]).astype(np.int64) if out else np.empty(0, np.int64) for j in range(3))


def best_of_shelf(shelf, queries, least: np.ndarray, k: int, bucket_rows: int, block_rows: int) -> list[tuple[np.ndarray, ...]]:
    """Best ``k`` ids of a shelf for every query, each side ``(ids, vectors, lengths)``. Buckets come longest first, and what a query
    found raises its threshold for the next ones."""
    ids, x, norms = shelf
    order = np.lexsort((ids, -norms))
    ids, x, norms = ids[order], x[order], norms[order]
    out = []
    for a in range(0, len(queries[0]), block_rows):
        q_ids, q, q_norms = (v[a : a + block_rows] for v in queries)
        bound = least[a : a + block_rows].copy()
        at = found = scores = np.empty(0, np.int64)
        for b in range(0, len(ids), bucket_rows):
            part = slice(b, b + bucket_rows)
            new = best_of_bucket(ids[part], x[part], norms[part], q_ids, q, q_norms, bound, k)
            at, found, scores = (np.concatenate(pair) for pair in zip((at, found, scores), new))
            # One row an id and query, then the first k of each query.
            order = np.lexsort((-scores, found, at))
            at, found, scores = at[order], found[order], scores[order]
            once = np.ones(len(at), bool)
            once[1:] = (at[1:] != at[:-1]) | (found[1:] != found[:-1])
            at, found, scores = at[once], found[once], scores[once]
            order = np.lexsort((found, -scores, at))
            at, found, scores = at[order], found[order], scores[order]
            place = np.arange(len(at)) - np.searchsorted(at, at)
            last = place == k - 1
            bound[at[last]] = np.maximum(bound[at[last]], scores[last])
            at, found, scores = at[place < k], found[place < k], scores[place < k]
        out.append((q_ids[at], found, scores))
    return out


def top_k(
    vectors: DataFrame, k: int = 5, every: int = 50, bucket_rows: int = BUCKET_ROWS, block_rows: int = BLOCK_ROWS, tile_bytes: int = TILE_BYTES
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row whose id is divisible by ``every``, the ``k`` highest integer inner
    products with other rows, ties to the smaller id.

    Vectors that are null or hold a null or non-finite component, and rows without an id, take no part, nor do vectors whose
    integer form is ``LONGEST`` or longer, as their products have no 64-bit value. An empty table gives no rows. Vectors are
    compared with those of their own length only. Rows that repeat id and vector are one; different vectors under
    one id are scored each, and the id keeps its best. Other columns are not read.

    Queries meet the shelves as tiles of about ``tile_bytes`` on either side, so a shelf is read once for each tile of queries that it
    can still serve and a tile once for each such shelf: no side is copied for every block of the other.
    """
    rows = materialise(quantised(vectors), "vectors")
    n, dim = rows.agg(F.count(F.lit(1)), F.max("dim")).head()
    tile_rows = max(1, tile_bytes // (8 * max(1, dim or 1)))
    place = F.xxhash64("x")  # rows that share length and id are dealt, too
    shelves = rows.repartitionByRange(max(1, -(-n // tile_rows)), "dim", F.desc("norm"), "id", place).withColumn("shelf", F.spark_partition_id())
    shelves = materialise(shelves, "norm-shelves")
    # A shelf at the border of two lengths of vector is two.
    stats = materialise(shelves.groupBy("dim", "shelf").agg(F.max("norm").alias("top")), "shelf-lengths")
    first = stats.groupBy("dim").agg(F.min("shelf").alias("shelf"))
    queries = shelves.where(F.col("id") % every == 0).select("id", "x", "dim", "norm")

    tiles = max(1, -(-n // (every * tile_rows)))
    dealt = queries.withColumn("tile", F.pmod(F.xxhash64("id", "x"), F.lit(tiles)).cast("int")).withColumn("least", F.lit(float("-inf")))
    sizes = (k, bucket_rows, block_rows)
    seeds = _meet(shelves, dealt, dealt.select("dim", "tile").distinct().join(first, "dim"), *sizes)
    seeds = materialise(seeds.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), "seeds")
    falling = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    reached = seeds.withColumn("n", F.row_number().over(falling)).where(F.col("n") == k)
    reached = reached.select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("least"))
    ready = queries.join(reached, "id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    # Queries that can do with the same length of candidate share a tile; a tile's need is that of its humblest query.
    need = F.when(F.col("norm") > 0, F.col("least") / F.col("norm")).otherwise(F.when(F.col("least") > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf"))))
    ready = ready.withColumn("need", need).repartitionByRange(tiles, "dim", "need", "id", place).withColumn("tile", F.spark_partition_id())
    ready = materialise(ready, "queries")
    humble = ready.groupBy("dim", "tile").agg(F.min("need").alias("need"))
    others = stats.join(first.withColumnRenamed("shelf", "low"), "dim").where("shelf > low")
    reach = humble.join(others, "dim").where(F.col("top") * F.lit(1 + SLACK) >= F.col("need") - F.abs("need") * F.lit(SLACK))
    rest = _meet(shelves, ready.drop("need"), reach.select("dim", "tile", "shelf"), *sizes)
    best = seeds.union(rest).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(falling)
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _meet(shelves: DataFrame, queries: DataFrame, pairs: DataFrame, k: int, bucket_rows: int, block_rows: int) -> DataFrame:
    """Best ``k`` per query and shelf for the given pairs of tile and shelf."""
    left = shelves.join(pairs, ["dim", "shelf"]).groupBy("dim", "shelf", "tile")
    asked = queries.join(pairs, ["dim", "tile"])
    renamed = asked.select(*(F.col(c).alias(f"q_{c}") for c in ("dim", "shelf", "tile", "id", "x", "norm", "least")))

    def side(table: pa.Table, dim: int, mark: str = "") -> tuple[np.ndarray, ...]:
        x = table[f"{mark}x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, dim)
        return table[f"{mark}id"].to_numpy(), x, table[f"{mark}norm"].to_numpy()

    def run(key: tuple, rows: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and asked.num_rows:
            dim = key[0].as_py()
            found = best_of_shelf(side(rows, dim), side(asked, dim, "q_"), asked["q_least"].to_numpy(), k, bucket_rows, block_rows)
        columns = [np.concatenate([f[j] for f in found]) if found else np.empty(0, np.int64) for j in range(3)]
        return pa.table(columns, names=["query_id", "vec_id", "score"])

    return left.cogroup(renamed.groupBy("q_dim", "q_shelf", "q_tile")).applyInArrow(run, RESULT)
