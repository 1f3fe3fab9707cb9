"""The inverted index as a stored table: blocks of postings, clustered by term.

A term's postings are cut into blocks of about ``BLOCK`` documents, so that a word that is in every document is spread over many
rows. A block holds its document keys in order, their counts, and the highest count in it; the file format stores the keys as
differences. The table is partitioned by a hash of the term: looking a term up lists one folder and reads the row groups
that hold the term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioworks.session import materialise

BLOCK, BUCKETS = 4096, 64
# Encodings of the second version of the format store sorted numbers and strings as differences, where no dictionary is in the way.
DELTAS = {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary#keys.list.element": "false"}


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def write_term_index(postings: DataFrame, path: str, key: str = "url", block: int = BLOCK, buckets: int = BUCKETS) -> None:
    """Write ``(term, key, n)`` rows, one per term and document, as an index under ``path``."""
    # Written once, as they are read twice: to count the documents of a term and to deal them to blocks.
    postings = materialise(postings.select("term", key, "n"), "postings")
    # Only terms of more than one block need to know how many there are; written, so that Spark can split a frequent term.
    wide = postings.groupBy("term").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks")).where("blocks > 1")
    wide = materialise(wide, "wide-terms")
    dealt = postings.join(wide, "term", "left").withColumn("block", F.coalesce(F.pmod(F.xxhash64(key), "blocks"), F.lit(0)))
    blocks = dealt.groupBy("term", "block").agg(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), "n"))).alias("p"), F.max("n").alias("max_n"))
    rows = blocks.select(
        "term", F.col("block").cast("bigint").alias("block"), F.size("p").cast("bigint").alias("posts"), "max_n",
        F.col("p.k").alias("keys"), F.col("p.n").alias("counts"), _bucket(F.col("term"), buckets).alias("bucket"),
    )
    rows = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term", "block")
    rows.write.partitionBy("bucket").options(**DELTAS).parquet(path)


def scan_term(spark: SparkSession, path: str, term: str, buckets: int = BUCKETS) -> DataFrame:
    """The blocks of one term, in lower case as the index has it: ``term, block, posts, max_n, keys, counts``."""
    word = F.lit(term.lower())
    return spark.read.parquet(path).where((F.col("bucket") == _bucket(word, buckets)) & (F.col("term") == word)).drop("bucket")


def unpacked(blocks: DataFrame, key: str = "url") -> DataFrame:
    """``(term, key, n)`` rows of blocks."""
    pairs = F.explode(F.arrays_zip("keys", "counts")).alias("p")
    return blocks.select("term", pairs).select("term", F.col("p.keys").alias(key), F.col("p.counts").alias("n"))


def top_posts(blocks: DataFrame, k: int, key: str = "url") -> DataFrame:
    """The ``k`` documents with the highest counts of a term, ties to the lesser key; ``blocks`` holds one term.

    Every block holds a document with its highest count, so the k-th of the maxima bounds the k-th count from below: blocks
    under it are not unpacked.
    """
    best = blocks.select("max_n").orderBy(F.desc("max_n")).limit(k)
    bound = best.agg(F.when(F.count(F.lit(1)) == k, F.min("max_n")).otherwise(F.lit(0)).alias("bound")).scalar()
    return unpacked(blocks.where(F.col("max_n") >= bound), key).orderBy(F.desc("n"), key).limit(k)
