"""A training-data pipeline over ``documents``: select by quality, drop near duplicates and repeated passages, mix, encode.

Every stage works on all rows that the one before it kept, and its result is written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioworks.llm import byte_bpe, mixing, quality, simhash, substring
from folioworks.session import materialise


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the ordinal classifier accepts; it is fitted on the rated ones among them.

    A null or empty text is judged by the thresholds alone, rows that repeat are judged alike, a null key has no label. Without any label
    all rows stay; of an empty table none.
    """
    return quality.keep_accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the least ``doc_id``.

    Texts without words share the fingerprint zero and are one group, null and empty ones among them; of rows that repeat one stays.
    """
    return simhash.drop_near_duplicates(docs, shingle=3, distance=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 20 words and more that stand earlier already, with their new number of characters.

    Every row stays; a text that loses all its words is empty, a null text stays null, texts of fewer words are as they were.
    """
    kept = substring.remove_repeats(docs, k=20, output="documents")
    return kept.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs, entropy_share=0.95)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text with the first character of each, and the text decoded from them; a null or empty text has none."""
    return byte_bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_filter", quality_filter),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixed_sources", mixed_sources),
    ("encoded", encoded),
]
# The fitted classifier cannot be put in SQL; tests/llm holds the stages after it against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
