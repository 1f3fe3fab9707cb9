"""The registered queries of this subpackage, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioworks.llm import (
    byte_bpe,
    chat,
    dialogue_repair,
    filter_audit,
    html_extract,
    line_rules,
    lm_score,
    mixing,
    quality,
    simhash,
    substring,
    token_files,
    topk,
)
from folioworks.session import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


@query()
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return simhash.near_duplicates(docs, shingle=3, distance=3)


@query()
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.encode_decode(docs, ranks, public_tokenizers.PATTERN, output="digest")


@query()
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = fresh_path(spark, "token-shards")
    manifest = token_files.write_shards(docs, folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.read_documents(manifest, folder)


@query()
def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return substring.remove_repeats(docs, k=20)


@query()
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mixing.blocks(mixing.plan(docs, entropy_share=0.95))


@query()
def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.line_verdicts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    return quality.classify(docs, labels)


@query()
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query()
def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query()
def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=5, every=50)


@query()
def op11_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue_repair.repair_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


FILTER_AUDIT_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), failing AS (
  SELECT part, doc_id,
    (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), FALSE)::INT AS fails
  FROM words
), rated AS (
  SELECT doc_id, coalesce(max(quality) FILTER (quality = 1), 0) AS good, coalesce(max(toxic) FILTER (toxic = 1), 0) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), cells AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM failing LEFT JOIN rated USING (doc_id) GROUP BY part, fails
), letters(f, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders AS (
  SELECT p.f || q.f || r.f || s.f || t.f AS filter_order, [p.b, q.b, r.b, s.b, t.b] AS bits
  FROM letters p, letters q, letters r, letters s, letters t WHERE (p.b | q.b | r.b | s.b | t.b) = 31
), steps AS (
  SELECT filter_order, i::INT AS step, bits[i] AS b, coalesce(list_sum(bits[1:i - 1]), 0)::INT AS earlier
  FROM orders, range(1, 6) x(i)
), counted AS (
  SELECT part, filter_order, step, b,
    sum(n) FILTER ((fails & (earlier + b)) = 0) AS kept, sum(n) FILTER ((fails & b) > 0 AND (fails & earlier) = 0) AS removed,
    sum(n) FILTER ((fails & b) > 0 AND (fails & earlier) > 0) AS redundant, sum(n) FILTER (fails = b) AS unique_fails,
    sum(good) FILTER ((fails & b) > 0 AND (fails & earlier) = 0) AS good_lost,
    sum(toxic) FILTER ((fails & b) > 0 AND (fails & earlier) = 0) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, b
)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, b), 0)::BIGINT AS shapley
FROM counted
"""


@query(FILTER_AUDIT_SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    return filter_audit.audit(docs, labels)


@query()
def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
