"""The registered queries of this subpackage and, where SQL can say it, their oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe, dialogues, exact, hmm, line_crf, merkle, mixing, near_vectors, oracles, packing, simhash, subwords,
    token_counts, token_files,
)
from .shared import LOCATOR

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP10_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY body ORDER BY doc_id) AS keep_id,
  count(*) OVER (PARTITION BY body) AS group_size,
  row_number() OVER (PARTITION BY body ORDER BY doc_id) = 1 AS kept,
  sha256(body) AS text_sha256
FROM t
"""


@query("op10_exact_dedup", OP10_SQL)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document of each group of equal texts stays."""
    return exact.decide(table(spark, sf_dir, "documents")).drop(*LOCATOR)


@query("op2_simhash")
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op3_token_files")
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, read back from Simple-8b shards."""
    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of every document lies in sequences of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op7_near_vectors")
def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector at a cosine of 0.9 or more."""
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, from the lines it consists of."""
    return line_crf.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, by its most toxic words."""
    return subwords.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_hmm_scores")
def op8_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document under a hidden Markov model of the corpus."""
    return hmm.score(table(spark, sf_dir, "documents"))


@query("op1_mixing")
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chances of the labelled domains, rate and copies of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return mixing.mix(docs, labels, most=mixing.MOST_COPIES).drop(*LOCATOR)


@query("op11_bpe")
def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by rank arrays, and the text decoded from them, as digests."""
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op12_merkle", oracles.merkle_sql())
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document in the tree of its language, some shown with a changed text."""
    return merkle.prove_tampered(table(spark, sf_dir, "documents"))


@query("op13_dialogues", oracles.dialogues_sql())
def op13_dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    return dialogues.repair_damaged(table(spark, sf_dir, "conversations"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline  # it imports this package

    return corpus_pipeline.run(spark, sf_dir)
