"""From raw documents to token ids, in five stages that each use one operator for training data.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next one's documents. All but the last return the columns of ``documents``, and further ones if there
are any. Every stage takes nulls in any column and an empty table; what becomes of such rows stands with it.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm import bpe, mixing, quality, secret_scan, simhash
from snapmart.session import ensure_checkpoint_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go; null and empty texts do, having under 20 words."""
    return quality.keep_good(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that near fingerprints link stays: the one with the smallest id, null last; of equal rows one."""
    return simhash.one_of_each_group(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked and ``n_chars`` follows; all documents stay, a null text with a null length."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in training order; null sources are one source."""
    return mixing.training_rows(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, none for null, and whether they decode to it again."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    rows = docs.select(F.struct("doc_id", "lang", "source", "n_chars", "text").alias("row"), "text")
    both = bpe.round_trip(rows, path, pattern, "row")
    return both.select("row.doc_id", "row.lang", "row.source", "row.n_chars", F.size("ids").cast("long").alias("n_tokens"),
                       "ids", (F.col("decoded") == F.coalesce("row.text", F.lit("")).cast("binary")).alias("decodes"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", dedup_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

# Suffix arrays, fingerprints and byte-pair merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written to the shared folder."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
