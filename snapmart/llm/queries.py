"""The queries of this folder and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from snapmart.llm import bpe, embeddings, filter_audit, hard_negatives, html_extract, language_id, mixing, preference, quality, secret_scan, sharding, simhash, url_rules
from snapmart.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


@query("op1_html")
def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query("op2_bpe")
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_groups(table(spark, sf_dir, "documents"))


@query("op4_mixing", mixing.curriculum_sql())
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.curriculum(docs).select("doc_id", "size", "source_size", "target", "taken", "position")


@query("op5_language")
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.learn(docs))


@query("op6_url_filter")
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"))


@query("op7_sharding")
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), sharding.even_tree(8))


@query("op8_secrets")
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_covered", "longest_repeat")


@query("op10_embeddings")
def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op11_hard_negatives", hard_negatives.mine_sql())
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


@query("op12_filter_audit", filter_audit.audit_sql())
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_preference")
def op13_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    figures = preference.measured(table(spark, sf_dir, "documents"))
    return preference.predict_measured(figures, preference.learn_measured(figures, table(spark, sf_dir, "labels")))
