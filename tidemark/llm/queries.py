"""One query per operator, over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    conversation_repair,
    embedding_dedup,
    fingerprints,
    license_scan,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    pii,
    quality_rules,
    secret_scan,
    token_counts,
    whitening,
)
from tidemark.session import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@_query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan_secrets(documents(spark, sf_dir).select("doc_id", "text")))


@_query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir)).drop("detections")


@_query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select(
        "doc_id", "n_lines", "n_removed", "emptied", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    )


@_query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(token_counts.stored_flat(documents(spark, sf_dir)))
    return counted.where("terminated").select("doc_id", "file", "start", "n_tokens")


@_query
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(documents(spark, sf_dir), 3, 90, 100).drop("text_hash")


@_query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select(
        "doc_id", "source", "lang", "topic", "tokens", "weight", "probability", "sampled"
    )


@_query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pii.digest(pii.find_personal_data(docs, pii.fit(docs)))


@_query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "lang", "text")
    stats = written(quality_rules.with_statistics(docs).drop("text"), "statistics")
    judged = quality_rules.judge(stats, quality_rules.cutoffs(stats, table(spark, sf_dir, "labels")))
    return judged.select(
        "doc_id", "_q.n_words", "_q.word_chars", "_q.n_symbols", "_q.n_dup_lines", "_q.n_repeat_words", "base_failed", "kept"
    )


@_query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


@_query
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(documents(spark, sf_dir))


@_query
def fingerprint_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate side of operator 10: bands joined in Spark, Jaccard verified."""
    return fingerprints.near_duplicates(documents(spark, sf_dir))


@_query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damage_and_repair(table(spark, sf_dir, "conversations"))


@_query
def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@_query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
