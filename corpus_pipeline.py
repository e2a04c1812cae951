"""From documents to packed training sequences, in five stages.

Each stage works on what the one before it kept; all but the last return the columns
of documents. ``run`` writes every stage's result to the shared folder and reads it
back, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, mixing, ngram_join, packing, quality_rules
from tidemark.llm.text import shield
from tidemark.session import written

SMALL_ROWS = 500_000


def _if_small(df: DataFrame) -> DataFrame:
    """Broadcast a written table of at most SMALL_ROWS rows; larger ones are shuffled."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def _stage(*needs: str):
    """A stage that reads the columns ``needs``; the others travel along, whatever their names.

    Tables may be empty. Null texts count as empty; null ids are ids.
    """

    def around(stage):
        @functools.wraps(stage)
        def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            inner, named = shield(docs, needs)
            return named(stage(spark, inner, sf_dir))

        return run

    return around


@_stage("doc_id", "lang", "text")
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept; cutoffs come from the labelled ones.

    Null, empty and blank texts have too few words and go. Repeated rows are judged alike.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    names = written(labels.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("_id")).distinct(), "labelled")
    labelled = docs.join(_if_small(names), F.col("doc_id") == F.col("_id"), "left_semi").select("doc_id", "lang", "text")
    stats = written(quality_rules.with_statistics(labelled).drop("text"), "statistics")
    judged = quality_rules.judge(quality_rules.with_statistics(docs), quality_rules.cutoffs(stats, labels))
    return judged.where("kept").select(*docs.columns)


@_stage("doc_id", "text", "n_chars")
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier line resembles; documents that lose all their lines go.

    A document without words has no lines to lose and stays, as does a null text. Repeated rows
    are one document and stay together.
    """
    kept = line_dedup.dedup_lines(docs).where("NOT emptied")
    return kept.select(
        *[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    )


@_stage("doc_id", "text")
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies (five words, 0.8 or more).

    Rows equal in id and text count as one document and stay together. Texts without words and
    null texts resemble nothing and stay.
    """
    found = ngram_join.join_documents(docs, 5, 80, 100)
    gone = written(
        found.where("doc_id <> component_id").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(),
        "near-copies",
    )
    return docs.join(
        _if_small(gone), (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_hash")), "left_anti"
    )


@_stage("doc_id", "text", "source", "lang")
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by calibrated probabilities that rake sources, languages and topics to their targets.

    Texts without words have no weight and are not drawn. Repeated rows are drawn or left together.
    """
    return mixing.mix(docs).where("sampled").select(*[F.col(f"`{c}`") for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the drawn documents with their places in sequences; a null text is one end token."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_join", near_copies),
    ("mixing", mixture),
    ("packing", packed),
]

#: Stages 3 to 5 (components, raking, packing) are not expressible in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
