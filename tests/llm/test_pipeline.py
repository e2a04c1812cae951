"""The stages of the corpus pipeline."""

import corpus_pipeline
from pyspark.sql import functions as F
from tidemark.session import written

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = written(stage(spark, docs, SF), name)
        assert kept.columns == docs.columns
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert {r["doc_id"] for r in kept.select("doc_id").collect()} <= before
        assert kept.where(F.col("n_chars") != F.length("text")).count() == 0
        docs = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.collect()}


def test_stages_keep_odd_rows_and_clashing_columns(odd, spark):
    """Every stage gives the caller's columns back with their own values, also for an empty table."""
    long_text = " ".join(f"word{i}" for i in range(80))
    good = odd.limit(1).withColumns({"doc_id": F.lit(50).cast("long"), "text": F.lit(long_text), "n_chars": F.length(F.lit(long_text)).cast("long")})
    for docs in (odd.unionByName(good), odd.where("false")):
        some = docs.count() > 0
        judged = corpus_pipeline.quality(spark, docs, SF)
        assert {r["doc_id"] for r in judged.collect()} == ({50} if some else set())
        for stage in (corpus_pipeline.lines, corpus_pipeline.near_copies, corpus_pipeline.mixture):
            kept = stage(spark, docs, SF)
            assert kept.columns == docs.columns
            rows = kept.collect()
            assert all(r["_s"] == "_s" and r["lines"] == "lines" and r["emptied"] == "emptied" and r["a.b"] == "a.b" and r["topic"] == "topic" for r in rows)
            if stage is not corpus_pipeline.mixture and some:
                assert {r["doc_id"] for r in rows} >= {None, 1, 2, 3, 4, 50}
