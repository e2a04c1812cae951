"""Token counts of documents in flat token files that have no index.

A flat file is a run of ids; documents end with an end-of-document id and nothing
else marks them. Files are read in blocks of a fixed number of ids. Each block is
searched for separators in one vector operation; documents that cross blocks are
stitched by a prefix scan: for each block, the last separator in any earlier block of
the file. The scan runs inside slices of blocks and over one row per slice, so
neither a long file nor a document longer than a block meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.ordered import last_known_in_series
from tidemark.llm.tokens import WordEncoder, slices, tokenizer_path
from tidemark.session import scratch_path, written

BLOCK = 65_536
END_OF_DOCUMENT = 49_407
SLICE = 1_024

_BLOCKS = "file int, block long, ids binary, doc_ids array<long>"
_SEPARATORS = "file int, block long, n long, at array<int>, doc_ids array<long>"


def flat_blocks(
    docs: DataFrame, tokenizer: str | None = None, end_id: int = END_OF_DOCUMENT, block: int = BLOCK
) -> DataFrame:
    """Texts as flat files of 16-bit ids, one file per task, cut into blocks without regard to documents.

    ``doc_ids`` lists the documents that end in the block, in order: the names of what
    is stored, not their places. Text never yields ``end_id`` by itself.
    """

    def write(parts: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encoder = WordEncoder(tokenizer_path(tokenizer), plain_specials=True)
        file, number = TaskContext.get().partitionId(), 0
        end = np.asarray([end_id], dtype="<u2").tobytes()
        held, size, names = bytearray(), 2 * block, []

        def out(ids: bytes, ended: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([number], pa.int64()), pa.array([ids], pa.binary()),
                 pa.array([ended], pa.list_(pa.int64()))],
                names=["file", "block", "ids", "doc_ids"],
            )

        place = 0
        for batch in parts:
            for some in slices(batch, "text"):
                for doc, ids in zip(some.column("doc_id").to_pylist(), encoder.encode(some.column("text"))):
                    short = np.frombuffer(ids, dtype="<u4").astype("<u2").tobytes() + end
                    held += short
                    place += len(short)
                    names.append((place - 2, doc))
                    while len(held) >= size:
                        limit = (number + 1) * size
                        ended = [d for at, d in names if at < limit]
                        names = names[len(ended) :]
                        yield out(bytes(held[:size]), ended)
                        del held[:size]
                        number += 1
        if held:
            yield out(bytes(held), [d for _, d in names])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(write, _BLOCKS)


def read_flat_files(spark: SparkSession, path: str, block: int = BLOCK, width: int = 2) -> DataFrame:
    """Blocks of existing flat files (little-endian ids of ``width`` bytes); files are numbered by path.

    Spark hands over one file at a time, so files should be of a size that fits a task.
    """
    files = spark.read.format("binaryFile").load(path)
    size = block * width
    return files.select(
        F.abs(F.xxhash64("path")).alias("file"),
        F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.col("length") - 1) / size))).cast("array<int>")).alias("block"),
        "content",
    ).select(
        "file", F.col("block").cast("long"), F.substring("content", F.col("block") * size + 1, F.lit(size)).alias("ids"),
        F.lit(None).cast("array<long>").alias("doc_ids"),
    )


def separators(blocks: DataFrame, end_id: int = END_OF_DOCUMENT, dtype: str = "<u2") -> DataFrame:
    """Places of the separators in each block, found in one vector comparison."""

    def search(parts: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in parts:
            at, n = [], []
            for ids in batch.column("ids"):
                row = np.frombuffer(ids.as_buffer(), dtype=dtype)
                n.append(len(row))
                at.append(np.flatnonzero(row == end_id).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), pa.array(n, pa.int64()),
                 pa.array(at, pa.list_(pa.int32())), batch.column("doc_ids")],
                names=["file", "block", "n", "at", "doc_ids"],
            )

    kind = blocks.schema["file"].dataType.simpleString()
    return blocks.select("file", "block", "ids", "doc_ids").mapInArrow(search, _SEPARATORS.replace("int", kind, 1))


def token_counts(blocks: DataFrame, end_id: int = END_OF_DOCUMENT, dtype: str = "<u2", block: int = BLOCK) -> DataFrame:
    """A row per document: file, start, n_tokens (without the separator), doc_id where known, terminated.

    Two separators in a row enclose a document of 0 tokens. Ids after the last separator
    of a file are a document that is not terminated; an empty file has no documents.
    """
    found = written(separators(blocks, end_id, dtype), "separators")
    last = F.when(F.size("at") > 0, F.col("block") * block + F.element_at("at", -1))
    carried = last_known_in_series(
        found, ["file"], ["block"], {"carry": last}, F.floor(F.col("block") / SLICE)
    ).withColumn("carry", F.coalesce("carry", F.lit(-1).cast("long")))
    ends = carried.select(
        "file", "block", "carry", "at", "doc_ids", F.posexplode(F.transform("at", lambda x: F.col("block") * block + x)).alias("i", "end")
    )
    start = F.when(F.col("i") == 0, F.col("carry")).otherwise(
        F.col("block") * block + F.get("at", F.greatest(F.col("i") - 1, F.lit(0)))
    ) + 1
    whole = ends.select(
        F.get("doc_ids", F.col("i")).alias("doc_id"), "file", start.alias("start"),
        (F.col("end") - start).alias("n_tokens"), F.lit(True).alias("terminated"),
    )
    tails = found.groupBy("file").agg(
        F.max(F.coalesce(last, F.lit(-1).cast("long"))).alias("last"), F.max(F.col("block") * block + F.col("n")).alias("total")
    ).where("total > last + 1")
    rest = tails.select(
        F.lit(None).cast("long").alias("doc_id"), "file", (F.col("last") + 1).alias("start"),
        (F.col("total") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("terminated"),
    )
    return whole.unionByName(rest)


def stored_flat(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``flat_blocks`` written to the shared folder (as Parquet with strong compression) and read back."""
    spark = docs.sparkSession
    made, path = flat_blocks(docs, tokenizer), scratch_path(docs.sparkSession, "flat")
    made.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(made.schema).parquet(path)
