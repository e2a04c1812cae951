"""Exact n-gram Jaccard join of whole documents, through prefix trees.

1. A document is the set of its word n-grams as 64-bit hashes. Documents with the same
   set are one class. Counts in a fixed number of buckets estimate how common each gram
   is; an id is that rank above the hash, so numeric order puts rare grams first.
2. Two sets can only reach the threshold if they share one of their first
   ``n - ceil(t * n) + 1`` ids. Ids that only one class has there are dropped by an
   aggregate that combines on the map side.
3. Ids of few classes give pairs; the number of ids a pair shares bounds its overlap, and
   most pairs end there. The others, and the classes of larger groups, are sent to a leader:
   the smaller of the pair, the smallest of the group. A leader's classes are cut into
   blocks of bounded total size (the leader is in all), and each block is joined through a
   prefix tree. The links are merged into components.
4. What is left are larger groups with classes in different components. Their classes are
   joined in pairs of blocks, so every pair of classes that shares an id meets unless it is
   connected already, and nothing emits all pairs of a large group.

Only connecting links are kept, which is what components need. Texts are read three
times; sets leave a task only for classes that share an id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.candidate_groups import resolve
from tidemark.llm.shingles import shingle_sets
from tidemark.llm.tokens import slices
from tidemark.session import discard, written

BUCKETS = 1 << 20
CHUNK = 1 << 12
SLICE_BYTES = 1_000_000


def _over_texts(docs: DataFrame, width: int, schema: str, rows: Callable) -> DataFrame:
    """mapInArrow over (doc_id, text): ``rows(ids, sets)`` yields record batches."""

    def run(parts: Iterator) -> Iterator:
        for batch in parts:
            for some in slices(batch, "text", SLICE_BYTES):
                yield from rows(some.column("doc_id").to_pylist(), shingle_sets(some.column("text").to_pylist(), width))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, schema
    )


def set_key(ids: np.ndarray) -> int | None:
    """64-bit name of a set; none for the empty set."""
    if not len(ids):
        return None
    return int.from_bytes(hashlib.blake2b(ids.tobytes(), digest_size=8).digest(), "little", signed=True)


def _bucket(ids: np.ndarray) -> np.ndarray:
    return (ids & np.uint64(BUCKETS - 1)).astype(np.int64)


def describe(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, key, text_hash) per document, and (chunk, counts) rows with the gram counts of each task."""
    names = ["doc_id", "n", "key", "text_hash", "chunk", "counts"]

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa

        counts = np.zeros(BUCKETS, dtype=np.uint32)
        for batch in parts:
            for some in slices(batch, "text", SLICE_BYTES):
                ids, texts, hashes = (some.column(i).to_pylist() for i in range(3))
                sets = shingle_sets(texts, width)
                counts += np.bincount(_bucket(np.concatenate(sets)), minlength=BUCKETS).astype(np.uint32)
                columns = (ids, [len(s) for s in sets], [set_key(s) for s in sets], hashes)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, pa.int64()) for c in columns], pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.binary())],
                    names=names,
                )
        parts_of = counts.reshape(-1, CHUNK)
        used = np.flatnonzero(parts_of.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [*[pa.nulls(len(used), pa.int64())] * 4, pa.array(used, pa.int32()),
             pa.array([parts_of[k].tobytes() for k in used], pa.binary())],
            names=names,
        )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"), F.xxhash64("text")).mapInArrow(
        run, "doc_id long, n long, key long, text_hash long, chunk int, counts binary"
    )


def rarity(described: DataFrame) -> np.ndarray:
    """Rank (0 rarest, at most 255) of each bucket from the counts of the whole table; BUCKETS numbers.

    The tasks' counts are added up chunk by chunk in a stream, so what a task holds does not grow with them.
    """

    def add(parts: Iterator) -> Iterator:
        import pyarrow as pa

        sums: dict[int, np.ndarray] = {}
        for batch in parts:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums.setdefault(k, np.zeros(CHUNK))
                sums[k] += np.frombuffer(c.as_buffer(), dtype=np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
            names=["chunk", "counts"],
        )

    counts = np.zeros((BUCKETS // CHUNK, CHUNK))
    added = described.where("chunk IS NOT NULL").select("chunk", "counts").repartition("chunk").mapInArrow(add, "chunk int, counts binary")
    for row in added.collect():
        counts[row["chunk"]] = np.frombuffer(row["counts"])
    return np.minimum(4 * np.log2(1 + counts.reshape(-1)), 255).astype(np.uint8)


def ordered_ids(hashes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Ids whose numeric order is the global order, rare grams first; sorted."""
    return np.sort((ranks[_bucket(hashes)].astype(np.uint64) << np.uint64(55)) | (hashes >> np.uint64(9))).view(np.int64)


def _postings(docs: DataFrame, width: int, ranks, num: int, den: int) -> DataFrame:
    import pyarrow as pa

    def rows(_, sets):
        columns: list[list] = [[], [], []]
        for s in sets:
            if len(s):
                first = len(s) - -(-num * len(s) // den) + 1
                ids = ordered_ids(s, ranks.value)[:first]
                for column, v in zip(columns, (ids, set_key(s), len(s))):
                    column.append(v if column is columns[0] else np.full(first, v, dtype=np.int64))
        if columns[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=["token", "key", "n"])

    return _over_texts(docs, width, "token long, key long, n long", rows)


def _sets(chosen: DataFrame, width: int, ranks) -> DataFrame:
    """(key, ids) of documents (doc_id, text, key) whose set has that key."""
    import pyarrow as pa

    def rows(keys, sets):
        kept = [(k, s) for k, s in zip(keys, sets) if set_key(s) == k]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in kept], pa.int64()),
             pa.array([ordered_ids(s, ranks.value) for _, s in kept], pa.list_(pa.int64()))],
            names=["key", "ids"],
        )

    return _over_texts(chosen.select(F.col("key").alias("doc_id"), "text"), width, "key long, ids array<long>", rows)


def join_documents(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id, text_hash) per document: links are Jaccard similarity >= num/den.

    ``component_id`` is the smallest doc_id reachable by links. Texts without words
    (null, empty, blank) have 0 shingles and are linked with nothing. Rows that repeat are
    reported as often as they come; a null id stays null and does not count as smallest.
    """
    spark = docs.sparkSession
    described = written(describe(docs, width), "described")
    ranks = spark.sparkContext.broadcast(rarity(described))
    rows = described.where("chunk IS NULL").select("doc_id", "n", "key", "text_hash")
    postings = written(_postings(docs, width, ranks, num, den), "postings")

    def sets_of(chosen: DataFrame) -> DataFrame:
        return _sets(chosen, width, ranks)

    out = resolve(docs, rows, postings, sets_of, num, den, prefixes=True)
    discard(postings)
    return out
