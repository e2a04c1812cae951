"""MinHash fingerprints of documents, likeness to neighbours, and near-duplicate classes.

A fingerprint holds, for each of PERMUTATIONS multiply-add hashes, the least value over
the word shingles of a text, reduced to 16 bits. Likeness is the share of equal values.
For near duplicates the values are cut into bands; documents that agree in a band are
candidates, found by a join in Spark, and linked when the exact Jaccard similarity of
their shingles reaches the threshold.

The successor in document order is found without sorting the table in one place:
document ids are cut into ranges, each range is sorted in its task, and the first row
of each range is also sent to the range before it (that of the first range to the last).
Texts are shuffled once; their shuffle files are removed before the bands are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.candidate_groups import resolve
from tidemark.llm.ngram_join import set_key
from tidemark.llm.shingles import mixed, shingle_list, shingle_sets
from tidemark.llm.tokens import slices
from tidemark.session import swept, written

WIDTH = 5
PERMUTATIONS = 128
BANDS, PER_BAND = 25, 5
RANGES_PER_PARTITION = 4
_NO_ID = -(1 << 63)
_CHUNK = 1 << 16
SLICE_BYTES = 1_000_000

_SEEDS = mixed(np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = (_SEEDS[:PERMUTATIONS] | np.uint64(1)).astype(np.uint32)
_SHIFTS = _SEEDS[PERMUTATIONS:].astype(np.uint32)

_OUT = (
    "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double, n long, key long"
)


def signatures(texts: list[str | None], width: int = WIDTH) -> np.ndarray:
    """One row of PERMUTATIONS 16-bit values per text; a text without words has all ones."""
    return _least_values(*shingle_list(texts, width))


def _least_values(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Signatures of texts from all their shingle hashes and where each text's begin."""
    hashes = (flat >> np.uint64(32)).astype(np.uint32)
    out = np.full((len(bounds) - 1, PERMUTATIONS), 0xFFFFFFFF, dtype=np.uint32)
    has = np.flatnonzero(np.diff(bounds) > 0)
    at = 0
    while at < len(has):
        # Texts whose shingles fit the processor's cache, at least one.
        stop = max(int(np.searchsorted(bounds[has], bounds[has[at]] + _CHUNK)), at + 1)
        part = hashes[bounds[has[at]] : bounds[has[stop - 1] + 1]]
        starts = bounds[has[at:stop]] - bounds[has[at]]
        for k in range(PERMUTATIONS):
            out[has[at:stop], k] = np.minimum.reduceat(part * _FACTORS[k] + _SHIFTS[k], starts)
        at = stop
    short = (mixed(out.astype(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)
    short[np.diff(bounds) == 0] = 0xFFFF
    return short


def _signed(signature: np.ndarray) -> bytes:
    return signature.astype(">u2").tobytes()


def _band_hashes(sig: np.ndarray) -> np.ndarray:
    """One row of BANDS hashes per signature."""
    cut = sig[:, : BANDS * PER_BAND].reshape(len(sig), BANDS, PER_BAND).astype(np.uint64)
    value = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sig), 1))
    for k in range(PER_BAND):
        value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + cut[:, :, k])
    return value.view(np.int64)


def _ranges(docs: DataFrame) -> tuple[DataFrame, int]:
    """``docs`` (doc_id, text) with a range number that does not fall along doc_id; nulls come first."""
    spark = docs.sparkSession
    count = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.coalesce(F.col("doc_id"), F.lit(_NO_ID)).cast("double")
    cuts = docs.agg(
        F.percentile_approx(order, [i / count for i in range(1, count)], 10 * count).alias("cuts")
    ).first()["cuts"]
    splits = [-float("inf"), *sorted(set(cuts or [0.0])), float("inf")]
    placed = Bucketizer(splits=splits, inputCol="_order", outputCol="_range").transform(docs.withColumn("_order", order))
    return placed.withColumn("_range", F.col("_range").cast("int")).drop("_order"), len(splits) - 1


def _packed(rows: DataFrame) -> DataFrame:
    """``rows`` (_range, _extra, doc_id, text) with texts compressed one by one, so that their only shuffle is small on disk."""

    def pack(parts: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in parts:
            for some in slices(batch, "text", SLICE_BYTES):
                texts = some.column("text").cast(pa.binary()).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [*[some.column(c) for c in ("_range", "_extra", "doc_id", "tie")], pa.array([squeeze(t) for t in texts], pa.binary())],
                    names=["_range", "_extra", "doc_id", "tie", "packed"],
                )

    return rows.select("_range", "_extra", "doc_id", F.xxhash64("text").alias("tie"), "text").mapInArrow(
        pack, "_range int, _extra int, doc_id long, tie long, packed binary"
    )


def with_successor(docs: DataFrame) -> DataFrame:
    """(_range, _extra, doc_id, packed), sorted inside each task so that the next row is the successor.

    Rows with ``_extra`` = 1 close their range and belong to the next one. Order is by
    doc_id (nulls first), then the text's hash; rows that repeat follow each other.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows, _ = _ranges(base)
    first = {r["_range"]: r["id"] for r in rows.groupBy("_range").agg(F.min(F.coalesce("doc_id", F.lit(_NO_ID))).alias("id")).collect()}
    used = sorted(first)
    homes = [(first[used[(i + 1) % len(used)]], r) for i, r in enumerate(used)]
    target = F.broadcast(spark.createDataFrame(homes, "_first long, _home int"))  # one row per range
    known = F.coalesce(F.col("doc_id"), F.lit(_NO_ID))
    extra = (
        base.join(target, known == F.col("_first"))
        .select(F.col("_home").alias("_range"), F.lit(1).alias("_extra"), "doc_id", "text")
    )
    both = _packed(rows.select("_range", F.lit(0).alias("_extra"), "doc_id", "text").unionByName(extra))
    return both.repartition("_range").sortWithinPartitions("_range", "_extra", F.col("doc_id").asc_nulls_first(), "tie")


def fingerprint(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """A row per document with its fingerprint, that of its edited text, two likenesses and its near-duplicate class.

    The edited text ends with the beginning of the next document in place of its last
    quarter. A null text counts as empty; two texts without words have likeness 1. Rows
    that repeat are each other's neighbours. An empty table gives no rows. ``component_id``
    is the class as ``near_duplicates`` finds it.
    """

    def run(parts: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa
        import zstandard

        spread = zstandard.ZstdDecompressor().decompress
        names = [c.split()[0] for c in _OUT.split(", ")]
        kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 3, pa.float64(), pa.float64(), pa.int64(), pa.int64())
        held = None
        for batch in parts:
            for some in slices(batch, "packed", SLICE_BYTES // 4):
                columns = [some.column(c).to_pylist() for c in ("_range", "_extra", "doc_id")]
                columns.append([spread(t).decode() for t in some.column("packed").to_pylist()])
                flat, bounds = shingle_list(columns[3], WIDTH)
                named = []
                for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    grams = np.unique(flat[i:j])
                    named.append((len(grams), set_key(grams)))
                rows = list(zip(zip(*columns, named), _least_values(flat, bounds)))
                if held is not None:
                    rows.insert(0, held)
                held = rows[-1]
                pairs = [(a, b) for a, b in zip(rows, rows[1:]) if not a[0][1] and a[0][0] == b[0][0]]
                edited = []
                for (a, _), (b, _) in pairs:
                    cut = len(a[3]) // 4
                    edited.append(a[3][: len(a[3]) - cut] + b[3][:cut])
                out: list[list] = [[] for _ in names]
                for ((a, sig), (_, after)), text, sig2 in zip(pairs, edited, signatures(edited) if edited else ()):
                    row = (
                        a[2], len(a[3]), hashlib.sha256(text.encode()).digest(), _signed(sig), _signed(sig2),
                        float((sig == sig2).mean()), float((sig == after).mean()), *a[4],
                    )
                    for column, v in zip(out, row):
                        column.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=names)

    def bands(parts: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in parts:
            if batch.num_rows:
                sig = np.frombuffer(b"".join(batch.column(0).to_pylist()), ">u2").reshape(batch.num_rows, PERMUTATIONS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(_band_hashes(sig)), pa.list_(pa.int64())), batch.column(1), batch.column(2)], names=["bands", "key", "n"]
                )

    rows = swept(with_successor(docs).mapInArrow(run, _OUT), "fingerprints")
    hashed = rows.where("key IS NOT NULL").select("fingerprint", "key", "n").mapInArrow(bands, "bands array<long>, key long, n long")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    classed = resolve(base, rows, _postings(hashed), _whole_sets, num, den, prefixes=False)
    text = lambda c: F.lower(F.hex(c)).alias(c)
    return classed.select(
        "doc_id", "n_chars", text("edited_sha256"), text("fingerprint"), text("edited_fingerprint"), "near_edited", "near_next",
        "n_shingles", "component_id",
    )


def _postings(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("bands").alias("token"), "key", "n")


def _whole_sets(chosen: DataFrame) -> DataFrame:
    """(key, ids) of documents (doc_id, text, key) whose set has that key."""

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in parts:
            for part in slices(batch, "text", SLICE_BYTES):
                sets = zip(part.column("key").to_pylist(), shingle_sets(part.column("text").to_pylist(), WIDTH))
                kept = [(k, np.sort(s.view(np.int64))) for k, s in sets if set_key(s) == k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in kept], pa.int64()), pa.array([s for _, s in kept], pa.list_(pa.int64()))],
                    names=["key", "ids"],
                )

    return chosen.select("key", F.col("text").cast("string").alias("text")).mapInArrow(run, "key long, ids array<long>")


def near_duplicates(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) of documents linked by bands and verified by exact Jaccard similarity.

    With 25 bands of 5 values, a pair at the threshold 0.8 meets in a band with
    probability 0.9999. Texts without words are linked with nothing.
    """

    def describe(parts: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in parts:
            for some in slices(batch, "text", SLICE_BYTES):
                texts = some.column("text").to_pylist()
                sets = shingle_sets(texts, WIDTH)
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([set_key(s) for s in sets], pa.int64()),
                     pa.array(list(_band_hashes(signatures(texts))), pa.list_(pa.int64()))],
                    names=["doc_id", "n", "key", "bands"],
                )

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = written(base.mapInArrow(describe, "doc_id long, n long, key long, bands array<long>"), "bands")
    postings = _postings(rows.where("key IS NOT NULL"))
    return resolve(base, rows.select("doc_id", "n", "key"), postings, _whole_sets, num, den, prefixes=False)
