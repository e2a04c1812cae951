"""Whitening of embeddings with distributed block matrices.

1. Rows are scaled to whole numbers and gathered, in the order a task meets them, into
   blocks of a fixed number of rows. Only complete blocks are numbered; the last one of a
   task is filled up with rows of zeros, which add nothing to a product.
2. The fit list is each distinct row once (an aggregate, so copies weigh nothing and meet
   nowhere). Its count and sums are exact whole numbers.
3. Centred blocks form a BlockMatrix; its transpose times itself is the scatter matrix.
   The row dimension of that product is split, so that a task holds SPLIT_BLOCKS blocks,
   and the partial products are added up. The scatter matrix (dimensions squared) goes to
   the driver, where its eigenvectors give the whitening matrix.
4. A second BlockMatrix, of all rows, is multiplied by the whitening matrix; each block of
   the product meets the ids of its rows again.

The driver holds numbers in proportion to the dimensions squared, and one small count per
task. Blocks are written to the shared folder before they are used, so a lost executor
costs the reading of its blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.mllib.linalg import DenseMatrix, Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import discard, written

SCALE = 256
COMPONENTS = 4
BLOCK_VALUES = 1 << 17
MOST_ROWS = 4096
SPLIT_BLOCKS = 16
#: Components whose eigenvalue is below this share of the trace have no direction of their own.
FLAT = 1e-12

_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
_BLOCKS = "part int, local int, m int, ids array<long>, x binary"


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): rows whose vector is whole and finite, as whole numbers ``floor(scale * c)``.

    Vectors of another length than the commonest one (of ties, the longest) are dropped, as
    are empty ones; a value beyond a long becomes the nearest long.
    """
    values = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("c")
    ).where(
        (F.size("c") > 0)
        & ~F.exists("c", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    )
    lengths = values.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = lengths[0]["d"] if lengths else 0
    return values.where(F.size("c") == d).select("vec_id", F.transform("c", lambda v: F.floor(v * scale)).alias("x"))


def _rows_per_block(d: int) -> int:
    return max(1, min(MOST_ROWS, BLOCK_VALUES // d))


def blocked(rows: DataFrame, d: int) -> DataFrame:
    """``rows`` (vec_id, x) in blocks: numbered inside the task, ``m`` rows with their ids and values."""
    most = _rows_per_block(d)

    def gather(parts: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        part, local = TaskContext.get().partitionId(), 0
        ids, values = [], np.empty((0, d), dtype=np.int64)

        def block(some, x):
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([local], pa.int32()), pa.array([len(some)], pa.int32()),
                 pa.array([some], pa.list_(pa.int64())), pa.array([x.astype("<i8").tobytes()], pa.binary())],
                names=["part", "local", "m", "ids", "x"],
            )

        for batch in parts:
            ids += batch.column(0).to_pylist()
            values = np.concatenate([values, batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)])
            while len(ids) >= most:
                yield block(ids[:most], values[:most])
                ids, values, local = ids[most:], values[most:], local + 1
        if ids:
            yield block(ids, values)

    return rows.select("vec_id", "x").mapInArrow(gather, _BLOCKS)


def numbered(blocks: DataFrame) -> tuple[DataFrame, int]:
    """Written blocks with their place ``block`` in the whole matrix, and how many there are; one count per task is collected."""
    counts = {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = {}, 0
    for part in sorted(counts):
        starts[part], total = total, total + counts[part]
    shift = blocks.sparkSession.createDataFrame(list(starts.items()) or [(0, 0)], "part int, first int")
    return blocks.join(F.broadcast(shift), "part").withColumn("block", F.col("first") + F.col("local")).drop("first"), total


def _whole(raw: bytes, d: int) -> np.ndarray:
    return np.frombuffer(raw, dtype="<i8").reshape(-1, d)


def _exact(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums`` as longs, or as Python numbers where longs could overflow."""
    reach = float(n) * float(np.abs(x.astype(float)).max(initial=0.0)) + float(max((abs(int(s)) for s in sums), default=0))
    if reach < 2.0**62:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums.astype(object)


def fit_sums(fit: DataFrame, d: int) -> tuple[int, np.ndarray]:
    """Number of rows of the blocks and their exact sum per dimension."""

    def add(parts: Iterator) -> Iterator:
        import pyarrow as pa

        n, sums = 0, np.zeros(d, dtype=object)
        for batch in parts:
            for raw in batch.column("x").to_pylist():
                x = _whole(raw, d)
                n += len(x)
                sums += x.sum(axis=0) if float(np.abs(x.astype(float)).max()) < 2.0**50 else x.astype(object).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([n], pa.int64()), pa.array([[str(s) for s in sums]], pa.list_(pa.string()))], names=["n", "sums"]
        )

    parts = fit.select("x").mapInArrow(add, "n long, sums array<string>")
    total = parts.select("n", F.posexplode("sums").alias("k", "s")).groupBy("k").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    ).collect()
    sums = np.zeros(d, dtype=object)
    for r in total:
        sums[r["k"]] = int(r["s"])
    return (int(total[0]["n"]) if total else 0), sums


def centred_matrix(blocks: DataFrame, count: int, d: int, n: int, sums: np.ndarray) -> BlockMatrix:
    """The blocks less the fit list's mean, as a BlockMatrix of one block column."""
    most = _rows_per_block(d)

    def block(row):
        x = _whole(row["x"], d)
        full = np.zeros((most, d))
        full[: len(x)] = _exact(x, n, sums).astype(float) / n
        return (row["block"], 0), DenseMatrix(most, d, full.ravel(order="F"))

    return BlockMatrix(blocks.select("block", "x").rdd.map(block), most, d, count * most, d)


def _gram(left: BlockMatrix, blocks: int) -> np.ndarray:
    """Transpose of a matrix times itself; the long dimension is split so that a task holds SPLIT_BLOCKS of its blocks."""
    splits = -(-blocks // SPLIT_BLOCKS)
    turned = left.transpose()
    made = turned._java_matrix_wrapper.call("multiply", left._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(made, turned.rowsPerBlock, left.colsPerBlock).toLocalMatrix().toArray()


def whitening_matrix(covariance: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Columns ``unit eigenvector / sqrt(e)`` by falling eigenvalue, and the share of the trace of each.

    Eigenvalues of at most FLAT of the trace have a column of NaN.
    """
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    trace = float(np.trace(covariance))
    kept = np.where(values[order] > FLAT * trace, values[order], np.nan)
    return vectors[:, order] / np.sqrt(kept), values[order] / trace if trace > 0 else np.full(len(order), np.nan)


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per row and component.

    ``vectors`` has vec_id and embedding. Rows without a whole finite vector are left out (see
    ``scaled``), rows that repeat are reported as often as they come, and a null id stays null.
    Where a component has no variance (all rows equal, fewer distinct rows than components)
    ``whitened`` is null, ``explained`` is null only if there is no variance at all, and
    ``identity_error`` covers the other components, null if there are none. ``deviation`` is
    null where it exceeds a long. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = written(scaled(vectors, scale), "scaled")
    head = rows.select(F.size("x").alias("d")).head()
    if head is None:
        discard(rows)
        return spark.createDataFrame([], _OUT)
    d = head["d"]
    fit = written(blocked(rows.groupBy("x").agg(F.lit(None).cast("long").alias("vec_id")), d), "fit-blocks")
    everything = written(blocked(rows, d), "row-blocks")
    discard(rows)
    n, sums = fit_sums(fit, d)
    placed, count = numbered(fit)
    centred = centred_matrix(placed, count, d, n, sums)
    columns, explained = whitening_matrix(_gram(centred, count) / n, components)
    k, sound = columns.shape[1], np.isfinite(columns[0])
    most = _rows_per_block(d)
    kernel = Matrices.dense(d, k, np.where(sound, columns, 0.0).ravel(order="F"))
    kernel = BlockMatrix(spark.sparkContext.parallelize([((0, 0), kernel)], 1), d, k)
    gram = _gram(centred.multiply(kernel), count) / n
    error = float(np.abs(gram - np.eye(k))[np.ix_(sound, sound)].max()) if sound.any() else None
    discard(fit)

    placed, count = numbered(everything)
    product = centred_matrix(placed, count, d, n, sums).multiply(kernel)
    projected = product.blocks.map(
        lambda b: (int(b[0][0]), np.asarray(b[1].toArray(), dtype=float).reshape(most, k).ravel().tolist())
    ).toDF("block int, projected array<double>")

    def deviations(parts: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in parts:
            out = []
            for raw in batch.column("x").to_pylist():
                apart = _exact(_whole(raw, d), n, sums)
                if apart.dtype != object and float(np.abs(apart).max(initial=0)) ** 2 * d < 2.0**62:
                    out.append((apart * apart).sum(axis=1).tolist())
                else:
                    total = (apart.astype(object) ** 2).sum(axis=1)
                    out.append([int(t) if t < 1 << 63 else None for t in total])
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("ids"), pa.array(out, pa.list_(pa.int64()))], names=["block", "ids", "deviation"]
            )

    named = placed.select("block", "ids", "x").mapInArrow(deviations, "block int, ids array<long>, deviation array<long>")
    listed = named.join(projected, "block").select(F.posexplode("ids").alias("i", "vec_id"), "deviation", "projected")
    number = lambda v: F.lit(None if v is None or not np.isfinite(v) else float(v)).cast("double")
    per_component = F.array(*[
        F.struct(
            F.lit(c + 1).alias("component"), F.lit(bool(sound[c])).alias("sound"), number(explained[c]).alias("explained")
        ) for c in range(k)
    ])
    return listed.select("i", "vec_id", "deviation", "projected", F.explode(per_component).alias("e")).select(
        "vec_id", F.col("e.component").alias("component"), F.lit(n).cast("long").alias("n"),
        F.get("deviation", F.col("i")).alias("deviation"),
        F.when(F.col("e.sound"), F.get("projected", F.col("i") * k + F.col("e.component") - 1)).alias("whitened"),
        F.col("e.explained").alias("explained"), number(error).alias("identity_error"),
    )
