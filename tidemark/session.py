"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, AQE with skew handling)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only where the setting is absent (tests, a laptop) is a local folder made.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(folder)
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, one per use."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing reads any more."""
    for df in tables:
        new_path = df.sparkSession._jvm.org.apache.hadoop.fs.Path
        folder = new_path(shared_dir(df.sparkSession)).toUri().getPath()
        for path in {new_path(f).getParent().toString() for f in df.inputFiles()}:
            at = new_path(path)
            if not at.toUri().getPath().startswith(f"{folder}/"):
                raise ValueError(f"{path} is not below the shared folder")
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what it holds; an absent one is fine."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage by writing ``df`` to the shared folder and reading it back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def swept(df: DataFrame, label: str) -> DataFrame:
    """As ``written``; the shuffle files of the write go when it ends, not when the driver collects garbage."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return written(df, label)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def spread(df: DataFrame) -> DataFrame:
    """Give a table of a few unsplittable files to all cores; larger ones stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
