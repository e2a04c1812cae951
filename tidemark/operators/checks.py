"""Table tests and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.silver import as_timestamp


def test_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls are not counted."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where("occurrences > 1")
    )


def test_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where the column is null."""
    return df.where(F.col(column).isNull())


def test_accepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with counts; nulls are not counted."""
    return (
        df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


# Names the test runner must not collect.
for _check in (test_unique, test_not_null, test_accepted):
    _check.__test__ = False


def freshness(
    df: DataFrame, column: str, as_of=None, warn_seconds: int = 3600, error_seconds: int = 21600
) -> DataFrame:
    """One row: newest value, its age in seconds, and pass, warn or error (also for no rows)."""
    newest = df.agg(F.max(column).alias("max_loaded_at"))
    age = (F.unix_micros(as_timestamp(as_of)) - F.unix_micros("max_loaded_at")) / F.lit(1e6)
    return newest.withColumn("age_seconds", age).withColumn(
        "status",
        F.when(F.col("age_seconds").isNull() | (F.col("age_seconds") > error_seconds), "error")
        .when(F.col("age_seconds") > warn_seconds, "warn")
        .otherwise("pass"),
    )


def reconcile_counts(source: Mapping[str, DataFrame], target: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table on both sides and the difference.

    Every table contributes one partial count; only those single rows are joined.
    """

    def counted(frames: Mapping[str, DataFrame], name: str) -> DataFrame:
        parts = [
            df.agg(F.count(F.lit(1)).alias(name)).select(F.lit(t).alias("table"), name)
            for t, df in frames.items()
        ]
        return reduce(DataFrame.unionByName, parts)

    both = counted(source, "source_rows").join(counted(target, "target_rows"), "table", "full_outer")
    have = {n: F.coalesce(n, F.lit(0)) for n in ("source_rows", "target_rows")}
    return both.select(
        "table",
        *[c.alias(n) for n, c in have.items()],
        (have["target_rows"] - have["source_rows"]).alias("delta"),
    )


def reconcile_rows(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys that are missing or extra in the target, or differ, with the differing columns."""

    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, F.struct(*columns).alias(name))

    both = packed(source, "_s").join(packed(target, "_t"), key, "full_outer")
    s, t = F.col("_s"), F.col("_t")
    differing = F.array_compact(
        F.array(*[F.when(~s[c].eqNullSafe(t[c]), F.lit(c)) for c in columns])
    )
    issue = (
        F.when(t.isNull(), "missing_in_target")
        .when(s.isNull(), "extra_in_target")
        .when(F.size(differing) > 0, "mismatch")
    )
    return (
        both.withColumn("issue", issue)
        .where("issue IS NOT NULL")
        .select(
            key,
            "issue",
            F.when(F.col("issue") == "mismatch", F.array_join(differing, ",")).alias("columns"),
        )
    )


def lost_rows(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Source rows that the target lacks, counted as often as they are lacking."""
    return source.select(*columns).exceptAll(target.select(*columns))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose parent is absent; a null reference is no orphan."""
    known = parent.select(F.col(parent_key).alias(child_key))
    return child.where(F.col(child_key).isNotNull()).join(known, child_key, "left_anti")


def union_feeds(frames: Sequence[DataFrame]) -> DataFrame:
    """Frames of differing columns as one feed; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def target_columns(spark, table: str) -> list[str]:
    """Ordered column names of a catalog table."""
    return [c.name for c in spark.catalog.listColumns(table)]


def check_target_columns(df: DataFrame, expected: Sequence[str]) -> dict[str, list[str]]:
    """Columns a change set lacks or adds compared with a target table."""
    return {
        "missing": [c for c in expected if c not in df.columns],
        "extra": [c for c in df.columns if c not in expected],
    }


def ensure_namespace(spark, namespace: str) -> None:
    """Create the schema of a target table when it is absent."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{namespace}`")
