"""Row-level helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluated_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose expressions are computed exactly once per row.

    A filter on an ordinary derived column is pushed below the projection with
    the expression copied into it, which would parse the same JSON again for
    every mention. The output of a generator is opaque to that rewrite, so a
    one-element ``explode`` keeps the work in one place, inside codegen.
    """
    packed = F.struct(*[expr.alias(name) for name, expr in columns.items()])
    held = df.select("*", F.explode(F.array(packed)).alias("_once"))
    return held.select(*df.columns, *[F.col("_once")[name].alias(name) for name in columns])


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame as a scalar subquery; nothing is joined."""
    held = df.withColumn("_one", one_row.select(F.struct(*one_row.columns)).scalar())
    return held.select(*df.columns, *[F.col("_one")[c].alias(c) for c in one_row.columns])
