"""Registered queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL where there is one."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Columns in types two engines print alike.

    Decimals and floats become doubles, integers become bigint, dates and
    timestamps become text.
    """
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            col = col.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            col = col.cast("bigint")
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            col = col.cast("string")
        out.append(col.alias(field.name))
    return df.select(*out)
