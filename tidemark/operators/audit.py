"""Audit logs: storing, querying, hash chains, statistics."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.ordered import previous_in_series, running_sum_in_series

SCHEMA = (
    "event_id string, event_type string, timestamp timestamp, level string, user string, service string, "
    "resource string, resource_id string, action string, result string, details map<string,string>, "
    "ip_address string, user_agent string, request_id string, previous_hash string"
)


def append_audit(df: DataFrame, path: str, mode: str = "append") -> None:
    """JSON lines in one folder per day; null fields are left out."""
    df.withColumn("day", F.to_date("timestamp")).write.mode(mode).partitionBy("day").json(path)


def read_audit(spark: SparkSession, path: str, from_day=None, to_day=None) -> DataFrame:
    """Stored audit events; days outside the range are not read."""
    events = spark.read.schema(SCHEMA + ", day date").json(path)
    if from_day is not None:
        events = events.where(F.col("day") >= F.lit(from_day).cast("date"))
    if to_day is not None:
        events = events.where(F.col("day") <= F.lit(to_day).cast("date"))
    return events


def query_audit(
    events: DataFrame,
    start=None,
    end=None,
    event_type: str | None = None,
    user: str | None = None,
    level: str | None = None,
    limit: int | None = None,
    tie_break: Sequence[str] = ("event_id",),
) -> DataFrame:
    """All given conditions, both times included, newest first.

    With ``limit`` only that many rows are kept, of which Spark holds as many per task.
    """
    found = events
    if start is not None:
        found = found.where(F.col("timestamp") >= F.lit(start).cast("timestamp"))
    if end is not None:
        found = found.where(F.col("timestamp") <= F.lit(end).cast("timestamp"))
    for name, wanted in (("event_type", event_type), ("user", user), ("level", level)):
        if wanted is not None:
            found = found.where(F.col(name) == wanted)
    newest = found.orderBy(F.col("timestamp").desc(), *[F.col(c).desc() for c in tie_break])
    return newest if limit is None else newest.limit(limit)


def latest(events: DataFrame, n: int, ts: str = "timestamp", tie_break: Sequence[str] = ("event_id",)) -> DataFrame:
    """The most recent ``n`` rows."""
    return events.orderBy(F.col(ts).desc(), *[F.col(c).desc() for c in tie_break]).limit(n)


def chain_breaks(lines: DataFrame, slice_rows: int = 100_000) -> DataFrame:
    """Lines whose ``previous_hash`` is not the sha256 of the line before.

    ``lines`` has log, position (whole numbers in file order) and line. The first
    line of a log must have none.
    """
    seen = previous_in_series(
        lines,
        ["log"],
        ["position"],
        {"_expected": F.sha2("line", 256)},
        F.floor(F.col("position") / slice_rows).cast("bigint"),
    )
    stated = F.get_json_object("line", "$.previous_hash")
    return seen.where(~stated.eqNullSafe(F.col("_expected"))).select("log", "position")


def verify_chain(lines: DataFrame, slice_rows: int = 100_000) -> DataFrame:
    """Per log: whether the chain holds, and the first position where it breaks."""
    broken = chain_breaks(lines, slice_rows).groupBy("log").agg(F.min("position").alias("first_break"))
    logs = lines.groupBy("log").agg(F.count(F.lit(1)).alias("lines"))
    return logs.join(broken, "log", "left").select(
        "log", "lines", F.col("first_break").isNull().alias("intact"), "first_break"
    )


def number_lines(
    events: DataFrame, order: Sequence[str], slice_by: Column, rotate_rows: int = 100_000, log: str = "log"
) -> DataFrame:
    """Place each record in its log: ``segment`` (a rotated file) and ``position`` in it."""
    numbered = running_sum_in_series(events, [log], order, {"_nth": F.lit(1)}, slice_by)
    before = F.col("_nth") - 1
    return numbered.withColumns(
        {
            "segment": F.floor(before / rotate_rows).cast("bigint"),
            "position": (before % rotate_rows).cast("bigint"),
        }
    ).drop("_nth")


def _link(records: pd.DataFrame) -> pd.DataFrame:
    """Chain one segment: each record carries the hash of the line written before it."""
    lines, previous = [], None
    for text in records.sort_values("position")["record"]:
        if previous is not None:
            record = json.loads(text)
            record["previous_hash"] = previous
            text = json.dumps(record, ensure_ascii=False, separators=(",", ":"))
        lines.append(text)
        previous = hashlib.sha256(text.encode("utf-8")).hexdigest()
    return pd.DataFrame(
        {
            "log": records["log"],
            "segment": records["segment"],
            "position": sorted(records["position"]),
            "line": lines,
        }
    )


def build_chain(records: DataFrame) -> DataFrame:
    """Chained lines from log, segment, position and record (compact JSON without a hash).

    Every hash covers the one before, so a segment is written in order; a log is
    cut into segments of bounded size by ``number_lines`` (a rotated file starts a
    new chain), which run in parallel.
    """
    schema = "log string, segment bigint, position bigint, line string"
    narrow = records.select(F.col("log").cast("string").alias("log"), "segment", "position", "record")
    return narrow.groupBy("log", "segment").applyInPandas(_link, schema)


def audit_counts(events: DataFrame, by: Sequence[str]) -> DataFrame:
    """Events by any of type, level, user, result."""
    return events.groupBy(*by).agg(F.count(F.lit(1)).alias("events"))


def denied_bursts(
    events: DataFrame, at_least: int = 5, window: str = "5 minutes", denied: Column | None = None
) -> DataFrame:
    """Users with many denied accesses inside one window."""
    test = denied if denied is not None else (F.col("event_type") == "access.denied")
    return (
        events.where(test)
        .groupBy("user", F.window("timestamp", window).alias("_w"))
        .agg(F.count(F.lit(1)).alias("denied"))
        .where(F.col("denied") >= at_least)
        .select("user", F.col("_w.start").alias("window_start"), "denied")
    )
