"""Windowed aggregates over live events, bounded by watermarks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import count_if


def tumbling_counts(
    events: DataFrame, ts: str, width: str, by: Sequence[str] = (), delay: str = "10 minutes"
) -> DataFrame:
    """Events per fixed window and group."""
    return (
        events.withWatermark(ts, delay)
        .groupBy(F.window(ts, width).alias("_w"), *by)
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.col("_w.start").alias("window_start"), *by, "events")
    )


def sliding_rate(
    events: DataFrame, ts: str, width_seconds: int, step_seconds: int, by: Sequence[str] = (), delay: str = "10 minutes"
) -> DataFrame:
    """Events per second over overlapping windows."""
    window = F.window(ts, f"{width_seconds} seconds", f"{step_seconds} seconds")
    return (
        events.withWatermark(ts, delay)
        .groupBy(window.alias("_w"), *by)
        .agg(F.count(F.lit(1)).alias("events"))
        .select(
            F.col("_w.end").alias("window_end"), *by, "events",
            (F.col("events") / F.lit(float(width_seconds))).alias("rate_per_second"),
        )
    )


def live_daily_revenue(stg_orders: DataFrame, delay: str = "2 days") -> DataFrame:
    """The additive columns of the daily mart, kept up to date per day."""
    amount = F.col("total_amount")
    nothing = F.lit(0).cast("decimal(12,2)")
    return (
        stg_orders.where("is_valid_record")
        .withWatermark("ordered_at", delay)
        .groupBy(F.window("ordered_at", "1 day").alias("_w"))
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            count_if(F.col("is_completed")).alias("completed_orders"),
            F.sum(amount).alias("gross_revenue"),
            F.sum(F.when(F.col("is_completed"), amount).otherwise(nothing)).alias("realized_revenue"),
        )
        .select(F.to_date("_w.start").alias("order_date"), "total_orders", "completed_orders", "gross_revenue", "realized_revenue")
    )
