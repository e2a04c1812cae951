"""Metric samples: counters, gauges, histograms, percentiles, rates, exposition.

A series is a metric name plus labels; few series hold many samples, so ordered
work goes through the sliced functions of ``tidemark.functions.ordered``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import count_if, ratio
from tidemark.functions.ordered import (
    previous_in_series,
    running_sum_in_series,
    since_window_start,
    time_slice,
    trailing_window,
)
from tidemark.functions.rows import attach_one_row
from tidemark.operators.silver import as_timestamp
from tidemark.session import written

# Latency bucket bounds in seconds, and the reported percentiles.
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
PERCENTILES = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99, "p999": 0.999}


def read_metrics(spark, path: str, fmt: str = "parquet") -> DataFrame:
    """Stored samples: ts, name, labels, value."""
    schema = "ts timestamp, name string, labels map<string,string>, value double"
    return spark.read.schema(schema).format(fmt).load(path)


def label_text(labels: Column) -> Column:
    """Labels in name order as ``a="x",b="y"``, usable as a grouping and join key."""
    entries = F.array_sort(F.map_entries(labels))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit('="'), e["value"], F.lit('"'))), ","
    )


def counter_totals(increments: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """Sum of increments per label set; negative ones are rejected and counted."""
    amount = F.col(value)
    return increments.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(amount >= 0, amount)), F.lit(0)).alias("total"),
        count_if(amount < 0).alias("rejected"),
    )


def gauge_current(
    updates: DataFrame, by: Sequence[str], order: Sequence[str], action: str = "action", value: str = "value"
) -> DataFrame:
    """Latest ``set`` per label set, moved by later ``inc`` and ``dec``."""
    at = F.struct(*[F.col(c) for c in order])
    is_set = F.col(action) == "set"
    sets = updates.groupBy(*by).agg(
        F.max(F.when(is_set, at)).alias("_set_at"),
        F.max_by(value, F.when(is_set, at)).alias("_set"),
    )
    moved = F.when(F.col(action) == "inc", F.col(value)).when(F.col(action) == "dec", -F.col(value))
    later = F.col("_set_at").isNull() | (at > F.col("_set_at"))
    return (
        updates.join(sets, list(by))
        .groupBy(*by)
        .agg(
            F.coalesce(F.first("_set"), F.lit(0)).alias("_set"),
            F.coalesce(F.sum(F.when(later, moved)), F.lit(0)).alias("_moved"),
        )
        .select(*by, (F.col("_set") + F.col("_moved")).alias("value"))
    )


def histogram(
    df: DataFrame, value: str, bounds: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """One row per group and bucket: count, cumulative count, and the group's totals.

    All buckets are counted in one aggregate, so empty ones show as 0 and a group
    without rows (no ``by``) gives zeros. The last bucket has ``le`` infinity.
    """
    v = F.col(value)
    counts = [count_if(v <= b).alias(f"_c{i}") for i, b in enumerate(bounds)]
    totals = df.groupBy(*by).agg(
        *counts,
        F.count(v).alias("count"),
        F.coalesce(F.sum(v), F.lit(0)).alias("sum"),
        F.coalesce(F.min(v), F.lit(0)).alias("min"),
        F.coalesce(F.max(v), F.lit(0)).alias("max"),
    )
    cumulative = [F.col(f"_c{i}") for i in range(len(bounds))] + [F.col("count")]
    edges = [*bounds, float("inf")]
    buckets = F.array(
        *[
            F.struct(
                F.lit(float(edge)).alias("le"),
                (cumulative[i] - (cumulative[i - 1] if i else F.lit(0))).alias("bucket_count"),
                cumulative[i].alias("cumulative_count"),
            )
            for i, edge in enumerate(edges)
        ]
    )
    return totals.withColumn("_b", F.explode(buckets)).select(
        *by, "_b.*", "count", "sum", "min", "max", ratio(F.col("sum"), F.col("count"), 0.0).alias("avg")
    )


#: Distinct values in a slice, about.
SLICE_VALUES = 100_000
_MOST_SLICES = 10_000


def _ranked_values(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Distinct values per group with ``_upto`` (rows up to the value) and ``_n`` (all rows).

    Equal values are counted before anything is ordered. The running count is
    taken in value slices whose borders come from a mergeable quantile sketch, so
    the exact result never needs a whole group in one task.
    """
    counted = written(
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_rows")),
        "value-counts",
    )
    # As many slices as the largest group needs; a small one is a single slice.
    largest = counted.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n").alias("n")).first()["n"] or 1
    splits = min(-(-largest // SLICE_VALUES), _MOST_SLICES)
    cuts = [i / splits for i in range(1, splits)] or [1.0]
    edges = counted.groupBy(*by).agg(
        F.percentile_approx("_value", cuts, max(1000, 4 * splits)).alias("_cuts"), F.sum("_rows").alias("_n")
    )
    placed = counted.join(edges, list(by)) if by else attach_one_row(counted, edges)
    slice_no = F.size(F.filter("_cuts", lambda c: c < F.col("_value"))).cast("bigint")
    placed = placed.withColumn("_slice_no", slice_no).drop("_cuts")
    return running_sum_in_series(
        placed, list(by), ["_value"], {"_upto": F.col("_rows")}, F.col("_slice_no")
    )


def _at_rank(index: Column) -> Column:
    """Smallest value with more than ``index`` rows up to it (0-based rank)."""
    return F.min(F.when(F.col("_upto") > index, F.col("_value")))


def _rank_index(p: float) -> Column:
    return F.least(F.floor(F.col("_n").cast("double") * F.lit(float(p))), F.col("_n") - 1)


def rank_percentile(
    df: DataFrame, value: str, percentiles: Mapping[str, float] = PERCENTILES, by: Sequence[str] = ()
) -> DataFrame:
    """Exact element at ``min(floor(n * p), n - 1)`` of the sorted values, 0 when empty."""
    ranked = _ranked_values(df, value, by)
    return ranked.groupBy(*by).agg(
        *[F.coalesce(_at_rank(_rank_index(p)), F.lit(0)).alias(name) for name, p in percentiles.items()]
    )


def distribution(
    df: DataFrame, value: str, by: Sequence[str] = (), percentiles: Mapping[str, float] = PERCENTILES
) -> DataFrame:
    """Count, sum, mean, median, min, max, sample deviation (0 below two rows), percentiles."""
    v = F.col(value)
    basics = df.groupBy(*by).agg(
        F.count(v).alias("count"),
        F.coalesce(F.sum(v), F.lit(0)).alias("sum"),
        F.coalesce(F.avg(v), F.lit(0)).alias("mean"),
        F.coalesce(F.min(v), F.lit(0)).alias("min"),
        F.coalesce(F.max(v), F.lit(0)).alias("max"),
        F.coalesce(F.when(F.count(v) > 1, F.stddev_samp(v)), F.lit(0.0)).alias("stddev"),
    )
    lower, upper = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)
    ranks = _ranked_values(df, value, by).groupBy(*by).agg(
        F.coalesce((_at_rank(lower) + _at_rank(upper)) / 2, F.lit(0)).alias("median"),
        *[F.coalesce(_at_rank(_rank_index(p)), F.lit(0)).alias(name) for name, p in percentiles.items()],
    )
    return basics.join(ranks, list(by)) if by else attach_one_row(basics, ranks)


def _hour(ts: str) -> Column:
    return time_slice(F.col(ts), 3600)


def counter_deltas(
    samples: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value", tie_break: Sequence[str] = ()
) -> DataFrame:
    """Growth since the previous sample; a fall means the counter restarted from zero."""
    before = previous_in_series(
        samples, keys, [ts, *tie_break], {"_before": F.col(value)}, _hour(ts)
    )
    grown = F.when(F.col(value) < F.col("_before"), F.col(value)).otherwise(F.col(value) - F.col("_before"))
    return before.withColumn("delta", grown).drop("_before")


def counter_increase(
    samples: DataFrame,
    keys: Sequence[str],
    seconds: int,
    ts: str = "ts",
    value: str = "value",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Per sample: ``increase`` and ``rate`` over the trailing window.

    Growth between the samples inside the window divided by the time between the
    first and the last of them; nothing is extrapolated to the window's edges.
    Null with fewer than two samples.
    """
    deltas = counter_deltas(samples, keys, ts, value, tie_break)
    # The growth up to the window's first sample happened before the window.
    framed = since_window_start(deltas, keys, ts, seconds, {"_grown": F.coalesce("delta", F.lit(0))}, tie_break)
    increase = F.when(F.col("_rows") > 1, F.col("_grown"))
    elapsed = (F.unix_micros(F.col(ts)) - F.col("_start")) / F.lit(1e6)
    return framed.withColumn("increase", increase).withColumn(
        "rate", F.col("increase") / F.nullif(elapsed, F.lit(0.0))
    ).drop("_grown", "_rows", "_start")


def tick(ts: str, step: int) -> Column:
    """End of the ``step``-second interval a sample belongs to."""
    return F.timestamp_seconds((time_slice(F.col(ts), step) + 1) * step)


def tick_bounds(df: DataFrame, ts: str, step: int) -> DataFrame:
    """One row: first and last tick of the samples."""
    return df.agg(F.min(tick(ts, step)).alias("_first"), F.max(tick(ts, step)).alias("_last"))


def tick_grid(groups: DataFrame, bounds: DataFrame, step: int) -> DataFrame:
    """Every tick between the bounds, for every row of ``groups``."""
    every = F.sequence("_first", "_last", F.make_dt_interval(secs=F.lit(step)))
    return attach_one_row(groups, bounds).select(*groups.columns, F.explode(every).alias("tick"))


def tick_increase(
    samples: DataFrame, by: Sequence[str], step: int, seconds: int, keys: Sequence[str], ts: str = "ts",
    value: str = "value", tie_break: Sequence[str] = (), bounds: DataFrame | None = None,
) -> DataFrame:
    """``increase`` and ``rate`` per tick and ``by``, summed over the series in ``keys``.

    Growth is added up per tick before the trailing window, so the window runs
    over ticks, not samples. With ``bounds`` (see ``tick_bounds``) the ticks without
    samples are kept.
    """
    deltas = counter_deltas(samples, keys, ts, value, tie_break)
    per_tick = deltas.groupBy(*by, tick(ts, step).alias("tick")).agg(
        F.coalesce(F.sum("delta"), F.lit(0)).alias("_grown")
    )
    if bounds is not None:
        # Without labels there is one group, even when the metric has no samples.
        groups = per_tick.select(*by).distinct() if by else bounds.select()
        per_tick = tick_grid(groups, bounds, step).join(per_tick, [*by, "tick"], "left").withColumn(
            "_grown", F.coalesce("_grown", F.lit(0))
        )
    return (
        trailing_window(per_tick, list(by), "tick", seconds, {"increase": F.sum("_grown")})
        .withColumn("rate", F.col("increase") / F.lit(float(seconds)))
        .drop("_grown")
    )


def histogram_quantile(
    buckets: DataFrame, q: float, by: Sequence[str] = (), le: str = "le", cumulative: str = "cumulative_count"
) -> DataFrame:
    """Quantile from cumulative buckets, linear inside the bucket.

    The lowest bucket starts at 0; a rank in the infinite bucket gives the highest
    finite bound; an empty histogram gives null. Windows see one row per bucket.
    """
    summed = buckets.groupBy(*by, F.col(le).alias("_le")).agg(F.sum(cumulative).alias("_cum"))
    ordered = Window.partitionBy(*by).orderBy("_le")
    everything = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    framed = summed.select(
        *by,
        "_le",
        "_cum",
        F.coalesce(F.lag("_le").over(ordered), F.lit(0.0)).alias("_low"),
        F.coalesce(F.lag("_cum").over(ordered), F.lit(0)).alias("_under"),
        (F.max("_cum").over(everything).cast("double") * F.lit(float(q))).alias("_rank"),
    )
    infinite = F.col("_le") == float("inf")
    inside = F.col("_low") + (F.col("_le") - F.col("_low")) * (F.col("_rank") - F.col("_under")) / F.nullif(
        (F.col("_cum") - F.col("_under")).cast("double"), F.lit(0.0)
    )
    value = F.when(infinite, F.col("_low")).otherwise(inside)
    return framed.groupBy(*by).agg(
        F.min_by(value, F.when((F.col("_cum") >= F.col("_rank")) & (F.col("_cum") > 0), F.col("_le"))).alias("quantile")
    )


def rolling_throughput(
    events: DataFrame, ts: str = "ts", window_seconds: int = 60, bucket_seconds: int = 1, by: Sequence[str] = ()
) -> DataFrame:
    """Events per second over a rolling window, and on average since the start.

    Counted per bucket first. The window is shortened to the age of the series
    while that is younger; at age 0 the rate is 0.
    """
    start = events.groupBy(*by).agg(F.min(ts).alias("_start"))
    bucket = F.timestamp_seconds(time_slice(F.col(ts), bucket_seconds) * bucket_seconds)
    counts = events.groupBy(*by, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("events"))
    rolled = trailing_window(
        counts, list(by), "bucket", window_seconds, {"_in_window": F.sum("events")}
    )
    rolled = running_sum_in_series(
        rolled, list(by), ["bucket"], {"total": F.col("events")}, time_slice(F.col("bucket"), 86400)
    )
    rolled = rolled.join(start, list(by)) if by else attach_one_row(rolled, start)
    end = F.unix_micros("bucket") + F.lit(bucket_seconds * 1_000_000)
    age = (end - F.unix_micros("_start")) / F.lit(1e6)
    return rolled.select(
        *by,
        "bucket",
        "events",
        "total",
        ratio(F.col("_in_window"), F.least(age, F.lit(float(window_seconds))), 0.0).alias("rate_per_second"),
        ratio(F.col("total"), age, 0.0).alias("average_rate_per_second"),
    )


def outcome_ratios(df: DataFrame, by: Sequence[str], failed: Column, duplicate: Column) -> DataFrame:
    """Failure, duplicate and success rates per group (null-safe)."""
    totals = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("events"),
        count_if(failed).alias("failed"),
        count_if(duplicate).alias("duplicates"),
    )
    return totals.select(
        *by,
        "events",
        ratio(F.col("failed"), F.col("events"), 0.0).alias("failure_rate"),
        ratio(F.col("duplicates"), F.col("events"), 0.0).alias("duplicate_rate"),
        ratio(F.col("events") - F.col("failed"), F.col("events"), 0.0).alias("success_rate"),
    )


def resource_summary(
    snapshots: DataFrame, by: Sequence[str] = (), ts: str = "ts", cpu: str = "cpu", memory: str = "memory",
    threads: str = "threads",
) -> DataFrame:
    """Mean, highest and lowest use over stored snapshots."""
    return snapshots.groupBy(*by).agg(
        F.avg(cpu).alias("cpu_mean"),
        F.max(cpu).alias("cpu_max"),
        F.min(cpu).alias("cpu_min"),
        F.avg(memory).alias("memory_mean"),
        F.max(memory).alias("memory_max"),
        F.min(memory).alias("memory_min"),
        F.max_by(memory, ts).alias("memory_last"),
        F.max(threads).alias("threads_max"),
    )


def range_filter(ts: str, start=None, end=None) -> Column:
    """Rows between two moments, both included; an open end is unbounded."""
    test = F.lit(True)
    if start is not None:
        test = test & (F.col(ts) >= F.lit(start).cast("timestamp"))
    if end is not None:
        test = test & (F.col(ts) <= F.lit(end).cast("timestamp"))
    return test


def last_interval(ts: str, amount: int, unit: str, as_of=None) -> Column:
    """Rows of the last ``amount`` minutes, hours or days."""
    seconds = {"minutes": 60, "hours": 3600, "days": 86400}[unit] * amount
    end = as_timestamp(as_of)
    return (F.col(ts) >= end - F.make_dt_interval(secs=F.lit(seconds))) & (F.col(ts) <= end)


def end_to_end_latency(df: DataFrame, event_time: str, processed_time: str) -> DataFrame:
    """Add the milliseconds from event time to processing."""
    micros = F.unix_micros(processed_time) - F.unix_micros(event_time)
    return df.withColumn("latency_ms", micros / F.lit(1000.0))


def offset_lag(produced: DataFrame, committed: DataFrame) -> DataFrame:
    """Messages not yet consumed, per topic and partition."""
    keys = ["topic", "partition"]
    high = produced.groupBy(*keys).agg(F.max("offset").alias("log_end"))
    done = committed.groupBy(*keys).agg(F.max("offset").alias("committed"))
    return high.join(done, keys, "left").select(
        *keys, "log_end", "committed",
        (F.col("log_end") - F.coalesce("committed", F.lit(-1))).alias("lag"),
    )


def metrics_to_text(samples: DataFrame, histograms: DataFrame | None = None) -> DataFrame:
    """Exposition lines with their sort keys (name, part, series, step).

    ``samples`` has name, kind (counter or gauge), help, labels and value;
    ``histograms`` has name, help, labels, le, cumulative_count, count and sum.
    Bucket counts are cumulative and label values quoted. Every line is a row;
    order by the keys when writing.
    """
    braces = F.when(F.size("labels") > 0, F.concat(F.lit("{"), label_text(F.col("labels")), F.lit("}"))).otherwise("")
    series = label_text(F.col("labels"))

    def line(part: int, step: Column, text: Column, key: Column = F.lit("")) -> Column:
        return F.struct(
            F.lit(part).alias("part"), key.alias("series"), step.cast("double").alias("step"), text.alias("line")
        )

    def heads(df: DataFrame, kind: Column) -> DataFrame:
        described = df.groupBy("name").agg(F.min("help").alias("help"), F.min(kind).alias("kind"))
        return described.select(
            "name",
            F.inline(
                F.array(
                    line(0, F.lit(0), F.concat(F.lit("# HELP "), "name", F.lit(" "), "help")),
                    line(1, F.lit(0), F.concat(F.lit("# TYPE "), "name", F.lit(" "), "kind")),
                )
            ),
        )

    out = heads(samples, F.col("kind")).unionByName(
        samples.select(
            "name",
            F.inline(
                F.array(line(2, F.lit(0), F.concat("name", braces, F.lit(" "), F.col("value").cast("string")), series))
            ),
        )
    )
    if histograms is not None:
        edge = F.when(F.col("le") == float("inf"), "+Inf").otherwise(F.col("le").cast("string"))
        comma = F.when(F.size("labels") > 0, F.concat(series, F.lit(","))).otherwise("")
        bucket = F.concat(
            "name", F.lit("_bucket{"), comma, F.lit('le="'), edge, F.lit('"} '),
            F.col("cumulative_count").cast("string"),
        )
        totals = F.col("le") == float("inf")
        out = (
            out.unionByName(heads(histograms, F.lit("histogram")))
            .unionByName(histograms.select("name", F.inline(F.array(line(2, F.col("le"), bucket, series)))))
            .unionByName(
                histograms.where(totals).select(
                    "name",
                    F.inline(
                        F.array(
                            line(3, F.lit(0), F.concat("name", F.lit("_sum"), braces, F.lit(" "), F.col("sum").cast("string")), series),
                            line(4, F.lit(0), F.concat("name", F.lit("_count"), braces, F.lit(" "), F.col("count").cast("string")), series),
                        )
                    ),
                )
            )
        )
    return out


def write_exposition(lines: DataFrame, path: str) -> None:
    """Write the lines in order as text files (part files follow each other)."""
    lines.orderBy("name", "part", "series", "step").select("line").write.mode("overwrite").text(path)
