"""Ordered computations over series of any size.

A plain ``Window.partitionBy(series)`` puts a whole series into one task. Metric
series, alert rules and busy entities are few and long, so that task would hold
much of the table. The functions here cut each series into slices that follow
the order (an hour of time, a range of log positions), work inside
(series, slice), and carry one summary row per slice across the borders. The
only window over a whole series runs on those summaries.

``slice_by`` must not decrease along ``order`` and the series keys must not be
null; ``order`` should be total, or ties are resolved arbitrarily.

Each function reads its input twice, once for the rows and once, narrowly, for
the summaries. Do not stack them: put ``session.written`` between two of them, or
the reads multiply.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shared_dir

_SLICE = "_slice"


def time_slice(ts: Column, seconds: int) -> Column:
    """Number of whole ``seconds``-long intervals since the epoch."""
    return F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000)).cast("bigint")


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def _with_carry(rows: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the summary carried into their slice.

    Many short series have about as many slices as rows, and Spark's size estimate below parsed JSON
    is far too small, so the carry is never broadcast. The rows already lie and are sorted by the join's keys.
    """
    return rows.join(carry.hint("merge"), [*keys, _SLICE], "left")


def previous_in_series(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, Column],
    slice_by: Column,
) -> DataFrame:
    """Add, under each name of ``values``, that expression on the preceding row."""
    return _neighbour(df, keys, order, values, slice_by, backwards=True)


def next_in_series(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, Column],
    slice_by: Column,
) -> DataFrame:
    """Add, under each name of ``values``, that expression on the following row."""
    return _neighbour(df, keys, order, values, slice_by, backwards=False)


def _neighbour(df, keys, order, values, slice_by, backwards):
    step, edge = (F.lag, F.max_by) if backwards else (F.lead, F.min_by)
    packed = F.struct(*[expr.alias(name) for name, expr in values.items()])
    rows = df.withColumn(_SLICE, slice_by).withColumn("_packed", packed)
    carry = (
        rows.groupBy(*keys, _SLICE)
        .agg(edge("_packed", _order_struct(order)).alias("_edge"))
        .withColumn("_carry", step("_edge").over(Window.partitionBy(*keys).orderBy(_SLICE)))
        .drop("_edge")
    )
    inside = Window.partitionBy(*keys, _SLICE).orderBy(*order)
    found = _with_carry(rows.withColumn("_near", step("_packed").over(inside)), carry, keys)
    near = F.coalesce("_near", "_carry")
    return found.select(*df.columns, *[near[name].alias(name) for name in values])


def running_sum_in_series(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, Column],
    slice_by: Column,
) -> DataFrame:
    """Add running sums (current row included) under the names of ``values``."""
    rows = df.withColumn(_SLICE, slice_by)
    for name, expr in values.items():
        rows = rows.withColumn(f"_v_{name}", expr)
    earlier = (
        Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = rows.groupBy(*keys, _SLICE).agg(
        *[F.sum(f"_v_{name}").alias(f"_t_{name}") for name in values]
    )
    carry = totals.select(
        *keys, _SLICE, *[F.sum(f"_t_{name}").over(earlier).alias(f"_c_{name}") for name in values]
    )
    inside = (
        Window.partitionBy(*keys, _SLICE)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = rows.select(
        "*", *[F.sum(f"_v_{name}").over(inside).alias(f"_r_{name}") for name in values]
    )
    joined = _with_carry(summed, carry, keys)
    return joined.select(
        *df.columns,
        *[
            (F.coalesce(f"_r_{name}", F.lit(0)) + F.coalesce(f"_c_{name}", F.lit(0))).alias(name)
            for name in values
        ],
    )


def last_known_in_series(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, Column],
    slice_by: Column,
) -> DataFrame:
    """Add, under each name, the latest non-null value on an earlier row."""
    rows = df.withColumn(_SLICE, slice_by)
    for name, expr in values.items():
        rows = rows.withColumn(f"_v_{name}", expr)
    earlier = (
        Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    tails = rows.groupBy(*keys, _SLICE).agg(
        *[
            F.max_by(
                f"_v_{name}", F.when(F.col(f"_v_{name}").isNotNull(), _order_struct(order))
            ).alias(f"_t_{name}")
            for name in values
        ]
    )
    carry = tails.select(
        *keys,
        _SLICE,
        *[
            F.last(f"_t_{name}", ignorenulls=True).over(earlier).alias(f"_c_{name}")
            for name in values
        ],
    )
    inside = (
        Window.partitionBy(*keys, _SLICE)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    seen = rows.select(
        "*",
        *[
            F.last(f"_v_{name}", ignorenulls=True).over(inside).alias(f"_r_{name}")
            for name in values
        ],
    )
    joined = _with_carry(seen, carry, keys)
    return joined.select(
        *df.columns, *[F.coalesce(f"_r_{name}", f"_c_{name}").alias(name) for name in values]
    )


def run_starts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: str, slice_by: Column
) -> DataFrame:
    """Add ``was`` (flag of the preceding row, false at first) and ``run_start``.

    ``run_start`` is the first order column at the beginning of the latest run of
    true flags; on the row after a run it still names that run. Only the first row
    of a slice depends on earlier slices, so one carry per slice settles it.
    """
    at = order[0]
    rows = df.withColumn(_SLICE, slice_by)
    inside = Window.partitionBy(*keys, _SLICE).orderBy(*order)
    marked = rows.withColumn("_lag", F.lag(flag).over(inside)).withColumn(
        "_begin", F.when(F.col(flag) & ~F.col("_lag"), F.col(at))
    )
    # The same windows, reduced to one row per slice.
    edges = (
        marked.groupBy(*keys, _SLICE)
        .agg(
            F.max_by(flag, _order_struct(order)).alias("_last"),
            F.max("_begin").alias("_inner"),
            F.min(at).alias("_first_at"),
            F.min_by(flag, _order_struct(order)).alias("_first"),
        )
    )
    by_slice = Window.partitionBy(*keys).orderBy(_SLICE)
    edges = edges.withColumn("_before", F.coalesce(F.lag("_last").over(by_slice), F.lit(False))).withColumn(
        "_edge", F.when(F.col("_first") & ~F.col("_before"), F.col("_first_at"))
    )
    carry = edges.select(
        *keys,
        _SLICE,
        "_before",
        "_edge",
        F.last(F.coalesce("_inner", "_edge"), ignorenulls=True)
        .over(by_slice.rowsBetween(Window.unboundedPreceding, -1))
        .alias("_carry"),
    )
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = _with_carry(marked.withColumn("_inside", F.last("_begin", ignorenulls=True).over(upto)), carry, keys)
    return found.select(
        *df.columns,
        F.coalesce("_lag", "_before").alias("was"),
        F.coalesce("_inside", "_edge", "_carry").alias("run_start"),
    )


def consecutive_runs(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: str, slice_by: Column
) -> DataFrame:
    """Add ``run_length`` (rows in a row that share the flag), ``seen`` and ``seen_true``.

    ``seen`` counts all rows of the series so far, ``seen_true`` those with a true
    flag, the current row included in both.
    """
    rows = df.withColumn(_SLICE, slice_by)
    inside = Window.partitionBy(*keys, _SLICE).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.select(
        "*",
        F.row_number().over(inside).cast("bigint").alias("_pos"),
        F.count(F.when(F.col(flag), 1)).over(upto).alias("_true"),
    )
    placed = placed.select(
        "*",
        F.max(F.when(F.col(flag), F.col("_pos"))).over(upto).alias("_on"),
        F.max(F.when(~F.col(flag), F.col("_pos"))).over(upto).alias("_off"),
    )
    sizes = placed.groupBy(*keys, _SLICE).agg(
        F.max("_pos").alias("_n"),
        F.max("_true").alias("_t"),
        F.max("_on").alias("_last_on"),
        F.max("_off").alias("_last_off"),
    )
    earlier = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    sizes = sizes.select(
        "*", offset.alias("_offset"), F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_true_before")
    )
    carry = sizes.select(
        *keys,
        _SLICE,
        "_offset",
        "_true_before",
        F.max(F.col("_offset") + F.col("_last_on")).over(earlier).alias("_on_before"),
        F.max(F.col("_offset") + F.col("_last_off")).over(earlier).alias("_off_before"),
    )
    joined = _with_carry(placed, carry, keys)
    place = F.col("_offset") + F.col("_pos")

    def broken(inner: str, before: str) -> Column:
        return F.coalesce(F.col("_offset") + F.col(inner), F.col(before), F.lit(0))

    length = place - F.when(F.col(flag), broken("_off", "_off_before")).otherwise(broken("_on", "_on_before"))
    return joined.select(
        *df.columns,
        length.alias("run_length"),
        place.alias("seen"),
        (F.col("_true_before") + F.col("_true")).alias("seen_true"),
    )


def trailing_window(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seconds: int,
    aggregates: Mapping[str, Column],
    slice_seconds: int | None = None,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Aggregates over the rows of the series in ``(t - seconds, t]``.

    Every row is also sent, as context only, to the following slice when its
    window reaches there; the slice is at least as long as the window, so one
    copy is enough. Rows with equal time see each other.
    """
    width = max(slice_seconds or 0, 10 * seconds)
    micros = F.unix_micros(F.col(ts))
    own = time_slice(F.col(ts), width)
    late = (own + 1) * F.lit(width * 1_000_000) - micros <= F.lit(seconds * 1_000_000)
    homes = F.when(late, F.array(own, own + 1)).otherwise(F.array(own))
    spread = (
        df.withColumn("_own", own)
        .withColumn("_micros", micros)
        .withColumn(_SLICE, F.explode(homes))
    )
    frame = (
        Window.partitionBy(*keys, _SLICE)
        .orderBy("_micros")
        .rangeBetween(-(seconds * 1_000_000 - 1), 0)
    )
    return (
        spread.select("*", *[expr.over(frame).alias(name) for name, expr in aggregates.items()])
        .where(F.col(_SLICE) == F.col("_own"))
        .drop(_SLICE, "_own", "_micros")
    )


def since_window_start(
    df: DataFrame, keys: Sequence[str], ts: str, seconds: int, values: Mapping[str, Column], tie_break: Sequence[str] = ()
) -> DataFrame:
    """What came after the first row of the window ``(t - seconds, t]``: a sum per name in ``values``.

    Adds the sums, ``_rows`` (rows in the window) and ``_start`` (microseconds of the first one). Each sum is a
    difference of two running sums: up to the row, and up to the window's first row, which every row looks up
    as of its window's start. So the cost is a few sorts, however many rows a window holds. Rows with
    equal time see each other; the first of them is the one that ``tie_break`` puts first.
    """
    width = 10 * seconds
    micros = F.unix_micros(F.col(ts))
    own = time_slice(F.col(ts), width)
    late = (own + 1) * F.lit(width * 1_000_000) - micros <= F.lit(seconds * 1_000_000)
    homes = F.when(late, F.array(own, own + 1)).otherwise(F.array(own))
    spread = df.withColumns({"_own": own, "_micros": micros}).withColumn(_SLICE, F.explode(homes))
    group = Window.partitionBy(*keys, _SLICE)
    rowwise = group.orderBy("_micros", *tie_break).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    peers = group.orderBy("_micros").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    summed = {**values, "_rows": F.lit(1)}
    totals = spread.select(
        "*",
        F.struct(*[F.sum(v).over(rowwise).alias(n) for n, v in summed.items()], F.col("_micros")).alias("_upto"),
        F.struct(*[F.sum(v).over(peers).alias(n) for n, v in summed.items()]).alias("_all"),
    )
    # Each row once as a sample at its time and, in its own slice, once as a question at its window's start.
    sample = F.struct(F.lit(0).alias("ask"), F.col("_micros").alias("at"))
    question = F.struct(F.lit(1).alias("ask"), (F.col("_micros") - F.lit(seconds * 1_000_000)).alias("at"))
    both = totals.select(
        "*", F.explode(F.when(F.col(_SLICE) == F.col("_own"), F.array(sample, question)).otherwise(F.array(sample))).alias("_e")
    )
    backwards = group.orderBy(
        F.col("_e.at").desc(), F.col("_e.ask").desc(), *[F.col(c).desc() for c in tie_break]
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.last(F.when(F.col("_e.ask") == 0, F.col("_upto")), ignorenulls=True).over(backwards)
    found = both.withColumn("_first", first).where("_e.ask = 1")
    return found.select(
        *df.columns,
        *[(F.col("_all")[n] - F.col("_first")[n]).alias(n) for n in values],
        (F.col("_all._rows") - F.col("_first._rows") + 1).alias("_rows"),
        F.col("_first._micros").alias("_start"),
    )


def number_rows(
    df: DataFrame,
    order: Sequence[Column],
    name: str,
    keys: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """``row_number`` over the whole table, or inside ``keys``, without one big task.

    Rows are range-partitioned by ``keys + order``, so a large group spreads over
    many tasks. The sorted rows are checkpointed, which fixes the partitions;
    counts per (partition, group) then give each group's offset. ``order`` should
    end in a unique column.
    """
    spark = df.sparkSession
    shared_dir(spark)
    wanted = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = [*[F.col(k).asc_nulls_first() for k in keys], *order]
    placed = (
        df.repartitionByRange(wanted, *sort)
        .sortWithinPartitions(*sort)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.spark_partition_id())
        .checkpoint()
    )
    same = [F.coalesce(F.col(k).cast("string"), F.lit("\0")).alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    placed = placed.select("*", *same)
    counts = placed.groupBy("_part", *names).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first")
    )
    # Keyed windows see at most one row per slice; without keys the table has one row per slice.
    earlier = Window.partitionBy(*names).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", *names, "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    return placed.join(offsets, ["_part", *names]).select(
        *df.columns,
        (F.col("_before") + F.col("_place") - F.col("_first") + 1).cast("bigint").alias(name),
    )
