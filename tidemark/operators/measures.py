"""Many measures of metric samples in one pass.

Samples are reduced once to a row per series and tick (growth and last value); the rows
are written, and every measure is computed from them: a measure is a metric, a trailing
window and a way to sum series up. All windows of a group are columns over one sort.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import metrics
from tidemark.session import written


@dataclass(frozen=True)
class Measure:
    """A number per tick and label set.

    ``kind`` is rate or increase (a counter's growth over ``seconds``), gauge (last values
    of the tick) or quantile (of a histogram's growth, from its ``_bucket`` counters).
    ``by`` lists the labels that stay; with none all series are summed, and None keeps
    every series by itself.
    """

    name: str
    kind: str
    metric: str
    seconds: int = 300
    by: tuple[str, ...] | None = ()
    q: float | None = None

    @property
    def source(self) -> str:
        return f"{self.metric}_bucket" if self.kind == "quantile" else self.metric

    @property
    def scope(self) -> str:
        return "series" if self.by is None else ",".join(self.by)

    def labels(self, held: Column) -> Column:
        """Text of the labels that stay."""
        if self.by is None:
            return metrics.label_text(F.map_filter(held, lambda k, _: k != "le") if self.kind == "quantile" else held)
        return metrics.label_text(F.map_filter(held, lambda k, _: k.isin(*self.by))) if self.by else F.lit("")


def series_ticks(samples: DataFrame, names: Sequence[str], step: int = 60) -> DataFrame:
    """Per series and tick: growth since the sample before, and the last value. Reads the samples twice."""
    rows = samples.where(F.col("name").isin(*names)).withColumn("series", metrics.label_text(F.col("labels")))
    deltas = metrics.counter_deltas(rows, ["name", "series"])
    return deltas.groupBy("name", "series", metrics.tick("ts", step).alias("tick")).agg(
        F.coalesce(F.sum("delta"), F.lit(0.0)).alias("grown"), F.max_by("value", "ts").alias("last"),
        F.first("labels").alias("labels"),
    )


def _edge(labels: Column) -> Column:
    edge = labels["le"]
    return F.when(edge == "+Inf", float("inf")).otherwise(edge.try_cast("double"))


def _quantile(buckets: Column, q: Column) -> Column:
    """Quantile of cumulative (le, n) buckets, linear inside one; see ``metrics.histogram_quantile``."""
    b = F.sort_array(buckets)
    rank = F.array_max(F.transform(b, lambda x: x["n"])) * q
    hit = F.get(F.filter(b, lambda x: (x["n"] >= rank) & (x["n"] > 0)), F.lit(0))
    below = F.try_element_at(F.filter(b, lambda x: x["le"] < hit["le"]), F.lit(-1))
    low, under = F.coalesce(below["le"], F.lit(0.0)), F.coalesce(below["n"], F.lit(0.0))
    inside = low + (hit["le"] - low) * (rank - under) / F.nullif(hit["n"] - under, F.lit(0.0))
    return F.when(hit["le"] == float("inf"), low).otherwise(inside)


def measured(samples: DataFrame, measures: Sequence[Measure], step: int = 60, every_tick: bool = False) -> DataFrame:
    """(measure, scope, labels, tick, value), written to the shared folder.

    A group has a row at ticks where it has samples. With ``every_tick``, growth summed over
    all series has one at all ticks between the first and the last sample of the
    metrics involved, zero where nothing came.
    """
    ticks = written(series_ticks(samples, sorted({m.source for m in measures}), step), "series-ticks")
    fed: dict[str, list[int]] = {}
    for i, m in enumerate(measures):
        fed.setdefault(m.source, []).append(i)
    pairs = [x for name, some in fed.items() for x in (F.lit(name), F.array(*[F.lit(i) for i in some]))]
    number = F.col("m")

    def per_measure(of) -> Column:
        cases = [(i, of(m)) for i, m in enumerate(measures)]
        out = F.when(number == cases[0][0], cases[0][1])
        for i, value in cases[1:]:
            out = out.when(number == i, value)
        return out

    edge = per_measure(lambda m: _edge(F.col("labels")) if m.kind == "quantile" else F.lit(None).cast("double"))
    rows = ticks.select("*", F.explode(F.create_map(*pairs)[F.col("name")]).alias("m")).select(
        "m", per_measure(lambda m: m.labels(F.col("labels"))).alias("group"), edge.alias("le"), "tick", "grown", "last"
    )
    if every_tick:
        bounds = ticks.agg(F.min("tick").alias("_first"), F.max("tick").alias("_last")).where("_first IS NOT NULL")
        totals = [i for i, m in enumerate(measures) if m.by == () and m.kind in ("rate", "increase")]
        known = rows.where(number.isin([i for i, m in enumerate(measures) if m.by == () and m.kind == "quantile"])).select("m", "le").distinct()
        plain = bounds.select(F.explode(F.array(*[F.lit(i) for i in totals]).cast("array<int>")).alias("m"), F.lit(None).cast("double").alias("le"))
        grid = metrics.tick_grid(known.unionByName(plain), bounds, step)
        rows = rows.unionByName(
            grid.select("m", F.lit("").alias("group"), "le", "tick", F.lit(0.0).alias("grown"), F.lit(None).cast("double").alias("last"))
        )
    summed = rows.groupBy("m", "group", "le", "tick").agg(F.sum("grown").alias("grown"), F.sum("last").alias("last"))
    order = Window.partitionBy("m", "group", "le").orderBy(F.unix_seconds("tick"))
    spans = sorted({m.seconds for m in measures if m.kind != "gauge"})
    framed = summed.select(
        "*", *[F.sum("grown").over(order.rangeBetween(-(s - step), 0)).alias(f"grown_{s}") for s in spans]
    )
    growth = per_measure(lambda m: F.col("last") if m.kind == "gauge" else F.col(f"grown_{m.seconds}"))
    whole = framed.withColumn("n", growth).groupBy("m", "group", "tick").agg(
        F.sum("n").alias("n"), F.collect_list(F.when(F.col("le").isNotNull(), F.struct("le", "n"))).alias("buckets")
    )
    value = per_measure(
        lambda m: _quantile(F.col("buckets"), F.lit(float(m.q))) if m.kind == "quantile"
        else F.col("n") / F.lit(float(m.seconds)) if m.kind == "rate" else F.col("n")
    )
    named = per_measure(lambda m: F.lit(m.name))
    scope = per_measure(lambda m: F.lit(m.scope))
    return written(
        whole.select(named.alias("measure"), scope.alias("scope"), F.col("group").alias("labels"), "tick", value.alias("value")),
        "measures",
    )


def wide(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """A row per scope, label set and tick with a column for each measure."""
    return rows.groupBy("scope", "labels", "tick").agg(
        *[F.max(F.when(F.col("measure") == n, F.col("value"))).alias(n) for n in names]
    )
