"""Alert rules over metric tables: evaluation, states, notifications, silences, reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ordered import run_starts, time_slice
from tidemark.functions.rows import attach_one_row
from tidemark.operators import metrics
from tidemark.operators.measures import Measure, measured, wide


@dataclass(frozen=True)
class AlertRule:
    """A condition on the wide metrics frame that must hold for ``for_seconds``."""

    name: str
    condition: Column
    level: str
    message: str
    for_seconds: int = 0
    labels: Mapping[str, str] = field(default_factory=dict)
    enabled: bool = True
    repeat_seconds: int = 4 * 3600
    per_series: bool = False


@dataclass(frozen=True)
class Silence:
    """Withholds notifications between two moments for alerts matching all matchers."""

    starts_at: str
    ends_at: str
    matchers: Mapping[str, str]

    def covers(self, rule: AlertRule) -> bool:
        return all(
            (rule.name if key == "alertname" else rule.labels.get(key)) == wanted
            for key, wanted in self.matchers.items()
        )


def evaluate_rules(wide: DataFrame, rules: Sequence[AlertRule], ts: str = "ts") -> DataFrame:
    """One row per tick and enabled rule; a null condition counts as not met.

    On a frame by scope and labels (``metric_rule_inputs``) a rule looks at the rows of its
    scope, and ``labels`` tells its alerts apart. A rule per series looks at the ticks at which
    its own metric has samples; other metrics may have the same labels.
    """
    verdicts = [
        F.struct(F.lit(r.name).alias("rule"), F.coalesce(r.condition, F.lit(False)).alias("met"))
        for r in rules
        if r.enabled
    ]
    if "scope" not in wide.columns:
        return wide.select(F.col(ts).alias("ts"), F.inline(F.array(*verdicts)))
    own = F.array_compact(F.array(*[
        F.when(r.condition.isNotNull() & (F.col("scope") == "series") if r.per_series else F.col("scope") == "", v)
        for r, v in zip([r for r in rules if r.enabled], verdicts)
    ]))
    return wide.select(F.col(ts).alias("ts"), "labels", F.inline(own))


def _alert_keys(evals: DataFrame) -> list[str]:
    """What tells alerts apart: the rule, and the label set where there is one."""
    return ["rule", "labels"] if "labels" in evals.columns else ["rule"]


def _per_rule(rules: Sequence[AlertRule], attribute: str) -> Column:
    pairs = [x for r in rules for x in (F.lit(r.name), F.lit(getattr(r, attribute)))]
    return F.create_map(*pairs)[F.col("rule")]


def _true_runs(evals: DataFrame, slice_seconds: int) -> DataFrame:
    """Evaluations with ``was`` (previous verdict) and ``run_start`` (first true)."""
    return run_starts(evals, _alert_keys(evals), ["ts"], "met", time_slice(F.col("ts"), slice_seconds))


def tick_states(evals: DataFrame, rules: Sequence[AlertRule], slice_seconds: int = 86400) -> DataFrame:
    """State of every rule at every tick: inactive, pending or firing."""
    runs = _true_runs(evals, slice_seconds)
    waited = F.unix_micros("ts") - F.unix_micros("run_start")
    due = _per_rule(rules, "for_seconds").cast("bigint") * 1_000_000
    state = F.when(~F.col("met"), "inactive").when(waited >= due, "firing").otherwise("pending")
    return runs.select(
        *_alert_keys(evals), "ts", state.alias("state"), F.when(F.col("met"), F.col("run_start")).alias("started_at")
    )


def alert_states(evals: DataFrame, rules: Sequence[AlertRule], slice_seconds: int = 86400) -> DataFrame:
    """One row per alert that fired: started (first true), fired, resolved (first false).

    ``resolved_at`` is null while it still fires; runs that end before their time
    leave nothing. ``last_seen`` is the last tick of the run.
    """
    runs = _true_runs(evals, slice_seconds).where(F.col("met") | F.col("was"))
    waited = F.unix_micros("ts") - F.unix_micros("run_start")
    due = _per_rule(rules, "for_seconds").cast("bigint") * 1_000_000
    return (
        runs.groupBy(*_alert_keys(evals), F.col("run_start").alias("started_at"))
        .agg(
            F.min(F.when(F.col("met") & (waited >= due), F.col("ts"))).alias("fired_at"),
            F.min(F.when(~F.col("met"), F.col("ts"))).alias("resolved_at"),
            F.max(F.when(F.col("met"), F.col("ts"))).alias("last_seen"),
        )
        .where("fired_at IS NOT NULL")
        .withColumns(
            {
                "level": _per_rule(rules, "level"),
                "message": _per_rule(rules, "message"),
                "state": F.when(F.col("resolved_at").isNull(), "firing").otherwise("resolved"),
            }
        )
    )


def silenced(rules: Sequence[AlertRule], silences: Sequence[Silence], ts: Column) -> Column:
    """Whether notifications of ``rule`` are withheld at ``ts`` (bounds included)."""
    hit = F.lit(False)
    for silence in silences:
        names = [r.name for r in rules if silence.covers(r)]
        if names:
            hit = hit | (
                F.col("rule").isin(*names)
                & ts.between(F.lit(silence.starts_at).cast("timestamp"), F.lit(silence.ends_at).cast("timestamp"))
            )
    return hit


def drop_silenced(
    ticks: DataFrame, rules: Sequence[AlertRule], silences: Sequence[Silence], ts: str = "ts"
) -> DataFrame:
    """Rows whose rule is not silenced at that moment."""
    return ticks.where(~silenced(rules, silences, F.col(ts)))


def notifications(
    alerts: DataFrame, rules: Sequence[AlertRule], silences: Sequence[Silence] = ()
) -> DataFrame:
    """When each alert is sent: on firing, every repeat interval after, and on resolve.

    What falls into a silence is withheld; the first one goes out as the silence
    ends, and the interval counts from there. Silences are configuration, so they
    fold into one expression per alert and nothing is joined.
    """
    second = 1_000_000
    start = F.unix_micros("fired_at")
    stop = F.unix_micros(F.coalesce("resolved_at", "last_seen"))
    # A still firing alert is notified up to its last tick, a resolved one before it resolved.
    stop = F.when(F.col("resolved_at").isNull(), stop + 1).otherwise(stop)
    step = _per_rule(rules, "repeat_seconds").cast("bigint") * second

    quiet = [
        F.when(
            F.col("rule").isin(*[r.name for r in rules if s.covers(r)]),
            F.struct(
                F.unix_micros(F.lit(s.starts_at).cast("timestamp")).alias("a"),
                (F.unix_micros(F.lit(s.ends_at).cast("timestamp")) + 1).alias("b"),
            ),
        )
        for s in sorted(silences, key=lambda s: s.starts_at)
        if any(s.covers(r) for r in rules)
    ]
    end_mark = F.struct(F.col("_stop").alias("a"), F.col("_stop").alias("b"))
    spans = F.concat(F.array_compact(F.array(*quiet)), F.array(end_mark)) if quiet else F.array(end_mark)

    def advance(state: Column, span: Column) -> Column:
        """Send from the due time up to the next silence, then move past it."""
        until = F.least(span["a"], F.col("_stop"))
        first = F.greatest(state["due"], state["free"])
        sends = F.when(
            first < until, F.sequence(first, until - 1, F.col("_step"))
        ).otherwise(F.array().cast("array<bigint>"))
        due = F.when(F.size(sends) > 0, F.element_at(sends, -1) + F.col("_step")).otherwise(state["due"])
        return F.struct(
            F.concat(state["sent"], sends).alias("sent"),
            due.alias("due"),
            F.greatest(state["free"], span["b"]).alias("free"),
        )

    begin = F.struct(
        F.array().cast("array<bigint>").alias("sent"), F.col("_start").alias("due"), F.col("_start").alias("free")
    )
    times = F.aggregate("_spans", begin, advance, lambda s: s["sent"])
    timed = alerts.withColumns({"_start": start, "_stop": stop, "_step": step}).withColumn("_spans", spans)
    sent = timed.withColumn("_at", F.explode(times)).select(
        "rule", "started_at", F.timestamp_micros("_at").alias("notified_at"),
        F.when(F.col("_at") == F.col("_start"), "firing").otherwise("repeat").alias("kind"),
    )
    closed = alerts.where("resolved_at IS NOT NULL").select(
        "rule", "started_at", F.col("resolved_at").alias("notified_at"), F.lit("resolved").alias("kind")
    )
    return sent.unionByName(drop_silenced(closed, rules, silences, "notified_at"))


def active_by_level(states: DataFrame, rules: Sequence[AlertRule]) -> DataFrame:
    """Firing alerts per tick and level."""
    return (
        states.where("state = 'firing'")
        .groupBy("ts", _per_rule(rules, "level").alias("level"))
        .agg(F.count(F.lit(1)).alias("active"))
    )


def _metric(wide: DataFrame, name: str, default: float) -> Column:
    return F.coalesce(F.col(name), F.lit(default)) if name in wide.columns else F.lit(default)


def standard_rules(wide: DataFrame) -> list[AlertRule]:
    """The seven built-in rules; an absent metric takes a value that never alerts."""

    def over(metric: str, limit: float) -> Column:
        return _metric(wide, metric, 0.0) > limit

    return [
        AlertRule("high_replication_lag", over("replication_lag_seconds", 60), "warning",
                  "Replication lag exceeds 60 seconds", 300, {"category": "performance"}),
        AlertRule("critical_replication_lag", over("replication_lag_seconds", 300), "critical",
                  "Replication lag exceeds 5 minutes", 120, {"category": "performance"}),
        AlertRule("high_error_rate", over("error_rate", 0.05), "warning",
                  "Error rate exceeds 5%", 300, {"category": "reliability"}),
        AlertRule("kafka_consumer_lag", over("kafka_consumer_lag", 10000), "warning",
                  "Kafka consumer lag exceeds 10,000 messages", 600, {"category": "backpressure"}),
        AlertRule("database_connection_errors", over("db_connection_errors", 10), "critical",
                  "Multiple database connection failures", 120, {"category": "connectivity"}),
        AlertRule("low_throughput", _metric(wide, "events_per_second", float("inf")) < 10, "warning",
                  "Event throughput is unusually low", 900, {"category": "performance"}),
        AlertRule("high_memory_usage", over("memory_usage_percent", 90), "warning",
                  "Memory usage exceeds 90%", 300, {"category": "resources"}),
    ]


# ---- rules and panels over metric samples -------------------------------------------


# Dashboard panels as (function, metric, arguments).
PANELS = {
    "events_rate": ("rate", "cdc_consumer_events_total", {"seconds": 300}),
    "processed_rate": ("rate", "cdc_consumer_events_processed_total", {"seconds": 300}),
    "failed_rate": ("rate", "cdc_consumer_events_failed_total", {"seconds": 300}),
    "dedup_cache_total": ("gauge", "cdc_dedup_cache_size", {}),
    "events_by_topic": ("rate", "cdc_consumer_events_total", {"seconds": 60, "by": ["topic"]}),
    "processed_by_sink": ("rate", "cdc_consumer_events_processed_total", {"seconds": 60, "by": ["sink"]}),
    "processing_p50": ("quantile", "cdc_consumer_processing_duration_seconds", {"q": 0.5, "seconds": 300}),
    "processing_p95": ("quantile", "cdc_consumer_processing_duration_seconds", {"q": 0.95, "seconds": 300}),
    "processing_p99": ("quantile", "cdc_consumer_processing_duration_seconds", {"q": 0.99, "seconds": 300}),
    "replica_write_p50": ("quantile", "cdc_postgres_write_duration_seconds", {"q": 0.5, "seconds": 300}),
    "archive_write_p50": ("quantile", "cdc_minio_write_duration_seconds", {"q": 0.5, "seconds": 300}),
    "failures_by_type": ("increase", "cdc_consumer_events_failed_total", {"seconds": 300, "by": ["sink", "error_type"]}),
    "connection_errors": ("increase", "cdc_postgres_connection_errors_total", {"seconds": 300}),
    "archive_buffer": ("gauge", "cdc_minio_buffer_size", {"by": ["table"]}),
    "archived_by_table": ("increase", "cdc_minio_events_archived_total", {"seconds": 300, "by": ["table"]}),
    "dedup_cache_size": ("gauge", "cdc_dedup_cache_size", {"by": ["instance"]}),
    "duplicate_ratio": ("share", "cdc_dedup_cache_hits_total", {"other": "cdc_dedup_cache_misses_total", "seconds": 300}),
}


def _panel_measures(name: str) -> list[Measure]:
    """The measures behind a panel; a share has two."""
    kind, metric, args = PANELS[name]
    by = tuple(args.get("by", ()))
    if kind == "share":
        other = {**args}.pop("other")
        return [Measure(f"{name}/{part}", "rate", m, args["seconds"]) for part, m in (("part", metric), ("rest", other))]
    return [Measure(name, kind, metric, args.get("seconds", 300), by, args.get("q"))]


def panels(samples: DataFrame, names: Sequence[str] | None = None, step: int = 60) -> DataFrame:
    """The data behind dashboard panels, all in one pass: panel, labels, tick, value."""
    names = list(PANELS if names is None else names)
    rows = measured(samples, [m for name in names for m in _panel_measures(name)], step)
    out = rows.where(~F.contains("measure", F.lit("/"))).select(F.col("measure").alias("panel"), "labels", "tick", "value")
    part, rest = (F.sum(F.when(F.endswith("measure", F.lit(f"/{end}")), F.col("value"))) for end in ("part", "rest"))
    shares = (
        rows.where(F.contains("measure", F.lit("/")))
        .groupBy(F.substring_index("measure", "/", 1).alias("panel"), "labels", "tick")
        .agg(F.coalesce(part, F.lit(0.0)).alias("x"), F.coalesce(rest, F.lit(0.0)).alias("y"))
    )
    return out.unionByName(shares.select("panel", "labels", "tick", (F.col("x") / F.nullif(F.col("x") + F.col("y"), F.lit(0.0))).alias("value")))


def panel(samples: DataFrame, name: str, step: int = 60) -> DataFrame:
    """The data behind one dashboard panel: its labels, tick, value."""
    by = PANELS[name][2].get("by", [])
    text = lambda b: F.nullif(F.regexp_extract("labels", f'(?:^|,){b}="(.*?)"(?:,[a-zA-Z_]+="|$)', 1), F.lit(""))
    return panels(samples, [name], step).select(*[text(b).alias(b) for b in by], "tick", "value")


# What the metric rules look at, as (column, kind, metric, window) and what follows.
RULE_MEASURES = (
    Measure("up", "gauge", "up", by=None),
    Measure("failed_rate", "rate", "cdc_consumer_events_failed_total"),
    Measure("events_rate", "rate", "cdc_consumer_events_total"),
    Measure("events_rate_10m", "rate", "cdc_consumer_events_total", 600),
    Measure("processing_p99", "quantile", "cdc_consumer_processing_duration_seconds", q=0.99),
    Measure("connection_errors", "increase", "cdc_postgres_connection_errors_total", by=None),
    Measure("replica_write_p95", "quantile", "cdc_postgres_write_duration_seconds", q=0.95),
    Measure("archive_buffer", "gauge", "cdc_minio_buffer_size"),
    Measure("archive_write_p95", "quantile", "cdc_minio_write_duration_seconds", q=0.95),
    Measure("duplicate_rate", "rate", "cdc_dedup_cache_hits_total"),
    Measure("unique_rate", "rate", "cdc_dedup_cache_misses_total"),
    Measure("dedup_cache_size", "gauge", "cdc_dedup_cache_size", by=None),
)


def metric_rule_inputs(samples: DataFrame, step: int = 60) -> DataFrame:
    """What the metric rules look at: a row per scope, labels and tick, from one pass over the samples.

    Scope ``series`` has a row for each series by itself, at ticks where it has samples; the empty scope has sums
    over all series, and keeps the ticks without samples.
    """
    rows = measured(samples, RULE_MEASURES, step, every_tick=True)
    return wide(rows, [m.name for m in RULE_MEASURES]).withColumnRenamed("tick", "ts")


def metric_rules() -> list[AlertRule]:
    """The ten rules over metric samples, on the frame of ``metric_rule_inputs``."""

    def per(part: str, whole: Column) -> Column:
        return F.col(part) / F.nullif(whole, F.lit(0.0))

    both = F.col("duplicate_rate") + F.col("unique_rate")
    return [
        AlertRule("CDCConsumerDown", F.col("up") == 0, "critical", "CDC consumer is down", 60, per_series=True),
        AlertRule("CDCHighFailureRate", per("failed_rate", F.col("events_rate")) > 0.05, "warning",
                  "High failure rate", 300),
        AlertRule("CDCNoEventsProcessed", F.col("events_rate_10m") == 0, "warning",
                  "No CDC events being processed", 600),
        AlertRule("CDCHighProcessingLatency", F.col("processing_p99") > 1.0, "warning",
                  "High processing latency", 300),
        AlertRule("CDCPostgresConnectionErrors", F.col("connection_errors") > 5, "warning",
                  "PostgreSQL connection errors detected", 120, per_series=True),
        AlertRule("CDCPostgresSlowWrites", F.col("replica_write_p95") > 0.5, "warning", "Slow replica writes", 300),
        AlertRule("CDCMinIOBufferBacklog", F.col("archive_buffer") > 1000, "warning",
                  "MinIO buffer backlog growing", 300),
        AlertRule("CDCMinIOSlowWrites", F.col("archive_write_p95") > 5.0, "warning", "Slow archive writes", 300),
        AlertRule("CDCHighDuplicateRate", per("duplicate_rate", both) > 0.1, "info", "High duplicate rate", 600),
        AlertRule("CDCDedupCacheNearCapacity", F.col("dedup_cache_size") / 100000 > 0.9, "warning",
                  "Deduplication cache near capacity", 300, per_series=True),
    ]


def threshold_colour(
    value: Column, thresholds: Sequence[tuple[float, str]], default: str = "green"
) -> Column:
    """Colour of the highest threshold that is not above the value."""
    colour: Column | None = None
    for limit, name in sorted(thresholds, reverse=True):
        test = value >= limit
        colour = F.when(test, name) if colour is None else colour.when(test, name)
    return F.lit(default) if colour is None else colour.otherwise(default)


def status_report(
    events: DataFrame, failed: Column, latency_seconds: str, lag: Column, queue: Column
) -> DataFrame:
    """One row: totals, error percentage, latency percentiles in ms, lag and queue."""
    rows = events.withColumns({"_failed": failed, "_lag": lag, "_queue": queue})
    totals = rows.agg(
        F.count(F.lit(1)).alias("events_processed"),
        F.count(F.when(F.col("_failed"), 1)).alias("events_failed"),
        (F.max(latency_seconds) * 1000).alias("max_ms"),
        F.coalesce(F.max("_lag"), F.lit(0)).alias("consumer_lag"),
        F.coalesce(F.max("_queue"), F.lit(0)).alias("queue_size"),
    )
    ranks = metrics.rank_percentile(rows, latency_seconds, {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    return attach_one_row(totals, ranks).select(
        "events_processed",
        "events_failed",
        F.round(
            F.coalesce(
                F.lit(100.0) * F.col("events_failed")
                / F.nullif(F.col("events_processed"), F.lit(0).cast("bigint")),
                F.lit(0.0),
            ),
            2,
        ).alias("error_percent"),
        *[(F.col(p) * 1000).alias(f"{p}_ms") for p in ("p50", "p95", "p99")],
        "max_ms",
        "consumer_lag",
        "queue_size",
    )
