"""Metric and alert queries over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.ordered import consecutive_runs, running_sum_in_series, time_slice
from tidemark.operators import alerts, metrics
from tidemark.plans import adapters as a
from tidemark.plans import change_log as cl
from tidemark.plans.registry import plain, query
from tidemark.session import scratch_path, written
from tidemark.sources.events import parse_events

BOUNDS = (1, 5, 10, 25, 50, 100, 250, 500)


def events(spark, d):
    """Events with a shard label and exact values."""
    return a.table(spark, d, "events").withColumns(
        {"shard": F.col("user_id") % 4, "amount": F.col("value").cast("decimal(18,2)")}
    )


def counter_samples(spark, d):
    """Running event counts per type and shard; counts restart after every 50 events."""
    counted = running_sum_in_series(
        events(spark, d), ["event_type", "shard"], ["ts", "event_id"], {"n": F.lit(1)},
        time_slice(F.col("ts"), 86400),
    )
    return counted.select(
        "event_id", "ts", "event_type", "shard", ((F.col("n") - 1) % 50 + 1).alias("value")
    )


EVENTS = """ev AS (
  SELECT *, user_id % 4 AS shard, CAST(value AS DECIMAL(18,2)) AS amount FROM events)"""
COUNTER = """ctr AS (
  SELECT event_id, ts, event_type, shard,
         (row_number() OVER (PARTITION BY event_type, shard ORDER BY ts, event_id) - 1) % 50 + 1 AS value FROM ev),
delta AS (
  SELECT *, CASE WHEN value < prev THEN value ELSE value - prev END AS delta FROM (
    SELECT *, lag(value) OVER (PARTITION BY event_type, shard ORDER BY ts, event_id) AS prev FROM ctr))"""
_EV = a.with_ctes(EVENTS)
_CTR = a.with_ctes(EVENTS, COUNTER)

query(
    "counter_totals",
    _EV
    + """SELECT event_type, shard, CAST(coalesce(sum(amount - 5) FILTER (amount >= 5), 0) AS DOUBLE) AS total,
      count(*) FILTER (amount < 5) AS rejected FROM ev GROUP BY 1, 2""",
)(
    lambda spark, d: plain(
        metrics.counter_totals(
            events(spark, d).withColumn("step", F.col("amount") - 5), ["event_type", "shard"], "step"
        )
    )
)

query(
    "gauge_last",
    _EV
    + """, act AS (SELECT *, CASE WHEN event_id % 40 = 0 THEN 'set' WHEN event_id % 2 = 0 THEN 'inc' ELSE 'dec' END AS action FROM ev),
      s AS (SELECT user_id, max(event_id) FILTER (action = 'set') AS set_at FROM act GROUP BY 1)
      SELECT a.user_id, CAST(coalesce(sum(CASE WHEN event_id = set_at THEN amount
        WHEN (set_at IS NULL OR event_id > set_at) AND action = 'inc' THEN amount
        WHEN (set_at IS NULL OR event_id > set_at) AND action = 'dec' THEN -amount END), 0) AS DOUBLE) AS value
      FROM act a JOIN s USING (user_id) GROUP BY 1""",
)(
    lambda spark, d: plain(
        metrics.gauge_current(
            events(spark, d).withColumn(
                "action",
                F.expr("CASE WHEN event_id % 40 = 0 THEN 'set' WHEN event_id % 2 = 0 THEN 'inc' ELSE 'dec' END"),
            ),
            ["user_id"], ["ts", "event_id"], value="amount",
        )
    )
)

_EDGES = ", ".join(f"({b})" for b in BOUNDS)

query(
    "histogram",
    _EV
    + f""", edge(le) AS (SELECT CAST(col0 AS DOUBLE) FROM (VALUES {_EDGES}) UNION ALL SELECT CAST('Infinity' AS DOUBLE)),
      h AS (SELECT event_type, le, count(*) FILTER (amount <= le) AS cumulative_count, count(*) AS "count",
        CAST(sum(amount) AS DOUBLE) AS "sum", CAST(min(amount) AS DOUBLE) AS "min", CAST(max(amount) AS DOUBLE) AS "max"
        FROM ev, edge GROUP BY 1, 2)
      SELECT event_type, CASE WHEN isinf(le) THEN '+Inf' ELSE CAST(le AS VARCHAR) END AS le, cumulative_count,
        cumulative_count - coalesce(lag(cumulative_count) OVER (PARTITION BY event_type ORDER BY h.le), 0) AS bucket_count,
        "count", "sum", "min", "max", "sum" / "count" AS avg FROM h""",
)(
    lambda spark, d: plain(
        metrics.histogram(events(spark, d), "amount", BOUNDS, ["event_type"]).withColumn(
            "le", F.when(F.col("le") == float("inf"), "+Inf").otherwise(F.col("le").cast("string"))
        )
    )
)


def _rank_sql(name, p):
    return (
        f"CAST(min(CASE WHEN rn > least(floor(CAST(n AS DOUBLE) * CAST({p} AS DOUBLE)), n - 1) THEN amount END)"
        f" AS DOUBLE) AS {name}"
    )


_RANKED = """ranked AS (
  SELECT event_type, amount, row_number() OVER (PARTITION BY event_type ORDER BY amount) AS rn,
         count(*) OVER (PARTITION BY event_type) AS n FROM ev)"""
_RANK_COLUMNS = ", ".join(_rank_sql(n, p) for n, p in metrics.PERCENTILES.items())

query(
    "rank_percentiles",
    a.with_ctes(EVENTS, _RANKED) + f"SELECT event_type, {_RANK_COLUMNS} FROM ranked GROUP BY 1",
)(lambda spark, d: plain(metrics.rank_percentile(events(spark, d), "amount", by=["event_type"])))

query(
    "distribution",
    a.with_ctes(EVENTS, _RANKED)
    + f"""SELECT event_type, count(*) AS "count", CAST(sum(amount) AS DOUBLE) AS "sum",
      CAST((2 * CAST(sum(amount) * 100 AS HUGEINT) * 10000 + count(*)) // (2 * count(*)) AS DOUBLE) / 1e6 AS mean,
      CAST(min(amount) AS DOUBLE) AS "min", CAST(max(amount) AS DOUBLE) AS "max",
      round(stddev_samp(amount), 6) AS stddev,
      CAST(sum(amount) FILTER (rn IN ((n + 1) // 2, n // 2 + 1)) AS DOUBLE) / count(*) FILTER (rn IN ((n + 1) // 2, n // 2 + 1)) AS median,
      {_RANK_COLUMNS}
      FROM ranked GROUP BY 1""",
)(
    lambda spark, d: plain(
        metrics.distribution(events(spark, d), "amount", ["event_type"]).withColumn(
            "stddev", F.round("stddev", 6)
        )
    )
)

query(
    "distribution_overall",
    _EV
    + """SELECT count(*) AS "count", CAST(max(amount) AS DOUBLE) AS "max",
      CAST(sum(amount) FILTER (rn IN ((n + 1) // 2, n // 2 + 1)) AS DOUBLE) / count(*) FILTER (rn IN ((n + 1) // 2, n // 2 + 1)) AS median
      FROM (SELECT amount, row_number() OVER (ORDER BY amount) AS rn, count(*) OVER () AS n FROM ev)""",
)(
    lambda spark, d: plain(
        metrics.distribution(events(spark, d), "amount", percentiles={"p50": 0.5}).select("count", "max", "median")
    )
)

_W6H = """WINDOW w AS (PARTITION BY event_type, shard ORDER BY epoch_us(ts)
  RANGE BETWEEN 21599999999 PRECEDING AND CURRENT ROW)"""

query(
    "counter_increase",
    _CTR
    + f"""SELECT event_id, CAST(CASE WHEN n > 1 THEN total - coalesce(d0, 0) END AS DOUBLE) AS increase FROM (
        SELECT event_id, count(*) OVER w AS n, coalesce(sum(delta) OVER w, 0) AS total, first_value(delta) OVER w AS d0
        FROM delta {_W6H})""",
)(
    lambda spark, d: plain(
        metrics.counter_increase(
            counter_samples(spark, d), ["event_type", "shard"], 21600, tie_break=["event_id"]
        ).select("event_id", F.col("increase").cast("double").alias("increase"))
    )
)

query(
    "counter_rate",
    _CTR
    + f"""SELECT event_id, CASE WHEN n > 1 THEN CAST(total - coalesce(d0, 0) AS DOUBLE)
        / nullif(CAST(epoch_us(ts) - t0 AS DOUBLE) / 1e6, 0) END AS rate FROM (
        SELECT event_id, ts, count(*) OVER w AS n, coalesce(sum(delta) OVER w, 0) AS total,
          first_value(delta) OVER w AS d0, min(epoch_us(ts)) OVER w AS t0
        FROM delta {_W6H})""",
)(
    lambda spark, d: plain(
        metrics.counter_increase(
            counter_samples(spark, d), ["event_type", "shard"], 21600, tie_break=["event_id"]
        ).select("event_id", "rate")
    )
)

query(
    "tick_rate_by_type",
    _CTR
    + """, t AS (SELECT event_type, epoch_us(ts) // 3600000000 + 1 AS h, coalesce(sum(delta), 0) AS g FROM delta GROUP BY 1, 2),
      b AS (SELECT min(epoch_us(ts) // 3600000000 + 1) AS lo, max(epoch_us(ts) // 3600000000 + 1) AS hi FROM ctr),
      full_t AS (SELECT ty.event_type, r.h, coalesce(t.g, 0) AS g
        FROM (SELECT DISTINCT event_type FROM ctr) ty, (SELECT unnest(generate_series(lo, hi)) AS h FROM b) r
        LEFT JOIN t ON t.event_type = ty.event_type AND t.h = r.h)
      SELECT event_type, CAST(make_timestamp(h * 3600000000) AS VARCHAR) AS tick,
        CAST(sum(g) OVER w AS DOUBLE) AS increase, CAST(sum(g) OVER w AS DOUBLE) / 10800 AS rate
      FROM full_t WINDOW w AS (PARTITION BY event_type ORDER BY h ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)(
    lambda spark, d: plain(
        metrics.tick_increase(
            counter_samples(spark, d), ["event_type"], 3600, 10800, ["event_type", "shard"],
            tie_break=["event_id"], bounds=metrics.tick_bounds(counter_samples(spark, d), "ts", 3600),
        ).withColumn("increase", F.col("increase").cast("double"))
    )
)

query(
    "histogram_quantile",
    _EV
    + f""", edge(le) AS (SELECT CAST(col0 AS DOUBLE) FROM (VALUES {_EDGES}) UNION ALL SELECT CAST('Infinity' AS DOUBLE)),
      h AS (SELECT event_type, le, count(*) FILTER (amount <= le) AS cum FROM ev, edge GROUP BY 1, 2),
      f AS (SELECT *, coalesce(lag(le) OVER w, 0) AS low, coalesce(lag(cum) OVER w, 0) AS under,
        max(cum) OVER (PARTITION BY event_type) * CAST(0.95 AS DOUBLE) AS rank FROM h WINDOW w AS (PARTITION BY event_type ORDER BY le))
      SELECT event_type, round(arg_min(CASE WHEN isinf(le) THEN low
          ELSE low + (le - low) * (rank - under) / (cum - under) END, le) FILTER (cum >= rank), 6) AS quantile
      FROM f GROUP BY 1""",
)(
    lambda spark, d: metrics.histogram_quantile(
        metrics.histogram(events(spark, d), "amount", BOUNDS, ["event_type"]), 0.95, ["event_type"]
    ).withColumn("quantile", F.round("quantile", 6))
)

query(
    "rolling_throughput",
    _EV
    + """, c AS (SELECT epoch_us(ts) // 60000000 AS m, count(*) AS n FROM ev GROUP BY 1),
      s AS (SELECT min(epoch_us(ts)) AS t0 FROM ev),
      r AS (SELECT m, n, sum(n) OVER (ORDER BY m RANGE BETWEEN 59 PRECEDING AND CURRENT ROW) AS w,
        sum(n) OVER (ORDER BY m) AS total, CAST((m + 1) * 60000000 - t0 AS DOUBLE) / 1e6 AS age FROM c, s)
      SELECT CAST(make_timestamp(m * 60000000) AS VARCHAR) AS bucket, n AS events, CAST(total AS BIGINT) AS total,
        CAST(w AS DOUBLE) / nullif(least(age, 3600.0), 0) AS rate_per_second,
        CAST(total AS DOUBLE) / nullif(age, 0) AS average_rate_per_second FROM r""",
)(lambda spark, d: plain(metrics.rolling_throughput(events(spark, d), "ts", 3600, 60)))

query(
    "consecutive_errors",
    _EV
    + """, f AS (SELECT *, event_type = 'error' AS bad, row_number() OVER (PARTITION BY shard ORDER BY ts, event_id) AS rn FROM ev),
      g AS (SELECT *, rn - row_number() OVER (PARTITION BY shard, bad ORDER BY ts, event_id) AS grp FROM f)
      SELECT event_id, bad, CAST(row_number() OVER (PARTITION BY shard, bad, grp ORDER BY rn) AS BIGINT) AS run_length FROM g""",
)(
    lambda spark, d: plain(
        consecutive_runs(
            events(spark, d).withColumn("bad", F.col("event_type") == "error"), ["shard"], ["ts", "event_id"],
            "bad", time_slice(F.col("ts"), 86400),
        ).select("event_id", "bad", "run_length")
    )
)

query(
    "ratios",
    _EV
    + """SELECT user_id, count(*) AS events,
      CAST(count(*) FILTER (event_type = 'error') AS DOUBLE) / count(*) AS failure_rate,
      CAST(count(*) FILTER (event_id % 9 = 0) AS DOUBLE) / count(*) AS duplicate_rate,
      CAST(count(*) FILTER (event_type <> 'error') AS DOUBLE) / count(*) AS success_rate FROM ev GROUP BY 1""",
)(
    lambda spark, d: metrics.outcome_ratios(
        events(spark, d), ["user_id"], F.col("event_type") == "error", F.col("event_id") % 9 == 0
    )
)

query(
    "resource_summary",
    _EV
    + """SELECT shard, CAST((2 * CAST(sum(amount) * 100 AS HUGEINT) * 10000 + count(*)) // (2 * count(*)) AS DOUBLE) / 1e6 AS cpu_mean,
      CAST(max(amount) AS DOUBLE) AS cpu_max, CAST(min(amount) AS DOUBLE) AS cpu_min,
      avg(user_id) AS memory_mean, max(user_id) AS memory_max, min(user_id) AS memory_min,
      arg_max(user_id, ts) AS memory_last, max(event_id % 17) AS threads_max FROM ev GROUP BY 1""",
)(
    lambda spark, d: plain(
        metrics.resource_summary(
            events(spark, d).withColumn("threads", F.col("event_id") % 17), ["shard"], "ts", "amount", "user_id"
        )
    )
)

query(
    "latency",
    _EV
    + """SELECT event_type, CAST(max(CAST(json_extract(props, '$.k') AS BIGINT)) * 1000 AS DOUBLE) AS max_latency_ms
      FROM ev GROUP BY 1""",
)(
    lambda spark, d: metrics.end_to_end_latency(
        events(spark, d).withColumn(
            "done", F.col("ts") + F.make_dt_interval(secs=F.get_json_object("props", "$.k").cast("int"))
        ),
        "ts", "done",
    )
    .groupBy("event_type")
    .agg(F.max("latency_ms").alias("max_latency_ms"))
)

def _offset_lag(spark, d):
    """Messages that came with an id; seven in ten entities count as consumed."""
    parsed = parse_events(cl.raw_events(spark, d)).where("wire_event_id IS NOT NULL AND schema_error IS NULL")
    entity = F.get_json_object(F.coalesce("after", "before"), "$.id").cast("bigint")
    return plain(metrics.offset_lag(parsed, parsed.where(entity % 10 < 7)))


query(
    "offset_lag",
    a.with_ctes(*cl.LOG_CTES)
    + """SELECT topic, CAST(part AS BIGINT) AS partition, max(off) AS log_end, max(off) FILTER (id % 10 < 7) AS committed,
      max(off) - coalesce(max(off) FILTER (id % 10 < 7), -1) AS lag
      FROM log WHERE damage IS NULL GROUP BY 1, 2""",
)(_offset_lag)


def _exposition(spark, d):
    ev = events(spark, d)
    counters = (
        ev.groupBy("event_type", "shard")
        .agg(F.count(F.lit(1)).cast("double").alias("value"))
        .select(
            F.lit("events_total").alias("name"), F.lit("counter").alias("kind"), F.lit("Events seen").alias("help"),
            F.create_map(F.lit("shard"), F.col("shard").cast("string"), F.lit("event_type"), "event_type").alias("labels"),
            "value",
        )
    )
    hist = metrics.histogram(ev, "amount", BOUNDS, ["event_type"]).select(
        F.lit("event_value").alias("name"), F.lit("Event values").alias("help"),
        F.create_map(F.lit("event_type"), "event_type").alias("labels"), "le", "cumulative_count", "count", "sum",
    )
    return metrics.metrics_to_text(counters, hist).select("line")


query(
    "exposition",
    _EV
    + f""", edge(le) AS (SELECT CAST(col0 AS DOUBLE) FROM (VALUES {_EDGES}) UNION ALL SELECT CAST('Infinity' AS DOUBLE))
      SELECT '# HELP events_total Events seen' AS line UNION ALL SELECT '# TYPE events_total counter'
      UNION ALL SELECT '# HELP event_value Event values' UNION ALL SELECT '# TYPE event_value histogram'
      UNION ALL SELECT 'events_total{{event_type="' || event_type || '",shard="' || shard || '"}} ' || CAST(CAST(count(*) AS DOUBLE) AS VARCHAR)
        FROM ev GROUP BY event_type, shard
      UNION ALL SELECT 'event_value_bucket{{event_type="' || event_type || '",le="' || CASE WHEN isinf(le) THEN '+Inf' ELSE CAST(le AS VARCHAR) END
        || '"}} ' || count(*) FILTER (amount <= le) FROM ev, edge GROUP BY event_type, le
      UNION ALL SELECT 'event_value_sum{{event_type="' || event_type || '"}} ' || sum(amount) FROM ev GROUP BY event_type
      UNION ALL SELECT 'event_value_count{{event_type="' || event_type || '"}} ' || count(*) FROM ev GROUP BY event_type""",
)(_exposition)

# ---- alerts -------------------------------------------------------------------------


def wide_ticks(spark, d):
    """Ten-minute ticks with the metrics the standard rules look at; lag and errors vary with the events."""
    bucket = F.timestamp_seconds((time_slice(F.col("ts"), 600) + 1) * 600)
    return (
        events(spark, d)
        .groupBy(bucket.alias("ts"))
        .agg(
            F.max("amount").cast("double").alias("replication_lag_seconds"),
            (F.count(F.when(F.col("event_type") == "error", 1)) / F.count(F.lit(1))).alias("error_rate"),
            (F.max("user_id") * 100).cast("double").alias("kafka_consumer_lag"),
            (F.max("event_id") % 20).cast("double").alias("db_connection_errors"),
            F.count(F.lit(1)).cast("double").alias("events_per_second"),
        )
    )


_WIDE = """wide AS (
  SELECT make_timestamp((epoch_us(ts) // 600000000 + 1) * 600000000) AS ts, CAST(max(amount) AS DOUBLE) AS lag,
         CAST(count(*) FILTER (event_type = 'error') AS DOUBLE) / count(*) AS err, max(user_id) * 100 AS klag,
         max(event_id) % 20 AS dberr, count(*) AS eps FROM ev GROUP BY 1),
evals AS (
  SELECT ts, r.rule, r.secs, r.level, CASE r.rule WHEN 'high_replication_lag' THEN lag > 60 WHEN 'critical_replication_lag' THEN lag > 300
    WHEN 'high_error_rate' THEN err > 0.05 WHEN 'kafka_consumer_lag' THEN klag > 10000
    WHEN 'database_connection_errors' THEN dberr > 10 WHEN 'low_throughput' THEN eps < 10 ELSE false END AS met
  FROM wide, (VALUES ('high_replication_lag', 300, 'warning'), ('critical_replication_lag', 120, 'critical'),
    ('high_error_rate', 300, 'warning'), ('kafka_consumer_lag', 600, 'warning'), ('database_connection_errors', 120, 'critical'),
    ('low_throughput', 900, 'warning'), ('high_memory_usage', 300, 'warning')) r(rule, secs, level)),
runs AS (
  SELECT *, max(CASE WHEN met AND NOT coalesce(was, false) THEN ts END) OVER (PARTITION BY rule ORDER BY ts) AS run_start FROM (
    SELECT *, lag(met) OVER (PARTITION BY rule ORDER BY ts) AS was FROM evals)),
alerts AS (
  SELECT rule, level, run_start AS started_at,
    min(ts) FILTER (met AND epoch_us(ts) - epoch_us(run_start) >= secs * 1000000) AS fired_at,
    min(ts) FILTER (NOT met) AS resolved_at, max(ts) FILTER (met) AS last_seen
  FROM runs WHERE met OR was GROUP BY 1, 2, 3
  HAVING min(ts) FILTER (met AND epoch_us(ts) - epoch_us(run_start) >= secs * 1000000) IS NOT NULL)"""
_ALERT = a.with_ctes(EVENTS, _WIDE)


def _evals(spark, d):
    wide = wide_ticks(spark, d)
    rules = alerts.standard_rules(wide)
    return alerts.evaluate_rules(wide, rules), rules


query("rule_evals", _ALERT + "SELECT CAST(ts AS VARCHAR) AS ts, rule, met FROM evals")(
    lambda spark, d: plain(_evals(spark, d)[0])
)

query(
    "alert_states",
    _ALERT
    + """SELECT rule, level, CAST(started_at AS VARCHAR) AS started_at, CAST(fired_at AS VARCHAR) AS fired_at,
      CAST(resolved_at AS VARCHAR) AS resolved_at, CASE WHEN resolved_at IS NULL THEN 'firing' ELSE 'resolved' END AS state FROM alerts""",
)(
    lambda spark, d: plain(
        alerts.alert_states(*_evals(spark, d)).select(
            "rule", "level", "started_at", "fired_at", "resolved_at", "state"
        )
    )
)

query(
    "alert_ticks",
    _ALERT
    + """SELECT rule, CAST(ts AS VARCHAR) AS ts, CASE WHEN NOT met THEN 'inactive'
        WHEN epoch_us(ts) - epoch_us(run_start) >= secs * 1000000 THEN 'firing' ELSE 'pending' END AS state,
      CASE WHEN met THEN CAST(run_start AS VARCHAR) END AS started_at FROM runs""",
)(lambda spark, d: plain(alerts.tick_states(*_evals(spark, d))))

query(
    "active_by_level",
    _ALERT
    + """SELECT CAST(ts AS VARCHAR) AS ts, level, count(*) AS active FROM runs
      WHERE met AND epoch_us(ts) - epoch_us(run_start) >= secs * 1000000 GROUP BY 1, 2""",
)(
    lambda spark, d: plain(
        alerts.active_by_level(
            alerts.tick_states(*_evals(spark, d)), _evals(spark, d)[1]
        )
    )
)

SILENCES = (
    alerts.Silence("2024-01-05 00:00:00", "2024-01-05 06:00:00", {"alertname": "low_throughput"}),
    alerts.Silence("2024-01-10 00:00:00", "2024-01-12 00:00:00", {"category": "performance"}),
)

_SILENCED = """((rule = 'low_throughput' AND {0} BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-05 06:00:00')
  OR (rule IN ('high_replication_lag', 'critical_replication_lag', 'low_throughput')
      AND {0} BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00'))"""

query(
    "silenced",
    _ALERT
    + f"""SELECT rule, CAST(ts AS VARCHAR) AS ts FROM runs
      WHERE met AND epoch_us(ts) - epoch_us(run_start) >= secs * 1000000 AND NOT {_SILENCED.format('ts')}""",
)(
    lambda spark, d: plain(
        (lambda evals, rules: alerts.drop_silenced(
            alerts.tick_states(evals, rules).where("state = 'firing'"), rules, SILENCES
        ))(*_evals(spark, d)).select("rule", "ts")
    )
)

query(
    "notifications",
    _ALERT
    + f""", sil(rule, a, b) AS (VALUES
        ('low_throughput', epoch_us(TIMESTAMP '2024-01-05 00:00:00'), epoch_us(TIMESTAMP '2024-01-05 06:00:00')),
        ('low_throughput', epoch_us(TIMESTAMP '2024-01-10 00:00:00'), epoch_us(TIMESTAMP '2024-01-12 00:00:00')),
        ('high_replication_lag', epoch_us(TIMESTAMP '2024-01-10 00:00:00'), epoch_us(TIMESTAMP '2024-01-12 00:00:00')),
        ('critical_replication_lag', epoch_us(TIMESTAMP '2024-01-10 00:00:00'), epoch_us(TIMESTAMP '2024-01-12 00:00:00'))),
      base AS (SELECT rule, started_at, epoch_us(fired_at) AS f,
        CASE WHEN resolved_at IS NULL THEN epoch_us(last_seen) + 1 ELSE epoch_us(resolved_at) END AS stop FROM alerts),
      sent AS (
        SELECT rule, started_at, f, stop, coalesce((SELECT b + 1 FROM sil s WHERE s.rule = base.rule AND f BETWEEN a AND b), f) AS due FROM base
        UNION ALL
        SELECT rule, started_at, f, stop, coalesce((SELECT b + 1 FROM sil s WHERE s.rule = sent.rule
          AND sent.due + 14400000000 BETWEEN a AND b), due + 14400000000) FROM sent WHERE due < stop)
      SELECT rule, CAST(started_at AS VARCHAR) AS started_at, CAST(make_timestamp(due) AS VARCHAR) AS notified_at,
        CASE WHEN due = f THEN 'firing' ELSE 'repeat' END AS kind FROM sent WHERE due < stop
      UNION ALL SELECT rule, CAST(started_at AS VARCHAR), CAST(resolved_at AS VARCHAR), 'resolved' FROM alerts
      WHERE resolved_at IS NOT NULL AND NOT {_SILENCED.format('resolved_at')}""",
)(
    lambda spark, d: plain(
        (lambda evals, rules: alerts.notifications(alerts.alert_states(evals, rules), rules, SILENCES))(
            *_evals(spark, d)
        )
    )
)

query(
    "threshold_colour",
    _EV
    + """SELECT event_id, CASE WHEN value >= 100 THEN 'red' WHEN value >= 50 THEN 'orange' WHEN value >= 10 THEN 'yellow'
      ELSE 'green' END AS colour FROM ev""",
)(
    lambda spark, d: events(spark, d).select(
        "event_id",
        alerts.threshold_colour(F.col("value"), [(10, "yellow"), (100, "red"), (50, "orange")]).alias("colour"),
    )
)

query(
    "status_report",
    a.with_ctes(EVENTS)
    + """, ranked AS (SELECT amount, row_number() OVER (ORDER BY amount) AS rn, count(*) OVER () AS n FROM ev)
      SELECT count(*) AS events_processed, (SELECT count(*) FROM ev WHERE event_type = 'error') AS events_failed,
        round(100.0 * (SELECT count(*) FROM ev WHERE event_type = 'error') / CAST(count(*) AS DOUBLE), 2) AS error_percent,
        CAST(min(CASE WHEN rn > least(floor(n * CAST(0.5 AS DOUBLE)), n - 1) THEN amount END) * 1000 AS DOUBLE) AS p50_ms,
        CAST(min(CASE WHEN rn > least(floor(n * CAST(0.95 AS DOUBLE)), n - 1) THEN amount END) * 1000 AS DOUBLE) AS p95_ms,
        CAST(min(CASE WHEN rn > least(floor(n * CAST(0.99 AS DOUBLE)), n - 1) THEN amount END) * 1000 AS DOUBLE) AS p99_ms,
        CAST(max(amount) * 1000 AS DOUBLE) AS max_ms, (SELECT max(user_id) FROM ev) AS consumer_lag,
        (SELECT max(event_id % 17) FROM ev) AS queue_size FROM ranked""",
)(
    lambda spark, d: plain(
        alerts.status_report(
            events(spark, d), F.col("event_type") == "error", "amount", F.col("user_id"), F.col("event_id") % 17
        )
    )
)

query(
    "time_range",
    _EV
    + """SELECT event_type, count(*) AS events FROM ev
      WHERE ts >= TIMESTAMP '2024-01-28 00:00:00' AND ts <= TIMESTAMP '2024-01-31 00:00:00' GROUP BY 1""",
)(
    lambda spark, d: events(spark, d)
    .where(metrics.last_interval("ts", 3, "days", a.EVENTS_AS_OF))
    .groupBy("event_type")
    .agg(F.count(F.lit(1)).alias("events"))
)


# ---- rules and panels over samples --------------------------------------------------

_EDGE_LABELS = {"0.5": 0.5, "1.0": 1.0, "2.5": 2.5, "+Inf": float("inf")}
_SAMPLES: dict[tuple[str, str], str] = {}


def consumer_samples(spark, d):
    """Counter and histogram samples of a consumer that saw the events; written once, like a stored table."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _SAMPLES:
        _SAMPLES[key] = scratch_path(spark, "samples")
        _consumer_samples(spark, d).write.parquet(_SAMPLES[key])
    return metrics.read_metrics(spark, _SAMPLES[key])


def _consumer_samples(spark, d):
    ev = events(spark, d).select("event_id", "ts", "event_type", "shard", (F.col("value") / 10).alias("seconds"))
    day = time_slice(F.col("ts"), 86400)
    order = ["ts", "event_id"]

    def sample(df, name, labels):
        pairs = [x for k, v in labels.items() for x in (F.lit(k), v)]
        return df.select("ts", F.lit(name).alias("name"), F.create_map(*pairs).alias("labels"), F.col("n").cast("double").alias("value"))

    total = running_sum_in_series(ev, ["event_type"], order, {"n": F.lit(1)}, day)
    failed = running_sum_in_series(ev.where("event_type = 'error'"), ["shard"], order, {"n": F.lit(1)}, day)
    edges = F.array(*[F.struct(F.lit(k).alias("le"), F.lit(v).alias("edge")) for k, v in _EDGE_LABELS.items()])
    spread_out = ev.select("*", F.inline(edges))
    bucket = running_sum_in_series(spread_out, ["le"], order, {"n": (F.col("seconds") <= F.col("edge")).cast("int")}, day)
    return (
        sample(total, "cdc_consumer_events_total", {"topic": F.col("event_type")})
        .unionByName(sample(failed, "cdc_consumer_events_failed_total", {"sink": F.concat(F.lit("s"), F.col("shard").cast("string"))}))
        .unionByName(sample(bucket, "cdc_consumer_processing_duration_seconds_bucket", {"le": F.col("le")}))
    )


# Growth per minute tick; the first sample of a series has none.
_GROWTH = """s AS (SELECT event_id, ts, event_type, user_id % 4 AS shard, value / 10 AS seconds, epoch_us(ts) // 60000000 + 1 AS k FROM events),
tot AS (SELECT event_type, k, sum(CASE WHEN nth = 1 THEN 0 ELSE 1 END) AS g FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS nth FROM s) GROUP BY 1, 2),
fai AS (SELECT k, sum(CASE WHEN nth = 1 THEN 0 ELSE 1 END) AS g FROM (
  SELECT *, row_number() OVER (PARTITION BY shard ORDER BY ts, event_id) AS nth FROM s WHERE event_type = 'error') GROUP BY 1),
edge(le) AS (VALUES (0.5::DOUBLE), (1.0::DOUBLE), (2.5::DOUBLE), ('Infinity'::DOUBLE)),
buc AS (SELECT le, k, sum(CASE WHEN nth > 1 AND seconds <= le THEN 1 ELSE 0 END) AS g FROM (
  SELECT s.*, row_number() OVER (ORDER BY ts, event_id) AS nth FROM s), edge GROUP BY 1, 2)"""
_P = """SELECT k, arg_min(CASE WHEN isinf(le) THEN low ELSE low + (le - low) * (rank - under) / (cum - under) END, le)
    FILTER (cum >= rank AND cum > 0) AS p FROM (
  SELECT *, coalesce(lag(le) OVER w, 0) AS low, coalesce(lag(cum) OVER w, 0) AS under,
    CAST(max(cum) OVER (PARTITION BY k) AS DOUBLE) * CAST({0} AS DOUBLE) AS rank FROM ({1}) WINDOW w AS (PARTITION BY k ORDER BY le)) GROUP BY 1"""

query(
    "panel_events_by_topic",
    a.with_ctes(_GROWTH)
    + """SELECT event_type AS topic, CAST(make_timestamp(k * 60000000) AS VARCHAR) AS tick, CAST(g AS DOUBLE) / 60 AS value FROM tot""",
)(lambda spark, d: plain(alerts.panel(consumer_samples(spark, d), "events_by_topic")))

query(
    "panel_processing_p95",
    a.with_ctes(_GROWTH)
    + "SELECT CAST(make_timestamp(k * 60000000) AS VARCHAR) AS tick, round(p, 6) AS value FROM ("
    + _P.format(
        0.95,
        "SELECT le, k, sum(g) OVER (PARTITION BY le ORDER BY k RANGE BETWEEN 4 PRECEDING AND CURRENT ROW) AS cum FROM buc",
    )
    + ")",
)(
    lambda spark, d: plain(
        alerts.panel(consumer_samples(spark, d), "processing_p95").withColumn("value", F.round("value", 6))
    )
)

query(
    "metric_rule_evals",
    a.with_ctes(_GROWTH)
    + """, grid AS (SELECT unnest(generate_series((SELECT min(k) FROM s), (SELECT max(k) FROM s))) AS k),
      ev_k AS (SELECT grid.k, coalesce(sum(tot.g), 0) AS e FROM grid LEFT JOIN tot USING (k) GROUP BY 1),
      fa_k AS (SELECT grid.k, coalesce(sum(fai.g), 0) AS f FROM grid LEFT JOIN fai USING (k) GROUP BY 1),
      bu_k AS (SELECT edge.le, grid.k, coalesce(buc.g, 0) AS g FROM edge CROSS JOIN grid LEFT JOIN buc ON buc.le = edge.le AND buc.k = grid.k),
      p99 AS ("""
    + _P.format(
        0.99,
        "SELECT le, k, sum(g) OVER (PARTITION BY le ORDER BY k ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS cum FROM bu_k",
    )
    + """),
      w AS (SELECT k, CAST(sum(f) OVER w5 AS DOUBLE) / 300 AS f5, CAST(sum(e) OVER w5 AS DOUBLE) / 300 AS e5, sum(e) OVER w10 AS e10
        FROM ev_k JOIN fa_k USING (k) WINDOW w5 AS (ORDER BY k ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
          w10 AS (ORDER BY k ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
      SELECT CAST(make_timestamp(k * 60000000) AS VARCHAR) AS ts, rule FROM (
        SELECT k, 'CDCHighFailureRate' AS rule FROM w WHERE f5 / nullif(e5, 0) > 0.05
        UNION ALL SELECT k, 'CDCNoEventsProcessed' FROM w WHERE e10 = 0
        UNION ALL SELECT k, 'CDCHighProcessingLatency' FROM p99 WHERE p > 1.0)""",
)(
    lambda spark, d: plain(
        alerts.evaluate_rules(alerts.metric_rule_inputs(consumer_samples(spark, d)), alerts.metric_rules())
        .where("met")
        .select("ts", "rule")
    )
)


# ---- all rules and panels, by series -------------------------------------------------

# Derived samples: metric -> (rows, labels, what a counter grows by or a gauge shows), in words both engines read.
_INSTANCE = {"instance": "'i' || (user_id % 3)"}
_COUNTERS = {
    "cdc_consumer_events_total": ("true", {"topic": "event_type"}, "1"),
    "cdc_consumer_events_processed_total": ("event_type <> 'error'", {"sink": "'s' || (user_id % 4)"}, "1"),
    "cdc_consumer_events_failed_total": (
        "event_type = 'error'", {"sink": "'s' || (user_id % 4)", "error_type": "'e' || (event_id % 2)"}, "1"),
    "cdc_postgres_connection_errors_total": ("event_id % 2 = 0", _INSTANCE, "event_id % 9"),
    "cdc_minio_events_archived_total": ("true", {"table": "event_type"}, "1 + event_id % 3"),
    "cdc_dedup_cache_hits_total": ("event_id % 5 > 0", _INSTANCE, "1"),
    "cdc_dedup_cache_misses_total": ("event_id % 2 = 0", _INSTANCE, "1"),
}
_GAUGES = {
    "up": ("true", _INSTANCE, "CASE WHEN user_id % 3 = 1 AND event_id % 400 < 40 THEN 0 ELSE 1 END"),
    "cdc_minio_buffer_size": ("true", {"table": "event_type"}, "event_id % 3000"),
    "cdc_dedup_cache_size": ("event_id % 3 > 0", _INSTANCE, "80000 + (event_id % 1000) * 20"),
}
_HISTOGRAMS = {
    "cdc_consumer_processing_duration_seconds": ("true", {}, "value / 10"),
    "cdc_postgres_write_duration_seconds": ("event_id % 2 = 1", {}, "value / 40"),
    "cdc_minio_write_duration_seconds": ("event_id % 3 = 1", {}, "value / 2"),
}
_ALL_EDGES = {"0.1": 0.1, "0.5": 0.5, "1.0": 1.0, "2.5": 2.5, "5.0": 5.0, "10.0": 10.0, "+Inf": float("inf")}


def pipeline_samples(spark, d):
    """Samples of every metric that the rules and panels read, derived from the events."""
    ev = events(spark, d).select("event_id", "ts", "event_type", "user_id", "value")
    day = time_slice(F.col("ts"), 86400)

    def sample(rows, name, labels, value):
        pairs = [x for k, v in labels.items() for x in (F.lit(k), v)]
        held = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
        return rows.select("ts", F.lit(name).alias("name"), held.alias("labels"), value.cast("double").alias("value"))

    def counter(name, rows, keys, labels, amount):
        summed = running_sum_in_series(rows.withColumns(keys), list(keys), ["ts", "event_id"], {"n": amount}, day)
        return sample(summed, name, labels, F.col("n"))

    out = []
    for name, (rows, labels, amount) in _COUNTERS.items():
        keys = {f"_{k}": F.expr(e) for k, e in labels.items()}
        out.append(counter(name, ev.where(rows), keys, {k: F.col(f"_{k}") for k in labels}, F.expr(amount)))
    for name, (rows, labels, value) in _GAUGES.items():
        out.append(sample(ev.where(rows), name, {k: F.expr(e) for k, e in labels.items()}, F.expr(value)))
    edges = F.array(*[F.struct(F.lit(k).alias("_le"), F.lit(v).alias("edge")) for k, v in _ALL_EDGES.items()])
    for name, (rows, _, seconds) in _HISTOGRAMS.items():
        wide = ev.where(rows).select("*", F.inline(edges))
        out.append(counter(f"{name}_bucket", wide, {"_k": F.col("_le")}, {"le": F.col("_le")}, (F.expr(seconds) <= F.col("edge")).cast("int")))
    union = out[0]
    for part in out[1:]:
        union = union.unionByName(part)
    return written(union, "pipeline-samples")


def _sql_labels(labels, by) -> str:
    parts = [f"""'{k}="' || ({labels[k]}) || '"'""" for k in sorted(labels) if k in by]
    return " || ',' || ".join(parts) or "''"


_S = "s AS (SELECT event_id, ts, event_type, user_id, value, epoch_us(ts) // 60000000 + 1 AS k FROM events)"


def _sql_growth(metric, by) -> str:
    """Rows (labels, k, g) of a counter."""
    rows, labels, amount = _COUNTERS[metric]
    own = ", ".join(f"({e})" for e in labels.values())
    return f"""(SELECT labels, k, sum(g) AS g FROM (SELECT {_sql_labels(labels, labels if by is None else by)} AS labels, k,
      CASE WHEN row_number() OVER (PARTITION BY {own} ORDER BY ts, event_id) = 1 THEN 0 ELSE {amount} END AS g FROM s WHERE {rows}) GROUP BY 1, 2)"""


def _sql_quantile(metric, q, grid="") -> str:
    """Rows (k, p); with ``grid`` (a table of k) at all ticks."""
    rows, _, seconds = _HISTOGRAMS[metric]
    edges = ", ".join(f"({v if v < float('inf') else repr('Infinity')}::DOUBLE)" for v in _ALL_EDGES.values())
    grown = f"""SELECT le, k, sum(CASE WHEN nth > 1 AND seconds <= le THEN 1 ELSE 0 END) AS g FROM (
      SELECT k, {seconds} AS seconds, row_number() OVER (ORDER BY ts, event_id) AS nth FROM s WHERE {rows}), (VALUES {edges}) e(le) GROUP BY 1, 2"""
    if grid:
        grown = f"""SELECT e.le, gr.k, coalesce(b.g, 0) AS g FROM {grid} gr CROSS JOIN (VALUES {edges}) e(le) LEFT JOIN ({grown}) b ON b.le = e.le AND b.k = gr.k"""
    return "(" + _P.format(
        q, f"SELECT le, k, sum(g) OVER (PARTITION BY le ORDER BY k RANGE BETWEEN 4 PRECEDING AND CURRENT ROW) AS cum FROM ({grown})"
    ) + ")"


def _sql_panel(name) -> str:
    kind, metric, args = alerts.PANELS[name]
    by, tick = args.get("by", []), "CAST(make_timestamp(k * 60000000) AS VARCHAR) AS tick"
    if kind == "quantile":
        return f"SELECT '{name}' AS panel, '' AS labels, {tick}, round(p, 6) AS value FROM {_sql_quantile(metric, args['q'])}"
    if kind == "gauge":
        rows, labels, value = _GAUGES[metric]
        full, some = _sql_labels(labels, labels), _sql_labels(labels, by)
        return f"""SELECT '{name}' AS panel, labels, {tick}, round(CAST(sum(v) AS DOUBLE), 6) AS value FROM (
          SELECT {some} AS labels, {full} AS series, k, arg_max({value}, ts) AS v FROM s WHERE {rows} GROUP BY 1, 2, 3) GROUP BY 2, k"""

    def windowed(m):
        span = args["seconds"] // 60 - 1
        return f"""(SELECT labels, k, sum(g) OVER (PARTITION BY labels ORDER BY k RANGE BETWEEN {span} PRECEDING AND CURRENT ROW) AS n FROM {_sql_growth(m, by)})"""

    if kind == "share":
        return f"""SELECT '{name}' AS panel, '' AS labels, {tick}, round(x / nullif(x + y, 0), 6) AS value FROM (
          SELECT k, coalesce(CAST(a.n AS DOUBLE), 0) / 300 AS x, coalesce(CAST(b.n AS DOUBLE), 0) / 300 AS y
          FROM {windowed(metric)} a FULL JOIN {windowed(args['other'])} b USING (k))"""
    over = f" / {args['seconds']}" if kind == "rate" else ""
    return f"SELECT '{name}' AS panel, labels, {tick}, round(CAST(n AS DOUBLE){over}, 6) AS value FROM {windowed(metric)}"


query(
    "panels", a.with_ctes(_S) + " UNION ALL ".join(_sql_panel(name) for name in alerts.PANELS)
)(lambda spark, d: plain(alerts.panels(pipeline_samples(spark, d)).withColumn("value", F.round("value", 6))))


def _sql_total(metric, minutes) -> str:
    return f"""(SELECT gr.k, CAST(sum(coalesce(c.g, 0)) OVER (ORDER BY gr.k ROWS BETWEEN {minutes - 1} PRECEDING AND CURRENT ROW) AS DOUBLE) / {minutes * 60} AS r
      FROM grid gr LEFT JOIN {_sql_growth(metric, [])} c ON c.k = gr.k)"""


def _sql_series_gauge(metric) -> str:
    rows, labels, value = _GAUGES[metric]
    return f"(SELECT {_sql_labels(labels, labels)} AS labels, k, arg_max({value}, ts) AS v FROM s WHERE {rows} GROUP BY 1, 2)"


_RULE_EVALS = f"""{_S},
grid AS (SELECT unnest(generate_series((SELECT min(k) FROM s), (SELECT max(k) FROM s))) AS k),
evals AS (
  SELECT 'CDCConsumerDown' AS rule, labels, k, v = 0 AS met, 60 AS secs FROM {_sql_series_gauge('up')}
  UNION ALL SELECT 'CDCHighFailureRate', '', k, coalesce(f.r / nullif(e.r, 0) > 0.05, false), 300
    FROM {_sql_total('cdc_consumer_events_failed_total', 5)} f JOIN {_sql_total('cdc_consumer_events_total', 5)} e USING (k)
  UNION ALL SELECT 'CDCNoEventsProcessed', '', k, r = 0, 600 FROM {_sql_total('cdc_consumer_events_total', 10)}
  UNION ALL SELECT 'CDCHighProcessingLatency', '', k, coalesce(p > 1.0, false), 300
    FROM {_sql_quantile('cdc_consumer_processing_duration_seconds', 0.99, grid='grid')}
  UNION ALL SELECT 'CDCPostgresConnectionErrors', labels, k,
    sum(g) OVER (PARTITION BY labels ORDER BY k RANGE BETWEEN 4 PRECEDING AND CURRENT ROW) > 5, 120
    FROM {_sql_growth('cdc_postgres_connection_errors_total', None)}
  UNION ALL SELECT 'CDCPostgresSlowWrites', '', k, coalesce(p > 0.5, false), 300
    FROM {_sql_quantile('cdc_postgres_write_duration_seconds', 0.95, grid='grid')}
  UNION ALL SELECT 'CDCMinIOBufferBacklog', '', gr.k, coalesce(b.v > 1000, false), 300 FROM grid gr LEFT JOIN (
    SELECT k, sum(v) AS v FROM {_sql_series_gauge('cdc_minio_buffer_size')} GROUP BY 1) b ON b.k = gr.k
  UNION ALL SELECT 'CDCMinIOSlowWrites', '', k, coalesce(p > 5.0, false), 300
    FROM {_sql_quantile('cdc_minio_write_duration_seconds', 0.95, grid='grid')}
  UNION ALL SELECT 'CDCHighDuplicateRate', '', k, coalesce(h.r / nullif(h.r + m.r, 0) > 0.1, false), 600
    FROM {_sql_total('cdc_dedup_cache_hits_total', 5)} h JOIN {_sql_total('cdc_dedup_cache_misses_total', 5)} m USING (k)
  UNION ALL SELECT 'CDCDedupCacheNearCapacity', labels, k, v / CAST(100000 AS DOUBLE) > 0.9, 300 FROM {_sql_series_gauge('cdc_dedup_cache_size')})"""

query(
    "metric_rules_by_series",
    a.with_ctes(_RULE_EVALS)
    + "SELECT rule, labels, count(*) AS ticks, count(*) FILTER (met) AS met, CAST(make_timestamp(min(k) FILTER (met) * 60000000) AS VARCHAR) AS first_met FROM evals GROUP BY 1, 2",
)(
    lambda spark, d: plain(
        _by_series(spark, d).groupBy("rule", "labels").agg(
            F.count(F.lit(1)).alias("ticks"), F.count(F.when(F.col("met"), 1)).alias("met"),
            F.min(F.when(F.col("met"), F.col("ts"))).alias("first_met"),
        )
    )
)


def _by_series(spark, d):
    """Evaluations of the ten rules; rules per series also report the label set."""
    inputs = alerts.metric_rule_inputs(pipeline_samples(spark, d))
    return alerts.evaluate_rules(inputs, alerts.metric_rules())


query(
    "metric_alerts_by_series",
    a.with_ctes(_RULE_EVALS)
    + """, marked AS (SELECT *, NOT coalesce(lag(met) OVER w, false) AND met AS begins FROM evals WINDOW w AS (PARTITION BY rule, labels ORDER BY k)),
      runs AS (SELECT *, sum(begins::INT) OVER (PARTITION BY rule, labels ORDER BY k) AS run FROM marked),
      spans AS (SELECT rule, labels, run, any_value(secs) AS secs, min(k) FILTER (met) AS a, max(k) FILTER (met) AS z, min(k) FILTER (NOT met) AS stop
        FROM runs WHERE run > 0 GROUP BY 1, 2, 3),
      fired AS (SELECT s.*, (SELECT min(r.k) FROM runs r WHERE r.rule = s.rule AND r.labels = s.labels AND r.run = s.run AND r.met
        AND (r.k - s.a) * 60 >= s.secs) AS f FROM spans s WHERE (z - a) * 60 >= secs)
      SELECT rule, labels, CAST(make_timestamp(a * 60000000) AS VARCHAR) AS started_at, CAST(make_timestamp(f * 60000000) AS VARCHAR) AS fired_at,
        CAST(make_timestamp(stop * 60000000) AS VARCHAR) AS resolved_at FROM fired""",
)(
    lambda spark, d: plain(
        alerts.alert_states(_by_series(spark, d), alerts.metric_rules()).select("rule", "labels", "started_at", "fired_at", "resolved_at")
    )
)
