"""Streaming queries, run to the end over files and checked like batch results."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.operators import changes, dedup, fanout, replica, silver
from tidemark.plans import adapters as a
from tidemark.plans import change_log as cl
from tidemark.plans import metric_queries as mq
from tidemark.plans import quality_queries as qq
from tidemark.plans import region_queries as rq
from tidemark.plans.change_queries import _FOLD, _FOLD_COLUMNS, _TRANSACTIONS, _decoded_log
from tidemark.plans.registry import plain, query
from tidemark.plans.shop_queries import STG_ORDERS
from tidemark.session import discard, scratch_path, written
from tidemark.sources.events import parse_events, stream_events, valid_events
from tidemark.streaming import health, ingest, late, stateful, windows


class _Arrivals:
    """A table that arrives in waves, each a run of the stream from its checkpoint.

    ``wave`` is a column of small numbers, or ``order`` is cut into three parts. The rows of a wave are
    written by as many tasks as they have partitions, and a run takes all of them as one micro-batch.
    """

    def __init__(self, spark, df, label, order=None, wave=None):
        if wave is None:
            cuts = df.agg(F.percentile_approx(order, [1 / 3, 2 / 3], 1000).alias("c")).first()["c"] or []
            wave = sum((F.when(F.col(order) > F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))
        self.rows = written(df.withColumn("_wave", wave.cast("int")), f"{label}-rows")
        self.path = scratch_path(spark, label)
        schema = self.rows.drop("_wave").schema
        spark.createDataFrame([], schema).write.parquet(self.path)
        self.stream = spark.readStream.schema(schema).parquet(self.path)
        self.waves = sorted(r["_wave"] for r in self.rows.select("_wave").distinct().collect())

    def run(self, each):
        """Let the waves arrive one after the other; ``each()`` runs the stream to its end."""
        for w in self.waves:
            self.rows.where(F.col("_wave") == w).drop("_wave").write.mode("append").parquet(self.path)
            if w == self.waves[-1]:
                discard(self.rows)
            each()


def _collected(spark, arrivals, live, label, keys=None):
    """Run a stream to its end; with keys the newest row of each, otherwise all rows."""
    out, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")
    mode = "update" if keys else "append"
    result = live(arrivals.stream)
    arrivals.run(lambda: ingest.run_to_end(result, ingest.batch_folder(out), checkpoint, mode))
    return ingest.newest_rows(spark, out, keys) if keys else spark.read.parquet(out).drop("batch")


def _raw_stream(spark, d):
    return stream_events(spark, cl.stored_log(spark, d), max_files_per_trigger=4)


# Waves of messages: by event time, but some orders' changes and every second copy come in the last one.
_WAVE_SQL = """CASE WHEN (tbl = 'orders' AND id % 7 = 3) OR (off % 2 = 1 AND id % 2 = 0) THEN 2
  WHEN ts < TIMESTAMP '1997-01-01' THEN 0 WHEN ts < TIMESTAMP '1999-01-01' THEN 1 ELSE 2 END"""
_DELAY = "30 days 1 second"
_LATE = f"""waved AS (SELECT *, {_WAVE_SQL} AS wave FROM good),
  marks AS (SELECT w.wave, max(e.ts) - INTERVAL 30 DAY - INTERVAL 1 SECOND AS mark FROM (VALUES (1), (2)) w(wave) JOIN waved e ON e.wave < w.wave GROUP BY 1),
  timed AS (SELECT e.*, coalesce(e.ts < m.mark, false) AS late FROM waved e LEFT JOIN marks m USING (wave))"""


def _waves(spark, d):
    """Valid parsed messages in waves, as the log's raw messages."""
    parsed = parse_events(cl.raw_events(spark, d)).where("deser_error IS NULL AND schema_error IS NULL")
    number = F.expr("offset div 8 * 3 + partition")
    late = ((F.col("source.table") == "orders") & (number % 7 == 3)) | ((F.col("offset") % 2 == 1) & (number % 2 == 0))
    ts = F.col("event_timestamp")
    wave = (
        F.when(late, 2).when(ts < F.lit("1997-01-01").cast("timestamp"), 0)
        .when(ts < F.lit("1999-01-01").cast("timestamp"), 1).otherwise(2)
    )
    raw = parsed.select(F.col("raw_value").alias("value"), "topic", "partition", "offset", wave.alias("w"))
    return _Arrivals(spark, raw, "messages", wave=F.col("w"))


query("stream_dedup", a.with_ctes(*cl.LOG_CTES, _LATE) + "SELECT DISTINCT event_id FROM timed WHERE NOT late")(
    lambda spark, d: _collected(
        spark, _waves(spark, d),
        lambda raw: dedup.dedup_stream(valid_events(parse_events(raw.drop("w"))), delay=_DELAY).select("event_id"),
        "stream-dedup",
    )
)


def _stream_late(spark, d):
    """Late order changes are set aside, then each is applied to the replica or listed as superseded."""
    arrivals = _waves(spark, d)
    events = valid_events(parse_events(arrivals.stream.drop("w"))).where(F.col("source.table") == "orders")
    path, aside, marks = (scratch_path(spark, x) for x in ("replica", "late", "marks"))
    checkpoint = scratch_path(spark, "late-checkpoint")
    replica.create_replica(spark, path, cl.ORDER_SCHEMA)
    sink = late.split_late(ingest.replica_sink(path, cl.ORDER_SCHEMA), aside, marks, _DELAY)
    arrivals.run(lambda: ingest.run_to_end(events, sink, checkpoint))
    unique = dedup.dedup_events(late.late_events(spark, aside, events.schema))
    outcomes = late.repair(spark, path, unique, 1_000_000, cl.ORDER_SCHEMA, scratch_path(spark, "late-listing"))
    state = replica.read_replica(spark, path, cl.ORDER_SCHEMA).select(F.col("id").cast("string").alias("key"), "status")
    return plain(outcomes.join(state, "key", "left").select("event_id", "key", "outcome", "status"))


query(
    "stream_late",
    a.with_ctes(*cl.LOG_CTES, _LATE.replace("FROM good", "FROM good WHERE tbl = 'orders'"))
    + """, reached AS (SELECT id, max(lsn_num) AS top FROM timed WHERE NOT late GROUP BY 1),
      lates AS (SELECT DISTINCT t.event_id, t.id, t.lsn_num, t.operation, t.status,
        CASE WHEN r.top >= t.lsn_num THEN 'superseded' ELSE 'applied' END AS outcome
        FROM timed t LEFT JOIN reached r USING (id) WHERE late),
      used AS (SELECT id, lsn_num, operation, status FROM timed WHERE NOT late
        UNION SELECT id, lsn_num, operation, status FROM lates WHERE outcome = 'applied'),
      newest AS (SELECT id, arg_max(operation, lsn_num) AS op, arg_max(status, lsn_num) AS status FROM used GROUP BY 1)
      SELECT event_id, CAST(l.id AS VARCHAR) AS "key", outcome, CASE WHEN n.op <> 'DELETE' THEN n.status END AS status
      FROM lates l LEFT JOIN newest n USING (id)""",
)(_stream_late)


def _stream_resume(spark, d):
    """A run that dies after writing its second batch, resumed from its checkpoint."""
    arrivals = _waves(spark, d)
    out, book, checkpoint = (scratch_path(spark, x) for x in ("resumed", "ledger", "resume-checkpoint"))
    folder, crashes = ingest.batch_folder(out), [1]

    def fragile(batch, batch_id):
        folder(batch, batch_id)
        if batch_id in crashes:
            crashes.remove(batch_id)
            raise RuntimeError("stopped before the batch was committed")

    events = valid_events(parse_events(arrivals.stream.drop("w")))

    def run():
        try:
            ingest.run_to_end(events, ingest.ledgered(fragile, book), checkpoint)
        except StreamingQueryException:
            ingest.run_to_end(events, ingest.ledgered(fragile, book), checkpoint)

    arrivals.run(run)
    kept = spark.read.parquet(out).groupBy("batch").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("topic", "partition", "offset").alias("messages")
    )
    return ingest.ledger(spark, book).join(kept, "batch").select("batch", "rows", "attempts", "events", "messages")


query(
    "stream_resume",
    a.with_ctes(*cl.LOG_CTES, _LATE)
    + """SELECT CAST(wave AS BIGINT) AS batch, count(*) AS "rows", CASE WHEN wave = 1 THEN 2 ELSE 1 END::BIGINT AS attempts,
      count(*) AS events, count(*) AS messages FROM waved GROUP BY wave""",
)(_stream_resume)

_FLUSH = 700


def _stream_flush(spark, d):
    """Events wait until their table has enough of them or they are too old; a batch comes every ten minutes."""
    arrivals = _waves(spark, d)
    path, checkpoint = scratch_path(spark, "flushing"), scratch_path(spark, "flush-checkpoint")
    events = valid_events(parse_events(arrivals.stream.drop("w")))
    sink = ingest.flushing_sink(
        path, _FLUSH, 1000.0, lambda batch_id: 600.0 * batch_id, lambda rows, folder: rows.write.mode("overwrite").parquet(folder)
    )
    arrivals.run(lambda: ingest.run_to_end(events, sink, checkpoint))
    stored = spark.read.parquet(f"{path}/archive").groupBy(
        F.col("source.table").alias("table"), F.col("flush").cast("bigint").alias("batch")
    ).agg(F.count(F.lit(1)).alias("archived"))
    return ingest.flushes(spark, path).join(stored, ["table", "batch"], "left")


query(
    "stream_flush",
    a.with_ctes(*cl.LOG_CTES, _LATE)
    + f""", n AS (SELECT tbl, count(*) FILTER (wave = 0) AS n0, count(*) FILTER (wave = 1) AS n1, count(*) FILTER (wave = 2) AS n2 FROM waved GROUP BY 1),
      p AS (SELECT *, n0 >= {_FLUSH} AS f0, CASE WHEN n0 >= {_FLUSH} THEN 0 ELSE n0 END + n1 AS p1 FROM n),
      q AS (SELECT *, p1 >= {_FLUSH} AS f1, CASE WHEN p1 >= {_FLUSH} THEN 0 ELSE p1 END + n2 AS p2 FROM p),
      r(tbl, batch, cause, n) AS (
        SELECT tbl, 0, 'size', n0 FROM q WHERE f0
        UNION ALL SELECT tbl, 1, 'size', p1 FROM q WHERE f1
        UNION ALL SELECT tbl, 2, CASE WHEN p2 >= {_FLUSH} THEN 'size' ELSE 'age' END, p2 FROM q
          WHERE p2 >= {_FLUSH} OR (NOT f0 AND NOT f1 AND n0 > 0 AND p2 > 0))
      SELECT tbl AS "table", CAST(batch AS BIGINT) AS batch, cause, n AS "rows", n AS archived FROM r""",
)(_stream_flush)

query(
    "stream_tumbling",
    """SELECT CAST(CAST(date_trunc('day', ts) AS TIMESTAMP) AS VARCHAR) AS window_start, event_type, count(*) AS events
      FROM events GROUP BY 1, 2""",
)(
    lambda spark, d: plain(
        _collected(
            spark,
            _Arrivals(spark, mq.events(spark, d), "events", "ts"),
            lambda rows: windows.tumbling_counts(rows, "ts", "1 day", ["event_type"]),
            "stream-tumbling",
            ["window_start", "event_type"],
        )
    )
)

query(
    "stream_sliding",
    """SELECT CAST(make_timestamp((epoch_us(ts) // 21600000000 + k) * 21600000000) AS VARCHAR) AS window_end, count(*) AS events,
      count(*) / 86400.0::DOUBLE AS rate_per_second FROM events, (VALUES (1), (2), (3), (4)) v(k) GROUP BY 1""",
)(
    lambda spark, d: plain(
        _collected(
            spark,
            _Arrivals(spark, mq.events(spark, d), "events", "ts"),
            lambda rows: windows.sliding_rate(rows, "ts", 86400, 21600),
            "stream-sliding",
            ["window_end"],
        )
    )
)


def _stream_apply(spark, d):
    path = scratch_path(spark, "replica")
    replica.create_replica(spark, path, cl.ORDER_SCHEMA)
    events = valid_events(parse_events(_raw_stream(spark, d))).where(F.col("source.table") == "orders")
    ingest.run_to_end(
        events, ingest.replica_sink(path, cl.ORDER_SCHEMA), scratch_path(spark, "replica-checkpoint")
    )
    return plain(replica.read_replica(spark, path, cl.ORDER_SCHEMA))


query(
    "stream_apply", a.with_ctes(a.ORDERS, _FOLD) + f"SELECT {_FOLD_COLUMNS} FROM fold WHERE NOT deleted"
)(_stream_apply)


def _replica_batches(spark, d):
    """Two batches, the second one delivered twice."""
    path = scratch_path(spark, "replica")
    replica.create_replica(spark, path, cl.ORDER_SCHEMA)
    unique = written(dedup.dedup_events(cl.order_events(spark, d)), "unique-events")
    first, second = unique.where("operation = 'INSERT'"), unique.where("operation <> 'INSERT'")
    for batch_id, events in ((0, first), (1, second), (1, second)):
        replica.apply_batch(spark, path, events, batch_id, cl.ORDER_SCHEMA)
    return plain(replica.read_replica(spark, path, cl.ORDER_SCHEMA))


query(
    "replica_batches", a.with_ctes(a.ORDERS, _FOLD) + f"SELECT {_FOLD_COLUMNS} FROM fold WHERE NOT deleted"
)(_replica_batches)


def _stream_quality(spark, d):
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    ingest.run_to_end(_raw_stream(spark, d), ingest.quality_gate(good, bad), scratch_path(spark, "gate-checkpoint"))
    kept = spark.read.parquet(good).select(F.lit("accepted").alias("outcome"), "event_id")
    lost = spark.read.parquet(bad).select(F.col("failure_reason").alias("outcome"))
    return kept.select("outcome").unionByName(lost).groupBy("outcome").agg(F.count(F.lit(1)).alias("messages"))


query(
    "stream_quality",
    qq._RUN
    + """SELECT coalesce(reason, 'accepted') AS outcome,
      CASE WHEN reason IS NULL THEN count(DISTINCT sent_id) ELSE count(*) END AS messages FROM staged GROUP BY reason""",
)(_stream_quality)

def _fan_out(spark, d):
    """Order events to an archive, to a sink that fails once and to one that always fails."""
    events = cl.order_events(spark, d)
    folders = {name: scratch_path(spark, f"sink-{name}") for name in ("archive", "flaky", "dead")}
    tries = []

    def store(name):
        return lambda rows: rows.write.mode("overwrite").parquet(folders[name])

    def flaky(rows):
        tries.append(1)
        if len(tries) == 1:
            raise OSError("not yet")
        store("flaky")(rows)

    def broken(rows):
        raise OSError("no such table")

    done = fanout.route(
        events, {"archive": store("archive"), "flaky": flaky, "broken": broken}, store("dead"), max_retries=2, sleep=lambda _: None
    )
    said = spark.createDataFrame([(x.sink, x.ok, x.attempts) for x in done], "sink string, ok boolean, attempts bigint")
    kept = [
        spark.read.parquet(folders[name]).select(F.lit(sink).alias("sink"), event.alias("event_id"), error.alias("error"))
        for name, sink, event, error in (
            ("archive", "archive", F.col("event_id"), F.lit(None).cast("string")),
            ("flaky", "flaky", F.col("event_id"), F.lit(None).cast("string")),
            ("dead", "broken", F.get_json_object(F.col("original_value").cast("string"), "$.event_id"), F.col("error_message")),
        )
    ]
    return kept[0].unionByName(kept[1]).unionByName(kept[2]).join(said, "sink")


query(
    "fan_out",
    a.with_ctes(*cl.LOG_CTES)
    + """SELECT sink, ok, CAST(attempts AS BIGINT) AS attempts, event_id, error FROM good,
      (VALUES ('archive', true, 1, NULL), ('flaky', true, 2, NULL), ('broken', false, 2, 'broken write failed: no such table')) v(sink, ok, attempts, error)
      WHERE tbl = 'orders'""",
)(_fan_out)


def _stream_health(spark, d):
    """Progress samples of the deduplicating stream, summed per wave of messages."""
    arrivals, samples = _waves(spark, d), []
    out, checkpoint = scratch_path(spark, "health"), scratch_path(spark, "health-checkpoint")
    # The samples are all that is asked for, so no images travel to the state or to the sink.
    events = valid_events(parse_events(arrivals.stream.drop("w"))).select("event_id", "event_timestamp")
    live = dedup.dedup_stream(events, delay=_DELAY)

    def run():
        running = ingest.start(live, ingest.batch_folder(out), checkpoint, interval=None)
        running.awaitTermination()
        wave = len({w for w, *_ in samples})
        samples.extend((wave, name, value) for p in running.recentProgress for _, name, _, value in health.progress_rows(p))

    arrivals.run(run)
    rows = spark.createDataFrame(samples, "wave bigint, name string, value double")
    return rows.where("name IN ('stream_input_rows', 'stream_rows_too_late')").groupBy("wave", "name").agg(F.sum("value").alias("value"))


query(
    "stream_health",
    a.with_ctes(*cl.LOG_CTES, _LATE)
    + """SELECT CAST(wave AS BIGINT) AS wave, 'stream_input_rows' AS name, CAST(count(*) AS DOUBLE) AS value FROM timed GROUP BY wave
      UNION ALL SELECT CAST(wave AS BIGINT), 'stream_rows_too_late', CAST(count(*) FILTER (late) AS DOUBLE) FROM timed GROUP BY wave""",
)(_stream_health)

query(
    "stream_transactions",
    a.with_ctes(*cl.LOG_CTES, cl.UNIQUE, _TRANSACTIONS) + "SELECT xid, event_id, type, lsn, commit_lsn FROM tx",
)(
    lambda spark, d: _collected(
        spark,
        _Arrivals(spark, _decoded_log(spark, d).withColumn("ts", F.timestamp_seconds("xid")), "log", "xid"),
        stateful.live_transactions,
        "stream-transactions",
    )
)


def _machine(spark, arrivals, sink, label):
    """Rows that a state machine finds over all waves."""
    path, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")
    arrivals.run(lambda: ingest.run_to_end(arrivals.stream, sink(path), checkpoint))
    return stateful.machine_rows(spark, path)


def _stream_alerts(spark, d):
    evals, rules = mq._evals(spark, d)
    waits = {r.name: r.for_seconds for r in rules}
    return plain(
        _machine(spark, _Arrivals(spark, evals, "evals", "ts"), lambda path: stateful.alert_sink(path, waits), "stream-alerts")
    )


query(
    "stream_alerts",
    mq._ALERT
    + """SELECT rule, CAST(started_at AS VARCHAR) AS started_at, 'firing' AS state, CAST(fired_at AS VARCHAR) AS "at" FROM alerts
      UNION ALL SELECT rule, CAST(started_at AS VARCHAR), 'resolved', CAST(resolved_at AS VARCHAR) FROM alerts WHERE resolved_at IS NOT NULL""",
)(_stream_alerts)

query(
    "stream_region_health",
    rq._LOC
    + f""", {rq._CHECKS} SELECT region, event_id AS check_id, coalesce(last_value(own IGNORE NULLS) OVER w, 'unknown') AS status
      FROM own WINDOW w AS (PARTITION BY region ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)(
    lambda spark, d: _machine(
        spark,
        _Arrivals(spark, rq.checks(spark, d).withColumnRenamed("event_id", "check_id"), "checks", "ts"),
        stateful.region_health_sink,
        "stream-region-health",
    )
)

query(
    "stream_daily_revenue",
    a.with_ctes(a.ORDERS, STG_ORDERS)
    + """SELECT CAST(order_date AS VARCHAR) AS order_date, count(*) AS total_orders,
      count(*) FILTER (is_completed) AS completed_orders, CAST(sum(total_amount) AS DOUBLE) AS gross_revenue,
      CAST(sum(CASE WHEN is_completed THEN total_amount ELSE 0 END) AS DOUBLE) AS realized_revenue
      FROM stg_orders WHERE is_valid_record GROUP BY 1""",
)(
    lambda spark, d: plain(
        _collected(
            spark,
            _Arrivals(spark, a.orders(spark, d), "orders", "created_at"),
            lambda rows: windows.live_daily_revenue(silver.stg_orders(rows)),
            "stream-revenue",
            ["order_date"],
        )
    )
)
