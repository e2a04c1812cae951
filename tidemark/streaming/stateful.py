"""State on live streams: transactions (a stream join), alerts and region health (state machines)."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.ordered import consecutive_runs, last_known_in_series, run_starts, time_slice
from tidemark.session import discard, remove_folder, written


def live_transactions(log: DataFrame, ts: str = "ts", hold: str = "1 day") -> DataFrame:
    """Changes of committed transactions from a stream of type, xid, lsn, event_id and a time.

    Changes wait in the join state until the COMMIT of their transaction arrives,
    in either order; those of a transaction open for longer than ``hold`` of event
    time are dropped. Rows stay rows, so a large transaction is never one object.
    """
    timed = log.withWatermark(ts, hold)
    changes = timed.where(F.col("type").isin("INSERT", "UPDATE", "DELETE")).alias("c")
    commits = timed.where("type = 'COMMIT'").select("xid", "lsn", ts).alias("e")
    limit = F.expr(f"INTERVAL {hold}")
    in_time = (F.col(f"e.{ts}") >= F.col(f"c.{ts}") - limit) & (F.col(f"e.{ts}") <= F.col(f"c.{ts}") + limit)
    return changes.join(commits, (F.col("c.xid") == F.col("e.xid")) & in_time).select(
        "c.xid", "c.event_id", "c.type", "c.lsn", F.col("e.lsn").alias("commit_lsn")
    )


def _carried(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    """What the batch before left behind; nothing before the first one."""
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/state/batch={batch_id - 1}")


def _keep(path: str, batch_id: int, found: DataFrame, state: DataFrame) -> None:
    """Write a batch's rows and its state; a repeated batch overwrites both and starts from the same state."""
    found.write.mode("overwrite").parquet(f"{path}/found/batch={batch_id}")
    state.write.mode("overwrite").parquet(f"{path}/state/batch={batch_id}")
    if batch_id > 1:
        remove_folder(state.sparkSession, f"{path}/state/batch={batch_id - 2}")


def machine_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows that a state machine's sink has found."""
    return spark.read.parquet(f"{path}/found").drop("batch")


def alert_sink(
    path: str, for_seconds: Mapping[str, int], slice_seconds: int = 86400
) -> Callable[[DataFrame, int], None]:
    """Batch function: firing and resolving of rules from evaluations (rule, ts, met, perhaps labels) in tick order.

    The machine of an alert is a map from the run that is open before some ticks to the one open
    after them. The ticks of a batch are cut into slices of time, each is reduced by itself, and only
    one row per slice meets the others; so a busy rule is spread over many tasks. Between batches an
    open run travels as its first and its last true tick.
    """
    due = F.create_map(*[x for rule, s in for_seconds.items() for x in (F.lit(rule), F.lit(s * 1_000_000))])[F.col("rule")]

    def advance(batch: DataFrame, batch_id: int) -> None:
        keys = [c for c in ("rule", "labels") if c in batch.columns]
        schema = ", ".join(f"`{c}` {batch.schema[c].dataType.simpleString()}" for c in keys) + ", started_at timestamp, seen timestamp"
        before = _carried(batch.sparkSession, path, batch_id, schema)
        edges = before.select(*keys, F.explode(F.array_distinct(F.array("started_at", "seen"))).alias("ts"), F.lit(True).alias("met"))
        ticks = written(
            batch.select(*keys, "ts", F.coalesce("met", F.lit(False)).alias("met")).unionByName(edges), "alert-ticks"
        )
        runs = run_starts(ticks, keys, ["ts"], "met", time_slice(F.col("ts"), slice_seconds)).where("met OR was")
        waited = F.unix_micros("ts") - F.unix_micros("run_start")
        moved = runs.groupBy(*keys, F.col("run_start").alias("started_at")).agg(
            F.min(F.when(F.col("met") & (waited >= due), F.col("ts"))).alias("firing"),
            F.min(F.when(~F.col("met"), F.col("ts"))).alias("resolved"),
            F.max(F.when(F.col("met"), F.col("ts"))).alias("last"),
        )
        known = written(moved.join(before, [*keys, "started_at"], "left"), "alert-runs")
        # A run that had fired by the last tick seen before has been told already.
        fired = known.where("firing IS NOT NULL AND (seen IS NULL OR firing > seen)")
        ended = known.where("firing IS NOT NULL AND resolved IS NOT NULL")
        found = fired.select(*keys, "started_at", F.lit("firing").alias("state"), F.col("firing").alias("at")).unionByName(
            ended.select(*keys, "started_at", F.lit("resolved").alias("state"), F.col("resolved").alias("at"))
        )
        _keep(path, batch_id, found, known.where("resolved IS NULL").select(*keys, "started_at", F.col("last").alias("seen")))
        discard(ticks, known)

    return advance


def region_health_sink(
    path: str, fail_n: int = 3, ok_n: int = 2, slice_seconds: int = 86400
) -> Callable[[DataFrame, int], None]:
    """Batch function: status after every check from (region, check_id, ts, passed) in time order.

    Runs are counted inside slices of time and put together from one row per slice. Between
    batches a region travels as one row: the last outcome, how long it has lasted, and the status.
    """
    schema = "region string, passed boolean, run_length bigint, status string"
    order = ["ts", "check_id"]

    def advance(batch: DataFrame, batch_id: int) -> None:
        before = _carried(batch.sparkSession, path, batch_id, schema)
        slice_by = time_slice(F.col("ts"), slice_seconds)
        checks = written(
            batch.select("region", F.col("check_id").cast("bigint").alias("check_id"), "ts", F.coalesce("passed", F.lit(False)).alias("passed")),
            "checks",
        )
        runs = consecutive_runs(checks, ["region"], order, "passed", slice_by).join(
            before.select("region", *[F.col(c).alias(f"old_{c}") for c in ("passed", "run_length", "status")]), "region", "left"
        )
        goes_on = (F.col("run_length") == F.col("seen")) & (F.col("passed") == F.col("old_passed"))
        length = F.col("run_length") + F.when(goes_on, F.col("old_run_length")).otherwise(0)
        own = (
            F.when(~F.col("passed") & (F.col("length") >= fail_n), "unhealthy")
            .when(~F.col("passed"), "degraded")
            .when(F.col("length") >= ok_n, "healthy")
        )
        judged = written(
            runs.withColumn("length", length).select("region", *order, "passed", "length", "old_status", own.alias("own")), "region-runs"
        )
        known = last_known_in_series(judged, ["region"], order, {"earlier": F.col("own")}, slice_by)
        status = F.coalesce("own", "earlier", "old_status", F.lit("unknown"))
        found = written(known.select("region", *order, "passed", F.col("length").alias("run_length"), status.alias("status")), "region-status")
        last = found.groupBy("region").agg(
            F.max_by(F.struct("passed", "run_length", "status"), F.struct(*order)).alias("last")
        ).select("region", "last.*")
        quiet = before.join(last.select("region"), "region", "left_anti")
        _keep(path, batch_id, found.select("region", "check_id", "status"), last.unionByName(quiet))
        discard(checks, judged, found)

    return advance
