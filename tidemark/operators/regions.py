"""Multi-region operators: fan-out, conflicts, lag, routing, health.

Regions are configuration (a handful of them), so they enter plans as literal
arrays and routing is an expression per event: no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ordered import consecutive_runs, last_known_in_series, number_rows, time_slice
from tidemark.functions.rows import attach_one_row
from tidemark.session import written

ACTIVE, DEGRADED = "active", "degraded"

# Fixed value: mean radius of the earth in kilometres.
EARTH_KM = 6371


@dataclass(frozen=True)
class Region:
    name: str
    latitude: float = 0.0
    longitude: float = 0.0
    priority: int = 50
    is_primary: bool = False
    status: str = ACTIVE
    replication_targets: tuple[str, ...] = ()
    weight: int | None = None

    @property
    def share(self) -> int:
        """Routing weight, 100 minus priority unless set, between 0 and 100."""
        chosen = 100 - self.priority if self.weight is None else self.weight
        return max(0, min(100, chosen))


# Coordinates of the known regions.
KNOWN_REGIONS = (
    Region("us-east-1", 37.4316, -78.6569, 10, True),
    Region("us-west-2", 45.8399, -119.7006, 20),
    Region("eu-west-1", 53.3331, -6.2489, 30),
    Region("eu-central-1", 50.1109, 8.6821, 40),
    Region("ap-south-1", 19.0760, 72.8777, 50),
    Region("ap-northeast-1", 35.6762, 139.6503, 60),
    Region("ap-southeast-1", 1.3521, 103.8198, 70),
)


def healthy(regions: Sequence[Region]) -> list[Region]:
    """Active regions in configured order."""
    found = [r for r in regions if r.status == ACTIVE]
    if not found:
        raise ValueError("no healthy regions available")
    return found


def _names(regions: Sequence[Region]) -> Column:
    return F.array(*[F.lit(r.name) for r in regions])


# ---- replication --------------------------------------------------------------------


def replication_fanout(events: DataFrame, regions: Sequence[Region], source: str = "source_region") -> DataFrame:
    """One row per active target: the event's ``target_regions``, else the configured ones."""
    configured = F.lit(None).cast("array<string>")
    for r in regions:
        targets = F.array(*[F.lit(t) for t in r.replication_targets]).cast("array<string>")
        configured = F.when(F.col(source) == r.name, targets).otherwise(configured)
    wanted = F.coalesce("target_regions", configured) if "target_regions" in events.columns else configured
    live = _names([r for r in regions if r.status == ACTIVE])
    return events.withColumn(
        "target_region", F.explode(F.filter(wanted, lambda t: F.array_contains(live, t)))
    )


def replication_status(events: DataFrame, results: DataFrame) -> DataFrame:
    """Outcome per event: completed when any target took it or none was tried.

    ``partial`` tells some but not all targets apart; ``acknowledged`` is what
    semi-synchronous writing waits for, ``all_acknowledged`` synchronous.
    """
    tried = results.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("targets"), F.count(F.when(F.col("success"), 1)).alias("succeeded")
    )
    targets, good = F.coalesce("targets", F.lit(0)), F.coalesce("succeeded", F.lit(0))
    return events.select("event_id").join(tried, "event_id", "left").select(
        "event_id",
        targets.alias("targets"),
        good.alias("succeeded"),
        F.when((targets == 0) | (good > 0), "completed").otherwise("failed").alias("status"),
        ((good > 0) & (good < targets)).alias("partial"),
        (good > 0).alias("acknowledged"),
        (good == targets).alias("all_acknowledged"),
    )


def replicated_counts(results: DataFrame) -> DataFrame:
    """Successes and failures per target region."""
    return results.groupBy("target_region").agg(
        F.count(F.when(F.col("success"), 1)).alias("replicated"),
        F.count(F.when(~F.col("success"), 1)).alias("failed"),
    )


STRATEGIES = ("last_write", "first_write", "source_wins", "merge", "manual")


def resolve_conflicts(
    local: DataFrame, remote: DataFrame, key: str, strategy: str, ts: str = "updated_at"
) -> DataFrame:
    """Rows of both sides as one, by the strategy; ``winner`` tells which side gave the row.

    last_write takes remote only when strictly newer; first_write keeps local only
    when strictly older; merge fills missing (null) columns and lets the newer
    remote overwrite. ``manual`` returns the rows that need a decision, both
    versions side by side. Rows of one side only pass through.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy}")
    columns = [c for c in local.columns if c != key]

    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, F.struct(*columns).alias(name))

    both = packed(local, "_l").join(packed(remote, "_r"), key, "full_outer")
    ours, theirs = F.col("_l"), F.col("_r")
    if strategy == "manual":
        return both.where(ours.isNotNull() & theirs.isNotNull() & (ours != theirs)).select(
            key, ours.alias("local"), theirs.alias("remote")
        )
    newer = theirs[ts] > ours[ts]
    takes_remote = {
        "last_write": newer,
        "first_write": ~(ours[ts] < theirs[ts]),
        "source_wins": F.lit(False),
        "merge": newer,
    }[strategy]
    takes_remote = F.when(ours.isNull(), True).when(theirs.isNull(), False).otherwise(
        F.coalesce(takes_remote, F.lit(False))
    )

    def value(c: str) -> Column:
        if strategy == "merge":
            return F.when(takes_remote, F.coalesce(theirs[c], ours[c])).otherwise(
                F.coalesce(ours[c], theirs[c])
            )
        return F.when(takes_remote, theirs[c]).otherwise(ours[c])

    return both.select(
        key,
        *[value(c).alias(c) for c in columns],
        F.when(takes_remote, "remote").otherwise("local").alias("winner"),
    )


def replication_lag(
    source_log: DataFrame, target_log: DataFrame, caught_up_ms: float = 1000.0, alert_ms: float = 5000.0
) -> DataFrame:
    """Distance of every (source, target) pair: milliseconds, events, last offsets.

    ``source_log`` has source_region, offset, ts; ``target_log`` also target_region.
    """
    head = source_log.groupBy("source_region").agg(
        F.max("offset").alias("last_source_offset"), F.max("ts").alias("_head_ts")
    )
    tail = target_log.groupBy("source_region", "target_region").agg(
        F.max("offset").alias("last_replicated_offset"), F.max("ts").alias("_tail_ts")
    )
    lag_ms = (F.unix_micros("_head_ts") - F.unix_micros("_tail_ts")) / F.lit(1000.0)
    return tail.join(head, "source_region").select(
        "source_region",
        "target_region",
        lag_ms.alias("lag_ms"),
        (F.col("last_source_offset") - F.col("last_replicated_offset")).alias("lag_events"),
        "last_replicated_offset",
        "last_source_offset",
        (lag_ms < caught_up_ms).alias("caught_up"),
        (lag_ms > alert_ms).alias("alert"),
    )


# ---- routing ------------------------------------------------------------------------


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    half = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(EARTH_KM) * 2 * F.atan2(F.sqrt(half), F.sqrt(1 - half))


def _ranked(costs: Sequence[tuple[int, Region, Column]]) -> Column:
    """Regions by cost, ties in configured order; unknown cost last."""
    return F.array_sort(
        F.array(
            *[
                F.struct(
                    F.coalesce(cost, F.lit(float("inf"))).alias("cost"),
                    F.lit(i).alias("nth"),
                    F.lit(r.name).alias("name"),
                )
                for i, r, cost in costs
            ]
        )
    )


def _with_choice(events: DataFrame, ranked: Column, cost_name: str) -> DataFrame:
    held = events.withColumn("_ranked", ranked)
    best = F.element_at("_ranked", 1)
    names = F.transform("_ranked", lambda r: r["name"])
    return held.select(
        *events.columns,
        best["name"].alias("region"),
        best["cost"].alias(cost_name),
        F.slice(names, 2, F.greatest(F.size(names) - 1, F.lit(0))).alias("alternatives"),
    )


def route_geographic(
    events: DataFrame, regions: Sequence[Region], latitude: str = "latitude", longitude: str = "longitude"
) -> DataFrame:
    """Nearest region, alternatives by distance."""
    costs = [
        (i, r, haversine_km(F.col(latitude), F.col(longitude), F.lit(r.latitude), F.lit(r.longitude)))
        for i, r in enumerate(healthy(regions))
    ]
    return _with_choice(events, _ranked(costs), "distance_km")


def route_latency(events: DataFrame, regions: Sequence[Region], measured: DataFrame) -> DataFrame:
    """Region with the lowest latest latency; ``measured`` has region, ts, latency_ms."""
    live = healthy(regions)
    latest = measured.where(F.col("region").isin(*[r.name for r in live])).agg(
        *[
            F.max_by("latency_ms", F.when(F.col("region") == r.name, F.col("ts"))).alias(f"_ms{i}")
            for i, r in enumerate(live)
        ]
    )
    held = attach_one_row(events, latest)
    costs = [(i, r, F.col(f"_ms{i}").cast("double")) for i, r in enumerate(live)]
    return _with_choice(held, _ranked(costs), "latency_ms").drop(*latest.columns)


def route_round_robin(
    events: DataFrame, regions: Sequence[Region], order: Sequence[Column]
) -> DataFrame:
    """The i-th event in ``order`` goes to the i-th healthy region, in turn."""
    live = healthy(regions)
    numbered = number_rows(events, order, "_nth")
    pick = F.pmod(F.col("_nth") - 1, F.lit(len(live))) + 1
    return numbered.withColumn("region", F.element_at(_names(live), pick.cast("int"))).drop("_nth")


def hash_draw(key: Column, n: int) -> Column:
    """A number below ``n`` fixed by the key: first 8 hex digits of its md5, modulo n."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % F.lit(n)


def route_weighted(events: DataFrame, regions: Sequence[Region], key: str) -> DataFrame:
    """Region with probability by weight; the draw is fixed by the key."""
    live = healthy(regions)
    total = sum(r.share for r in live)
    if total == 0:
        return events.withColumn(
            "region", F.element_at(_names(live), (hash_draw(F.col(key), len(live)) + 1).cast("int"))
        )
    draw = hash_draw(F.col(key), total)
    chosen: Column | None = None
    upto = 0
    for r in live:
        upto += r.share
        chosen = F.when(draw < upto, r.name) if chosen is None else chosen.when(draw < upto, r.name)
    return events.withColumn("region", chosen)


def route_affinity(
    events: DataFrame, regions: Sequence[Region], key: str, event_id: str = "event_id",
    overrides: DataFrame | None = None,
) -> DataFrame:
    """The same key always goes to the same region.

    ``overrides`` (key column, region) wins while its region is active; events
    without a key spread by their id.
    """
    live = healthy(regions)
    text = F.coalesce(F.nullif(F.col(key).cast("string"), F.lit("")), F.col(event_id).cast("string"))
    hashed = F.element_at(_names(live), (hash_draw(text, len(live)) + 1).cast("int"))
    if overrides is None:
        return events.withColumn("region", hashed)
    fixed = overrides.select(F.col(key), F.col("region").alias("_fixed"))
    pinned = F.when(F.col("_fixed").isin(*[r.name for r in live]), F.col("_fixed"))
    return (
        events.join(fixed, key, "left").withColumn("region", F.coalesce(pinned, hashed)).drop("_fixed")
    )


def route_failover(
    events: DataFrame, regions: Sequence[Region], failures: DataFrame, ts: str = "ts", retry_seconds: int = 60
) -> DataFrame:
    """Primary when usable, otherwise the replica with the smallest priority number.

    A region is unusable for ``retry_seconds`` after each of its failures
    (``failures`` has region, ts). Per interval of that length only the first and
    the last failure of a region matter, so the log shrinks to one row per
    interval before it meets the events. ``region`` is null when none is usable.
    """
    usable = [r for r in regions if r.status in (ACTIVE, DEGRADED)]
    ordered = sorted(usable, key=lambda r: (not r.is_primary, r.priority))
    names = [r.name for r in ordered]
    slot = time_slice(F.col(ts), retry_seconds)
    known = failures.where(F.col("region").isin(*names))
    at = F.unix_micros("ts")
    here = known.select("region", at.alias("_at"), time_slice(F.col("ts"), retry_seconds).alias("_slot"))
    spread = here.select(
        "region", "_at", F.inline(F.array(
            F.struct(F.col("_slot").alias("_slot"), F.lit(True).alias("_same")),
            F.struct((F.col("_slot") + 1).alias("_slot"), F.lit(False).alias("_same")),
        ))
    )
    per_slot = spread.groupBy("_slot").agg(
        *[
            agg
            for i, name in enumerate(names)
            for agg in (
                F.min(F.when((F.col("region") == name) & F.col("_same"), F.col("_at"))).alias(f"_first{i}"),
                F.max(F.when((F.col("region") == name) & ~F.col("_same"), F.col("_at"))).alias(f"_last{i}"),
            )
        ]
    )
    now = F.unix_micros(F.col(ts))
    joined = events.withColumn("_slot", slot).join(per_slot, "_slot", "left")
    chosen: Column = F.lit(None).cast("string")
    for i in reversed(range(len(names))):
        down = F.coalesce(F.col(f"_first{i}") <= now, F.lit(False)) | F.coalesce(
            now - F.col(f"_last{i}") < retry_seconds * 1_000_000, F.lit(False)
        )
        chosen = F.when(~down, names[i]).otherwise(chosen)
    return joined.withColumn("region", chosen).select(*events.columns, "region")


# ---- health -------------------------------------------------------------------------


def region_health(
    checks: DataFrame, fail_n: int = 3, ok_n: int = 2, order: Sequence[str] = ("ts",), slice_seconds: int = 86400
) -> DataFrame:
    """Status of a region after each of its checks, with running success and error rate.

    ``fail_n`` failures in a row make it unhealthy, fewer degraded; ``ok_n``
    successes in a row make it healthy, fewer leave the status as it was.
    """
    slice_by = time_slice(F.col(order[0]), slice_seconds)
    runs = consecutive_runs(checks, ["region"], order, "passed", slice_by)
    own = (
        F.when(~F.col("passed") & (F.col("run_length") >= fail_n), "unhealthy")
        .when(~F.col("passed"), "degraded")
        .when(F.col("run_length") >= ok_n, "healthy")
    )
    rate = F.col("seen_true") / F.col("seen")
    judged = runs.withColumn("_own", own).withColumn(
        "_error", F.when(F.col("_own") == "healthy", F.lit(0.0)).when(~F.col("passed"), 1.0 - rate)
    )
    known = last_known_in_series(
        written(judged, "region-runs"),
        ["region"],
        order,
        {"_before": F.col("_own"), "_error_before": F.col("_error")},
        slice_by,
    )
    return known.select(
        *checks.columns,
        F.coalesce("_own", "_before", F.lit("unknown")).alias("status"),
        "run_length",
        rate.alias("success_rate"),
        F.coalesce("_error", "_error_before", F.lit(0.0)).alias("error_rate"),
    )


# Order of badness.
_SEVERITY = {"healthy": 0, "degraded": 1, "unhealthy": 2}


def component_health(checks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Worst status among critical checks; others do not count."""
    rank = F.lit(None).cast("int")
    for name, value in _SEVERITY.items():
        rank = F.when(F.col("status") == name, value).otherwise(rank)
    worst = checks.groupBy(*by).agg(
        F.coalesce(F.max(F.when(F.col("critical"), rank)), F.lit(0)).alias("_worst")
    )
    labels = F.array(*[F.lit(n) for n in _SEVERITY])
    status = F.element_at(labels, F.col("_worst") + 1)
    return worst.select(*by, status.alias("status"), (F.col("_worst") == 0).alias("healthy"))
