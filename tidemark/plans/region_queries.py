"""Multi-region queries over events and orders."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tidemark.operators import regions as rg
from tidemark.plans import adapters as a
from tidemark.plans.metric_queries import events
from tidemark.plans.registry import plain, query

_TARGETS = {
    "us-east-1": ("us-west-2", "eu-west-1", "mars-1"),
    "us-west-2": ("us-east-1",),
    "eu-west-1": ("us-east-1", "eu-central-1", "ap-south-1"),
}
REGIONS = tuple(
    replace(
        r,
        replication_targets=_TARGETS.get(r.name, ()),
        status="offline" if r.name == "ap-south-1" else rg.ACTIVE,
    )
    for r in rg.KNOWN_REGIONS
)
_LIVE = [r.name for r in REGIONS if r.status == rg.ACTIVE]
_LIVE_SQL = "[" + ", ".join(f"'{n}'" for n in _LIVE) + "]"
_SOURCES = ("us-east-1", "us-west-2", "eu-west-1", "eu-central-1")


def located(spark, d):
    """Events with a source region and a client position."""
    return events(spark, d).withColumns(
        {
            "source_region": F.element_at(
                F.array(*[F.lit(s) for s in _SOURCES]), (F.col("user_id") % 4 + 1).cast("int")
            ),
            "latitude": (F.col("event_id") % 141 - 70).cast("double"),
            "longitude": (F.col("event_id") * 7 % 359 - 179).cast("double"),
        }
    )


_LOC = a.with_ctes(
    """ev AS (SELECT *, ['us-east-1', 'us-west-2', 'eu-west-1', 'eu-central-1'][user_id % 4 + 1] AS source_region,
  CAST(event_id % 141 - 70 AS DOUBLE) AS latitude, CAST(event_id * 7 % 359 - 179 AS DOUBLE) AS longitude FROM events)""",
    """fan AS (SELECT event_id, source_region, unnest(CASE source_region WHEN 'us-east-1' THEN ['us-west-2', 'eu-west-1']
  WHEN 'us-west-2' THEN ['us-east-1'] WHEN 'eu-west-1' THEN ['us-east-1', 'eu-central-1'] ELSE [] END) AS target_region FROM ev)""",
)

query("fanout", _LOC + "SELECT event_id, target_region FROM fan")(
    lambda spark, d: rg.replication_fanout(located(spark, d), REGIONS).select("event_id", "target_region")
)


def _results(spark, d):
    sent = rg.replication_fanout(located(spark, d), REGIONS)
    digit = F.when(F.col("target_region") == "eu-west-1", 3).otherwise(F.length("target_region"))
    return sent.select("event_id", "target_region", ((F.col("event_id") * digit) % 5 != 0).alias("success"))


_RESULTS = """SELECT event_id, target_region, (event_id * CASE WHEN target_region = 'eu-west-1' THEN 3 ELSE length(target_region) END) % 5 <> 0 AS success FROM fan"""

query(
    "replication_status",
    _LOC
    + f""", r AS ({_RESULTS}), t AS (SELECT event_id, count(*) AS targets, count(*) FILTER (success) AS good FROM r GROUP BY 1)
      SELECT e.event_id, coalesce(targets, 0) AS targets, coalesce(good, 0) AS succeeded,
        CASE WHEN targets IS NULL OR good > 0 THEN 'completed' ELSE 'failed' END AS status,
        coalesce(good > 0 AND good < targets, false) AS partial, coalesce(good > 0, false) AS acknowledged,
        coalesce(good = targets, true) AS all_acknowledged FROM ev e LEFT JOIN t USING (event_id)""",
)(lambda spark, d: rg.replication_status(located(spark, d), _results(spark, d)))

query(
    "replicated_counts",
    _LOC
    + f""", r AS ({_RESULTS}) SELECT target_region, count(*) FILTER (success) AS replicated, count(*) FILTER (NOT success) AS failed
      FROM r GROUP BY 1""",
)(lambda spark, d: rg.replicated_counts(_results(spark, d)))


def _sides(spark, d):
    """Two regions' copies of the orders; the remote one is older, equal or newer by key."""
    o = a.orders(spark, d).select("id", "status", "shipping_address", "updated_at")
    local = o.where("id % 9 <> 0")
    shift = F.make_dt_interval(hours=(F.col("id") % 3 - 1).cast("int"))
    remote = o.where("id % 8 <> 0").select(
        "id",
        F.expr("CASE WHEN id % 4 = 1 THEN NULL ELSE concat('r-', status) END").alias("status"),
        F.expr("coalesce(shipping_address, 'remote street')").alias("shipping_address"),
        (F.col("updated_at") + shift).alias("updated_at"),
    )
    return local, remote


_SIDES = """l AS (SELECT id, status, shipping_address, updated_at FROM shop_orders WHERE id % 9 <> 0),
r AS (SELECT id, CASE WHEN id % 4 = 1 THEN NULL ELSE 'r-' || status END AS status,
    coalesce(shipping_address, 'remote street') AS shipping_address,
    updated_at + CAST(id % 3 - 1 AS INTEGER) * INTERVAL 1 HOUR AS updated_at FROM shop_orders WHERE id % 8 <> 0),
b AS (SELECT coalesce(l.id, r.id) AS id, l.id AS lid, r.id AS rid, l.status AS ls, r.status AS rs, l.shipping_address AS la,
    r.shipping_address AS ra, l.updated_at AS lt, r.updated_at AS rt FROM l FULL JOIN r ON l.id = r.id)"""
_TAKES = {
    "last_write": "rt > lt",
    "first_write": "NOT (lt < rt)",
    "source_wins": "false",
    "merge": "rt > lt",
}
for _strategy, _test in _TAKES.items():
    _pick = "CASE WHEN t THEN {1} ELSE {0} END"
    if _strategy == "merge":
        _pick = "CASE WHEN t THEN coalesce({1}, {0}) ELSE coalesce({0}, {1}) END"
    query(
        f"conflict_{_strategy}",
        a.with_ctes(a.ORDERS, _SIDES)
        + f"""SELECT id, {_pick.format('ls', 'rs')} AS status, {_pick.format('la', 'ra')} AS shipping_address,
          CAST({_pick.format('lt', 'rt')} AS VARCHAR) AS updated_at, CASE WHEN t THEN 'remote' ELSE 'local' END AS winner
          FROM (SELECT *, CASE WHEN lid IS NULL THEN true WHEN rid IS NULL THEN false ELSE {_test} END AS t FROM b)""",
    )(lambda spark, d, s=_strategy: plain(rg.resolve_conflicts(*_sides(spark, d), "id", s)))

query(
    "conflict_manual",
    a.with_ctes(a.ORDERS, _SIDES)
    + """SELECT id, ls AS local_status, rs AS remote_status FROM b WHERE lid IS NOT NULL AND rid IS NOT NULL
      AND (ls IS DISTINCT FROM rs OR la IS DISTINCT FROM ra OR lt IS DISTINCT FROM rt)""",
)(
    lambda spark, d: rg.resolve_conflicts(*_sides(spark, d), "id", "manual").select(
        "id", F.col("local.status").alias("local_status"), F.col("remote.status").alias("remote_status")
    )
)


def _logs(spark, d):
    source = located(spark, d).select("source_region", F.col("event_id").alias("offset"), "ts")
    fanned = rg.replication_fanout(located(spark, d), REGIONS)
    behind = F.length("target_region") * 3 + F.length("source_region")
    newest = F.struct(F.max("event_id").alias("top"))
    top = located(spark, d).agg(newest.alias("m")).select("m.top")
    return source, (
        fanned.withColumn("_top", top.scalar())
        .where(F.col("event_id") <= F.col("_top") - behind)
        .select("source_region", "target_region", F.col("event_id").alias("offset"), "ts")
    )


query(
    "replication_lag",
    _LOC
    + """, s AS (SELECT source_region, max(event_id) AS o, max(ts) AS t FROM ev GROUP BY 1),
      g AS (SELECT f.source_region, target_region, max(f.event_id) AS o, max(ev.ts) AS t FROM fan f JOIN ev USING (event_id)
        WHERE f.event_id <= (SELECT max(event_id) FROM ev) - (length(target_region) * 3 + length(f.source_region)) GROUP BY 1, 2)
      SELECT g.source_region, target_region, (epoch_us(s.t) - epoch_us(g.t)) / 1000.0::DOUBLE AS lag_ms, s.o - g.o AS lag_events,
        g.o AS last_replicated_offset, s.o AS last_source_offset, (epoch_us(s.t) - epoch_us(g.t)) / 1000.0::DOUBLE < 1000 AS caught_up,
        (epoch_us(s.t) - epoch_us(g.t)) / 1000.0::DOUBLE > 5000 AS alert FROM g JOIN s USING (source_region)""",
)(lambda spark, d: plain(rg.replication_lag(*_logs(spark, d))))

query(
    "route_round_robin",
    _LOC
    + f"""SELECT event_id, {_LIVE_SQL}[(row_number() OVER (ORDER BY ts, event_id) - 1) % {len(_LIVE)} + 1] AS region FROM ev""",
)(
    lambda spark, d: rg.route_round_robin(
        located(spark, d).select("event_id", "ts"), REGIONS, [F.col("ts"), F.col("event_id")]
    ).select("event_id", "region")
)

_MEASURED = """lat AS (SELECT region, arg_max(ms, event_id) AS ms FROM (
    SELECT event_id, ['us-east-1', 'us-west-2', 'eu-west-1', 'eu-central-1'][event_id % 4 + 1] AS region, value AS ms FROM events) GROUP BY 1)"""

query(
    "route_latency",
    _LOC
    + f""", {_MEASURED} SELECT event_id, (SELECT region FROM lat ORDER BY ms LIMIT 1) AS region,
      (SELECT min(ms) FROM lat) AS latency_ms, (SELECT string_agg(region, ',' ORDER BY ms) FROM lat
        WHERE region <> (SELECT region FROM lat ORDER BY ms LIMIT 1)) || ',ap-northeast-1,ap-southeast-1' AS alternatives FROM ev""",
)(
    lambda spark, d: rg.route_latency(
        located(spark, d).select("event_id"),
        REGIONS,
        events(spark, d).select(
            F.element_at(F.array(*[F.lit(s) for s in _SOURCES]), (F.col("event_id") % 4 + 1).cast("int")).alias("region"),
            "ts", F.col("value").alias("latency_ms"),
        ),
    ).withColumn("alternatives", F.array_join("alternatives", ","))
)

_COORDS = ", ".join(
    f"({i}, '{r.name}', {r.latitude}::DOUBLE, {r.longitude}::DOUBLE)"
    for i, r in enumerate(x for x in REGIONS if x.status == rg.ACTIVE)
)

query(
    "route_geo",
    _LOC
    + f""", dist AS (SELECT event_id, nth, name, 2 * 6371 * atan2(sqrt(h), sqrt(1 - h)) AS km FROM (
        SELECT event_id, nth, name, pow(sin(radians(lat - latitude) / 2), 2)
          + cos(radians(latitude)) * cos(radians(lat)) * pow(sin(radians(lon - longitude) / 2), 2) AS h
        FROM ev, (VALUES {_COORDS}) r(nth, name, lat, lon)))
      SELECT event_id, arg_min(name, km) AS region, round(min(km), 3) AS distance_km,
        string_agg(name, ',' ORDER BY km) AS ranked FROM dist GROUP BY 1""",
)(
    lambda spark, d: rg.route_geographic(located(spark, d).select("event_id", "latitude", "longitude"), REGIONS).select(
        "event_id", "region", F.round("distance_km", 3).alias("distance_km"),
        F.concat_ws(",", F.array("region"), "alternatives").alias("ranked"),
    )
)

_HASH = "CAST(('0x' || substr(md5(CAST({0} AS VARCHAR)), 1, 8)) AS BIGINT)"
_total, _cuts = 0, []
for _r in REGIONS:
    if _r.status == rg.ACTIVE:
        _total += _r.share
        _cuts.append(f"WHEN draw < {_total} THEN '{_r.name}'")

query(
    "route_weighted",
    _LOC
    + f"""SELECT event_id, CASE {' '.join(_cuts)} END AS region FROM (
      SELECT event_id, {_HASH.format('event_id')} % {_total} AS draw FROM ev)""",
)(lambda spark, d: rg.route_weighted(located(spark, d), REGIONS, "event_id").select("event_id", "region"))

query(
    "route_affinity",
    _LOC
    + f"""SELECT event_id, CASE WHEN user_id % 10 = 3 THEN 'eu-west-1'
        ELSE {_LIVE_SQL}[{_HASH.format('user_id')} % {len(_LIVE)} + 1] END AS region FROM ev""",
)(
    # Users ending in 3 are moved; those ending in 7 are sent to a region that is offline.
    lambda spark, d: rg.route_affinity(
        located(spark, d).select("event_id", "user_id"),
        REGIONS,
        "user_id",
        overrides=events(spark, d)
        .where("user_id % 10 IN (3, 7)")
        .select("user_id", F.expr("CASE WHEN user_id % 10 = 3 THEN 'eu-west-1' ELSE 'ap-south-1' END").alias("region"))
        .distinct(),
    ).select("event_id", "region")
)

_FAIL = """fail AS (SELECT ['us-east-1', 'us-west-2'][event_id % 2 + 1] AS region, ts FROM events WHERE event_type = 'error')"""

query(
    "route_failover",
    _LOC
    + f""", {_FAIL}, down AS (SELECT e.event_id, bool_or(f.region = 'us-east-1') AS p, bool_or(f.region = 'us-west-2') AS w
        FROM ev e JOIN fail f ON f.ts <= e.ts AND epoch_us(e.ts) - epoch_us(f.ts) < 900000000 GROUP BY 1)
      SELECT event_id, CASE WHEN NOT coalesce(p, false) THEN 'us-east-1' WHEN NOT coalesce(w, false) THEN 'us-west-2'
        ELSE 'eu-west-1' END AS region FROM ev LEFT JOIN down USING (event_id)""",
)(
    lambda spark, d: rg.route_failover(
        located(spark, d).select("event_id", "ts"),
        REGIONS,
        events(spark, d)
        .where("event_type = 'error'")
        .select(F.element_at(F.array(F.lit("us-east-1"), F.lit("us-west-2")), (F.col("event_id") % 2 + 1).cast("int")).alias("region"), "ts"),
        retry_seconds=900,
    ).select("event_id", "region")
)


def checks(spark, d):
    """Each event is one health check of its source region; large values fail."""
    return located(spark, d).select(
        F.col("source_region").alias("region"), "event_id", "ts", (F.col("value") < 12).alias("passed")
    )


_CHECKS = """chk AS (SELECT source_region AS region, event_id, ts, value < 12 AS passed FROM ev),
runs AS (SELECT *, row_number() OVER (PARTITION BY region, passed, g ORDER BY ts, event_id) AS run FROM (
  SELECT *, row_number() OVER (PARTITION BY region ORDER BY ts, event_id)
          - row_number() OVER (PARTITION BY region, passed ORDER BY ts, event_id) AS g FROM chk)),
own AS (SELECT *, CASE WHEN NOT passed AND run >= 3 THEN 'unhealthy' WHEN NOT passed THEN 'degraded' WHEN run >= 2 THEN 'healthy' END AS own,
    CAST(count(*) FILTER (passed) OVER w AS DOUBLE) / count(*) OVER w AS rate
  FROM runs WINDOW w AS (PARTITION BY region ORDER BY ts, event_id))"""

query(
    "region_health",
    _LOC
    + f""", {_CHECKS} SELECT region, event_id, coalesce(last_value(own IGNORE NULLS) OVER w, 'unknown') AS status, run AS run_length, rate AS success_rate,
      coalesce(last_value(CASE WHEN own = 'healthy' THEN 0.0::DOUBLE WHEN NOT passed THEN 1.0::DOUBLE - rate END IGNORE NULLS) OVER w, 0.0::DOUBLE) AS error_rate
      FROM own WINDOW w AS (PARTITION BY region ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)(
    lambda spark, d: plain(
        rg.region_health(checks(spark, d), order=("ts", "event_id")).select(
            "region", "event_id", "status", "run_length", "success_rate", "error_rate"
        )
    )
)

query(
    "component_health",
    _LOC
    + """, c AS (SELECT user_id, event_type <> 'view' AS critical, CASE WHEN value >= 40 THEN 2 WHEN value >= 25 THEN 1 ELSE 0 END AS s FROM ev),
      w AS (SELECT user_id, coalesce(max(s) FILTER (critical), 0) AS s FROM c GROUP BY 1)
      SELECT user_id, ['healthy', 'degraded', 'unhealthy'][s + 1] AS status, s = 0 AS healthy FROM w""",
)(
    lambda spark, d: rg.component_health(
        events(spark, d).select(
            "user_id", (F.col("event_type") != "view").alias("critical"),
            F.expr("CASE WHEN value >= 40 THEN 'unhealthy' WHEN value >= 25 THEN 'degraded' ELSE 'healthy' END").alias("status"),
        ),
        ["user_id"],
    )
)
