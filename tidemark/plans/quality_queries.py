"""Queries for rules, checkers, dead letters, table tests and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import checks, dlq, quality, stages
from tidemark.plans import adapters as a
from tidemark.plans import change_log as cl
from tidemark.plans.registry import plain, query
from tidemark.session import scratch_path, written
from tidemark.sources.bronze import read_bronze, write_bronze
from tidemark.sources.events import parse_events, valid_events


def _verdict(checked, key):
    return checked.select(
        key, "passed", F.array_join(F.transform("failures", lambda f: f["message"]), "; ").alias("message")
    )


def _rule(rule, rows, key, json_col=None):
    return plain(_verdict(quality.Checker("one").add(rule).apply(rows, json_col), key))


def _rule_sql(ctes, source, key, failed, message):
    head = a.with_ctes(*ctes) if ctes else ""
    return (
        head
        + f"""SELECT {key}, NOT ({failed}) AS passed, CASE WHEN {failed} THEN {message} ELSE '' END AS message
        FROM {source}"""
    )


query(
    "rule_required",
    _rule_sql((a.ORDERS,), "shop_orders", "id", "shipping_address IS NULL",
              "'Required field ''shipping_address'' is null'"),
)(lambda spark, d: _rule(quality.required("shipping_address"), a.orders(spark, d), "id"))

query(
    "rule_type",
    _rule_sql((), "(SELECT event_id FROM events)", "event_id", "event_id % 4 IN (1, 3)",
              "CASE event_id % 4 WHEN 1 THEN 'Field ''k'' has type str, expected int or float' "
              "ELSE 'Field ''k'' has type list, expected int or float' END"),
)(
    lambda spark, d: _rule(
        quality.type_is("k", ["int", "float"]),
        a.table(spark, d, "events").select(
            "event_id",
            F.expr("""CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN concat('{"k": "', event_type, '"}')
                      WHEN 2 THEN concat('{"k": ', value, '}') ELSE '{"k": [1]}' END""").alias("props"),
        ),
        "event_id",
        "props",
    )
)

query(
    "rule_range",
    _rule_sql((), "(SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)", "event_id",
              "k < 10 OR k > 90",
              "'Field ''k'' value ' || k || CASE WHEN k < 10 THEN ' is below minimum 10' ELSE ' is above maximum 90' END"),
)(
    lambda spark, d: _rule(
        quality.in_range("k", 10, 90), a.table(spark, d, "events").select("event_id", "props"), "event_id", "props"
    )
)

query(
    "rule_pattern",
    _rule_sql((a.CUSTOMERS,), "customers", "id",
              r"NOT regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$')",
              "'Field ''email'' doesn''t match email format'"),
)(lambda spark, d: _rule(quality.email("email"), a.customers(spark, d), "id"))

query(
    "rule_enum",
    _rule_sql((a.ORDERS,), "shop_orders", "id", "status NOT IN ('pending', 'shipped')",
              "'Field ''status'' value ''' || status || ''' not in allowed values'"),
)(lambda spark, d: _rule(quality.one_of("status", ["pending", "shipped"]), a.orders(spark, d), "id"))

query(
    "rule_custom",
    _rule_sql((a.ORDERS,), "shop_orders", "id",
              "NOT coalesce(total_amount >= 50 OR length(shipping_address) > 15, false)",
              "'small orders need an address'"),
)(
    lambda spark, d: _rule(
        quality.custom(
            "address_needed",
            (F.col("total_amount") >= 50) | (F.length("shipping_address") > 15),
            "small orders need an address",
        ),
        a.orders(spark, d),
        "id",
    )
)

query(
    "rule_severity",
    a.with_ctes(a.ORDERS)
    + """SELECT id, total_amount >= 5 AS passed,
      CAST(CASE WHEN shipping_address IS NULL THEN 1 ELSE 0 END AS BIGINT) AS warnings,
      CAST(CASE WHEN total_amount < 5 THEN 1 ELSE 0 END AS BIGINT) AS errors FROM shop_orders""",
)(
    lambda spark, d: plain(
        quality.Checker("order_rows")
        .add(quality.required("shipping_address", quality.WARNING), quality.in_range("total_amount", low=5))
        .apply(a.orders(spark, d), fail_on="error")
        .select(
            "id", "passed",
            F.size(quality.by_severity("warning")).alias("warnings"),
            F.size(quality.by_severity("error")).alias("errors"),
        )
    )
)

# The staged run in SQL: rule names and messages per readable message.
_STAGED = """judged AS (
  SELECT *, damage IS NOT NULL AND damage IN (0, 1, 7) AS unread, coalesce(damage = 4, false) AS shapeless,
    [x FOR x IN [
      CASE WHEN damage = 2 THEN 'required_event_id' END,
      CASE WHEN damage = 5 THEN 'required_source' END,
      CASE WHEN damage = 3 THEN 'enum_operation' END,
      CASE WHEN damage = 5 THEN 'source_has_table' END,
      CASE WHEN damage = 5 THEN 'source_has_database' END,
      CASE WHEN image = 'partial' THEN 'required_customer_id' END,
      CASE WHEN image = 'partial' THEN 'required_total_amount' END,
      CASE WHEN tbl = 'customers' AND (id % 50 = 0 OR id % 7 = 0) THEN 'pattern_email' END,
      CASE WHEN tbl = 'customers' AND id < 1 THEN 'range_id' END] IF x IS NOT NULL] AS rules,
    [x FOR x IN [
      CASE WHEN damage = 2 THEN 'Required field ''event_id'' is null' END,
      CASE WHEN damage = 5 THEN 'Required field ''source'' is null' END,
      CASE WHEN damage = 3 THEN 'Field ''operation'' value ''UPSERT'' not in allowed values' END,
      CASE WHEN damage = 5 THEN 'source.table is required' END,
      CASE WHEN damage = 5 THEN 'source.database is required' END,
      CASE WHEN image = 'partial' THEN 'Required field ''customer_id'' is null' END,
      CASE WHEN image = 'partial' THEN 'Required field ''total_amount'' is null' END,
      CASE WHEN tbl = 'customers' AND (id % 50 = 0 OR id % 7 = 0) THEN 'Field ''email'' doesn''t match email format' END,
      CASE WHEN tbl = 'customers' AND id < 1 THEN 'Field ''id'' value 0 is below minimum 1' END] IF x IS NOT NULL] AS messages
  FROM log WHERE damage IS NULL OR damage <> 6),
staged AS (
  SELECT *, CASE WHEN unread THEN 'deser_error' WHEN shapeless THEN 'schema_mismatch'
                 WHEN len(rules) > 0 THEN 'quality_failure' END AS reason,
    CASE WHEN damage = 0 THEN 'Failed to deserialize: empty message'
         WHEN damage = 1 THEN 'Failed to deserialize: invalid JSON'
         WHEN damage = 7 THEN 'Failed to deserialize: invalid UTF-8'
         WHEN damage = 4 THEN 'Failed to parse change event: not an object'
         WHEN len(rules) > 0 THEN 'Quality checks failed: ' || array_to_string(messages[1:3], ', ')
              || CASE WHEN len(messages) > 3 THEN ' (and ' || (len(messages) - 3) || ' more)' ELSE '' END END AS message
  FROM judged)"""
_RUN = a.with_ctes(*cl.LOG_CTES, _STAGED)


def _staged(spark, d):
    return stages.stage_events(cl.raw_events(spark, d))


query(
    "envelope_report",
    _RUN
    + """SELECT topic, CAST(part AS BIGINT) AS partition, off AS "offset", array_to_string(rules, ',') AS failed_rules,
      CASE WHEN reason IS NULL THEN 'routing' ELSE 'quality' END AS stage
      FROM staged WHERE NOT unread AND NOT shapeless""",
)(
    lambda spark, d: plain(
        _staged(spark, d)
        .where("stage <> 'deserialization'")
        .select(
            "topic", "partition", "offset",
            F.array_join(F.transform("failures", lambda f: f["rule"]), ",").alias("failed_rules"), "stage",
        )
    )
)

query(
    "row_checkers",
    _RUN
    + """SELECT tbl AS "table", unnest(rules) AS rule, count(*) AS failures FROM staged
      WHERE damage IS NULL GROUP BY 1, 2""",
)(
    lambda spark, d: quality.check_by_table(
        cl.parsed_log(spark, d).where(F.col("event_id").isNotNull()).withColumn("image", F.coalesce("after", "before")),
        quality.table_checkers(), None, F.col("source.table"), "image",
    )
    .select(F.col("source.table").alias("table"), F.explode("failures.rule").alias("rule"))
    .groupBy("table", "rule")
    .agg(F.count(F.lit(1)).alias("failures"))
)

def _split(spark, d):
    """Both halves of the split, each with what the other must not hold."""
    checked = quality.check_by_table(
        cl.parsed_log(spark, d).withColumn("image", F.coalesce("after", "before")),
        quality.table_checkers(), None, F.col("source.table"), "image",
    )
    # Written, as both halves are read from it: messages are parsed and checked once.
    held = checked.select(F.col("source.table").alias("table"), "event_id", "failures", "passed")
    good, bad = quality.quality_split(written(held, "checked"))
    half = lambda rows, name: rows.select(
        F.lit(name).alias("half"), "table", "event_id", F.size("failures").cast("bigint").alias("failures")
    )
    return half(good, "passed").unionByName(half(bad, "failed"))


query(
    "quality_split",
    _RUN
    # The event id is a rule of the envelope, not of the row.
    + """SELECT CASE WHEN n = 0 THEN 'passed' ELSE 'failed' END AS half, tbl AS "table", event_id, CAST(n AS BIGINT) AS failures
      FROM good JOIN (SELECT topic, part, off, len([x FOR x IN rules IF x <> 'required_event_id']) AS n FROM staged) USING (topic, part, off)""",
)(_split)

query(
    "quality_metrics",
    a.with_ctes(*cl.LOG_CTES)
    + """, rules(checker, rule) AS (VALUES ('customer', 'required_id'), ('customer', 'required_email'), ('customer', 'type_id'),
        ('customer', 'pattern_email'), ('customer', 'range_id'), ('order', 'required_id'), ('order', 'required_customer_id'),
        ('order', 'required_total_amount'), ('order', 'type_id'), ('order', 'type_customer_id'),
        ('order', 'type_total_amount'), ('order', 'range_total_amount')),
      found AS (SELECT CASE tbl WHEN 'orders' THEN 'order' ELSE 'customer' END AS checker,
        image = 'partial' AS p, tbl = 'customers' AND (id % 50 = 0 OR id % 7 = 0) AS e, tbl = 'customers' AND id < 1 AS r FROM good),
      per AS (SELECT checker, count(*) AS checks, count(*) FILTER (p) AS p, count(*) FILTER (e) AS e, count(*) FILTER (r) AS r,
        count(*) FILTER (NOT (p OR e OR r)) AS fine FROM found GROUP BY 1)
      SELECT checker, rule, 'error' AS severity, checks,
        CASE WHEN rule IN ('required_customer_id', 'required_total_amount') THEN p WHEN rule = 'pattern_email' THEN e
             WHEN rule = 'range_id' THEN r ELSE 0 END AS failures,
        round(100.0 * fine / CAST(checks AS DOUBLE), 4) AS pass_rate
      FROM rules JOIN per USING (checker)""",
)(
    lambda spark, d: plain(
        quality.quality_metrics(
            quality.check_by_table(
                cl.parsed_log(spark, d).withColumn("image", F.coalesce("after", "before")),
                quality.table_checkers(), None, F.col("source.table"), "image",
            ),
            list(quality.table_checkers().values()),
        )
    )
)

query(
    "stage_stats",
    _RUN
    + """SELECT count(*) AS processed, count(*) FILTER (NOT unread AND NOT shapeless AND len(rules) = 0) AS quality_passed,
      count(*) FILTER (reason = 'quality_failure') AS quality_failed,
      count(*) FILTER (reason IN ('deser_error', 'schema_mismatch')) AS deserialization_failed,
      count(*) FILTER (reason IS NULL) AS ready,
      round(100.0 * count(*) FILTER (NOT unread AND NOT shapeless AND len(rules) = 0)
        / CAST(count(*) FILTER (NOT unread AND NOT shapeless) AS DOUBLE), 1) AS quality_pass_rate FROM staged""",
)(lambda spark, d: stages.stage_stats(_staged(spark, d)))

query(
    "accepted_events",
    a.with_ctes(*cl.LOG_CTES, _STAGED)
    + """SELECT sent_id AS event_id, min(operation) AS operation FROM staged WHERE reason IS NULL GROUP BY 1""",
)(lambda spark, d: stages.process(cl.raw_events(spark, d))[0].select("event_id", "operation"))

query(
    "dlq_entries",
    _RUN
    + """SELECT topic || ':' || CAST(part AS VARCHAR) AS dlq_key, off AS original_offset, reason AS failure_reason,
      message AS error_message, CAST(0 AS BIGINT) AS retry_count,
      CASE damage WHEN 0 THEN '{"raw_message":""}' WHEN 7 THEN '{"raw_message":"<binary 6 bytes>"}' WHEN 4 THEN '"just text"' END AS short_event,
      CASE WHEN reason = 'quality_failure' THEN CAST(len(rules) AS VARCHAR) END AS failure_count
      FROM staged WHERE reason IS NOT NULL""",
)(
    lambda spark, d: plain(
        stages.rejected(_staged(spark, d)).select(
            dlq.dlq_key().alias("dlq_key"), "original_offset", "failure_reason", "error_message", "retry_count",
            F.when(F.length("original_event") < 60, F.col("original_event")).alias("short_event"),
            F.col("error_details")["failure_count"].alias("failure_count"),
        )
    )
)

query(
    "dlq_summary",
    _RUN + "SELECT reason AS failure_reason, count(*) AS entries FROM staged WHERE reason IS NOT NULL GROUP BY 1",
)(lambda spark, d: dlq.dlq_summary(stages.rejected(_staged(spark, d))))

query(
    "dlq_replay",
    _RUN
    + """SELECT topic, off AS "offset", CAST(1 AS BIGINT) AS retry_count, {0} AS event_id, CAST(NULL AS VARCHAR) AS body_md5
      FROM staged WHERE reason = 'quality_failure' AND damage IS DISTINCT FROM 3 AND damage IS DISTINCT FROM 5
      UNION ALL SELECT topic, off, 1, NULL, CASE damage WHEN 0 THEN md5('') WHEN 1 THEN md5('{invalid json' || repeat('x', 600))
        WHEN 7 THEN md5(unhex('00FF807FABCD')) END FROM staged WHERE damage IN (0, 1, 7, 3, 5)""".replace(
        "{0}", "coalesce(sent_id, " + cl._uuid("topic || ':' || CAST(part AS VARCHAR) || ':' || CAST(off AS VARCHAR)") + ")"
    ),
)(
    lambda spark, d: _replayed(spark, d)
)


def _replayed(spark, d):
    """Replayed messages parsed again; those still unusable have no event id."""
    again = dlq.replay_dlq(stages.rejected(_staged(spark, d)), ["quality_failure", "deser_error"])
    parsed = parse_events(again)
    usable = F.col("deser_error").isNull() & F.col("schema_error").isNull()
    return plain(
        parsed.select(
            "topic", "offset", F.lit(1).alias("retry_count"), F.when(usable, F.col("event_id")).alias("event_id"),
            F.when(F.col("deser_error").isNotNull(), F.md5("raw_value")).alias("body_md5"),
        )
    )


# ---- sinks read back ----------------------------------------------------------------


def _dlq_roundtrip(spark, d):
    path = scratch_path(spark, "dlq")
    dlq.write_dlq(stages.rejected(_staged(spark, d)), path)
    return dlq.read_dlq(spark, path).select("failure_reason", "original_topic", "original_offset", "error_message")


query(
    "dlq_roundtrip",
    _RUN
    + """SELECT reason AS failure_reason, topic AS original_topic, off AS original_offset, message AS error_message
      FROM staged WHERE reason IS NOT NULL""",
)(_dlq_roundtrip)


def _bronze_roundtrip(spark, d):
    path = scratch_path(spark, "bronze")
    write_bronze(cl.parsed_log(spark, d), path)
    got = read_bronze(spark, path, "orders", "1997-03-01 00:00:00", "1998-03-01 00:00:00")
    return plain(
        got.select(
            "event_id", "operation", "table", "year", "month", "day", "hour", F.col("source.lsn").alias("lsn"), "event_timestamp"
        )
    )


query(
    "bronze_roundtrip",
    a.with_ctes(*cl.LOG_CTES)
    + """SELECT event_id, operation, tbl AS "table", year(ts) AS year, month(ts) AS month, day(ts) AS day, hour(ts) AS hour, lsn,
      CAST(CAST(date_trunc('second', ts) AS TIMESTAMP) AS VARCHAR) AS event_timestamp FROM good
      WHERE tbl = 'orders' AND ts >= TIMESTAMP '1997-03-01' AND ts < TIMESTAMP '1998-03-01'""",
)(_bronze_roundtrip)

# ---- table tests --------------------------------------------------------------------

query(
    "test_unique",
    a.with_ctes(a.ORDER_ITEMS)
    + "SELECT id AS value, count(*) AS occurrences FROM order_items GROUP BY 1 HAVING count(*) > 1",
)(lambda spark, d: checks.test_unique(a.order_items(spark, d), "id"))

query("test_not_null", a.with_ctes(a.ORDERS) + "SELECT id FROM shop_orders WHERE shipping_address IS NULL")(
    lambda spark, d: checks.test_not_null(a.orders(spark, d), "shipping_address").select("id")
)

query(
    "test_accepted",
    a.with_ctes(a.ORDERS)
    + """SELECT status AS value, count(*) AS occurrences FROM shop_orders
      WHERE status NOT IN ('pending', 'shipped', 'delivered') GROUP BY 1""",
)(lambda spark, d: checks.test_accepted(a.orders(spark, d), "status", ["pending", "shipped", "delivered"]))

query(
    "freshness",
    a.with_ctes(a.ORDERS)
    + f"""SELECT CAST(max(updated_at) AS VARCHAR) AS max_loaded_at,
      date_diff('microsecond', max(updated_at), TIMESTAMP '{a.AS_OF}') / 1e6 AS age_seconds,
      CASE WHEN date_diff('second', max(updated_at), TIMESTAMP '{a.AS_OF}') > 21600 THEN 'error'
           WHEN date_diff('second', max(updated_at), TIMESTAMP '{a.AS_OF}') > 3600 THEN 'warn' ELSE 'pass' END AS status
      FROM shop_orders""",
)(lambda spark, d: plain(checks.freshness(a.orders(spark, d), "updated_at", a.AS_OF)))

query(
    "reconcile_counts",
    a.with_ctes(a.ORDERS, a.CUSTOMERS)
    + """SELECT 'orders' AS "table", (SELECT count(*) FROM shop_orders) AS source_rows,
        (SELECT count(*) FROM shop_orders WHERE id % 13 <> 0) AS target_rows,
        (SELECT count(*) FROM shop_orders WHERE id % 13 <> 0) - (SELECT count(*) FROM shop_orders) AS delta
      UNION ALL SELECT 'customers', (SELECT count(*) FROM customers), (SELECT count(*) FROM customers), 0""",
)(
    lambda spark, d: checks.reconcile_counts(
        {"orders": a.orders(spark, d), "customers": a.customers(spark, d)},
        {"orders": a.orders(spark, d).where("id % 13 <> 0"), "customers": a.customers(spark, d)},
    )
)


def _drifted(spark, d):
    """A target that lost every 13th order, gained shifted ones, and changed some columns."""
    o = a.orders(spark, d)
    kept = o.where("id % 13 <> 0").withColumns(
        {
            "status": F.expr("CASE WHEN id % 19 = 0 THEN 'pending' ELSE status END"),
            "total_amount": F.expr("CASE WHEN id % 23 = 0 THEN cast(total_amount + 1 AS decimal(12,2)) ELSE total_amount END"),
        }
    )
    extra = o.where("id % 101 = 0").withColumn("id", F.col("id") + 100000000000)
    return kept.unionByName(extra)


_DRIFTED = """drifted AS (
  SELECT id, CASE WHEN id % 19 = 0 THEN 'pending' ELSE status END AS status,
         CASE WHEN id % 23 = 0 THEN total_amount + 1 ELSE total_amount END AS total_amount
  FROM shop_orders WHERE id % 13 <> 0
  UNION ALL SELECT id + 100000000000, status, total_amount FROM shop_orders WHERE id % 101 = 0)"""

query(
    "reconcile_rows",
    a.with_ctes(a.ORDERS, _DRIFTED)
    + """SELECT * FROM (SELECT coalesce(s.id, t.id) AS id,
        CASE WHEN t.id IS NULL THEN 'missing_in_target' WHEN s.id IS NULL THEN 'extra_in_target'
             WHEN s.status <> t.status OR s.total_amount <> t.total_amount THEN 'mismatch' END AS issue,
        CASE WHEN s.status <> t.status AND s.total_amount <> t.total_amount THEN 'status,total_amount'
             WHEN s.status <> t.status THEN 'status' WHEN s.total_amount <> t.total_amount THEN 'total_amount' END AS columns
      FROM shop_orders s FULL JOIN drifted t ON s.id = t.id) WHERE issue IS NOT NULL""",
)(
    lambda spark, d: checks.reconcile_rows(
        a.orders(spark, d), _drifted(spark, d), "id", ["status", "total_amount"]
    )
)

query(
    "lost_rows",
    a.with_ctes(a.ORDERS, _DRIFTED)
    + """SELECT id, status FROM shop_orders EXCEPT ALL SELECT id, status FROM drifted""",
)(lambda spark, d: checks.lost_rows(a.orders(spark, d), _drifted(spark, d), ["id", "status"]))

query(
    "union_feeds",
    a.with_ctes(*cl.LOG_CTES)
    + """SELECT tbl AS feed, event_id, CASE WHEN tbl = 'orders' THEN lsn END AS lsn,
      CASE WHEN tbl = 'customers' THEN operation END AS operation FROM good""",
)(
    lambda spark, d: checks.union_feeds(
        [
            cl.parsed_log(spark, d)
            .where("source.table = 'orders'")
            .select(F.lit("orders").alias("feed"), "event_id", F.col("source.lsn").alias("lsn")),
            cl.parsed_log(spark, d)
            .where("source.table = 'customers'")
            .select(F.lit("customers").alias("feed"), "event_id", "operation"),
        ]
    )
)
