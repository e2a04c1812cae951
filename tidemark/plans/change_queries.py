"""Queries over the derived change log: parsing, transactions, folding, questions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.lsn import lsn_to_num, num_to_lsn
from tidemark.operators import changes, checks, dedup, envelope
from tidemark.plans import adapters as a
from tidemark.plans import change_log as cl
from tidemark.plans.registry import plain, query
from tidemark.session import swept
from tidemark.sources.events import parse_events, split_registry_header, typed_rows, valid_events

_BASE = a.with_ctes(*cl.LOG_CTES)
_UNIQUE = a.with_ctes(*cl.LOG_CTES, cl.UNIQUE)

query(
    "parse_events",
    _BASE
    + """SELECT event_id, topic, CAST(part AS BIGINT) AS partition, off AS "offset", CAST(ts AS VARCHAR) AS event_timestamp,
      tbl AS table_name, xid, lsn, operation, CAST(lsn_num AS DOUBLE) AS lsn_num FROM good""",
)(
    lambda spark, d: plain(
        cl.parsed_log(spark, d).select(
            "event_id", "topic", "partition", "offset", "event_timestamp",
            F.col("source.table").alias("table_name"), F.col("source.transaction_id").alias("xid"),
            F.col("source.lsn").alias("lsn"), "operation", "lsn_num",
        )
    )
)

query(
    "event_errors",
    _BASE
    + """SELECT CASE damage WHEN 0 THEN 'deser: empty message' WHEN 1 THEN 'deser: invalid JSON'
        WHEN 7 THEN 'deser: invalid UTF-8' WHEN 3 THEN 'schema: operation'
        WHEN 4 THEN 'schema: not an object' WHEN 5 THEN 'schema: source' END AS problem, count(*) AS messages
      FROM log WHERE damage IN (0, 1, 3, 4, 5, 7) GROUP BY 1""",
)(
    lambda spark, d: parse_events(cl.raw_events(spark, d))
    .select(
        F.coalesce(
            F.concat(F.lit("deser: "), "deser_error"), F.concat(F.lit("schema: "), "schema_error")
        ).alias("problem")
    )
    .where("problem IS NOT NULL")
    .groupBy("problem")
    .agg(F.count(F.lit(1)).alias("messages"))
)

query(
    "typed_orders",
    _BASE
    + """SELECT event_id, id, CASE WHEN image = 'partial' THEN NULL ELSE customer_id END AS customer_id, status,
      CASE WHEN image = 'partial' THEN NULL ELSE CAST(total_amount AS DOUBLE) END AS total_amount,
      CASE image WHEN 'partial' THEN NULL WHEN 'marked' THEN '__unchanged__' ELSE shipping_address END AS shipping_address,
      CASE WHEN image = 'partial' THEN NULL ELSE CAST(created_at AS VARCHAR) END AS created_at,
      CAST(updated_at AS VARCHAR) AS updated_at
      FROM good WHERE tbl = 'orders' AND operation <> 'DELETE'""",
)(
    lambda spark, d: plain(
        typed_rows(
            cl.order_events(spark, d).where("operation <> 'DELETE'").select("event_id", "after"),
            cl.ORDER_SCHEMA,
        ).drop("_rescued")
    )
)

query(
    "rescued_cells",
    _BASE
    + """SELECT event_id, 'status' AS cell, status AS text FROM good
      WHERE tbl = 'orders' AND operation <> 'DELETE'""",
)(
    lambda spark, d: typed_rows(
        cl.order_events(spark, d).where("operation <> 'DELETE'").select("event_id", "after"),
        T.StructType().add("id", "long").add("status", "integer"),
    ).select("event_id", F.explode("_rescued").alias("cell", "text"))
)

query(
    "lsn_order",
    _UNIQUE
    + """SELECT event_id, lsn, CAST(lsn_num AS DOUBLE) AS lsn_num, lsn AS again FROM uniq""",
)(
    lambda spark, d: plain(
        dedup.dedup_events(cl.parsed_log(spark, d))
        .select("event_id", F.col("source.lsn").alias("lsn"))
        .withColumn("lsn_num", lsn_to_num(F.col("lsn")))
        .withColumn("again", num_to_lsn(F.col("lsn_num")))
    )
)

query(
    "entity_key",
    _UNIQUE + "SELECT event_id, CAST(id AS VARCHAR) AS entity_key, operation FROM uniq",
)(
    lambda spark, d: dedup.dedup_events(cl.parsed_log(spark, d)).select(
        "event_id", envelope.entity_key().alias("entity_key"), "operation"
    )
)

def _with_previous(batches):
    """The operation of the row before, where that row is of the same entity."""
    key, operation = None, None
    for rows in batches:
        keys, before = rows["entity_key"].shift(), rows["operation"].shift()
        if len(rows):
            keys.iloc[0], before.iloc[0] = key, operation
            key, operation = rows["entity_key"].iloc[-1], rows["operation"].iloc[-1]
        previous = before.where(keys == rows["entity_key"], None)
        yield rows[["entity_key", "event_id"]].assign(previous=previous)


query(
    "entity_order",
    _BASE
    + """SELECT CAST(id AS VARCHAR) AS entity_key, event_id,
      lag(operation) OVER (PARTITION BY id ORDER BY lsn_num, event_id) AS previous FROM good WHERE tbl = 'orders'""",
)(
    # No sort here but the operator's: rows are read as its partitions hold them.
    lambda spark, d: envelope.order_by_entity(cl.order_events(spark, d), 8)
    .select("entity_key", "event_id", "operation")
    .mapInPandas(_with_previous, "entity_key string, event_id string, previous string")
)

query(
    "topic_counts",
    _BASE + "SELECT 'cdc.source_db.public.' || tbl AS topic, count(*) AS events FROM good GROUP BY 1",
)(
    lambda spark, d: cl.parsed_log(spark, d)
    .select(envelope.topic_name().alias("topic"))
    .groupBy("topic")
    .agg(F.count(F.lit(1)).alias("events"))
)


def _decoded_log(spark, d):
    """Row changes of orders with BEGIN and COMMIT rows; every seventh transaction stays open."""
    rows = dedup.dedup_events(cl.order_events(spark, d)).select(
        F.col("operation").alias("type"),
        F.col("source.transaction_id").alias("xid"),
        F.col("source.lsn").alias("lsn"),
        "event_id",
    )
    base = a.orders(spark, d).select(F.expr("id div 5").alias("xid")).distinct()
    first, last = F.col("xid") * (20 * cl.LSN_STEP), F.col("xid") * (20 * cl.LSN_STEP) + 20 * cl.LSN_STEP - 1
    nothing = F.lit(None).cast("string").alias("event_id")
    begin = base.select(F.lit("BEGIN").alias("type"), "xid", num_to_lsn(first).alias("lsn"), nothing)
    commit = base.where("xid % 7 <> 0").select(
        F.lit("COMMIT").alias("type"), "xid", num_to_lsn(last).alias("lsn"), nothing
    )
    return rows.unionByName(begin).unionByName(commit)


_TRANSACTIONS = f"""tx AS (
  SELECT event_id, operation AS type, xid, lsn, {cl.sql_lsn(f'xid * {20 * cl.LSN_STEP} + {20 * cl.LSN_STEP - 1}')} AS commit_lsn,
         row_number() OVER (PARTITION BY xid ORDER BY lsn_num, event_id) AS position
  FROM uniq WHERE tbl = 'orders' AND xid % 7 <> 0)"""

query(
    "transactions",
    a.with_ctes(*cl.LOG_CTES, cl.UNIQUE, _TRANSACTIONS)
    + "SELECT event_id, type, xid, lsn, commit_lsn, position FROM tx",
)(
    lambda spark, d: plain(
        envelope.assemble_transactions(_decoded_log(spark, d), slice_steps=4 * cl.LSN_STEP).select(
            "event_id", "type", "xid", "lsn", "commit_lsn", "position"
        )
    )
)

query(
    "transaction_summary",
    a.with_ctes(*cl.LOG_CTES, cl.UNIQUE, _TRANSACTIONS)
    + "SELECT xid, commit_lsn, count(*) AS events FROM tx GROUP BY 1, 2",
)(
    lambda spark, d: envelope.transaction_summary(
        envelope.assemble_transactions(_decoded_log(spark, d))
    ).select("xid", "commit_lsn", "events")
)

_SNAPSHOTS = """old_s AS (SELECT id, customer_id, CASE WHEN id % 2 = 0 THEN 'pending' ELSE status END AS status FROM shop_orders WHERE id % 7 <> 0),
new_s AS (SELECT id, customer_id, status FROM shop_orders WHERE id % 13 <> 0)"""


def _snapshots(spark, d):
    o = a.orders(spark, d)
    old = o.where("id % 7 <> 0").selectExpr(
        "id", "customer_id", "CASE WHEN id % 2 = 0 THEN 'pending' ELSE status END AS status"
    )
    return old, o.where("id % 13 <> 0").select("id", "customer_id", "status")


query(
    "snapshot_diff",
    a.with_ctes(a.ORDERS, _SNAPSHOTS)
    + """SELECT CASE WHEN o.id IS NULL THEN 'INSERT' WHEN n.id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation,
      CAST(coalesce(o.id, n.id) AS VARCHAR) AS entity_key, o.status AS old_status, n.status AS new_status
      FROM old_s o FULL JOIN new_s n ON o.id = n.id
      WHERE o.id IS NULL OR n.id IS NULL OR o.status <> n.status OR o.customer_id <> n.customer_id""",
)(
    lambda spark, d: envelope.diff_snapshots(*_snapshots(spark, d), "id", "orders").select(
        "operation", "entity_key",
        F.get_json_object("before", "$.status").alias("old_status"),
        F.get_json_object("after", "$.status").alias("new_status"),
    )
)

query(
    "to_change_events",
    a.with_ctes(a.ORDERS)
    + """SELECT 'cdc.source_db.public.orders' AS topic, CAST(id AS VARCHAR) AS entity_key, 'INSERT' AS operation,
      status, CAST(NULL AS VARCHAR) AS before FROM shop_orders""",
)(
    lambda spark, d: envelope.to_change_events(
        a.orders(spark, d).select("id", "status"), "INSERT", "orders", "id"
    ).select(
        envelope.topic_name().alias("topic"), "entity_key", "operation",
        F.get_json_object("after", "$.status").alias("status"), "before",
    )
)

_SOLD = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("customer_id", T.LongType()), T.StructField("status", T.StringType())]
)


def _built_events(spark, d):
    """Every order inserted, every third updated, every 13th deleted, by the builders."""
    o = a.orders(spark, d).select("id", "customer_id", "status")
    place = lambda key, step: num_to_lsn((key * 4 + step) * cl.LSN_STEP)
    new = F.struct("id", "customer_id", F.lit("changed").alias("status"))
    changed = o.where("id % 3 = 0").select(F.struct("id", "customer_id", "status").alias("before"), new.alias("after"))
    key, at = F.col("id"), F.timestamp_seconds("id")
    return (
        envelope.to_change_events(o, "INSERT", "orders", "id", at=at, lsn=place(key, 0), xid=key)
        .unionByName(envelope.to_change_events(
            changed, "UPDATE", "orders", "id", at=F.timestamp_seconds("after.id"), lsn=place(F.col("after.id"), 1), xid=F.col("after.id")
        ))
        .unionByName(envelope.to_change_events(o.where("id % 13 = 0"), "DELETE", "orders", "id", at=at, lsn=place(key, 2), xid=key))
    )


query(
    "built_events",
    a.with_ctes(a.ORDERS)
    + f"""SELECT CAST(id AS VARCHAR) AS entity_key, CASE step WHEN 0 THEN 'INSERT' WHEN 1 THEN 'UPDATE' ELSE 'DELETE' END AS operation,
      {cl.sql_lsn(f'(CAST(id AS HUGEINT) * 4 + step) * {cl.LSN_STEP}')} AS lsn, id AS xid, CAST(make_timestamp(id * 1000000) AS VARCHAR) AS at,
      CASE WHEN step > 0 THEN status END AS old_status, CASE step WHEN 0 THEN status WHEN 1 THEN 'changed' END AS new_status
      FROM shop_orders, (VALUES (0), (1), (2)) s(step) WHERE step = 0 OR (step = 1 AND id % 3 = 0) OR (step = 2 AND id % 13 = 0)""",
)(
    # Through the wire form and the parser and back.
    lambda spark, d: valid_events(parse_events(envelope.to_messages(_built_events(spark, d)).select("value", "topic"))).select(
        envelope.entity_key().alias("entity_key"), "operation", F.col("source.lsn").alias("lsn"),
        F.col("source.transaction_id").alias("xid"), F.col("event_timestamp").cast("string").alias("at"),
        F.get_json_object("before", "$.status").alias("old_status"), F.get_json_object("after", "$.status").alias("new_status"),
    )
)

query(
    "built_state",
    a.with_ctes(a.ORDERS)
    + "SELECT id, customer_id, CASE WHEN id % 3 = 0 THEN 'changed' ELSE status END AS status FROM shop_orders WHERE id % 13 <> 0",
)(
    lambda spark, d: changes.latest_state(_built_events(spark, d), _SOLD).drop("_lsn")
)

query(
    "registry_frames",
    a.with_ctes(a.CUSTOMERS)
    + """SELECT id, CASE WHEN id % 10 < 8 THEN id % 300 END AS schema_id,
      CASE WHEN id % 10 < 8 THEN email END AS body,
      CASE WHEN id % 10 = 8 THEN 'bad magic byte' WHEN id % 10 = 9 THEN 'too short' END AS frame_error
      FROM customers""",
)(
    lambda spark, d: split_registry_header(
        a.customers(spark, d).select(
            "id",
            F.when(F.col("id") % 10 == 9, F.unhex(F.lit("0001")))
            .otherwise(
                F.concat(
                    F.unhex(F.when(F.col("id") % 10 == 8, "01").otherwise("00")),
                    F.unhex(F.lpad(F.hex(F.col("id") % 300), 8, "0")),
                    F.col("email").cast("binary"),
                )
            )
            .alias("value"),
        )
    ).withColumn("body", F.col("body").cast("string"))
)

# ---- duplicates ---------------------------------------------------------------------

query("dedup_events", _UNIQUE + 'SELECT event_id, topic, off AS "offset" FROM uniq')(
    lambda spark, d: dedup.dedup_events(cl.parsed_log(spark, d)).select("event_id", "topic", "offset")
)

query(
    "dedup_stats",
    _BASE
    + """SELECT count(*) - count(DISTINCT event_id) AS hits, count(DISTINCT event_id) AS misses,
      count(DISTINCT event_id) AS size,
      round(100.0 * (count(*) - count(DISTINCT event_id)) / CAST(count(*) AS DOUBLE), 4) AS hit_rate_percent FROM good""",
)(lambda spark, d: dedup.dedup_stats(cl.parsed_log(spark, d)))

# ---- states -------------------------------------------------------------------------

# What the log folds to, computed from the orders themselves: the INSERT may be
# lost, and a partial or marked UPDATE then leaves columns empty.
_FOLD = """st AS (
  SELECT o.*, (o.id % 97 = 0 AND (o.id // 97) % 8 <> 2) AS lost, o.status <> 'pending' AS moved,
         CASE WHEN o.id % 3 = 0 THEN 'marked' WHEN o.id % 3 = 1 THEN 'partial' ELSE 'full' END AS image
  FROM shop_orders o),
fold AS (
  SELECT id, CASE WHEN lost AND image = 'partial' THEN NULL ELSE customer_id END AS customer_id, status,
         CASE WHEN lost AND image = 'partial' THEN NULL ELSE total_amount END AS total_amount,
         CASE WHEN lost AND image <> 'full' THEN NULL ELSE shipping_address END AS shipping_address,
         CASE WHEN lost AND image = 'partial' THEN NULL ELSE created_at END AS created_at,
         CASE WHEN moved THEN updated_at ELSE created_at END AS updated_at,
         id % 13 = 0 AS deleted, id * 4 + CASE WHEN moved THEN 1 ELSE 0 END AS seq
  FROM st WHERE moved OR NOT lost)"""

_FOLD_COLUMNS = """id, customer_id, status, CAST(total_amount AS DOUBLE) AS total_amount, shipping_address,
  CAST(created_at AS VARCHAR) AS created_at, CAST(updated_at AS VARCHAR) AS updated_at"""

query(
    "latest_state",
    a.with_ctes(a.ORDERS, _FOLD) + f"SELECT {_FOLD_COLUMNS} FROM fold WHERE NOT deleted",
)(
    lambda spark, d: plain(
        changes.latest_state(cl.order_events(spark, d), cl.ORDER_SCHEMA).drop("_lsn")
    )
)


def _halves(spark, d):
    """The unique order log cut in two at a log position, so the second half meets a replica."""
    unique = dedup.dedup_events(cl.order_events(spark, d))
    early = F.col("operation") == "INSERT"
    return unique.where(early), unique.where(~early)


def _applied(spark, d):
    first, second = _halves(spark, d)
    replica = changes.apply_changes(changes.empty_replica(spark, cl.ORDER_SCHEMA), first, cl.ORDER_SCHEMA)
    return changes.apply_changes(replica, second, cl.ORDER_SCHEMA)


query(
    "apply_changes",
    a.with_ctes(a.ORDERS, _FOLD) + f"SELECT {_FOLD_COLUMNS} FROM fold WHERE NOT deleted",
)(lambda spark, d: plain(changes.live_rows(_applied(spark, d))))

query(
    "apply_twice",
    a.with_ctes(a.ORDERS, _FOLD)
    + f"""SELECT {_FOLD_COLUMNS}, CAST(seq * {cl.LSN_STEP} AS DOUBLE) AS _lsn FROM fold WHERE NOT deleted""",
)(
    # The whole log, old changes included, is applied again on top.
    lambda spark, d: plain(
        changes.apply_changes(
            _applied(spark, d), dedup.dedup_events(cl.order_events(spark, d)), cl.ORDER_SCHEMA
        )
        .where("NOT _deleted")
        .drop("_deleted")
    )
)

query(
    "skipped_changes",
    _BASE + """SELECT 'missing key' AS reason, 'INSERT' AS operation, count(*) AS "rows"
      FROM good WHERE tbl = 'customers' HAVING count(*) > 0""",
)(
    # Customer images have no order_number, so every one of them lacks that key.
    lambda spark, d: changes.skipped_changes(
        cl.parsed_log(spark, d).where(F.col("source.table") == "customers"), key="order_number"
    )
)

def _unique_images(spark, d):
    """Unique order events with their images; written, as the series functions read their input twice."""
    unique = dedup.dedup_events(cl.order_events(spark, d))
    return swept(unique.select("event_id", "lsn_num", "operation", "before", "after"), "unique-images")


query(
    "fill_unchanged",
    _BASE
    + """SELECT event_id, CASE WHEN image = 'partial' THEN NULL ELSE shipping_address END AS shipping_address
      FROM good WHERE tbl = 'orders' AND operation = 'UPDATE'""",
)(
    lambda spark, d: changes.fill_unchanged(
        _unique_images(spark, d), ["shipping_address"], slice_steps=3 * cl.LSN_STEP
    )
    .where("operation = 'UPDATE'")
    .select("event_id", "shipping_address")
)

_ASOF = "1998-06-01 12:00:00"

query(
    "state_as_of",
    a.with_ctes(a.ORDERS)
    + f"""SELECT id, CASE WHEN moved AND updated_at <= TIMESTAMP '{_ASOF}' THEN status ELSE 'pending' END AS status
      FROM (SELECT *, id % 97 = 0 AND (id // 97) % 8 <> 2 AS lost, status <> 'pending' AS moved FROM shop_orders)
      WHERE created_at <= TIMESTAMP '{_ASOF}' AND (NOT lost OR (moved AND updated_at <= TIMESTAMP '{_ASOF}'))
        AND NOT (id % 13 = 0 AND updated_at + INTERVAL 1 HOUR <= TIMESTAMP '{_ASOF}')""",
)(
    lambda spark, d: changes.state_as_of(cl.order_events(spark, d), cl.ORDER_SCHEMA, _ASOF).select(
        "id", "status"
    )
)

query(
    "change_counts",
    _BASE + 'SELECT tbl AS "table", operation, count(*) AS events FROM good GROUP BY 1, 2',
)(lambda spark, d: changes.change_counts(cl.parsed_log(spark, d)))

query(
    "changed_columns",
    _BASE
    + """SELECT event_id, CASE WHEN id % 96 <> 0 THEN 'status,updated_at' ELSE 'status' END AS changed
      FROM good WHERE tbl = 'orders' AND operation = 'UPDATE'""",
)(
    lambda spark, d: changes.changed_columns(cl.order_events(spark, d)).select(
        "event_id", F.array_join("changed", ",").alias("changed")
    )
)

query(
    "invalid_transitions",
    _UNIQUE
    + """SELECT event_id, previous_status, status FROM (
        SELECT *, lag(status) OVER (PARTITION BY id ORDER BY lsn_num, event_id) AS previous_status
        FROM uniq WHERE tbl = 'orders' AND operation <> 'DELETE')
      WHERE previous_status IS NOT NULL AND previous_status <> status
        AND previous_status || '>' || status NOT IN ('pending>confirmed', 'confirmed>shipped', 'shipped>delivered')""",
)(
    lambda spark, d: changes.invalid_transitions(
        _unique_images(spark, d), slice_steps=3 * cl.LSN_STEP
    ).select("event_id", "previous_status", "status")
)

query(
    "orphans",
    a.with_ctes(a.ORDER_ITEMS, a.ORDERS, a.CUSTOMERS)
    + """SELECT 'order_items' AS child, order_id AS missing, count(*) AS "rows" FROM order_items
      WHERE order_id NOT IN (SELECT id FROM shop_orders) GROUP BY 2
      UNION ALL SELECT 'orders', customer_id, count(*) FROM shop_orders
      WHERE customer_id NOT IN (SELECT id FROM customers WHERE id % 9 <> 0) GROUP BY 2""",
)(
    lambda spark, d: checks.orphans(a.order_items(spark, d), a.orders(spark, d), "order_id", "id")
    .groupBy(F.lit("order_items").alias("child"), F.col("order_id").alias("missing"))
    .agg(F.count(F.lit(1)).alias("rows"))
    .unionByName(
        checks.orphans(
            a.orders(spark, d), a.customers(spark, d).where("id % 9 <> 0"), "customer_id", "id"
        )
        .groupBy(F.lit("orders").alias("child"), F.col("customer_id").alias("missing"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
)
