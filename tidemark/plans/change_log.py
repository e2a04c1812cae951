"""The change log derived from orders and customers, as wire messages and as SQL.

Per order: INSERT (pending), UPDATE to the final status, DELETE for every 13th;
every 17th INSERT is sent twice and every 97th is damaged in one of eight ways.
Customers contribute one INSERT each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.lsn import num_to_lsn
from tidemark.plans import adapters as a
from tidemark.session import scratch_path, spread
from tidemark.sources.events import parse_events, read_events, uuid_from, valid_events

ORDER_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("total_amount", T.DecimalType(12, 2)),
        T.StructField("shipping_address", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

# Fixed value: log positions per step of the derived log.
LSN_STEP = 1048576


def _json(*columns) -> F.Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def order_changes(spark, d) -> DataFrame:
    """One row per change of an order, before it is encoded."""
    o = spread(a.orders(spark, d))
    steps = F.array_compact(
        F.array(
            F.lit(0),
            F.when(F.col("status") != "pending", F.lit(1)),
            F.when(F.col("id") % 13 == 0, F.lit(2)),
        )
    )
    rows = o.withColumn("step", F.explode(steps))
    final = F.when((F.col("step") >= 1), F.col("status")).otherwise(F.lit("pending"))
    address = F.col("shipping_address")
    base = [F.col("id"), F.col("customer_id")]
    rest = [F.col("total_amount")]
    times = [F.col("created_at"), F.col("updated_at")]
    inserted = _json(*base, F.lit("pending").alias("status"), *rest, address.alias("shipping_address"),
                     F.col("created_at"), F.col("created_at").alias("updated_at"))
    full = _json(*base, final.alias("status"), *rest, address.alias("shipping_address"), *times)
    marked = _json(*base, final.alias("status"), *rest,
                   F.lit("__unchanged__").alias("shipping_address"), *times)
    partial = _json(F.col("id"), final.alias("status"), F.col("updated_at"))
    updated = F.when(F.col("id") % 3 == 0, marked).when(F.col("id") % 3 == 1, partial).otherwise(full)
    step = F.col("step")
    return rows.select(
        F.lit("orders").alias("table"),
        "id",
        "step",
        F.when(step == 0, "INSERT").when(step == 1, "UPDATE").otherwise("DELETE").alias("operation"),
        (F.col("id") * 4 + step).alias("seq"),
        F.expr("id div 5").alias("xid"),
        (F.when(step == 0, F.col("created_at")).when(step == 1, F.col("updated_at"))
         .otherwise(F.col("updated_at") + F.expr("interval 1 hour"))).alias("ts"),
        F.when(step == 0, F.lit(None)).when(step == 1, inserted).otherwise(full).alias("before"),
        F.when(step == 0, inserted).when(step == 1, updated).alias("after"),
        F.concat(F.col("id").cast("string"), F.lit(":"), step.cast("string")).alias("name"),
        F.when((step == 0) & (F.col("id") % 97 == 0), F.expr("(id div 97) % 8")).alias("damage"),
        F.when((step == 0) & (F.col("id") % 17 == 0), 2).otherwise(1).alias("copies"),
    )


def customer_changes(spark, d) -> DataFrame:
    c = spread(a.customers(spark, d))
    after = _json("id", "email", "first_name", "last_name", "phone", "created_at", "updated_at")
    return c.select(
        F.lit("customers").alias("table"),
        "id",
        F.lit(0).alias("step"),
        F.lit("INSERT").alias("operation"),
        (F.col("id") * 4 + 3).alias("seq"),
        F.expr("1000000000 + id div 5").alias("xid"),
        F.col("created_at").alias("ts"),
        F.lit(None).cast("string").alias("before"),
        after.alias("after"),
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("name"),
        F.lit(None).cast("bigint").alias("damage"),
        F.lit(1).alias("copies"),
    )


_STORED: dict[tuple[str, str], str] = {}


def stored_log(spark, d) -> str:
    """Folder with the wire messages, written once per application and input folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _STORED:
        path = scratch_path(spark, "raw-log")
        raw_log(spark, d).write.parquet(path)
        _STORED[key] = path
    return _STORED[key]


def raw_log(spark, d) -> DataFrame:
    """Wire messages with topic, partition and offset, as a source would hold them."""
    rows = order_changes(spark, d).unionByName(customer_changes(spark, d)).withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))
    )
    damage = F.col("damage")
    missing = {"ignoreNullFields": "true"}

    def envelope(event_id, operation, source):
        nulls = F.struct(
            event_id.alias("event_id"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_timestamp"),
            operation.alias("operation"),
            source.alias("source"),
            F.parse_json("before").alias("before"),
            F.parse_json("after").alias("after"),
        )
        return F.to_json(nulls, missing)

    source = F.struct(
        F.lit("source_db").alias("database"),
        F.lit("public").alias("schema"),
        F.col("table"),
        F.col("xid").alias("transaction_id"),
        num_to_lsn(F.col("seq") * LSN_STEP).alias("lsn"),
    )
    no_id, no_source = F.lit(None).cast("string"), F.lit(None).cast("struct<database:string>")
    event_id, operation = uuid_from(F.col("name")), F.col("operation")
    good = envelope(event_id, operation, source)
    text = (
        F.when(damage.isNull(), good)
        .when(damage == 0, "")
        .when(damage == 1, F.concat(F.lit("{invalid json"), F.repeat(F.lit("x"), 600)))
        .when(damage == 2, envelope(no_id, operation, source))
        .when(damage == 3, envelope(event_id, F.lit("UPSERT"), source))
        .when(damage == 4, '"just text"')
        .when(damage == 5, envelope(event_id, operation, no_source))
    )
    value = F.when(damage == 7, F.unhex(F.lit("00FF807FABCD"))).otherwise(text.cast("binary"))
    return rows.select(
        value.alias("value"),
        F.concat(F.lit("cdc.source_db.public."), F.col("table")).alias("topic"),
        (F.col("id") % 3).cast("int").alias("partition"),
        (F.expr("id div 3") * 8 + F.col("step") * 2 + F.col("copy")).alias("offset"),
    )


def raw_events(spark, d) -> DataFrame:
    """The stored wire messages."""
    return read_events(spark, stored_log(spark, d))


def parsed_log(spark, d) -> DataFrame:
    """Valid parsed events of the log, duplicates included."""
    return valid_events(parse_events(raw_events(spark, d)))


def order_events(spark, d) -> DataFrame:
    """Valid parsed order events, duplicates included."""
    return parsed_log(spark, d).where(F.col("source")["table"] == "orders")


def _uuid(text: str) -> str:
    m = f"md5({text})"
    return (
        f"substr({m},1,8) || '-' || substr({m},9,4) || '-' || substr({m},13,4) || '-' || "
        f"substr({m},17,4) || '-' || substr({m},21,12)"
    )


def sql_lsn(num: str) -> str:
    return (
        f"printf('%X', CAST(({num}) // 4294967296 AS BIGINT)) || '/' || "
        f"printf('%08X', CAST(({num}) % 4294967296 AS BIGINT))"
    )


# The same log for the checks: one row per message with its decoded content.
LOG = f"""log0 AS (
  SELECT 'orders' AS tbl, o.id, s.step, CASE s.step WHEN 0 THEN 'INSERT' WHEN 1 THEN 'UPDATE' ELSE 'DELETE' END AS operation,
         o.id * 4 + s.step AS seq, o.id // 5 AS xid,
         CASE s.step WHEN 0 THEN created_at WHEN 1 THEN updated_at ELSE updated_at + INTERVAL 1 HOUR END AS ts,
         CAST(o.id AS VARCHAR) || ':' || CAST(s.step AS VARCHAR) AS name,
         CASE WHEN s.step = 0 AND o.id % 97 = 0 THEN (o.id // 97) % 8 END AS damage,
         CASE WHEN s.step = 0 AND o.id % 17 = 0 THEN 2 ELSE 1 END AS copies,
         customer_id, CASE WHEN s.step = 0 THEN 'pending' ELSE status END AS status, total_amount,
         shipping_address, created_at, CASE WHEN s.step = 0 THEN created_at ELSE updated_at END AS updated_at,
         CASE WHEN s.step <> 1 THEN 'full' WHEN o.id % 3 = 0 THEN 'marked' WHEN o.id % 3 = 1 THEN 'partial' ELSE 'full' END AS image,
         CAST(NULL AS VARCHAR) AS email
  FROM shop_orders o, (VALUES (0), (1), (2)) s(step)
  WHERE s.step = 0 OR (s.step = 1 AND o.status <> 'pending') OR (s.step = 2 AND o.id % 13 = 0)
  UNION ALL
  SELECT 'customers', id, 0, 'INSERT', id * 4 + 3, 1000000000 + id // 5, created_at, 'c' || CAST(id AS VARCHAR),
         NULL, 1, NULL, NULL, NULL, NULL, created_at, updated_at, 'full', email
  FROM customers),
log AS (
  SELECT l.*, c.copy, 'cdc.source_db.public.' || tbl AS topic, CAST(id % 3 AS INTEGER) AS part,
         (id // 3) * 8 + step * 2 + c.copy AS off,
         CASE WHEN damage = 2 THEN NULL ELSE {_uuid('name')} END AS sent_id,
         {sql_lsn(f'seq * {LSN_STEP}')} AS lsn, CAST(seq AS HUGEINT) * {LSN_STEP} AS lsn_num
  FROM log0 l, (VALUES (0), (1)) c(copy) WHERE c.copy < l.copies),
good AS (
  SELECT *, coalesce(sent_id, {_uuid("topic || ':' || CAST(part AS VARCHAR) || ':' || CAST(off AS VARCHAR)")}) AS event_id
  FROM log WHERE damage IS NULL OR damage = 2)"""

# First arrivals only.
UNIQUE = """uniq AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY topic, part, off) AS nth FROM good)
  WHERE nth = 1)"""

LOG_CTES = (a.CUSTOMERS, a.ORDERS, LOG)
