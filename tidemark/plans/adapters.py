"""Business tables, change log, metrics and audit rows derived from the given tables.

Every adapter exists twice: as a DataFrame and as the SQL the checks use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The moments the time-relative operators are evaluated at.
AS_OF = "2001-08-05 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table; zone-less timestamps are read as UTC instants."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.selectExpr(
        "c_custkey AS id",
        """CASE WHEN c_custkey % 50 = 0 THEN ''
                WHEN c_custkey % 7 = 0 THEN concat('  ', upper(replace(c_name, '#', '.')), '@EXAMPLE.COM ')
                ELSE concat(lower(replace(c_name, '#', '.')), '@example.com') END AS email""",
        "c_mktsegment AS first_name",
        "c_name AS last_name",
        "concat('+1-555-', lpad(cast(c_custkey AS string), 7, '0')) AS phone",
        "timestamp'1995-01-01 00:00:00' + make_dt_interval(cast(c_custkey % 1000 AS int)) AS created_at",
        "timestamp'1995-01-01 00:00:00' + make_dt_interval(cast(c_custkey % 1000 AS int)) AS updated_at",
    )


CUSTOMERS = """customers AS (
  SELECT c_custkey AS id,
         CASE WHEN c_custkey % 50 = 0 THEN ''
              WHEN c_custkey % 7 = 0 THEN '  ' || upper(replace(c_name, '#', '.')) || '@EXAMPLE.COM '
              ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
         c_mktsegment AS first_name, c_name AS last_name,
         '+1-555-' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS phone,
         TIMESTAMP '1995-01-01 00:00:00' + CAST(c_custkey % 1000 AS INTEGER) * INTERVAL 1 DAY AS created_at,
         TIMESTAMP '1995-01-01 00:00:00' + CAST(c_custkey % 1000 AS INTEGER) * INTERVAL 1 DAY AS updated_at
  FROM customer)"""


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.selectExpr(
        "p_partkey AS id",
        "p_name AS name",
        "p_type AS category",
        "cast((cast(round(p_retailprice * 100) AS bigint) - 89000) * 0.01BD AS decimal(10,2)) AS price",
        "p_size * 2 - 10 AS stock_qty",
        "CASE WHEN p_partkey % 3 <> 0 THEN p_brand END AS description",
        "timestamp'1995-01-01 00:00:00' AS created_at",
        "timestamp'1995-01-01 00:00:00' AS updated_at",
    )


PRODUCTS = """products AS (
  SELECT p_partkey AS id, p_name AS name, p_type AS category,
         CAST((CAST(round(p_retailprice * 100) AS BIGINT) - 89000) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS price,
         p_size * 2 - 10 AS stock_qty,
         CASE WHEN p_partkey % 3 <> 0 THEN p_brand END AS description,
         TIMESTAMP '1995-01-01 00:00:00' AS created_at,
         TIMESTAMP '1995-01-01 00:00:00' AS updated_at
  FROM part)"""

_DIVISOR = "CASE o_custkey % 4 WHEN 0 THEN 25000 WHEN 1 THEN 5000 ELSE 500 END"


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.selectExpr(
        "o_orderkey AS id",
        # Every tenth customer never orders; the next one has their orders.
        "CASE WHEN o_custkey % 10 = 0 THEN o_custkey + 1 ELSE o_custkey END AS customer_id",
        """CASE WHEN o_orderkey % 11 = 0 THEN 'cancelled'
                WHEN o_orderstatus = 'P' THEN 'pending'
                WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'delivered' END AS status""",
        f"cast((cast(round(o_totalprice * 100) AS bigint) div ({_DIVISOR})) * 0.01BD AS decimal(12,2)) AS total_amount",
        "CASE WHEN o_orderkey % 5 <> 0 THEN concat(' ', cast(o_orderkey AS string), ' Main Street ') END"
        " AS shipping_address",
        "o_orderdate AS created_at",
        "o_orderdate + make_dt_interval(0, cast(o_orderkey % 96 AS int)) AS updated_at",
    )


ORDERS = f"""shop_orders AS (
  SELECT o_orderkey AS id, CASE WHEN o_custkey % 10 = 0 THEN o_custkey + 1 ELSE o_custkey END AS customer_id,
         CASE WHEN o_orderkey % 11 = 0 THEN 'cancelled'
              WHEN o_orderstatus = 'P' THEN 'pending'
              WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'delivered' END AS status,
         CAST((CAST(round(o_totalprice * 100) AS BIGINT) // ({_DIVISOR})) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS total_amount,
         CASE WHEN o_orderkey % 5 <> 0 THEN ' ' || CAST(o_orderkey AS VARCHAR) || ' Main Street ' END AS shipping_address,
         o_orderdate AS created_at,
         o_orderdate + CAST(o_orderkey % 96 AS INTEGER) * INTERVAL 1 HOUR AS updated_at
  FROM orders)"""


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.selectExpr(
        "l_orderkey * 10 + l_linenumber AS id",
        "l_orderkey AS order_id",
        "l_partkey AS product_id",
        "cast(l_quantity AS int) AS quantity",
        """cast((cast(round(l_extendedprice * 100) AS bigint) div cast(l_quantity * 100 AS bigint))
                * 0.01BD AS decimal(10,2)) AS unit_price""",
        "l_shipdate AS created_at",
    )


ORDER_ITEMS = """order_items AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST((CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity * 100 AS BIGINT))
              * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS unit_price,
         l_shipdate AS created_at
  FROM lineitem)"""


def with_ctes(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"
