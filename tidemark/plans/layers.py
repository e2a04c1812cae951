"""Silver views and Gold tables in dependency order, tested before they are published.

Marts are built into a folder of their own per build, tested there, and published by one small
file that names the build. Readers follow the newest such file, so they see all marts of one
build or all of the one before, and a build whose tests fail leaves nothing but its folder.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import checks, gold, silver

# What the marts' labels may be.
TIERS = ("prospect", "bronze", "silver", "gold", "platinum")
ENGAGEMENT = ("never_ordered", "active", "at_risk", "dormant", "churned")
VELOCITY = ("no_sales", "bestseller", "steady", "slow_mover", "moderate")
STOCK_ALERTS = ("critical_out_of_stock", "reorder_urgent", "reorder_soon", "adequate")

Test = tuple[str, str, Callable[[DataFrame], DataFrame]]


class LayerTestError(Exception):
    """A layer holds rows that fail its tests; ``failures`` has the count per test."""

    def __init__(self, failures: Mapping[str, int]):
        super().__init__("; ".join(f"{label}: {n} failing values" for label, n in failures.items()))
        self.failures = dict(failures)


def _key(table: str, column: str) -> list[Test]:
    return [
        (table, f"{column} unique", lambda df: checks.test_unique(df, column)),
        (table, f"{column} not null", lambda df: checks.test_not_null(df, column)),
    ]


def _accepted(table: str, column: str, values) -> Test:
    return table, f"{column} accepted", lambda df: checks.test_accepted(df, column, list(values))


VIEW_TESTS: list[Test] = [
    *_key("stg_customers", "customer_id"),
    *_key("stg_products", "product_id"),
    *_key("stg_orders", "order_id"),
    ("stg_order_items", "order_item_id not null", lambda df: checks.test_not_null(df, "order_item_id")),
    _accepted("stg_orders", "status_category", [*set(silver.STATUS_CATEGORY.values()), "unknown"]),
]
MART_TESTS: list[Test] = [
    *_key("mart_daily_revenue", "order_date"),
    *_key("mart_customer_360", "customer_id"),
    _accepted("mart_customer_360", "customer_tier", TIERS),
    _accepted("mart_customer_360", "engagement_status", ENGAGEMENT),
    *_key("mart_product_performance", "product_id"),
    _accepted("mart_product_performance", "sales_velocity", VELOCITY),
    _accepted("mart_product_performance", "inventory_alert", STOCK_ALERTS),
]


def staging_views(sources: Mapping[str, DataFrame], as_of=None) -> dict[str, DataFrame]:
    """The staging views over customers, products, orders and order_items."""
    return {
        "stg_customers": silver.stg_customers(sources["customers"], as_of),
        "stg_products": silver.stg_products(sources["products"]),
        "stg_orders": silver.stg_orders(sources["orders"]),
        "stg_order_items": silver.stg_order_items(sources["order_items"]),
    }


def mart_tables(views: Mapping[str, DataFrame], as_of=None) -> dict[str, DataFrame]:
    """The marts over the staging views."""
    return {
        "mart_daily_revenue": gold.mart_daily_revenue(views["stg_orders"], as_of),
        "mart_customer_360": gold.mart_customer_360(views["stg_customers"], views["stg_orders"], as_of),
        "mart_product_performance": gold.mart_product_performance(
            views["stg_products"], views["stg_order_items"], views["stg_orders"], as_of
        ),
    }


def failing(tables: Mapping[str, DataFrame], tests: list[Test]) -> dict[str, int]:
    """Number of failing values of each test that has any."""
    found = {f"{table}.{label}": test(tables[table]).count() for table, label, test in tests}
    return {label: n for label, n in found.items() if n}


def published_build(spark: SparkSession, out: str) -> int | None:
    """The newest published build below ``out``; None before the first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/published")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema("build bigint").parquet(f"{out}/published").agg(F.max("build").alias("b")).first()["b"]


def read_marts(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The marts of the newest published build."""
    build = published_build(spark, out)
    if build is None:
        return {}
    return {name: spark.read.parquet(f"{out}/builds/{build}/{name}") for name in dict.fromkeys(t for t, _, _ in MART_TESTS)}


def build_layers(
    spark: SparkSession, sources: Mapping[str, DataFrame], out: str, as_of=None,
    marts: Callable[[Mapping[str, DataFrame], object], Mapping[str, DataFrame]] = mart_tables,
) -> dict[str, DataFrame]:
    """Test the staging views, build the marts beside the live ones, test them, then publish all at once.

    Raises ``LayerTestError`` with every failing test; the live marts then stay as they are. A build
    that was not published is overwritten by the next one, which gets the same number.
    """
    views = staging_views(sources, as_of)
    if found := failing(views, VIEW_TESTS):
        raise LayerTestError(found)
    build = (published_build(spark, out) or 0) + 1
    stored = {}
    for name, df in marts(views, as_of).items():
        path = f"{out}/builds/{build}/{name}"
        df.write.mode("overwrite").parquet(path)
        stored[name] = spark.read.parquet(path)
    if found := failing(stored, MART_TESTS):
        raise LayerTestError(found)
    # One row in one file: the folder's newest build is what readers see.
    spark.range(1).select(F.lit(build).cast("bigint").alias("build")).coalesce(1).write.mode("append").parquet(f"{out}/published")
    for name, df in {**views, **stored}.items():
        df.createOrReplaceTempView(name)
    return {**views, **stored}
