"""The layer build: published marts, and a build that fails its tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import adapters as a
from tidemark.plans import layers, shop_queries  # noqa: F401  (shop_queries fills ORACLES)
from tidemark.plans.registry import ORACLES, query
from tidemark.session import scratch_path


def _layers_roundtrip(spark, d):
    """Labels of the live marts after one good build and one whose tiers are wrong, and what the second one failed."""
    out = scratch_path(spark, "layers")
    sources = {"customers": a.customers(spark, d), "products": a.products(spark, d), "orders": a.orders(spark, d),
               "order_items": a.order_items(spark, d)}
    layers.build_layers(spark, sources, out, a.AS_OF)

    def wrong(views, as_of):
        made = layers.mart_tables(views, as_of)
        return {**made, "mart_customer_360": made["mart_customer_360"].withColumn("customer_tier", F.lit("unheard of"))}

    failures = {}
    try:
        layers.build_layers(spark, sources, out, a.AS_OF, wrong)
    except layers.LayerTestError as refused:
        failures = refused.failures
    live = layers.read_marts(spark, out)
    label = lambda mart, column: live[mart].groupBy(F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(mart).alias("part"), "label", "n"
    )
    parts = label("mart_customer_360", "customer_tier").unionByName(label("mart_product_performance", "inventory_alert"))
    refusals = spark.createDataFrame(list(failures.items()), "label string, n bigint").select(F.lit("refused").alias("part"), "label", "n")
    return parts.unionByName(refusals)


query(
    "layers_roundtrip",
    f"""SELECT 'mart_customer_360' AS part, customer_tier AS label, count(*) AS n FROM ({ORACLES['mart_customer_360']}) GROUP BY 2
      UNION ALL SELECT 'mart_product_performance', inventory_alert, count(*) FROM ({ORACLES['mart_product_performance']}) GROUP BY 2
      UNION ALL SELECT 'refused', 'mart_customer_360.customer_tier accepted', 1""",
)(_layers_roundtrip)
