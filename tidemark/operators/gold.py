"""Gold marts: daily revenue, customer 360, product performance.

All aggregates run before the joins, so the joins see one row per key. Ordered
numbering of a whole table goes through ``number_rows`` (range partitions), not
through a window without partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import count_if, percent
from tidemark.functions.ordered import number_rows
from tidemark.operators.silver import as_timestamp, valid_records, whole_days

_SIZES = ("small", "medium", "large", "enterprise")


def _daily_aggregates() -> list[Column]:
    amount = F.col("total_amount")
    nothing = F.lit(0).cast("decimal(12,2)")
    return [
        F.count(F.lit(1)).alias("total_orders"),
        count_if(F.col("is_completed")).alias("completed_orders"),
        count_if(F.col("is_cancelled")).alias("cancelled_orders"),
        count_if(F.col("is_active")).alias("active_orders"),
        F.sum(amount).alias("gross_revenue"),
        F.sum(F.when(F.col("is_completed"), amount).otherwise(nothing)).alias("realized_revenue"),
        F.sum(F.when(F.col("is_cancelled"), amount).otherwise(nothing)).alias("lost_revenue"),
        F.avg(amount).alias("avg_order_value"),
        *[count_if(F.col("order_size") == size).alias(f"{size}_orders") for size in _SIZES],
        F.avg("fulfillment_hours").alias("avg_fulfillment_hours"),
    ]


def distinct_customers(stg_orders: DataFrame, *by: str, approximate: bool = False) -> DataFrame:
    """Customers per group; the approximate form keeps one small sketch per group."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return stg_orders.groupBy(*by).agg(count("customer_id").alias("unique_customers"))


def month_to_date(daily: DataFrame, value: str, alias: str) -> DataFrame:
    """Running sum of ``value`` inside each month (at most 31 rows per window)."""
    month = Window.partitionBy("order_year", "order_month").orderBy("order_date")
    return daily.withColumn(alias, F.sum(value).over(month))


def mart_daily_revenue(stg_orders: DataFrame, as_of=None, ordered: bool = True) -> DataFrame:
    """Revenue per day, newest first."""
    orders = valid_records(stg_orders)
    daily = orders.groupBy("order_date", "order_year", "order_month").agg(
        *_daily_aggregates(), F.count_distinct("customer_id").alias("unique_customers")
    )
    mart = month_to_date(daily, "gross_revenue", "mtd_revenue").select(
        "*",
        percent(F.col("completed_orders"), F.col("total_orders")).alias("completion_rate"),
        percent(F.col("cancelled_orders"), F.col("total_orders")).alias("cancellation_rate"),
        as_timestamp(as_of).alias("dbt_updated_at"),
    )
    return mart.orderBy(F.col("order_date").desc_nulls_first()) if ordered else mart


def customer_orders(stg_orders: DataFrame, as_of=None) -> DataFrame:
    """Order history per customer."""
    return stg_orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        count_if(F.col("is_completed")).alias("completed_orders"),
        count_if(F.col("is_cancelled")).alias("cancelled_orders"),
        F.sum("total_amount").alias("lifetime_revenue"),
        F.avg("total_amount").alias("avg_order_value"),
        F.max("total_amount").alias("largest_order"),
        F.min("ordered_at").alias("first_order_at"),
        F.max("ordered_at").alias("last_order_at"),
        whole_days(as_timestamp(as_of), F.max("ordered_at")).alias("days_since_last_order"),
    )


def mart_customer_360(stg_customers: DataFrame, stg_orders: DataFrame, as_of=None) -> DataFrame:
    """One row per valid customer with order history, tier and engagement."""
    history = customer_orders(valid_records(stg_orders), as_of)
    revenue, orders, idle = (
        F.col("lifetime_revenue"), F.col("total_orders"), F.col("days_since_last_order")
    )
    tier = (
        F.when(revenue.isNull() | (revenue == 0), "prospect")
        .when(revenue < 100, "bronze")
        .when(revenue < 500, "silver")
        .when(revenue < 2000, "gold")
        .otherwise("platinum")
    )
    engagement = (
        F.when(orders.isNull(), "never_ordered")
        .when(idle <= 30, "active")
        .when(idle <= 90, "at_risk")
        .when(idle <= 180, "dormant")
        .otherwise("churned")
    )
    zero = F.lit(0)
    return (
        valid_records(stg_customers)
        .join(history, "customer_id", "left")
        .select(
            "customer_id",
            "email",
            "first_name",
            "last_name",
            "full_name",
            F.col("phone_normalized").alias("phone"),
            F.col("created_at").alias("customer_since"),
            "account_age_days",
            F.coalesce(orders, zero).alias("total_orders"),
            F.coalesce("completed_orders", zero).alias("completed_orders"),
            F.coalesce("cancelled_orders", zero).alias("cancelled_orders"),
            F.coalesce(revenue, zero).alias("lifetime_revenue"),
            F.coalesce("avg_order_value", zero).alias("avg_order_value"),
            "largest_order",
            "first_order_at",
            "last_order_at",
            F.coalesce(idle, F.col("account_age_days")).alias("days_since_last_order"),
            tier.alias("customer_tier"),
            engagement.alias("engagement_status"),
            (F.coalesce(orders, zero) > 1).alias("is_repeat_customer"),
            (F.coalesce(revenue, zero) >= 500).alias("is_high_value"),
            as_timestamp(as_of).alias("dbt_updated_at"),
        )
    )


def completed_sales(stg_order_items: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """Items of delivered orders."""
    delivered = valid_records(stg_orders).where("is_completed").select(
        "order_id", "ordered_at", "order_date"
    )
    items = valid_records(stg_order_items).select(
        "order_id", "product_id", "quantity", "unit_price", "line_total"
    )
    return items.join(delivered, "order_id")


def product_sales(sales: DataFrame, as_of=None) -> DataFrame:
    """Sales per product, with the trailing 30 days apart."""
    today = F.to_date(as_timestamp(as_of))
    recent = F.col("order_date") >= F.date_sub(today, 30)
    return sales.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("times_ordered"),
        F.sum("quantity").alias("total_units_sold"),
        F.sum("line_total").alias("total_revenue"),
        F.avg("line_total").alias("avg_sale_amount"),
        F.avg("unit_price").alias("avg_selling_price"),
        F.min("unit_price").alias("min_selling_price"),
        F.max("unit_price").alias("max_selling_price"),
        F.min("ordered_at").alias("first_sale_at"),
        F.max("ordered_at").alias("last_sale_at"),
        F.sum(F.when(recent, F.col("quantity")).otherwise(0)).alias("units_sold_last_30_days"),
        F.sum(F.when(recent, F.col("line_total")).otherwise(0)).alias("revenue_last_30_days"),
    )


def product_performance(
    stg_products: DataFrame, stg_order_items: DataFrame, stg_orders: DataFrame, as_of=None
) -> DataFrame:
    """The product mart without ranks."""
    sales = product_sales(completed_sales(stg_order_items, stg_orders), as_of)
    stock, recent = F.col("stock_qty"), F.col("units_sold_last_30_days")
    zero = F.lit(0)
    sold_lately = F.coalesce(recent, zero) > 0
    today = F.to_date(as_timestamp(as_of))
    days_left = F.round(
        (stock * 30).cast("decimal(18,0)") / F.nullif(recent, F.lit(0).cast("bigint")).cast("decimal(18,0)"), 0
    )
    velocity = (
        F.when(F.col("total_units_sold").isNull(), "no_sales")
        .when(recent >= 10, "bestseller")
        .when(recent >= 3, "steady")
        .when(F.col("last_sale_at") < F.date_sub(today, 60).cast("timestamp"), "slow_mover")
        .otherwise("moderate")
    )
    alert = (
        F.when(stock <= 0, "critical_out_of_stock")
        .when((stock < 5) & sold_lately, "reorder_urgent")
        .when(stock < 20, "reorder_soon")
        .otherwise("adequate")
    )
    return (
        valid_records(stg_products)
        .join(sales, "product_id", "left")
        .select(
            "product_id",
            "product_name",
            "category",
            "description",
            F.col("price").alias("current_price"),
            "price_tier",
            "stock_qty",
            "stock_status",
            "is_out_of_stock",
            F.coalesce("times_ordered", zero).alias("times_ordered"),
            F.coalesce("total_units_sold", zero).alias("total_units_sold"),
            F.coalesce("total_revenue", zero).alias("total_revenue"),
            "avg_sale_amount",
            "avg_selling_price",
            "first_sale_at",
            "last_sale_at",
            F.coalesce(recent, zero).alias("units_sold_last_30_days"),
            F.coalesce("revenue_last_30_days", zero).alias("revenue_last_30_days"),
            F.when(sold_lately, days_left).cast("bigint").alias("days_of_stock_remaining"),
            velocity.alias("sales_velocity"),
            alert.alias("inventory_alert"),
        )
    )


def mart_product_performance(
    stg_products: DataFrame, stg_order_items: DataFrame, stg_orders: DataFrame, as_of=None
) -> DataFrame:
    """Product sales, stock outlook and revenue ranks; equal revenue ranks by product id."""
    performance = product_performance(stg_products, stg_order_items, stg_orders, as_of)
    by_revenue = [F.col("total_revenue").desc_nulls_first(), F.col("product_id").asc()]
    ranked = number_rows(performance, by_revenue, "revenue_rank")
    ranked = number_rows(ranked, by_revenue, "category_rank", keys=["category"])
    return ranked.withColumn("dbt_updated_at", as_timestamp(as_of))


def top_products(performance: DataFrame, k: int) -> DataFrame:
    """The ``k`` best sellers overall (a bounded heap per task, no global sort)."""
    return performance.orderBy(
        F.col("total_revenue").desc_nulls_first(), F.col("product_id").asc()
    ).limit(k)


def top_products_by_category(performance: DataFrame, k: int) -> DataFrame:
    """The ``k`` best sellers per category.

    The rank filter lets Spark cut every map task to ``k`` rows per category
    before the shuffle, so a large category stays small in its reducer.
    """
    rank = F.row_number().over(
        Window.partitionBy("category").orderBy(
            F.col("total_revenue").desc_nulls_first(), F.col("product_id").asc()
        )
    )
    return performance.withColumn("category_rank", rank).where(F.col("category_rank") <= k)
