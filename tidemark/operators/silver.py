"""Silver projections: cleaned, typed and flagged views of the source tables.

Each function is one narrow projection, so scans keep column pruning and filter
pushdown. Null values fall into the last bucket of every banding, as in plain
``CASE`` semantics; such rows are mostly flagged invalid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Order status -> category; anything else is 'unknown'.
STATUS_CATEGORY = {
    "pending": "open",
    "confirmed": "open",
    "shipped": "in_transit",
    "delivered": "completed",
    "cancelled": "cancelled",
}


def as_timestamp(as_of) -> Column:
    """``as_of`` as a timestamp column; ``None`` means now."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole days from ``earlier`` to ``later``, truncated towards zero."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    days = micros.cast("decimal(20,0)") / F.lit(86_400_000_000).cast("decimal(11,0)")
    return days.cast("bigint")


def _banded(value: Column, bands: list[tuple[Column, str]], top: str) -> Column:
    (first, label), *rest = bands
    banded = F.when(first, label)
    for test, label in rest:
        banded = banded.when(test, label)
    return banded.otherwise(top)


def _present(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def stg_customers(customers: DataFrame, as_of=None) -> DataFrame:
    """Trimmed names, lower-case e-mail, normalized phone, account age, validity."""
    first, last = F.trim("first_name"), F.trim("last_name")
    return customers.where(F.col("id").isNotNull()).select(
        F.col("id").alias("customer_id"),
        F.lower(F.trim("email")).alias("email"),
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat(first, F.lit(" "), last).alias("full_name"),
        F.regexp_replace("phone", "[^0-9+]", "").alias("phone_normalized"),
        F.col("phone").alias("phone_original"),
        "created_at",
        "updated_at",
        whole_days(as_timestamp(as_of), F.col("created_at")).alias("account_age_days"),
        F.coalesce(_present(F.col("email")) & _present(F.col("first_name")), F.lit(False)).alias(
            "is_valid_record"
        ),
    )


def stg_products(products: DataFrame) -> DataFrame:
    """Price tier, stock status and validity per product."""
    price, stock = F.col("price"), F.col("stock_qty")
    return products.where(F.col("id").isNotNull()).select(
        F.col("id").alias("product_id"),
        F.trim("name").alias("product_name"),
        F.trim("category").alias("category"),
        F.coalesce(F.trim("description"), F.lit("No description")).alias("description"),
        "price",
        _banded(
            price, [(price < 25, "budget"), (price < 100, "mid-range"), (price < 500, "premium")], "luxury"
        ).alias("price_tier"),
        "stock_qty",
        _banded(
            stock,
            [(stock <= 0, "out_of_stock"), (stock < 10, "low_stock"), (stock < 50, "normal")],
            "high_stock",
        ).alias("stock_status"),
        (stock <= 0).alias("is_out_of_stock"),
        "created_at",
        "updated_at",
        F.coalesce(_present(F.col("name")) & (price > 0), F.lit(False)).alias("is_valid_record"),
    )


def stg_orders(orders: DataFrame) -> DataFrame:
    """Status category and flags, size band, calendar parts, fulfilment time, validity."""
    status, amount, placed = F.lower("status"), F.col("total_amount"), F.col("created_at")
    address = F.col("shipping_address")
    category = F.lit("unknown")
    for name, group in STATUS_CATEGORY.items():
        category = F.when(status == name, group).otherwise(category)
    took = (F.unix_micros("updated_at") - F.unix_micros(placed)).cast("double") / F.lit(3.6e9)
    return orders.where(F.col("id").isNotNull()).select(
        F.col("id").alias("order_id"),
        "customer_id",
        status.alias("status"),
        category.alias("status_category"),
        status.isin("pending", "confirmed", "shipped").alias("is_active"),
        (status == "delivered").alias("is_completed"),
        (status == "cancelled").alias("is_cancelled"),
        "total_amount",
        _banded(
            amount, [(amount < 50, "small"), (amount < 200, "medium"), (amount < 500, "large")], "enterprise"
        ).alias("order_size"),
        F.coalesce(F.trim(address), F.lit("Not provided")).alias("shipping_address"),
        _present(address).alias("has_shipping_address"),
        placed.alias("ordered_at"),
        "updated_at",
        F.to_date(placed).alias("order_date"),
        F.year(placed).alias("order_year"),
        F.month(placed).alias("order_month"),
        # Sunday is 0 here; Spark counts it as 1.
        (F.dayofweek(placed) - 1).alias("order_day_of_week"),
        F.hour(placed).alias("order_hour"),
        F.when(status == "delivered", took).alias("fulfillment_hours"),
        F.coalesce(F.col("customer_id").isNotNull() & (amount >= 0), F.lit(False)).alias("is_valid_record"),
    )


def stg_order_items(order_items: DataFrame) -> DataFrame:
    """Line totals, quantity band and validity."""
    quantity, price = F.col("quantity"), F.col("unit_price")
    return order_items.where(F.col("id").isNotNull()).select(
        F.col("id").alias("order_item_id"),
        "order_id",
        "product_id",
        "quantity",
        "unit_price",
        (quantity * price).alias("line_total"),
        _banded(
            quantity,
            [(quantity == 1, "single"), (quantity <= 3, "small_batch"), (quantity <= 10, "medium_batch")],
            "bulk",
        ).alias("quantity_bucket"),
        "created_at",
        F.coalesce(
            F.col("order_id").isNotNull()
            & F.col("product_id").isNotNull()
            & (quantity > 0)
            & (price > 0),
            F.lit(False),
        ).alias("is_valid_record"),
    )


def valid_records(staged: DataFrame) -> DataFrame:
    """Only rows the staging view marked as valid."""
    return staged.where("is_valid_record")
