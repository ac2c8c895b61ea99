"""Further per-customer features: rates, diversity, timing, basket size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientela.functions.columns import elapsed_days, micros, snapshot
from clientela.functions.skew import spread_join
from clientela.session import materialise

PURCHASED = "order_purchase_timestamp"
CANCELED_STATUSES = ["canceled", "returned"]
HOUR_MICROS = 3_600_000_000.0


def _ratio(top, bottom):
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def _known(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull())


def purchase_rate(transactions: DataFrame, snapshot_date: str, key: str = "customer_id") -> DataFrame:
    """Orders per day since the first purchase; null on day 0."""
    grouped = _known(transactions, key).groupBy(key).agg(
        F.count_distinct("order_id").alias("orders"), F.min(PURCHASED).alias("_first")
    )
    days = elapsed_days(snapshot(snapshot_date), F.col("_first"))
    return grouped.select(
        key,
        "orders",
        days.alias("days_since_first"),
        _ratio(F.col("orders"), days).alias("purchase_rate"),
    )


def payment_types(payments: DataFrame, orders: DataFrame, key: str = "customer_id") -> DataFrame:
    """Distinct payment types used. Repeats within an order vanish before the join."""
    used = payments.select("order_id", "payment_type").distinct()
    return (
        _known(orders.select("order_id", key), key)
        .join(used, "order_id")
        .groupBy(key)
        .agg(F.count_distinct("payment_type").alias("payment_types"))
    )


def states_shipped(orders: DataFrame, customers: DataFrame, key: str = "customer_unique_id") -> DataFrame:
    """Distinct states with an order. Each buyer id reaches the join once."""
    buyers = orders.select("customer_id").distinct()
    return (
        _known(customers, key)
        .join(buyers, "customer_id", "left_semi")
        .groupBy(key)
        .agg(F.count_distinct("customer_state").alias("states_shipped"))
    )


def product_categories(transactions: DataFrame, products: DataFrame, key: str = "customer_id") -> DataFrame:
    """Distinct product categories bought; popular products are spread over tasks.

    The distinct customer-product pairs are written first: the spread join reads its
    large side twice and needs its rows in a fixed order.
    """
    pairs = _known(transactions, key).select(key, "product_id").distinct()
    bought = materialise(pairs, "bought-products")
    categories = products.select("product_id", "product_category_name").distinct()
    return (
        spread_join(bought, categories, "product_id", "inner")
        .groupBy(key)
        .agg(F.count_distinct("product_category_name").alias("product_categories"))
    )


def weekend_ratio(orders: DataFrame, key: str = "customer_id") -> DataFrame:
    """Weekend orders, weekday orders and their ratio (null without weekday orders)."""
    weekend = F.dayofweek(PURCHASED).isin(1, 7)
    return (
        _known(orders, key)
        .groupBy(key)
        .agg(
            F.count_if(weekend).alias("weekend_orders"), F.count_if(~weekend).alias("weekday_orders")
        )
        .withColumn("weekend_ratio", _ratio(F.col("weekend_orders"), F.col("weekday_orders")))
    )


def cancel_ratio(orders_raw: DataFrame, key: str = "customer_id") -> DataFrame:
    """Share of cancelled or returned orders, over orders of every status."""
    cancelled = F.coalesce(F.col("order_status").isin(CANCELED_STATUSES), F.lit(False))
    return (
        _known(orders_raw, key)
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("orders"), F.avg(cancelled.cast("int")).alias("cancel_ratio"))
    )


def approval_delay(orders: DataFrame, key: str = "customer_id") -> DataFrame:
    """Mean hours from purchase to payment approval, unapproved orders left out."""
    delay = micros("order_approved_at") - micros(PURCHASED)
    return (
        _known(orders, key)
        .groupBy(key)
        .agg((_ratio(F.sum(delay), F.count(delay)) / HOUR_MICROS).alias("approval_hours"))
    )


def basket_size(transactions: DataFrame, key: str = "customer_id") -> DataFrame:
    """Mean items per order, through one row per order."""
    per_order = _known(transactions, key).groupBy(key, "order_id").agg(
        F.count(F.lit(1)).alias("_items")
    )
    return per_order.groupBy(key).agg(
        _ratio(F.sum("_items"), F.count(F.lit(1))).alias("items_per_order")
    )
