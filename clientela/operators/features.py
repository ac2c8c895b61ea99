"""Per-customer features: recency/frequency/monetary, reviews, delivery, payments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientela import settings as S
from clientela.functions.columns import amount, cents, elapsed_days, snapshot
from clientela.functions.privacy import hmac_sha256

PURCHASED = "order_purchase_timestamp"
DELIVERED = "order_delivered_customer_date"
ESTIMATED = "order_estimated_delivery_date"


def _known(df: DataFrame, key: str) -> DataFrame:
    """Rows without a customer belong to no customer (they would form a null group)."""
    return df.where(F.col(key).isNotNull())


def _recency_and_average(df: DataFrame, snapshot_date: str) -> DataFrame:
    return df.withColumns(
        {
            "recency_days": elapsed_days(snapshot(snapshot_date), F.col("_last_order")),
            "monetary_avg": F.try_divide(F.col("monetary_total"), F.col("frequency").cast("double")),
        }
    )


def rfm(
    transactions: DataFrame, snapshot_date: str, key: str = "customer_id", grain: str = "item"
) -> DataFrame:
    """Recency in days, distinct orders, total and mean spend per customer.

    ``grain="item"`` adds the order's payment total once per item row; ``"order"``
    adds it once per order.
    """
    rows = _known(transactions, key)
    paid = F.coalesce(cents("payment_value"), F.lit(0))
    if grain == "order":
        per_order = rows.groupBy(key, "order_id").agg(
            F.max(PURCHASED).alias("_last"), F.max(paid).alias("_paid")
        )
        grouped = per_order.groupBy(key).agg(
            F.max("_last").alias("_last_order"),
            F.count("order_id").alias("frequency"),
            amount(F.sum("_paid")).alias("monetary_total"),
        )
    elif grain == "item":
        grouped = rows.groupBy(key).agg(
            F.max(PURCHASED).alias("_last_order"),
            F.count_distinct("order_id").alias("frequency"),
            amount(F.sum(paid)).alias("monetary_total"),
        )
    else:
        raise ValueError("grain must be 'item' or 'order'")
    return _recency_and_average(grouped, snapshot_date).select(
        key, "recency_days", "frequency", "monetary_total", "monetary_avg"
    )


def review_features(reviews: DataFrame, orders: DataFrame, key: str = "customer_id") -> DataFrame:
    """Mean score and number of reviews per customer.

    Reviews are summed per order before the join, so an order with very many
    reviews reaches the join as one row.
    """
    per_order = _review_sums(reviews)
    joined = _known(orders.select("order_id", key), key).join(per_order, "order_id")
    return joined.groupBy(key).agg(
        F.try_divide(F.sum("_score_sum").cast("double"), F.sum("_scores").cast("double")).alias(
            "avg_review_score"
        ),
        F.sum("_scores").alias("review_count"),
    )


def _review_sums(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.sum(F.col("review_score").cast("bigint")).alias("_score_sum"),
        F.count("review_score").alias("_scores"),
    )


def delivery_days() -> Column:
    return elapsed_days(DELIVERED, PURCHASED)


def is_late() -> Column:
    """Whether the delivery took more whole days than estimated; null without estimate."""
    later = delivery_days() > elapsed_days(ESTIMATED, PURCHASED)
    return F.when(F.col(ESTIMATED).isNotNull(), F.coalesce(later, F.lit(False)))


def _delivered(value: Column) -> Column:
    return F.when(F.col(DELIVERED).isNotNull(), value)


def _delivery_aggregates() -> list[Column]:
    return [
        F.avg(_delivered(delivery_days())).alias("avg_delivery_days"),
        F.coalesce(F.avg(_delivered(is_late().cast("int"))), F.lit(0.0)).alias("late_delivery_rate"),
    ]


def delivery_features(transactions: DataFrame, key: str = "customer_id") -> DataFrame:
    """Mean delivery days and share of late deliveries over delivered item rows."""
    delivered = _known(transactions, key).where(F.col(DELIVERED).isNotNull())
    return delivered.groupBy(key).agg(*_delivery_aggregates())


def payment_features(transactions: DataFrame, key: str = "customer_id") -> DataFrame:
    """Mean instalments per item row; the category count is a constant 0 here."""
    return (
        _known(transactions, key)
        .groupBy(key)
        .agg(F.avg("payment_installments").alias("payment_installments_avg"))
        .withColumn("unique_product_categories", F.lit(0).cast("bigint"))
    )


def _finish(df: DataFrame, snapshot_date: str, key: str, salt: str | None) -> DataFrame:
    """Fill gaps, add the constant columns, name the key, fix the column order."""
    key_column = hmac_sha256(key, salt) if salt else F.col(key)
    filled = df.fillna(S.FEATURE_FILLS).withColumns(
        {
            "customer_hash": key_column,
            "snapshot_date": snapshot(snapshot_date),
            "anomaly_score": F.lit(None).cast("double"),
            "segment_label": F.lit(None).cast("string"),
        }
    )
    missing = set(S.FEATURE_MATRIX_COLUMNS) - set(filled.columns)
    if missing:
        raise ValueError(f"Missing required columns in feature matrix: {sorted(missing)}")
    return filled.select(*S.FEATURE_MATRIX_COLUMNS)


def assemble_feature_matrix(
    rfm_features: DataFrame,
    review: DataFrame,
    delivery: DataFrame,
    payment: DataFrame,
    snapshot_date: str,
    key: str = "customer_id",
    salt: str | None = None,
) -> DataFrame:
    """The 14-column feature matrix from the four feature tables.

    With ``salt`` the key is replaced by its keyed hash; without, it is renamed.
    """
    joined = (
        rfm_features.join(review, key, "left").join(delivery, key, "left").join(payment, key, "left")
    )
    return _finish(joined, snapshot_date, key, salt)


def fused_feature_matrix(
    transactions: DataFrame,
    reviews: DataFrame,
    orders: DataFrame,
    snapshot_date: str,
    key: str = "customer_id",
    salt: str | None = None,
) -> DataFrame:
    """Same result as ``assemble_feature_matrix`` from one pass over transactions."""
    paid = F.coalesce(cents("payment_value"), F.lit(0))
    grouped = (
        _known(transactions, key)
        .groupBy(key)
        .agg(
            F.max(PURCHASED).alias("_last_order"),
            F.count_distinct("order_id").alias("frequency"),
            amount(F.sum(paid)).alias("monetary_total"),
            F.avg("payment_installments").alias("payment_installments_avg"),
            *_delivery_aggregates(),
        )
        .withColumn("unique_product_categories", F.lit(0).cast("bigint"))
    )
    features = _recency_and_average(grouped, snapshot_date)
    return _finish(
        features.join(review_features(reviews, orders, key), key, "left"), snapshot_date, key, salt
    )


def order_grain_feature_matrix(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    snapshot_date: str,
    key: str = "customer_id",
    salt: str | None = None,
) -> DataFrame:
    """Same result straight from the cleaned tables, without the item-level join.

    Items, payments and reviews are each reduced to one row per order before they
    meet, and means over item rows become means weighted by the item count. No
    table larger than the orders is ever joined, no key is hot in a join, and the
    distinct order count is a plain count.
    """
    item_counts = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("_items"))
    paid = payments.groupBy("order_id").agg(
        F.sum(cents("payment_value")).alias("_paid"),
        F.max("payment_installments").alias("_installments"),
    )
    per_order = (
        _known(orders, key)
        .select("order_id", key, PURCHASED, DELIVERED, ESTIMATED)
        .join(item_counts, "order_id", "left")
        .join(paid, "order_id", "left")
        .join(_review_sums(reviews), "order_id", "left")
    )
    has_items = F.col("_items").isNotNull()

    def weighted_mean(value: Column) -> Column:
        """Mean over item rows where ``value`` is known."""
        total = F.sum(value * F.col("_items"))
        rows = F.sum(F.when(value.isNotNull(), F.col("_items")))
        return F.try_divide(total.cast("double"), rows.cast("double"))

    grouped = (
        per_order.groupBy(key)
        .agg(
            F.max(F.when(has_items, F.col(PURCHASED))).alias("_last_order"),
            F.count(F.when(has_items, F.col("order_id"))).alias("frequency"),
            amount(F.sum(F.coalesce(F.col("_paid") * F.col("_items"), F.lit(0)))).alias(
                "monetary_total"
            ),
            weighted_mean(F.col("_installments")).alias("payment_installments_avg"),
            weighted_mean(_delivered(delivery_days())).alias("avg_delivery_days"),
            weighted_mean(_delivered(is_late().cast("int"))).alias("late_delivery_rate"),
            F.try_divide(
                F.sum("_score_sum").cast("double"), F.sum("_scores").cast("double")
            ).alias("avg_review_score"),
            F.sum("_scores").alias("review_count"),
        )
        .where(F.col("frequency") > 0)
        .withColumn("unique_product_categories", F.lit(0).cast("bigint"))
    )
    return _finish(_recency_and_average(grouped, snapshot_date), snapshot_date, key, salt)
