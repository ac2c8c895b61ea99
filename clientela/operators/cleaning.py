"""Cleaning of the raw tables and assembly of the transaction table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientela import settings as S
from clientela.functions.columns import WHITESPACE, amount, cents, lenient_timestamp
from clientela.sources.raw import INGEST_COLUMN

ORDER_TIMES = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]
REVIEW_TIMES = ["review_creation_date", "review_answer_timestamp"]


def keep_one(df: DataFrame, key: str, order: str, last: bool = False) -> DataFrame:
    """One row per ``key``: the first (or last) by ``order``.

    An aggregate rather than a window: each map task reduces a repeated key to one
    row before the shuffle, so a key with a third of all rows reaches one task as one
    row per map task. Whole rows make it a sort-based aggregate, so a table without
    repeats pays one sort more than a plain shuffle.
    """
    pick = F.max_by if last else F.min_by
    chosen = pick(F.struct(*[F.col(c) for c in df.columns if c != key]), F.col(order))
    return df.groupBy(key).agg(chosen.alias("_row")).select(key, "_row.*").select(*df.columns)


def _parse_times(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[lenient_timestamp(df, c) if c in names else F.col(c) for c in df.columns])


def clean_orders(
    orders: DataFrame,
    valid_statuses: list[str] | None = None,
    order: str = INGEST_COLUMN,
) -> DataFrame:
    """Valid status, purchase time present, times parsed, first row per order.

    An unreadable time turns null after the null check, so its row stays.
    """
    statuses = S.VALID_ORDER_STATUSES if valid_statuses is None else valid_statuses
    kept = orders.where(
        F.col("order_status").isin(statuses) & F.col("order_purchase_timestamp").isNotNull()
    )
    return _parse_times(keep_one(kept, "order_id", order), ORDER_TIMES)


def clean_customers(customers: DataFrame, order: str = INGEST_COLUMN) -> DataFrame:
    """Both ids present, city and state trimmed, state upper case, last row per person."""
    known = customers.dropna(subset=["customer_id", "customer_unique_id"])
    latest = keep_one(known, "customer_unique_id", order, last=True)
    blanks = F.lit(WHITESPACE)
    return latest.withColumns(
        {
            "customer_city": F.btrim(F.col("customer_city"), blanks),
            "customer_state": F.upper(F.btrim(F.col("customer_state"), blanks)),
        }
    )


def clean_reviews(reviews: DataFrame, order: str = INGEST_COLUMN) -> DataFrame:
    """Score between 1 and 5 (null is out), times parsed, first row per review."""
    scored = reviews.where(F.col("review_score").between(1, 5))
    return _parse_times(keep_one(scored, "review_id", order), REVIEW_TIMES)


def clean_payments(payments: DataFrame) -> DataFrame:
    """Positive value and a known payment type."""
    return payments.where((F.col("payment_value") > 0) & F.col("payment_type").isNotNull())


def payments_per_order(payments: DataFrame) -> DataFrame:
    """``order_id, payment_value, payment_installments``: sum and maximum per order."""
    return payments.groupBy("order_id").agg(
        amount(F.sum(cents("payment_value"))).alias("payment_value"),
        F.max("payment_installments").alias("payment_installments"),
    )


def build_transactions(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per order item with its order and the order's payment totals.

    Every side meets on ``order_id``, so each table is shuffled once: the items and
    the aggregated payments by the joins, the orders by their de-duplication. An
    order has few items, so its key is never hot.
    """
    order_side = orders.drop(INGEST_COLUMN, *[c for c in orders.columns if c in items.columns and c != "order_id"])
    rows = items.join(order_side, "order_id", "left").join(payments_per_order(payments), "order_id", "left")
    return rows.select(*[c for c in S.TRANSACTION_COLUMNS if c in rows.columns])
