"""The feature matrix kept up to date: stored partials, merged with the changed orders only.

The state is one row per order (what the order adds to its customer) and one row per customer (the sums of those).
All of it is counts, cents and whole days, so an order that changes is taken out of the sums exactly and put back in
its new form: a late status, delivery, payment or review, a cancellation, or another customer. Only the latest purchase
cannot be taken out of a maximum; it is looked up again for customers who lost an order that reached it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela.functions.columns import amount, cents
from clientela.operators.features import (
    DELIVERED,
    ESTIMATED,
    PURCHASED,
    _delivered,
    _finish,
    _known,
    _recency_and_average,
    delivery_days,
    is_late,
)
from clientela.session import materialise

ORDER = "order_id"
# Sums of a customer over orders; each can be added and taken away.
SUMS = ["frequency", "paid", "installments", "installment_rows", "days", "day_rows", "late", "late_rows", "scores", "reviews"]
# Number of orders behind the sums, with or without items.
ALL_ORDERS = "orders"


@dataclass
class OrderTables:
    """The cleaned tables of one moment."""

    orders: DataFrame
    items: DataFrame
    payments: DataFrame
    reviews: DataFrame

    def facts(self) -> DataFrame:
        """``order_id`` with its item rows, cents paid, most instalments, score sum and scores; a sum of nothing is null.

        One aggregate over the rows of three tables: with one for each table, a task that joins the three holds a hash
        table and a sort for every one of them.
        """
        score = F.col("review_score")
        parts = [
            self.items.select(ORDER, F.lit(1).cast("bigint").alias("_items")),
            self.payments.select(ORDER, cents("payment_value").alias("_paid"), F.col("payment_installments").alias("_most")),
            self.reviews.select(ORDER, score.cast("bigint").alias("_score"), score.isNotNull().cast("bigint").alias("_scored")),
        ]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        return rows.groupBy(ORDER).agg(
            F.sum("_items").alias("_items"),
            F.sum("_paid").alias("_paid"),
            F.max("_most").alias("_most"),
            F.sum("_score").alias("_score_sum"),
            F.sum("_scored").alias("_scores"),
        )


@dataclass
class FeatureState:
    """``partials``: one row per order; ``sums``: one row per customer with at least one order."""

    partials: DataFrame
    sums: DataFrame

    def save(self, folder: str) -> None:
        """Write to a folder that holds nothing yet: a state is read while the next one is made from it."""
        self.partials.write.parquet(f"{folder}/partials")
        self.sums.write.parquet(f"{folder}/sums")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> FeatureState:
        return cls(spark.read.parquet(f"{folder}/partials"), spark.read.parquet(f"{folder}/sums"))


def order_partials(tables: OrderTables, key: str = "customer_id", ids: DataFrame | None = None) -> DataFrame:
    """What every order of a known customer adds: ``order_id, key``, latest purchase, ``SUMS``; of orders in ``ids`` only.

    Orders without items count nothing but their reviews. The tables are reduced to one row per order before they
    meet the orders, so no join has a hot key. Ids that are few enough to be broadcast pass to the scans, and only rows
    of their orders are aggregated; more of them meet the aggregated rows, which is less to shuffle and to sort.
    """
    orders, facts = _known(tables.orders, key).select(ORDER, key, PURCHASED, DELIVERED, ESTIMATED), tables.facts()
    if ids is not None:
        orders, facts = (t.join(ids, ORDER, "left_semi") for t in (orders, facts))
    joined = orders.join(facts, ORDER, "left")

    def weighted(value: Column, name: str, rows: str) -> list[Column]:
        known = F.when(value.isNotNull(), F.col("_items"))
        return [_whole(value.cast("bigint") * F.col("_items"), name), _whole(known, rows)]

    return joined.select(
        ORDER,
        key,
        F.when(F.col("_items").isNotNull(), F.col(PURCHASED)).alias("last_order"),
        F.col("_items").isNotNull().cast("bigint").alias("frequency"),
        _whole(F.col("_paid") * F.col("_items"), "paid"),
        *weighted(F.col("_most"), "installments", "installment_rows"),
        *weighted(_delivered(delivery_days()), "days", "day_rows"),
        *weighted(_delivered(is_late().cast("int")), "late", "late_rows"),
        _whole(F.col("_score_sum"), "scores"),
        _whole(F.col("_scores"), "reviews"),
    )


def _whole(value: Column, name: str) -> Column:
    return F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint")).alias(name)


def customer_sums(partials: DataFrame, key: str = "customer_id") -> DataFrame:
    """Sums of the partials by customer, with the number of orders behind them."""
    return partials.groupBy(key).agg(
        F.max("last_order").alias("last_order"),
        F.count(F.lit(1)).alias(ALL_ORDERS),
        *[F.sum(c).alias(c) for c in SUMS],
    )


def first_state(tables: OrderTables, key: str = "customer_id") -> FeatureState:
    """The state of a first run, over all orders."""
    partials = materialise(order_partials(tables, key), "order-partials")
    return FeatureState(partials, materialise(customer_sums(partials, key), "customer-sums"))


def changed_orders(before: OrderTables, after: OrderTables) -> DataFrame:
    """Ids of orders with a row in any table that was added, removed or changed; repeated rows count.

    For callers without a change feed: every table is shuffled once, reduced to an id and a hash of the row.
    """

    def differing(old: DataFrame, new: DataFrame) -> DataFrame:
        names = [c for c in new.columns if c in old.columns]
        # A hash passes over nulls, so their places are hashed too.
        nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in names])
        signed = [
            df.select(ORDER, F.xxhash64(*names, nulls).alias("row"), F.lit(sign).alias("sign")) for df, sign in ((old, -1), (new, 1))
        ]
        both = signed[0].unionByName(signed[1])
        return both.groupBy(ORDER, "row").agg(F.sum("sign").alias("sign")).where("sign != 0").select(ORDER)

    pairs = [
        (before.orders, after.orders),
        (before.items, after.items),
        (before.payments, after.payments),
        (before.reviews, after.reviews),
    ]
    found = reduce(DataFrame.unionByName, [differing(old, new) for old, new in pairs])
    return found.where(F.col(ORDER).isNotNull()).distinct()


def refresh(state: FeatureState, tables: OrderTables, changed: DataFrame, key: str = "customer_id") -> FeatureState:
    """The state after the orders in ``changed`` (column ``order_id``) took the form they have in ``tables``.

    ``changed`` may name orders that did not change, that are new, or that are gone; repeats and nulls do no harm.
    Equal to ``first_state(tables)`` as long as it names every order that changed. Changed orders that are few enough
    to be broadcast are aggregated alone. The stored partials are read once for the orders to take out and copied
    without a shuffle by customer.
    """
    ids = materialise(changed.select(ORDER).where(F.col(ORDER).isNotNull()).distinct(), "changed-orders")
    old = materialise(state.partials.join(ids, ORDER, "left_semi"), "old-partials")
    new = materialise(order_partials(tables, key, ids), "new-partials")
    partials = materialise(state.partials.join(ids, ORDER, "left_anti").unionByName(new), "order-partials")

    signed = [df.withColumn("_sign", F.lit(sign).cast("bigint")) for df, sign in ((old, -1), (new, 1))]
    deltas = (
        signed[0]
        .unionByName(signed[1])
        .groupBy(key)
        .agg(
            F.max(F.when(F.col("_sign") < 0, F.col("last_order"))).alias("_taken"),
            F.max(F.when(F.col("_sign") > 0, F.col("last_order"))).alias("_added"),
            F.sum("_sign").alias(f"_{ALL_ORDERS}"),
            *[F.sum(F.col(c) * F.col("_sign")).alias(f"_{c}") for c in SUMS],
        )
    )

    def moved(name: str) -> Column:
        return (F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col(f"_{name}"), F.lit(0))).alias(name)

    # Customers whose latest purchase was taken out, unless one at least as late came in.
    lost = F.coalesce(F.col("_taken") >= F.col("last_order"), F.lit(False))
    replaced = F.coalesce(F.col("_added") >= F.col("last_order"), F.lit(False))
    merged = state.sums.join(deltas, key, "full").select(
        key,
        F.greatest("last_order", "_added").alias("last_order"),
        (lost & ~replaced).alias("_again"),
        moved(ALL_ORDERS),
        *[moved(c) for c in SUMS],
    )
    merged = materialise(merged.where(F.col(ALL_ORDERS) > 0), "merged-sums")
    again = merged.where("_again").select(key)
    latest = partials.join(again, key, "left_semi").groupBy(key).agg(F.max("last_order").alias("_found"))
    last_order = F.when(F.col("_again"), F.col("_found")).otherwise(F.col("last_order"))
    sums = merged.join(latest, key, "left").select(key, last_order.alias("last_order"), ALL_ORDERS, *SUMS)
    return FeatureState(partials, materialise(sums, "customer-sums"))


def matrix_of_state(state: FeatureState, snapshot_date: str, key: str = "customer_id", salt: str | None = None) -> DataFrame:
    """The 14-column feature matrix of a state: a narrow pass over the customers, for any snapshot date."""

    def mean(total: str, rows: str) -> Column:
        return F.try_divide(F.col(total).cast("double"), F.col(rows).cast("double"))

    bought = state.sums.where(F.col("frequency") > 0).select(
        key,
        F.col("last_order").alias("_last_order"),
        "frequency",
        amount(F.col("paid")).alias("monetary_total"),
        mean("installments", "installment_rows").alias("payment_installments_avg"),
        mean("days", "day_rows").alias("avg_delivery_days"),
        mean("late", "late_rows").alias("late_delivery_rate"),
        mean("scores", "reviews").alias("avg_review_score"),
        F.col("reviews").alias("review_count"),
        F.lit(0).cast("bigint").alias("unique_product_categories"),
    )
    return _finish(_recency_and_average(bought, snapshot_date), snapshot_date, key, salt)
