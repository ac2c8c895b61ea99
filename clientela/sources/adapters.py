"""Raw-shaped tables derived from a star-schema data folder.

Gives the operators payments, reviews, delivery times and customers with repeats,
all computed from the folder's own tables, so every filter, null rule and
de-duplication has rows to act on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@lru_cache(maxsize=256)
def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def orders_raw(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey AS ingest_seq",
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END"
        " AS order_status",
        "o_orderdate AS order_purchase_timestamp",
        "o_orderdate + INTERVAL '1' HOUR * CAST((o_orderkey * 11) % 48 AS INT) AS order_approved_at",
        "CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate + INTERVAL '1' HOUR *"
        " CAST((o_orderkey * 37) % 720 AS INT) END AS order_delivered_customer_date",
        "CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderdate + INTERVAL '1' HOUR *"
        " CAST((o_orderkey * 53) % 600 AS INT) END AS order_estimated_delivery_date",
    )


def customers_raw(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    joined = table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.selectExpr(
        "c_custkey AS ingest_seq",
        "c_custkey AS customer_id",
        "c_custkey - c_custkey % 3 AS customer_unique_id",
        "concat(' ', n_name, ' ') AS customer_city",
        "concat(' ', lower(replace(n_name, 'NATION_', 'N')), ' ') AS customer_state",
    )


def order_items_raw(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS order_item_id",
        "l_partkey AS product_id",
        "l_suppkey AS seller_id",
        "l_extendedprice AS price",
        "l_extendedprice * l_tax AS freight_value",
    )


def order_payments_raw(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS payment_sequential",
        "CASE l_returnflag WHEN 'R' THEN 'credit_card' WHEN 'A' THEN 'boleto' END AS payment_type",
        "CAST(floor(l_quantity) AS INT) % 12 + 1 AS payment_installments",
        "CASE WHEN l_partkey % 50 = 0 THEN 0.0D ELSE l_extendedprice END AS payment_value",
    )


def order_reviews_raw(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "event_id AS ingest_seq",
        "event_id - CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END AS review_id",
        "event_id % 12000 AS order_id",
        "CASE WHEN event_type <> 'error' THEN CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 7 END"
        " AS review_score",
        "ts AS review_creation_date",
        "ts + INTERVAL '1' HOUR * CAST(user_id AS INT) AS review_answer_timestamp",
    )


def products_raw(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "p_partkey AS product_id", "p_brand AS product_category_name"
    )


def sellers_raw(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").selectExpr(
        "s_suppkey AS seller_id", "s_nationkey AS seller_state"
    )


RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "orders": orders_raw,
    "customers": customers_raw,
    "order_items": order_items_raw,
    "order_payments": order_payments_raw,
    "order_reviews": order_reviews_raw,
    "products": products_raw,
    "sellers": sellers_raw,
}


class RawTables(Mapping):
    """The seven raw-shaped tables of a folder, each opened on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getitem__(self, name: str) -> DataFrame:
        return RAW[name](self.spark, self.folder)

    def __iter__(self) -> Iterator[str]:
        return iter(RAW)

    def __len__(self) -> int:
        return len(RAW)
