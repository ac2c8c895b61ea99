"""The seven raw CSV tables with explicit schemas and a file-order column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela.functions.columns import nan_to_null
from clientela.sources.quoted import read_quoted_csv

# Column lists of the public e-commerce files (fixed values).
RAW_SCHEMAS = {
    "orders": (
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp string, order_approved_at string, "
        "order_delivered_carrier_date string, order_delivered_customer_date string, "
        "order_estimated_delivery_date string"
    ),
    "customers": (
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string"
    ),
    "order_items": (
        "order_id string, order_item_id bigint, product_id string, seller_id string, "
        "shipping_limit_date string, price double, freight_value double"
    ),
    "order_payments": (
        "order_id string, payment_sequential bigint, payment_type string, "
        "payment_installments bigint, payment_value double"
    ),
    "order_reviews": (
        "review_id string, order_id string, review_score bigint, review_comment_title string, "
        "review_comment_message string, review_creation_date string, review_answer_timestamp string"
    ),
    "products": "product_id string, product_category_name string",
    "sellers": (
        "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"
    ),
}

# Review texts hold line breaks inside quotes, which Spark's own reader cannot split;
# ``quoted`` reads them in splits, as every other table.
MULTI_LINE_TABLES = {"order_reviews"}

# File order, used by keep-first / keep-last: file, block in the file, row in the block.
INGEST_COLUMN = "ingest_seq"


def read_csv(
    spark: SparkSession, path: str, schema: str, multi_line: bool = False, split_bytes: int | None = None
) -> DataFrame:
    """Header CSV with a known schema; fields are matched to columns by header name.

    Only the columns named in ``schema`` that the file has are returned, so a file
    with more, fewer or reordered columns still reads correctly. Files of one folder
    must share their header: one that differs fails the read instead of shifting
    columns. With ``multi_line``, quoted fields may hold line breaks; ``split_bytes`` bounds
    the splits of such files where the session's setting is not wanted.
    """
    options = {"header": True, "multiLine": multi_line, "escape": '"', "enforceSchema": False}
    header = spark.read.options(**options).csv(path).columns
    wanted = dict(part.strip().split(" ") for part in schema.split(","))
    text = ", ".join(f"`{c}` {wanted.get(c, 'string')}" for c in header)
    if multi_line:
        table = read_quoted_csv(spark, path, header, text, split_bytes)
        order = F.struct("file", "block", "row").alias(INGEST_COLUMN)
        return nan_to_null(table.select(*[c for c in wanted if c in header], order))
    table = spark.read.options(**options).schema(text).csv(path)
    order = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return nan_to_null(table.select(*[c for c in wanted if c in header], order.alias(INGEST_COLUMN)))


def read_raw_tables(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Raw tables by name; ``paths`` maps a name of ``RAW_SCHEMAS`` to its CSV path."""
    unknown = set(paths) - set(RAW_SCHEMAS)
    if unknown:
        raise ValueError(f"unknown raw tables: {sorted(unknown)}")
    return {
        name: read_csv(spark, path, RAW_SCHEMAS[name], name in MULTI_LINE_TABLES)
        for name, path in paths.items()
    }
