"""Keyed hashing of customer identifiers as a plain column expression."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientela.functions.columns import as_column

BLOCK_BYTES = 64
INNER_PAD = 0x36
OUTER_PAD = 0x5C
HASH_PATTERN = r"^[0-9a-f]{64}\z"


def hmac_sha256(value: Column | str, salt: str) -> Column:
    """HMAC-SHA256 (RFC 2104) hex digest of a column, key = ``salt``.

    Built from sha2/concat, so hashing stays in generated code. An empty or
    null identifier fails the job.
    """
    if not salt:
        raise ValueError("salt cannot be empty")
    key = salt.encode("utf-8")
    if len(key) > BLOCK_BYTES:
        key = hashlib.sha256(key).digest()
    key = key.ljust(BLOCK_BYTES, b"\0")
    inner = F.lit(bytes(b ^ INNER_PAD for b in key))
    outer = F.lit(bytes(b ^ OUTER_PAD for b in key))
    text = as_column(value).cast("string")
    digest = F.sha2(
        F.concat(outer, F.unhex(F.sha2(F.concat(inner, F.encode(text, "UTF-8")), 256))), 256
    )
    empty = text.isNull() | (text == "")
    return F.when(empty, F.raise_error(F.lit("identifier cannot be empty"))).otherwise(digest)


def pseudonymize(df: DataFrame, id_column: str, salt: str, drop_original: bool = True) -> DataFrame:
    """Add ``<id_column>_hash``; by default the readable identifier goes away."""
    if id_column not in df.columns:
        raise ValueError(f"Column '{id_column}' not found in DataFrame")
    hashed = df.withColumn(f"{id_column}_hash", hmac_sha256(id_column, salt))
    return hashed.drop(id_column) if drop_original else hashed


def pseudonymize_customers(customers: DataFrame, salt: str) -> DataFrame:
    """Hash ``customer_id`` and, where present, ``customer_unique_id``."""
    hashed = pseudonymize(customers, "customer_id", salt)
    if "customer_unique_id" in hashed.columns:
        hashed = pseudonymize(hashed, "customer_unique_id", salt)
    return hashed


def is_valid_hash(value: Column | str) -> Column:
    """True where the whole text is a 64-digit lower-case hex digest."""
    return F.coalesce(as_column(value).rlike(HASH_PATTERN), F.lit(False))
