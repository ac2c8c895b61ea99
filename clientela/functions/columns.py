"""Small column expressions: elapsed days, money in cents, text cleaning, gates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000

# Fixed value: the characters Python's str.strip() removes.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def micros(value: Column | str) -> Column:
    """Microseconds since the epoch; needs a UTC session for zone-less columns."""
    return F.unix_micros(as_column(value).cast("timestamp"))


def elapsed_days(later: Column | str, earlier: Column | str) -> Column:
    """Whole days of elapsed time rounded down (-23 h is -1), not calendar days."""
    gap = micros(later) - micros(earlier)
    return ((gap - F.pmod(gap, F.lit(DAY_MICROS))) / F.lit(DAY_MICROS)).cast("bigint")


def snapshot(date: str) -> Column:
    if not date:
        raise ValueError("snapshot date must be a non-empty date string")
    return F.lit(date).cast("timestamp")


def lenient_timestamp(df: DataFrame, name: str) -> Column:
    """Timestamp of a text column, null where it cannot be read."""
    if df.schema[name].dataType.typeName() == "string":
        return F.try_to_timestamp(F.col(name)).alias(name)
    return F.col(name).cast("timestamp").alias(name)


def cents(amount: Column | str) -> Column:
    """Currency amount as whole cents: sums become exact and order-independent."""
    return F.round(as_column(amount) * 100).cast("bigint")


def amount(total_cents: Column | str) -> Column:
    return as_column(total_cents).cast("double") / F.lit(100.0)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every float column (one missing-value notion)."""
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("float", "double")}
    return df.select(
        *[F.nanvl(F.col(c), F.lit(None)).alias(c) if c in floats else F.col(c) for c in df.columns]
    )


def missing_values(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row: for each column the count of null or NaN cells."""
    types = dict(df.dtypes)

    def is_missing(c: str) -> Column:
        gap = F.col(c).isNull()
        return gap | F.isnan(c) if types[c] in ("float", "double") else gap

    return df.agg(*[F.count_if(is_missing(c)).cast("bigint").alias(c) for c in columns])


def require_features(df: DataFrame, columns: list[str]) -> DataFrame:
    """Return ``df`` if all feature columns exist and none has a missing value."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"Missing required features: {absent}")
    counts = missing_values(df, columns).first().asDict()
    bad = [c for c in columns if counts[c]]
    if bad:
        raise ValueError(f"Null values detected in feature columns: {bad}")
    return df
