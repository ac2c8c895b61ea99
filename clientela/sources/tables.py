"""Intermediate tables: read, overwrite, tolerate or require presence, bucket."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from clientela.functions.columns import nan_to_null


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table with NaN read as null (one missing-value notion)."""
    return nan_to_null(spark.read.parquet(path))


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Replace the table at ``path`` and return it as stored."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """Store as a catalog table bucketed and sorted by ``key``.

    Score tables share ``customer_hash``: stored with one bucket count they join
    with each other without a shuffle.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def table_exists(spark: SparkSession, path: str, form: str = "parquet") -> bool:
    try:
        spark.read.format(form).load(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def read_or_empty(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The table, or an empty one with ``schema`` where nothing is stored yet."""
    if table_exists(spark, path):
        return read_table(spark, path)
    return spark.createDataFrame([], schema)


def require_tables(spark: SparkSession, paths: Iterable[str], form: str = "parquet") -> None:
    """Fail before any work starts if an input is absent, naming every one."""
    missing = [p for p in paths if not table_exists(spark, p, form)]
    if missing:
        raise FileNotFoundError(f"Missing required inputs: {missing}")
