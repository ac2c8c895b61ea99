"""Joins that stay balanced when a few keys hold much of the large side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def share_count(df: DataFrame) -> int:
    """How many shuffle partitions the session deals rows to."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, key: str, shares: int) -> DataFrame:
    """Keys that hold more than one of ``shares`` equal parts of all rows, with the pieces to cut each into.

    Exact counts, reduced on the map side. Fewer than ``shares`` keys can hold that
    much, so the result is bounded without a cap.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    part = df.agg(F.count(F.lit(1)) / F.lit(shares)).scalar()
    return counts.where(F.col("n") > part).select(key, F.ceil(F.col("n") / part).cast("int").alias("_pieces"))


def spread_join(
    fact: DataFrame, dimension: DataFrame, key: str, how: str = "left", shares: int | None = None
) -> DataFrame:
    """Join ``fact`` to ``dimension`` on ``key`` with hot fact keys cut into pieces.

    Every fact row of a hot key takes one piece number and the dimension rows of
    that key are repeated once per piece, so the result equals the plain join and
    no task receives a whole hot key. Other keys keep piece 0. ``fact`` must be a
    scan or a written table: piece numbers follow the row position, which a
    re-run task reproduces only when its input order is fixed.
    """
    if how not in ("left", "inner"):
        raise ValueError("spread_join supports left and inner joins")
    shares = shares or share_count(fact)
    # Size proven: fewer than ``shares`` rows.
    hot = F.broadcast(hot_keys(fact, key, shares))
    pieces = F.coalesce(F.col("_pieces"), F.lit(1))
    position = F.monotonically_increasing_id()
    fact_piece = F.when(F.col(key).isNull(), F.pmod(position, F.lit(shares))).otherwise(
        F.pmod(position, pieces)
    )
    spread_fact = (
        fact.join(hot, key, "left").withColumn("_piece", fact_piece.cast("int")).drop("_pieces")
    )
    spread_dimension = (
        dimension.join(hot, key, "left")
        .withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .drop("_pieces")
    )
    return spread_fact.join(spread_dimension, [key, "_piece"], how).drop("_piece")
