"""Running totals over a global order, and what follows from them.

Exact quantiles, positions, ROC-AUC and the two-sample KS distance all need
cumulative counts over sorted values. A window without partitions would put the
whole table into one task; here Spark range-partitions the rows, each partition
cumulates its own part and one small table of partition totals adds the offsets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clientela.session import materialise

WIDE = "decimal(19,0)"


def running_totals(
    df: DataFrame, order: Sequence[Column | str], weights: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Add ``<w>_before`` for each weight: its sum over all earlier rows.

    ``order`` must be unique within ``by``. The range-partitioned rows are written
    once, so the partition of every row is a stored fact that both the cumulation
    and the offsets read, even when an executor is lost in between.
    """
    by = list(by)
    ranged = df.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id())
    ranged = materialise(ranged, "ranged")
    inside = Window.partitionBy("_part", *by).orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = ranged.groupBy("_part", *by).agg(*[F.sum(w).alias(w) for w in weights])
    # One row per range partition (and group): bounded by the shuffle partition count.
    across = Window.partitionBy(*by).orderBy("_part")
    # Groups may be null, so rows meet their offsets by null-safe equality.
    offsets = totals.select(
        F.col("_part").alias("_at"),
        *[F.col(c).alias(f"_by_{c}") for c in by],
        *[(F.sum(w).over(across) - F.col(w)).alias(f"_{w}_offset") for w in weights],
    )
    own = F.col("_part") == F.col("_at")
    for c in by:
        own = own & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return (
        ranged.select("*", *[F.sum(w).over(inside).alias(f"_{w}_through") for w in weights])
        .join(F.broadcast(offsets), own)
        .select(
            *df.columns,
            *[
                (F.col(f"_{w}_offset") + F.col(f"_{w}_through") - F.col(w)).alias(f"{w}_before")
                for w in weights
            ],
        )
    )


def with_position(df: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """Number all rows 1..n in ``order`` (which must be unique)."""
    counted = running_totals(df.withColumn("_one", F.lit(1).cast("bigint")), order, ["_one"])
    return counted.withColumn(name, F.col("_one_before") + 1).drop("_one", "_one_before")


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """Linear-interpolation quantiles: ``feature, share, value`` rows, nulls skipped."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "feature", "value"
    )
    counts = (
        long.where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running_totals(counts, ["value"], ["n"], by=["feature"])
    # One row per feature and share.
    sizes = ranked.groupBy("feature").agg(F.sum("n").alias("rows"))
    place = (F.col("rows") - 1) * F.col("share")
    wanted = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    targets = sizes.select("feature", "rows", wanted).select(
        "feature",
        "share",
        F.floor(place).alias("low"),
        F.ceil(place).alias("high"),
        (place - F.floor(place)).alias("part"),
    )
    through = F.col("n_before") + F.col("n")

    def holds(rank: str) -> Column:
        return (F.col("n_before") <= F.col(rank)) & (F.col(rank) < through)

    found = ranked.join(F.broadcast(targets), "feature").where(holds("low") | holds("high"))
    return (
        found.groupBy("feature", "share", "part")
        .agg(
            F.max(F.when(holds("low"), F.col("value"))).alias("a"),
            F.max(F.when(holds("high"), F.col("value"))).alias("b"),
        )
        .select("feature", "share", (F.col("a") + (F.col("b") - F.col("a")) * F.col("part")).alias("value"))
    )


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row ``roc_auc``: rank statistic with ties averaged, null with one class."""
    counts = df.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"),
        F.sum(1 - F.col(label).cast("bigint")).alias("neg"),
    )
    ranked = running_totals(counts, ["score"], ["neg"])
    # Twice the won pairs, as whole numbers wider than 64 bits.
    beaten = 2 * F.col("neg_before") + F.col("neg")
    wins = F.col("pos").cast(WIDE) * beaten.cast(WIDE)
    sums = ranked.agg(
        F.sum(wins).alias("wins"), F.sum("pos").alias("p"), F.sum("neg").alias("n")
    )
    pairs = F.col("p").cast("double") * F.col("n").cast("double")
    return sums.select(F.try_divide(F.col("wins").cast("double") / 2.0, pairs).alias("roc_auc"))


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row ``auc_pr``: precision at each score, weighted by the positives that score adds; null without positives."""
    counts = df.groupBy((-F.col(score)).alias("_falling")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("n")
    )
    ranked = running_totals(counts, ["_falling"], ["pos", "n"])
    found, seen = F.col("pos_before") + F.col("pos"), F.col("n_before") + F.col("n")
    weighed = F.col("pos") * found.cast("double") / seen
    return ranked.agg(F.try_divide(F.sum(weighed), F.sum("pos").cast("double")).alias("auc_pr"))


def ks_distance(first: DataFrame, second: DataFrame, column: str) -> DataFrame:
    """One row ``ks_statistic, n_first, n_second``: largest gap of the two ECDFs."""

    def tagged(df: DataFrame, a: int) -> DataFrame:
        value = F.col(column).cast("double").alias("value")
        kept = df.select(value).where(F.col("value").isNotNull() & ~F.isnan("value"))
        return kept.select("value", F.lit(a).cast("bigint").alias("a"), F.lit(1 - a).cast("bigint").alias("b"))

    both = tagged(first, 1).unionByName(tagged(second, 0))
    counts = both.groupBy("value").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    ranked = running_totals(counts, ["value"], ["a", "b"])
    n_first, n_second = ranked.agg(F.sum("a")).scalar(), ranked.agg(F.sum("b")).scalar()

    def share(part: str, total: Column) -> Column:
        through = F.col(f"{part}_before") + F.col(part)
        return F.try_divide(through.cast("double"), total.cast("double"))

    gap = F.abs(share("a", n_first) - share("b", n_second))
    return ranked.agg(
        F.max(gap).alias("ks_statistic"), F.sum("a").alias("n_first"), F.sum("b").alias("n_second")
    )


def ks_p_value(statistic: float, n: int, m: int) -> float:
    """Two-sided p-value of the KS distance, from the Kolmogorov limit distribution.

    One method for every size. The alternating series converges for large arguments
    and its theta transform for small ones; both are the same function, and a few
    terms give full precision on either side of 1.
    """
    if not n or not m or statistic <= 0:
        return 1.0
    x = statistic * math.sqrt(n * m / (n + m))
    if x < 1.0:
        parts = [math.exp(-((2 * j - 1) ** 2) * math.pi**2 / (8.0 * x * x)) for j in range(1, 8)]
        value = 1.0 - math.sqrt(2.0 * math.pi) / x * sum(parts)
    else:
        value = 2.0 * sum((-1) ** (j - 1) * math.exp(-2.0 * j * j * x * x) for j in range(1, 12))
    return min(1.0, max(0.0, value))
