"""Drift and score-distribution checks between two runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela import settings as S
from clientela.functions.ranks import ks_distance, ks_p_value
from clientela.functions.sketch import ks_bounds

NUMERIC = {"tinyint", "smallint", "int", "bigint", "float", "double"}
DRIFT_SCHEMA = (
    "feature string, reference_mean double, current_mean double, drift double, drifted boolean"
)
KS_SCHEMA = "status string, ks_statistic double, p_value double, drift_detected boolean"
BOUNDED_SCHEMA = (
    "status string, ks_low double, ks_high double, p_value_low double, p_value_high double, drift_detected boolean"
)


def is_numeric(dtype: str) -> bool:
    return dtype in NUMERIC or dtype.startswith("decimal")


def _means(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """One aggregate, then one row per column."""
    row = df.agg(*[F.avg(c).cast("double").alias(c) for c in columns])
    return row.unpivot([], columns, "feature", name)


def mean_drift(
    reference: DataFrame, current: DataFrame, threshold: float = S.DRIFT_THRESHOLD
) -> DataFrame:
    """Relative change of the mean of every numeric column both tables have.

    Columns whose reference mean is 0 are left out.
    """
    numeric = [c for c, t in reference.dtypes if is_numeric(t) and c in current.columns]
    if not numeric:
        return reference.sparkSession.createDataFrame([], DRIFT_SCHEMA)
    # One row per column on either side.
    both = _means(reference, numeric, "reference_mean").join(
        F.broadcast(_means(current, numeric, "current_mean")), "feature"
    )
    change = F.abs(
        F.try_divide(F.col("current_mean") - F.col("reference_mean"), F.col("reference_mean"))
    )
    return (
        both.where(F.col("reference_mean") != 0)
        .withColumn("drift", change)
        .withColumn("drifted", F.coalesce(F.col("drift") > threshold, F.lit(False)))
    )


def _rate_check(rate: Column, bounds: tuple[float, float]) -> Column:
    return F.coalesce(rate.between(*bounds), F.lit(False))


def churn_rate_check(
    scores: DataFrame, bounds: tuple[float, float] = S.CHURN_RATE_RANGE
) -> DataFrame:
    """One row: share of probabilities from 0.5 up, and whether it lies in ``bounds``."""
    high = F.coalesce(F.col("churn_probability") >= 0.5, F.lit(False))
    rate = scores.agg(F.avg(high.cast("int")).alias("churn_rate"))
    return rate.withColumn("churn_rate_in_range", _rate_check(F.col("churn_rate"), bounds))


def anomaly_rate_check(
    scores: DataFrame, bounds: tuple[float, float] = S.ANOMALY_RATE_RANGE
) -> DataFrame:
    """Opt-in companion of ``churn_rate_check`` on the share of anomalous customers."""
    anomalous = F.coalesce(F.col("anomaly_flag") == "anomalous", F.lit(False))
    rate = scores.agg(F.avg(anomalous.cast("int")).alias("anomaly_rate"))
    return rate.withColumn("anomaly_rate_in_range", _rate_check(F.col("anomaly_rate"), bounds))


def ks_verdict(
    statistic: float, n: int, m: int, threshold: float = S.KS_THRESHOLD
) -> tuple[str, float, float, bool]:
    p = ks_p_value(statistic, n, m)
    return "completed", statistic, p, statistic > threshold and p < S.KS_SIGNIFICANCE


def model_drift(
    baseline: DataFrame, current: DataFrame, threshold: float = S.KS_THRESHOLD
) -> DataFrame:
    """KS distance of two score distributions; drift needs a large gap and a small p."""
    found = ks_distance(baseline, current, "churn_probability").first()
    statistic = found["ks_statistic"]
    row = ("no_data", 0.0, 1.0, False)
    if statistic is not None:
        row = ks_verdict(statistic, found["n_first"], found["n_second"], threshold)
    return current.sparkSession.createDataFrame([row], KS_SCHEMA).coalesce(1)


def bounded_drift(
    sketch: DataFrame, current: DataFrame, threshold: float = S.KS_THRESHOLD
) -> DataFrame:
    """:func:`model_drift` against a rank sketch of the baseline: bounds of the distance and of its p-value.

    The exact distance lies within the bounds, and its p-value between the two. ``drift_detected`` is null where
    the bounds differ in their verdict, so that only the exact distance can tell.
    """
    found = ks_bounds(sketch, current, "churn_probability").first()
    row = ("no_data", 0.0, 0.0, 1.0, 1.0, False)
    if found["ks_low"] is not None:
        sides = [ks_verdict(found[c], found["n_first"], found["n_second"], threshold) for c in ("ks_low", "ks_high")]
        (_, low, p_high, calm), (_, high, p_low, drifted) = sides
        row = ("completed", low, high, p_low, p_high, drifted if calm == drifted else None)
    return current.sparkSession.createDataFrame([row], BOUNDED_SCHEMA).coalesce(1)


def monitoring_verdict(
    drift: DataFrame, score_checks: DataFrame, model: DataFrame, threshold: float = S.DRIFT_THRESHOLD
) -> DataFrame:
    """One row: drifted columns, KS result, and whether the run passed.

    ``score_checks`` holds ``check_name, passed`` rows; all must pass and the model
    must not have drifted. Drifted columns are counted but do not fail the run.
    """
    drifted = drift.agg(F.count_if(F.col("drift") > threshold)).scalar()
    checks = score_checks.agg(F.coalesce(F.every("passed"), F.lit(False))).scalar()
    return model.select(
        drifted.alias("n_drifted"),
        F.col("status"),
        F.col("ks_statistic"),
        F.col("drift_detected"),
        (checks & ~F.col("drift_detected")).alias("passed"),
        ((F.col("status") == "completed") & ~F.col("drift_detected")).alias("roll_baseline"),
    )


def score_checks(scores: DataFrame | None, spark: SparkSession) -> DataFrame:
    """``check_name, passed`` rows; a missing table fails the presence check."""
    if scores is None:
        return spark.createDataFrame([("scores_file_exists", False)], "check_name string, passed boolean")
    present = F.struct(F.lit("scores_file_exists").alias("check_name"), F.lit(True).alias("passed"))
    if "churn_probability" not in scores.columns:
        return scores.agg(F.array(present).alias("c")).select(F.inline("c"))
    in_range = F.struct(
        F.lit("churn_rate_in_range").alias("check_name"), F.col("churn_rate_in_range").alias("passed")
    )
    return churn_rate_check(scores).select(F.inline(F.array(in_range, present)))
