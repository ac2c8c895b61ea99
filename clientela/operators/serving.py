"""Risk views, alerts and summaries, computed once for the whole table.

A lookup for single customers, alerts or segments is a filter on these tables; the
``wanted`` argument joins them to a table of requested keys and reports the keys
that were not found.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela import settings as S
from clientela.functions.ranks import with_position
from clientela.functions.text import fixed, percent

KEY = "customer_hash"
SUMMARY_DAYS = 7
TOP_ANOMALOUS = 5
ALERT_PAGE = 50
TABLE_PAGE = 20
HASH_PREFIX = 8


def _in_period(scores: DataFrame, days: int, now: datetime | None) -> DataFrame:
    """Rows scored in the last ``days`` days when ``now`` is given, else all rows."""
    if now is None:
        return scores
    since = F.lit(now).cast("timestamp") - F.make_dt_interval(days=F.lit(days))
    return scores.where(F.col("scored_at") >= since)


def anomaly_summary(
    scores: DataFrame, days: int = SUMMARY_DAYS, filter_from: datetime | None = None
) -> DataFrame:
    """One row of counts. ``days`` is only echoed unless ``filter_from`` is given."""
    flag = F.col("anomaly_flag")
    counted = _in_period(scores, days, filter_from).agg(
        F.count(F.lit(1)).alias("total_customers_scored"),
        F.count_if(flag == "anomalous").alias("anomaly_count"),
        F.count_if(flag == "suspicious").alias("suspicious_count"),
    )
    total, bad = F.col("total_customers_scored"), F.col("anomaly_count")
    rate = F.try_divide(bad.cast("double"), total.cast("double"))
    return counted.withColumns(
        {
            "normal_count": total - bad - F.col("suspicious_count"),
            "anomaly_rate": F.coalesce(rate, F.lit(0.0)),
            "period_days": F.lit(days),
        }
    )


def interpreted_summary(
    scores: DataFrame, days: int = SUMMARY_DAYS, filter_from: datetime | None = None
) -> DataFrame:
    """Summary with a reading of the rate and the five strangest customers."""
    kept = _in_period(scores, days, filter_from)
    leaders = (
        kept.where(F.col("anomaly_flag") == "anomalous")
        .orderBy(F.desc("anomaly_score"), KEY)
        .limit(TOP_ANOMALOUS)
    )
    # Five rows gathered; sorted again because collecting keeps no order.
    entry = F.struct((-F.col("anomaly_score")).alias("o"), KEY, "anomaly_score")
    ordered = F.array_sort(F.collect_list(entry))
    top = leaders.agg(
        F.transform(
            ordered,
            lambda e: F.struct(e[KEY].alias(KEY), F.round(e["anomaly_score"], 4).alias("score")),
        )
    ).scalar()
    rate = F.col("anomaly_rate")
    reading = (
        F.when(rate > S.HIGH_RATE, S.RATE_TEXT_HIGH)
        .when(rate > S.MODERATE_RATE, S.RATE_TEXT_MODERATE)
        .otherwise(S.RATE_TEXT_LOW)
    )
    empty = F.col("total_customers_scored") == 0
    return anomaly_summary(kept, days).select(
        F.when(empty, "no_data").otherwise("ok").alias("status"),
        F.when(empty, S.NO_SCORES_TEXT).alias("message"),
        "period_days",
        "total_customers_scored",
        F.col("anomaly_count").alias("anomalous_count"),
        "suspicious_count",
        "normal_count",
        F.round(rate * 100, 2).alias("anomaly_rate_percent"),
        F.when(~empty, reading).alias("interpretation"),
        top.alias("top_anomalous_customers"),
    )


def customer_risk(anomaly: DataFrame, churn: DataFrame, segments: DataFrame) -> DataFrame:
    """Scores and segment of every customer with an anomaly or a churn score.

    The segment joins either side before the full join. After it, the key is a new
    expression whose partitioning Spark does not know, and one more shuffle would be
    needed; this way tables stored in equal buckets join without any.
    """
    labels = segments.select(KEY, "segment_label")
    left = anomaly.select(KEY, "anomaly_score", "anomaly_flag").join(labels, KEY, "left")
    right = churn.select(KEY, "churn_probability", "predicted_churn").join(labels, KEY, "left")
    return left.join(right.withColumnRenamed("segment_label", "_label"), KEY, "full").select(
        KEY,
        "anomaly_score",
        "anomaly_flag",
        "churn_probability",
        "predicted_churn",
        F.coalesce("segment_label", "_label").alias("segment_label"),
    )


def _lookup(label: Column, texts: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(v) for pair in texts.items() for v in pair])
    return F.try_element_at(table, label)


def risk_profiles(risk: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Risk level, advice and segment description on top of ``customer_risk``.

    A score of exactly 0 is reported as 0. With ``wanted`` (a table of
    ``customer_hash``) unknown customers come back with status ``not_found``.
    """
    p, flag, segment = F.col("churn_probability"), F.col("anomaly_flag"), F.col("segment_label")
    level = (
        F.when((flag == "anomalous") | (p >= S.HIGH_RISK), "high")
        .when(p >= S.MEDIUM_RISK, "medium")
        .otherwise("low")
    )
    advice = F.array_compact(
        F.array(
            F.when(level == "high", S.ADVICE_HIGH_RISK),
            F.when(flag.isin("anomalous", "suspicious"), S.ADVICE_UNUSUAL),
            F.when(segment.isin("at_risk", "hibernating"), S.ADVICE_DISENGAGED),
        )
    )
    profiles = risk.select(
        KEY,
        F.lit("found").alias("status"),
        level.alias("risk_level"),
        F.round("anomaly_score", 4).alias("anomaly_score"),
        "anomaly_flag",
        F.round(p, 4).alias("churn_probability"),
        "predicted_churn",
        segment.alias("segment"),
        F.coalesce(_lookup(segment, S.SEGMENT_DESCRIPTIONS), F.lit("")).alias("segment_description"),
        F.when(F.size(advice) == 0, F.array(F.lit(S.ADVICE_NONE)))
        .otherwise(advice)
        .alias("recommendations"),
    )
    if wanted is None:
        return profiles
    asked = wanted.select(KEY).distinct().join(profiles, KEY, "left")
    missing = F.col("status").isNull()
    return asked.withColumns(
        {
            "status": F.coalesce("status", F.lit("not_found")),
            "message": F.when(missing, S.NOT_FOUND_TEXT),
        }
    )


def generate_alerts(
    anomaly: DataFrame,
    churn: DataFrame,
    now: datetime,
    anomaly_threshold: float = S.ANOMALY_ALERT_THRESHOLD,
    churn_threshold: float = S.CHURN_ALERT_THRESHOLD,
) -> DataFrame:
    """Open alerts for scores at or above the thresholds, numbered by type and customer."""

    def above(df: DataFrame, score: str, kind: str, threshold: float) -> DataFrame:
        return df.where(F.col(score) >= threshold).select(
            F.col(KEY),
            F.lit(kind).alias("alert_type"),
            F.col(score).alias("score"),
            F.lit(threshold).alias("threshold"),
        )

    both = above(anomaly, "anomaly_score", "anomaly", anomaly_threshold).unionByName(
        above(churn, "churn_probability", "churn_risk", churn_threshold)
    )
    return with_position(both, ["alert_type", KEY], "id").select(
        "id",
        KEY,
        "alert_type",
        "score",
        "threshold",
        F.lit(now).cast("timestamp").alias("created_at"),
        F.lit(False).alias("is_resolved"),
        F.lit(None).cast("string").alias("notes"),
    )


def list_alerts(alerts: DataFrame, resolved: bool = False, limit: int = ALERT_PAGE) -> DataFrame:
    """Newest alerts first; the limit is the page size of the report."""
    kept = alerts.where(F.col("is_resolved") == resolved)
    return kept.orderBy(F.desc("created_at"), "id").limit(limit)


def _filled(template: str, *values: Column) -> Column:
    """Template text with its ``%s`` places filled."""
    parts = template.split("%s")
    pieces: list[Column] = [F.lit(parts[0])]
    for value, part in zip(values, parts[1:], strict=True):
        pieces += [value, F.lit(part)]
    return F.concat(*pieces)


def explain_alerts(alerts: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Plain-language text and next action of every alert.

    With ``wanted`` (a table of ``alert_id``) unknown ids get status ``not_found``.
    """
    who = F.substring(F.col(KEY).cast("string"), 1, HASH_PREFIX)
    score, threshold = F.col("score"), F.col("threshold")
    text = (
        F.when(
            F.col("alert_type") == "anomaly",
            _filled(S.ALERT_TEXT_ANOMALY, who, fixed(score, 2), fixed(threshold, 2)),
        )
        .when(
            F.col("alert_type") == "churn_risk",
            _filled(S.ALERT_TEXT_CHURN, who, percent(score), percent(threshold)),
        )
        .otherwise(_filled(S.ALERT_TEXT_OTHER, F.col("alert_type"), who, fixed(score, 4)))
    )
    explained = alerts.select(
        F.col("id").alias("alert_id"),
        F.lit("found").alias("status"),
        KEY,
        "alert_type",
        F.round(score, 4).alias("score"),
        threshold,
        "created_at",
        "is_resolved",
        text.alias("explanation"),
        F.when(F.col("is_resolved"), S.ALERT_CLOSED_ACTION)
        .otherwise(S.ALERT_OPEN_ACTION)
        .alias("recommended_action"),
    )
    if wanted is None:
        return explained
    asked = wanted.select("alert_id").distinct().join(explained, "alert_id", "left")
    return asked.withColumns(
        {
            "status": F.coalesce("status", F.lit("not_found")),
            "explanation": F.coalesce(
                "explanation",
                _filled("No alert found with ID %s.", F.col("alert_id").cast("string")),
            ),
        }
    )


def segment_dimension(spark: SparkSession) -> DataFrame:
    """The six labels with their texts."""
    rows = [
        (s, S.SEGMENT_DESCRIPTIONS[s], S.MARKETING_SUGGESTIONS[s], i)
        for i, s in enumerate(S.SEGMENT_LABELS)
    ]
    schema = "segment_label string, description string, marketing_suggestion string, place int"
    return spark.createDataFrame(rows, schema).coalesce(1)


def segment_lookup(
    assignments: DataFrame, profiles: DataFrame, wanted: DataFrame | None = None
) -> DataFrame:
    """Per label: size, description, profile means (2 digits) and marketing text.

    ``note`` says so where a label has no profile.

    With ``wanted`` (a table of ``segment_label``) a label outside the six gets status
    ``invalid_segment`` and a message listing the valid ones.
    """
    labels = segment_dimension(assignments.sparkSession)
    known = F.col("segment_label").isin(S.SEGMENT_LABELS)
    sizes = assignments.where(known).groupBy("segment_label").agg(F.count(F.lit(1)).alias("customer_count"))
    # One row per known label, six at most, on either right side.
    table = (
        labels.join(F.broadcast(sizes), "segment_label", "left")
        .join(F.broadcast(rounded_profiles(profiles.where(known))), "segment_label", "left")
        .withColumn("customer_count", F.coalesce("customer_count", F.lit(0)).cast("bigint"))
        .withColumn("note", F.when(F.col("count").isNull(), S.NO_PROFILE_TEXT))
        .drop("place")
    )
    if wanted is None:
        return table
    options = ", ".join(S.SEGMENT_LABELS)
    asked = wanted.select("segment_label").distinct().join(F.broadcast(table), "segment_label", "left")
    valid = F.col("segment_label").isin(S.SEGMENT_LABELS)
    return asked.withColumns(
        {
            "status": F.when(valid, "found").otherwise("invalid_segment"),
            "message": F.when(
                ~valid,
                _filled(f"Invalid segment '%s'. Valid options: {options}", F.col("segment_label")),
            ),
        }
    )


def rounded_profiles(profiles: DataFrame) -> DataFrame:
    """Segment profile rows with means at 2 digits (the distribution table)."""
    means = [c for c, t in profiles.dtypes if t in ("double", "float")]
    return profiles.withColumns({c: F.round(c, 2) for c in means})


def overview_kpis(anomaly: DataFrame, churn: DataFrame, segments: DataFrame) -> DataFrame:
    """One row: anomalous customers and rate, customers at risk, largest segment."""
    flags = anomaly.agg(
        F.struct(
            F.count_if(F.col("anomaly_flag") == "anomalous").alias("bad"),
            F.count(F.lit(1)).alias("all"),
        )
    ).scalar()
    sizes = segments.where(F.col("segment_label").isNotNull()).groupBy("segment_label").count()
    # Equal sizes: the alphabetically first label.
    largest = sizes.orderBy(F.desc("count"), "segment_label").select("segment_label").limit(1).scalar()
    return churn.agg(
        F.count_if(F.col("churn_probability") >= S.HIGH_RISK).alias("high_risk_customers")
    ).select(
        flags["bad"].alias("flagged_anomalies"),
        F.coalesce(
            percent(F.try_divide(flags["bad"].cast("double"), flags["all"].cast("double"))), F.lit("N/A")
        ).alias("anomaly_rate"),
        "high_risk_customers",
        F.coalesce(largest, F.lit("N/A")).alias("largest_segment"),
    )


def flagged_customers(anomaly: DataFrame, churn: DataFrame) -> DataFrame:
    """Customers that are not normal with their churn probability, strangest first."""
    flagged = anomaly.where(F.col("anomaly_flag") != "normal")
    joined = flagged.join(churn.select(KEY, "churn_probability"), KEY, "left")
    return joined.orderBy(F.desc("anomaly_score"), KEY).select(
        KEY,
        F.round("anomaly_score", 4).alias("anomaly_score"),
        "anomaly_flag",
        F.round("churn_probability", 4).alias("churn_probability"),
    )


def flagged_page(
    anomaly: DataFrame, churn: DataFrame, after: tuple[float, str] | None = None, size: int = TABLE_PAGE
) -> DataFrame:
    """The page of ``flagged_customers`` that follows (score, hash) ``after``.

    The page is cut before the join, so only its rows look up a churn score. Column
    ``cursor_score`` holds the unrounded score to pass on as the next ``after``.
    """
    flagged = anomaly.where(F.col("anomaly_flag") != "normal")
    if after is not None:
        score, key = F.lit(after[0]), F.lit(after[1])
        later = (F.col("anomaly_score") < score) | ((F.col("anomaly_score") == score) & (F.col(KEY) > key))
        flagged = flagged.where(later)
    page = flagged.orderBy(F.desc("anomaly_score"), KEY).limit(size)
    cursor = page.select(KEY, F.col("anomaly_score").alias("cursor_score"))
    # At most one page of rows.
    return flagged_customers(page, churn).join(F.broadcast(cursor), KEY)
