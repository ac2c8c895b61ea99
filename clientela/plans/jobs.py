"""The daily and weekly jobs, as chains of operators.

Only what several later steps read is written: the feature matrix and the score
tables. Everything in between stays one lazy plan.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela import settings as S
from clientela.functions.privacy import pseudonymize, pseudonymize_customers
from clientela.operators import anomaly, churn, cleaning, explain, features, incremental, monitoring, segments, serving
from clientela.operators.private import train_private_model
from clientela.session import materialise
from clientela.sources import publish, tables
from clientela.sources.raw import INGEST_COLUMN


@dataclass
class CleanTables:
    orders: DataFrame
    customers: DataFrame | None
    reviews: DataFrame
    payments: DataFrame
    items: DataFrame


def clean_tables(raw: Mapping[str, DataFrame], valid_statuses: list[str] | None = None) -> CleanTables:
    return CleanTables(
        orders=cleaning.clean_orders(raw["orders"], valid_statuses),
        customers=cleaning.clean_customers(raw["customers"]) if "customers" in raw else None,
        reviews=cleaning.clean_reviews(raw["order_reviews"]),
        payments=cleaning.clean_payments(raw["order_payments"]),
        items=raw["order_items"],
    )


def transactions(clean: CleanTables) -> DataFrame:
    return cleaning.build_transactions(clean.orders, clean.items, clean.payments)


def feature_tables(clean: CleanTables, lines: DataFrame, snapshot_date: str = S.SNAPSHOT_DATE) -> dict[str, DataFrame]:
    """The four feature tables by customer, from the item-level transactions ``lines``."""
    return {
        "rfm_features": features.rfm(lines, snapshot_date),
        "review_features": features.review_features(clean.reviews, clean.orders),
        "delivery_features": features.delivery_features(lines),
        "payment_features": features.payment_features(lines),
    }


def pseudonymized_tables(clean: CleanTables, salt: str) -> dict[str, DataFrame]:
    """Customers and transactions without readable customer ids."""
    known = transactions(clean).where(F.col("customer_id").isNotNull())
    return {
        "customers_pseudonymized": pseudonymize_customers(clean.customers, salt),
        "transactions_pseudonymized": pseudonymize(known, "customer_id", salt),
    }


SALT_VARIABLE = "HMAC_SALT"


def salt_or_fail(salt: str | None = None) -> str:
    """The given salt or the one in the environment."""
    salt = salt or os.environ.get(SALT_VARIABLE)
    if not salt:
        raise ValueError(f"{SALT_VARIABLE} must be set for pseudonymization")
    return salt


# Columns the features use. De-duplication keeps whole rows, so columns have to be
# dropped before it for the scans to skip them.
FEATURE_INPUTS = {
    "orders": [
        INGEST_COLUMN,
        "order_id",
        "customer_id",
        "order_status",
        features.PURCHASED,
        features.DELIVERED,
        features.ESTIMATED,
    ],
    "order_items": ["order_id"],
    "order_payments": ["order_id", "payment_type", "payment_installments", "payment_value"],
    "order_reviews": [INGEST_COLUMN, "review_id", "order_id", "review_score"],
}


def feature_job(
    raw: Mapping[str, DataFrame],
    snapshot_date: str = S.SNAPSHOT_DATE,
    salt: str | None = None,
    pseudonymize: bool = True,
    valid_statuses: list[str] | None = None,
) -> DataFrame:
    """Raw tables to the feature matrix.

    Customer keys are hashed with ``salt`` (default: environment variable
    ``HMAC_SALT``); ``pseudonymize=False`` keeps them readable, for comparisons only.
    """
    salt = salt_or_fail(salt) if pseudonymize else None
    t = order_tables(raw, valid_statuses)
    return features.order_grain_feature_matrix(t.orders, t.items, t.payments, t.reviews, snapshot_date, salt=salt)


def order_tables(raw: Mapping[str, DataFrame], valid_statuses: list[str] | None = None) -> incremental.OrderTables:
    """The cleaned tables of the features, with the columns that they use."""
    needed = {name: raw[name].select(*columns) for name, columns in FEATURE_INPUTS.items()}
    return incremental.OrderTables(
        cleaning.clean_orders(needed["orders"], valid_statuses),
        needed["order_items"],
        cleaning.clean_payments(needed["order_payments"]),
        cleaning.clean_reviews(needed["order_reviews"]),
    )


def refreshed_feature_job(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    changed: DataFrame,
    last_state: str,
    next_state: str,
    snapshot_date: str = S.SNAPSHOT_DATE,
    salt: str | None = None,
) -> DataFrame:
    """The feature matrix of a stored state (a folder) and the orders in ``changed``; the new state is stored too."""
    salt = salt_or_fail(salt)
    state = incremental.refresh(incremental.FeatureState.load(spark, last_state), order_tables(raw), changed)
    state.save(next_state)
    return incremental.matrix_of_state(state, snapshot_date, salt=salt)


@dataclass
class Models:
    """What a scoring run needs; all tables here have a bounded number of rows."""

    forest: anomaly.Forest
    scaler: DataFrame
    centroids: DataFrame
    labels: DataFrame
    booster: PipelineModel

    def save(self, spark: SparkSession, root: str) -> None:
        self.forest.save(spark, f"{root}/forest")
        for name in ("scaler", "centroids", "labels"):
            getattr(self, name).coalesce(1).write.mode("overwrite").parquet(f"{root}/{name}")
        self.booster.write().overwrite().save(f"{root}/booster")

    @staticmethod
    def load(spark: SparkSession, root: str) -> Models:
        tables.require_tables(
            spark,
            [f"{root}/forest/nodes", f"{root}/forest/meta"]
            + [f"{root}/{n}" for n in ("scaler", "centroids", "labels")],
        )
        # The booster is a model folder, not a table: its description is text.
        tables.require_tables(spark, [f"{root}/booster/metadata"], "text")
        return Models(
            forest=anomaly.Forest.load(spark, f"{root}/forest"),
            scaler=spark.read.parquet(f"{root}/scaler"),
            centroids=spark.read.parquet(f"{root}/centroids"),
            labels=spark.read.parquet(f"{root}/labels"),
            booster=PipelineModel.load(f"{root}/booster"),
        )


@dataclass
class TrainingResult:
    models: Models
    anomaly_scores: DataFrame
    segment_assignments: DataFrame
    churn_scores: DataFrame
    segment_profiles: DataFrame
    k_analysis: DataFrame
    anomaly_metrics: DataFrame
    segment_metrics: DataFrame
    churn_metrics: DataFrame
    private_metrics: DataFrame | None
    churn_features: DataFrame


def training_job(
    feature_matrix: DataFrame,
    contamination: float = S.CONTAMINATION,
    seed: int = S.SEED,
    rounds: int = S.BOOSTING_ROUNDS,
    step: float = S.BOOSTING_STEP,
    k_range: tuple[int, int] = (S.K_MIN, S.K_MAX),
    epsilon: float | None = S.DP_EPSILON,
    delta: float = S.DP_DELTA,
    anomaly_threshold: float = S.ANOMALY_THRESHOLD,
    churn_threshold: float = S.CHURN_RISK_THRESHOLD,
) -> TrainingResult:
    """Fit the three models and score the training table.

    ``feature_matrix`` is read many times: pass a stored table.
    """
    matrix = feature_matrix
    forest, raw, anomaly_metrics = anomaly.train_isolation_forest(matrix, contamination, seed)
    scores = anomaly.score_raw(raw, forest.cut, anomaly_threshold)

    points, scaler = segments.prepare_points(matrix)
    k_analysis, fits = segments.find_optimal_k(points, *k_range, seed)
    k_analysis = materialise(k_analysis, "k-analysis")
    k = segments.select_optimal_k(k_analysis).first()["k"]
    centroids = fits[k].to_frame(matrix.sparkSession)
    clustered = segments.assign_clusters(points, centroids).select("customer_hash", "cluster_id")
    profiles = segments.cluster_profiles(matrix, clustered)
    marks = segments.feature_percentiles(matrix, ["recency_days", "frequency", "monetary_total"])
    labels = materialise(segments.label_clusters(profiles, marks), "segment-labels")
    assigned = clustered.join(F.broadcast(labels), "cluster_id")
    assigned = assigned.select("customer_hash", "cluster_id", "segment_label")

    labelled = churn.build_churn_labels(matrix)
    merged = materialise(churn.merge_churn_features(labelled, scores, assigned), "churn-features")
    split = churn.ordered_split(churn.require_features(merged, S.CHURN_FEATURES))
    booster, churn_metrics = churn.train_churn_model(split, rounds, step, seed)
    private_metrics = train_private_model(split, epsilon, delta, seed)[1] if epsilon else None

    return TrainingResult(
        models=Models(forest, scaler, centroids, labels, booster),
        anomaly_scores=scores,
        segment_assignments=assigned,
        churn_scores=churn.score_churn(merged, booster, churn_threshold),
        segment_profiles=segments.segment_profiles(matrix, assigned),
        k_analysis=k_analysis,
        anomaly_metrics=anomaly_metrics,
        segment_metrics=k_analysis.where(F.col("k_values") == k),
        churn_metrics=churn_metrics,
        private_metrics=private_metrics,
        churn_features=merged,
    )


def explanation_tables(feature_matrix: DataFrame, result: TrainingResult) -> dict[str, DataFrame]:
    return {
        "anomaly_shap_values": explain.anomaly_shap(feature_matrix, result.models.forest),
        "churn_shap_values": explain.churn_shap(result.churn_features, result.models.booster),
    }


def scoring_job(
    feature_matrix: DataFrame,
    models: Models,
    reuse_training_span: bool = False,
    anomaly_threshold: float = S.ANOMALY_THRESHOLD,
    churn_threshold: float = S.CHURN_RISK_THRESHOLD,
) -> dict[str, DataFrame]:
    """Score a batch with saved models; nothing is refitted."""
    scores = anomaly.score_anomalies(
        feature_matrix, models.forest, anomaly_threshold, reuse_training_span
    )
    points, _ = segments.prepare_points(feature_matrix, scaler=models.scaler)
    clustered = segments.assign_clusters(points, models.centroids)
    assigned = clustered.join(F.broadcast(models.labels), "cluster_id", "left").select(
        "customer_hash", "cluster_id", "segment_label"
    )
    labelled = churn.build_churn_labels(feature_matrix)
    merged = materialise(churn.merge_churn_features(labelled, scores, assigned), "churn-features")
    churn.require_features(merged, S.CHURN_FEATURES)
    return {
        "anomaly_scores": scores,
        "segment_assignments": assigned,
        "churn_scores": churn.score_churn(merged, models.booster, churn_threshold),
    }


def scoring_from_saved(
    spark: SparkSession, feature_matrix: DataFrame, model_root: str, **thresholds: float
) -> dict[str, DataFrame]:
    """Daily inference: load the current models and score; refuses if none are saved."""
    return scoring_job(feature_matrix, Models.load(spark, model_root), **thresholds)


def publish_job(
    spark: SparkSession,
    root: str,
    score_paths: dict[str, str],
    now: datetime | None = None,
    anomaly_alert: float = S.ANOMALY_ALERT_THRESHOLD,
    churn_alert: float = S.CHURN_ALERT_THRESHOLD,
) -> DataFrame:
    """Publish score tables and fresh alerts as one release; returns counts."""
    make = partial(serving.generate_alerts, anomaly_threshold=anomaly_alert, churn_threshold=churn_alert)
    return publish.publish_all(spark, root, score_paths, make, now or datetime.now(UTC))


@dataclass
class MonitoringResult:
    drift: DataFrame
    score_checks: DataFrame
    model_drift: DataFrame
    verdict: DataFrame


def monitoring_job(
    spark: SparkSession,
    reference_features: str,
    current_features: str,
    current_scores: str,
    baseline_scores: str,
) -> MonitoringResult:
    """Weekly checks. Missing inputs skip their check; the baseline rolls when stable."""
    comparable = (
        reference_features != current_features
        and tables.table_exists(spark, reference_features)
        and tables.table_exists(spark, current_features)
    )
    if comparable:
        drift = monitoring.mean_drift(
            tables.read_table(spark, reference_features), tables.read_table(spark, current_features)
        )
    else:
        drift = spark.createDataFrame([], monitoring.DRIFT_SCHEMA)
    scores = None
    if tables.table_exists(spark, current_scores):
        scores = tables.read_table(spark, current_scores)
    checks = monitoring.score_checks(scores, spark)

    status = ("no_data", 0.0, 1.0, False)
    if scores is not None:
        baseline, created = publish.baseline_or_create(scores, baseline_scores)
        status = ("baseline_created", 0.0, 1.0, False)
        if not created:
            found = monitoring.model_drift(baseline, scores).first()
            status = tuple(found)
            if found["status"] == "completed" and not found["drift_detected"]:
                publish.save_baseline(scores, baseline_scores)
    model = spark.createDataFrame([status], monitoring.KS_SCHEMA).coalesce(1)
    return MonitoringResult(drift, checks, model, monitoring.monitoring_verdict(drift, checks, model))
