"""Logistic regression with differential privacy, as a comparison to the main model.

Objective perturbation (Chaudhuri, Monteleoni and Sarwate 2011): rows are clipped
to unit norm, one random vector is added to the regularised loss, and the exact
minimiser of that loss is released.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from clientela import settings as S
from clientela.operators.churn import classification_metrics
from clientela.operators.segments import apply_scaler, fit_scaler
from clientela.session import materialise

REGULARISATION = 1.0
CURVATURE = 0.25
MAX_ITERATIONS = 200
GRADIENT_TOLERANCE = 1e-6


@dataclass
class PrivateLogistic:
    features: list[str]
    scaler: list[Row]
    weights: np.ndarray
    epsilon: float


def unit_rows(df: DataFrame, features: list[str], scaler: list[Row]) -> DataFrame:
    """Scaled features with a constant column, each row of norm at most 1.

    Features are clipped to norm 1; with the constant the bound is sqrt(2), divided
    out here so that the privacy argument holds for the intercept as well.
    """
    scaled = apply_scaler(df, scaler, prefix="_z_")
    names = [f"_z_{c}" for c in features]
    squares = [F.col(c) * F.col(c) for c in names]
    norm = F.sqrt(sum(squares[1:], squares[0]))
    shrink = F.when(norm > 1, F.lit(1.0) / norm).otherwise(F.lit(1.0)) / F.lit(math.sqrt(2.0))
    clipped = {c: F.col(c) * F.col("_shrink") for c in names}
    return (
        scaled.withColumn("_shrink", shrink)
        .withColumns(clipped)
        .withColumn("_z_one", F.lit(1.0 / math.sqrt(2.0)))
        .drop("_shrink")
    )


def perturbation(dimension: int, epsilon: float, seed: int) -> tuple[np.ndarray, float]:
    """Noise vector and extra regularisation for ``epsilon`` (none if infinite)."""
    if epsilon <= 0:
        raise ValueError("epsilon must be positive")
    if math.isinf(epsilon):
        return np.zeros(dimension), 0.0
    remaining = epsilon - 2.0 * math.log1p(CURVATURE / REGULARISATION)
    extra = 0.0
    if remaining <= 0:
        extra = CURVATURE / math.expm1(epsilon / 4.0) - REGULARISATION
        remaining = epsilon / 2.0
    rng = np.random.default_rng(seed)
    direction = rng.normal(size=dimension)
    length = rng.gamma(dimension, 2.0 / remaining)
    return direction / np.linalg.norm(direction) * length, extra


def _loss_parts(rows: DataFrame, names: list[str], models: dict[float, np.ndarray]) -> dict[float, np.ndarray]:
    """Loss, gradient and Hessian sums over all rows, for several weight vectors in one scan.

    Each task reduces its rows to one vector per model; a shuffle adds them up.
    """
    d = len(names)
    size = 1 + d + d * d
    weights = list(models.values())

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(weights), size))
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names])
            y = batch.column("churned").to_numpy(zero_copy_only=False).astype(float)
            for part, w in zip(total, weights, strict=True):
                margin = x @ w
                p = 1.0 / (1.0 + np.exp(-margin))
                part[0] += np.logaddexp(0.0, margin).sum() - (y * margin).sum()
                part[1 : 1 + d] += x.T @ (p - y)
                part[1 + d :] += (x.T @ (x * (p * (1.0 - p))[:, None])).ravel()
        places = np.arange(total.size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(total.ravel())], names=["i", "v"])

    partial = rows.select(*names, "churned").mapInArrow(add_up, "i int, v double")
    found = np.zeros(len(weights) * size)
    # Bounded: 1 + d + d*d numbers for each model.
    for row in partial.groupBy("i").agg(F.sum("v").alias("v")).collect():
        found[row["i"]] = row["v"]
    return dict(zip(models, found.reshape(len(weights), size), strict=True))


def fit_private_models(
    train: DataFrame,
    epsilons: list[float],
    seed: int = S.SEED,
    features: list[str] | None = None,
    max_iterations: int = MAX_ITERATIONS,
) -> dict[float, PrivateLogistic]:
    """One model for each privacy level; all Newton steps of a round share one scan."""
    features = features or S.CHURN_FEATURES
    # One row per feature, read once.
    scaler = fit_scaler(train, features).collect()
    names = [f"_z_{c}" for c in features] + ["_z_one"]
    d = len(names)
    drawn = {e: perturbation(d, e, seed) for e in epsilons}
    rows = unit_rows(train, features, scaler).select(*names, "churned")
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    weights = {e: np.zeros(d) for e in epsilons}
    accepted, lowest = dict(weights), dict.fromkeys(epsilons, math.inf)
    moving = dict(weights)
    try:
        for _ in range(max_iterations):
            if not moving:
                break
            for e, parts in _loss_parts(rows, names, moving).items():
                (noise, extra), w = drawn[e], moving[e]
                ridge = REGULARISATION + extra
                loss = parts[0] + ridge / 2.0 * w @ w + noise @ w
                if loss > lowest[e] + 1e-9 * abs(lowest[e]):
                    moving[e] = (w + accepted[e]) / 2.0
                    continue
                accepted[e], lowest[e] = w, loss
                gradient = parts[1 : 1 + d] + ridge * w + noise
                if np.linalg.norm(gradient) <= GRADIENT_TOLERANCE * max(1.0, np.linalg.norm(w)):
                    del moving[e]
                    continue
                hessian = parts[1 + d :].reshape(d, d) + ridge * np.eye(d)
                moving[e] = w - np.linalg.solve(hessian, gradient)
    finally:
        rows.unpersist()
    if not all(np.isfinite(w).all() for w in accepted.values()):
        raise ArithmeticError("private fit did not stay finite")
    return {e: PrivateLogistic(features, scaler, accepted[e], e) for e in epsilons}


def fit_private_logistic(
    train: DataFrame,
    epsilon: float = S.DP_EPSILON,
    seed: int = S.SEED,
    features: list[str] | None = None,
    max_iterations: int = MAX_ITERATIONS,
) -> PrivateLogistic:
    """Newton steps; each is one pass over the training rows."""
    return fit_private_models(train, [epsilon], seed, features, max_iterations)[epsilon]


def private_probabilities(df: DataFrame, models: dict[str, PrivateLogistic]) -> DataFrame:
    """Add one probability column for each named model of one training run."""
    first = next(iter(models.values()))
    names = [f"_z_{c}" for c in first.features] + ["_z_one"]
    rows = unit_rows(df, first.features, first.scaler)

    def chance(model: PrivateLogistic) -> Column:
        terms = [F.col(c) * F.lit(float(w)) for c, w in zip(names, model.weights, strict=True)]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-sum(terms[1:], terms[0])))

    return rows.withColumns({name: chance(m) for name, m in models.items()}).drop(*names)


def private_probability(df: DataFrame, model: PrivateLogistic) -> DataFrame:
    """Add ``churn_probability`` of the private model."""
    return private_probabilities(df, {"churn_probability": model})


METRIC_COLUMNS = [
    "roc_auc",
    "f1",
    "precision",
    "recall",
    "epsilon",
    "delta",
    "train_size",
    "test_size",
    "churn_rate_train",
    "churn_rate_test",
    "dp_training_failed",
]


def train_private_model(
    split: DataFrame,
    epsilon: float = S.DP_EPSILON,
    delta: float = S.DP_DELTA,
    seed: int = S.SEED,
    features: list[str] | None = None,
) -> tuple[PrivateLogistic | None, DataFrame]:
    """Private model and its metrics row; a numerical failure gives a marker row.

    ``delta`` is recorded only: the mechanism is purely epsilon-private.
    """
    try:
        train = split.where(F.col("split") == "train")
        model = fit_private_logistic(train, epsilon, seed, features)
        return model, _metrics_row(private_probability(split, model), "churn_probability", epsilon, delta)
    except (ArithmeticError, np.linalg.LinAlgError):
        return None, _marker_row(split.sparkSession, epsilon)


def _metrics_row(scored: DataFrame, score: str, epsilon: float, delta: float) -> DataFrame:
    metrics = classification_metrics(scored, score).withColumns(
        {
            "epsilon": F.lit(float(epsilon)),
            "delta": F.lit(float(delta)),
            "dp_training_failed": F.lit(0.0),
        }
    )
    return metrics.select(*METRIC_COLUMNS)


def _marker_row(spark: SparkSession, epsilon: float) -> DataFrame:
    known = {"epsilon": float(epsilon), "dp_training_failed": 1.0}
    schema = ", ".join(f"{c} double" for c in METRIC_COLUMNS)
    return spark.createDataFrame([tuple(known.get(c) for c in METRIC_COLUMNS)], schema)


def privacy_tradeoff(
    split: DataFrame, epsilons: list[float] | None = None, seed: int = S.SEED, delta: float = S.DP_DELTA
) -> DataFrame:
    """Metrics at several privacy levels, one row each; one fit and one scoring pass for all."""
    epsilons = epsilons or S.DP_EPSILON_GRID
    try:
        models = fit_private_models(split.where(F.col("split") == "train"), epsilons, seed)
    except (ArithmeticError, np.linalg.LinAlgError):
        rows = [_marker_row(split.sparkSession, e) for e in epsilons]
    else:
        names = {e: f"p{i}" for i, e in enumerate(epsilons)}
        scored = private_probabilities(split, {names[e]: m for e, m in models.items()})
        scored = materialise(scored.select("split", "churned", *names.values()), "private-scores")
        rows = [_metrics_row(scored, names[e], e, delta) for e in epsilons]
    return reduce(DataFrame.unionByName, rows)
