"""Logistic regression under (epsilon, delta): a Gaussian mechanism on clipped sums.

Everything that is learnt from the training rows, scaling included, is a sum over rows of bounded norm, released with
Gaussian noise. The cost is counted as zero-concentrated differential privacy (Bun and Steinke 2016): a sum of
sensitivity s with noise of deviation sigma costs s^2 / (2 sigma^2), costs add up, and a total of rho gives
(rho + 2 sqrt(rho ln(1 / delta)), delta). Neighbours differ by one customer's row, added or removed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela import settings as S
from clientela.operators.churn import classification_metrics
from clientela.session import materialise

# Public ranges of the features, wide enough for any shop of this kind; never read from the data.
RANGES: dict[str, tuple[float, float]] = {
    "recency_days": (0.0, 1000.0),
    "frequency": (0.0, 20.0),
    "monetary_total": (0.0, 5000.0),
    "monetary_avg": (0.0, 2000.0),
    "avg_review_score": (1.0, 5.0),
    "review_count": (0.0, 20.0),
    "payment_installments_avg": (0.0, 24.0),
    "avg_delivery_days": (0.0, 90.0),
    "late_delivery_rate": (0.0, 1.0),
    "anomaly_score": (0.0, 1.0),
    "segment_encoded": (0.0, 5.0),
}
ROUNDS = 30
# Share of the budget that scaling takes.
SCALER_SHARE = 0.2
STEP = 4.0
REGULARISATION = 1e-3
# Least spread of a scaled feature, as a share of half its range: noise can make a variance tiny or negative.
LEAST_SCALE = 0.02
LEDGER_SCHEMA = "step string, releases bigint, sensitivity double, sigma double, rho double"


def rho_of(epsilon: float, delta: float) -> float:
    """The largest rho that still gives (epsilon, delta)."""
    if not 0 < delta < 1 or not epsilon > 0:
        raise ValueError("epsilon must be positive and delta between 0 and 1")
    log = math.log(1.0 / delta)
    return (math.sqrt(log + epsilon) - math.sqrt(log)) ** 2


def epsilon_of(rho: float, delta: float) -> float:
    return rho + 2.0 * math.sqrt(rho * math.log(1.0 / delta))


@dataclass(frozen=True)
class Release:
    """``releases`` noisy sums of the same kind."""

    step: str
    releases: int
    sensitivity: float
    sigma: float

    @property
    def rho(self) -> float:
        return self.releases * self.sensitivity**2 / (2.0 * self.sigma**2) if self.sigma else math.inf


@dataclass(frozen=True)
class Budget:
    epsilon: float
    delta: float
    scaler: Release
    gradients: Release

    @classmethod
    def plan(cls, epsilon: float, delta: float, features: int, rounds: int = ROUNDS) -> Budget:
        """Noise scales that spend the whole budget; an infinite ``epsilon`` means no noise."""
        # Per row: 1 for the count, each feature in [-1, 1] and its square in [0, 1].
        reach = math.sqrt(1.0 + 2.0 * features)
        if math.isinf(epsilon):
            return cls(epsilon, delta, Release("scaler", 1, reach, 0.0), Release("gradient", rounds, 1.0, 0.0))
        rho = rho_of(epsilon, delta)
        scaling = reach / math.sqrt(2.0 * rho * SCALER_SHARE)
        each = rho * (1.0 - SCALER_SHARE) / rounds
        return cls(
            epsilon, delta, Release("scaler", 1, reach, scaling), Release("gradient", rounds, 1.0, 1.0 / math.sqrt(2.0 * each))
        )

    @property
    def rho(self) -> float:
        return self.scaler.rho + self.gradients.rho

    def ledger(self, spark: SparkSession) -> DataFrame:
        """One row for each kind of release."""
        rows = [(r.step, r.releases, r.sensitivity, r.sigma, r.rho) for r in (self.scaler, self.gradients)]
        return spark.createDataFrame(rows, LEDGER_SCHEMA)


def ranged(feature: str, ranges: Mapping[str, tuple[float, float]] = RANGES) -> Column:
    """A feature cut to its public range and moved to [-1, 1]; null and NaN are the middle."""
    low, high = ranges[feature]
    value = F.nanvl(F.col(feature).cast("double"), F.lit(None))
    cut = F.least(F.greatest(value, F.lit(low)), F.lit(high))
    return F.when(value.isNull(), F.lit(0.0)).otherwise((cut - F.lit(low)) / F.lit((high - low) / 2.0) - F.lit(1.0))


def clipped_sums(rows: DataFrame, features: list[str], ranges: Mapping[str, tuple[float, float]] = RANGES) -> DataFrame:
    """One row: count, and sum and sum of squares of each feature in [-1, 1]. Exact: not to be released as it is."""
    values = {c: ranged(c, ranges) for c in features}
    return rows.agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        *[F.coalesce(F.sum(v), F.lit(0.0)).alias(f"sum_{c}") for c, v in values.items()],
        *[F.coalesce(F.sum(v * v), F.lit(0.0)).alias(f"squares_{c}") for c, v in values.items()],
    )


@dataclass
class GaussianLogistic:
    features: list[str]
    ranges: Mapping[str, tuple[float, float]]
    budget: Budget
    rows: float
    means: np.ndarray
    scales: np.ndarray
    weights: np.ndarray

    def inputs(self) -> dict[str, Column]:
        """Scaled features and a constant, cut so that a row's norm is at most 1."""
        scaled = {
            c: (ranged(c, self.ranges) - F.lit(float(m))) / F.lit(float(s))
            for c, m, s in zip(self.features, self.means, self.scales, strict=True)
        }
        squares = [v * v for v in scaled.values()]
        norm = F.sqrt(sum(squares[1:], squares[0]))
        # Typical rows have the norm sqrt(features); twice that stays uncut, and the constant takes half of the square.
        bound = 2.0 * math.sqrt(len(self.features))
        shrink = F.lit(1.0 / math.sqrt(2.0)) / F.greatest(norm, F.lit(bound))
        return {f"_x_{c}": v * shrink for c, v in scaled.items()} | {"_x_one": F.lit(1.0 / math.sqrt(2.0))}


def noisy_scaler(sums: np.ndarray, features: int, release: Release, rng: np.random.Generator):
    """Row count, means and scales out of noisy sums: nothing exact passes."""
    noisy = sums + rng.normal(0.0, release.sigma, len(sums)) if release.sigma else sums
    n = max(1.0, float(noisy[0]))
    means = np.clip(noisy[1 : 1 + features] / n, -1.0, 1.0)
    spread = np.clip(noisy[1 + features :] / n, 0.0, 1.0) - means**2
    return n, means, np.sqrt(np.maximum(spread, LEAST_SCALE**2))


def gradient_sums(rows: DataFrame, names: list[str], weights: np.ndarray) -> np.ndarray:
    """Sum over rows of (p - y) x. A row adds a vector of norm at most 1, because x has one and |p - y| is below 1.

    A task reduces its rows to one vector; a shuffle adds the vectors up, so the driver gets ``len(names)`` numbers.
    """

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names))
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names])
            y = batch.column("churned").to_numpy(zero_copy_only=False)
            total += x.T @ (1.0 / (1.0 + np.exp(-(x @ weights))) - y)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(names), dtype=np.int32)), pa.array(total)], names=["i", "v"])

    found = np.zeros(len(names))
    for row in rows.mapInArrow(add_up, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        found[row["i"]] = row["v"]
    return found


def fit_gaussian_logistic(
    train: DataFrame,
    epsilon: float = S.DP_EPSILON,
    delta: float = S.DP_DELTA,
    seed: int = S.SEED,
    features: list[str] | None = None,
    ranges: Mapping[str, tuple[float, float]] = RANGES,
    rounds: int = ROUNDS,
) -> GaussianLogistic:
    """Noisy gradient descent: one scan of the scaled rows per round, at most one vector per task shuffled.

    Rows need ``churned`` (0 or 1; rows without are left out, as public) and the features; one row per customer is what
    the promise covers. An empty table gives a model of noise alone. The noise comes from a seeded generator so that
    runs can be repeated: a real release has to keep its seed secret.
    """
    features = list(features or S.CHURN_FEATURES)
    budget = Budget.plan(epsilon, delta, len(features), rounds)
    rng = np.random.default_rng(seed)
    known = train.where(F.col("churned").isNotNull())
    # One row of 1 + 2 x features numbers.
    sums = np.array(list(clipped_sums(known, features, ranges).first()), float)
    n, means, scales = noisy_scaler(sums, len(features), budget.scaler, rng)
    model = GaussianLogistic(features, ranges, budget, n, means, scales, np.zeros(len(features) + 1))
    inputs = model.inputs()
    points = known.select(*[v.alias(c) for c, v in inputs.items()], F.col("churned").cast("double").alias("churned"))
    points = materialise(points, "gaussian-points")
    sigma, tail = budget.gradients.sigma, np.zeros(len(inputs))
    for i in range(rounds):
        gradient = gradient_sums(points, list(inputs), model.weights)
        if sigma:
            gradient = gradient + rng.normal(0.0, sigma, len(gradient))
        model.weights = model.weights - STEP * (gradient / n + REGULARISATION * model.weights)
        # The mean of the last half of the path has less noise than its end.
        if i >= rounds // 2:
            tail += model.weights
    model.weights = tail / (rounds - rounds // 2)
    return model


def gaussian_probability(df: DataFrame, model: GaussianLogistic) -> DataFrame:
    """Add ``churn_probability``; built-in functions only."""
    terms = [v * F.lit(float(w)) for v, w in zip(model.inputs().values(), model.weights, strict=True)]
    return df.withColumn("churn_probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-sum(terms[1:], terms[0]))))


def gaussian_model_metrics(split: DataFrame, model: GaussianLogistic) -> DataFrame:
    """The metrics row of a fitted model, with the epsilon and delta that its noise amounts to."""
    budget = model.budget
    epsilon = math.inf if math.isinf(budget.epsilon) else epsilon_of(budget.rho, budget.delta)
    metrics = classification_metrics(gaussian_probability(split, model), "churn_probability")
    return metrics.withColumns({"epsilon": F.lit(epsilon), "delta": F.lit(float(budget.delta))})
