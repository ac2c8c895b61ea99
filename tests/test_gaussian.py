"""Budget, noise and data part of the Gaussian mechanism."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clientela.operators import gaussian
from clientela.operators.gaussian import Budget, clipped_sums, epsilon_of, fit_gaussian_logistic, noisy_scaler, rho_of

FEATURES = ["recency_days", "frequency"]


@pytest.mark.parametrize("epsilon", [0.1, 1.0, 2.0, 8.0])
@pytest.mark.parametrize("delta", [1e-6, 1e-3])
def test_budget_is_spent_exactly(epsilon, delta):
    plan = Budget.plan(epsilon, delta, 11, rounds=7)
    assert math.isclose(plan.rho, rho_of(epsilon, delta))
    assert math.isclose(epsilon_of(plan.rho, delta), epsilon)
    assert plan.gradients.releases == 7 and plan.scaler.sensitivity == math.sqrt(23)


def test_smaller_delta_needs_more_noise():
    noise = [Budget.plan(2.0, d, 5).gradients.sigma for d in (1e-3, 1e-5, 1e-7)]
    assert noise == sorted(noise) and noise[0] < noise[2]


@pytest.mark.parametrize("epsilon, delta", [(0, 1e-5), (-1, 1e-5), (1, 0), (1, 1)])
def test_no_such_budget(epsilon, delta):
    with pytest.raises(ValueError):
        rho_of(epsilon, delta)


def test_noise_moments():
    release = Budget.plan(2.0, 1e-5, 1000).scaler
    sums = np.concatenate([[1e9], np.zeros(1000), np.full(1000, 5e8)])
    n, means, scales = noisy_scaler(sums, 1000, release, np.random.default_rng(3))
    drawn = np.concatenate([[n - 1e9], means * n])
    assert abs(drawn.mean()) < 4 * release.sigma / math.sqrt(len(drawn))
    assert abs(drawn.std() / release.sigma - 1) < 0.1
    assert np.allclose(scales**2, 0.5, atol=1e-3)


@pytest.fixture(scope="module")
def rows(spark):
    """Churn follows recency; one row of nulls and one far outside the ranges."""
    made = spark.range(4000).select(
        (F.col("id") % 400).cast("double").alias("recency_days"),
        (F.col("id") % 7).cast("double").alias("frequency"),
        F.when(F.col("id") % 400 > 180, 1).otherwise(0).alias("churned"),
    )
    return made.unionByName(spark.createDataFrame([(None, float("nan"), 0), (1e12, -1e12, 1)], made.schema))


def test_clipped_sums(rows):
    found = clipped_sums(rows, FEATURES).first()
    recency = np.append(np.arange(4000) % 400 / 500 - 1, [0, 1])
    frequency = np.append(np.arange(4000) % 7 / 10 - 1, [0, -1])
    expected = [4002, recency.sum(), frequency.sum(), (recency**2).sum(), (frequency**2).sum()]
    assert np.allclose(list(found), expected)


def test_one_row_adds_a_bounded_vector(rows):
    sums = [np.array(list(clipped_sums(r, FEATURES).first())) for r in (rows, rows.where("recency_days < 1e9 OR recency_days IS NULL"))]
    assert np.linalg.norm(sums[0] - sums[1]) <= Budget.plan(1.0, 1e-5, 2).scaler.sensitivity


def test_fit_learns_and_noise_hurts(rows):
    def right(epsilon, seed=1):
        model = fit_gaussian_logistic(rows, epsilon, 1e-5, seed, FEATURES)
        scored = gaussian.gaussian_probability(rows, model)
        assert set(rows.columns) < set(scored.columns)
        return scored.agg(F.avg(((F.col("churn_probability") > 0.5).cast("int") == F.col("churned")).cast("int"))).first()[0]

    assert right(math.inf) > 0.9 and right(4.0) > 0.8
    assert right(0.001) < right(math.inf)


def test_norms_and_empty_table(rows):
    model = fit_gaussian_logistic(rows.limit(0), 1.0, 1e-5, 1, FEATURES, rounds=2)
    assert np.isfinite(model.weights).all()
    values = list(model.inputs().values())
    size = sum([v * v for v in values[1:]], values[0] * values[0])
    assert rows.agg(F.max(size)).first()[0] <= 1 + 1e-9
