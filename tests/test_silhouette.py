"""Plain-distance silhouette against all pairs."""

import numpy as np
import pytest

from clientela.operators.segments import select_optimal_k
from clientela.operators.silhouette import plain_quality, plain_silhouette

FEATURES = ["x", "y", "z"]


def all_pairs(points, labels):
    apart = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    values = []
    for i, own in enumerate(labels):
        means = {c: apart[i][labels == c].sum() / max(1, (labels == c).sum() - (c == own)) for c in set(labels.tolist())}
        a, b = means.pop(own), min(means.values())
        values.append(0.0 if (labels == own).sum() == 1 or max(a, b) == 0 else (b - a) / max(a, b))
    return float(np.mean(values))


def table(spark, points, labels):
    rows = [(*map(float, p), int(c)) for p, c in zip(points, labels, strict=True)]
    return spark.createDataFrame(rows + [(1.0, 2.0, None, 3), (1.0, 2.0, 3.0, None)], "x double, y double, z double, cluster_id int").repartition(5)


@pytest.mark.parametrize("error", [0.1, 0.02, 0.005])
def test_within_the_error_of_all_pairs(spark, error):
    """Clusters that touch, a heavy tail, a cluster of one point, copies of one point, clusters numbered with gaps."""
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.normal(0, 1, (300, 3)), rng.normal(1.5, 1, (200, 3)), rng.lognormal(1, 1, (120, 3)), np.full((40, 3), 5.0), [[9.0, 9.0, 9.0]]])
    labels = np.repeat([0, 2, 7, 9, 11], [300, 200, 120, 40, 1])
    found = plain_silhouette(table(spark, points, labels), FEATURES, error=error).first()
    assert 0 <= found["error"] <= error
    assert abs(found["silhouette"] - all_pairs(points, labels)) <= found["error"] + 1e-6
    assert error < 0.05 or found["balls"] < len(points) / 4


def test_points_that_coincide_are_exact(spark):
    points = np.repeat([[0.0, 0.0, 0.0], [3.0, 4.0, 0.0], [0.0, 0.0, 1.0]], 50, axis=0)
    labels = np.repeat([0, 1, 0], 50)
    found = plain_silhouette(table(spark, points, labels), FEATURES, error=1e-6).first()
    assert found["silhouette"] == pytest.approx(all_pairs(points, labels), abs=1e-6)


def test_fewer_than_two_clusters(spark):
    one = table(spark, np.zeros((5, 3)), np.zeros(5))
    assert plain_silhouette(one.where("cluster_id = 0"), FEATURES).first()["silhouette"] is None
    assert plain_silhouette(one.limit(0), FEATURES).first()["silhouette"] is None


def test_k_is_chosen_by_the_plain_silhouette(spark):
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(c, 0.4, (80, 3)) for c in (0, 4, 9)])
    three = np.repeat([0, 1, 2], 80)
    rows = [(*map(float, p), int(c), int(c > 0), i % 4) for i, (p, c) in enumerate(zip(points, three, strict=True))]
    df = spark.createDataFrame(rows, "x double, y double, z double, k3 int, k2 int, k4 int")
    found = plain_quality(df, FEATURES, {2: "k2", 3: "k3", 4: "k4"})
    scores = {r["k_values"]: (r["silhouette_scores"], r["errors"]) for r in found.collect()}
    for k, labels in ((2, (three > 0).astype(int)), (3, three), (4, np.arange(240) % 4)):
        assert abs(scores[k][0] - all_pairs(points, labels)) <= scores[k][1] + 1e-6
    assert select_optimal_k(found).first()["k"] == 3
