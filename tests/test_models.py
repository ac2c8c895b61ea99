import itertools
import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from clientela import settings as S
from clientela.operators import anomaly, churn, explain, private, segments
from clientela.plans import jobs
from clientela.session import spread


def feature_rows(n, seed=7):
    rng = np.random.default_rng(seed)
    return pd.DataFrame(
        {
            "customer_hash": [f"h{i:05d}" for i in range(n)],
            "recency_days": rng.integers(1, 400, n),
            "frequency": rng.integers(1, 20, n),
            "monetary_total": rng.uniform(100, 5000, n).round(2),
            "monetary_avg": rng.uniform(50, 500, n).round(2),
            "avg_review_score": rng.uniform(1, 5, n).round(2),
            "review_count": rng.integers(0, 9, n),
            "payment_installments_avg": rng.uniform(1, 12, n).round(2),
            "unique_product_categories": 0,
            "avg_delivery_days": rng.uniform(1, 30, n).round(2),
            "late_delivery_rate": rng.uniform(0, 1, n).round(2),
        }
    )


@pytest.fixture(scope="module")
def matrix(spark):
    pdf = feature_rows(600)
    pdf.loc[0, ["recency_days", "frequency", "monetary_total", "monetary_avg"]] = [5000, 900, 9e6, 9e5]
    schema = (
        "customer_hash string, recency_days long, frequency long, monetary_total double, monetary_avg double, "
        "avg_review_score double, review_count long, payment_installments_avg double, "
        "unique_product_categories long, avg_delivery_days double, late_delivery_rate double"
    )
    nulls = {"anomaly_score": F.lit(None).cast("double"), "segment_label": F.lit(None).cast("string")}
    return spark.createDataFrame(pdf, schema).withColumns(nulls).repartition(8).cache()


# --- isolation forest ----------------------------------------------------------
@pytest.fixture(scope="module")
def trained_forest(matrix):
    return anomaly.train_isolation_forest(matrix)


def test_forest_shape_and_determinism(matrix, trained_forest):
    forest = trained_forest[0]
    assert forest.trees == 100
    roots = forest.nodes[forest.nodes["node"] == 0]
    assert set(roots["size"]) == {256} and forest.subsample == 256
    assert forest.nodes["depth"].max() <= 8
    inner = forest.nodes[forest.nodes["left"] >= 0]
    sizes = forest.nodes.set_index(["tree", "node"])["size"]
    for r in inner.sample(200, random_state=1).itertuples():
        assert r.size == sizes[r.tree, r.left] + sizes[r.tree, r.right]
    again = anomaly.fit_forest(matrix.repartition(3))
    pd.testing.assert_frame_equal(forest.nodes, again.nodes)
    assert not anomaly.fit_forest(matrix, seed=1).nodes.equals(forest.nodes)


def test_small_table_uses_all_rows(matrix):
    forest = anomaly.fit_forest(matrix.limit(40), trees=5)
    assert set(forest.nodes.loc[forest.nodes["node"] == 0, "size"]) == {40}


def test_large_table_sample_stays_bounded(spark):
    big = spark.range(200_000).select(F.col("id").cast("string").alias("k"))
    counts = anomaly.tree_samples(big, "k", trees=10, subsample=64).groupBy("tree").count().toPandas()
    assert len(counts) == 10
    assert counts["count"].between(64, 64 * 2.5).all()


def test_scores_follow_the_definition(matrix, trained_forest):
    forest, raw, metrics = trained_forest
    scores = anomaly.score_raw(raw, forest.cut).toPandas().set_index("customer_hash")
    assert scores["anomaly_score"].between(0, 1).all()
    assert scores["anomaly_score"].idxmax() == "h00000"
    assert set(scores["anomaly_flag"]) <= set(S.ANOMALY_FLAGS)
    raw_pd = raw.toPandas().set_index("customer_hash")["raw_score"]
    assert forest.cut == pytest.approx(np.quantile(raw_pd, S.CONTAMINATION))
    assert (scores["is_anomaly"] == (raw_pd < forest.cut)).all()
    row = metrics.first()
    assert row["n_anomalies"] == scores["is_anomaly"].sum() == 30
    assert row["anomaly_rate"] == pytest.approx(0.05)
    # walk one row through every tree by hand
    pdf = matrix.where("customer_hash = 'h00042'").toPandas()
    x = pdf[S.ANOMALY_FEATURES].to_numpy(dtype=float)[0]
    lengths = []
    for _, tree in forest.nodes.groupby("tree"):
        nodes, at = tree.set_index("node"), 0
        while nodes.loc[at, "left"] >= 0:
            n = nodes.loc[at]
            at = int(n["left"] if x[int(n["feature"])] <= n["threshold"] else n["right"])
        lengths.append(nodes.loc[at, "depth"] + float(anomaly.average_path(nodes.loc[at, "size"])))
    want = -(2 ** (-np.mean(lengths) / float(anomaly.average_path(256))))
    assert raw_pd["h00042"] == pytest.approx(want)


def test_average_path_known_values():
    assert list(anomaly.average_path(np.array([0, 1, 2]))) == [0, 0, 1]
    assert float(anomaly.average_path(256)) == pytest.approx(10.2447, abs=1e-3)


def test_flag_bands(spark):
    df = spark.createDataFrame([(0.7,), (0.6999,), (0.49,), (0.4899,), (0.0,)], "s double")
    got = [r["f"] for r in df.select(anomaly.flag_band("s").alias("f")).collect()]
    assert got == ["anomalous", "suspicious", "suspicious", "normal", "normal"]


def test_equal_scores_give_null(spark):
    df = spark.createDataFrame([("a", -0.5), ("b", -0.5)], "customer_hash string, raw_score double")
    assert [r["anomaly_score"] for r in anomaly.score_raw(df, -0.6).collect()] == [None, None]


def test_gate_rejects_gaps(matrix):
    with pytest.raises(ValueError, match="Missing"):
        anomaly.fit_forest(matrix.drop("frequency"))
    with pytest.raises(ValueError, match="Null values"):
        anomaly.fit_forest(matrix.withColumn("frequency", F.lit(None).cast("long")))


def test_forest_round_trip(spark, matrix, trained_forest, tmp_path):
    forest = trained_forest[0]
    forest.save(spark, str(tmp_path / "f"))
    loaded = anomaly.Forest.load(spark, str(tmp_path / "f"))
    a = anomaly.score_anomalies(matrix, forest, reuse_training_span=True)
    b = anomaly.score_anomalies(matrix, loaded, reuse_training_span=True)
    assert a.exceptAll(b).count() == 0
    with pytest.raises(ValueError, match="train"):
        anomaly.score_anomalies(matrix, anomaly.Forest(forest.nodes, 256))


# --- explanations -------------------------------------------------------------------
def conditional_value(tree, x, known):
    """Expected leaf value when only the features in ``known`` are given."""

    def walk(node):
        r = tree[node]
        if r["left"] < 0:
            return r["value"]
        if r["feature"] in known:
            return walk(r["left"] if x[r["feature"]] <= r["threshold"] else r["right"])
        left, right = tree[r["left"]], tree[r["right"]]
        return (left["cover"] * walk(r["left"]) + right["cover"] * walk(r["right"])) / r["cover"]

    return walk(0)


def brute_shapley(tree, x):
    m = len(x)
    out = np.zeros(m)
    for j in range(m):
        others = [i for i in range(m) if i != j]
        for size in range(m):
            weight = math.factorial(size) * math.factorial(m - size - 1) / math.factorial(m)
            for known in itertools.combinations(others, size):
                gain = conditional_value(tree, x, {*known, j}) - conditional_value(tree, x, set(known))
                out[j] += weight * gain
    return out


def test_contributions_equal_brute_force_shapley():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(60, 4))
    nodes = pd.DataFrame(anomaly._grow_tree(rows, rng), columns=["node", "feature", "threshold", "left", "right", "size", "depth"])
    nodes["tree"], nodes["cover"] = 0, nodes["size"].astype(float)
    nodes["value"] = nodes["depth"] + anomaly.average_path(nodes["size"].to_numpy())
    tree = nodes.set_index("node").to_dict("index")
    leaves = explain.LeafTable(nodes)
    for x in rng.normal(size=(5, 4)):
        np.testing.assert_allclose(leaves.contributions(x[None])[0], brute_shapley(tree, x), atol=1e-9)


def test_forest_explanations_add_up(matrix, trained_forest):
    forest, raw, _ = trained_forest
    got = explain.explain_rows(matrix, explain.forest_leaves(forest), S.ANOMALY_FEATURES, 40, "customer_hash").toPandas()
    assert len(got) == 40
    raw_pd = raw.toPandas().set_index("customer_hash")["raw_score"]
    scale = float(anomaly.average_path(forest.subsample))
    for r in got.itertuples():
        mean_path = -math.log2(-raw_pd[r.customer_hash]) * scale
        assert sum(r.contributions) + r.base == pytest.approx(mean_path)


def test_anomaly_json_has_three_ordered_features(matrix, trained_forest):
    got = explain.anomaly_shap(matrix, trained_forest[0]).collect()
    assert len(got) == 600
    assert explain.anomaly_shap(matrix, trained_forest[0], samples=50).count() == 50
    for r in got[:50]:
        values = json.loads(r["shap_values"])
        assert len(values) == 3 and set(values) <= set(S.ANOMALY_FEATURES)
        sizes = [abs(v) for v in values.values()]
        assert sizes == sorted(sizes, reverse=True)


def test_no_trees_gives_an_empty_table(matrix):
    empty = anomaly.Forest(pd.DataFrame(columns=["tree", "node"]), 0)
    got = explain.anomaly_shap(matrix, empty)
    assert (got.columns, got.count()) == (["customer_hash", "shap_values"], 0)


def test_top_contribution_ties_keep_feature_order(spark):
    df = spark.createDataFrame([("a", [1.0, -2.0, 2.0, 0.5])], "customer_hash string, contributions array<double>")
    got = explain.top_contributions(df, ["w", "x", "y", "z"], 3).first()["shap_values"]
    assert list(json.loads(got).items()) == [("x", -2.0), ("y", 2.0), ("w", 1.0)]


# --- segmentation ----------------------------------------------------------------------
@pytest.fixture(scope="module")
def points(matrix):
    return segments.prepare_points(matrix)


def test_scaled_features_are_standard(points):
    pdf = points[0].toPandas()[S.SEGMENT_FEATURES]
    np.testing.assert_allclose(pdf.mean(), 0, atol=1e-9)
    np.testing.assert_allclose(pdf.std(ddof=0), 1, atol=1e-9)


def test_constant_feature_scales_by_one(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0)], "a double, b double")
    scaled = segments.apply_scaler(df, segments.fit_scaler(df, ["a", "b"])).toPandas()
    assert list(scaled["a"]) == [0.0, 0.0]


@pytest.fixture(scope="module")
def sweep(points):
    return segments.find_optimal_k(points[0], 3, 6, starts=4)


def test_sweep_quality(sweep):
    rows = sweep[0].collect()
    assert [r["k_values"] for r in rows] == [3, 4, 5, 6]
    inertias = [r["inertias"] for r in rows]
    assert inertias == sorted(inertias, reverse=True)
    assert all(-1 <= r["silhouette_scores"] <= 1 and r["davies_bouldin_scores"] > 0 for r in rows)
    for r in rows:
        assert r["inertias"] == pytest.approx(sweep[1][r["k_values"]].inertia)


def test_fit_is_a_local_optimum_and_deterministic(points, sweep):
    x = points[0].toPandas()[S.SEGMENT_FEATURES].to_numpy()
    c = sweep[1][4].centroids
    labels = ((x[:, None, :] - c[None]) ** 2).sum(2).argmin(1)
    moved = np.array([x[labels == i].mean(0) for i in range(4)])
    assert ((moved - c) ** 2).sum() < 1e-2
    again = segments.fit_kmeans(points[0].repartition(3), [4], starts=4)[4]
    np.testing.assert_allclose(again.centroids, c, atol=1e-6)


def test_planted_clusters_are_found(spark):
    rng = np.random.default_rng(0)
    centres = np.array([[0, 0], [10, 0], [0, 10]])
    rows = [(f"p{i}", *map(float, centres[i % 3] + rng.normal(size=2))) for i in range(300)]
    df = spark.createDataFrame(rows, "customer_hash string, a double, b double")
    fit = segments.fit_kmeans(df, [3], features=["a", "b"], starts=5)[3]
    labels = df.withColumn("c", segments.nearest_cluster(fit.centroids, ["a", "b"])).toPandas()
    assert labels.groupby(labels.index % 3)["c"].nunique().max() == 1


def brute_silhouette(x, labels, power):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) ** power
    out = []
    for i, own in enumerate(labels):
        same = labels == own
        if same.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, same].sum() / (same.sum() - 1)
        b = min(d[i, labels == o].mean() for o in set(labels) - {own})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def brute_davies_bouldin(x, labels):
    names = sorted(set(labels))
    centres = [x[labels == c].mean(0) for c in names]
    scatter = [np.linalg.norm(x[labels == c] - m, axis=1).mean() for c, m in zip(names, centres, strict=True)]
    worst = [
        max((scatter[i] + scatter[j]) / np.linalg.norm(centres[i] - centres[j]) for j in range(len(names)) if j != i)
        for i in range(len(names))
    ]
    return float(np.mean(worst))


def test_quality_matches_brute_force(points):
    df = points[0].withColumn("g", F.pmod(F.hash("customer_hash"), F.lit(4))).withColumn(
        "lone", F.when(F.col("customer_hash") == "h00001", 9).otherwise(F.col("g"))
    )
    pdf = df.toPandas()
    x = pdf[S.SEGMENT_FEATURES].to_numpy()
    rows = segments.cluster_quality(df, S.SEGMENT_FEATURES, {4: "g", 5: "lone"}).collect()
    got = {r["k_values"]: r for r in rows}
    for k, column in ((4, "g"), (5, "lone")):
        labels = pdf[column].to_numpy()
        assert got[k]["silhouette_scores"] == pytest.approx(brute_silhouette(x, labels, 2))
        assert got[k]["davies_bouldin_scores"] == pytest.approx(brute_davies_bouldin(x, labels))
    vectors = VectorAssembler(inputCols=S.SEGMENT_FEATURES, outputCol="features").transform(df)
    library = ClusteringEvaluator(predictionCol="g").evaluate(vectors.withColumn("g", F.col("g").cast("double")))
    assert got[4]["silhouette_scores"] == pytest.approx(library)


def test_one_cluster_has_no_separation(points):
    row = segments.cluster_quality(points[0].withColumn("g", F.lit(0)), S.SEGMENT_FEATURES, {1: "g"}).first()
    assert row["silhouette_scores"] is None and row["davies_bouldin_scores"] is None


def test_select_k(spark):
    schema = "k_values int, silhouette_scores double"
    assert segments.select_optimal_k(spark.createDataFrame([(3, 0.2), (5, 0.4), (4, 0.4)], schema)).first()["k"] == 4
    empty = spark.createDataFrame([], schema)
    assert segments.select_optimal_k(empty).first()["k"] == 3
    assert segments.select_optimal_k(empty, 5).first()["k"] == 5


MARKS = [("recency_days", 10.0, 50.0, 100.0, 200.0), ("frequency", 2.0, 4.0, 8.0, 16.0), ("monetary_total", 10.0, 20.0, 30.0, 40.0)]


@pytest.mark.parametrize(
    ("recency", "frequency", "monetary", "label"),
    [
        (5.0, 9.0, 35.0, "champions"),
        (5.0, 9.0, 5.0, "loyal"),
        (60.0, 3.0, 5.0, "at_risk"),
        (5.0, 1.0, 5.0, "new_customers"),
        (60.0, 1.0, 5.0, "hibernating"),
        (250.0, 1.0, 5.0, "lost"),
        # nothing fires: first label
        (40.0, 3.0, 5.0, "champions"),
        # loyal, at_risk and hibernating tie at 2: declared order decides
        (60.0, 4.0, 5.0, "loyal"),
    ],
)
def test_label_rules(spark, recency, frequency, monetary, label):
    marks = spark.createDataFrame(MARKS, "feature string, p25 double, p50 double, p75 double, p90 double")
    profile = spark.createDataFrame([(0, recency, frequency, monetary)], "cluster_id int, recency_days double, frequency double, monetary_total double")
    assert segments.label_clusters(profile, marks).first()["segment_label"] == label


def test_profiles_cover_everyone(matrix, points, sweep):
    centroids = sweep[1][3].to_frame(matrix.sparkSession)
    clusters = segments.assign_clusters(points[0], centroids)
    assigned = segments.assign_segments(matrix, clusters)
    assert assigned.columns == ["customer_hash", "cluster_id", "segment_label"]
    assert assigned.count() == 600
    profiles = segments.segment_profiles(matrix, assigned).collect()
    assert sum(r["count"] for r in profiles) == 600
    totals = [r["avg_monetary_total"] for r in profiles]
    assert totals == sorted(totals, reverse=True)
    projected = segments.project_clusters(clusters)
    assert projected.columns == ["customer_hash", "cluster_id", "pc1", "pc2"]
    assert projected.count() == 600


# --- churn ---------------------------------------------------------------------------------
def test_labels(spark):
    df = spark.createDataFrame([("a", 180), ("b", 181), ("c", None)], "customer_hash string, recency_days long")
    got = {r["customer_hash"]: r["churned"] for r in churn.build_churn_labels(df).collect()}
    assert got == {"a": 0, "b": 1, "c": 0}
    assert "recency_days" not in churn.build_churn_labels(df, drop_label_source=True).columns
    row = churn.label_distribution(churn.build_churn_labels(df)).first()
    assert (row["active"], row["churned"]) == (2, 1)


@pytest.fixture(scope="module")
def prepared(matrix, trained_forest):
    forest, raw, _ = trained_forest
    scores = anomaly.score_raw(raw, forest.cut).where("customer_hash > 'h00100'")
    labels = matrix.select("customer_hash", F.lit("loyal").alias("segment_label")).where("customer_hash > 'h00200'")
    return churn.prepare_churn_features(churn.build_churn_labels(matrix), scores, labels).cache()


def test_merged_features(prepared):
    assert prepared.columns == ["customer_hash", *S.CHURN_FEATURES, "churned"]
    pdf = prepared.toPandas().set_index("customer_hash")
    assert len(pdf) == 600
    assert pdf.loc["h00050", "anomaly_score"] == 0.5
    assert pdf.loc["h00050", "segment_encoded"] == 4
    assert pdf.loc["h00300", "segment_encoded"] == 1


def test_unknown_segment_fails_the_gate(matrix):
    scores = matrix.select("customer_hash", F.lit(0.1).alias("anomaly_score"))
    labels = matrix.select("customer_hash", F.lit("vip").alias("segment_label"))
    with pytest.raises(ValueError, match="segment_encoded"):
        churn.prepare_churn_features(churn.build_churn_labels(matrix), scores, labels)


@pytest.mark.parametrize("share", [0.0, 0.1, 0.5, 0.8, 1.0])
@pytest.mark.parametrize("values", [1, 7, 400])
def test_split_equals_a_sorted_cut(spark, share, values):
    rows = [(f"h{i:04d}", (i * 37) % values, i % 2) for i in range(501)]
    df = spark.createDataFrame(rows, "customer_hash string, recency_days long, churned int").repartition(8)
    got = {r["customer_hash"] for r in churn.ordered_split(df, share).where("split = 'train'").collect()}
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    assert got == {r[0] for r in ordered[: int(share * 501)]}


@pytest.fixture(scope="module")
def split(prepared):
    return churn.ordered_split(prepared).cache()


@pytest.fixture(scope="module")
def booster(split):
    return churn.train_churn_model(split, rounds=8)


def test_churn_metrics(booster):
    row = booster[1].first().asDict()
    assert set(row) == {"roc_auc", "f1", "precision", "recall", "train_size", "test_size", "churn_rate_train", "churn_rate_test"}
    assert (row["train_size"], row["test_size"]) == (480.0, 120.0)
    # the tail of the split holds only churned customers: no AUC
    assert row["churn_rate_test"] == 1.0 and row["roc_auc"] is None
    assert 0 <= row["f1"] <= 1


def test_probabilities(prepared, booster):
    scores = churn.score_churn(prepared, booster[0]).toPandas()
    assert scores["churn_probability"].between(0, 1).all()
    assert (scores["predicted_churn"] == (scores["churn_probability"] >= 0.6)).all()


def test_booster_explanations_add_up(prepared, booster):
    nodes = explain.boosting_nodes(prepared, booster[0])
    got = explain.explain_rows(prepared, explain.LeafTable(nodes), S.CHURN_FEATURES, 30, "customer_hash").toPandas()
    scores = churn.score_churn(prepared, booster[0]).toPandas().set_index("customer_hash")["churn_probability"]
    for r in got.itertuples():
        p = scores[r.customer_hash]
        assert sum(r.contributions) + r.base == pytest.approx(math.log(p / (1 - p)))
    values = [json.loads(r["shap_values"]) for r in explain.churn_shap(prepared, booster[0]).collect()]
    assert len(values) == 600 and all(len(v) == 5 for v in values)


def test_threshold_metrics_without_positives(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "p double, churned int")
    assert tuple(churn.threshold_metrics(df, "p").first()) == (0.0, 0.0, 0.0)


@pytest.mark.parametrize("values", [1, 9, 1000])
def test_precision_at_share(spark, values):
    rows = [(f"h{i:04d}", ((i * 61) % values) / values, i % 3 == 0) for i in range(705)]
    df = spark.createDataFrame([(k, p, int(y)) for k, p, y in rows], "customer_hash string, churn_probability double, churned int").repartition(8)
    got = churn.precision_at_share(df).first()
    top = sorted(rows, key=lambda r: (-r[1], r[0]))[:70]
    assert (got["k"], got["precision_at_k"]) == (70, pytest.approx(sum(r[2] for r in top) / 70))


# --- private fit ----------------------------------------------------------------------------
def test_noise_free_fit_is_the_ridge_optimum(split):
    train = split.where("split = 'train'")
    model = private.fit_private_logistic(train, math.inf)
    rows = private.unit_rows(train, S.CHURN_FEATURES, model.scaler).toPandas()
    x = rows[[f"_z_{c}" for c in S.CHURN_FEATURES] + ["_z_one"]].to_numpy()
    y = rows["churned"].to_numpy()
    assert (np.linalg.norm(x, axis=1) <= 1 + 1e-12).all()
    p = 1 / (1 + np.exp(-x @ model.weights))
    np.testing.assert_allclose(x.T @ (p - y) + model.weights, 0, atol=1e-4)


def test_noise_depends_on_epsilon_and_seed():
    small, _ = private.perturbation(12, 10.0, 42)
    large, extra = private.perturbation(12, 0.3, 42)
    assert np.linalg.norm(large) > np.linalg.norm(small) > 0
    assert extra > 0
    np.testing.assert_array_equal(small, private.perturbation(12, 10.0, 42)[0])
    assert not np.array_equal(small, private.perturbation(12, 10.0, 43)[0])
    assert private.perturbation(12, math.inf, 42)[0].any() == False  # noqa: E712
    with pytest.raises(ValueError, match="positive"):
        private.perturbation(12, 0.0, 42)


def test_private_metrics_and_tradeoff(split):
    model, metrics = private.train_private_model(split, epsilon=2.0)
    row = metrics.first()
    assert model is not None and row["epsilon"] == 2.0 and row["dp_training_failed"] == 0.0
    assert row["train_size"] == 480.0
    table = private.privacy_tradeoff(split, [1.0, math.inf]).collect()
    assert [r["epsilon"] for r in table] == [1.0, math.inf]


def test_failed_private_fit_gives_a_marker(split, monkeypatch):
    def fail(*_args, **_kwargs):
        raise np.linalg.LinAlgError("singular")

    monkeypatch.setattr(private, "fit_private_logistic", fail)
    model, metrics = private.train_private_model(split, epsilon=2.0)
    row = metrics.first()
    assert model is None and row["dp_training_failed"] == 1.0 and row["roc_auc"] is None


# --- the whole job -----------------------------------------------------------------------------
def test_training_and_scoring_jobs(spark, matrix, tmp_path):
    full = matrix.withColumn("snapshot_date", F.lit("2018-10-17").cast("timestamp"))
    result = jobs.training_job(full, rounds=3, k_range=(3, 4), epsilon=None)
    assert result.anomaly_scores.count() == result.churn_scores.count() == 600
    assert result.segment_assignments.where(F.col("segment_label").isin(S.SEGMENT_LABELS)).count() == 600
    assert result.private_metrics is None
    result.models.save(spark, str(tmp_path / "models"))
    scored = jobs.scoring_from_saved(spark, full, str(tmp_path / "models"))
    for name, want in (
        ("anomaly_scores", result.anomaly_scores),
        ("segment_assignments", result.segment_assignments),
        ("churn_scores", result.churn_scores),
    ):
        got = scored[name].select(*want.columns)
        assert got.exceptAll(want).count() == 0, name
    with pytest.raises(FileNotFoundError, match="Missing required inputs"):
        jobs.scoring_from_saved(spark, full, str(tmp_path / "absent"))


def test_starts_see_the_whole_table(spark):
    """A small far cluster among many rows is always among the candidates."""
    rows = spark.range(60_000).select(
        F.col("id").cast("string").alias("customer_hash"),
        F.when(F.col("id") == 31_337, 1000.0).otherwise(F.rand(1)).alias("a"),
        F.rand(2).alias("b"),
    )
    fit = segments.fit_kmeans(rows, [3], features=["a", "b"], starts=1)[3]
    assert fit.centroids[:, 0].max() == 1000.0


def test_too_few_rows_for_the_clusters(spark):
    rows = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "customer_hash string, a double")
    with pytest.raises(ValueError, match="cannot fit 3 clusters to 2 rows"):
        segments.fit_kmeans(rows, [3], features=["a"])


def test_gaps_of_tight_clusters_far_from_the_origin(spark):
    rows = [(f"p{i}", 1e8 + (i % 2) * 10 + (i % 3) * 1e-3, i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "customer_hash string, a double, g int")
    got = segments.cluster_quality(df, ["a"], {2: "g"}).first()["inertias"]
    x = np.array([r[1] for r in rows])
    want = sum(((x[g::2] - x[g::2].mean()) ** 2).sum() for g in (0, 1))
    assert got == pytest.approx(want, rel=1e-3)


def test_all_privacy_levels_share_their_scans(split):
    tracker = split.sparkSession.sparkContext.statusTracker()
    train = split.where("split = 'train'")

    def jobs_of(levels, group):
        split.sparkSession.sparkContext.setJobGroup(group, group)
        models = private.fit_private_models(train, levels)
        split.sparkSession.sparkContext.setJobGroup("tests", "tests")
        return models, len(tracker.getJobIdsForGroup(group))

    alone = [jobs_of([e], f"one-{e}") for e in (1.0, 5.0)]
    together, jobs_run = jobs_of([1.0, 5.0], "both")
    assert jobs_run < sum(n for _, n in alone)
    for (models, _), e in zip(alone, (1.0, 5.0), strict=True):
        np.testing.assert_allclose(models[e].weights, together[e].weights, atol=1e-8)


def test_stacked_models_sum_like_each_alone():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 3))
    models = {m: x[rng.choice(len(x), k)] for m, k in enumerate([4, 2, 3, 4, 1])}
    models[5] = np.vstack([x[:2], x[:2]])  # equally near: the first takes the point
    stacked = segments.Stacked(models)
    for start in range(0, len(x), 128):
        stacked.add(x[start : start + 128])
    for m, found in stacked.totals().items():
        assert np.allclose(found, segments._batch_sums(x, models[m]), atol=1e-9)


@pytest.fixture(scope="module")
def one_split(spark):
    """Rows that all stand in one partition."""
    names = S.SEGMENT_FEATURES
    values = [(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 10).alias(c) for i, c in enumerate(names)]
    rows = spark.range(0, 45_000, 1, 1).select(F.col("id").cast("string").alias("customer_hash"), *values)
    return rows.localCheckpoint()


def partition_sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_rows_of_one_split_are_spread_over_the_cores(spark, one_split):
    sizes = partition_sizes(spread(one_split, "customer_hash"))
    assert len(sizes) == 5 and max(sizes) < 12_000 and sum(sizes) == 45_000
    assert len(partition_sizes(spread(one_split.limit(7), "customer_hash"))) == 1
    assert spread(one_split.limit(0), "customer_hash").count() == 0


def test_sweep_scans_and_explanations_use_several_tasks(one_split, monkeypatch):
    seen = []
    monkeypatch.setattr(segments, "_candidates", lambda points, *rest: seen.append(partition_sizes(points)) or (np.zeros((0, 7)), np.zeros(0)))
    with pytest.raises(ValueError):
        segments.fit_kmeans(one_split, [2], starts=1)
    assert len(seen[0]) == 5
    leaves = explain.LeafTable(pd.DataFrame([(0, 0, 0, 50.0, 1, 2, 4.0, 0.0), (0, 1, -1, 0.0, -1, -1, 2.0, 1.0), (0, 2, -1, 0.0, -1, -1, 2.0, 3.0)], columns=["tree", "node", "feature", "threshold", "left", "right", "cover", "value"]))
    explained = explain.explain_rows(one_split, leaves, S.SEGMENT_FEATURES, None, "customer_hash")
    assert len(partition_sizes(explained)) == 5
    assert explained.where(F.abs(F.col("contributions")[0]) == 1.0).count() == 45_000


def test_booster_rounds_use_several_tasks(one_split, monkeypatch):
    seen = []

    def fit(self, vectors):
        seen.append(partition_sizes(vectors))
        raise InterruptedError

    monkeypatch.setattr(churn.GBTClassifier, "fit", fit)
    split = one_split.select("*", F.lit("train").alias("split"), F.lit(1).alias("churned"))
    with pytest.raises(InterruptedError):
        churn.train_churn_model(split, 1, features=S.SEGMENT_FEATURES)
    assert len(seen[0]) == 5
