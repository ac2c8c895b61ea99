from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clientela import settings as S
from clientela.operators import monitoring, serving
from clientela.plans import jobs
from clientela.sources import publish, tables

NOW = datetime(2024, 5, 1, 8, 30, tzinfo=UTC)
ANOMALY = [
    ("k1aaaaaaaa", 0.97, True, "anomalous"),
    ("k2aaaaaaaa", 0.80, True, "anomalous"),
    ("k3aaaaaaaa", 0.55, False, "suspicious"),
    ("k4aaaaaaaa", 0.0, False, "normal"),
    ("k5aaaaaaaa", 0.04, False, "normal"),
]
CHURN = [
    ("k1aaaaaaaa", 0.93, True),
    ("k2aaaaaaaa", 0.70, True),
    ("k3aaaaaaaa", 0.41, False),
    ("k4aaaaaaaa", 0.0, False),
    ("k6aaaaaaaa", 0.05, False),
]
SEGMENT = [("k1aaaaaaaa", 0, "champions"), ("k2aaaaaaaa", 1, "at_risk"), ("k3aaaaaaaa", 2, "loyal"), ("k4aaaaaaaa", 0, "champions"), ("k9aaaaaaaa", 1, "at_risk")]


@pytest.fixture
def anomalies(spark):
    return spark.createDataFrame(ANOMALY, "customer_hash string, anomaly_score double, is_anomaly boolean, anomaly_flag string")


@pytest.fixture
def churned(spark):
    return spark.createDataFrame(CHURN, "customer_hash string, churn_probability double, predicted_churn boolean")


@pytest.fixture
def segmented(spark):
    return spark.createDataFrame(SEGMENT, "customer_hash string, cluster_id int, segment_label string")


@pytest.fixture
def profiles(spark):
    schema = "segment_label string, count long, avg_recency_days double, avg_monetary_total double"
    return spark.createDataFrame([("champions", 2, 10.126, 99.999), ("at_risk", 2, 200.5, 3.004)], schema)


# --- summaries ----------------------------------------------------------------
def test_summary(anomalies):
    row = serving.anomaly_summary(anomalies).first()
    assert (row["total_customers_scored"], row["anomaly_count"], row["suspicious_count"], row["normal_count"]) == (5, 2, 1, 2)
    assert (row["anomaly_rate"], row["period_days"]) == (0.4, 7)
    empty = serving.anomaly_summary(anomalies.limit(0), days=30).first()
    assert (empty["total_customers_scored"], empty["anomaly_rate"], empty["period_days"]) == (0, 0.0, 30)


def test_summary_of_a_period(anomalies):
    stamped = anomalies.withColumn(
        "scored_at", F.when(F.col("anomaly_score") > 0.9, F.lit(datetime(2024, 1, 1))).otherwise(F.lit(datetime(2024, 4, 30)))
    )
    row = serving.anomaly_summary(stamped, 7, filter_from=NOW).first()
    assert (row["total_customers_scored"], row["anomaly_count"]) == (4, 1)


@pytest.mark.parametrize(("bad", "of", "text"), [(1, 4, S.RATE_TEXT_HIGH), (1, 10, S.RATE_TEXT_MODERATE), (1, 20, S.RATE_TEXT_LOW)])
def test_interpretation(spark, bad, of, text):
    df = spark.range(of).select(
        F.concat(F.lit("c"), "id").alias("customer_hash"),
        F.lit(0.123456).alias("anomaly_score"),
        F.when(F.col("id") < bad, "anomalous").otherwise("normal").alias("anomaly_flag"),
    )
    row = serving.interpreted_summary(df).first()
    assert (row["status"], row["interpretation"], row["anomaly_rate_percent"]) == ("ok", text, round(100 * bad / of, 2))


def test_top_anomalous_are_the_five_highest(spark):
    df = spark.range(40).select(
        F.format_string("c%02d", "id").alias("customer_hash"), ((F.col("id") % 8) / 7).alias("anomaly_score"), F.lit("anomalous").alias("anomaly_flag")
    )
    top = serving.interpreted_summary(df.repartition(6)).first()["top_anomalous_customers"]
    assert [(r["customer_hash"], r["score"]) for r in top] == [(f"c{i:02d}", 1.0) for i in (7, 15, 23, 31, 39)]


def test_no_scores(anomalies):
    row = serving.interpreted_summary(anomalies.limit(0)).first()
    assert (row["status"], row["message"], row["interpretation"]) == ("no_data", S.NO_SCORES_TEXT, None)
    assert row["top_anomalous_customers"] == []


# --- risk ----------------------------------------------------------------------
def test_risk_levels_and_advice(spark, anomalies, churned, segmented):
    risk = serving.customer_risk(anomalies, churned, segmented)
    assert risk.count() == 6
    wanted = spark.createDataFrame([(k,) for k in ("k1aaaaaaaa", "k2aaaaaaaa", "k3aaaaaaaa", "k4aaaaaaaa", "k9aaaaaaaa")], "customer_hash string")
    got = {r["customer_hash"][:2]: r for r in serving.risk_profiles(risk, wanted).collect()}
    assert {k: r["risk_level"] for k, r in got.items()} == {"k1": "high", "k2": "high", "k3": "medium", "k4": "low", "k9": None}
    assert got["k1"]["recommendations"] == [S.ADVICE_HIGH_RISK, S.ADVICE_UNUSUAL]
    assert got["k2"]["recommendations"] == [S.ADVICE_HIGH_RISK, S.ADVICE_UNUSUAL, S.ADVICE_DISENGAGED]
    assert got["k3"]["recommendations"] == [S.ADVICE_UNUSUAL]
    assert got["k4"]["recommendations"] == [S.ADVICE_NONE]
    # a score of zero is a score
    assert (got["k4"]["anomaly_score"], got["k4"]["churn_probability"]) == (0.0, 0.0)
    assert got["k2"]["segment_description"] == S.SEGMENT_DESCRIPTIONS["at_risk"]
    # a segment alone does not make a risk profile
    assert got["k9"]["status"] == "not_found"


def test_unsegmented_customer_has_an_empty_description(anomalies, churned, segmented):
    got = {r["customer_hash"]: r for r in serving.risk_profiles(serving.customer_risk(anomalies, churned, segmented)).collect()}
    assert (got["k6aaaaaaaa"]["segment"], got["k6aaaaaaaa"]["segment_description"]) == (None, "")


# --- alerts -----------------------------------------------------------------------
def test_alerts(anomalies, churned):
    alerts = serving.generate_alerts(anomalies, churned, NOW)
    got = [(r["id"], r["customer_hash"][:2], r["alert_type"], r["threshold"], r["is_resolved"]) for r in alerts.orderBy("id").collect()]
    assert got == [
        (1, "k1", "anomaly", 0.8, False),
        (2, "k2", "anomaly", 0.8, False),
        (3, "k1", "churn_risk", 0.7, False),
        (4, "k2", "churn_risk", 0.7, False),
    ]
    assert serving.generate_alerts(anomalies, churned, NOW, 0.99, 0.99).count() == 0
    listed = serving.list_alerts(alerts, limit=3).collect()
    assert [r["id"] for r in listed] == [1, 2, 3]
    assert serving.list_alerts(alerts, resolved=True).count() == 0


def test_alert_texts(spark):
    rows = [
        (1, "abcdefgh1234", "anomaly", 0.865, 0.8, False),
        (2, "abcdefgh1234", "churn_risk", 0.9125, 0.7, True),
        (3, "short", "other", 0.5, 0.4, False),
    ]
    schema = "id long, customer_hash string, alert_type string, score double, threshold double, is_resolved boolean"
    alerts = spark.createDataFrame(rows, schema).withColumn("created_at", F.lit(NOW))
    wanted = spark.createDataFrame([(1,), (2,), (3,), (99,)], "alert_id long")
    got = {r["alert_id"]: r for r in serving.explain_alerts(alerts, wanted).collect()}
    assert got[1]["explanation"].startswith(
        f"Customer abcdefgh... was flagged as anomalous with a score of {0.865:.2f} (threshold: 0.80). This means"
    )
    assert f"has a churn probability of {0.9125:.1%} (threshold: 70.0%). The model" in got[2]["explanation"]
    assert got[3]["explanation"] == "Alert type 'other' triggered for customer short... with score 0.5000."
    assert (got[1]["recommended_action"], got[2]["recommended_action"]) == (S.ALERT_OPEN_ACTION, S.ALERT_CLOSED_ACTION)
    assert (got[99]["status"], got[99]["explanation"]) == ("not_found", "No alert found with ID 99.")


# --- segments and overview ------------------------------------------------------------
def test_segment_lookup(spark, segmented, profiles):
    got = {r["segment_label"]: r for r in serving.segment_lookup(segmented, profiles).collect()}
    assert list(sorted(got)) == sorted(S.SEGMENT_LABELS)
    assert (got["champions"]["customer_count"], got["champions"]["avg_recency_days"]) == (2, 10.13)
    assert (got["lost"]["customer_count"], got["lost"]["avg_recency_days"]) == (0, None)
    wanted = spark.createDataFrame([("loyal",), ("vip",)], "segment_label string")
    asked = {r["segment_label"]: r for r in serving.segment_lookup(segmented, profiles, wanted).collect()}
    assert asked["loyal"]["status"] == "found" and asked["loyal"]["message"] is None
    assert asked["vip"]["status"] == "invalid_segment"
    assert asked["vip"]["message"] == "Invalid segment 'vip'. Valid options: champions, loyal, at_risk, new_customers, hibernating, lost"


def test_overview(anomalies, churned, segmented):
    row = serving.overview_kpis(anomalies, churned, segmented).first()
    # at_risk and champions have two each: the alphabetically first
    assert tuple(row) == (2, "40.0%", 2, "at_risk")
    empty = serving.overview_kpis(anomalies.limit(0), churned.limit(0), segmented.limit(0)).first()
    assert tuple(empty) == (0, "N/A", 0, "N/A")


def test_pages_cover_the_flagged_table(spark):
    scores = spark.range(90).select(
        F.format_string("c%02d", "id").alias("customer_hash"),
        ((F.col("id") % 7) / 13.0).alias("anomaly_score"),
        F.when(F.col("id") % 7 > 1, "suspicious").otherwise("normal").alias("anomaly_flag"),
    )
    churn = spark.range(45).select(F.format_string("c%02d", "id").alias("customer_hash"), F.lit(0.25).alias("churn_probability"))
    whole = [r["customer_hash"] for r in serving.flagged_customers(scores, churn).collect()]
    paged, after = [], None
    while True:
        page = serving.flagged_page(scores, churn, after, size=20).collect()
        if not page:
            break
        page.sort(key=lambda r: (-r["cursor_score"], r["customer_hash"]))
        paged += [r["customer_hash"] for r in page]
        after = (page[-1]["cursor_score"], page[-1]["customer_hash"])
    assert len(whole) > 40 and paged == whole


# --- publishing ---------------------------------------------------------------------------
@pytest.fixture
def score_paths(tmp_path, anomalies, churned, segmented):
    paths = {}
    for name, df in (("anomaly_scores", anomalies), ("churn_scores", churned), ("segment_assignments", segmented)):
        paths[name] = str(tmp_path / "in" / name)
        df.write.parquet(paths[name])
    return paths


def counts(df):
    return {r["label"]: r["rows"] for r in df.collect()}


@pytest.mark.parametrize("step", [0, -1])
def test_the_last_publish_is_current(spark, tmp_path, step):
    """Whatever the stamps say: the same one each time, or older ones."""
    root = str(tmp_path / "serving")
    start = datetime(2020, 1, 9, tzinfo=UTC)
    for i in range(5):
        scores = spark.createDataFrame([(f"c{i}", i / 10)], "customer_hash string, anomaly_score double")
        scores = scores.selectExpr("*", "false is_anomaly", "'normal' anomaly_flag")
        folder = str(tmp_path / f"scores{i}")
        scores.write.parquet(folder)
        jobs.publish_job(spark, root, {"anomaly_scores": folder}, start + timedelta(days=i * step))
        assert [r["customer_hash"] for r in publish.read_published(spark, root, "anomaly_scores").collect()] == [f"c{i}"]


def test_publish_and_reload(spark, tmp_path, score_paths):
    root = str(tmp_path / "serving")
    assert publish.read_published(spark, root, "anomaly_scores").count() == 0
    want = {"anomaly_scores": 5, "churn_scores": 5, "segment_assignments": 5, "alerts_generated": 4}
    for _ in range(2):
        assert counts(jobs.publish_job(spark, root, score_paths)) == want
        assert publish.read_published(spark, root, "anomaly_scores").count() == 5
        assert publish.read_published(spark, root, "alerts").count() == 4
    stored = publish.read_published(spark, root, "churn_scores")
    assert stored.columns == ["customer_hash", "churn_probability", "predicted_churn", "scored_at"]


def test_missing_input_keeps_the_earlier_table(spark, tmp_path, score_paths):
    root = str(tmp_path / "serving")
    jobs.publish_job(spark, root, score_paths)
    fewer = {k: v for k, v in score_paths.items() if k != "churn_scores"} | {"churn_scores": str(tmp_path / "absent")}
    got = counts(jobs.publish_job(spark, root, fewer))
    assert (got["churn_scores"], got["alerts_generated"]) == (0, 4)
    assert publish.read_published(spark, root, "churn_scores").count() == 5


def test_failed_publish_changes_nothing(spark, tmp_path, score_paths, churned):
    root = str(tmp_path / "serving")
    jobs.publish_job(spark, root, score_paths)
    before = publish.current_release(spark, root)
    broken = str(tmp_path / "broken")
    churned.unionByName(churned.limit(1)).write.parquet(broken)
    with pytest.raises(ValueError, match="not a key"):
        jobs.publish_job(spark, root, score_paths | {"churn_scores": broken})
    assert publish.current_release(spark, root) == before
    assert publish.read_published(spark, root, "churn_scores").count() == 5


def test_table_presence(spark, tmp_path, anomalies):
    path = str(tmp_path / "t")
    assert not tables.table_exists(spark, path)
    assert tables.read_or_empty(spark, path, "a int").columns == ["a"]
    with pytest.raises(FileNotFoundError, match="absent"):
        tables.require_tables(spark, [str(tmp_path / "absent")])
    tables.write_table(anomalies, path)
    tables.require_tables(spark, [path])
    assert tables.read_or_empty(spark, path, "a int").count() == 5


def test_bucketed_tables_join_without_a_shuffle(spark, anomalies, churned, segmented):
    names = []
    for name, df in (("b_anomaly", anomalies), ("b_churn", churned), ("b_segment", segmented)):
        tables.write_bucketed(df, name, "customer_hash", 4)
        names.append(name)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        risk = serving.customer_risk(*[spark.table(n) for n in names])
        assert risk.count() == 6
        plan = risk._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- monitoring --------------------------------------------------------------------------------
def test_mean_drift(spark):
    reference = spark.createDataFrame([(1, 2.0, 0, True, "x", 5), (3, 2.0, 0, False, "y", 5)], "a int, b double, zero int, flag boolean, s string, gone int")
    current = spark.createDataFrame([(4, 2.2, 9, True, "x"), (4, None, 9, True, "x")], "a int, b double, zero int, flag boolean, s string")
    got = {r["feature"]: (round(r["drift"], 9), r["drifted"]) for r in monitoring.mean_drift(reference, current).collect()}
    assert got == {"a": (1.0, True), "b": (0.1, False)}


@pytest.mark.parametrize(("high", "ok"), [(0, False), (1, True), (6, True), (7, False)])
def test_churn_rate_range(spark, high, ok):
    df = spark.range(10).select(F.when(F.col("id") < high, 0.5).otherwise(0.49).alias("churn_probability"))
    row = monitoring.churn_rate_check(df).first()
    assert (row["churn_rate"], row["churn_rate_in_range"]) == (high / 10, ok)


def test_null_probability_is_not_high(spark):
    df = spark.createDataFrame([(0.9,), (None,)], "churn_probability double")
    assert monitoring.churn_rate_check(df).first()["churn_rate"] == 0.5


def test_anomaly_rate_range(anomalies):
    row = monitoring.anomaly_rate_check(anomalies).first()
    assert (row["anomaly_rate"], row["anomaly_rate_in_range"]) == (0.4, False)


def spread(spark, shift, n=200):
    return spark.range(n).select(F.least((F.col("id") / n) + F.lit(shift), F.lit(1.0)).alias("churn_probability"))


def test_monitoring_job(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    features = spark.range(20).select(F.col("id").alias("feature_a"), (F.col("id") * 1.5).alias("feature_b"))
    features.write.parquet(at("old"))
    features.withColumn("feature_a", F.col("feature_a") * 2).write.parquet(at("new"))
    spread(spark, 0.0).write.parquet(at("scores"))
    spread(spark, 0.02).write.parquet(at("close"))
    spread(spark, 0.4).write.parquet(at("far"))

    missing = jobs.monitoring_job(spark, at("none"), at("new"), at("none"), at("base"))
    assert missing.drift.count() == 0
    assert {r["check_name"]: r["passed"] for r in missing.score_checks.collect()} == {"scores_file_exists": False}
    assert missing.model_drift.first()["status"] == "no_data"
    assert missing.verdict.first()["passed"] is False
    same = jobs.monitoring_job(spark, at("new"), at("new"), at("scores"), at("base"))
    assert same.drift.count() == 0
    assert same.model_drift.first()["status"] == "baseline_created"
    assert same.verdict.first()["passed"] is True

    stable = jobs.monitoring_job(spark, at("old"), at("new"), at("close"), at("base"))
    row = stable.verdict.first()
    assert (row["n_drifted"], row["status"], row["drift_detected"], row["passed"]) == (1, "completed", False, True)
    rolled = publish.current_release(spark, at("base"))
    far = jobs.monitoring_job(spark, at("old"), at("new"), at("far"), at("base"))
    row = far.verdict.first()
    assert (row["drift_detected"], row["passed"], row["roll_baseline"]) == (True, False, False)
    # a drifted run leaves the baseline alone
    assert publish.current_release(spark, at("base")) == rolled


def test_identical_scores_do_not_drift(spark):
    row = monitoring.model_drift(spread(spark, 0.0), spread(spark, 0.0)).first()
    assert tuple(row) == ("completed", 0.0, 1.0, False)
    assert monitoring.model_drift(spread(spark, 0.0), spread(spark, 0.0).limit(0)).first()["ks_statistic"] is not None


def test_publishers_at_once_lose_no_table(spark, tmp_path, score_paths):
    """Each publisher starts over from what the other made meanwhile; alerts follow from both."""
    root, others = str(tmp_path / "serving"), [{"churn_scores": score_paths["churn_scores"]}, {"segment_assignments": score_paths["segment_assignments"]}]

    def meanwhile(anomalies, churned, now):
        while others:
            jobs.publish_job(spark, root, others.pop())
        return serving.generate_alerts(anomalies, churned, now)

    now = datetime(2020, 1, 1, tzinfo=UTC)
    publish.publish_all(spark, root, {"anomaly_scores": score_paths["anomaly_scores"]}, meanwhile, now)
    assert set(publish.current_release(spark, root)) == {*publish.SCORE_SCHEMAS, "alerts"}
    assert publish.read_published(spark, root, "churn_scores").count() == 5
    assert publish.read_published(spark, root, "alerts").count() == 4
    assert publish.entry_numbers(spark, root) == [1, 2, 3]


def test_a_log_number_is_given_once(spark, tmp_path):
    root = str(tmp_path / "serving")
    line = {"number": 1, "release": "first", "published_at": "2020-01-01T00:00:00+00:00", "tables": {"a": "x"}}
    assert publish.create_entry(spark, root, line)
    assert not publish.create_entry(spark, root, line | {"release": "second"})
    assert publish.newest_line(spark, root)["release"] == "first"
    assert not list((tmp_path / "serving" / publish.RELEASE_LOG).glob(".second"))


def test_log_compaction_keeps_the_newest(spark, tmp_path):
    root = str(tmp_path / "serving")
    for number in range(1, 8):
        publish.create_entry(spark, root, {"number": number, "release": "r", "published_at": "2020-01-01T00:00:00+00:00", "tables": {"a": f"f{number}"}})
    publish.compact_log(spark, root, kept=3)
    assert publish.entry_numbers(spark, root) == [5, 6, 7]
    assert publish.current_release(spark, root) == {"a": "f7"}
    assert publish.commit_release(spark, root, {"b": "g"}, datetime(2020, 1, 1, tzinfo=UTC)) == {"a": "f7", "b": "g"}


def test_logs_of_appended_lines_go_on(spark, tmp_path):
    root, now = str(tmp_path / "serving"), datetime(2020, 1, 1, tzinfo=UTC)
    spark.createDataFrame([(4, "old", now, {"a": "x"})], publish.LOG_SCHEMA).write.json(f"{root}/{publish.RELEASE_LOG}")
    assert publish.current_release(spark, root) == {"a": "x"}
    publish.commit_release(spark, root, {"b": "y"}, now)
    assert publish.entry_numbers(spark, root) == [5] and publish.current_release(spark, root) == {"a": "x", "b": "y"}
