"""Registered queries: name -> (session, data folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela import settings as S
from clientela.functions.columns import missing_values
from clientela.functions.privacy import is_valid_hash, pseudonymize, pseudonymize_customers
from clientela.functions.ranks import average_precision, exact_quantiles, ks_distance, roc_auc
from clientela.functions.sketch import RankSketch, ks_bounds, merged
from clientela.operators import (
    anomaly,
    churn,
    cleaning,
    explain,
    exploration,
    extra_features,
    features,
    gaussian,
    incremental,
    monitoring,
    private,
    segments,
    serving,
    silhouette,
)
from clientela.plans import jobs
from clientela.session import materialise, new_folder, ship_package
from clientela.sources import adapters, publish, raw, tables
from registry.inputs import (
    GIVEN_CENTROIDS,
    NOW,
    SALT,
    SNAPSHOT,
    Inputs,
    given_clusters,
    given_forest,
    rounded,
    text_times,
    whole,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SKETCH_PARTS = 64
STAND_IN_KS = {k: f"c{k}" for k in range(S.K_MIN, S.K_MAX + 1)}


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register ``build`` under its function name."""

    @wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ship_package(spark)
        return build(Inputs(spark, folder))

    QUERIES[build.__name__] = run
    return build


# --- sources and sinks --------------------------------------------------------
def _as_csv(t: Inputs, name: str) -> str:
    """Write a raw table as CSV the way the source files look."""
    path = new_folder(t.spark, f"csv-{name}")
    table = text_times(t.raw[name])
    table.drop("ingest_seq").write.option("header", True).csv(path)
    return path


@query
def s1_csv_source(t: Inputs) -> DataFrame:
    orders = raw.read_csv(t.spark, _as_csv(t, "orders"), raw.RAW_SCHEMAS["orders"])
    return text_times(cleaning.clean_orders(orders).drop("ingest_seq", "order_approved_at"))


@query
def s1_csv_row_counts(t: Inputs) -> DataFrame:
    loaded = raw.read_raw_tables(t.spark, {n: _as_csv(t, n) for n in raw.RAW_SCHEMAS})
    parts = [
        df.agg(F.lit(n).alias("table"), F.count(F.lit(1)).alias("rows")) for n, df in loaded.items()
    ]
    return exploration._union(parts)


@query
def s1_split_reviews(t: Inputs) -> DataFrame:
    """Files of long quoted texts with quotes, commas and line breaks, each read in many splits."""
    path = new_folder(t.spark, "csv-split")
    message = F.concat(F.lit('"'), F.coalesce("text", F.lit("")), F.lit('",\n""\nend'))
    reviews = adapters.table(t.spark, t.folder, "documents").select(
        F.col("doc_id").alias("review_id"),
        F.col("source").alias("order_id"),
        (F.col("doc_id") % 5).alias("review_score"),
        F.coalesce(F.left("text", F.lit(9)), F.lit("")).alias("review_comment_title"),
        message.alias("review_comment_message"),
    )
    options = {"header": True, "quoteAll": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    reviews.write.options(**options).csv(path)
    return raw.read_csv(t.spark, path, raw.RAW_SCHEMAS["order_reviews"], multi_line=True, split_bytes=1 << 16).drop("ingest_seq")


@query
def s2_stored_transactions(t: Inputs) -> DataFrame:
    path = new_folder(t.spark, "transactions")
    tables.write_table(t.transactions, path)
    return text_times(tables.read_table(t.spark, path)).drop("freight_value")


@query
def s3_publish_anomaly_scores(t: Inputs) -> DataFrame:
    path = new_folder(t.spark, "anomaly")
    return publish.publish_anomaly_scores(t.anomaly_scores(), path, NOW).drop("scored_at")


@query
def s4_publish_churn_scores(t: Inputs) -> DataFrame:
    path = new_folder(t.spark, "churn")
    return publish.publish_churn_scores(t.churn_scores(), path, NOW).drop("scored_at")


@query
def s5_publish_segments(t: Inputs) -> DataFrame:
    path = new_folder(t.spark, "segments")
    return publish.publish_segment_assignments(t.segments(), path, NOW).drop("assigned_at")


@query
def s6_publish_release(t: Inputs) -> DataFrame:
    root = new_folder(t.spark, "release")
    inputs = {n: f"{root}/in/{n}" for n in publish.SCORE_SCHEMAS}
    t.anomaly_scores().write.parquet(inputs["anomaly_scores"])
    t.churn_scores().write.parquet(inputs["churn_scores"])
    return publish.publish_all(t.spark, root, inputs, serving.generate_alerts, NOW)


@query
def s6_second_publish(t: Inputs) -> DataFrame:
    """Two publishes under one stamp: the second is what readers get."""
    root = new_folder(t.spark, "twice")
    for number, scores in enumerate((t.churn_scores(), t.churn_scores().where("churn_probability >= 0.5"))):
        folder = f"{root}/in/{number}"
        scores.write.parquet(folder)
        publish.publish_all(t.spark, root, {"churn_scores": folder}, serving.generate_alerts, NOW)
    return publish.read_published(t.spark, root, "churn_scores").drop("scored_at")


@query
def s6_concurrent_publish(t: Inputs) -> DataFrame:
    """Two publishers of different tables that start from the same release: both tables are current afterwards."""
    root = new_folder(t.spark, "concurrent")
    folders = {name: f"{root}/in/{name}" for name in ("anomaly_scores", "churn_scores")}
    t.anomaly_scores().write.parquet(folders["anomaly_scores"])
    t.churn_scores().write.parquet(folders["churn_scores"])

    others = [{"churn_scores": folders["churn_scores"]}]

    def meanwhile(anomalies: DataFrame, churned: DataFrame, now) -> DataFrame:
        # The other publisher commits while this one is at work for the first time.
        while others:
            publish.publish_all(t.spark, root, others.pop(), serving.generate_alerts, now)
        return serving.generate_alerts(anomalies, churned, now)

    publish.publish_all(t.spark, root, {"anomaly_scores": folders["anomaly_scores"]}, meanwhile, NOW)
    tables = [*folders, "alerts"]
    parts = [publish.read_published(t.spark, root, n).agg(F.lit(n).alias("table"), F.count(F.lit(1)).alias("rows")) for n in tables]
    return exploration._union(parts)


@query
def s7_tolerant_read(t: Inputs) -> DataFrame:
    path = new_folder(t.spark, "present")
    t.churn_scores().write.parquet(path)
    schema = publish.SCORE_SCHEMAS["churn_scores"]
    parts = [
        tables.read_or_empty(t.spark, p, schema).agg(
            F.lit(n).alias("table"), F.count(F.lit(1)).alias("rows")
        )
        for n, p in (("present", path), ("absent", f"{path}-absent"))
    ]
    return exploration._union(parts)


@query
def s8_required_inputs(t: Inputs) -> DataFrame:
    names = ["orders", "customer", "lineitem", "events", "part", "supplier"]
    paths = [f"{t.folder}/{n}.parquet" for n in names]
    tables.require_tables(t.spark, paths)
    parts = [
        t.spark.read.parquet(p).agg(F.lit(n).alias("table"), F.count(F.lit(1)).alias("rows"))
        for n, p in zip(names, paths, strict=True)
    ]
    return exploration._union(parts)


@query
def s9_score_baseline(t: Inputs) -> DataFrame:
    root = new_folder(t.spark, "baseline")
    _, created = publish.baseline_or_create(t.churn_scores(), root)
    stored, again = publish.baseline_or_create(t.newer_churn_scores(), root)
    return stored.withColumns({"created_first": F.lit(created), "created_again": F.lit(again)})


@query
def s9_baseline_sketch(t: Inputs) -> DataFrame:
    root = new_folder(t.spark, "sketch")
    publish.sketch_or_create(t.churn_scores(), root, SKETCH_PARTS)
    return publish.sketch_or_create(t.newer_churn_scores(), root, SKETCH_PARTS)[0]


# --- cleaning ------------------------------------------------------------------
@query
def p1_clean_orders(t: Inputs) -> DataFrame:
    return text_times(t.clean.orders.drop("ingest_seq"))


@query
def p2_clean_customers(t: Inputs) -> DataFrame:
    return t.clean.customers.drop("ingest_seq")


@query
def p3_clean_reviews(t: Inputs) -> DataFrame:
    return whole(text_times(t.clean.reviews.drop("ingest_seq")), "review_score")


@query
def p4_clean_payments(t: Inputs) -> DataFrame:
    return whole(t.clean.payments, "payment_sequential", "payment_installments")


@query
def p5_pseudonymize_customers(t: Inputs) -> DataFrame:
    return pseudonymize_customers(t.clean.customers.drop("ingest_seq"), SALT)


@query
def p5_pseudonymize_transactions(t: Inputs) -> DataFrame:
    known = t.transactions.where(F.col("customer_id").isNotNull())
    hashed = pseudonymize(known, "customer_id", SALT)
    return hashed.select("customer_id_hash", "order_id", "product_id", "seller_id", "price")


@query
def p5b_hash_format(t: Inputs) -> DataFrame:
    hashed = pseudonymize(t.clean.customers, "customer_id", SALT, drop_original=False)
    both = hashed.select(
        "customer_id",
        is_valid_hash("customer_id_hash").alias("hash_valid"),
        is_valid_hash(F.col("customer_id").cast("string")).alias("id_valid"),
        is_valid_hash(F.concat("customer_id_hash", F.lit("\n"))).alias("padded_valid"),
    )
    return both


@query
def p6_build_transactions(t: Inputs) -> DataFrame:
    return whole(text_times(t.transactions.drop("freight_value")), "payment_installments")


# --- features --------------------------------------------------------------------
@query
def f1_rfm(t: Inputs) -> DataFrame:
    return features.rfm(t.transactions, SNAPSHOT)


@query
def f1_rfm_order_grain(t: Inputs) -> DataFrame:
    return features.rfm(t.transactions, SNAPSHOT, grain="order")


@query
def f2_review_features(t: Inputs) -> DataFrame:
    return features.review_features(t.clean.reviews, t.clean.orders)


@query
def f3_delivery_features(t: Inputs) -> DataFrame:
    return features.delivery_features(t.transactions)


@query
def f4_payment_features(t: Inputs) -> DataFrame:
    return features.payment_features(t.transactions)


@query
def f5_feature_matrix(t: Inputs) -> DataFrame:
    tx, c = t.transactions, t.clean
    return text_times(
        features.assemble_feature_matrix(
            features.rfm(tx, SNAPSHOT),
            features.review_features(c.reviews, c.orders),
            features.delivery_features(tx),
            features.payment_features(tx),
            SNAPSHOT,
        )
    )


@query
def f5_feature_matrix_hashed(t: Inputs) -> DataFrame:
    return text_times(jobs.feature_job(t.raw, SNAPSHOT, salt=SALT))


@query
def f6_fused_feature_matrix(t: Inputs) -> DataFrame:
    c = t.clean
    return text_times(features.fused_feature_matrix(t.transactions, c.reviews, c.orders, SNAPSHOT))


@query
def f6_order_grain_feature_matrix(t: Inputs) -> DataFrame:
    return text_times(t.matrix)


@query
def f6_incremental(t: Inputs) -> DataFrame:
    """The state of an earlier day, brought up to date: later orders, deliveries, payments and reviews, cancellations."""
    early = F.lit("2000-08-02").cast("timestamp")
    ordered, delivered = F.col(features.PURCHASED), F.col(features.DELIVERED)
    not_canceled_yet = F.when(F.col("order_status") == "canceled", "shipped").otherwise(F.col("order_status"))
    then = {
        "orders": t.raw["orders"]
        .where(ordered < early)
        .withColumns({"order_status": not_canceled_yet, features.DELIVERED: F.when(delivered < early, delivered)}),
        "order_items": t.raw["order_items"],
        "order_payments": t.raw["order_payments"].where("payment_type = 'boleto'"),
        "order_reviews": t.raw["order_reviews"].where("review_creation_date < timestamp'2024-01-16'"),
    }
    before, after = jobs.order_tables(then), jobs.order_tables(t.raw)
    state = incremental.first_state(before)
    now = incremental.refresh(state, after, incremental.changed_orders(before, after))
    return text_times(incremental.matrix_of_state(now, SNAPSHOT))


@query
def x1_purchase_rate(t: Inputs) -> DataFrame:
    return extra_features.purchase_rate(t.transactions, SNAPSHOT)


@query
def x2_payment_types(t: Inputs) -> DataFrame:
    return extra_features.payment_types(t.clean.payments, t.clean.orders)


@query
def x3_states_shipped(t: Inputs) -> DataFrame:
    return extra_features.states_shipped(t.clean.orders, t.raw["customers"])


@query
def x4_product_categories(t: Inputs) -> DataFrame:
    return extra_features.product_categories(t.transactions, t.raw["products"])


@query
def x5_weekend_ratio(t: Inputs) -> DataFrame:
    return extra_features.weekend_ratio(t.clean.orders)


@query
def x6_cancel_ratio(t: Inputs) -> DataFrame:
    return extra_features.cancel_ratio(t.raw["orders"])


@query
def x7_approval_delay(t: Inputs) -> DataFrame:
    return extra_features.approval_delay(t.clean.orders)


@query
def x8_basket_size(t: Inputs) -> DataFrame:
    return extra_features.basket_size(t.transactions)


@query
def x9_precision_at_share(t: Inputs) -> DataFrame:
    return churn.precision_at_share(t.scored_labels)


@query
def x11_ranked_at_risk(t: Inputs) -> DataFrame:
    return churn.ranked_at_risk(t.churn_scores())


# --- exploration --------------------------------------------------------------------
@query
def e1_table_overview(t: Inputs) -> DataFrame:
    named = {n: df.drop("ingest_seq") for n, df in t.raw.items()}
    return exploration.table_overview(named)


@query
def e2_null_percentages(t: Inputs) -> DataFrame:
    return rounded(exploration.null_percentages(t.raw))


@query
def e3_status_frequency(t: Inputs) -> DataFrame:
    return exploration.status_frequency(t.raw["orders"])


@query
def e4_monthly_orders(t: Inputs) -> DataFrame:
    return exploration.monthly_orders(t.raw["orders"])


@query
def e4_order_span(t: Inputs) -> DataFrame:
    return text_times(exploration.order_span(t.raw["orders"]))


@query
def e5_orders_per_person(t: Inputs) -> DataFrame:
    return exploration.orders_per_person(t.raw["orders"], t.raw["customers"])


@query
def e6_spend_per_person(t: Inputs) -> DataFrame:
    return exploration.spend_per_person(t.raw["orders"], t.raw["customers"], t.raw["order_items"])


def _person_rfm(t: Inputs) -> DataFrame:
    return exploration.person_rfm(t.raw["orders"], t.raw["customers"], t.raw["order_items"])


@query
def e7_order_histogram(t: Inputs) -> DataFrame:
    per_person = exploration.orders_per_person(t.raw["orders"], t.raw["customers"])
    return rounded(exploration.histogram(per_person, "orders", 30))


@query
def e7_spend_histogram(t: Inputs) -> DataFrame:
    spend = exploration.spend_per_person(t.raw["orders"], t.raw["customers"], t.raw["order_items"])
    return rounded(exploration.histogram(spend, "spend", 50), 4)


@query
def e7_recency_histogram(t: Inputs) -> DataFrame:
    return rounded(exploration.histogram(_person_rfm(t), "recency", 40))


@query
def e7_frequency_histogram(t: Inputs) -> DataFrame:
    return rounded(exploration.histogram(_person_rfm(t), "frequency", 20))


@query
def e8_repeat_share(t: Inputs) -> DataFrame:
    per_person = exploration.orders_per_person(t.raw["orders"], t.raw["customers"])
    return rounded(exploration.repeat_share(per_person))


@query
def e9_person_rfm(t: Inputs) -> DataFrame:
    return _person_rfm(t)


@query
def e10_correlation(t: Inputs) -> DataFrame:
    return rounded(exploration.correlation_matrix(_person_rfm(t), ["recency", "frequency", "monetary"]))


@query
def e11_review_distribution(t: Inputs) -> DataFrame:
    return whole(exploration.review_distribution(t.raw["order_reviews"], t.raw["orders"]), "review_score")


@query
def e11_monthly_review_score(t: Inputs) -> DataFrame:
    return rounded(exploration.monthly_review_score(t.raw["order_reviews"], t.raw["orders"]))


@query
def e11_overall_review_score(t: Inputs) -> DataFrame:
    return rounded(exploration.overall_review_score(t.raw["order_reviews"], t.raw["orders"]))


@query
def e12_churn_balance(t: Inputs) -> DataFrame:
    return whole(rounded(exploration.churn_balance(_person_rfm(t))), "churn")


@query
def e12_churn_by_state(t: Inputs) -> DataFrame:
    return rounded(exploration.churn_by_state(_person_rfm(t), t.raw["customers"]))


@query
def e13_outliers(t: Inputs) -> DataFrame:
    return rounded(exploration.outliers(_person_rfm(t)), only=["monetary_z", "frequency_z"])


@query
def e13_outlier_share(t: Inputs) -> DataFrame:
    return rounded(exploration.outlier_share(exploration.outliers(_person_rfm(t), 2.0)))


@query
def e14_top_outliers(t: Inputs) -> DataFrame:
    flagged = exploration.outliers(_person_rfm(t), 2.0)
    return rounded(exploration.top_outliers(flagged), only=["monetary_z", "frequency_z"])


@query
def e15_outliers_by_state(t: Inputs) -> DataFrame:
    return exploration.outliers_by_state(exploration.outliers(_person_rfm(t), 2.0), t.raw["customers"])


# --- anomaly, on a given raw score -----------------------------------------------------
def _given_raw(t: Inputs) -> DataFrame:
    raw_score = -(F.lit(0.3) + F.col("anomaly_score") * F.lit(0.5))
    return t.anomaly_scores().select("customer_hash", raw_score.alias("raw_score"))


@query
def a1_feature_gate(t: Inputs) -> DataFrame:
    return missing_values(t.matrix, S.ANOMALY_FEATURES)


@query
def a3_normalised_scores(t: Inputs) -> DataFrame:
    given = _given_raw(t)
    cut = exact_quantiles(given, ["raw_score"], [S.CONTAMINATION]).select("value").scalar()
    return rounded(anomaly.score_raw(given, cut))


@query
def a4_flag_bands(t: Inputs) -> DataFrame:
    return t.anomaly_scores().select("customer_hash", "anomaly_flag")


@query
def a5_anomaly_metrics(t: Inputs) -> DataFrame:
    given = _given_raw(t)
    cut = exact_quantiles(given, ["raw_score"], [S.CONTAMINATION]).select("value").scalar()
    return rounded(anomaly.anomaly_metrics(anomaly.score_raw(given, cut)))


# --- segmentation, on given labels -----------------------------------------------------
@query
def g1_standardised_features(t: Inputs) -> DataFrame:
    return rounded(segments.prepare_points(t.stored_matrix)[0])


@query
def g1_scaler(t: Inputs) -> DataFrame:
    return rounded(segments.fit_scaler(t.matrix))


def _given_quality(t: Inputs) -> DataFrame:
    points, _ = segments.prepare_points(t.stored_matrix)
    labels = {c: (F.col("customer_hash") % k).cast("int") for k, c in STAND_IN_KS.items()}
    return segments.cluster_quality(points.withColumns(labels), S.SEGMENT_FEATURES, STAND_IN_KS)


@query
def g4_inertia(t: Inputs) -> DataFrame:
    return rounded(whole(_given_quality(t), "k_values").select("k_values", "inertias"))


@query
def g5_silhouette(t: Inputs) -> DataFrame:
    return rounded(whole(_given_quality(t), "k_values").select("k_values", "silhouette_scores"))


@query
def g5_plain_silhouette(t: Inputs) -> DataFrame:
    """Of the clusters around given centroids; no SQL, as the value is exact to the stated error only."""
    points, _ = segments.prepare_points(t.stored_matrix)
    nearest = segments.nearest_cluster(GIVEN_CENTROIDS, S.SEGMENT_FEATURES)
    return silhouette.plain_silhouette(points.withColumn("cluster_id", nearest), S.SEGMENT_FEATURES)


@query
def g6_davies_bouldin(t: Inputs) -> DataFrame:
    return rounded(whole(_given_quality(t), "k_values").select("k_values", "davies_bouldin_scores"), 4)


@query
def g7_select_k(t: Inputs) -> DataFrame:
    return whole(segments.select_optimal_k(_given_quality(t)), "k")


@query
def g9_nearest_centroid(t: Inputs) -> DataFrame:
    points, _ = segments.prepare_points(t.stored_matrix)
    grouped = points.groupBy((F.col("customer_hash") % 5).cast("int").alias("cluster_id"))
    centre = F.array(*[F.avg(c) for c in S.SEGMENT_FEATURES])
    assigned = segments.assign_clusters(points, grouped.agg(centre.alias("centroid")))
    return whole(assigned.select("customer_hash", "cluster_id"), "cluster_id")


@query
def g10_cluster_profiles(t: Inputs) -> DataFrame:
    matrix = t.stored_matrix
    profiles = segments.cluster_profiles(matrix, given_clusters(matrix))
    return whole(rounded(profiles, 4), "cluster_id")


@query
def g11_feature_percentiles(t: Inputs) -> DataFrame:
    return rounded(segments.feature_percentiles(t.matrix))


@query
def g12_cluster_labels(t: Inputs) -> DataFrame:
    matrix = t.stored_matrix
    profiles = segments.cluster_profiles(matrix, given_clusters(matrix))
    return whole(segments.label_clusters(profiles, segments.feature_percentiles(matrix)), "cluster_id")


@query
def g13_segment_assignments(t: Inputs) -> DataFrame:
    matrix = t.stored_matrix
    return whole(segments.assign_segments(matrix, given_clusters(matrix)), "cluster_id")


def _profiles(t: Inputs) -> DataFrame:
    matrix = t.matrix.withColumn("customer_hash", F.col("customer_hash").cast("string"))
    return segments.segment_profiles(matrix, t.segments())


@query
def g14_segment_profiles(t: Inputs) -> DataFrame:
    return rounded(_profiles(t), 4)


# --- churn, on given scores -----------------------------------------------------------
@query
def c1_churn_labels(t: Inputs) -> DataFrame:
    labelled = churn.build_churn_labels(t.matrix)
    return whole(labelled.select("customer_hash", "recency_days", "churned", "churn_label_source"), "churned")


@query
def c2_label_distribution(t: Inputs) -> DataFrame:
    return rounded(churn.label_distribution(churn.build_churn_labels(t.matrix)))


def _given_features(t: Inputs) -> DataFrame:
    """Every second customer has an anomaly score, two of three a segment."""
    scores = t.anomaly_scores("id").withColumnRenamed("id", "customer_hash")
    labels = t.segments("id").withColumnRenamed("id", "customer_hash")
    return churn.prepare_churn_features(
        churn.build_churn_labels(t.matrix),
        scores.where(F.col("anomaly_flag") != "suspicious"),
        labels.where(F.col("cluster_id") > 0),
    )


@query
def c3_churn_features(t: Inputs) -> DataFrame:
    return whole(_given_features(t), "segment_encoded", "churned")


@query
def c4_ordered_split(t: Inputs) -> DataFrame:
    split = churn.ordered_split(t.scored_labels)
    return split.select("customer_hash", "recency_days", "split")


@query
def c6_roc_auc(t: Inputs) -> DataFrame:
    return rounded(roc_auc(t.scored_labels, "churn_probability", "churned"))


@query
def c6_average_precision(t: Inputs) -> DataFrame:
    return rounded(average_precision(t.scored_labels, "churn_probability", "churned"))


@query
def c6_average_precision_with_ties(t: Inputs) -> DataFrame:
    """The same with scores rounded to one digit, so that many customers share one."""
    return rounded(average_precision(t.scored_labels.withColumn("s", F.round("churn_probability", 1)), "s", "churned"))


@query
def c7_threshold_metrics(t: Inputs) -> DataFrame:
    return rounded(churn.threshold_metrics(t.scored_labels, "churn_probability"))


@query
def c8_split_statistics(t: Inputs) -> DataFrame:
    return rounded(churn.split_statistics(churn.ordered_split(t.scored_labels)))


@query
def c10_predicted_churn(t: Inputs) -> DataFrame:
    return rounded(churn.predict_churn(t.scored_labels))


# --- monitoring ---------------------------------------------------------------------
def _two_matrices(t: Inputs) -> tuple[DataFrame, DataFrame]:
    """The feature matrix before and after a year, seen from two snapshot dates."""
    current = t.matrix.drop("anomaly_score", "segment_label")
    c = t.clean
    earlier = features.order_grain_feature_matrix(
        c.orders.where(F.col("order_purchase_timestamp") < F.lit("2000-08-02").cast("timestamp")),
        c.items,
        c.payments,
        c.reviews,
        "2000-08-02",
    )
    return earlier.drop("anomaly_score", "segment_label"), current


@query
def m1_mean_drift(t: Inputs) -> DataFrame:
    reference, current = _two_matrices(t)
    return rounded(monitoring.mean_drift(reference.drop("customer_hash"), current.drop("customer_hash")))


@query
def m2_churn_rate_check(t: Inputs) -> DataFrame:
    return rounded(monitoring.churn_rate_check(t.churn_scores()))


@query
def m2b_anomaly_rate_check(t: Inputs) -> DataFrame:
    return rounded(monitoring.anomaly_rate_check(t.anomaly_scores()))


@query
def m3_ks_statistic(t: Inputs) -> DataFrame:
    return rounded(ks_distance(t.churn_scores(), t.newer_churn_scores(), "churn_probability"))


@query
def m3_model_drift(t: Inputs) -> DataFrame:
    return rounded(monitoring.model_drift(t.churn_scores(), t.newer_churn_scores()))


@query
def m3_distance_bounds(t: Inputs) -> DataFrame:
    """Bounds from a sketch of the earlier scores, and whether the exact distance lies within them."""
    stored = RankSketch.of(t.churn_scores(), "churn_probability", SKETCH_PARTS).to_frame(t.spark)
    bounds = ks_bounds(stored, t.newer_churn_scores(), "churn_probability")
    return rounded(_with_exact(t, bounds).select("ks_low", "ks_high", "n_first", "n_second", "inside"))


@query
def m3_merged_sketch_bounds(t: Inputs) -> DataFrame:
    """The same from merged and thinned sketches of three parts of the earlier scores."""
    place = F.pmod(F.xxhash64("customer_hash"), F.lit(3))
    parts = [RankSketch.of(t.churn_scores().where(place == i), "churn_probability", SKETCH_PARTS) for i in range(3)]
    stored = merged(parts).thinned(SKETCH_PARTS).to_frame(t.spark)
    bounds = _with_exact(t, ks_bounds(stored, t.newer_churn_scores(), "churn_probability"))
    narrow = F.col("ks_high") - F.col("ks_low") <= 2 / SKETCH_PARTS
    return bounds.select("n_first", "n_second", "inside", narrow.alias("narrow"))


def _with_exact(t: Inputs, bounds: DataFrame) -> DataFrame:
    exact = ks_distance(t.churn_scores(), t.newer_churn_scores(), "churn_probability").select("ks_statistic").scalar()
    return bounds.withColumn("inside", exact.between(F.col("ks_low"), F.col("ks_high")))


@query
def m4_monitoring_verdict(t: Inputs) -> DataFrame:
    reference, current = _two_matrices(t)
    drift = monitoring.mean_drift(reference.drop("customer_hash"), current.drop("customer_hash"))
    checks = monitoring.score_checks(t.newer_churn_scores(), t.spark)
    model = monitoring.model_drift(t.churn_scores(), t.newer_churn_scores())
    return rounded(monitoring.monitoring_verdict(drift, checks, model))


# --- serving ---------------------------------------------------------------------------
@query
def q1_anomaly_summary(t: Inputs) -> DataFrame:
    return rounded(whole(serving.anomaly_summary(t.anomaly_scores()), "period_days"))


@query
def q2_interpreted_summary(t: Inputs) -> DataFrame:
    summary = serving.interpreted_summary(t.anomaly_scores())
    lines = F.transform(
        "top_anomalous_customers", lambda e: F.concat(e["customer_hash"], F.lit(":"), e["score"].cast("string"))
    )
    return whole(summary, "period_days").withColumn("top_anomalous_customers", F.concat_ws("|", lines))


def _partial_scores(t: Inputs) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scores in which some customers lack an anomaly score, a churn score or both."""
    return (
        t.anomaly_scores().where(F.col("anomaly_score") >= 0.2),
        t.churn_scores().where(F.col("churn_probability") < 0.9),
        t.segments().where(F.col("cluster_id") > 0),
    )


@query
def q3_customer_risk(t: Inputs) -> DataFrame:
    return serving.customer_risk(*_partial_scores(t))


@query
def q4_risk_profiles(t: Inputs) -> DataFrame:
    profiles = serving.risk_profiles(serving.customer_risk(*_partial_scores(t)))
    return profiles.withColumn("recommendations", F.concat_ws("|", "recommendations"))


@query
def q4_risk_lookup(t: Inputs) -> DataFrame:
    risk = serving.customer_risk(*_partial_scores(t))
    profiles = serving.risk_profiles(risk, wanted=t.people)
    return profiles.select("customer_hash", "status", "risk_level", "message")


def _alerts(t: Inputs) -> DataFrame:
    return serving.generate_alerts(t.anomaly_scores(), t.churn_scores(), NOW)


@query
def q5_generate_alerts(t: Inputs) -> DataFrame:
    return text_times(_alerts(t))


@query
def q6_list_alerts(t: Inputs) -> DataFrame:
    return text_times(serving.list_alerts(_alerts(t)))


@query
def q7_explain_alerts(t: Inputs) -> DataFrame:
    return text_times(serving.explain_alerts(_alerts(t)))


@query
def q7_alert_lookup(t: Inputs) -> DataFrame:
    wanted = t.people.select(F.col("id").alias("alert_id"))
    found = serving.explain_alerts(_alerts(t), wanted)
    return found.select("alert_id", "status", "explanation", "recommended_action")


@query
def q8_segment_lookup(t: Inputs) -> DataFrame:
    return serving.segment_lookup(t.segments(), _profiles(t))


@query
def q9_overview_kpis(t: Inputs) -> DataFrame:
    return serving.overview_kpis(t.anomaly_scores(), t.churn_scores(), t.segments())


@query
def q10_flagged_customers(t: Inputs) -> DataFrame:
    anomalies, churned, _ = _partial_scores(t)
    return serving.flagged_customers(anomalies, churned)


@query
def q10_flagged_second_page(t: Inputs) -> DataFrame:
    anomalies, churned, _ = _partial_scores(t)
    last = min(
        serving.flagged_page(anomalies, churned).collect(),
        key=lambda r: (r["cursor_score"], [-ord(c) for c in r["customer_hash"]]),
    )
    after = (last["cursor_score"], last["customer_hash"])
    return serving.flagged_page(anomalies, churned, after).drop("cursor_score")


@query
def q11_segment_distribution(t: Inputs) -> DataFrame:
    return serving.rounded_profiles(_profiles(t))



# --- fitted models: run in full, compared by invariants in the tests -------------------
_trained: dict[tuple[str, str], tuple[DataFrame, jobs.TrainingResult]] = {}


def _training(t: Inputs) -> tuple[DataFrame, jobs.TrainingResult]:
    """The training job on the folder's feature matrix, once per session."""
    place = (t.spark.sparkContext.applicationId, t.folder)
    if place not in _trained:
        matrix = materialise(jobs.feature_job(t.raw, SNAPSHOT, salt=SALT), "feature-matrix")
        _trained[place] = (matrix, jobs.training_job(matrix))
    return _trained[place]


@query
def a2_isolation_forest(t: Inputs) -> DataFrame:
    return anomaly.fit_forest(t.stored_matrix).node_frame(t.spark)


@query
def a3_fitted_scores(t: Inputs) -> DataFrame:
    matrix = t.stored_matrix
    forest, _, _ = anomaly.train_isolation_forest(matrix)
    return anomaly.score_anomalies(matrix, forest)


@query
def a5_training_metrics(t: Inputs) -> DataFrame:
    return anomaly.train_isolation_forest(t.stored_matrix)[2]


@query
def a6_top_contributions(t: Inputs) -> DataFrame:
    """The ranking half of the explanations, on contributions taken from the features."""
    scaled = segments.apply_scaler(
        t.stored_matrix, segments.fit_scaler(t.stored_matrix, S.ANOMALY_FEATURES)
    )
    given = scaled.select("customer_hash", F.array(*S.ANOMALY_FEATURES).alias("contributions"))
    top = explain.top_contributions(given, S.ANOMALY_FEATURES, explain.ANOMALY_TOP)
    values = F.from_json("shap_values", "map<string,double>")
    return top.select("customer_hash", F.concat_ws("|", F.map_keys(values)).alias("top_features"))


@query
def a6_anomaly_shap(t: Inputs) -> DataFrame:
    matrix = t.stored_matrix
    return explain.anomaly_shap(matrix, anomaly.fit_forest(matrix))


@query
def g2_k_sweep(t: Inputs) -> DataFrame:
    points, _ = segments.prepare_points(t.stored_matrix)
    return segments.find_optimal_k(points)[0]


@query
def g3_kmeans_centroids(t: Inputs) -> DataFrame:
    points, _ = segments.prepare_points(t.stored_matrix)
    return segments.fit_kmeans(points, [S.DEFAULT_CLUSTERS])[S.DEFAULT_CLUSTERS].to_frame(t.spark)


@query
def g8_train_kmeans(t: Inputs) -> DataFrame:
    points, _ = segments.prepare_points(t.stored_matrix)
    return segments.train_kmeans(points, S.DEFAULT_CLUSTERS)[1]


@query
def c5_churn_model_metrics(t: Inputs) -> DataFrame:
    return _training(t)[1].churn_metrics


@query
def c9_private_model_metrics(t: Inputs) -> DataFrame:
    return private.train_private_model(churn.ordered_split(materialise(_given_features(t), "churn")))[1]


@query
def x10_privacy_tradeoff(t: Inputs) -> DataFrame:
    return private.privacy_tradeoff(churn.ordered_split(materialise(_given_features(t), "churn")))


@query
def c10_churn_scores(t: Inputs) -> DataFrame:
    return _training(t)[1].churn_scores


@query
def c11_churn_shap(t: Inputs) -> DataFrame:
    _, result = _training(t)
    return explain.churn_shap(result.churn_features, result.models.booster)


@query
def c12_score_with_saved_models(t: Inputs) -> DataFrame:
    matrix, result = _training(t)
    root = new_folder(t.spark, "models")
    result.models.save(t.spark, root)
    scored = jobs.scoring_from_saved(t.spark, matrix, root)
    return serving.customer_risk(
        scored["anomaly_scores"], scored["churn_scores"], scored["segment_assignments"]
    )


@query
def x11_explained_anomalies(t: Inputs) -> DataFrame:
    matrix, result = _training(t)
    shap = explain.anomaly_shap(matrix, result.models.forest)
    return explain.explained_anomalies(result.anomaly_scores, shap)


@query
def x11_cluster_projection(t: Inputs) -> DataFrame:
    points, _ = segments.prepare_points(t.stored_matrix)
    return segments.project_clusters(segments.assign_clusters(points, _centroids(t, points)))


def _centroids(t: Inputs, points: DataFrame) -> DataFrame:
    return segments.fit_kmeans(points, [S.DEFAULT_CLUSTERS])[S.DEFAULT_CLUSTERS].to_frame(t.spark)


# --- fitted models: given ones with values, and what holds for every fit -----------------
@query
def a2_forest_invariants(t: Inputs) -> DataFrame:
    nodes = anomaly.fit_forest(t.stored_matrix).node_frame(t.spark)
    sides = [nodes.select("tree", F.col("node").alias(side), F.col("size").alias(f"{side}_size"), F.col("depth").alias(f"{side}_depth")) for side in ("left", "right")]
    inner = nodes.join(sides[0], ["tree", "left"]).join(sides[1], ["tree", "right"])
    off = (F.col("left_size") + F.col("right_size") != F.col("size")) | (F.col("left_depth") != F.col("depth") + 1) | (F.col("right_depth") != F.col("depth") + 1)
    unbalanced = inner.where(off).agg(F.count(F.lit(1))).scalar()
    roots = F.when(F.col("node") == 0, F.col("size"))
    return nodes.agg(
        F.count_distinct("tree").alias("trees"),
        F.min(roots).alias("smallest_root"),
        F.max(roots).alias("largest_root"),
        F.count_if(F.col("depth") > 8).alias("too_deep"),
    ).withColumn("unbalanced", unbalanced)


@query
def a3_given_forest_scores(t: Inputs) -> DataFrame:
    return rounded(anomaly.raw_scores(t.matrix, given_forest()))


@query
def a6_given_forest_sums(t: Inputs) -> DataFrame:
    """Contributions and base of the given forest add up to the mean path of each row."""
    found = explain.explain_rows(t.matrix, explain.forest_leaves(given_forest()), S.ANOMALY_FEATURES, None, "customer_hash")
    total = F.aggregate("contributions", F.col("base"), lambda a, v: a + v)
    return rounded(found.select("customer_hash", total.alias("path")))


def _assigned(points: DataFrame, centroids: list) -> DataFrame:
    """One assignment step: size, inertia and new centre of every cluster."""
    sums = segments._assignment_sums(points, S.SEGMENT_FEATURES, {0: np.array(centroids, dtype=float)})
    means = [(F.col(f"s{i}") / F.col("n")).alias(c) for i, c in enumerate(S.SEGMENT_FEATURES)]
    return sums.where("n > 0").select("cluster", "n", "inertia", *means)


@query
def g3_lloyd_step(t: Inputs) -> DataFrame:
    return rounded(_assigned(segments.prepare_points(t.matrix)[0], GIVEN_CENTROIDS))


@query
def g8_fixed_point(t: Inputs) -> DataFrame:
    """Another step from the fitted centroids moves none of them."""
    points, _ = segments.prepare_points(t.stored_matrix)
    fit = segments.fit_kmeans(points, [S.DEFAULT_CLUSTERS])[S.DEFAULT_CLUSTERS]
    centres = t.spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(fit.centroids)], "cluster int, centre array<double>")
    moved = F.aggregate(
        F.zip_with(F.array(*S.SEGMENT_FEATURES), "centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v
    )
    stepped = _assigned(points, fit.centroids).join(F.broadcast(centres), "cluster")
    return stepped.agg(
        F.count(F.lit(1)).alias("clusters"), F.sum("n").cast("bigint").alias("rows"), (F.sum(moved) <= 2 * segments.SHIFT_TOLERANCE).alias("settled")
    )


@query
def c9_private_optimum(t: Inputs) -> DataFrame:
    """Without noise the fit is the minimum of the ridge loss: its gradient, added up in SQL functions, is zero."""
    train = churn.ordered_split(materialise(_given_features(t), "churn")).where("split = 'train'")
    model = private.fit_private_logistic(train, float("inf"))
    rows = private.private_probability(train, model)
    rows = private.unit_rows(rows, S.CHURN_FEATURES, model.scaler)
    names = [f"_z_{c}" for c in S.CHURN_FEATURES] + ["_z_one"]
    gradient = [F.abs(F.sum(F.col(c) * (F.col("churn_probability") - F.col("churned"))) + float(w)) < 1e-3 for c, w in zip(names, model.weights, strict=True)]
    size = sum([F.col(c) * F.col(c) for c in names[1:]], F.col(names[0]) * F.col(names[0]))
    return rows.agg(reduce(lambda a, b: a & b, gradient).alias("optimal"), (F.max(size) <= 1 + 1e-9).alias("unit_rows"))


# Features of the private model that the matrix holds by itself.
MATRIX_CHURN_FEATURES = S.CHURN_FEATURES[:9]


@query
def c9_gaussian_clipped_sums(t: Inputs) -> DataFrame:
    """What the private scaler adds noise to."""
    return rounded(gaussian.clipped_sums(t.matrix, MATRIX_CHURN_FEATURES), 4)


@query
def c9_gaussian_first_gradient(t: Inputs) -> DataFrame:
    """What the first round of the private fit adds noise to, under a given scaler: rows of norm 1 at most."""
    d = len(MATRIX_CHURN_FEATURES)
    budget = gaussian.Budget.plan(S.DP_EPSILON, S.DP_DELTA, d)
    model = gaussian.GaussianLogistic(
        MATRIX_CHURN_FEATURES, gaussian.RANGES, budget, 1.0, np.full(d, -0.5), np.full(d, 0.25), np.zeros(d + 1)
    )
    rows = churn.build_churn_labels(t.matrix).select(*[v.alias(c) for c, v in model.inputs().items()], F.col("churned").cast("double"))
    names = list(model.inputs())
    size = sum([F.col(c) * F.col(c) for c in names[1:]], F.col(names[0]) * F.col(names[0]))
    longest = rows.agg((F.max(size) <= 1 + 1e-9).alias("unit_rows"))
    sums = gaussian.gradient_sums(materialise(rows, "gaussian-points"), names, model.weights)
    return rounded(longest.select("unit_rows", *[F.lit(float(v)).alias(f"g{c}") for c, v in zip(names, sums, strict=True)]), 4)


def _gaussian(t: Inputs) -> tuple[DataFrame, gaussian.GaussianLogistic]:
    split = churn.ordered_split(materialise(_given_features(t), "churn"))
    return split, gaussian.fit_gaussian_logistic(split.where("split = 'train'"))


@query
def c9_gaussian_budget(t: Inputs) -> DataFrame:
    """The noise of a fit, and the epsilon that it amounts to."""
    split, model = _gaussian(t)
    total = gaussian.epsilon_of(model.budget.rho, model.budget.delta)
    trained = split.where("split = 'train'").agg(F.count(F.lit(1)).alias("train_rows"))
    ledger = model.budget.ledger(t.spark).withColumns({"epsilon": F.lit(total), "delta": F.lit(model.budget.delta)})
    return rounded(ledger.crossJoin(F.broadcast(trained)), 9)


@query
def c9_gaussian_model_metrics(t: Inputs) -> DataFrame:
    return gaussian.gaussian_model_metrics(*_gaussian(t))


@query
def x10_tradeoff_levels(t: Inputs) -> DataFrame:
    table = private.privacy_tradeoff(churn.ordered_split(materialise(_given_features(t), "churn")))
    return table.select("epsilon", "dp_training_failed", "train_size", "test_size")


def _wrong(df: DataFrame, wrong) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(wrong, F.lit(True))).alias("wrong"))


def _margin(result: jobs.TrainingResult) -> DataFrame:
    """Log-odds of every customer, walked through the booster's node table with SQL functions."""
    nodes = explain.boosting_nodes(result.churn_features, result.models.booster)
    # Bounded: rounds x 63 nodes.
    walks = []
    for _, tree in nodes.groupby("tree"):
        by_node = tree.set_index("node")

        def walk(at: int, by_node=by_node):
            n = by_node.loc[at]
            if n["left"] < 0:
                return F.lit(float(n["value"]))
            goes_left = F.col(S.CHURN_FEATURES[int(n["feature"])]).cast("double") <= float(n["threshold"])
            return F.when(goes_left, walk(int(n["left"]))).otherwise(walk(int(n["right"])))

        walks.append(walk(0))
    # One array of leaf values: a sum of this many terms would nest too deep.
    return result.churn_features.select("customer_hash", F.aggregate(F.array(*walks), F.lit(0.0), lambda a, v: a + v).alias("margin"))


@query
def c10_walked_scores(t: Inputs) -> DataFrame:
    _, result = _training(t)
    both = _margin(result).join(result.churn_scores, "customer_hash")
    return _wrong(both, F.abs(1 / (1 + F.exp(-F.col("margin"))) - F.col("churn_probability")) > 1e-9)


@query
def c11_contributions_add_up(t: Inputs) -> DataFrame:
    _, result = _training(t)
    leaves = explain.LeafTable(explain.boosting_nodes(result.churn_features, result.models.booster))
    found = explain.explain_rows(result.churn_features, leaves, S.CHURN_FEATURES, None, "customer_hash")
    total = F.aggregate("contributions", F.col("base"), lambda a, v: a + v)
    both = found.join(_margin(result), "customer_hash")
    return _wrong(both, F.abs(total - F.col("margin")) > 1e-6)


@query
def c12_saved_equals_fresh(t: Inputs) -> DataFrame:
    matrix, result = _training(t)
    root = new_folder(t.spark, "models")
    result.models.save(t.spark, root)
    scored = jobs.scoring_from_saved(t.spark, matrix, root)
    saved = serving.customer_risk(scored["anomaly_scores"], scored["churn_scores"], scored["segment_assignments"])
    fresh = serving.customer_risk(result.anomaly_scores, result.churn_scores, result.segment_assignments)
    fresh = fresh.select("customer_hash", F.struct(*[c for c in saved.columns if c != "customer_hash"]).alias("fresh"))
    saved = saved.select("customer_hash", F.struct(*[c for c in saved.columns if c != "customer_hash"]).alias("saved"))
    return _wrong(saved.join(fresh, "customer_hash"), ~F.col("saved").eqNullSafe(F.col("fresh")))


@query
def x11_all_explained(t: Inputs) -> DataFrame:
    """Flagged customers without an explanation, and flagged customers that the list lacks."""
    matrix, result = _training(t)
    listed = explain.explained_anomalies(result.anomaly_scores, explain.anomaly_shap(matrix, result.models.forest))
    flagged = result.anomaly_scores.where("anomaly_flag <> 'normal'").agg(F.count(F.lit(1))).scalar()
    counted = listed.agg(F.count_if(F.col("shap_values").isNull()).alias("unexplained"), F.count(F.lit(1)).alias("n"))
    return counted.select("unexplained", (flagged - F.col("n")).alias("missing"))


@query
def m5_monitoring_job(t: Inputs) -> DataFrame:
    root = new_folder(t.spark, "monitoring")
    reference, current = _two_matrices(t)
    reference.write.parquet(f"{root}/reference")
    current.write.parquet(f"{root}/current")
    t.churn_scores().write.parquet(f"{root}/before")
    t.newer_churn_scores().write.parquet(f"{root}/scores")
    places = (f"{root}/reference", f"{root}/current")
    jobs.monitoring_job(t.spark, *places, f"{root}/before", f"{root}/baseline")
    return rounded(jobs.monitoring_job(t.spark, *places, f"{root}/scores", f"{root}/baseline").verdict)
