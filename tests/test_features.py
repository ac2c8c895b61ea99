from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clientela import settings as S
from clientela.functions.privacy import hmac_sha256
from clientela.operators import extra_features as X
from clientela.operators import features as Fe
from clientela.plans import jobs

SNAPSHOT = "2018-10-01"


def at(text):
    return datetime.fromisoformat(text) if text else None


@pytest.fixture
def transactions(spark):
    rows = [
        # order, customer, paid, instalments, bought, delivered, estimated
        ("o1", "A", 100.10, 2, "2018-09-01 12:00:00", "2018-09-05 11:00:00", "2018-09-06 00:00:00"),
        ("o1", "A", 100.10, 2, "2018-09-01 12:00:00", "2018-09-05 11:00:00", "2018-09-06 00:00:00"),
        ("o2", "A", 50.20, 5, "2018-09-20 00:00:00", "2018-09-30 00:00:00", "2018-09-22 00:00:00"),
        ("o3", "B", None, None, "2018-10-01 01:00:00", None, "2018-10-05 00:00:00"),
        ("o4", "C", 10.00, 1, "2018-08-01 00:00:00", "2018-08-02 23:59:59", None),
        ("o5", "D", 10.00, 3, None, "2018-08-02 00:00:00", "2018-08-03 00:00:00"),
        ("o6", None, 99.00, 3, "2018-08-01 00:00:00", "2018-08-02 00:00:00", "2018-08-03 00:00:00"),
    ]
    schema = (
        "order_id string, customer_id string, payment_value double, payment_installments long, "
        "order_purchase_timestamp timestamp, order_delivered_customer_date timestamp, "
        "order_estimated_delivery_date timestamp"
    )
    return spark.createDataFrame([(*r[:4], *map(at, r[4:])) for r in rows], schema).repartition(4)


def by_customer(df, key="customer_id"):
    return {r[key]: r for r in df.collect()}


def test_rfm_per_item_and_per_order(transactions):
    got = by_customer(Fe.rfm(transactions, SNAPSHOT))
    assert set(got) == {"A", "B", "C", "D"}
    # the order total counts once per item row
    assert (got["A"]["recency_days"], got["A"]["frequency"], got["A"]["monetary_total"]) == (11, 2, 250.4)
    assert got["A"]["monetary_avg"] == 125.2
    # one hour after the snapshot is day -1; unpaid is 0
    assert (got["B"]["recency_days"], got["B"]["monetary_total"]) == (-1, 0.0)
    assert got["D"]["recency_days"] is None
    order = by_customer(Fe.rfm(transactions, SNAPSHOT, grain="order"))
    assert (order["A"]["monetary_total"], order["A"]["frequency"]) == (150.3, 2)


def test_rfm_arguments(transactions):
    with pytest.raises(ValueError, match="snapshot"):
        Fe.rfm(transactions, "")
    with pytest.raises(ValueError, match="grain"):
        Fe.rfm(transactions, SNAPSHOT, grain="year")


def test_delivery_days_and_lateness(transactions):
    got = by_customer(Fe.delivery_features(transactions))
    assert set(got) == {"A", "C", "D"}
    # item rows weigh: 3, 3 and 10 days; late only for the last
    assert got["A"]["avg_delivery_days"] == pytest.approx(16 / 3)
    assert got["A"]["late_delivery_rate"] == pytest.approx(1 / 3)
    assert (got["C"]["avg_delivery_days"], got["C"]["late_delivery_rate"]) == (1.0, 0.0)
    assert (got["D"]["avg_delivery_days"], got["D"]["late_delivery_rate"]) == (None, 0.0)


def test_payment_features(transactions):
    got = by_customer(Fe.payment_features(transactions))
    assert got["A"]["payment_installments_avg"] == 3.0
    assert got["B"]["payment_installments_avg"] is None
    assert {r["unique_product_categories"] for r in got.values()} == {0}


def test_review_features(spark):
    orders = spark.createDataFrame([("o1", "A"), ("o2", "A"), ("o3", "B"), ("o4", None)], "order_id string, customer_id string")
    reviews = spark.createDataFrame([("o1", 5), ("o1", 2), ("o2", 1), ("zz", 4), ("o4", 4)], "order_id string, review_score long")
    got = by_customer(Fe.review_features(reviews, orders))
    assert set(got) == {"A"}
    assert (got["A"]["avg_review_score"], got["A"]["review_count"]) == (8 / 3, 3)


def test_matrix_columns_and_fills(spark, transactions):
    orders = transactions.select("order_id", "customer_id").distinct()
    reviews = spark.createDataFrame([("o4", 4)], "order_id string, review_score long")
    parts = (
        Fe.rfm(transactions, SNAPSHOT),
        Fe.review_features(reviews, orders),
        Fe.delivery_features(transactions),
        Fe.payment_features(transactions),
    )
    matrix = Fe.assemble_feature_matrix(*parts, SNAPSHOT)
    assert matrix.columns == S.FEATURE_MATRIX_COLUMNS
    got = by_customer(matrix, "customer_hash")
    b = got["B"]
    assert (b["avg_review_score"], b["review_count"], b["avg_delivery_days"]) == (3.0, 0, 0.0)
    assert (b["late_delivery_rate"], b["payment_installments_avg"]) == (0.0, 1.0)
    assert (b["anomaly_score"], b["segment_label"], b["snapshot_date"]) == (None, None, at("2018-10-01"))
    fused = Fe.fused_feature_matrix(transactions, reviews, orders, SNAPSHOT)
    assert fused.exceptAll(matrix).count() == matrix.exceptAll(fused).count() == 0
    hashed = Fe.assemble_feature_matrix(*parts, SNAPSHOT, salt="s")
    want = {r["h"] for r in parts[0].select(hmac_sha256("customer_id", "s").alias("h")).collect()}
    assert {r["customer_hash"] for r in hashed.collect()} == want
    with pytest.raises(ValueError, match="Missing required"):
        Fe.assemble_feature_matrix(parts[0].drop("frequency"), *parts[1:], SNAPSHOT)


@pytest.fixture
def raw(spark):
    """Random raw tables with gaps, repeats, orders without items and items without orders."""
    base = spark.range(400)
    h = lambda n, m: F.pmod(F.xxhash64("id", F.lit(n)), F.lit(m))
    start = F.lit("2018-01-01").cast("timestamp")
    plus = lambda c: start + F.make_dt_interval(hours=c.cast("int"))
    orders = base.select(
        F.col("id").alias("ingest_seq"),
        (F.col("id") - F.when(h(1, 9) == 0, 1).otherwise(0)).cast("string").alias("order_id"),
        F.when(h(2, 20) > 0, h(3, 40).cast("string")).alias("customer_id"),
        F.element_at(F.array(*map(F.lit, ["delivered", "shipped", "canceled", "invoiced"])), (h(4, 4) + 1).cast("int")).alias("order_status"),
        plus(h(5, 5000)).alias("order_purchase_timestamp"),
        F.when(h(6, 5) > 0, plus(h(7, 6000))).alias("order_delivered_customer_date"),
        F.when(h(8, 5) > 0, plus(h(9, 6000))).alias("order_estimated_delivery_date"),
    )
    items = spark.range(900).select(h(11, 420).cast("string").alias("order_id"), F.col("id").alias("product_id"))
    payments = spark.range(700).select(
        h(12, 420).cast("string").alias("order_id"),
        F.when(h(13, 9) > 0, F.lit("card")).alias("payment_type"),
        h(14, 12).alias("payment_installments"),
        ((h(15, 9000) - 500) / 100).alias("payment_value"),
    )
    reviews = spark.range(300).select(
        F.col("id").alias("ingest_seq"), h(16, 250).alias("review_id"), h(17, 420).cast("string").alias("order_id"), h(18, 8).alias("review_score")
    )
    return {"orders": orders, "order_items": items, "order_payments": payments, "order_reviews": reviews, "customers": spark.createDataFrame([], "ingest_seq long, customer_id string, customer_unique_id string, customer_city string, customer_state string")}


def test_order_grain_matrix_equals_the_item_level_one(raw):
    clean = jobs.clean_tables(raw)
    tx = jobs.transactions(clean)
    want = Fe.assemble_feature_matrix(
        Fe.rfm(tx, SNAPSHOT),
        Fe.review_features(clean.reviews, clean.orders),
        Fe.delivery_features(tx),
        Fe.payment_features(tx),
        SNAPSHOT,
    )
    got = jobs.feature_job(raw, SNAPSHOT, pseudonymize=False)
    assert want.count() > 20
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_feature_job_needs_a_salt(raw, monkeypatch):
    monkeypatch.delenv("HMAC_SALT", raising=False)
    with pytest.raises(ValueError, match="HMAC_SALT"):
        jobs.feature_job(raw, SNAPSHOT)
    monkeypatch.setenv("HMAC_SALT", "from-env")
    assert {len(r["customer_hash"]) for r in jobs.feature_job(raw, SNAPSHOT).collect()} == {64}


def test_pseudonymized_tables(spark, raw):
    clean = jobs.clean_tables({**raw, "customers": spark.createDataFrame([(1, "c", "u", "x", "y")], raw["customers"].schema)})
    tables = jobs.pseudonymized_tables(clean, "s")
    assert "customer_id" not in tables["transactions_pseudonymized"].columns
    assert tables["customers_pseudonymized"].count() == 1
    assert tables["transactions_pseudonymized"].count() == jobs.transactions(clean).where("customer_id IS NOT NULL").count()


def test_extra_features(spark, transactions):
    rate = by_customer(X.purchase_rate(transactions, SNAPSHOT))
    assert (rate["A"]["days_since_first"], rate["A"]["purchase_rate"]) == (29, 2 / 29)
    assert by_customer(X.basket_size(transactions))["A"]["items_per_order"] == 1.5
    orders = spark.createDataFrame(
        [
            ("o1", "A", "delivered", at("2018-09-01 00:00:00"), at("2018-09-01 03:00:00")),
            ("o2", "A", "canceled", at("2018-09-03 00:00:00"), at("2018-09-03 01:00:00")),
            ("o3", "A", "delivered", at("2018-09-04 00:00:00"), None),
            ("o4", "B", "delivered", at("2018-09-02 00:00:00"), None),
        ],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, order_approved_at timestamp",
    )
    weekend = by_customer(X.weekend_ratio(orders))
    assert (weekend["A"]["weekend_ratio"], weekend["B"]["weekend_ratio"]) == (0.5, None)
    assert by_customer(X.cancel_ratio(orders))["A"]["cancel_ratio"] == pytest.approx(1 / 3)
    delay = by_customer(X.approval_delay(orders))
    assert (delay["A"]["approval_hours"], delay["B"]["approval_hours"]) == (2.0, None)
    paid = spark.createDataFrame([("o1", "card"), ("o1", "card"), ("o2", "slip"), ("o4", "card")], "order_id string, payment_type string")
    types = by_customer(X.payment_types(paid, orders))
    assert (types["A"]["payment_types"], types["B"]["payment_types"]) == (2, 1)
    people = spark.createDataFrame([("A", "u", "SP"), ("B", "u", "RJ"), ("Z", "u", "MG")], "customer_id string, customer_unique_id string, customer_state string")
    assert by_customer(X.states_shipped(orders, people), "customer_unique_id")["u"]["states_shipped"] == 2
    bought = spark.createDataFrame([("A", "p1"), ("A", "p2"), ("A", "p1"), ("B", "p3")], "customer_id string, product_id string")
    products = spark.createDataFrame([("p1", "toys"), ("p2", "toys"), ("p3", None)], "product_id string, product_category_name string")
    categories = by_customer(X.product_categories(bought, products))
    assert (categories["A"]["product_categories"], categories["B"]["product_categories"]) == (1, 0)
