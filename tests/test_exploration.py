from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from clientela.operators import exploration as E


def table(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


@pytest.fixture
def shop(spark):
    day = lambda m, d: datetime(2018, m, d, 12)
    orders = spark.createDataFrame(
        [("o1", "c1", "delivered", day(1, 1)), ("o2", "c2", "delivered", day(1, 9)), ("o3", "c3", "canceled", day(3, 1)), ("o4", "c9", None, day(8, 1)), ("o5", "c1", "shipped", day(8, 2))],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp",
    )
    customers = spark.createDataFrame(
        [("c1", "u1", "SP"), ("c2", "u1", "RJ"), ("c3", "u2", "SP"), ("c4", "u3", "MG")],
        "customer_id string, customer_unique_id string, customer_state string",
    )
    items = spark.createDataFrame([("o1", 10.1), ("o1", 0.2), ("o2", 5.0), ("o3", 7.0), ("zz", 1.0)], "order_id string, price double")
    return orders, customers, items


def test_person_measures(shop):
    orders, customers, items = shop
    assert sorted(table(E.orders_per_person(orders, customers), "customer_unique_id", "orders")) == [("u1", 3), ("u2", 1)]
    assert sorted(table(E.spend_per_person(orders, customers, items), "customer_unique_id", "spend")) == [("u1", 15.3), ("u2", 7.0)]
    got = sorted(table(E.person_rfm(orders, customers, items), "customer_unique_id", "recency", "frequency", "monetary"))
    assert got == [("u1", 205, 2, 15.3), ("u2", 154, 1, 7.0)]
    share = E.repeat_share(E.orders_per_person(orders, customers)).first()
    assert (share["single_pct"], share["repeat_pct"]) == (50.0, 50.0)


def test_orders_over_time(shop):
    orders = shop[0]
    assert table(E.monthly_orders(orders), "order_month", "orders") == [("2018-01", 2), ("2018-03", 1), ("2018-08", 2)]
    assert E.order_span(orders).first()["months"] == 3
    assert table(E.status_frequency(orders), "order_status", "count") == [("delivered", 2), ("canceled", 1), ("shipped", 1)]


def test_nulls_and_overview(shop):
    tables = dict(zip(("orders", "customers", "items"), shop, strict=True))
    assert table(E.null_percentages(tables), "table", "column", "null_pct") == [("orders", "order_status", 20.0)]
    rows = [r for r in E.table_overview(tables).collect() if r["table"] == "items"]
    assert [(r["rows"], r["columns"], r["column"], r["dtype"]) for r in rows] == [(5, 2, "order_id", "string"), (5, 2, "price", "double")]


@pytest.mark.parametrize("bins", [1, 7, 20])
def test_histogram_matches_numpy(spark, bins):
    values = np.random.default_rng(bins).integers(0, 40, 500)
    df = spark.createDataFrame([(int(v),) for v in values] + [(None,)], "v int").repartition(5)
    got = E.histogram(df, "v", bins).orderBy("bin").collect()
    want, edges = np.histogram(values, bins)
    assert [r["n"] for r in got] == list(want)
    np.testing.assert_allclose([r["bin_start"] for r in got], edges[:-1])


def test_histogram_of_a_constant(spark):
    got = E.histogram(spark.createDataFrame([(3.0,)] * 4, "v double"), "v", 4).orderBy("bin").collect()
    want, edges = np.histogram([3.0] * 4, 4)
    assert [r["n"] for r in got] == list(want)
    assert got[0]["bin_start"] == edges[0]


def test_correlation(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(80, 3))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    got = {(r["a"], r["b"]): r["correlation"] for r in E.correlation_matrix(df, ["a", "b", "c"]).collect()}
    want = np.corrcoef(x.T)
    for i, a in enumerate("abc"):
        for j, b in enumerate("abc"):
            assert got[a, b] == pytest.approx(want[i, j])


def test_reviews_over_time(spark, shop):
    orders = shop[0]
    reviews = spark.createDataFrame([("o1", 5), ("o1", 5), ("o2", 1), ("o3", None), ("zz", 3)], "order_id string, review_score int")
    assert table(E.review_distribution(reviews, orders), "review_score", "reviews") == [(1, 1), (5, 2)]
    assert table(E.monthly_review_score(reviews, orders), "order_month", "avg_score") == [("2018-01", 11 / 3), ("2018-03", None)]
    assert E.overall_review_score(reviews, orders).first()["avg_score"] == pytest.approx(11 / 3)


def test_churn_views(shop):
    orders, customers, items = shop
    rfm = E.person_rfm(orders, customers, items)
    got = {r["churn"]: (r["persons"], r["share"], r["churn_rate"]) for r in E.churn_balance(rfm).collect()}
    assert got == {1: (1, 0.5, 0.5), 0: (1, 0.5, 0.5)}
    assert table(E.churn_by_state(rfm, customers), "customer_state", "churn_rate") == [("RJ", 1.0), ("SP", 0.5)]


def test_outliers(spark):
    rows = [(f"u{i:03d}", 10, 2 + i % 2, 100.0 + i) for i in range(200)] + [("big", 1, 1, 90_000.0), ("many", 1, 500, 100.0)]
    rfm = spark.createDataFrame(rows, "customer_unique_id string, recency long, frequency long, monetary double")
    flagged = E.outliers(rfm)
    money = np.array([r[3] for r in rows])
    z = (90_000 - money.mean()) / money.std(ddof=1)
    top = E.top_outliers(flagged).collect()
    assert [r["customer_unique_id"] for r in top] == ["big", "many"]
    assert top[0]["monetary_z"] == pytest.approx(z)
    row = E.outlier_share(flagged).first()
    assert (row["outliers"], row["outlier_pct"]) == (2, pytest.approx(200 / 202))
    states = spark.createDataFrame([("c", "big", "SP"), ("d", "big", "SP"), ("e", "many", "RJ")], "customer_id string, customer_unique_id string, customer_state string")
    assert table(E.outliers_by_state(flagged, states), "customer_state", "count") == [("RJ", 1), ("SP", 1)]
    assert E.outliers(rfm.withColumn("monetary", F.lit(1.0))).where("anomaly_flag").count() == 1
