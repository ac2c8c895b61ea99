import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from clientela.__main__ import main
from clientela.session import materialise, run_folder
from clientela.sources import publish

STATUSES = ["delivered"] * 6 + ["shipped", "invoiced", "canceled"]


def write(path, header, rows):
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)


@pytest.fixture
def raw_dir(tmp_path):
    rng = random.Random(11)
    day = lambda: f"2018-{rng.randint(1, 9):02d}-{rng.randint(1, 28):02d} {rng.randint(0, 23):02d}:00:00"
    ids = [f"o{i}" for i in range(600)]
    folder = tmp_path / "raw"
    folder.mkdir()
    times = ["order_purchase_timestamp", "order_approved_at", "order_delivered_customer_date", "order_estimated_delivery_date"]
    write(
        folder / "orders.csv",
        ["order_id", "customer_id", "order_status", *times],
        [(i, f"c{rng.randint(0, 150)}", rng.choice(STATUSES), day(), day(), rng.choice([day(), ""]), day()) for i in ids],
    )
    write(
        folder / "order_items.csv",
        ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"],
        [(rng.choice(ids), 1, f"p{n % 30}", "s", rng.randint(1, 9999) / 100, 1.5) for n in range(1200)],
    )
    write(
        folder / "order_payments.csv",
        ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
        [(i, 1, "card", rng.randint(1, 10), rng.randint(0, 50000) / 100) for i in ids],
    )
    write(
        folder / "order_reviews.csv",
        ["review_id", "order_id", "review_score", "review_comment_message", "review_creation_date", "review_answer_timestamp"],
        [(f"r{n}", i, rng.randint(1, 5), "good,\nor bad", day(), day()) for n, i in enumerate(ids)],
    )
    write(
        folder / "customers.csv",
        ["customer_id", "customer_unique_id", "customer_city", "customer_state"],
        [(f"c{n}", f"u{n // 2}", " rio ", "rj") for n in range(151)],
    )
    return str(folder)


def test_raw_files_to_alerts_and_monitoring(spark, raw_dir, tmp_path, monkeypatch, capsys):
    monkeypatch.setenv("HMAC_SALT", "command-test")
    data = str(tmp_path / "data")
    main(["clean", "--raw", raw_dir, "--data", data])
    assert spark.read.parquet(f"{data}/transactions_clean").count() == 1200
    assert "customer_id" not in spark.read.parquet(f"{data}/transactions_pseudonymized").columns
    assert spark.read.parquet(f"{data}/customers_pseudonymized").count() == 76
    main(["features", "--raw", raw_dir, "--data", data, "--snapshot", "2018-10-01"])
    matrix = spark.read.parquet(f"{data}/feature_matrix")
    customers = matrix.count()
    assert customers > 100
    for name in ("orders_clean", "customers_clean", "reviews_clean", "payments_clean", "rfm_features", "review_features", "delivery_features", "payment_features"):
        assert spark.read.parquet(f"{data}/{name}").count() > 0, name
    main(["train", "--data", data, "--rounds", "3"])
    assert spark.read.parquet(f"{data}/feature_matrix_with_labels").where("churned in (0, 1)").count() == customers
    before = spark.read.parquet(f"{data}/anomaly_scores").toPandas()
    assert len(before) == customers
    assert spark.read.parquet(f"{data}/segment_profiles").agg(F.sum("count")).first()[0] == customers
    main(["score", "--data", data])
    after = spark.read.parquet(f"{data}/anomaly_scores").toPandas()
    key = "customer_hash"
    assert before.sort_values(key, ignore_index=True).equals(after.sort_values(key, ignore_index=True))
    main(["publish", "--data", data, "--anomaly-alert", "0.0", "--churn-alert", "2.0"])
    alerts = publish.read_published(spark, f"{data}/serving", "alerts")
    assert {r["alert_type"] for r in alerts.collect()} == {"anomaly"} and alerts.count() == customers
    main(["publish", "--data", data])
    assert publish.read_published(spark, f"{data}/serving", "churn_scores").count() == customers
    matrix.write.parquet(f"{data}/feature_matrix_reference")
    main(["monitor", "--data", data])
    main(["monitor", "--data", data])
    assert "completed" in capsys.readouterr().out
    main(["score", "--data", data, "--anomaly-threshold", "0.0", "--churn-threshold", "2.0"])
    assert spark.read.parquet(f"{data}/anomaly_scores").where("anomaly_flag <> 'anomalous'").count() == 0
    assert spark.read.parquet(f"{data}/churn_scores").where("predicted_churn").count() == 0
    main(["clean", "--raw", raw_dir, "--data", data, "--statuses", "shipped"])
    assert {r["order_status"] for r in spark.read.parquet(f"{data}/orders_clean").collect()} <= {"shipped"}


def test_a_run_clears_its_folder(spark):
    with run_folder(spark) as folder:
        stored = materialise(spark.range(5).toDF("id"), "five")
        assert stored.count() == 5 and stored.inputFiles()[0].startswith(folder if "://" in folder else "file:")
        path = folder.removeprefix("file://").removeprefix("file:")
        assert os.path.isdir(path)
    assert not os.path.exists(path)


def test_features_need_raw_files():
    with pytest.raises(SystemExit):
        main(["features", "--data", "x"])
