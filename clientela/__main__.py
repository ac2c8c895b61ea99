"""Batch jobs for spark-submit.

    python -m clientela clean    --raw RAW_DIR --data DATA_DIR
    python -m clientela features --raw RAW_DIR --data DATA_DIR --snapshot 2018-10-17
    python -m clientela train    --data DATA_DIR
    python -m clientela score    --data DATA_DIR
    python -m clientela publish  --data DATA_DIR
    python -m clientela monitor  --data DATA_DIR

RAW_DIR holds one CSV file or folder per raw table (``orders.csv`` ...); DATA_DIR
receives the cleaned tables, the feature tables and ``feature_matrix``, the score
tables, ``models`` and ``serving``. What a job materialises on the way lies in a
folder of its own below ``spark.checkpoint.dir``, which it deletes at the end.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from clientela import settings as S
from clientela.functions.privacy import pseudonymize
from clientela.operators import churn
from clientela.plans import jobs
from clientela.session import get_spark, materialise, run_folder, ship_package
from clientela.sources import raw, tables

CLEAN_INPUTS = ["orders", "customers", "order_items", "order_payments", "order_reviews"]
SCORE_TABLES = ["anomaly_scores", "churn_scores", "segment_assignments"]


def clean(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    paths = {name: f"{args.raw}/{name}.csv" for name in CLEAN_INPUTS}
    salt = jobs.salt_or_fail()
    cleaned = jobs.clean_tables(raw.read_raw_tables(spark, paths), args.statuses)
    for name in ("orders", "customers", "reviews", "payments"):
        table = getattr(cleaned, name).drop(raw.INGEST_COLUMN)
        tables.write_table(table, f"{args.data}/{name}_clean")
    outputs = {"transactions_clean": jobs.transactions(cleaned), **jobs.pseudonymized_tables(cleaned, salt)}
    written = {name: tables.write_table(df, f"{args.data}/{name}") for name, df in outputs.items()}
    return written["transactions_clean"].groupBy("order_status").count()


def features(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    paths = {name: f"{args.raw}/{name}.csv" for name in jobs.FEATURE_INPUTS}
    loaded = raw.read_raw_tables(spark, paths)
    cleaned = jobs.clean_tables(loaded, args.statuses)
    lines = materialise(jobs.transactions(cleaned), "transactions")
    for name, df in jobs.feature_tables(cleaned, lines, args.snapshot).items():
        # Readable ids stay out of stored tables.
        hashed = pseudonymize(df.where(df["customer_id"].isNotNull()), "customer_id", jobs.salt_or_fail())
        tables.write_table(hashed, f"{args.data}/{name}")
    matrix = jobs.feature_job(loaded, args.snapshot, valid_statuses=args.statuses)
    return tables.write_table(matrix, f"{args.data}/feature_matrix")


def train(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    tables.require_tables(spark, [f"{args.data}/feature_matrix"])
    matrix = tables.read_table(spark, f"{args.data}/feature_matrix")
    result = jobs.training_job(
        matrix,
        contamination=args.contamination,
        seed=args.seed,
        rounds=args.rounds,
        step=args.learning_rate,
        k_range=(args.k_min, args.k_max),
        epsilon=args.epsilon,
        delta=args.delta,
        anomaly_threshold=args.anomaly_threshold,
        churn_threshold=args.churn_threshold,
    )
    result.models.save(spark, f"{args.data}/models")
    outputs = {name: getattr(result, name) for name in SCORE_TABLES}
    outputs |= {"segment_profiles": result.segment_profiles, "k_analysis_results": result.k_analysis}
    outputs |= {"anomaly_metrics": result.anomaly_metrics, "churn_metrics": result.churn_metrics}
    outputs |= {"feature_matrix_with_labels": churn.build_churn_labels(matrix)}
    outputs |= jobs.explanation_tables(matrix, result)
    if result.private_metrics is not None:
        outputs["private_metrics"] = result.private_metrics
    written = {name: tables.write_table(df, f"{args.data}/{name}") for name, df in outputs.items()}
    return written["churn_metrics"]


def score(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    tables.require_tables(spark, [f"{args.data}/feature_matrix"])
    matrix = tables.read_table(spark, f"{args.data}/feature_matrix")
    scored = jobs.scoring_from_saved(
        spark,
        matrix,
        f"{args.data}/models",
        anomaly_threshold=args.anomaly_threshold,
        churn_threshold=args.churn_threshold,
    )
    written = {n: tables.write_table(df, f"{args.data}/{n}") for n, df in scored.items()}
    return written["churn_scores"].groupBy("predicted_churn").count()


def publish(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    paths = {name: f"{args.data}/{name}" for name in SCORE_TABLES}
    return jobs.publish_job(
        spark, f"{args.data}/serving", paths, anomaly_alert=args.anomaly_alert, churn_alert=args.churn_alert
    )


def monitor(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return jobs.monitoring_job(
        spark,
        f"{args.data}/feature_matrix_reference",
        f"{args.data}/feature_matrix",
        f"{args.data}/churn_scores",
        f"{args.data}/baseline",
    ).verdict


JOBS = {
    "clean": clean,
    "features": features,
    "train": train,
    "score": score,
    "publish": publish,
    "monitor": monitor,
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="clientela")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--data", required=True)
    parser.add_argument("--raw")
    parser.add_argument("--snapshot", default=S.SNAPSHOT_DATE)
    parser.add_argument("--statuses", nargs="+", default=S.VALID_ORDER_STATUSES, help="order statuses to keep")
    parser.add_argument("--contamination", type=float, default=S.CONTAMINATION)
    parser.add_argument("--seed", type=int, default=S.SEED)
    parser.add_argument("--rounds", type=int, default=S.BOOSTING_ROUNDS)
    parser.add_argument("--learning-rate", type=float, default=S.BOOSTING_STEP)
    parser.add_argument("--k-min", type=int, default=S.K_MIN)
    parser.add_argument("--k-max", type=int, default=S.K_MAX)
    parser.add_argument("--epsilon", type=float, default=S.DP_EPSILON)
    parser.add_argument("--delta", type=float, default=S.DP_DELTA)
    parser.add_argument("--anomaly-threshold", type=float, default=S.ANOMALY_THRESHOLD)
    parser.add_argument("--churn-threshold", type=float, default=S.CHURN_RISK_THRESHOLD)
    parser.add_argument("--anomaly-alert", type=float, default=S.ANOMALY_ALERT_THRESHOLD)
    parser.add_argument("--churn-alert", type=float, default=S.CHURN_ALERT_THRESHOLD)
    args = parser.parse_args(arguments)
    if args.job in ("clean", "features") and not args.raw:
        parser.error(f"{args.job} needs --raw")
    spark = get_spark("clientela")
    ship_package(spark)
    with run_folder(spark):
        JOBS[args.job](spark, args).show(truncate=False)


if __name__ == "__main__":
    main()
