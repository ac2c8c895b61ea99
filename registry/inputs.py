"""Inputs of the registered queries: cleaned tables, features and given scores.

The score stand-ins are formulas of the customer number, so the operators that
consume fitted scores can be compared value by value.
"""

from __future__ import annotations

from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela import settings as S
from clientela.operators import anomaly, churn
from clientela.plans import jobs
from clientela.session import materialise
from clientela.sources import adapters

SNAPSHOT = "2001-08-02"
NOW = datetime(2001, 8, 2, 12, 0, 0, tzinfo=UTC)
SALT = "oracle-salt"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# A given forest, tree by tree: (node, feature, threshold, left, right, size, depth).
GIVEN_SUBSAMPLE = 256
GIVEN_TREES = [
    [(0, 0, 100.5, 1, 2, 256, 0), (1, 2, 900000.0, 3, 4, 100, 1), (2, 1, 12.5, 5, 6, 156, 1),
     (3, -1, 0.0, -1, -1, 60, 2), (4, -1, 0.0, -1, -1, 40, 2), (5, -1, 0.0, -1, -1, 155, 2), (6, -1, 0.0, -1, -1, 1, 2)],
    [(0, 1, 8.5, 1, 2, 256, 0), (1, -1, 0.0, -1, -1, 2, 1), (2, 0, 40.5, 3, 4, 254, 1),
     (3, -1, 0.0, -1, -1, 54, 2), (4, 1, 15.5, 5, 6, 200, 2), (5, -1, 0.0, -1, -1, 120, 3), (6, -1, 0.0, -1, -1, 80, 3)],
    [(0, -1, 0.0, -1, -1, 256, 0)],
]
# Given centroids of scaled points, one number for each segmentation feature.
GIVEN_CENTROIDS = [(-1.0, 1.0, 0.5, 0.0, 0.0, 0.25, 0.0), (0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0), (1.0, -1.0, -0.5, 0.5, 0.0, 0.0, 0.25)]


class Inputs:
    """Lazy tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.raw = adapters.RawTables(spark, folder)

    @property
    def clean(self) -> jobs.CleanTables:
        return jobs.clean_tables(self.raw)

    @property
    def transactions(self) -> DataFrame:
        return jobs.transactions(self.clean)

    @property
    def matrix(self) -> DataFrame:
        return jobs.feature_job(self.raw, SNAPSHOT, pseudonymize=False)

    @property
    def stored_matrix(self) -> DataFrame:
        """The feature matrix as a written table, for operators that read it repeatedly."""
        return materialise(self.matrix, "feature-matrix")

    @property
    def people(self) -> DataFrame:
        return adapters.table(self.spark, self.folder, "customer").select(
            F.col("c_custkey").alias("id"), F.col("c_custkey").cast("string").alias("customer_hash")
        )

    def anomaly_scores(self, key: str = "customer_hash") -> DataFrame:
        score = (F.col("id") * 37 % 1000) / F.lit(1000.0)
        scored = self._keyed(key).withColumn("anomaly_score", score)
        return scored.select(
            key,
            "anomaly_score",
            (F.col("anomaly_score") >= 0.95).alias("is_anomaly"),
            anomaly.flag_band("anomaly_score").alias("anomaly_flag"),
        )

    def churn_scores(self, key: str = "customer_hash") -> DataFrame:
        p = (F.col("id") * 53 % 997) / F.lit(997.0)
        return churn.predict_churn(self._keyed(key).withColumn("churn_probability", p), key=key)

    def newer_churn_scores(self) -> DataFrame:
        p = ((F.col("id") * 59 + 7) % 991) / F.lit(1100.0)
        return self._keyed("customer_hash").select("customer_hash", p.alias("churn_probability"))

    def segments(self, key: str = "customer_hash") -> DataFrame:
        """Clusters by customer number with a label derived from it."""
        cluster = (F.col("id") % 3).cast("int")
        names = F.array(*[F.lit(s) for s in S.SEGMENT_LABELS])
        label = F.element_at(names, (F.col("id") % 5 + 1).cast("int"))
        return self._keyed(key).select(
            key, cluster.alias("cluster_id"), label.alias("segment_label")
        )

    def _keyed(self, key: str) -> DataFrame:
        people = self.people
        return people if key == "customer_hash" else people.withColumn(key, F.col("id"))

    @property
    def scored_labels(self) -> DataFrame:
        """Feature-matrix customers with churn label and a given probability, written."""
        labelled = churn.build_churn_labels(self.matrix)
        p = (F.col("customer_hash") * 53 % 997) / F.lit(997.0)
        rows = labelled.select("customer_hash", "recency_days", "churned", p.alias("churn_probability"))
        return materialise(rows, "scored-labels")


def given_clusters(matrix: DataFrame) -> DataFrame:
    """Feature-matrix customers (numeric key) with a cluster derived from the key."""
    return matrix.select("customer_hash", (F.col("customer_hash") % 3).cast("int").alias("cluster_id"))


def text_times(df: DataFrame) -> DataFrame:
    """Times as text, so both engines return the same type."""
    kinds = dict(df.dtypes)
    return df.select(
        *[
            F.date_format(F.col(c), TIME_FORMAT).alias(c) if kinds[c].startswith("timestamp") else F.col(c)
            for c in df.columns
        ]
    )


def rounded(df: DataFrame, digits: int = 6, only: list[str] | None = None) -> DataFrame:
    """Doubles at fixed digits: their sums depend on row order in the last bits."""
    names = only or [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, digits) for c in names})


def whole(df: DataFrame, *columns: str) -> DataFrame:
    """Count columns as 64-bit integers."""
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})



def given_forest() -> anomaly.Forest:
    names = ["node", "feature", "threshold", "left", "right", "size", "depth"]
    rows = [(tree, *node) for tree, nodes in enumerate(GIVEN_TREES) for node in nodes]
    return anomaly.Forest(pd.DataFrame(rows, columns=["tree", *names]), GIVEN_SUBSAMPLE)
