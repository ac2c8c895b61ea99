"""Anomaly detection with an isolation forest (Liu, Ting and Zhou 2008)."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela import settings as S
from clientela.functions.columns import require_features
from clientela.functions.selection import selected_quantiles
from clientela.session import materialise

TREES = 100
SUBSAMPLE = 256
HIT_FACTOR = 1.5
EULER_GAMMA = 0.5772156649015329
NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, size bigint, depth int"
)
META_SCHEMA = "trees int, subsample bigint, cut double, low double, high double, contamination double"


def average_path(size: np.ndarray | float) -> np.ndarray:
    """Mean path length c(n) of an unsuccessful search in a tree over n rows."""
    n = np.asarray(size, dtype=float)
    safe = np.maximum(n, 3.0)
    value = 2.0 * (np.log(safe - 1.0) + EULER_GAMMA) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n <= 2, 1.0, value))


@dataclass
class Forest:
    """Tree nodes (at most trees x 511 rows) and the numbers needed to score."""

    nodes: pd.DataFrame
    subsample: int
    cut: float | None = None
    low: float | None = None
    high: float | None = None
    contamination: float = S.CONTAMINATION

    @property
    def trees(self) -> int:
        return int(self.nodes["tree"].nunique())

    def node_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.nodes, NODE_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        self.node_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        meta = (self.trees, self.subsample, self.cut, self.low, self.high, self.contamination)
        row = spark.createDataFrame([meta], META_SCHEMA)
        row.coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Forest:
        # Bounded: the model has at most trees x 511 node rows.
        nodes = spark.read.parquet(f"{path}/nodes").toPandas()
        meta = spark.read.parquet(f"{path}/meta").first()
        return Forest(
            nodes, meta["subsample"], meta["cut"], meta["low"], meta["high"], meta["contamination"]
        )


def _uniform(*parts: Column) -> Column:
    """Deterministic pseudo-uniform number in [0, 1) from column values."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) / F.lit(float(1 << 40))


def _grow_tree(rows: np.ndarray, rng: np.random.Generator) -> list[tuple]:
    """Random cuts until a node is single, constant or at the depth limit."""
    limit = math.ceil(math.log2(max(len(rows), 2)))
    nodes: list[list] = []
    pending = [(rows, 0, -1, 0)]
    while pending:
        part, depth, parent, side = pending.pop()
        place = len(nodes)
        if parent >= 0:
            nodes[parent][3 + side] = place
        low, high = part.min(0), part.max(0)
        open_features = np.flatnonzero(high > low)
        if depth >= limit or len(part) <= 1 or not len(open_features):
            nodes.append([place, -1, float("nan"), -1, -1, len(part), depth])
            continue
        feature = int(rng.choice(open_features))
        threshold = float(rng.uniform(low[feature], high[feature]))
        nodes.append([place, feature, threshold, -1, -1, len(part), depth])
        goes_left = part[:, feature] <= threshold
        pending.append((part[~goes_left], depth + 1, place, 1))
        pending.append((part[goes_left], depth + 1, place, 0))
    return [tuple(n) for n in nodes]


def tree_samples(
    df: DataFrame, key: str, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = S.SEED
) -> DataFrame:
    """Rows with the trees whose subsample they may join (column ``tree``, ``draw``).

    Every pair of row and tree has a draw of its own, so subsamples are independent
    of each other at any size. Only hits are exploded and shuffled: about
    ``HIT_FACTOR * subsample`` rows for each tree, however large the table is.
    """
    rows = df.count()
    hit_share = min(1.0, HIT_FACTOR * subsample / max(rows, 1))
    seeded = [F.col(key), F.lit(seed)]
    hits = F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: _uniform(*seeded, t) < hit_share
    )
    return df.withColumn("tree", F.explode(hits)).withColumn("draw", F.xxhash64(*seeded, F.col("tree")))


def fit_forest(
    feature_matrix: DataFrame,
    contamination: float = S.CONTAMINATION,
    seed: int = S.SEED,
    trees: int = TREES,
    subsample: int = SUBSAMPLE,
    key: str = "customer_hash",
) -> Forest:
    """Grow the trees in parallel, one group of about 1.5 x ``subsample`` rows each."""
    features = S.ANOMALY_FEATURES
    gated = require_features(feature_matrix, features)
    table = gated.select(F.col(key).alias("_key"), *[F.col(c).cast("double").alias(c) for c in features])
    samples = tree_samples(table, "_key", trees, subsample, seed).select("tree", "draw", *features)
    # The sample is small in bytes but each group costs time: keep the tasks apart.
    tasks = min(trees, feature_matrix.sparkSession.sparkContext.defaultParallelism)
    samples = samples.repartition(tasks, "tree")

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        chosen = pdf.sort_values(["draw", *features], kind="stable").head(subsample)
        rng = np.random.default_rng([seed, tree])
        rows = _grow_tree(chosen[features].to_numpy(), rng)
        names = ["node", "feature", "threshold", "left", "right", "size", "depth"]
        nodes = pd.DataFrame(rows, columns=names)
        nodes.insert(0, "tree", tree)
        return nodes

    # Bounded: at most trees x 511 nodes come to the driver.
    nodes = samples.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()
    nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
    size = int(nodes.loc[nodes["node"] == 0, "size"].max())
    return Forest(nodes, size, contamination=contamination)


def _stacked(nodes: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """All trees in one set of arrays; a leaf points to itself."""
    starts = nodes.groupby("tree", sort=True)["node"].size().cumsum().shift(fill_value=0)
    base = nodes["tree"].map(starts).to_numpy()
    place = base + nodes["node"].to_numpy()
    is_leaf = nodes["left"].to_numpy() < 0
    left = np.where(is_leaf, place, base + nodes["left"].to_numpy())
    right = np.where(is_leaf, place, base + nodes["right"].to_numpy())
    feature = np.where(is_leaf, 0, nodes["feature"].to_numpy())
    threshold = np.where(is_leaf, np.inf, nodes["threshold"].to_numpy())
    value = nodes["depth"].to_numpy() + average_path(nodes["size"].to_numpy())
    return starts.to_numpy(), feature, threshold, left, right, value


def raw_scores(feature_matrix: DataFrame, forest: Forest, key: str = "customer_hash") -> DataFrame:
    """``customer_hash, raw_score``: -2^(-mean path / c(subsample)), lower is stranger."""
    features = S.ANOMALY_FEATURES
    roots, feature, threshold, left, right, value = _stacked(forest.nodes)
    depth = int(forest.nodes["depth"].max())
    scale = float(average_path(forest.subsample)) or 1.0

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in parts:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            at = np.broadcast_to(roots, (len(x), len(roots)))
            rows = np.arange(len(x))[:, None]
            for _ in range(depth):
                at = np.where(x[rows, feature[at]] <= threshold[at], left[at], right[at])
            yield pd.Series(-np.exp2(-value[at].mean(1) / scale))

    inputs = [F.col(c).cast("double") for c in features]
    return feature_matrix.select(key, score(*inputs).alias("raw_score"))


def train_isolation_forest(
    feature_matrix: DataFrame,
    contamination: float = S.CONTAMINATION,
    seed: int = S.SEED,
    key: str = "customer_hash",
) -> tuple[Forest, DataFrame, DataFrame]:
    """Forest with its contamination cut, training raw scores and a metrics row."""
    forest = fit_forest(feature_matrix, contamination, seed, key=key)
    raw = materialise(raw_scores(feature_matrix, forest, key), "raw-scores")
    forest.cut = selected_quantiles(raw, ["raw_score"], [contamination]).first()["value"]
    span = raw.agg(F.min("raw_score").alias("low"), F.max("raw_score").alias("high")).first()
    forest.low, forest.high = span["low"], span["high"]
    return forest, raw, anomaly_metrics(score_raw(raw, forest.cut), contamination)


def score_raw(
    raw: DataFrame,
    cut: float | Column,
    threshold: float = S.ANOMALY_THRESHOLD,
    span: tuple[float, float] | None = None,
) -> DataFrame:
    """Turn ``raw_score`` into ``anomaly_score, is_anomaly, anomaly_flag``.

    Normalised over this batch by default, so scores of two batches do not compare;
    pass the training ``span`` to keep one scale. Null scores if all are equal.
    """
    if span is None:
        edges = raw.agg(F.struct(F.min("raw_score").alias("a"), F.max("raw_score").alias("b"))).scalar()
        low, high = edges["a"], edges["b"]
    else:
        low, high = F.lit(span[0]), F.lit(span[1])
    share = F.try_divide(F.col("raw_score") - low, high - low)
    cut = F.lit(cut) if isinstance(cut, int | float) else cut
    return raw.select(
        *[c for c in raw.columns if c != "raw_score"],
        (F.lit(1.0) - share).alias("anomaly_score"),
        (F.col("raw_score") < cut).alias("is_anomaly"),
    ).withColumn("anomaly_flag", flag_band("anomaly_score", threshold))


def flag_band(score: str, threshold: float = S.ANOMALY_THRESHOLD) -> Column:
    """Anomalous from ``threshold``, suspicious from 70 % of it, else normal."""
    normal, suspicious, anomalous = S.ANOMALY_FLAGS
    return (
        F.when(F.col(score) >= threshold, anomalous)
        .when(F.col(score) >= threshold * S.SUSPICIOUS_SHARE, suspicious)
        .otherwise(normal)
    )


def score_anomalies(
    feature_matrix: DataFrame,
    forest: Forest,
    threshold: float = S.ANOMALY_THRESHOLD,
    reuse_training_span: bool = False,
    key: str = "customer_hash",
) -> DataFrame:
    """Scores of a batch with a trained forest.

    The forest walk is written once: the batch minimum and maximum and the scores
    themselves would otherwise each run it.
    """
    if forest.cut is None:
        raise ValueError("forest has no contamination cut; train it first")
    raw = raw_scores(feature_matrix, forest, key)
    if reuse_training_span:
        return score_raw(raw, forest.cut, threshold, (forest.low, forest.high))
    return score_raw(materialise(raw, "raw-scores"), forest.cut, threshold)


def anomaly_metrics(scores: DataFrame, contamination: float = S.CONTAMINATION) -> DataFrame:
    return scores.agg(
        F.avg(F.col("is_anomaly").cast("int")).alias("anomaly_rate"),
        F.avg("anomaly_score").alias("avg_anomaly_score"),
        F.count_if("is_anomaly").alias("n_anomalies"),
        F.lit(float(contamination)).alias("contamination_param"),
    )
