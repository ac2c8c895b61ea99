"""Feature contributions of tree models (path-dependent SHAP, Lundberg et al. 2018).

For one leaf the value of a coalition is the product of, per feature on its path,
either "the row satisfies all cuts on this feature" (feature known) or the share of
training rows that do (feature unknown). Shapley values of a product follow from
its elementary symmetric polynomials, so leaves are handled in whole arrays.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientela import settings as S
from clientela.operators.anomaly import Forest, average_path
from clientela.session import new_folder, spread

ANOMALY_TOP = 3
CHURN_TOP = 5
SAMPLE_SEED = 42
# Rows times leaves looked at in one step: bounds the memory of a task and keeps it in the processor's cache.
ROWS_TIMES_LEAVES = 1 << 15
SHAP_SCHEMA = "customer_hash string, shap_values string"


class LeafTable:
    """Leaves of all trees grouped by how many features their path uses."""

    def __init__(self, nodes: pd.DataFrame):
        """``nodes``: tree, node, feature, threshold, left, right, cover, value."""
        grouped: dict[int, list] = {}
        self.base = 0.0
        for _, tree in nodes.groupby("tree", sort=True):
            by_node = tree.set_index("node")
            columns = {c: by_node[c].to_dict() for c in by_node.columns}
            pending = [(0, {})]
            while pending:
                node, path = pending.pop()
                if columns["left"][node] < 0:
                    share = math.prod(z for _, _, z in path.values())
                    self.base += columns["value"][node] * share
                    grouped.setdefault(len(path), []).append((path, columns["value"][node]))
                    continue
                feature, cut = columns["feature"][node], columns["threshold"][node]
                low, high, z = path.get(feature, (-math.inf, math.inf, 1.0))
                cover = columns["cover"][node]
                left, right = columns["left"][node], columns["right"][node]
                to_left = (low, min(high, cut), z * columns["cover"][left] / cover)
                to_right = (max(low, cut), high, z * columns["cover"][right] / cover)
                pending.append((left, {**path, feature: to_left}))
                pending.append((right, {**path, feature: to_right}))
        self.groups = []
        for m, leaves in grouped.items():
            if m == 0:
                continue
            # Leaves of equal features stand side by side, so their contributions are added up in runs.
            leaves.sort(key=lambda leaf: sorted(leaf[0]))
            features = np.array([sorted(p) for p, _ in leaves], dtype=int)
            bounds = np.array([[p[f] for f in sorted(p)] for p, _ in leaves], dtype=float)
            values = np.array([v for _, v in leaves], dtype=float)
            starts = np.flatnonzero(np.r_[True, (features[1:] != features[:-1]).any(axis=1)])
            shares = _shares(bounds[:, :, 2], values).reshape(-1, m).T.copy()
            self.groups.append((features, bounds[:, :, 0].T.copy(), bounds[:, :, 1].T.copy(), starts, shares))

    def contributions(self, x: np.ndarray) -> np.ndarray:
        """Shapley value of each feature for rows of feature values (all rows at once)."""
        total = np.zeros(x.shape)
        for features, low, high, starts, shares in self.groups:
            leaves, m = features.shape
            place = np.arange(leaves, dtype=np.int32) << m
            step = max(1, ROWS_TIMES_LEAVES // leaves)
            # Adds up what the runs say about one feature.
            add = np.zeros((m, len(starts), x.shape[1]))
            for i in range(m):
                add[i, np.arange(len(starts)), features[starts, i]] = 1.0
            for start in range(0, len(x), step):
                block = x[start : start + step]
                at = np.zeros((len(block), leaves), np.int32) + place
                for i in range(m):
                    seen = block.take(features[:, i], axis=1)
                    known = (seen > low[i]) & (seen <= high[i])
                    at += known.astype(np.int32) << i
                for i in range(m):
                    part = np.add.reduceat(shares[i].take(at), starts, axis=1)
                    total[start : start + step] += part @ add[i]
        return total


def _shares(unknown: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Contributions of a leaf's features for every pattern of satisfied features.

    ``(leaf, pattern, feature)``. The product of all factors (unknown + known t) is
    built once; dividing one factor out again gives the sums over the coalitions of
    the others, weighted by how often each size comes first.
    """
    leaves, m = unknown.shape
    known = ((np.arange(1 << m)[:, None] >> np.arange(m)) & 1).astype(float)
    product = np.zeros((leaves, 1 << m, m + 1))
    product[:, :, 0] = 1.0
    for i in range(m):
        longer = product * unknown[:, i, None, None]
        longer[:, :, 1:] += product[:, :, :-1] * known[None, :, i, None]
        product = longer
    weights = np.array([math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m) for s in range(m)])
    out = np.empty((leaves, 1 << m, m))
    for j in range(m):
        u = unknown[:, j, None]
        others = np.zeros((leaves, 1 << m, m))
        # By (unknown + t) from the top, by the constant where the feature is not satisfied.
        others[:, :, m - 1] = product[:, :, m]
        for i in range(m - 1, 0, -1):
            others[:, :, i - 1] = product[:, :, i] - u * others[:, :, i]
        unmet = product[:, :, :m] / np.where(u == 0, 1.0, u)[:, :, None]
        others = np.where(known[None, :, j, None] == 1, others, unmet)
        out[:, :, j] = values[:, None] * (known[None, :, j] - u) * (others @ weights)
    return out


def forest_leaves(forest: Forest) -> LeafTable:
    """Explains the mean path length: negative contributions make a row stranger."""
    nodes = forest.nodes
    value = (nodes["depth"] + average_path(nodes["size"].to_numpy())) / forest.trees
    return LeafTable(nodes.assign(cover=nodes["size"].astype(float), value=value))


def boosting_nodes(df: DataFrame, model: PipelineModel) -> pd.DataFrame:
    """Node table of the fitted booster, read from its saved form.

    Bounded: rounds x at most 63 nodes. Leaf values are in log-odds (twice the
    booster's margin).
    """
    spark = df.sparkSession
    path = new_folder(spark, "booster")
    model.stages[-1].write().save(path)
    trees = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "about", "weight")
    split = F.col("nodeData.split")
    nodes = spark.read.parquet(f"{path}/data").join(F.broadcast(trees), "treeID")
    return nodes.select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        split["featureIndex"].alias("feature"),
        F.try_element_at(split["leftCategoriesOrThreshold"], F.lit(1)).alias("threshold"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.rawCount").cast("double").alias("cover"),
        (F.col("nodeData.prediction") * F.col("weight") * 2.0).alias("value"),
    ).toPandas()


def explain_rows(
    df: DataFrame, leaves: LeafTable, features: list[str], samples: int | None, key: str
) -> DataFrame:
    """``customer_hash, contributions, base`` of every row, spread evenly over the cores.

    With ``samples`` only that many rows, in hash order, so the choice is the same
    whatever the partitioning.
    """
    rows = df.select(key, *[F.col(c).cast("double").alias(c) for c in features])
    if samples is not None:
        rows = rows.orderBy(F.xxhash64(F.col(key), F.lit(SAMPLE_SEED)), F.col(key)).limit(samples)
    else:
        rows = spread(rows, key, *features)
    kind = dict(df.dtypes)[key]

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = leaves.contributions(pdf[features].to_numpy(dtype=float))
            yield pd.DataFrame({key: pdf[key], "contributions": list(found), "base": leaves.base})

    return rows.mapInPandas(explain, f"`{key}` {kind}, contributions array<double>, base double")


def top_contributions(
    explained: DataFrame, features: list[str], top: int, key: str = "customer_hash"
) -> DataFrame:
    """``shap_values``: JSON of the ``top`` features by absolute contribution."""
    names = F.array(*[F.lit(c) for c in features])
    entries = F.transform(
        "contributions",
        lambda v, i: F.struct(
            F.abs(v).alias("size"), (-i).alias("place"), F.get(names, i).alias("key"), v.alias("value")
        ),
    )
    largest = F.slice(F.sort_array(entries, asc=False), 1, top)
    pairs = F.transform(largest, lambda e: F.struct(e["key"], e["value"]))
    return explained.select(key, F.to_json(F.map_from_entries(pairs)).alias("shap_values"))


def anomaly_shap(
    feature_matrix: DataFrame,
    forest: Forest,
    samples: int | None = None,
    key: str = "customer_hash",
) -> DataFrame:
    """Top-3 contributions to the mean path length as JSON; empty if there is no tree."""
    if forest.nodes.empty:
        return feature_matrix.sparkSession.createDataFrame([], SHAP_SCHEMA)
    explained = explain_rows(feature_matrix, forest_leaves(forest), S.ANOMALY_FEATURES, samples, key)
    return top_contributions(explained, S.ANOMALY_FEATURES, ANOMALY_TOP, key)


def churn_shap(
    prepared: DataFrame,
    model: PipelineModel,
    features: list[str] | None = None,
    samples: int | None = None,
    key: str = "customer_hash",
) -> DataFrame:
    """Top-5 contributions to the churn log-odds as JSON; empty if there is no tree."""
    features = features or S.CHURN_FEATURES
    nodes = boosting_nodes(prepared, model)
    if nodes.empty:
        return prepared.sparkSession.createDataFrame([], SHAP_SCHEMA)
    explained = explain_rows(prepared, LeafTable(nodes), features, samples, key)
    return top_contributions(explained, features, CHURN_TOP, key)


def explained_anomalies(scores: DataFrame, shap: DataFrame, key: str = "customer_hash") -> DataFrame:
    """Flagged customers with their top contributions."""
    flagged = scores.where(F.col("anomaly_flag") != "normal")
    return flagged.join(shap, key, "left").orderBy(F.desc("anomaly_score"), key)


def explained_risk(risk: DataFrame, shap: DataFrame, key: str = "customer_hash") -> DataFrame:
    """The risk view with the top contributions to each customer's churn risk."""
    return risk.join(shap.withColumnRenamed("shap_values", "churn_factors"), key, "left")
