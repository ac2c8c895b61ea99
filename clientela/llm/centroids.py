"""Centroid clustering in whole numbers: the nearest centroid by a tournament of bisectors."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientela.llm.common import Batches, arrow_batch
from clientela.llm.vectors import SUMS, Sums, largest, matrix, moved, usable, whole, wide
from clientela.session import materialise

CLUSTERS = 40
ROUNDS = 5
FACTOR = 256
SIZE = 64
# Vectors in one tournament: the normals gathered for them stay in the cache.
TOGETHER = 2048


class Bisectors:
    """For every pair of centroids i < j the bisecting hyperplane: x is nearer to j when normal . x > threshold.

    |x - ci|^2 - |x - cj|^2 = 2 (cj - ci) . x - (|cj|^2 - |ci|^2), so normals and thresholds are whole numbers and a
    sign decides; zero is a tie, which the smaller number wins. They are k (k - 1) / 2 normals, fixed for a round.
    """

    def __init__(self, centroids: np.ndarray):
        self.centroids, self.k = centroids, len(centroids)
        numbers = wide(centroids, 4 * (largest(centroids) + 1) ** 2 * max(1, centroids.shape[1]))
        squares = (numbers * numbers).sum(axis=1)
        low, high = np.triu_indices(self.k, 1)
        normals = 2 * (numbers[high] - numbers[low])
        self.normals = normals if normals.dtype == object else normals.astype(np.int64)
        thresholds = squares[high] - squares[low]
        self.thresholds = thresholds if thresholds.dtype == object else thresholds.astype(np.int64)
        self.place = np.zeros((self.k, self.k), np.int64)
        self.place[low, high] = np.arange(len(low))
        self.as_double = self.normals.astype(np.float64), self.thresholds.astype(np.float64)

    def nearest(self, rows: np.ndarray) -> np.ndarray:
        """Number of the nearest centroid of each row, of equally near ones the smallest: k - 1 sign tests for a row."""
        bound = (largest(self.normals) + 1) * (largest(rows) + 1) * max(1, rows.shape[1]) + largest(self.thresholds)
        numbers = wide(rows, bound)
        normals, thresholds = self.as_double if numbers.dtype == np.float64 else (self.normals, self.thresholds)
        if numbers.dtype == object:
            normals = normals.astype(object)
        winner = np.zeros(len(rows), np.int64)
        for challenger in range(1, self.k):
            pair = self.place[winner, challenger]
            side = (normals[pair] * numbers).sum(axis=1) - thresholds[pair]
            winner[side > 0] = challenger
        return winner

    def distances(self, rows: np.ndarray, winner: np.ndarray) -> np.ndarray:
        """Squared distance of each row to its centroid, exact."""
        bound = (largest(self.centroids) + largest(rows)) ** 2 * max(1, rows.shape[1])
        gap = wide(rows, bound) - wide(self.centroids, bound)[winner]
        return (gap * gap).sum(axis=1)


def starting_order(key: str) -> Column:
    """Lowercase hex SHA-256 of ``2:`` and the key; null for a null key."""
    return F.sha2(F.concat(F.lit("2:"), F.col(key).cast("string")).cast("binary"), 256)


def assigned(vectors: DataFrame, centroids: np.ndarray, size: int) -> DataFrame:
    """``id, cluster, distance`` of every vector."""
    bisectors = Bisectors(centroids)

    def run(batches: Batches):
        for batch in batches:
            rows = matrix(batch.column(1), size)
            for at in range(0, len(rows), TOGETHER):
                part = rows[at : at + TOGETHER]
                winner = bisectors.nearest(part)
                distance = pa.array([int(d) for d in bisectors.distances(part, winner)], pa.int64())
                yield arrow_batch(["id", "cluster", "distance"], [batch.column(0).slice(at, len(part)), pa.array(winner, pa.int32()), distance])

    kind = [T.StructField("id", vectors.schema["id"].dataType), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
    return vectors.select("id", "numbers").mapInArrow(run, T.StructType(kind))


def sums_of_round(vectors: DataFrame, centroids: np.ndarray, size: int) -> DataFrame:
    """``entry, n, sums``: what one task gave to each centroid, a row for each task and centroid."""
    bisectors = Bisectors(centroids)

    def run(batches: Batches):
        sums = Sums(len(centroids), size)
        for batch in batches:
            rows = matrix(batch.column(0), size)
            for at in range(0, len(rows), TOGETHER):
                part = rows[at : at + TOGETHER]
                sums.add(bisectors.nearest(part), part)
        yield sums.batch()

    return vectors.select("numbers").mapInArrow(run, SUMS)


def cluster_vectors(
    table: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    factor: int = FACTOR,
    size: int = SIZE,
) -> tuple[DataFrame, np.ndarray]:
    """``key, cluster, distance`` of every kept vector, and the centroids.

    Kept are vectors of exactly ``size`` components, none null or not finite; a component x becomes floor(factor * x).
    The first centroids are the kept vectors with the smallest hash of their key (a null key comes last; of repeated
    keys the smaller vector comes first, and repeated rows count as often as they stand there). Each of ``rounds``
    rounds gives every vector to its nearest centroid, the smaller number if two are as near, and moves centroids to
    the floor of their vectors' mean; one that is given nothing stays. ``distance`` is squared. Fewer vectors than
    ``clusters`` make fewer centroids, none an empty result. All arithmetic is in whole numbers and exact; distances
    and sums that no long holds raise an error. Other columns are ignored.
    """
    column = F.col(vector)
    kept = table.where((F.size(column) == size) & usable(column)).select(F.col(key).alias("id"), whole(column, factor).alias("numbers"))
    vectors = materialise(kept, "vectors")
    # ``clusters`` rows.
    first = vectors.orderBy(F.asc_nulls_last(starting_order("id")), "numbers").limit(clusters).select("numbers").collect()
    centroids = np.array([row["numbers"] for row in first], np.int64).reshape(-1, size)
    if len(centroids):
        for _ in range(rounds):
            centroids = moved(centroids, sums_of_round(vectors, centroids, size), size)
        found = materialise(assigned(vectors, centroids, size), "assigned")
    else:
        found = vectors.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    return found.withColumnRenamed("id", key), centroids


def cluster_report(table: DataFrame, key: str = "vec_id", **options) -> DataFrame:
    """Clusters of :func:`cluster_vectors` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256``."""
    found, centroids = cluster_vectors(table, key, **options)
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    names = table.sparkSession.createDataFrame(list(enumerate(digests)), "cluster int, centroid_sha256 string")
    # One row for each cluster.
    totals = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    overall = totals.agg(F.sum("cluster_inertia").alias("inertia")).first()["inertia"]
    totals = totals.join(F.broadcast(names), "cluster").withColumn("inertia", F.lit(overall).cast("long"))
    return found.join(F.broadcast(totals), "cluster").select(
        key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
