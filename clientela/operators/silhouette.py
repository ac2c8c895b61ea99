"""Silhouette of plain distances within a given error, without all pairs.

A cluster is summed up by balls: count n, mean m and variance v of the points in a cell. The mean distance from x to a
ball's points is at least |x - m| and at most sqrt(|x - m|^2 + v), both by Jensen's inequality. That bounds a point's
mean distance to every cluster, so its silhouette and the mean of all. Cells that leave most of the gap are cut
in two and everything is bounded again, until half of the gap is at most the given error.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientela.session import materialise, ship_package, spread

ERROR = 0.01
# Cells that together leave this share of the gap are cut.
CUT_SHARE = 0.9
# Distances computed at a time in a task: few enough to stay in the processor's cache.
BLOCK = 1 << 17
# Variances below this share of a cell's squared size are rounding.
ROUNDING = 1e-12


class Cells:
    """A binary tree of cuts for each cluster; its leaves are the cells."""

    def __init__(self, clusters: Sequence[int]):
        self.clusters = np.array(sorted(clusters))
        k = len(self.clusters)
        self.dimension, self.cut = np.full(k, -1), np.zeros(k)
        self.low, self.high = np.full(k, -1), np.full(k, -1)
        self.owner = np.arange(k)

    def split(self, cell: int, dimension: int, cut: float) -> None:
        at = len(self.owner)
        self.dimension[cell], self.cut[cell], self.low[cell], self.high[cell] = dimension, cut, at, at + 1
        for name, value in (("dimension", -1), ("cut", 0.0), ("low", -1), ("high", -1), ("owner", self.owner[cell])):
            setattr(self, name, np.append(getattr(self, name), [value, value]))

    def find(self, clusters: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The cell of each point of a cluster."""
        cell = np.searchsorted(self.clusters, clusters)
        at = np.arange(len(cell))
        while True:
            at = at[self.dimension[cell[at]] >= 0]
            if not len(at):
                return cell
            node = cell[at]
            above = x[at, self.dimension[node]] > self.cut[node]
            cell[at] = np.where(above, self.high[node], self.low[node])


class Balls:
    """Count, mean and variances of every cell that holds points."""

    def __init__(self, cells: Cells, rows: list, width: int):
        self.cell = np.array([r["cell"] for r in rows])
        self.n = np.array([r["n"] for r in rows], float)
        sums, squares = (np.array([r[name] for r in rows]).reshape(-1, width) for name in ("sums", "squares"))
        self.mean = sums / self.n[:, None]
        self.variances = squares / self.n[:, None] - self.mean**2
        self.variances[self.variances < ROUNDING * (1 + self.mean**2)] = 0.0
        self.v = self.variances.sum(axis=1)
        self.minus_twice, self.squares = -2.0 * self.mean.T, (self.mean * self.mean).sum(axis=1)
        self.owner = cells.owner[self.cell]
        self.sizes = np.bincount(self.owner, self.n, len(cells.clusters))
        # Share of each ball in its cluster, by cluster.
        self.shares = np.zeros((len(self.n), len(cells.clusters)))
        self.shares[np.arange(len(self.n)), self.owner] = self.n / self.sizes[self.owner]

    def bounds(self, own: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lowest and highest silhouette of each point, and the gap that each ball leaves."""
        near = x @ self.minus_twice
        near += (x * x).sum(axis=1)[:, None]
        near += self.squares
        np.maximum(near, 0.0, out=near)
        far = near + self.v
        np.sqrt(near, out=near)
        np.sqrt(far, out=far)
        least, most = near @ self.shares, far @ self.shares
        row, size = np.arange(len(x)), self.sizes[own]
        # A point is no neighbour of its own.
        others = size / np.maximum(size - 1, 1)
        a = least[row, own] * others, most[row, own] * others
        least[row, own] = most[row, own] = np.inf
        b = least.min(axis=1), most.min(axis=1)
        low, high = silhouette(a[1], b[0]), silhouette(a[0], b[1])
        low[size == 1] = high[size == 1] = 0.0
        scale = np.maximum(np.maximum(a[1], b[1]), 1e-300)
        far -= near
        left = (1.0 / scale) @ far * self.shares.sum(axis=1)
        return low, high, left


def silhouette(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    most = np.maximum(a, b)
    return np.where(most > 0, (b - a) / np.where(most > 0, most, 1.0), 0.0)


def _points(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return batch.column(0).to_numpy(zero_copy_only=False), x


def _summed(stored: DataFrame, cells: Cells, width: int) -> Balls:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(cells.owner)
        n, sums, squares = np.zeros(size), np.zeros((size, width)), np.zeros((size, width))
        for batch in batches:
            clusters, x = _points(batch, width)
            cell = cells.find(clusters, x)
            n += np.bincount(cell, minlength=size)
            for at in range(width):
                sums[:, at] += np.bincount(cell, x[:, at], size)
                squares[:, at] += np.bincount(cell, x[:, at] ** 2, size)
        used = np.nonzero(n)[0]
        lists = pa.list_(pa.float64())
        columns = [pa.array(used.astype(np.int32)), pa.array(n[used].astype(np.int64)), pa.array(list(sums[used]), lists), pa.array(list(squares[used]), lists)]
        yield pa.RecordBatch.from_arrays(columns, names=["cell", "n", "sums", "squares"])

    parts = stored.mapInArrow(scan, "cell int, n long, sums array<double>, squares array<double>")
    together = [F.array(*[F.sum(F.col(name)[at]) for at in range(width)]).alias(name) for name in ("sums", "squares")]
    # One row per cell.
    return Balls(cells, parts.groupBy("cell").agg(F.sum("n").alias("n"), *together).collect(), width)


def _bounded(stored: DataFrame, cells: Cells, balls: Balls, width: int) -> tuple[float, float, np.ndarray]:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, gap = np.zeros(3), np.zeros(len(balls.n))
        step = max(1, BLOCK // len(balls.n))
        for batch in batches:
            clusters, x = _points(batch, width)
            own = np.searchsorted(cells.clusters, clusters)
            for at in range(0, len(x), step):
                low, high, left = balls.bounds(own[at : at + step], x[at : at + step])
                total += low.sum(), high.sum(), len(low)
                gap += left
        numbers = np.concatenate([total, gap])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(numbers), dtype=np.int32)), pa.array(numbers)], names=["at", "value"])

    rows = stored.mapInArrow(scan, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    values = np.zeros(len(balls.n) + 3)
    for row in rows:
        values[row["at"]] = row["value"]
    return values[0] / values[2], values[1] / values[2], values[3:]


def plain_silhouette(labelled: DataFrame, features: Sequence[str], cluster: str = "cluster_id", error: float = ERROR) -> DataFrame:
    """One row ``silhouette, error, balls``: the mean silhouette lies within ``error`` (at most the one asked for).

    Rows with a null cluster or a null feature are left out; a cluster of one point counts 0, as usual; with fewer than
    two clusters the silhouette is null. Each round is two scans of the stored points; what is shuffled and what comes
    to the driver has one row per cell and task, however many points there are. The number of cells follows from the
    error: at one point a cell the bounds meet.
    """
    ship_package(labelled.sparkSession)
    width = len(features)
    known = labelled.dropna(subset=[*features, cluster])
    points = known.select(F.col(cluster).cast("long").alias("c"), F.array(*[F.col(f).cast("double") for f in features]).alias("x"))
    stored = materialise(spread(points, "c", "x"), "silhouette-points")
    clusters = [r["c"] for r in stored.select("c").distinct().collect()]
    found: tuple = (None, None, 0)
    if len(clusters) > 1:
        cells = Cells(clusters)
        while True:
            balls = _summed(stored, cells, width)
            low, high, gap = _bounded(stored, cells, balls, width)
            found = (float(low + high) / 2, float(high - low) / 2, len(balls.n))
            order = np.argsort(-gap, kind="stable")
            order = order[(gap[order] > 0) & (balls.v[order] > 0)]
            if found[1] <= error or not len(order):
                break
            upto = int(np.searchsorted(np.cumsum(gap[order]), CUT_SHARE * gap[order].sum())) + 1
            for ball in order[:upto]:
                widest = int(balls.variances[ball].argmax())
                cells.split(int(balls.cell[ball]), widest, float(balls.mean[ball, widest]))
    return labelled.sparkSession.createDataFrame([found], "silhouette double, error double, balls long")


def plain_quality(
    labelled: DataFrame, features: Sequence[str], label_columns: dict[int, str], error: float = ERROR
) -> DataFrame:
    """``k_values, silhouette_scores, errors`` of several labelings, for ``segments.select_optimal_k``.

    ``label_columns`` maps k to the column holding its cluster number. Scores closer to each other than their errors
    are not told apart: of those the choice may fall on either.
    """
    rows = []
    for k, column in label_columns.items():
        found = plain_silhouette(labelled, features, column, error).first()
        rows.append((k, found["silhouette"], found["error"]))
    return labelled.sparkSession.createDataFrame(rows, "k_values int, silhouette_scores double, errors double")
