"""Vectors as whole numbers: which rows count, batches as matrices, sums and means without rounding."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sums up to this size are exact as doubles.
EXACT = 1 << 53


def usable(vector: Column) -> Column:
    """The vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(finite, F.lit(False))


def whole(vector: Column, factor: int) -> Column:
    """Components times ``factor``, as doubles, rounded down."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(factor))))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, all of the same width, as int64."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def wide(numbers: np.ndarray, bound: int) -> np.ndarray:
    """The numbers in a type whose sums of products up to ``bound`` are exact: double, else int64, else Python's own."""
    if bound < EXACT:
        return numbers.astype(np.float64)
    return numbers if bound < 1 << 62 else numbers.astype(object)


def largest(numbers: np.ndarray) -> int:
    return max(abs(int(numbers.max())), abs(int(numbers.min()))) if numbers.size else 0


class Sums:
    """Count and componentwise sum of what each of a fixed number of entries was given in one task."""

    def __init__(self, entries: int, width: int):
        self.counts = np.zeros(entries, np.int64)
        self.sums = np.zeros((entries, width), object)
        self.width = width

    def add(self, entry: np.ndarray, numbers: np.ndarray) -> None:
        self.counts += np.bincount(entry, minlength=len(self.counts))
        exact = np.float64 if largest(numbers) * len(numbers) < EXACT else object
        for at in range(self.width):
            if exact is object:
                np.add.at(self.sums[:, at], entry, numbers[:, at].astype(object))
            else:
                part = np.bincount(entry, numbers[:, at].astype(np.float64), len(self.counts))
                self.sums[:, at] += part.astype(np.int64)

    def batch(self) -> pa.RecordBatch:
        used = np.nonzero(self.counts)[0]
        sums = pa.array([[int(v) for v in self.sums[e]] for e in used], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(self.counts[used]), sums], ["entry", "n", "sums"])


SUMS = "entry int, n long, sums array<long>"


def moved(entries: np.ndarray, parts: DataFrame, width: int) -> np.ndarray:
    """Entries after the sums of all tasks: floor of sum by count, where an entry was given anything.

    One row per entry comes to the driver: as many as there are entries, each of ``width`` numbers.
    """
    added = [F.sum(F.col("sums")[at]).alias(f"s{at}") for at in range(width)]
    rows: Iterable = parts.groupBy("entry").agg(F.sum("n").alias("n"), *added).collect()
    result = entries.copy()
    for row in rows:
        result[row["entry"]] = [row[f"s{at}"] // row["n"] for at in range(width)]
    return result
