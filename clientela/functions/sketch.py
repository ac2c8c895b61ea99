"""Mergeable rank sketches of a column, and bounds on the KS distance to the rows they sum up.

A sketch names some values of the column and how many rows lie below and up to each. Its size follows from the wanted
number of parts, not from the rows. Between two neighbouring values lie at most ``rows / parts`` rows, so the distance of
the summed-up distribution to another one is known up to ``1 / parts``, whatever the other one looks like. Sketches of
separate tables merge: where one does not name a value, its neighbours bound the ranks there (after Greenwald and Khanna
2001, with exact ranks to begin with).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela.functions.selection import selected_ranks
from clientela.session import ship_package

PARTS = 256
RANKS = ["below_least", "below_most", "upto_least", "upto_most"]
SKETCH_SCHEMA = "value double, " + ", ".join(f"{c} bigint" for c in RANKS) + ", rows bigint"
BOUNDS_SCHEMA = "ks_low double, ks_high double, slack double, n_first bigint, n_second bigint"


@dataclass
class RankSketch:
    """Values in rising order, with the least and the most rows that may lie below and up to each."""

    values: np.ndarray
    below_least: np.ndarray
    below_most: np.ndarray
    upto_least: np.ndarray
    upto_most: np.ndarray
    rows: int

    @classmethod
    def of(cls, df: DataFrame, column: str, parts: int = PARTS) -> RankSketch:
        """Sketch with exact ranks of at most ``parts + 1`` values; nulls and NaN are skipped.

        Found by counting scans; what comes to the driver are at most 2048 counters for each value.
        """

        def wanted(rows: int) -> list[int]:
            return sorted({max(0, -(-i * rows // parts) - 1) for i in range(parts + 1)})

        sizes, found = selected_ranks(df, [column], wanted)
        edges = np.array(sorted(set(found[0].values())), float).reshape(-1, 3)
        below, upto = edges[:, 1].astype(np.int64), edges[:, 2].astype(np.int64)
        return cls(edges[:, 0], below, below, upto, upto, sizes[0])

    @classmethod
    def from_frame(cls, stored: DataFrame) -> RankSketch:
        """Read a stored sketch. Bounded: its size does not depend on the rows it sums up."""
        table = stored.orderBy("value").toPandas()
        ranks = [table[c].to_numpy(np.int64) for c in RANKS]
        return cls(table["value"].to_numpy(float), *ranks, int(table["rows"].iloc[0]) if len(table) else 0)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        columns = [self.values, *[getattr(self, c) for c in RANKS]]
        rows = [(*r, self.rows) for r in zip(*[c.tolist() for c in columns], strict=True)]
        return spark.createDataFrame(rows, SKETCH_SCHEMA).coalesce(1)

    @property
    def slack(self) -> float:
        """By how much the bounds of a KS distance can differ: the largest share of rows of unknown place."""
        if not self.rows:
            return 0.0
        upto = np.concatenate([[0], self.upto_least])
        below = np.concatenate([self.below_most, [self.rows]])
        return float(max((below - upto).max(), (self.upto_most - self.upto_least).max()) / self.rows)

    def thinned(self, parts: int = PARTS) -> RankSketch:
        """At most ``2 * (parts + 1)`` of the values; the slack grows by no more than ``1 / parts``."""
        if not self.rows:
            return self
        part = self.upto_least * parts // self.rows
        changes = part[1:] != part[:-1]
        kept = np.concatenate([[True], changes]) | np.concatenate([changes, [True]])
        return RankSketch(self.values[kept], *[getattr(self, c)[kept] for c in RANKS], self.rows)

    def ks_bounds(self, below: np.ndarray, upto: np.ndarray, rows: int) -> tuple[float, float]:
        """Bounds of the KS distance to a table with so many rows below and up to each value.

        At a value both distributions are known (this one within its ranks); between two values each lies between
        its share up to the first and its share below the second.
        """
        g_below, g_upto = below / rows, upto / rows
        low, high = 0.0, 0.0
        for least, most, g in (("below_least", "below_most", g_below), ("upto_least", "upto_most", g_upto)):
            f_least, f_most = getattr(self, least) / self.rows, getattr(self, most) / self.rows
            low = max(low, (f_least - g).max(), (g - f_most).max())
            high = max(high, (f_most - g).max(), (g - f_least).max())
        next_f = np.concatenate([self.below_most / self.rows, [1.0]])
        next_g = np.concatenate([g_below, [1.0]])
        last_f = np.concatenate([[0.0], self.upto_least / self.rows])
        last_g = np.concatenate([[0.0], g_upto])
        return float(low), float(max(high, (next_f - last_g).max(), (next_g - last_f).max()))


def merged(sketches: Sequence[RankSketch]) -> RankSketch:
    """Sketch of all rows that ``sketches`` sum up; its slack is no larger than the largest of theirs."""
    filled = [s for s in sketches if s.rows]
    values = np.unique(np.concatenate([s.values for s in filled])) if filled else np.zeros(0)
    ranks = {c: np.zeros(len(values), np.int64) for c in RANKS}
    for s in filled:
        at, after = np.searchsorted(s.values, values, "left"), np.searchsorted(s.values, values, "right")
        named = after > at
        own = np.minimum(at, len(s.values) - 1)
        # Where the sketch does not name the value: no fewer rows than up to the value before, no more than below the next.
        least = np.concatenate([[0], s.upto_least])[at]
        most = np.concatenate([s.below_most, [s.rows]])[after]
        for c in RANKS:
            ranks[c] += np.where(named, getattr(s, c)[own], least if c.endswith("least") else most)
    return RankSketch(values, *[ranks[c] for c in RANKS], sum(s.rows for s in filled))


def counts_at(df: DataFrame, column: str, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """How many rows of ``column`` lie below and up to each of the sorted ``values``, and how many there are.

    One scan; a task returns one row for each value.
    """
    ship_package(df.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below, upto = np.zeros((2, len(values) + 1), np.int64)
        for batch in batches:
            x = batch.column(0).drop_null().to_numpy(zero_copy_only=False)
            x = x[~np.isnan(x)]
            below += np.bincount(np.searchsorted(values, x, "right"), minlength=len(below))
            upto += np.bincount(np.searchsorted(values, x, "left"), minlength=len(upto))
        columns = [np.arange(len(below)), np.cumsum(below), np.cumsum(upto)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["at", "below", "upto"])

    partial = df.select(F.col(column).cast("double")).mapInArrow(scan, "at long, below long, upto long")
    # One row for each value and one for the total.
    total = partial.groupBy("at").agg(F.sum("below").alias("below"), F.sum("upto").alias("upto")).toPandas()
    below, upto = np.zeros((2, len(values) + 1), np.int64)
    below[total["at"]], upto[total["at"]] = total["below"], total["upto"]
    return below[:-1], upto[:-1], int(below[-1])


def ks_bounds(sketch: DataFrame, other: DataFrame, column: str) -> DataFrame:
    """One row ``ks_low, ks_high, slack, n_first, n_second``: the KS distance lies between the two bounds.

    ``sketch`` is a stored sketch, ``other`` a table of rows. ``ks_high - ks_low`` is at most ``slack``, but for
    rounding. Null bounds where either side has no rows.
    """
    first = RankSketch.from_frame(sketch)
    below, upto, rows = counts_at(other, column, first.values)
    low, high = first.ks_bounds(below, upto, rows) if first.rows and rows else (None, None)
    return other.sparkSession.createDataFrame([(low, high, first.slack, first.rows, rows)], BOUNDS_SCHEMA).coalesce(1)
