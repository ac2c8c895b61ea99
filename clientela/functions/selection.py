"""Exact quantiles by radix selection: a few counting scans, no value is sorted or shuffled.

The bits of a double, with the sign turned around, order like the doubles. Each scan counts, for every wanted rank, the
next digit of those values that share the digits found so far; the counts tell the rank's next digit. Only
counters are shuffled: for each task at most one for each wanted rank and digit, however many rows there are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientela.session import materialise, ship_package

# Width of each scan's digit, the highest first: 64 bits together.
DIGITS = [11, 11, 11, 11, 11, 9]
COUNTS = "feature int, prefix long, digit int, n long"


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the doubles; both zeros are one."""
    bits = (values + 0.0).view(np.uint64)
    negative = bits >> np.uint64(63) == 1
    return np.where(negative, ~bits, bits | np.uint64(1 << 63))


def double_of(key: int) -> float:
    """The double with these ordered bits."""
    bits = key ^ (1 << 63) if key >> 63 else key ^ ((1 << 64) - 1)
    return float(np.array([bits], np.uint64).view(np.float64)[0])


def digit_counts(stored: DataFrame, prefixes: list[list[int]], done: int, width: int) -> DataFrame:
    """``feature, prefix, digit, n``: the next ``width`` bits of values whose first ``done`` bits are a wanted prefix."""
    wanted = [np.array(sorted(p), np.uint64) for p in prefixes]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [np.zeros(len(w) << width, np.int64) for w in wanted]
        for batch in batches:
            for at, known in enumerate(wanted):
                if not len(known):
                    continue
                values = batch.column(at).drop_null().to_numpy(zero_copy_only=False)
                keys = ordered_bits(values[~np.isnan(values)])
                top = keys >> np.uint64(64 - done) if done else np.zeros(len(keys), np.uint64)
                place = np.minimum(np.searchsorted(known, top), len(known) - 1)
                mine = known[place] == top
                digit = keys[mine] >> np.uint64(64 - done - width) & np.uint64((1 << width) - 1)
                flat = place[mine].astype(np.int64) << width | digit.astype(np.int64)
                found[at] += np.bincount(flat, minlength=len(found[at]))
        for at, counts in enumerate(found):
            used = np.nonzero(counts)[0]
            columns = [np.full(len(used), at, np.int32), wanted[at][used >> width].astype(np.int64), (used & ((1 << width) - 1)).astype(np.int32), counts[used]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["feature", "prefix", "digit", "n"])

    return stored.mapInArrow(scan, COUNTS).groupBy("feature", "prefix", "digit").agg(F.sum("n").alias("n"))


def selected_ranks(
    df: DataFrame, columns: Sequence[str], wanted: Callable[[int], Sequence[int]]
) -> tuple[list[int], list[dict[int, tuple[float, int, int]]]]:
    """Size of each column, and of each wanted rank (from 0): its value, the rows below that and those up to it.

    ``wanted`` gives the ranks for a column's size; nulls and NaN are skipped. What comes to the driver are the
    counters, at most 2048 for each rank and column.
    """
    ship_package(df.sparkSession)
    stored = materialise(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), "values")
    # Wanted ranks of each column, with the digits found so far, the rank among values of the same digits, and their number.
    open_ranks: list[dict[int, tuple[int, int, int]]] = [{} for _ in columns]
    sizes = [0] * len(columns)
    done = 0
    for width in DIGITS:
        prefixes = [sorted({prefix for prefix, _, _ in ranks.values()}) if done else [0] for ranks in open_ranks]
        counted: dict[tuple[int, int], list[tuple[int, int]]] = {}
        found = digit_counts(stored, prefixes, done, width).toArrow().to_pydict()
        for at, prefix, digit, n in zip(found["feature"], found["prefix"], found["digit"], found["n"], strict=True):
            counted.setdefault((at, prefix), []).append((digit, n))
        for digits in counted.values():
            digits.sort()
        if not done:
            for at in range(len(columns)):
                sizes[at] = sum(n for _, n in counted.get((at, 0), []))
                open_ranks[at] = {r: (0, r, sizes[at]) for r in (wanted(sizes[at]) if sizes[at] else [])}
        for at, ranks in enumerate(open_ranks):
            for rank, (prefix, left, _) in ranks.items():
                for digit, n in counted[at, prefix]:
                    if left < n:
                        ranks[rank] = (prefix << width | digit, left, n)
                        break
                    left -= n
        done += width
    return sizes, [{r: (double_of(key), r - left, r - left + n) for r, (key, left, n) in ranks.items()} for ranks in open_ranks]


def selected_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """Linear-interpolation quantiles: ``feature, share, value`` rows, nulls and NaN skipped.

    The values of :func:`clientela.functions.ranks.exact_quantiles`. A column without values has no rows. What comes
    to the driver are the counters, at most 2048 for each of two ranks a share and column.
    """

    def both_sides(rows: int) -> list[int]:
        return [r for s in shares for r in (math.floor((rows - 1) * s), math.ceil((rows - 1) * s))]

    sizes, found = selected_ranks(df, columns, both_sides)
    rows = []
    for at, name in enumerate(columns):
        for share in shares if sizes[at] else []:
            place = (sizes[at] - 1) * share
            low, high = (found[at][r][0] for r in (math.floor(place), math.ceil(place)))
            rows.append((name, float(share), low + (high - low) * (place - math.floor(place)) if high != low else low))
    return df.sparkSession.createDataFrame(rows, "feature string, share double, value double")
