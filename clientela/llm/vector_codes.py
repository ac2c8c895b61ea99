"""Short codes for vectors: one codebook for each part of a vector, searched through neighbour lists (Orchard 1991)."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientela.llm.common import Batches, arrow_batch
from clientela.llm.vectors import SUMS, Sums, largest, matrix, moved, usable, whole, wide
from clientela.session import materialise

PARTS = 8
ENTRIES = 16
ROUNDS = 6
FACTOR = 4096
# Vectors searched together.
TOGETHER = 2048


class Codebooks:
    """Entries of all part positions, and for each entry the others of its codebook by growing distance.

    ``entries`` is ``parts x entries x width``. The lists take parts * entries^2 numbers, fixed for a round.
    """

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.parts, self.k, self.width = entries.shape
        numbers = wide(entries, 4 * (2 * largest(entries) + 1) ** 2 * max(1, self.width))
        gap = numbers[:, :, None, :] - numbers[:, None, :, :]
        apart = (gap * gap).sum(axis=3)
        order = np.argsort(apart, axis=2, kind="stable")
        # An entry is not its own neighbour; one equal to it is.
        others = order[order != np.arange(self.k)[None, :, None]].reshape(self.parts, self.k, self.k - 1)
        self.neighbours = others.reshape(self.parts * self.k, self.k - 1)
        self.apart = np.take_along_axis(apart, others, axis=2).reshape(self.parts * self.k, self.k - 1)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers and squared distances, ``vectors x parts`` each; of equally near entries the smallest number.

        A search holds the best entry so far and walks that entry's list. A nearer entry (or one as near with a smaller
        number) takes its place, and the walk goes on at the head of the new entry's list. Entries that were
        measured before are marked and not measured again. A neighbour further from the best entry than twice the current
        distance is further from the vector than the best entry, by the triangle inequality, and so are all behind it:
        there the search ends. (Squares: four times.) One at exactly twice may be a tie and is still measured.
        """
        items = vectors.reshape(-1, self.width)
        bound = 4 * (largest(self.entries) + largest(items)) ** 2 * max(1, self.width)
        items, entries = wide(items, bound), wide(self.entries, bound).reshape(-1, self.width)
        base = np.tile(np.arange(self.parts) * self.k, len(vectors))
        best = np.zeros(len(items), np.int64)
        gap = items - entries[base]
        distance = (gap * gap).sum(axis=1)
        marked = np.zeros((len(items), self.k), bool)
        marked[:, 0] = True
        place = np.zeros(len(items), np.int64)
        at = np.arange(len(items)) if self.k > 1 else np.arange(0)
        while len(at):
            row = base[at] + best[at]
            at = at[self.apart[row, place[at]] <= 4 * distance[at]]
            other = self.neighbours[base[at] + best[at], place[at]]
            fresh = ~marked[at, other]
            place[at] += 1
            new, other = at[fresh], other[fresh]
            marked[new, other] = True
            gap = items[new] - entries[base[new] + other]
            found = (gap * gap).sum(axis=1)
            better = (found < distance[new]) | ((found == distance[new]) & (other < best[new]))
            moving, to = new[better], other[better]
            best[moving], distance[moving], place[moving] = to, found[better], 0
            at = at[place[at] < self.k - 1]
        return best.reshape(-1, self.parts), distance.reshape(-1, self.parts)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def sums_of_round(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``entry, n, sums``: what one task gave to each entry (numbered through all parts)."""
    size = books.parts * books.width

    def run(batches: Batches):
        sums = Sums(books.parts * books.k, books.width)
        for batch in batches:
            rows = matrix(batch.column(0), size)
            for at in range(0, len(rows), TOGETHER):
                part = rows[at : at + TOGETHER]
                best, _ = books.nearest(part)
                sums.add((best + np.arange(books.parts) * books.k).reshape(-1), part.reshape(-1, books.width))
        yield sums.batch()

    return vectors.select("numbers").mapInArrow(run, SUMS)


def coded(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``id, label, code, error`` of every vector; a code has two hex digits for each part."""
    size = books.parts * books.width

    def run(batches: Batches):
        for batch in batches:
            rows = matrix(batch.column(2), size)
            for at in range(0, len(rows), TOGETHER):
                best, distance = books.nearest(rows[at : at + TOGETHER])
                codes = [bytes(b).hex() for b in best.astype(np.uint8)]
                error = pa.array([int(e) for e in distance.sum(axis=1)], pa.int64())
                left = [batch.column(i).slice(at, len(codes)) for i in (0, 1)]
                yield arrow_batch(["id", "label", "code", "error"], [*left, pa.array(codes, pa.string()), error])

    fields = [vectors.schema["id"], vectors.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    return vectors.select("id", "label", "numbers").mapInArrow(run, T.StructType(fields))


def compress(
    table: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    factor: int = FACTOR,
) -> tuple[DataFrame, Codebooks | None]:
    """``key, label, code, error`` of every kept vector, and the codebooks (none without vectors).

    Vectors that are null or hold a null or not finite component are left out; a component x becomes floor(factor * x)
    and vectors are cut into ``parts`` equal parts. Vectors can be compared only at one length: the most frequent one
    that parts divide (of equally frequent ones the larger); rows of other lengths are left out like null vectors.
    Codebooks start as the parts of the ``entries`` kept vectors with the smallest keys (null last; of repeated keys
    the smaller vector first), at most 256; fewer vectors make fewer entries. Each of ``rounds`` rounds gives
    every part to its nearest entry, the smaller number if two are as near, and moves entries to the floor of their
    parts' mean; unused ones stay. ``error`` is the squared distance summed over parts. Repeated rows are coded
    each, other columns are ignored, an empty table gives an empty result. All arithmetic is in whole numbers and
    exact; errors and sums that no long holds raise an error.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits: at most 256 entries")
    columns = [F.col(key).alias("id"), F.col(label).alias("label"), whole(F.col(vector), factor).alias("numbers")]
    every = materialise(table.where(usable(F.col(vector))).select(*columns), "vectors")
    length = F.size("numbers")
    cut = every.where((length > 0) & (length % parts == 0))
    common = cut.groupBy(length.alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if common is None:
        return every.limit(0).select(F.col("id").alias(key), "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), None
    vectors = every.where(length == common["size"])
    # ``entries`` rows.
    first = vectors.orderBy(F.asc_nulls_last("id"), "numbers").limit(entries).select("numbers").collect()
    start = np.array([row["numbers"] for row in first], np.int64).reshape(len(first), parts, -1)
    books = Codebooks(np.ascontiguousarray(start.transpose(1, 0, 2)))
    for _ in range(rounds):
        flat = books.entries.reshape(-1, books.width)
        books = Codebooks(moved(flat, sums_of_round(vectors, books), books.width).reshape(books.entries.shape))
    return materialise(coded(vectors, books), "vector-codes").withColumnRenamed("id", key), books


def decoded(codes: DataFrame, books: Codebooks, factor: int = FACTOR, code: str = "code") -> DataFrame:
    """``codes`` with ``decoded``: the vector that a code stands for; null for a null code."""
    entries = [F.array(*[F.array(*[F.lit(v / factor) for v in e]) for e in book.tolist()]) for book in books.entries]

    def part(number: int):
        digits = F.substring(F.col(code), 2 * number + 1, 2)
        return F.element_at(entries[number], F.conv(digits, 16, 10).cast("int") + 1)

    vector = F.concat(*[part(number) for number in range(books.parts)])
    return codes.withColumn("decoded", F.when(F.col(code).isNotNull(), vector))


def code_report(table: DataFrame, key: str = "vec_id", label: str = "label", **options) -> DataFrame:
    """``key, code, error, label_error, codebooks_sha256``; equal labels share one ``label_error``, null ones too."""
    found, books = compress(table, key, label=label, **options)
    # A label of a third of all rows is summed on the map side; the join is a plain one, which adaptive execution splits.
    sums = found.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    digest = F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256")
    return found.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(key, "code", "error", "label_error", digest)
