"""Shards of nearly equal bytes: longest-processing-time scheduling of groups that must stay together."""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientela.functions.ranks import running_totals
from clientela.llm.common import Batches, arrow_batch
from clientela.session import materialise

SHARDS = 16
# Equal groups are dealt one by one through the heap up to so many for each shard, beyond that in bulk.
SINGLE_STEPS = 4


def text_key(text: str):
    """128-bit hash that equal texts share; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def filled_below(loads: list[int], size: int, level: int) -> list[int]:
    """How many groups of ``size`` each shard takes while its load is below ``level``."""
    return [max(0, -((load - level) // size)) for load in loads]


class Schedule:
    """Loads of the shards in a heap; groups come largest first and go to the least loaded shard, then smallest number."""

    def __init__(self, shards: int):
        self.heap = [(0, shard) for shard in range(shards)]

    def take(self, size: int, count: int) -> list[int]:
        """How many of ``count`` groups of ``size`` every shard gets.

        The heap hands out the smallest (load, shard) first, so all places below a level go before any above it.
        For many equal groups the highest level that they fill is searched, and only the rest, fewer than there are
        shards, goes through the heap: the same result as one step for each group.
        """
        shards = len(self.heap)
        given = [0] * shards
        if count > SINGLE_STEPS * shards:
            loads = [load for load, _ in sorted(self.heap, key=lambda e: e[1])]
            low, high = min(loads), min(loads) + size * count + 1
            while high - low > 1:
                middle = (low + high) // 2
                if sum(filled_below(loads, size, middle)) <= count:
                    low = middle
                else:
                    high = middle
            given = filled_below(loads, size, low)
            self.heap = [(load + size * n, shard) for shard, (load, n) in enumerate(zip(loads, given, strict=True))]
            heapq.heapify(self.heap)
        for _ in range(count - sum(given)):
            load, shard = self.heap[0]
            heapq.heapreplace(self.heap, (load + size, shard))
            given[shard] += 1
        return given


def schedule(sizes: DataFrame, shards: int) -> DataFrame:
    """``bytes, first, ends`` for each different group size (``bytes, n`` in ``sizes``).

    ``first`` numbers the size's first group in falling order of sizes; its group number ``i`` goes to the shard
    numbered by how many of ``ends`` are at most ``i``. One task walks the sizes: d different sizes need at least
    d * (d + 1) / 2 bytes of groups, so 100 TB hold fewer than 15 million of them, and no batch is kept.
    """

    def walk(batches: Batches):
        heap, first = Schedule(shards), 0
        for batch in batches:
            firsts, ends = [], []
            for size, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                end, upto = 0, []
                for given in heap.take(size, count):
                    end += given
                    upto.append(end)
                firsts.append(first)
                ends.append(upto)
                first += count
            ends = pa.array(ends, pa.list_(pa.int64()))
            yield arrow_batch(["bytes", "first", "ends"], [batch.column(0), pa.array(firsts, pa.int64()), ends])

    falling = sizes.select("bytes", "n").repartition(1).sortWithinPartitions(F.desc("bytes"))
    return materialise(falling.mapInArrow(walk, "bytes long, first long, ends array<long>"), "schedule")


def sharded_groups(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``grp, bytes, n, shard`` of each group of ``rows`` (``grp``, ``size``: 1 or more).

    Groups go by falling total size, then by key, to the shard with the fewest bytes (of equal ones that with the
    smallest number). A group is summed on the map side, whatever share of the rows it holds.
    """
    groups = rows.groupBy("grp").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    groups = materialise(groups.withColumn("one", F.lit(1).cast("long")), "shard-groups")
    plan = schedule(groups.groupBy("bytes").agg(F.count(F.lit(1)).alias("n")), shards)
    # One global order in place of a rank within each size: sizes may be many, or one size may be that of most groups.
    placed = running_totals(groups, [F.desc("bytes"), "grp"], ["one"]).join(plan, "bytes")
    at = F.col("one_before") - F.col("first")
    shard = F.size(F.filter("ends", lambda end: end <= at)).alias("shard")
    return materialise(placed.select("grp", "bytes", "n", shard), "group-shards")


def shard_documents(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key, size, text_crc32, shard, slot``.

    ``size`` is the text's UTF-8 bytes plus 1, ``text_crc32`` the unsigned CRC of these bytes. Rows of equal texts form
    a group and stay together; null counts as empty. Groups, largest first, go to the least loaded shard, so shards
    differ by no more than the largest group, and a group of a third of all bytes has its shard nearly to itself.
    ``slot`` numbers a shard's rows from 0 by key (null first), then text. Ties go to the smaller shard number;
    groups of equal size are taken by text hash. Repeated rows each have their slot; an empty table gives an empty
    result; other columns are ignored.
    """
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    columns = [F.col(key).alias("id"), (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("crc")]
    # The texts are read once; from here on a row is a few numbers.
    rows = materialise(docs.select(*columns, text_key(text).alias("grp")), "sharded-rows")
    # A text of a third of all rows is a skewed key: a plain join, which adaptive execution splits.
    found = rows.join(sharded_groups(rows, shards).select("grp", "shard"), "grp")
    found = materialise(found.withColumn("one", F.lit(1).cast("long")), "sharded")
    slots = running_totals(found, ["id", "grp"], ["one"], by=["shard"])
    return slots.select(
        F.col("id").alias(key), "size", F.col("crc").alias("text_crc32"), "shard", F.col("one_before").alias("slot")
    )


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, text: str = "text", pieces: int = 8) -> None:
    """Write all rows and columns of ``docs`` to ``folder/shard=N``, up to ``pieces`` files a shard.

    The shard is that of :func:`shard_documents`. ``docs`` must not have a column ``shard`` and should be a scan or a
    written table: pieces follow the row position, which a task that is run again finds unchanged there.
    """
    grouped = docs.withColumn("_grp", text_key(text)).withColumn("_at", F.monotonically_increasing_id())
    sizes = grouped.select(F.col("_grp").alias("grp"), (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 1).alias("size"))
    groups = sharded_groups(materialise(sizes, "sharded-rows"), shards)
    placed = grouped.join(groups.select(F.col("grp").alias("_grp"), "shard"), "_grp")
    # Rows of a group go to all pieces of its shard, so no task holds a whole shard.
    dealt = placed.repartition(shards * pieces, "shard", F.pmod("_at", F.lit(pieces)))
    dealt.drop("_grp", "_at").write.partitionBy("shard").parquet(folder)
