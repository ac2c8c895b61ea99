"""What the document operators share: table access, text as bytes, row keys, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela.session import materialise, ship_package

# ASCII white space: space and 0x09 to 0x0D.
BLANKS = b" \t\n\x0b\x0c\r"
# Second and later bytes of a UTF-8 character.
CONTINUATION = bytes(range(0x80, 0xC0))


# Bytes of an Arrow batch, about: tasks hold a few batches, as bytes and as Python objects, however long texts are.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 6 << 20


def prepare(spark: SparkSession) -> None:
    """What the operators need of a session: the package on the executors, batches of bounded size."""
    ship_package(spark)
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{folder}/{table}.parquet")


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def code_points(data: bytes) -> int:
    return len(data.translate(None, CONTINUATION))


def arrow_batch(names: list[str], arrays: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a) for a in arrays], names=names)


Batches = Iterator[pa.RecordBatch]


def same(left: str, right: str):
    """Null-safe equality of two aliased columns."""
    return F.col(left).eqNullSafe(F.col(right))


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` of every node of an edge table; root is the smallest node of its component.

    Alternating large-star and small-star steps (Kiveris et al. 2014). Every step is a grouped minimum, which
    combines on the map side, and a join of plain shuffles, which adaptive execution splits where one node has many
    neighbours (the minima are dealt anew, else the join would stay tied to the grouping). Each step is written to the shared folder, so lineage stays short.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    current = materialise(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).repartition(F.xxhash64("u"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        current = materialise(large, "large-star")
        low = current.groupBy("u").agg(F.min("v").alias("m")).repartition(F.xxhash64("u"))
        joined = current.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        current = materialise(small, "small-star")
        mark = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == before:
            break
        before = mark
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
