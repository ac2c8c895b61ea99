"""CSV files whose quoted fields hold line breaks, read in splits.

A line break ends a record only outside quotes, which a reader that starts in the middle of a file cannot know. Here
every split counts its quotes once; whether a split starts inside quotes is the parity of all quotes before it, a prefix
sum over one number per split. With that each split cuts its own records; only records that cross a border are put
together from the pieces of two or more splits.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clientela.session import materialise

SPLIT_SETTING = "spark.sql.files.maxPartitionBytes"
# A field is quoted as a whole or holds no quote: else the parity of quotes tells nothing. No part can backtrack.
FIELD = r'(?:"(?:[^"]|"")*+"|[^",]*+)'
WELL_FORMED = f"^{FIELD}(?:,{FIELD})*+$"
PIECES = "file string, block bigint, row bigint, piece string, text string"
BLANK = ["", "\r"]


@contextmanager
def split_size(spark: SparkSession, size: int | None) -> Iterator[None]:
    """Splits of at most ``size`` bytes for the reads that run meanwhile; the session's own setting where it is None."""
    before = spark.conf.get(SPLIT_SETTING)
    spark.conf.set(SPLIT_SETTING, str(size) if size else before)
    try:
        yield
    finally:
        spark.conf.set(SPLIT_SETTING, before)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines with file, start of their split, and a number that grows within the split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )


def _quotes(text: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def _in_fewer_tasks(lines: DataFrame, size: int | None, usual: str) -> DataFrame:
    """The same splits of ``size`` bytes, but a task reads ``usual`` bytes: a task for each small split would cost more.

    A split's lines stay together and in order.
    """
    if not size:
        return lines
    context = lines.sparkSession.sparkContext
    most = context._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(usual)
    splits = lines.rdd.getNumPartitions()
    tasks = max(context.defaultParallelism, -(-splits * size // most))
    return lines.coalesce(tasks) if tasks < splits else lines


def _inside_quotes(lines: DataFrame) -> DataFrame:
    """``file, block, inside``: whether the split starts inside a quoted field. One row per split."""
    counted = lines.groupBy("file", "block").agg(F.sum(_quotes("value")).alias("quotes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(earlier) % 2 == 1, F.lit(False))
    return counted.select(F.col("file").alias("_file"), F.col("block").alias("_block"), inside.alias("inside"))


def _goes_on(batch: pa.RecordBatch, split: tuple | None) -> bool:
    """Whether a record of ``split`` that is open before the batch is still open after it: no line ends it."""
    file, block, odd = batch.column(0), batch.column(1), batch.column(5)
    if pc.any(odd).as_py():
        return False
    return pc.all(pc.equal(block, split[1])).as_py() and pc.all(pc.equal(file, split[0])).as_py()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each split as ``whole``; ``tail``, ``middle`` and ``open`` are pieces of records that cross borders.

    ``tail`` ends a record of an earlier split, ``open`` begins one that a later split ends, ``middle`` does neither.
    Batches are lines with file, block, row, value, whether their split starts inside quotes, and whether their own
    quotes are odd in number. The lines of a record that is not complete go to the next batch. ``lead`` marks the first
    whole record of a split that is not blank, and may mark others.
    """
    kinds = pa.array(["whole", "tail", "open", "middle"])
    held: list[pa.RecordBatch] = []
    # The split of the last line, and whether the held lines began inside quotes.
    split: tuple | None = None
    begun = False

    def records(lines: pa.RecordBatch, last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, split, begun
        n = lines.num_rows
        file, block, row, value, inside, odd = lines.columns
        files, blocks = file.dictionary_encode().indices.to_numpy(), block.to_numpy()
        new = np.concatenate([[(file[0].as_py(), int(blocks[0])) != split], (files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])])
        first = np.nonzero(np.concatenate([[True], new[1:]]))[0]
        at = inside.to_numpy(zero_copy_only=False)[first].astype(np.int64)
        if not new[0]:
            at[0] = begun
        odd = odd.to_numpy(zero_copy_only=False).astype(np.int64)
        upto = np.cumsum(odd)
        spans = np.diff(np.concatenate([first, [n]]))
        quoted = (np.repeat(at - upto[first] + odd[first], spans) + upto) % 2
        ends = quoted == 0
        ends[first[1:] - 1] = True
        ends[-1] |= last
        ends = np.nonzero(ends)[0] + 1
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        crossing = np.zeros(n, bool)
        crossing[first] = at == 1
        split, begun = (file[n - 1].as_py(), int(blocks[-1])), False
        if not len(ends) or ends[-1] < n:
            rest = ends[-1] if len(ends) else 0
            held, begun = [lines.slice(rest)], bool(crossing[rest])
            starts = starts[: len(ends)]
        if len(ends):
            kind = crossing[starts] + 2 * quoted[ends - 1]
            parts = pa.ListArray.from_arrays(pa.array(np.concatenate([starts, ends[-1:]]), pa.int32()), value)
            text = pc.binary_join(parts, "\n")
            full = np.nonzero((kind == 0) & ~pc.is_in(text, pa.array(BLANK)).to_numpy(zero_copy_only=False))[0]
            lead = np.zeros(len(starts), bool)
            lead[full[np.unique(np.searchsorted(first, starts[full], side="right"), return_index=True)[1]]] = True
            places = pa.array(starts)
            columns = [file.take(places), block.take(places), row.take(places), kinds.take(pa.array(kind)), text, pa.array(lead)]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "row", "piece", "text", "lead"])

    for batch in batches:
        # A record of many batches is put together when its last line has come, or the next split.
        if held and batch.num_rows and _goes_on(batch, split):
            held.append(batch)
            continue
        if batch.num_rows:
            lines = pa.concat_batches([*held, batch])
            held = []
            yield from records(lines, False)
    if held:
        lines = pa.concat_batches(held)
        held = []
        yield from records(lines, True)


def _joined(pieces: DataFrame) -> DataFrame:
    """The records that cross borders: an ``open`` piece and all pieces up to the next one. A few pieces per split.

    Which open piece a split continues follows from one row per split; texts are only shuffled by record.
    """
    is_open = F.col("piece") == "open"
    opened = pieces.groupBy("file", "block").agg(F.max(F.when(is_open, F.col("block"))).alias("opened"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    continued = opened.select(F.col("file").alias("_file"), F.col("block").alias("_block"), F.max("opened").over(earlier).alias("continued"))
    known = pieces.join(F.broadcast(continued), (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
    numbered = known.withColumn("number", F.when(is_open, F.col("block")).otherwise(F.col("continued")))
    one = F.array_sort(F.collect_list(F.struct("block", "row", "text")))
    grouped = numbered.groupBy("file", "number").agg(one.alias("all"))
    return grouped.select(
        "file",
        F.col("all")[0]["block"].alias("block"),
        F.col("all")[0]["row"].alias("row"),
        F.array_join(F.transform("all", lambda p: p["text"]), "\n").alias("text"),
    )


def _stored(spark: SparkSession, path: str, split_bytes: int | None) -> tuple[DataFrame, DataFrame]:
    """All records, and a few for each split that hold the first one of every file; both ``file, block, row, text``.

    Texts of whole records, of pieces and of first records are written as columns of their own, so that who wants the
    few need not read the many.
    """
    usual = spark.conf.get(SPLIT_SETTING)
    with split_size(spark, split_bytes):
        lines = _in_fewer_tasks(_lines(spark, path), split_bytes, usual)
        starts = F.broadcast(materialise(_inside_quotes(lines), "split-starts"))
        known = lines.join(starts, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
        odd = _quotes("value") % 2 == 1
        cut = known.select("file", "block", "row", "value", "inside", odd.alias("odd")).mapInArrow(_cut, f"{PIECES}, lead boolean")
        is_whole = F.col("piece") == "whole"
        texts = [F.when(is_whole, F.col("text")).alias("text"), F.when(~is_whole, F.col("text")).alias("part"), F.when(F.col("lead"), F.col("text")).alias("lead")]
        pieces = materialise(cut.where(~(is_whole & F.col("text").isin(BLANK))).select("file", "block", "row", "piece", *texts), "csv-pieces")
    columns = ["file", "block", "row", "text"]
    parts = pieces.where("piece <> 'whole'").select("file", "block", "row", "piece", F.col("part").alias("text"))
    # Records that cross borders hold quotes, so none is blank.
    crossing = materialise(_joined(parts).select(columns), "csv-crossing")
    whole = pieces.where("piece = 'whole'").select(columns)
    early = pieces.where("lead IS NOT NULL").select("file", "block", "row", F.col("lead").alias("text"))
    return whole.unionByName(crossing), early.unionByName(crossing)


def read_records(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """``file, block, row, text`` of every CSV record below ``path``, quoted line breaks included.

    Two scans in splits; the records are written once, so nothing later depends on how the files were split. Empty
    lines outside quotes are no records. Line ends stay as they are, a carriage return at a record's end too. What
    is broadcast has one row per split: 100 TB in splits of 128 MB are about 800 000 rows.
    """
    return _stored(spark, path, split_bytes)[0]


def read_quoted_csv(spark: SparkSession, path: str, columns: list[str], schema: str, split_bytes: int | None = None) -> DataFrame:
    """Rows of header CSV files with quoted line breaks: ``file, block, row`` (file order) and the fields of ``schema``.

    ``columns`` is the header that every file must have. Where it ends in a carriage return and a line feed, that is the
    file's line end, and one inside quotes is read as a line feed. A record with a quote inside an unquoted field fails the
    read: there the parity of quotes does not tell where records end.
    """
    options = {"escape": '"', "multiLine": "true"}
    records, early = _stored(spark, path, split_bytes)
    place = F.struct("block", "row")
    heads = materialise(early.groupBy("file").agg(F.min(place).alias("head"), F.min_by("text", place).alias("text")), "headers")
    names = ", ".join(f"c{i} string" for i in range(len(columns) + 1))
    found = F.from_csv(F.rtrim("text", F.lit("\r")), names, options)
    fields = F.array_compact(F.array(*[found[f"c{i}"] for i in range(len(columns) + 1)]))
    other = heads.where(fields != F.array(*[F.lit(c) for c in columns])).select("file", "text").limit(1).collect()
    if other:
        raise ValueError(f"header of {other[0]['file']} is {other[0]['text']!r}, not {columns}")
    # One row per file.
    wide = F.col("text").endswith("\r").alias("wide")
    first = F.broadcast(heads.select(F.col("file").alias("_file"), "head", wide))
    body = records.join(first, F.col("file") == F.col("_file"))
    body = body.where(place != F.col("head"))
    stray = F.raise_error(F.concat(F.lit("quote inside an unquoted field: "), F.left("text", F.lit(200))))
    narrow = F.replace(F.regexp_replace("text", "\r$", ""), F.lit("\r\n"), F.lit("\n"))
    plain = F.when(F.col("wide"), narrow).otherwise(F.col("text"))
    body = body.withColumn("text", plain)
    text = F.when(F.col("text").rlike(WELL_FORMED), F.col("text")).otherwise(stray.cast("string"))
    return body.select("file", "block", "row", F.from_csv(text, schema, options).alias("fields")).select("file", "block", "row", "fields.*")
