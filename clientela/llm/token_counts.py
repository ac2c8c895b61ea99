"""Exact histogram of encoded document lengths, and what its suffix sums answer."""

from __future__ import annotations

import base64
import re
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela.functions.ranks import running_totals
from clientela.llm.common import Batches, arrow_batch
from clientela.session import materialise

RANKS_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Word pattern that belongs to these ranks (a fixed value of the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Runs of blanks from this length on are cut out before the pattern sees them: its look-ahead steps back over the whole
# run, and a run of a million overflows its stack. The blanks of the pattern (a fixed value: Unicode White_Space).
LONG_BLANKS = 10_000
BLANK_RUNS = re.compile(r"([\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,})" % LONG_BLANKS)

_encoders: dict[int, object] = {}


def encoder(ranks: bytes, pattern: str):
    """The tokenizer of a vocabulary file, built once in each worker process."""
    import tiktoken

    number = hash((ranks, pattern))
    if number not in _encoders:
        pairs = (line.split() for line in ranks.splitlines() if line)
        merges = {base64.b64decode(token): int(rank) for token, rank in pairs}
        _encoders[number] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
    return _encoders[number]


def encoded_length(encoder, text: str) -> int:
    """Number of tokens of a text.

    Of a run of blanks before other text the pattern takes all but the last as one piece; at the end it takes all.
    """
    if len(text) < LONG_BLANKS:
        return len(encoder.encode_ordinary(text))
    total, parts = 0, BLANK_RUNS.split(text)
    for i in range(1, len(parts), 2):
        run = parts[i]
        if parts[i + 1]:
            run, parts[i + 1] = run[:-1], run[-1] + parts[i + 1]
        total += len(encoder._encode_single_piece(run.encode()))
    return total + sum(len(encoder.encode_ordinary(p)) for p in parts[::2])


def read_file(spark: SparkSession, path: str) -> bytes:
    """A vocabulary file as the driver sees it (about 1 MB), to be broadcast: executors need no copy of their own."""
    with open(path, "rb") as file:
        return file.read()


def encoded_lengths(docs: DataFrame, text: str = "text", by: Sequence[str] = (), ranks_file: str = RANKS_FILE) -> DataFrame:
    """``length`` of every row (and the ``by`` columns); null and empty texts have length 0."""
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(read_file(spark, ranks_file))
    by = list(by)

    def count(batches: Batches):
        tokenizer = encoder(shipped.value, PATTERN)
        for batch in batches:
            lengths = [encoded_length(tokenizer, t) if t else 0 for t in batch.column(len(by)).to_pylist()]
            yield arrow_batch([*by, "length"], [*[batch.column(i) for i in range(len(by))], pa.array(lengths, pa.int64())])

    kind = docs.select(*by, F.lit(0).cast("long").alias("length")).schema
    return docs.select(*by, text).mapInArrow(count, kind)


def length_histogram(docs: DataFrame, text: str = "text", by: Sequence[str] = (), ranks_file: str = RANKS_FILE) -> DataFrame:
    """``length, n_docs`` (by the ``by`` columns): one row per distinct encoded length.

    Counted on the map side, so a source with a third of all rows costs no more than any other.
    """
    lengths = encoded_lengths(docs, text, by, ranks_file)
    # Written, since all answers read it again: the texts are encoded once.
    return materialise(lengths.groupBy(*by, "length").agg(F.count(F.lit(1)).alias("n_docs")), "lengths")


def context_limits(histogram: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """What a context limit of each distinct length would keep.

    ``length, n_docs, docs_longer, tokens_longer`` (suffix sums over longer documents), ``docs_upto``,
    ``tokens_upto`` (documents that fit whole), ``tokens_truncated`` (all documents cut at the limit) and
    ``share_upto`` (of documents: the quantile that the length is). An empty table has no rows.
    """
    weighed = histogram.withColumn("tokens", F.col("n_docs") * F.col("length"))
    summed = running_totals(weighed, [F.desc("length")], ["n_docs", "tokens"], by=by)
    totals = histogram.groupBy(*[F.col(c).alias(f"_by_{c}") for c in by]).agg(
        F.sum("n_docs").alias("docs"), F.sum(F.col("n_docs") * F.col("length")).alias("all_tokens")
    )
    # One row for each group (null is one), at most as many as the ``by`` columns have values.
    if by:
        same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
        joined = summed.join(totals, reduce(lambda a, b: a & b, same))
    else:
        joined = summed.select("*", *[totals.select(c).scalar().alias(c) for c in ("docs", "all_tokens")])
    longer, tokens = F.col("n_docs_before"), F.col("tokens_before")
    return joined.select(
        *by,
        "length",
        "n_docs",
        longer.alias("docs_longer"),
        tokens.alias("tokens_longer"),
        (F.col("docs") - longer).alias("docs_upto"),
        (F.col("all_tokens") - tokens).alias("tokens_upto"),
        (F.col("all_tokens") - tokens + longer * F.col("length")).alias("tokens_truncated"),
        ((F.col("docs") - longer) / F.col("docs")).alias("share_upto"),
    )


def truncated_total(limits: DataFrame, limit: int) -> DataFrame:
    """One row: documents and tokens kept at any ``limit``, read off the suffix sums of :func:`context_limits`."""
    fits = F.col("length") <= limit
    return limits.agg(
        F.coalesce(F.max(F.when(fits, F.col("docs_upto"))), F.lit(0)).alias("docs_whole"),
        (
            F.coalesce(F.max(F.when(fits, F.col("tokens_upto"))), F.lit(0))
            + limit * F.coalesce(F.sum(F.when(~fits, F.col("n_docs"))), F.lit(0))
        ).alias("tokens_kept"),
    )


def length_quantile(limits: DataFrame, share: float) -> DataFrame:
    """One row: the smallest length that at least ``share`` of the documents do not exceed."""
    return limits.where(F.col("share_upto") >= share).agg(F.min("length").alias("length"))
