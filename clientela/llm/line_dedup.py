"""Lines shared by many documents: dropped everywhere but in one document."""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientela.llm.common import BLANKS, Batches, arrow_batch, code_points, raw_texts
from clientela.session import materialise

MIN_LENGTH = 40
MIN_DOCUMENTS = 5


def line_key(line: bytes) -> bytes:
    """Normalised line: ASCII blanks stripped at both ends, A-Z lower-cased."""
    return line.strip(BLANKS).lower()


def line_hash(line: bytes, min_length: int) -> bytes | None:
    """128-bit hash of a line's key; none for keys that are too short to count."""
    key = line_key(line)
    return xxhash.xxh3_128_digest(key) if len(key) >= min_length and code_points(key) >= min_length else None


def line_hashes(docs: DataFrame, key: str, text: str, min_length: int) -> DataFrame:
    """Lines exploded to ``key, hash``, each hash once per row; line texts stay where they are."""

    def explode(batches: Batches):
        for batch in batches:
            parents, hashes = [], []
            for i, data in enumerate(raw_texts(batch.column(1))):
                found = {line_hash(line, min_length) for line in data.split(b"\n") if len(line) >= min_length}
                found.discard(None)
                hashes.extend(found)
                parents.extend([i] * len(found))
            ids = batch.column(0).take(pa.array(parents, pa.int64()))
            yield arrow_batch(["id", "hash"], [ids, pa.array(hashes, pa.binary())])

    kind = T.StructType([T.StructField("id", docs.schema[key].dataType), T.StructField("hash", T.BinaryType())])
    return docs.select(key, text).mapInArrow(explode, kind)


def drop_shared_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """``docs`` with shared lines cut out of ``text``, plus ``n_lines`` (before) and ``n_dropped``.

    A line counts when its key has at least ``min_length`` code points. Keys found in at least ``min_documents``
    different documents lose all their lines but those in the largest ``key`` holding them; the rest keep their order
    and are joined by a line feed. Null or empty text is one empty line and comes back empty. A document is its
    ``key``: repeated rows of one key count once, and the key kept keeps its lines in all its rows. A null key is
    one document, smaller than any other. Input columns named like a result column are replaced.

    Only 16-byte hashes are shuffled to count; one line in a third of all documents is reduced on the map side. The
    texts move once, to meet the hashes their document has to drop.
    """
    holders = materialise(line_hashes(docs, key, text, min_length).distinct(), "line-holders")
    shared = (
        holders.groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("kept"))
        .where(F.col("n") >= min_documents)
        # Dealt anew, so that the join has two plain shuffles and adaptive execution can split a line many hold.
        .repartition(F.xxhash64("hash"))
    )
    drops = (
        holders.join(shared, "hash")
        .where(~F.col("id").eqNullSafe(F.col("kept")))
        .groupBy("id")
        .agg(F.collect_list("hash").alias("_drops"))
    )
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "_drops")]
    rows = docs.select(*columns)
    met = rows.join(drops, rows[key].eqNullSafe(drops["id"]), "left").select(*[rows[c] for c in columns], "_drops")
    place = columns.index(text)

    def cut(batches: Batches):
        for batch in batches:
            kept, before, dropped = [], [], []
            for data, drop in zip(raw_texts(batch.column(place)), batch.column(len(columns)).to_pylist(), strict=True):
                lines = data.split(b"\n")
                stay = lines
                if drop:
                    gone = set(drop)
                    stay = [line for line in lines if line_hash(line, min_length) not in gone]
                kept.append(b"\n".join(stay))
                before.append(len(lines))
                dropped.append(len(lines) - len(stay))
            arrays = [batch.column(i) for i in range(len(columns))]
            arrays[place] = pa.array(kept, pa.binary()).cast(pa.string())
            yield arrow_batch([*columns, "n_lines", "n_dropped"], [*arrays, pa.array(before, pa.int64()), pa.array(dropped, pa.int64())])

    fields = [T.StructField(c, T.StringType() if c == text else docs.schema[c].dataType) for c in columns]
    counts = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    return met.mapInArrow(cut, T.StructType([*fields, *counts]))
