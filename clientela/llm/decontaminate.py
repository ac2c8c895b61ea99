"""Benchmark passages in documents, found by a prefix-filtered set join."""

from __future__ import annotations

from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientela.llm.common import Batches, arrow_batch, raw_texts
from clientela.session import materialise

WINDOW = 10
# Slots of the word filter shipped to the tasks: one bit each, 2 MB whatever the number of words.
FILTER_SLOTS = 1 << 24

# A-Z to a-z, other ASCII outside 0-9 and a-z to a blank, everything else as it is.
WORD_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def words_of(data: bytes) -> list[bytes]:
    return data.translate(WORD_TABLE).split()


def item_windows(items: DataFrame, item: str, text: str, size: int) -> DataFrame:
    """Item-sized windows of every item: ``item, window`` (words joined by one space), distinct."""

    def windows(batches: Batches):
        for batch in batches:
            parents, found = [], []
            for i, data in enumerate(raw_texts(batch.column(1))):
                words = words_of(data)
                if words:
                    own = {b" ".join(words[j : j + size]) for j in range(max(1, len(words) - size + 1))}
                    found.extend(own)
                    parents.extend([i] * len(own))
            ids = batch.column(0).take(pa.array(parents, pa.int64()))
            yield arrow_batch(["item", "window"], [ids, pa.array(found, pa.binary()).cast(pa.string())])

    rows = items.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"), text)
    return rows.mapInArrow(windows, "item string, window string").distinct()


def word_filter(words: DataFrame, column: str) -> bytes:
    """Bitmap with the hash slots of all words set: a filter without misses and of fixed size."""
    slot = F.pmod(F.xxhash64(column), F.lit(FILTER_SLOTS)) + 1
    marks = words.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("bit"))
    # At most FILTER_SLOTS / 32768 = 512 rows of 4 KB.
    found = marks.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    bitmap = bytearray(FILTER_SLOTS // 8)
    for row in found:
        start = (row["bucket"] - 1) * 4096
        bitmap[start : start + len(row["bits"])] = row["bits"]
    return bytes(bitmap)


class WordFilter:
    """Membership by bitmap."""

    def __init__(self, bitmap: bytes):
        self.bits = np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little").view(bool)

    def among(self, words: list[bytes]) -> set[bytes]:
        """The different words that may be in the set."""
        different = list(set(words))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, different, repeat(42)), np.uint64, len(different))
        return {different[i] for i in np.nonzero(self.bits[hashes % np.uint64(FILTER_SLOTS)])[0].tolist()}

    def passes(self, words: list[bytes]) -> list[int]:
        """Positions of the words that may be in the set."""
        found = self.among(words)
        return [i for i, word in enumerate(words) if word in found] if found else []


def corpus_counts(docs: DataFrame, text: str, vocabulary: DataFrame) -> DataFrame:
    """``word, n``: how often each word of ``vocabulary`` occurs in all documents."""
    shipped = docs.sparkSession.sparkContext.broadcast(word_filter(vocabulary, "word"))

    def count(batches: Batches):
        keep = WordFilter(shipped.value)
        for batch in batches:
            counts: Counter[bytes] = Counter()
            for data in raw_texts(batch.column(0)):
                words = words_of(data)
                own = Counter(words)
                for word in keep.among(words):
                    counts[word] += own[word]
            words_out = pa.array(list(counts), pa.binary()).cast(pa.string())
            yield arrow_batch(["word", "n"], [words_out, pa.array(list(counts.values()), pa.int64())])

    partial = docs.select(text).mapInArrow(count, "word string, n long")
    counted = partial.groupBy("word").agg(F.sum("n").alias("n"))
    return vocabulary.join(counted, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))


def prefixes(windows: DataFrame, rarity: DataFrame) -> DataFrame:
    """The necessary prefix of each distinct window: its rarest word, with where it stands.

    Words are ordered by corpus count, then by the word. All words of a window must occur, so a prefix of one word
    is enough: ``token, offset, size, window``.
    """
    words = F.split("window", " ")
    placed = windows.select("window").distinct().select("window", F.size(words).alias("size"), F.posexplode(words).alias("offset", "word"))
    ranked = placed.join(rarity, "word").groupBy("window", "size").agg(F.min(F.struct("n", "word", "offset")).alias("first"))
    return ranked.select(F.col("first.word").alias("token"), F.col("first.offset").alias("offset"), "size", "window")


def candidate_positions(docs: DataFrame, key: str, text: str, tokens: DataFrame, size: int) -> DataFrame:
    """Per row its word count and the positions of prefix tokens, each with the words around it.

    Written to the shared folder with a row number, so the whole texts are read once.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(word_filter(tokens, "token"))
    near = size - 1

    def scan(batches: Batches):
        keep = WordFilter(shipped.value)
        for batch in batches:
            counts, spots = [], []
            for data in raw_texts(batch.column(1)):
                words = words_of(data)
                counts.append(len(words))
                spots.append(
                    [
                        {"at": i, "left": min(i, near), "token": words[i].decode("utf-8", "replace"),
                         "around": b" ".join(words[max(0, i - near) : i + near + 1]).decode("utf-8", "replace")}
                        for i in keep.passes(words)
                    ]
                )
            kind = pa.list_(pa.struct([("at", pa.int64()), ("left", pa.int32()), ("token", pa.string()), ("around", pa.string())]))
            yield arrow_batch(["id", "n_words", "spots"], [batch.column(0), pa.array(counts, pa.int64()), pa.array(spots, kind)])

    spot = T.StructType().add("at", "long").add("left", "integer").add("token", "string").add("around", "string")
    kind = T.StructType([T.StructField("id", docs.schema[key].dataType), T.StructField("n_words", T.LongType()), T.StructField("spots", T.ArrayType(spot))])
    scanned = docs.select(key, text).mapInArrow(scan, kind)
    return materialise(scanned.withColumn("row", F.monotonically_increasing_id()), "scanned")


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
) -> DataFrame:
    """One row per input row: ``key, n_words, n_hit, spans, items, contaminated``.

    A window is ``size`` consecutive words of an item; an item with fewer words, but not none, is one window. A
    document word inside any occurrence of a window is hit. ``spans`` are the occurrences as word ranges (end
    exclusive, ordered), ``items`` the ids, as strings in order, of all items with an occurring window. Null and
    empty texts have no words and no windows; repeated rows each get their row; a null item id is the item "null".
    Other columns are ignored.

    Steps: words of the windows are ordered by their count over all documents; the rarest of each window is its
    necessary prefix token; documents give their positions of such tokens (a filter of fixed size passes them);
    positions meet windows on the token; window length and token offset must fit; the words decide.
    """
    # Written once: item windows are the small side, and three later steps read them.
    windows = materialise(item_windows(items, item, item_text, size), "windows")
    vocabulary = windows.select(F.explode(F.split("window", " ")).alias("word")).distinct()
    index = materialise(prefixes(windows, corpus_counts(docs, text, vocabulary)), "prefixes")
    scanned = candidate_positions(docs, key, text, index, size)
    spots = scanned.select("row", F.inline("spots"))
    around = F.split("around", " ")
    begin = F.col("left") - F.col("offset")
    hits = (
        spots.join(index, "token")
        .where((begin >= 0) & (begin + F.col("size") <= F.size(around)))
        .where(F.array_join(F.slice(around, begin + 1, F.col("size")), " ") == F.col("window"))
        .select("row", (F.col("at") - F.col("offset")).alias("start"), (F.col("at") - F.col("offset") + F.col("size")).alias("end"), "window")
    )
    hits = materialise(hits, "hits")
    spans = hits.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))
    found = hits.select("row", "window").distinct().join(windows, "window").groupBy("row")
    found = found.agg(F.array_sort(F.collect_set("item")).alias("items"))
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total"))
    covered = F.aggregate(
        "spans",
        zero,
        lambda acc, x: F.struct(
            F.greatest(acc["end"], x["end"]).alias("end"),
            (acc["total"] + F.greatest(F.lit(0).cast("long"), x["end"] - F.greatest(x["start"], acc["end"]))).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    return (
        scanned.select("row", "id", "n_words")
        .join(spans, "row", "left")
        .join(found, "row", "left")
        .select(
            F.col("id").alias(key),
            "n_words",
            F.when(F.col("spans").isNull(), F.lit(0)).otherwise(covered).cast("long").alias("n_hit"),
            F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.col("spans").isNotNull().alias("contaminated"),
        )
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """``docs`` without every document (all rows of its key) that has a contaminated row."""
    bad = find_contamination(docs, items, key, **options).where("contaminated").select(F.col(key).alias("_bad")).distinct()
    return docs.join(bad, docs[key].eqNullSafe(bad["_bad"]), "left_anti")
