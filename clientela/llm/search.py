"""Exact BM25 top-k over an inverted index with block maxima."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clientela.llm.common import Batches, arrow_batch, raw_texts
from clientela.llm.decontaminate import words_of
from clientela.session import materialise

K = 10
K1, B = 1.2, 0.75
# Documents of one shard, the unit that is indexed and searched in memory, and of one block within it.
SHARD_DOCUMENTS = 8192
BLOCK_DOCUMENTS = 64
# Lists that hold more than this share of a shard's documents are stored as whole rows of impacts.
DENSE_SHARE = 1 / 24
# Query terms of one pass: a pass broadcasts that many (16 bytes each) and searches all shards with them.
TERMS_AT_ONCE = 4_000_000
QUERIES_AT_ONCE = 128
# Queries of a pass whose bounds are known before they are put in groups that keep the same blocks alive.
QUERIES_SORTED = 2048
# Terms by which documents of a shard are put in order.
COMMON_TERMS = 256
# Maxima of sparse lists are kept for so many blocks together; their postings stand in rows of so many.
LIST_BLOCKS = 8
POSTINGS_ROW = 16
# Hashes of which a task counts the documents at once.
HASHES_AT_ONCE = 1 << 20
# Seeds: one document in so many is searched first, and its k-th best score bounds every other shard from the start.
# About k times this many documents of the whole table reach that score, so a query's rows do not grow with the shards.
SEED_EVERY = 8
# Allowed error of the 32-bit block scores; whoever may be in the top k is scored again in 64 bits.
TOLERANCE = 1e-4
DIGITS = 6


def term_counts(data: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes of the different words of a text, their counts, and the number of words."""
    words = words_of(data)
    counts = Counter(words)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in counts), np.uint64, len(counts))
    return hashes, np.fromiter(counts.values(), np.int32, len(counts)), len(words)


@dataclass
class Queries:
    """A block of queries as sorted distinct terms and, query by query, term places and counts."""

    ids: np.ndarray
    vocabulary: np.ndarray
    offsets: np.ndarray
    terms: np.ndarray
    counts: np.ndarray


def query_blocks(queries: DataFrame, key: str, text: str):
    """All query rows in blocks of a bounded number of terms, as they pass through the driver one at a time."""

    def scan(batches: Batches):
        for batch in batches:
            found = [term_counts(t) for t in raw_texts(batch.column(1))]
            yield arrow_batch(
                ["id", "terms", "counts", "size"],
                [
                    batch.column(0),
                    pa.array([h.tobytes() for h, _, _ in found], pa.binary()),
                    pa.array([c.tobytes() for _, c, _ in found], pa.binary()),
                    pa.array([len(h) for h, _, _ in found], pa.int64()),
                ],
            )

    # A repeated row is one query.
    rows = queries.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), text).distinct()
    stored = rows.mapInArrow(scan, "id long, terms binary, counts binary, size long")
    # Queries in the order of a hash: the running count of terms cuts blocks; a block is a range of that order.
    stored = materialise(stored.withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(1 << 20))), "query-terms")
    total = stored.agg(F.sum("size")).first()[0]
    if total is None:
        return
    # Every pass reads and indexes all documents again, so blocks are as full as they may be: cut by ranges that hold a
    # small part of a block each.
    ranges = max(1 << 10, min(1 << 20, 64 * total // TERMS_AT_ONCE))
    sizes = stored.groupBy(F.floor(F.col("slot") * ranges / (1 << 20)).alias("range")).agg(F.sum("size").alias("n"))
    cuts, held = [0], 0
    for at, size in sorted(sizes.collect()):
        if held and held + size > TERMS_AT_ONCE:
            cuts.append(at)
            held = 0
        held += size
    place = F.floor(F.col("slot") * ranges / (1 << 20))
    for low, high in zip(cuts, [*cuts[1:], ranges], strict=True):
        part = stored.where((place >= low) & (place < high)).orderBy("id", "terms")
        table = part.select("id", "terms", "counts").toArrow()
        if not len(table):
            continue
        hashes = [np.frombuffer(t, np.uint64) for t in table.column("terms").to_pylist()]
        counts = [np.frombuffer(c, np.int32) for c in table.column("counts").to_pylist()]
        # Queries with the same leading word are searched together: they skip the same blocks.
        lead = [int(h[np.argmax(c)]) if len(h) else 0 for h, c in zip(hashes, counts, strict=True)]
        order = sorted(range(len(lead)), key=lead.__getitem__)
        hashes, counts = [hashes[i] for i in order], [counts[i] for i in order]
        joined = np.concatenate(hashes)
        vocabulary, places = np.unique(joined, return_inverse=True)
        offsets = np.concatenate([[0], np.cumsum([len(h) for h in hashes])])
        yield Queries(table.column("id").to_numpy()[order], vocabulary, offsets, places.astype(np.int32), np.concatenate(counts))


def word_lists(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id, size, terms, counts``: the words of every document, written once for all passes.

    Different words as sorted hashes of 8 bytes with their counts, of 1 byte each where they fit, and the number of words.
    """

    def scan(batches: Batches):
        for batch in batches:
            terms, counts, sizes = [], [], []
            for data in raw_texts(batch.column(1)):
                hashes, found, size = term_counts(data)
                order = np.argsort(hashes)
                found = found[order]
                terms.append(hashes[order].tobytes())
                counts.append((found.astype(np.uint8) if len(found) and found.max() < 256 else found).tobytes())
                sizes.append(size)
            arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())]
            yield arrow_batch(["id", "size", "terms", "counts"], arrays)

    rows = docs.select(F.col(key).cast("long").alias("id"), text)
    return materialise(rows.mapInArrow(scan, "id long, size long, terms binary, counts binary"), "word-lists")


def known_words(sizes: list[int], terms: list[bytes], counts: list[bytes], known: np.ndarray, idf: np.ndarray, mean: float):
    """Places in ``known`` and impacts of the words that some documents of :func:`word_lists` share with the queries."""
    number = np.array([len(t) // 8 for t in terms])
    # Counts of 1 or of 4 bytes.
    tf = np.concatenate([np.frombuffer(c, np.uint8 if len(c) * 8 == len(t) else np.int32).astype(np.int32) for c, t in zip(counts, terms, strict=True)])
    hashes = np.frombuffer(b"".join(terms), np.uint64)
    place = np.minimum(np.searchsorted(known, hashes), len(known) - 1).astype(np.int32)
    have = np.nonzero(known[place] == hashes)[0]
    del hashes
    place, impact = place[have], tf[have].astype(np.float64)
    doc = np.repeat(np.arange(len(number), dtype=np.int32), number)[have]
    del have, tf
    cuts = np.cumsum(np.bincount(doc, minlength=len(number)))[:-1]
    least = K1 * (1 - B + B * np.array(sizes) / mean)
    below = impact + least[doc]
    impact *= idf[place] * (K1 + 1)
    impact /= below
    return np.split(place, cuts), np.split(impact, cuts)


def document_counts(lists: DataFrame) -> DataFrame:
    """``term, n``: the number of documents of every word, counted once for all passes; the hash as a signed number."""

    def count(batches: Batches):
        held, size = [], 0

        def counted():
            different, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            for start in range(0, len(different), 1 << 18):
                part = slice(start, start + (1 << 18))
                yield arrow_batch(["term", "n"], [pa.array(different[part].view(np.int64)), pa.array(n[part], pa.int64())])

        for batch in batches:
            held += [np.frombuffer(t, np.uint64) for t in batch.column(0).to_pylist()]
            size += sum(map(len, held[-batch.num_rows :])) if batch.num_rows else 0
            if size >= HASHES_AT_ONCE:
                yield from counted()
                size = 0
        if held:
            yield from counted()

    counted = lists.select("terms").mapInArrow(count, "term long, n long")
    return materialise(counted.groupBy("term").agg(F.sum("n").alias("n")), "document-counts")


def frequencies(counted: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Document counts of the vocabulary of a block."""
    shipped = counted.sparkSession.sparkContext.broadcast(vocabulary)

    def find(batches: Batches):
        known = shipped.value
        for batch in batches:
            terms, n = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
            have = known[at] == terms
            yield arrow_batch(["place", "n"], [pa.array(at[have], pa.int64()), pa.array(n[have], pa.int64())])

    out = np.zeros(len(vocabulary), np.int64)
    if len(vocabulary):
        # One row for each term of the block at most.
        found = counted.select("term", "n").mapInArrow(find, "place long, n long").toArrow()
        out[found.column("place").to_numpy()] = found.column("n").to_numpy()
    return out


def alike_order(dense: np.ndarray, first: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """An order in which documents of similar common words stand together.

    Leading terms that many documents share give centroids, every document goes to the nearest one, and the centroids
    follow one another by likeness.
    """
    leads, own, counts = np.unique(first, return_inverse=True, return_counts=True)
    frequent = np.nonzero(counts >= BLOCK_DOCUMENTS)[0]
    if len(frequent) < 2 or not len(dense):
        return np.lexsort((ids, first))
    unit = dense / np.maximum(np.linalg.norm(dense, axis=0), 1e-9)
    centroids = np.stack([unit[:, own == lead].mean(axis=1) for lead in frequent])
    centroids /= np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-9)
    nearest = (centroids @ unit).argmax(axis=0)
    likeness = centroids @ centroids.T
    chain = [int(counts[frequent].argmax())]
    while len(chain) < len(frequent):
        # Like the last ones most, so one kind of centroids is used up before the next begins.
        near = likeness[chain].max(axis=0)
        near[chain] = -1
        chain.append(int(near.argmax()))
    place = np.empty(len(chain), np.int64)
    place[chain] = np.arange(len(chain))
    return np.lexsort((ids, first, place[nearest]))


def stable_order(numbers: np.ndarray) -> np.ndarray:
    """Stable order of numbers from 0 to 2^32: two passes of the counting sort that numpy has for 16 bits."""
    order = np.argsort((numbers & 0xFFFF).astype(np.uint16), kind="stable")
    return order[np.argsort((numbers[order] >> 16).astype(np.uint16), kind="stable")]


class Shard:
    """Inverted index of a few thousand documents: impacts by term, block maxima by term."""

    def __init__(self, ids: np.ndarray, doc_terms: list[np.ndarray], impacts: list[np.ndarray], idf: np.ndarray):
        """Documents alike in their common words stand together, so blocks are alike inside and unlike outside."""
        size = len(ids)
        self.blocks = -(-size // BLOCK_DOCUMENTS)
        counts = np.array([len(t) for t in doc_terms])
        terms, values = np.concatenate(doc_terms), np.concatenate(impacts).astype(np.float32)
        lengths = np.bincount(terms, minlength=len(idf))
        own = np.nonzero(lengths)[0]
        wide = lengths[own] > size * DENSE_SHARE
        # Where each term of the vocabulary is kept: its dense row, its sparse list, or -1.
        self.row_of = np.full(len(idf), -1, np.int32)
        self.row_of[own[wide]] = np.arange(wide.sum())
        self.list_of = np.full(len(idf), -1, np.int32)
        self.list_of[own[~wide]] = np.arange((~wide).sum())
        docs = np.repeat(np.arange(size, dtype=np.int32), counts)
        # The most common words tell which documents are alike.
        common = np.full(len(idf), -1, np.int32)
        chosen = own[wide][np.argsort(-lengths[own[wide]], kind="stable")[:COMMON_TERMS]]
        common[chosen] = np.arange(len(chosen))
        rows = common[terms]
        inside = np.nonzero(rows >= 0)[0]
        few = np.zeros((len(chosen), size), np.float32)
        few[rows[inside], docs[inside]] = values[inside]
        first = np.array([int(t[np.argmax(i / idf[t])]) if len(t) else -1 for t, i in zip(doc_terms, impacts, strict=True)])
        order = alike_order(few, first, ids)
        del few, rows, inside, docs, values, terms
        self.ids = ids[order]
        # Place of every document among the different ids, if any id is repeated.
        different, places = np.unique(self.ids, return_inverse=True)
        self.different, self.places = len(different), places if len(different) < len(ids) else None
        # Document by document, for exact scores.
        self.doc_terms = np.concatenate([doc_terms[i] for i in order]).astype(np.intp, copy=False)
        self.doc_impacts = np.concatenate([impacts[i] for i in order])
        self.doc_starts = np.concatenate([[0], np.cumsum(counts[order])])
        terms, values = self.doc_terms, self.doc_impacts.astype(np.float32)
        docs = np.repeat(np.arange(size, dtype=np.int32), counts[order])
        rows = self.row_of[terms]
        inside = np.nonzero(rows >= 0)[0]
        self.dense = np.zeros((int(wide.sum()), self.blocks, BLOCK_DOCUMENTS), np.float32)
        self.dense.ravel()[rows[inside] * np.int64(self.blocks * BLOCK_DOCUMENTS) + docs[inside]] = values[inside]
        self.dense_max = self.dense.max(axis=2)
        # The other lists: postings in rows of one length, filled up with impacts of 0, and their maxima by some blocks.
        lists = self.list_of[terms]
        outside = np.nonzero(lists >= 0)[0]
        by_list = outside[stable_order(lists[outside])]
        lists, docs, values = lists[by_list], docs[by_list], values[by_list]
        del rows, inside, outside, by_list
        thin = lengths[own[~wide]]
        self.list_rows = -(-thin // POSTINGS_ROW)
        self.list_starts = np.concatenate([[0], np.cumsum(self.list_rows)])
        at = np.arange(len(lists)) - np.repeat(np.cumsum(thin) - thin - self.list_starts[:-1] * POSTINGS_ROW, thin)
        self.docs = np.zeros((self.list_starts[-1], POSTINGS_ROW), np.uint16 if size <= 1 << 16 else np.int64)
        self.values = np.zeros(self.docs.shape, np.float32)
        self.docs.ravel()[at], self.values.ravel()[at] = docs, values
        # Documents ascend within a list, so equal keys stand together.
        groups = -(-self.blocks // LIST_BLOCKS)
        key = lists.astype(np.int64) * groups + docs // (BLOCK_DOCUMENTS * LIST_BLOCKS)
        head = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0] if len(key) else np.zeros(0, np.int64)
        self.list_max = np.zeros((len(thin), groups), np.float32)
        if len(key):
            self.list_max.ravel()[key[head]] = np.maximum.reduceat(values, head)

    def add_lists(self, lists: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Sum of the weighted postings of sparse lists by document."""
        counts = self.list_rows[lists]
        ends = np.cumsum(counts)
        rows = np.arange(ends[-1]) + np.repeat(self.list_starts[lists] - ends + counts, counts)
        values = self.values.take(rows, axis=0)
        values *= np.repeat(weights, counts)[:, None]
        return np.bincount(self.docs.take(rows, axis=0).ravel(), values.ravel(), minlength=self.blocks * BLOCK_DOCUMENTS)

    def exact(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """64-bit scores, each added up in the order of the document's terms."""
        counts = self.doc_starts[docs + 1] - self.doc_starts[docs]
        starts = np.cumsum(counts) - counts
        inside = np.arange(counts.sum()) + np.repeat(self.doc_starts[docs] - starts, counts)
        return np.add.reduceat(weights[self.doc_terms[inside]] * self.doc_impacts[inside], starts)

    def kth_best(self, docs: np.ndarray, scores: np.ndarray, k: int) -> float:
        """The k-th best of positive scores, the best one of each id; 0 if there are fewer ids."""
        if self.places is not None:
            best = np.zeros(self.different, scores.dtype)
            np.maximum.at(best, self.places[docs], scores)
            scores = best[best > 0]
        return np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else 0.0


class Top:
    """The k best of a query so far: higher score first, then smaller id; repeated ones count once."""

    def __init__(self, bound: float):
        self.bound, self.rows = bound, []

    def offer(self, rows: list[tuple[float, int]], k: int) -> None:
        self.rows = sorted({*self.rows, *rows}, key=lambda r: (-r[0], r[1]))[:k]
        if len(self.rows) == k:
            self.bound = max(self.bound, self.rows[-1][0])


def search_shard(shard: Shard, queries: Queries, weights: np.ndarray, tops: list[Top], k: int) -> None:
    """Block-max pruning for a few queries at a time.

    The weighted block maxima of a query's lists bound every document of a block. Blocks below the score that the
    query's k-th best has reached are skipped; the others are scored, and the bound rises from shard to shard. Queries
    that keep the same blocks alive are scored together, with the dense rows that any of them has.
    """
    full = np.zeros(len(queries.vocabulary))
    all_rows, all_lists = shard.row_of[queries.terms], shard.list_of[queries.terms]
    for begin in range(0, len(tops), QUERIES_SORTED):
        part = range(begin, min(len(tops), begin + QUERIES_SORTED))
        dense = np.zeros((len(part), len(shard.dense)), np.float32)
        bounds = np.zeros((len(part), shard.list_max.shape[1]), np.float32)
        sparse = []
        for row, q in enumerate(part):
            span = slice(queries.offsets[q], queries.offsets[q + 1])
            rows, lists, weight = all_rows[span], all_lists[span], weights[span].astype(np.float32)
            kept = rows >= 0
            dense[row, rows[kept]] = weight[kept]
            kept = lists >= 0
            sparse.append((lists[kept], weight[kept]))
            if len(sparse[row][0]):
                bounds[row] = sparse[row][1] @ shard.list_max[sparse[row][0]]
        bounds = np.repeat(bounds, LIST_BLOCKS, axis=1)[:, : shard.blocks] + dense @ shard.dense_max
        reached = np.array([tops[q].bound for q in part])
        floor = (reached * (1 - TOLERANCE) - TOLERANCE).astype(np.float32)
        # 32-bit sums of all lists: what they may lack is added.
        alive = (bounds * np.float32(1 + TOLERANCE) >= floor[:, None]) & (bounds > 0)
        used = alive.sum(axis=1)
        middle = alive @ np.arange(shard.blocks) / np.maximum(used, 1)
        order = np.argsort(middle, kind="stable")
        order = order[used[order] > 0]
        for start in range(0, len(order), QUERIES_AT_ONCE):
            rows = order[start : start + QUERIES_AT_ONCE]
            blocks = np.nonzero(alive[rows].any(axis=0))[0]
            own = dense[rows]
            kinds = np.nonzero(own.any(axis=0))[0]
            columns = (blocks[:, None] * BLOCK_DOCUMENTS + np.arange(BLOCK_DOCUMENTS)).ravel()
            scores = own[:, kinds] @ shard.dense[np.ix_(kinds, blocks)].reshape(len(kinds), len(columns))
            whole = len(blocks) == shard.blocks
            for line, row in enumerate(rows.tolist()):
                score, (lists, weight) = scores[line], sparse[row]
                if len(lists):
                    added = shard.add_lists(lists, weight)
                    score += added if whole else added[columns]
                least = floor[row]
                if score.max() < least:
                    continue
                hits = np.nonzero((score >= least) & (score > 0))[0]
                if len(hits) > k:
                    kth = shard.kth_best(columns[hits], score[hits], k)
                    least = max(least, kth * (1 - 2 * TOLERANCE) - TOLERANCE)
                    hits = hits[score[hits] >= least]
                if not len(hits):
                    continue
                q = part[row]
                span = slice(queries.offsets[q], queries.offsets[q + 1])
                full[queries.terms[span]] = weights[span]
                docs = columns[hits]
                docs = docs[docs < len(shard.ids)]
                exact = np.round(shard.exact(docs, full), DIGITS)
                tops[q].offer(list(zip(exact.tolist(), shard.ids[docs].tolist(), strict=True)), k)
                full[queries.terms[span]] = 0


def search_pass(lists: DataFrame, queries: Queries, totals, bounds: np.ndarray, k: int) -> DataFrame:
    """``query, id, score``: the k best of every query in each task's documents, of :func:`word_lists`."""
    spark = lists.sparkSession
    n, mean, frequency = totals
    idf = np.log1p((n - frequency + 0.5) / (frequency + 0.5))
    shipped = spark.sparkContext.broadcast((queries, idf, bounds, mean))

    def search(batches: Batches):
        queries, idf, bounds, mean = shipped.value
        tops = [Top(b) for b in bounds]
        weights = queries.counts.astype(np.float64)
        known = queries.vocabulary
        ids, terms, impacts = [], [], []

        def finish():
            held = [column[:SHARD_DOCUMENTS] for column in (ids, terms, impacts)]
            for column in (ids, terms, impacts):
                del column[:SHARD_DOCUMENTS]
            search_shard(Shard(np.array(held[0]), held[1], held[2], idf), queries, weights, tops, k)

        for batch in batches:
            if not len(known) or not batch.num_rows:
                continue
            own = known_words(*(c.to_pylist() for c in batch.columns[1:]), known, idf, mean)
            ids += batch.column(0).to_pylist()
            terms += own[0]
            impacts += own[1]
            while len(ids) >= SHARD_DOCUMENTS:
                finish()
        if ids:
            finish()
        found = [(int(q), d, s) for q, top in zip(queries.ids, tops, strict=True) for s, d in top.rows]
        for start in range(0, len(found), 1 << 16):
            q, d, s = zip(*found[start : start + (1 << 16)], strict=True)
            yield arrow_batch(["query", "id", "score"], [pa.array(q, pa.int64()), pa.array(d, pa.int64()), pa.array(s, pa.float64())])

    rows = lists.where("id IS NOT NULL").select("id", "size", "terms", "counts")
    return rows.mapInArrow(search, "query long, id long, score double")


def merged(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    return found.distinct().withColumn("rank", place).where(F.col("rank") <= k)


def top_k(docs: DataFrame, queries: DataFrame, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """``query, id, score, rank``: the k documents with the best BM25 score of every query, exactly.

    Words as in :mod:`decontaminate`; a query's repeated words count as often as they stand; scores use document counts
    and mean length over all documents, are rounded to 6 digits, and ties go to the smaller id. Documents that share no
    word with the query are not returned, so empty and null texts neither find nor are found. Rows with a null key are
    counted in the statistics but never returned; repeated rows are one document in the result and count in the
    statistics as often as they stand. Other columns are ignored.

    Texts are read once: the words of every document and the document counts of every word are written, and all passes
    read these. Queries go in blocks of a bounded number of terms, each against all documents. A task indexes its
    documents shard by shard in memory and keeps k rows for a query; the tasks' rows are merged, which is exact because
    all use the same global statistics.
    """
    out = None
    for block in query_blocks(queries, key, text):
        if out is None:
            lists = word_lists(docs, key, text)
            counted = document_counts(lists)
            n, words = lists.agg(F.count(F.lit(1)), F.sum("size")).first()
            mean = (words or 0) / max(1, n)
        totals = (n, mean, frequencies(counted, block.vocabulary))
        none = np.zeros(len(block.ids))
        seeds = lists.where(F.pmod(F.xxhash64("id"), F.lit(SEED_EVERY)) == 0)
        # Whole shards: every task searches with all queries, so small parts would cost most.
        seeds = seeds.repartition(max(1, totals[0] // (SEED_EVERY * SHARD_DOCUMENTS)))
        first = merged(search_pass(seeds, block, totals, none, k), k)
        # The k-th best among the seeds: one row for a query of the block.
        reached = first.where(F.col("rank") == k).select("query", "score").toArrow()
        kth = dict(zip(reached.column("query").to_pylist(), reached.column("score").to_pylist(), strict=True))
        bounds = np.array([kth.get(int(q), 0.0) for q in block.ids])
        found = merged(search_pass(lists, block, totals, bounds, k), k)
        found = materialise(found, "found")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = docs.sparkSession.createDataFrame([], "query long, id long, score double, rank int")
    return out.select("query", "id", "score", "rank")
