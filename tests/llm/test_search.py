"""BM25 top-k against brute force over all documents."""

import math
import re
from collections import Counter

import numpy as np
from rows import DOCS, docs_table, prose

from clientela.llm import search


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, queries, k):
    bags = [Counter(words(t)) for _, t in docs]
    sizes = [sum(b.values()) for b in bags]
    mean = sum(sizes) / len(docs)
    frequency = Counter(w for b in bags for w in b)
    out = {}
    for q, text in queries:
        if q is None:
            continue
        found = set()
        for (key, _), bag, size in zip(docs, bags, sizes, strict=True):
            score = 0.0
            for w, n in Counter(words(text)).items():
                if w in bag:
                    idf = math.log(1 + (len(docs) - frequency[w] + 0.5) / (frequency[w] + 0.5))
                    score += n * idf * bag[w] * 2.2 / (bag[w] + 1.2 * (0.25 + 0.75 * size / mean))
            if score > 0 and key is not None:
                found.add((round(score, 6), key))
        out[q] = sorted(found, key=lambda r: (-r[0], r[1]))[:k]
    return out


def compare(got, want):
    ranked = {}
    for r in sorted(got, key=lambda r: (r["query"], r["rank"])):
        ranked.setdefault(r["query"], []).append((r["score"], r["id"]))
    assert set(ranked) == {q for q, rows in want.items() if rows}
    for q, rows in ranked.items():
        assert np.allclose([s for s, _ in rows], [s for s, _ in want[q]], atol=2e-6)
        assert [i for _, i in rows] == [i for _, i in want[q]]


ROWS = [r for r in DOCS if r[0] not in (12, 13)] + [(13, prose(13, 900))] + [(100 + i, prose(i, 20 + 7 * (i % 11))) for i in range(150)]
COPIES = [(300 + i, "the same words again and again") for i in range(40)]


def test_top_k_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD_DOCUMENTS", 50)
    monkeypatch.setattr(search, "SEED_EVERY", 4)
    rows = ROWS + COPIES
    queries = [r for r in rows if r[0] is None or r[0] % 5 == 0]
    docs = docs_table(spark, rows).repartition(3)
    got = search.top_k(docs, docs_table(spark, queries), k=5).collect()
    compare(got, brute(rows, queries, 5))


def test_blocks_of_queries_change_nothing(spark, monkeypatch):
    queries = ROWS[::9]
    monkeypatch.setattr(search, "TERMS_AT_ONCE", 100)
    got = search.top_k(docs_table(spark, ROWS), docs_table(spark, queries), k=3).collect()
    compare(got, brute(ROWS, queries, 3))


def test_copies_tie_by_id(spark):
    got = search.top_k(docs_table(spark, COPIES), docs_table(spark, COPIES[:2]), k=4).orderBy("query", "rank").collect()
    assert [r["id"] for r in got] == [300, 301, 302, 303] * 2


def test_repeated_rows_take_one_place(spark, monkeypatch):
    """One row stands more often than k in one task, in every shard and among the seeds, and as a query."""
    monkeypatch.setattr(search, "SEED_EVERY", 1)
    hot = (7, "the same words again and again")
    rows = [hot] * 60 + [(20 + i, "same words " + prose(i, 4 + i)) for i in range(12)] + [hot] * 60
    docs = docs_table(spark, rows).coalesce(1)
    for size in (50, 8192):
        monkeypatch.setattr(search, "SHARD_DOCUMENTS", size)
        got = search.top_k(docs, docs_table(spark, [hot] * 30 + [rows[65]]), k=5).collect()
        assert len(got) == 10
        compare(got, brute(rows, [hot, rows[65]], 5))


def test_repeated_query_rows_are_one_query(spark):
    blocks = list(search.query_blocks(docs_table(spark, [(7, "same words")] * 30 + [(7, "other words")]), "doc_id", "text"))
    assert [len(b.ids) for b in blocks] == [2]


def test_nothing_to_find(spark):
    empty = docs_table(spark, [])
    assert search.top_k(empty, empty).count() == 0
    assert search.top_k(docs_table(spark), empty).count() == 0
    assert search.top_k(empty, docs_table(spark, DOCS[:2])).count() == 0
    assert search.top_k(docs_table(spark), docs_table(spark, [(1, None), (2, "zzzz unseen")])).count() == 0


def test_blocks_below_the_bound_are_skipped():
    """A block whose weighted maxima stay below the bound is never scored."""
    idf = np.ones(6)
    terms = [np.array([0, 1])] * 64 + [np.array([4, 5])] * 64
    impacts = [np.array([1.0, 1.0])] * 64 + [np.array([0.1, 0.1])] * 64
    shard = search.Shard(np.arange(128), terms, impacts, idf)
    queries = search.Queries(np.array([1]), np.arange(6), np.array([0, 4]), np.array([0, 1, 4, 5], np.int32), np.ones(4, np.int32))
    scored, exact = [], shard.exact
    shard.exact = lambda docs, weights: scored.extend(docs.tolist()) or exact(docs, weights)
    top = search.Top(1.5)
    search.search_shard(shard, queries, np.ones(4), [top], 3)
    assert [r for _, r in top.rows] == [0, 1, 2]
    assert {int(shard.ids[d]) for d in scored} <= set(range(64))


def test_texts_are_read_once_for_all_blocks(spark, monkeypatch):
    """However many blocks of queries there are; and blocks are as full as they may be."""
    monkeypatch.setattr(search, "TERMS_AT_ONCE", 400)
    read = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    table = docs_table(spark, ROWS, clash=False)
    docs = table.mapInArrow(passing, table.schema)
    queries = ROWS[::9]
    got = search.top_k(docs, docs_table(spark, queries), k=3).collect()
    assert read.value == len(ROWS)
    compare(got, brute(ROWS, queries, 3))
    sizes = [len(b.terms) for b in search.query_blocks(docs_table(spark, ROWS), "doc_id", "text")]
    assert len(sizes) > 2 and max(sizes) <= 400
    assert all(a + b > 300 for a, b in zip(sizes, sizes[1:], strict=False))


def test_shards_of_several_kinds_of_documents_are_exact():
    """Kinds with few words in common, dense and sparse terms, repeated ids: all scores against plain sums."""
    rng = np.random.default_rng(7)
    kinds, terms, n = 3, 400, 700
    idf = rng.uniform(0.5, 6, kinds * terms)
    doc_terms, impacts = [], []
    for i in range(n):
        chance = 0.6 / (1 + np.arange(terms) / 8)
        own = np.nonzero(rng.random(terms) < chance)[0] + terms * (i % kinds)
        own = np.unique(np.append(own, rng.integers(0, kinds * terms))) if i % 50 else own[:0]
        doc_terms.append(own.astype(np.int32))
        impacts.append(idf[own] * rng.uniform(0.3, 2.1, len(own)))
    ids = np.arange(n) // 2 * 3
    shard = search.Shard(ids, doc_terms, impacts, idf)
    assert sorted(shard.ids.tolist()) == sorted(ids.tolist())
    picked = [doc_terms[i] for i in range(1, n, 9)]
    counts = [rng.integers(1, 4, len(t)).astype(np.int32) for t in picked]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in picked])])
    queries = search.Queries(np.arange(len(picked)), np.arange(len(idf)), offsets, np.concatenate(picked), np.concatenate(counts))
    for bound in (0.0, 60.0):
        tops = [search.Top(bound) for _ in picked]
        search.search_shard(shard, queries, queries.counts.astype(float), tops, 4)
        for t, c, top in zip(picked, counts, tops, strict=True):
            weight = np.zeros(len(idf))
            weight[t] = c
            scores = {(round(float(weight[d] @ v), 6), int(i)) for i, d, v in zip(ids, doc_terms, impacts, strict=True)}
            want = sorted((r for r in scores if r[0] > 0 and r[0] >= bound), key=lambda r: (-r[0], r[1]))
            got = [r for r in top.rows if r[0] >= bound]
            assert np.allclose([s for s, _ in got], [s for s, _ in want[:4]], atol=2e-6)
