"""Shards against a plain heap over all groups."""

import heapq
import random
import zlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from rows import DOCS, docs_table

from clientela.llm import sharding


def plain_heap(sizes, shards):
    """One heap step for every group, largest first: how many groups of a size each shard gets."""
    heap, given = [(0, s) for s in range(shards)], defaultdict(lambda: [0] * shards)
    for size in sorted(sizes, reverse=True):
        load, shard = heapq.heappop(heap)
        given[size][shard] += 1
        heapq.heappush(heap, (load + size, shard))
    return given, dict((s, load) for load, s in heap)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 17), st.dictionaries(st.integers(1, 400), st.integers(1, 900), min_size=1, max_size=7))
def test_bulk_steps_equal_single_steps(shards, counts):
    want, _ = plain_heap([s for s, n in counts.items() for _ in range(n)], shards)
    heap = sharding.Schedule(shards)
    for size in sorted(counts, reverse=True):
        assert heap.take(size, counts[size]) == want[size]


def check(rows, got, shards):
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == sorted(
        (str(k), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in rows
    )
    by_crc = defaultdict(set)
    for r in got:
        by_crc[r["text_crc32"], r["size"]].add(r["shard"])
    assert all(len(s) == 1 for s in by_crc.values())
    groups, loads, slots = defaultdict(int), defaultdict(int), defaultdict(list)
    for _, t in rows:
        groups[t or ""] += len((t or "").encode()) + 1
    for r in got:
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    _, want = plain_heap(groups.values(), shards)
    assert {s: n for s, n in want.items() if n} == dict(loads)


def test_awkward_documents(spark):
    for shards in (1, 3, 16):
        check(DOCS, sharding.shard_documents(docs_table(spark, DOCS), shards).collect(), shards)


def test_groups_of_a_third_of_all_rows(spark):
    rng = random.Random(3)
    rows = [(i, "word " * rng.randint(0, 60) + str(i % 7)) for i in range(600)]
    rows += [(1000 + i, "copied text " * 9) for i in range(400)] + [(None, None)] * 3 + [(5000 + i, "") for i in range(300)]
    check(rows, sharding.shard_documents(docs_table(spark, rows).repartition(9), 16).collect(), 16)


def test_slots_follow_the_key(spark):
    got = sharding.shard_documents(docs_table(spark, [(i, f"text {i}") for i in range(50, 0, -1)]), 4).collect()
    for shard in range(4):
        ids = [r["doc_id"] for r in sorted((r for r in got if r["shard"] == shard), key=lambda r: r["slot"])]
        assert ids == sorted(ids)


def test_empty_table(spark):
    found = sharding.shard_documents(docs_table(spark, []))
    assert found.columns == ["doc_id", "size", "text_crc32", "shard", "slot"] and found.count() == 0


def test_written_shards_hold_all_rows(spark, tmp_path):
    folder = f"{tmp_path}/shards"
    docs = docs_table(spark)
    sharding.write_shards(docs, folder, shards=3, pieces=2)
    back = spark.read.parquet(folder)
    assert sorted(map(str, back.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))
    where = {(r["doc_id"], r["size"]): r["shard"] for r in sharding.shard_documents(docs, 3).collect()}
    for r in back.collect():
        assert r["shard"] == where[r["doc_id"], len((r["text"] or "").encode()) + 1]
