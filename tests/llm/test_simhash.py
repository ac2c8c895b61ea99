"""Fingerprints, the vantage-point search and components against brute force."""

import re
from collections import Counter, defaultdict

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from rows import DOCS, docs_table, prose

from clientela.llm import simhash
from clientela.llm.common import connected


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


class Sets:
    def __init__(self):
        self.up = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        self.up[self.root(x)] = self.root(y)


def brute_components(docs, reach=3):
    fps = [brute_fingerprint(t) for _, t in docs]
    sets = Sets()
    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= reach:
                sets.join(i, j)
    low = defaultdict(list)
    for i, (key, _) in enumerate(docs):
        if key is not None:
            low[sets.root(i)].append(key)
    return Counter((k, fps[i], min(low[sets.root(i)], default=None)) for i, (k, _) in enumerate(docs))


NEAR = [(100 + i, prose(21, 3000) + (" tail" if i % 2 else "")) for i in range(8)]


def test_components_match_brute_force(spark):
    rows = DOCS + NEAR
    got = simhash.near_duplicates(docs_table(spark, rows)).collect()
    found = Counter((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in got)
    assert found == brute_components(rows)
    assert found[(107, brute_fingerprint(NEAR[7][1]), 100)] == 1


def test_one_row_of_each_group_stays(spark):
    rows = DOCS + NEAR
    docs = docs_table(spark, rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    groups = {c if c is not None else ("none", f) for (_, f, c) in brute_components(rows)}
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(groups)
    assert 100 in ids and 101 not in ids and ids.count(12) <= 1


def test_empty_table(spark):
    assert simhash.near_duplicates(docs_table(spark, [])).count() == 0
    assert simhash.keep_one(docs_table(spark, [])).count() == 0


def forest_components(n, pairs):
    sets = Sets()
    for a, b in pairs:
        sets.join(a, b)
    return {frozenset(i for i in range(n) if sets.root(i) == r) for r in {sets.root(i) for i in range(n)}}


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10_000), st.integers(2, 700), st.integers(0, 3))
def test_trees_lose_no_link(seed, n, shards):
    """Members and visitors of all shards together link exactly what brute force links."""
    rng = np.random.default_rng(seed)
    fps = rng.integers(0, 1 << 63, n).astype(np.uint64)
    crowd = rng.integers(0, n, n // 2)
    for _ in range(2):
        fps[crowd] = fps[0] ^ (np.uint64(1) << rng.integers(0, 64, len(crowd)).astype(np.uint64)) ^ fps[crowd[0]] ^ fps[0]
    fps = np.unique(fps)
    place = {int(f): i for i, f in enumerate(fps)}
    want = [(i, j) for i in range(len(fps)) for j in np.nonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= 3)[0]]
    top = simhash.fit_top(fps[:: max(1, n // 60)], 1 << shards)
    shard, at, member = simhash.deal_to_shards(top, fps, 3)
    assert sorted(at[member]) == list(range(len(fps)))
    got = []
    for s in np.unique(shard):
        own = shard == s
        got += simhash.linked_in_shard(fps[at[own & member]], fps[at[own & ~member]], 3)
    for a, b in got:
        assert (a ^ b).bit_count() <= 3
    pairs = [(place[a], place[b]) for a, b in got]
    assert forest_components(len(fps), pairs) == forest_components(len(fps), want)


def crowded(seed, n):
    """Fingerprints of which a third lie within a few bits of one."""
    rng = np.random.default_rng(seed)
    fps = rng.integers(0, 1 << 64, n, np.uint64)
    for i in range(0, n, 3):
        for bit in rng.integers(0, 64, rng.integers(0, 6)):
            fps[i] = fps[0] ^ (np.uint64(1) << np.uint64(bit))
    return np.unique(fps)


def test_blocks_meet_once(monkeypatch):
    monkeypatch.setattr(simhash, "MEMBERS_AT_ONCE", 20)
    monkeypatch.setattr(simhash, "VISITORS_AT_ONCE", 15)
    fps = crowded(1, 200).view(np.int64)
    member = np.arange(len(fps)) % 3 > 0
    blocks = simhash.Blocks(np.array([5, member.sum()]), np.array([0, (~member).sum()]))
    at, own, other, home = blocks.deal(np.ones(len(fps), int), fps, member)
    groups = defaultdict(lambda: ([], []))
    for i, a, b, at_home in zip(at, own, other, home):
        groups[a, b][0 if at_home else 1].append(i)
    met = Counter()
    for (_, b), (here, guests) in groups.items():
        met.update(frozenset((i, j)) for i in here for j in guests)
        if b == 0:
            met.update(frozenset((i, j)) for n, i in enumerate(here) for j in here[:n])
    wanted = {frozenset((i, j)) for i in range(len(fps)) for j in range(i) if member[i] or member[j]}
    assert set(met) == wanted and set(met.values()) == {1}
    assert max(len(h) for h, _ in groups.values()) < 60


def test_small_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_MEMBERS", 300)
    monkeypatch.setattr(simhash, "MEMBERS_AT_ONCE", 40)
    monkeypatch.setattr(simhash, "VISITORS_AT_ONCE", 30)
    fps = crowded(2, 1500)
    rows = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    found, wanted = Sets(), Sets()
    for a, b in simhash.links(rows, 3).collect():
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 3 and a != b
        found.join(a, b)
    for i, j in zip(*np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)):
        wanted.join(int(fps[i : i + 1].view(np.int64)[0]), int(fps[j : j + 1].view(np.int64)[0]))
    groups = [defaultdict(set) for _ in range(2)]
    for f in fps.view(np.int64):
        for sets, known in zip((found, wanted), groups):
            known[sets.root(int(f))].add(int(f))
    assert sorted(map(sorted, groups[0].values())) == sorted(map(sorted, groups[1].values()))


def test_connected_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    edges = spark.createDataFrame(chain + star + [(7, 7)], "a long, b long")
    roots = {r["node"]: r["root"] for r in connected(edges, "a", "b").collect()}
    assert roots == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(1000, 1050), 1000)}
