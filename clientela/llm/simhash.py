"""SimHash near-duplicates through vantage-point trees."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from clientela.llm.common import Batches, arrow_batch, connected, raw_texts
from clientela.session import materialise

SHINGLE = 3
DISTANCE = 3
SEED = 42
# Fingerprints that belong to one shard, about; the top of the tree is as deep as that takes.
SHARD_MEMBERS = 30_000
# The top of the tree is fitted on so many fingerprints for each shard, and never on more than SAMPLE_MOST.
SAMPLE_PER_SHARD = 64
SAMPLE_MOST = 1 << 17
LEAF_MEMBERS = 64
# Members and visitors of a shard that one task holds at once, about; larger shards are searched block by block.
MEMBERS_AT_ONCE = 1 << 17
VISITORS_AT_ONCE = 1 << 17
# Pairs compared at a time in a leaf.
BLOCK = 1 << 21
VANTAGE_TRIES = 6
SHINGLES_AT_ONCE = 1 << 14


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """64 bits; one is set when it is set in over half of the shingles' hashes, repeats included.

    Words are runs of non-blank bytes of the text with A-Z lower-cased; fewer words than a shingle make one
    shingle; no words give zero.
    """
    words = data.lower().split()
    if not words:
        return 0
    last = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    hashed = xxhash.xxh64_intdigest
    for start in range(0, last, SHINGLES_AT_ONCE):
        stop = min(last, start + SHINGLES_AT_ONCE)
        if shingle == 3 and len(words) >= 3:
            part = words[start : stop + 2]
            joined = [b"%b %b %b" % w for w in zip(part, part[1:], part[2:], strict=False)]
        else:
            joined = [b" ".join(words[i : i + shingle]) for i in range(start, stop)]
        hashes = np.array([hashed(s, SEED) for s in joined], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > last, bitorder="little").tobytes(), "little", signed=True)


def row_hash(key: str, text: str):
    """128-bit hash of key and text, the same for repeated rows only (null text as empty)."""
    none = F.lit("")
    return F.md5(F.concat_ws(":", F.col(key).isNull(), F.coalesce(F.col(key).cast("string"), none), F.coalesce(text, none)))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id, copy, fp`` of every row (``copy``: hash of key and text); the texts are read once and not kept."""

    def scan(batches: Batches):
        for batch in batches:
            texts = raw_texts(batch.column(1))
            fps = pa.array([fingerprint(t, shingle) for t in texts], pa.int64())
            yield arrow_batch(["id", "copy", "fp"], [batch.column(0), batch.column(2), fps])

    kind = T.StructType(
        [T.StructField("id", docs.schema[key].dataType), T.StructField("copy", T.StringType()), T.StructField("fp", T.LongType())]
    )
    return docs.select(F.col(key), F.col(text), row_hash(key, text).alias("_copy")).mapInArrow(scan, kind)


def distances(fps: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(fps ^ point)


class Split:
    """A vantage point and the distance up to which members go to the near side."""

    def __init__(self, point: np.uint64, radius: int):
        self.point, self.radius = point, radius

    @classmethod
    def fit(cls, fps: np.ndarray) -> Split | None:
        """The best of a few fixed tries: even halves and few fingerprints close to the border."""
        best = None
        for at in np.linspace(0, len(fps) - 1, VANTAGE_TRIES).astype(int):
            counts = np.bincount(distances(fps, fps[at]), minlength=65)
            upto = np.cumsum(counts)
            radius = int(np.searchsorted(upto, len(fps) / 2))
            for r in (radius - 1, radius):
                if r < 0 or upto[r] == len(fps):
                    continue
                worst = max(upto[r], len(fps) - upto[r])
                border = counts[max(0, r - DISTANCE + 1) : r + DISTANCE + 1].sum()
                cost = worst + border / 2
                if best is None or cost < best[0]:
                    best = (cost, fps[at], r)
        return None if best is None else cls(best[1], best[2])

    def deal(self, members: np.ndarray, visitors: np.ndarray, reach: int):
        """Members and visitors of the near and of the far side, as masks.

        Members have one side. Far members within ``reach`` of the border also visit the near side, so a pair across
        the border meets there once. By the triangle inequality nobody else can be within ``reach`` across it.
        """
        dm, dv = distances(members, self.point), distances(visitors, self.point)
        near = dm <= self.radius
        crossing = ~near & (dm <= self.radius + reach)
        return near, crossing, dv <= self.radius + reach, dv > self.radius - reach


class Forest:
    """Union-find over array positions that keeps one pair for every union."""

    def __init__(self, size: int):
        self.parent = np.arange(size)
        self.pairs: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = int(parent[i])
        return i

    def roots(self, at: np.ndarray) -> np.ndarray:
        found = self.parent[at]
        while True:
            above = self.parent[found]
            if np.array_equal(above, found):
                break
            found = above
        self.parent[at] = found
        return found

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        a, b = self.roots(left), self.roots(right)
        differ = a != b
        if not differ.any():
            return
        left, right, a, b = left[differ], right[differ], a[differ], b[differ]
        _, first = np.unique(np.minimum(a, b) * np.int64(len(self.parent)) + np.maximum(a, b), return_index=True)
        for i in first:
            x, y = self.root(int(left[i])), self.root(int(right[i]))
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                self.pairs.append((int(left[i]), int(right[i])))


def linked_in_shard(members: np.ndarray, visitors: np.ndarray, reach: int, among: bool = True) -> list[tuple[int, int]]:
    """Pairs (member or visitor, member) within ``reach``: enough of them to connect all that link in this shard.

    The shard's own vantage-point tree is walked for all members and visitors at once; without ``among`` for the
    visitors only.
    """
    fps = np.concatenate([members, visitors])
    forest = Forest(len(fps))
    todo = [(np.arange(len(members)), np.arange(len(members), len(fps)))]
    while todo:
        own, guests = todo.pop()
        if not len(own) or len(own) + len(guests) < 2:
            continue
        split = Split.fit(fps[own]) if len(own) > LEAF_MEMBERS else None
        if split:
            near, crossing, guests_near, guests_far = split.deal(fps[own], fps[guests], reach)
            across = own[crossing] if among else own[:0]
            todo.append((own[near], np.concatenate([guests[guests_near], across])))
            todo.append((own[~near], guests[guests_far]))
            continue
        everyone = np.concatenate([own, guests]) if among else guests
        step = max(1, BLOCK // len(own))
        for start in range(0, len(everyone), step):
            part = everyone[start : start + step]
            i, j = np.nonzero(np.bitwise_count(fps[part][:, None] ^ fps[own][None, :]) <= reach)
            left, right = part[i], own[j]
            differ = left != right
            if differ.any():
                forest.link(left[differ], right[differ])
    return [(int(fps[a]), int(fps[b])) for a, b in forest.pairs]


def fit_top(sample: np.ndarray, shards: int) -> tuple:
    """Top of the tree: nested (split, near, far) with shard numbers as leaves."""
    numbers = iter(range(1 << 30))

    def grow(fps: np.ndarray, depth: int):
        split = Split.fit(fps) if depth and len(fps) > 1 else None
        if split is None:
            return next(numbers)
        near = distances(fps, split.point) <= split.radius
        return split, grow(fps[near], depth - 1), grow(fps[~near], depth - 1)

    return grow(sample, max(0, math.ceil(math.log2(max(1, shards)))))


def leaves(top) -> list[int]:
    """Numbers of the shards below a node."""
    if isinstance(top, int):
        return [top]
    return leaves(top[1]) + leaves(top[2])


def deal_to_shards(top, fps: np.ndarray, reach: int):
    """``shard, position, is member`` arrays for every shard a fingerprint belongs to or has to visit."""
    out = []
    todo = [(top, np.arange(len(fps)), np.arange(0))]
    while todo:
        node, own, guests = todo.pop()
        if isinstance(node, int):
            at = np.concatenate([own, guests])
            out.append((np.full(len(at), node), at, np.arange(len(at)) < len(own)))
            continue
        split, near_node, far_node = node
        near, crossing, guests_near, guests_far = split.deal(fps[own], fps[guests], reach)
        todo.append((near_node, own[near], np.concatenate([guests[guests_near], own[crossing]])))
        todo.append((far_node, own[~near], guests[guests_far]))
    return [np.concatenate(x) for x in zip(*out, strict=True)]


class Blocks:
    """Cuts shards into blocks of members and of visitors, so that no task holds a whole large one.

    Every block of members meets every block of visitors and every other block of members once: as the groups
    (shard, own block, other). ``other`` counts the visitors' blocks, then the members'; with the first of them
    members are also compared among themselves.
    """

    def __init__(self, members: np.ndarray, visitors: np.ndarray):
        self.own = np.maximum(1, -(-members // MEMBERS_AT_ONCE))
        self.visiting = np.maximum(1, -(-visitors // VISITORS_AT_ONCE))

    def deal(self, shard: np.ndarray, fps: np.ndarray, member: np.ndarray):
        """``position, own block, other, is own`` of every group that a row goes to."""
        own, visiting = self.own[shard], self.visiting[shard]
        mixed = (fps.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        block = (mixed % np.where(member, own, visiting).astype(np.uint64)).astype(np.int64)
        copies = np.where(member, visiting + own - 1, own)
        at = np.repeat(np.arange(len(fps)), copies)
        turn = np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
        own, visiting, block, member = own[at], visiting[at], block[at], member[at]
        # Members, after all visitors' blocks: the other members' blocks in turn; the smaller number is at home.
        rest = turn - visiting
        mate = rest + (rest >= block)
        home = member & ((rest < 0) | (mate > block))
        own_block = np.where(home, block, np.where(member, mate, turn))
        other = np.where(~member, block, np.where(rest < 0, turn, visiting + np.maximum(mate, block)))
        return at, own_block, other, home


def links(distinct: DataFrame, reach: int = DISTANCE) -> DataFrame:
    """``a, b``: links between different fingerprints (column ``fp``) that connect all within ``reach`` bits.

    Top of a vantage-point tree, fitted on a bounded sample, deals every fingerprint to one shard, and those near a
    border to the shards across it as visitors; every shard then searches its own tree. All fingerprints are
    indexed; only which points serve as vantage points comes from the sample. A shard returns a spanning forest of
    its links, so a group of g near copies costs it g - 1 rows, not g^2. Shards with more members or visitors than a
    task should hold are searched block against block (:class:`Blocks`): a crowd of near copies, which visits most
    shards, makes more tasks instead of larger ones.
    """
    shards = max(1, math.ceil(distinct.count() / SHARD_MEMBERS))
    wanted = min(SAMPLE_MOST, SAMPLE_PER_SHARD * shards)
    # At most SAMPLE_MOST fingerprints, whatever the table size.
    rows = distinct.orderBy(F.xxhash64("fp"), "fp").limit(wanted).toArrow()
    sample = rows.column("fp").to_numpy().view(np.uint64) if len(rows) else np.zeros(0, np.uint64)
    top = fit_top(sample, shards)

    def visits(batches: Batches):
        for batch in batches:
            if batch.num_rows:
                fps = batch.column(0).to_numpy(zero_copy_only=False)
                shard, at, member = deal_to_shards(top, fps.view(np.uint64), reach)
                yield shard.astype(np.int32), fps[at], member

    def count(batches: Batches):
        for shard, _, member in visits(batches):
            found, times = np.unique(2 * shard + member, return_counts=True)
            yield arrow_batch(["place", "n"], [pa.array(found, pa.int32()), pa.array(times, pa.int64())])

    # Bounded: two numbers for each leaf of the top, which has no more leaves than the sample has fingerprints.
    sizes = np.zeros(2 * len(leaves(top)), np.int64)
    counted = distinct.select("fp").mapInArrow(count, "place int, n long")
    for place, n in counted.groupBy("place").agg(F.sum("n")).collect():
        sizes[place] = n
    blocks = Blocks(sizes[1::2], sizes[0::2])

    def deal(batches: Batches):
        for shard, fps, member in visits(batches):
            at, own, other, home = blocks.deal(shard, fps, member)
            parts = [shard[at], own.astype(np.int32), other.astype(np.int32), fps[at], home]
            yield arrow_batch(["shard", "own", "other", "fp", "member"], [pa.array(x) for x in parts])

    def search(group: pa.Table) -> pa.Table:
        fps = group.column("fp").to_numpy().view(np.uint64)
        member = group.column("member").to_numpy()
        among = group.column("other")[0].as_py() == 0
        found = linked_in_shard(fps[member], fps[~member], reach, among)
        pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})

    dealt = distinct.select("fp").mapInArrow(deal, "shard int, own int, other int, fp long, member boolean")
    return dealt.groupBy("shard", "own", "other").applyInArrow(search, "a long, b long")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, reach: int = DISTANCE
) -> DataFrame:
    """One row per input row: ``key, copy, fp, component_id``.

    Rows link when their fingerprints differ in at most ``reach`` bits; ``component_id`` is the smallest key
    reachable over links, the row's own included. ``copy`` is a hash of key and text. Null, empty and blank texts have
    the fingerprint zero and link like any other; a null key is never the smallest unless its group has no other;
    repeated rows each get their row. Other columns are ignored.
    """
    rows = materialise(fingerprints(docs, key, text, shingle), "fingerprints")
    smallest = materialise(rows.groupBy("fp").agg(F.min("id").alias("low")), "distinct-fingerprints")
    roots = materialise(connected(links(smallest, reach), "a", "b"), "roots")
    joined = smallest.join(roots, smallest["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "low")
    lowest = joined.groupBy("root").agg(F.min("low").alias("component_id")).repartition("component_id")
    component = joined.join(lowest, "root").select("fp", "component_id")
    # A fingerprint with a third of all rows is a skewed key here: a plain left join, which adaptive execution splits.
    return rows.join(component, "fp", "left").select(F.col("id").alias(key), "copy", "fp", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that with the smallest key, then text hash.

    Groups as in :func:`near_duplicates`. Texts without words are alike, so one of them stays; of repeated rows one stays;
    a row with a null key stays only where its group has no other. An empty table gives an empty one.
    """
    found = near_duplicates(docs, key, text, **options)
    # Rows of null keys only: their fingerprint stands for the group.
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fp"), F.col("fp").cast("string")))
    first = F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), "copy")).alias("first")
    return only(docs, found.groupBy(group).agg(first), key, text)


def only(docs: DataFrame, chosen: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of ``docs`` that ``first.copy`` names, each once."""
    kept = chosen.select(F.col("first.copy").alias("_copy"))
    met = docs.withColumn("_copy", row_hash(key, text)).join(kept, "_copy", "left_semi")
    # Repeated rows of one key and text: one stays. The join has them together already.
    place = F.row_number().over(Window.partitionBy("_copy").orderBy("_copy"))
    return met.withColumn("_place", place).where("_place = 1").drop("_place", "_copy")
