"""Clusters and vector codes against brute force."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from clientela.llm import centroids, vector_codes

KIND = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        *[T.StructField(n, T.StringType()) for n in ("id", "numbers", "cluster", "distance", "code", "error", "entry", "of")],
    ]
)


def table(spark, rows):
    return spark.createDataFrame([(*r, *["extra"] * 8) for r in rows], KIND)


def vectors(n, size, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    return [np.float32(v).tolist() for v in rng.normal(0, spread, (n, size))]


def awkward(size, seed=5):
    """Nulls, wrong lengths, not finite components, ties, repeated rows and keys, one vector in a third of all rows."""
    rows = [(i, v, i % 4 if i % 5 else None) for i, v in enumerate(vectors(70, size, seed))]
    rows += [(200 + i, [0.5] * size, 1) for i in range(40)]
    rows += [(3, rows[3][1], 0), (3, [0.25] * size, None), (None, [0.125] * size, 2), (None, rows[9][1], None)]
    rows += [(300, None, 1), (301, [], 1), (302, [1.0] * (size - 1), 1), (303, [1.0] * (size + 1), None)]
    rows += [(304, [None] + [1.0] * (size - 1), 1), (305, [math.nan] * size, 1), (306, [math.inf] + [0.0] * (size - 1), 1)]
    rows += [(400 + i, [float(i % 2)] * size, 3) for i in range(10)]
    return rows


def whole(vector, factor):
    return [math.floor(factor * x) for x in vector]


def finite(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def lloyd(rows, start, rounds):
    """Plain whole-number K-Means: nearest by (distance, number), then floors of means."""
    centres = [list(c) for c in start]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        given = [[] for _ in centres]
        for v in rows:
            given[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(g) for x in zip(*g, strict=True)] if g else c for g, c in zip(given, centres, strict=True)]
    return centres, [nearest(v) for v in rows]


@pytest.mark.parametrize("k", [1, 7, 500])
def test_clusters_match_brute_force(spark, k):
    rows = awkward(6)
    got = centroids.cluster_report(table(spark, rows), clusters=k, rounds=3, size=6)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    kept = [(i, whole(v, 256)) for i, v, _ in rows if finite(v) and len(v) == 6]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres, near = lloyd([v for _, v in kept], [v for _, v in order[:k]], 3)
    inertia = {c: sum(d for d, n in near if n == c) for _, c in near}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    want = [(i, c, d, inertia[c], sum(inertia.values()), names[c]) for (i, _), (d, c) in zip(kept, near, strict=True)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("entries", [1, 5, 200])
def test_codes_match_brute_force(spark, entries):
    rows = awkward(16)
    got = vector_codes.code_report(table(spark, rows), parts=8, entries=entries, rounds=3)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    kept = [(i, whole(v, 4096), label) for i, v, label in rows if finite(v) and len(v) == 16]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books, codes, errors = [], [""] * len(kept), [0] * len(kept)
    for part in range(8):
        cut = slice(2 * part, 2 * part + 2)
        centres, near = lloyd([v[cut] for _, v, _ in kept], [v[cut] for _, v, _ in order], 3)
        books += [x for c in centres for x in c]
        codes = [c + f"{n:02x}" for c, (_, n) in zip(codes, near, strict=True)]
        errors = [e + d for e, (d, _) in zip(errors, near, strict=True)]
    by_label = {}
    for (_, _, label), e in zip(kept, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    digest = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    want = [(i, c, e, by_label[label], digest) for (i, _, label), c, e in zip(kept, codes, errors, strict=True)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_codes_stand_for_vectors(spark):
    rows = [(i, v, 0) for i, v in enumerate(vectors(300, 16, 8))]
    codes, books = vector_codes.compress(table(spark, rows), entries=64)
    back = {r["vec_id"]: r["decoded"] for r in vector_codes.decoded(codes, books).collect()}
    error = {r["vec_id"]: r["error"] for r in codes.collect()}
    for i, v, _ in rows:
        gap = sum((math.floor(4096 * a) - round(4096 * b)) ** 2 for a, b in zip(v, back[i], strict=True))
        assert gap == error[i]
    assert sum(error.values()) < 0.5 * sum(sum((4096 * x) ** 2 for x in v) for _, v, _ in rows)


def test_empty_tables(spark):
    for rows in ([], [(1, None, 1)], [(1, [math.nan] * 64, 1)]):
        assert centroids.cluster_report(table(spark, rows)).count() == 0
        assert vector_codes.code_report(table(spark, rows)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 20), st.integers(1, 4), st.sampled_from([2, 9, 4000, 1 << 28, 1 << 34]))
def test_both_searches_are_exact(seed, k, width, size):
    """Small numbers give many ties; large ones leave the doubles, then 64 bits."""
    rng = np.random.default_rng(seed)
    entries, rows = rng.integers(-size, size, (3, k, width)), rng.integers(-size, size, (20, 3 * width))
    numbers, distances = vector_codes.Codebooks(entries).nearest(rows)
    for i, row in enumerate(rows.reshape(20, 3, width).tolist()):
        for part in range(3):
            want = min((sum((a - b) ** 2 for a, b in zip(row[part], e, strict=True)), n) for n, e in enumerate(entries[part].tolist()))
            assert (int(distances[i, part]), int(numbers[i, part])) == want
    bisectors = centroids.Bisectors(entries[0])
    cut = rows[:, :width]
    winner = bisectors.nearest(cut)
    got = zip(map(int, bisectors.distances(cut, winner)), winner.tolist(), strict=True)
    for row, found in zip(cut.tolist(), got, strict=True):
        assert found == min((sum((a - b) ** 2 for a, b in zip(row, e, strict=True)), n) for n, e in enumerate(entries[0].tolist()))
