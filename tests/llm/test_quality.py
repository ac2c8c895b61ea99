"""The quality model: learns from pairs, never from held-out labels, and only the text counts."""

import random
import zlib

import numpy as np
import pytest
from rows import DOCS, docs_table, prose

from clientela.llm import quality


def is_held_out(key):
    return key is not None and zlib.crc32(str(key).encode()) % 4 == 2


def corpus(n=400):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        text = prose(i, 60) + "."
        rows.append((i, text if good else " ".join(w + rng.choice(["###", "&&&", "$$$"]) for w in text.split())))
        labels.append((i, int(good)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    return rows, dict(labels), spark.createDataFrame(labels, "doc_id long, quality int")


def test_held_out_documents_are_told_apart(spark, fitted):
    rows, truth, labels = fitted
    more = DOCS[5:8] + [(None, "no id")]
    got = quality.score_documents(docs_table(spark, rows + [(10_000 + (k or 0), t) for k, t in more] + [(None, "x y")]), labels).collect()
    assert len(got) == len(rows) + len(more) + 1
    for r in got:
        assert r["held_out"] == is_held_out(r["doc_id"])
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    known = [r for r in got if r["doc_id"] in truth]
    assert sum(r["held_out"] for r in known) > 50
    assert all(r["predicted"] == truth[r["doc_id"]] for r in known)


def test_held_out_labels_do_not_matter(spark, fitted):
    rows, truth, labels = fitted
    turned = spark.createDataFrame([(k, 1 - v if is_held_out(k) else v) for k, v in truth.items()], "doc_id long, quality int")
    docs = docs_table(spark, rows)
    first = {r["doc_id"]: r["score"] for r in quality.score_documents(docs, labels).collect()}
    second = {r["doc_id"]: r["score"] for r in quality.score_documents(docs, turned).collect()}
    assert first == pytest.approx(second, abs=1e-6)


def test_rejected_rows_go(spark, fitted):
    rows, truth, labels = fitted
    docs = docs_table(spark, rows)
    kept = quality.drop_rejected(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k, v in truth.items() if v}


def test_odd_labels(spark):
    rows, labels = corpus(60)
    odd = [(k, v) for k, v in labels] + [(1, 0), (1, 1), (None, 1), (2, None), (3, 7)] + labels[:5]
    table = spark.createDataFrame(odd, "doc_id long, quality int")
    got = quality.score_documents(docs_table(spark, rows), table).collect()
    assert len(got) == 60
    one_class = spark.createDataFrame([(k, 1) for k, _ in labels], "doc_id long, quality int")
    assert {r["score"] for r in quality.score_documents(docs_table(spark, rows), one_class).collect()} == {1.0}
    assert quality.score_documents(docs_table(spark, []), table).count() == 0
    assert quality.score_documents(docs_table(spark, rows), table.limit(0)).count() == 60


def test_threshold_is_the_best_quantile_of_all_scores(spark):
    """Against all quantiles tried one by one; ties, a crowd at one score, classes of different sizes."""
    rng = random.Random(4)
    rows = [(1, rng.gauss(1, 1)) for _ in range(900)] + [(0, rng.gauss(-1, 1)) for _ in range(200)] + [(1, 0.25)] * 300 + [(0, 0.25)] * 40
    got = quality.quantile_threshold(spark.createDataFrame(rows, "label int, raw double"))
    raw = sorted(r for _, r in rows)

    def quantile(share):
        at = (len(raw) - 1) * share
        low, high = raw[int(at)], raw[min(int(at) + 1, len(raw) - 1)]
        return low + (high - low) * (at - int(at))

    def value(t):
        good = [r >= t for y, r in rows if y == 1]
        bad = [r < t for y, r in rows if y == 0]
        return round(sum(good) / len(good) + sum(bad) / len(bad), 9)

    tried = sorted({quantile(i / quality.LEVELS) for i in range(1, quality.LEVELS)})
    best = [t for t in tried if value(t) == max(map(value, tried))]
    assert got == pytest.approx((best[0] + best[-1]) / 2)


def test_weights_minimise_the_pair_loss(spark):
    """The loss over all pairs of good and bad documents falls all the way to the weights found."""
    rows, labels = corpus(240)
    docs = docs_table(spark, rows)
    featured = docs.select("doc_id", quality.features("text").alias("features"))
    model = quality.fit(featured, spark.createDataFrame(labels, "doc_id long, quality int"))
    truth = dict(labels)
    known = {r["doc_id"]: np.array(r["features"]) for r in featured.collect() if not is_held_out(r["doc_id"])}
    good, bad = ([f for k, f in known.items() if truth[k] == y] for y in (1, 0))
    gaps = np.array([g - b for g in good for b in bad])

    def loss(w):
        return np.logaddexp(0, -gaps @ w).mean()

    found, zero = loss(np.array(model.weights)), loss(np.zeros(gaps.shape[1]))
    assert found < 0.05 * zero
    # From zero to the weights found.
    assert all(loss(np.array(model.weights) * s) > found for s in (0.0, 0.25, 0.5, 0.75))
