"""Document quality from preference pairs: Bradley-Terry scores, thresholded at a score quantile."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from clientela.functions.ranks import exact_quantiles
from clientela.llm.common import raw_texts
from clientela.session import materialise

# Labelled rows of each class that the model is fitted on, at most, taken in the order of a hash of the key.
ROWS_PER_CLASS = 10_000
# Preference pairs drawn from them.
PAIRS = 20_000
# Quantile levels tried as threshold.
LEVELS = 400
ACCEPTED = 0.7

_CLASS = np.zeros(256, np.int64)
for _number, _bytes in enumerate(
    [range(0x41, 0x5B), range(0x61, 0x7B), range(0x30, 0x3A), range(0x80, 0x100), b" \t\r\x0b\x0c", b"\n", b".,;:'\"?()-", b"!", b"|/\\<>=_[]{}", b"#$%&*+@^~`"]
):
    _CLASS[list(_bytes)] = _number + 1
CLASSES = 11


def text_features(data: bytes) -> list[float]:
    """Numbers that describe form, not language: shares of byte classes, repetition, lengths."""
    counts = np.bincount(_CLASS, np.bincount(np.frombuffer(data, np.uint8), minlength=256), CLASSES) / (len(data) + 1)
    words = data.split()
    n = len(words) + 1
    repeats = sum(map(bytes.__eq__, words, words[1:])) / n
    distinct = len(set(words)) / n
    lines = data.split(b"\n")
    same_lines = len(set(lines)) / len(lines)
    shares = [*counts.tolist(), repeats, distinct, same_lines]
    return [*shares, *[math.sqrt(s) for s in shares], math.log(len(data) + 1), math.log(n), len(data) / n / 10]


@arrow_udf(T.ArrayType(T.DoubleType()))
def features(texts: pa.Array) -> pa.Array:
    return pa.array([text_features(t) for t in raw_texts(texts)], pa.list_(pa.float64()))


@dataclass
class PairModel:
    """Weights of the features and the score of the document at the threshold."""

    weights: list[float]
    threshold: float

    def score(self, feature: Column | str) -> Column:
        """Preference of a document over the one at the threshold, moved so that a tie scores 0.7.

        Without weights (no two classes to compare) nothing speaks against a document: 1.
        """
        if not self.weights:
            return F.lit(1.0)
        margin = self.raw(feature) - self.threshold + math.log(ACCEPTED / (1 - ACCEPTED))
        return 1 / (1 + F.exp(-margin))

    def raw(self, feature: Column | str) -> Column:
        column = F.col(feature) if isinstance(feature, str) else feature
        weights = F.array(*[F.lit(float(w)) for w in self.weights])
        return F.aggregate(F.zip_with(column, weights, lambda x, w: x * w), F.lit(0.0), lambda a, x: a + x)


def held_out(key: str) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(featured: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> PairModel:
    """Learn from ``featured`` (``key, features``) and ``labels``.

    Logistic loss on feature differences of pairs (a document labelled 1 preferred to one labelled 0), without an
    intercept: the Bradley-Terry model. At most ``ROWS_PER_CLASS`` rows of each class and ``PAIRS`` pairs fit the
    weights; the threshold comes from the scores of all rows that may be learnt from. Keys with
    null or contradicting labels are left out, repeated labels count once, and held-out keys are never read.
    """
    known = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("label")).where("label in (0, 1) and id is not null")
    known = known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other")
    known = known.where(~held_out("id")).select("id", "label")
    rows = featured.select(F.col(key).alias("id"), "features").join(known, "id")

    def sample(value: int) -> DataFrame:
        return rows.where(F.col("label") == value).orderBy(F.xxhash64("id"), "id", "features").limit(ROWS_PER_CLASS)

    # At most 2 * ROWS_PER_CLASS rows from here on.
    chosen = materialise(sample(1).unionByName(sample(0)), "labelled-sample")
    sizes = {r["label"]: r["n"] for r in chosen.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return PairModel([], 0.0)

    def numbered(value: int, name: str) -> DataFrame:
        # A local collect of the bounded sample gives every row its place.
        place = F.posexplode(F.col("all"))
        listed = chosen.where(F.col("label") == value).agg(F.array_sort(F.collect_list(F.struct("id", "features"))).alias("all"))
        return listed.select(place.alias(f"{name}_at", "row")).select(f"{name}_at", F.col("row.features").alias(name))

    pair = chosen.sparkSession.range(PAIRS).withColumnRenamed("id", "p")
    pair = pair.withColumn("good_at", (F.col("p") % sizes[1]).cast("int"))
    pair = pair.withColumn("bad_at", ((F.col("p") * 7919 + F.floor(F.col("p") / sizes[1])) % sizes[0]).cast("int"))
    pair = pair.join(numbered(1, "good"), "good_at").join(numbered(0, "bad"), "bad_at")
    sign = F.when(F.col("p") % 2 == 0, 1.0).otherwise(-1.0)
    gap = F.zip_with("good", "bad", lambda g, b: g - b)
    pair = pair.select(((sign + 1) / 2).alias("label"), F.transform(gap, lambda d: d * sign).alias("gap"))
    pair = materialise(pair, "pairs").select("label", array_to_vector("gap").alias("features"))
    model = LogisticRegression(fitIntercept=False, regParam=1e-4, maxIter=40).fit(pair)
    fitted = PairModel([float(w) for w in model.coefficients], 0.0)
    return PairModel(fitted.weights, quantile_threshold(rows.select("label", fitted.raw("features").alias("raw"))))


def quantile_threshold(scored: DataFrame) -> float:
    """The quantile of all labelled scores that separates the labels best (both classes weigh the same).

    Exact quantiles of every row in ``scored`` (``label, raw``), then one count for each label between neighbouring
    quantiles; what comes to the driver has one row for each of ``LEVELS`` and each label. Of equally good ones the
    middle of the lowest and the highest.
    """
    scored = materialise(scored, "labelled-scores")
    levels = [i / LEVELS for i in range(1, LEVELS)]
    quantiles = sorted({r["value"] for r in exact_quantiles(scored, ["raw"], levels).collect()})
    bins = Bucketizer(splits=[-math.inf, *quantiles, math.inf], inputCol="raw", outputCol="bin")
    counts = bins.transform(scored).groupBy("label", F.col("bin").cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    below = {0: [0] * (len(quantiles) + 1), 1: [0] * (len(quantiles) + 1)}
    for row in counts.collect():
        below[row["label"]][row["bin"]] = row["n"]
    good, bad = sum(below[1]), sum(below[0])
    # Rows of bin i lie from quantile i - 1 on and below quantile i.
    values, missed, found = [], 0, 0
    for at in range(len(quantiles)):
        missed, found = missed + below[1][at], found + below[0][at]
        values.append(round(1 - missed / good + found / bad, 9))
    best = [q for q, v in zip(quantiles, values, strict=True) if v == max(values)]
    return (best[0] + best[-1]) / 2


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """One row per input row: ``key, held_out, score, predicted``.

    ``score`` is in 0 to 1, ``predicted`` is 1 from 0.7 on. Only the text decides; null text counts as empty, and empty
    texts are scored like any other. Without labels of both classes every document scores 1. Repeated rows each get
    their row, null keys are never held out, other columns are ignored.
    """
    featured = materialise(docs.select(key, features(text).alias("features")), "features")
    model = fit(featured, labels, key, label)
    scored = featured.select(key, held_out(key).alias("held_out"), model.score("features").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= ACCEPTED).cast("int"))


def drop_rejected(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """``docs`` without the rows that the fitted model rejects; every row is scored where it stands."""
    featured = materialise(docs.select(key, features(text).alias("features")), "features")
    model = fit(featured, labels, key, label)
    return docs.where(model.score(features(text)) >= ACCEPTED)
