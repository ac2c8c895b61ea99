"""Churn: rule-based labels, features, ordered split, boosted trees, metrics."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientela import settings as S
from clientela.functions.columns import require_features
from clientela.functions.ranks import roc_auc, running_totals, with_position
from clientela.session import materialise, spread

KEY = "customer_hash"


def build_churn_labels(
    feature_matrix: DataFrame, days: int = S.CHURN_DAYS, drop_label_source: bool = False
) -> DataFrame:
    """Add ``churned`` (recency above ``days``; unknown recency is 0) and its source.

    The label is a function of ``recency_days``, itself a model feature;
    ``drop_label_source=True`` removes that column for a model without the leak.
    """
    churned = F.coalesce(F.col("recency_days") > days, F.lit(False)).cast("int")
    labelled = feature_matrix.withColumn("churned", churned).withColumn(
        "churn_label_source", F.lit(S.CHURN_LABEL_SOURCE)
    )
    return labelled.drop("recency_days") if drop_label_source else labelled


def label_distribution(labelled: DataFrame) -> DataFrame:
    """Customers per class next to the overall churn rate, as one row."""
    return labelled.agg(
        F.count_if(F.col("churned") == 0).alias("active"),
        F.count_if(F.col("churned") == 1).alias("churned"),
        F.avg("churned").alias("churn_rate"),
    )


def encode_segment(label: str = "segment_label") -> Column:
    codes = F.create_map(*[F.lit(v) for i, s in enumerate(S.SEGMENT_LABELS) for v in (s, i)])
    return F.try_element_at(codes, F.col(label))


def merge_churn_features(
    labelled: DataFrame, anomaly_scores: DataFrame, segments: DataFrame, key: str = KEY
) -> DataFrame:
    """Key, the 11 features and the label; unscored customers get the defaults."""
    merged = (
        labelled.drop("segment_label", "anomaly_score")
        .join(anomaly_scores.select(key, "anomaly_score"), key, "left")
        .join(segments.select(key, "segment_label"), key, "left")
        .withColumn("segment_label", F.coalesce("segment_label", F.lit(S.DEFAULT_SEGMENT)))
        .withColumn("segment_encoded", encode_segment())
        .withColumn("anomaly_score", F.coalesce("anomaly_score", F.lit(S.DEFAULT_ANOMALY_SCORE)))
    )
    return merged.select(key, *[c for c in S.CHURN_FEATURES if c in merged.columns], "churned")


def prepare_churn_features(
    labelled: DataFrame,
    anomaly_scores: DataFrame,
    segments: DataFrame,
    key: str = KEY,
    features: list[str] | None = None,
) -> DataFrame:
    """``merge_churn_features`` plus the gate. Rows are not sorted: see ``ordered_split``."""
    merged = merge_churn_features(labelled, anomaly_scores, segments, key)
    return require_features(merged, features or S.CHURN_FEATURES)


def ordered_split(
    df: DataFrame, share: float = S.TRAIN_SHARE, order: str = "recency_days", key: str = KEY
) -> DataFrame:
    """Add ``split``: the first ``int(share * rows)`` rows by (``order``, ``key``) train.

    The boundary is found from row counts per ``order`` value; only rows sharing
    the boundary value are ranked by key. The table itself is never sorted: the
    split is two comparisons against the boundary row.
    """
    rows = df.count()
    cut = int(share * rows)
    if cut == 0:
        return df.withColumn("split", F.lit("test"))
    counts = df.groupBy(order).agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counts, [order], ["n"])
    edge = ranked.where((F.col("n_before") < cut) & (F.col("n_before") + F.col("n") >= cut)).first()
    value, inside = edge[order], cut - edge["n_before"]
    in_train = F.col(order) < F.lit(value)
    if inside == edge["n"]:
        in_train = F.col(order) <= F.lit(value)
    else:
        ties = with_position(df.where(F.col(order) == F.lit(value)).select(key), [key])
        last = ties.where(F.col("position") == inside).first()[key]
        in_train = in_train | ((F.col(order) == F.lit(value)) & (F.col(key) <= F.lit(last)))
    return df.withColumn("split", F.when(in_train, "train").otherwise("test"))


def split_statistics(split: DataFrame) -> DataFrame:
    """One row: rows and churn rate of each side."""
    train, test = F.col("split") == "train", F.col("split") == "test"
    return split.agg(
        F.count_if(train).cast("double").alias("train_size"),
        F.count_if(test).cast("double").alias("test_size"),
        F.avg(F.when(train, F.col("churned"))).alias("churn_rate_train"),
        F.avg(F.when(test, F.col("churned"))).alias("churn_rate_test"),
    )


def threshold_metrics(scored: DataFrame, score: str, label: str = "churned", at: float = 0.5) -> DataFrame:
    """One row ``f1, precision, recall`` for score above ``at``; 0 where undefined."""
    predicted, actual = F.col(score) > at, F.col(label) == 1
    counts = scored.agg(
        F.count_if(predicted & actual).alias("tp"),
        F.count_if(predicted & ~actual).alias("fp"),
        F.count_if(~predicted & actual).alias("fn"),
    )

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
    )


def classification_metrics(split_scored: DataFrame, score: str) -> DataFrame:
    """AUC, F1, precision and recall on the test side plus the split statistics.

    Three aggregates read the scores, so they are written first: a model scores once.
    """
    split_scored = materialise(split_scored.select("split", "churned", score), "scored-split")
    test = split_scored.where(F.col("split") == "test")
    row = split_statistics(split_scored)
    auc = roc_auc(test, score, "churned")
    at_half = threshold_metrics(test, score)
    values = at_half.agg(F.struct(F.first("f1").alias("f1"), F.first("precision").alias("p"), F.first("recall").alias("r"))).scalar()
    return row.select(
        auc.scalar().alias("roc_auc"),
        values["f1"].alias("f1"),
        values["p"].alias("precision"),
        values["r"].alias("recall"),
        "*",
    )


def train_churn_model(
    split: DataFrame,
    rounds: int = S.BOOSTING_ROUNDS,
    step: float = S.BOOSTING_STEP,
    seed: int = S.SEED,
    features: list[str] | None = None,
    key: str = KEY,
) -> tuple[PipelineModel, DataFrame]:
    """Boosted trees fitted on the train side, and the metrics row of the test side.

    Every round scans the train side once for each level of its tree, so it is spread evenly over the cores first; it
    is sorted in each partition, as the booster draws its candidate cuts by place.
    """
    features = features or S.CHURN_FEATURES
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    label = F.col("churned").cast("double").alias("label")
    train = spread(split.where(F.col("split") == "train").select(key, *features, label), key, *features)
    train = train.sortWithinPartitions(key, *features)
    booster = GBTClassifier(
        maxIter=rounds, stepSize=step, seed=seed, featuresCol="features", labelCol="label"
    )
    vectors = assembler.transform(train).select("features", "label")
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = booster.fit(vectors)
    finally:
        vectors.unpersist()
    model = PipelineModel([assembler, fitted])
    scored = with_probability(split, model).select("split", "churned", "churn_probability")
    return model, classification_metrics(scored, "churn_probability")


def with_probability(df: DataFrame, model: PipelineModel) -> DataFrame:
    scored = model.transform(df).withColumn(
        "churn_probability", vector_to_array("probability").getItem(1)
    )
    return scored.drop("features", "rawPrediction", "probability", "prediction")


def score_churn(
    df: DataFrame, model: PipelineModel, threshold: float = S.CHURN_RISK_THRESHOLD, key: str = KEY
) -> DataFrame:
    """``customer_hash, churn_probability, predicted_churn``."""
    return predict_churn(with_probability(df, model), threshold, key)


def predict_churn(
    scored: DataFrame, threshold: float = S.CHURN_RISK_THRESHOLD, key: str = KEY
) -> DataFrame:
    return scored.select(
        key, "churn_probability", (F.col("churn_probability") >= threshold).alias("predicted_churn")
    )


def precision_at_share(
    scored: DataFrame,
    score: str = "churn_probability",
    label: str = "churned",
    share: float = S.PRECISION_AT_SHARE,
    key: str = KEY,
) -> DataFrame:
    """One row ``k, precision_at_k``: label mean of the riskiest ``share`` of customers.

    Score values above the boundary count whole; only the customers sharing the
    boundary value are ranked by key.
    """
    rows = scored.count()
    k = int(share * rows)
    falling = scored.select(key, (-F.col(score)).alias("_s"), F.col(label).cast("bigint").alias("_y"))
    if k == 0:
        return scored.agg(F.lit(0).cast("bigint").alias("k"), F.lit(None).cast("double").alias("precision_at_k"))
    counts = falling.groupBy("_s").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("y"))
    ranked = running_totals(counts, ["_s"], ["n", "y"])
    edge = ranked.where((F.col("n_before") < k) & (F.col("n_before") + F.col("n") >= k)).first()
    inside = k - edge["n_before"]
    tied = falling.where(F.col("_s") == F.lit(edge["_s"])).select(key, "_y")
    top = with_position(tied, [key]).where(F.col("position") <= inside)
    hits = F.lit(edge["y_before"]) + F.sum("_y")
    return top.agg(
        F.lit(k).cast("bigint").alias("k"), (hits.cast("double") / F.lit(float(k))).alias("precision_at_k")
    )


def ranked_at_risk(
    scores: DataFrame, threshold: float = S.CHURN_RISK_THRESHOLD, key: str = KEY
) -> DataFrame:
    """Customers at risk, highest probability first, with their rank."""
    risky = scores.where(F.col("churn_probability") >= threshold)
    return with_position(risky, [F.desc("churn_probability"), F.col(key)], "risk_rank")
