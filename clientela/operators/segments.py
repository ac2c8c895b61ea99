"""Segmentation: scaling, multi-start K-Means, quality measures, segment labels."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from clientela import settings as S
from clientela.functions.columns import require_features
from clientela.functions.selection import selected_quantiles
from clientela.session import spread

SCALER_SCHEMA = "feature string, mean double, scale double"
CENTROID_SCHEMA = "cluster_id int, centroid array<double>"
QUANTILE_SHARES = [0.25, 0.50, 0.75, 0.90]
MAX_ITERATIONS = 300
SHIFT_TOLERANCE = 1e-4
# Rounds of drawing candidate starts and candidates of a round; more where k asks for more.
CANDIDATE_ROUNDS = 5
CANDIDATES = 64
# Points that all models of a scan look at in one step: their distances stay in the processor's cache.
BLOCK = 256


# --- scaling ----------------------------------------------------------------
def fit_scaler(df: DataFrame, features: Sequence[str] = S.SEGMENT_FEATURES) -> DataFrame:
    """``feature, mean, scale`` rows: mean and population deviation (1 if constant)."""
    aggregates = []
    for c in features:
        deviation = F.stddev_pop(c)
        aggregates.append(
            F.struct(
                F.lit(c).alias("feature"),
                F.avg(c).alias("mean"),
                F.when(deviation == 0, F.lit(1.0)).otherwise(deviation).alias("scale"),
            )
        )
    return df.agg(F.array(*aggregates).alias("s")).select(F.inline("s"))


def apply_scaler(df: DataFrame, scaler: DataFrame | list[Row], prefix: str = "") -> DataFrame:
    """Replace (or, with ``prefix``, add) each scaled feature.

    ``scaler`` is the table of :func:`fit_scaler` or its collected rows, one per feature.
    """
    rows = scaler if isinstance(scaler, list) else scaler.collect()
    scaled = {
        f"{prefix}{r['feature']}": (F.col(r["feature"]) - F.lit(r["mean"])) / F.lit(r["scale"])
        for r in rows
    }
    return df.withColumns(scaled)


def prepare_points(
    feature_matrix: DataFrame, key: str = "customer_hash", scaler: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Key and scaled features of every customer, and the scaler for later reuse."""
    gated = require_features(feature_matrix, S.SEGMENT_FEATURES)
    raw = gated.select(key, *S.SEGMENT_FEATURES)
    scaler = fit_scaler(raw) if scaler is None else scaler
    return apply_scaler(raw, scaler), scaler


# --- K-Means: every k and every start share one scan per iteration -----------
def _matrix(batch: pa.RecordBatch, features: Sequence[str]) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in features])


def _nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the closest centroid of each point."""
    gaps = (points**2).sum(1)[:, None] - 2 * points @ centroids.T + (centroids**2).sum(1)[None, :]
    labels = gaps.argmin(1)
    return labels, np.maximum(gaps[np.arange(len(points)), labels], 0.0)


class Stacked:
    """Sums by nearest centroid for many models at once: one product for all distances, one for all sums."""

    def __init__(self, models: dict[int, np.ndarray]):
        # Models of equal k stand side by side, so their centroids are compared in whole arrays.
        self.order = sorted(models, key=lambda m: len(models[m]))
        self.sizes = [len(models[m]) for m in self.order]
        self.centroids = np.vstack([models[m] for m in self.order])
        self.factors = np.column_stack([-2.0 * self.centroids, (self.centroids**2).sum(1)])
        self.sums = np.zeros((len(self.centroids), 2 + self.centroids.shape[1]))

    def add(self, x: np.ndarray) -> None:
        # Squared distances, but for the point's own square, which no centroid changes.
        gaps = self.factors @ np.vstack([x.T, np.ones(len(x))])
        member = np.empty(gaps.shape)
        at = 0
        for k in sorted(set(self.sizes)):
            upto = at + k * self.sizes.count(k)
            mine = gaps[at:upto].reshape(-1, k, len(x))
            nearest = mine == mine.min(axis=1)[:, None]
            if np.count_nonzero(nearest) != len(mine) * len(x):  # of equally near ones the first
                nearest = mine.argmin(axis=1)[:, None] == np.arange(k)[:, None]
            member[at:upto] = nearest.reshape(-1, len(x))
            at = upto
        self.sums += member @ np.column_stack([np.ones(len(x)), (x**2).sum(1), x])

    def totals(self) -> dict[int, np.ndarray]:
        """Model -> per cluster: size, inertia and feature sums."""
        found = self.sums.copy()
        # Sum of |x - c|^2 = squares - 2 c.S + n |c|^2
        found[:, 1] += (self.factors * np.column_stack([found[:, 2:], found[:, 0]])).sum(1)
        found[:, 1] = np.maximum(found[:, 1], 0.0)
        return dict(zip(self.order, np.split(found, np.cumsum(self.sizes)[:-1]), strict=True))


def _assignment_sums(
    points: DataFrame, features: list[str], models: dict[int, np.ndarray]
) -> DataFrame:
    """Rows of (model, cluster): size, inertia part and feature sums.

    Each task reduces its points to one row per cluster; a shuffle adds those up.
    """
    schema = "model int, cluster int, n bigint, inertia double, " + ", ".join(
        f"s{i} double" for i in range(len(features))
    )
    names = [part.strip().split(" ")[0] for part in schema.split(",")]

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stacked = Stacked(models)
        for batch in batches:
            x = _matrix(batch, features)
            for start in range(0, len(x), BLOCK):
                stacked.add(x[start : start + BLOCK])
        totals = stacked.totals()
        rows = [
            (m, c, int(v[0]), *v[1:].tolist()) for m, t in totals.items() for c, v in enumerate(t)
        ]
        columns = list(zip(*rows, strict=True))
        kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.float64()] * (1 + len(features))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(columns, kinds, strict=True)], names=names
        )

    partial = points.select(*features).mapInArrow(reduce, schema)
    return partial.groupBy("model", "cluster").agg(*[F.sum(c).alias(c) for c in names[2:]])


def _collect_sums(sums: DataFrame, models: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Bounded: one row per cluster of each model."""
    found = {m: np.zeros((len(c), 2 + c.shape[1])) for m, c in models.items()}
    for row in sums.collect():
        found[row["model"]][row["cluster"]] = np.array(list(row)[2:], dtype=float)
    return found


def _batch_sums(x: np.ndarray, centroids: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """Per cluster: size, inertia and feature sums of one block of (weighted) points."""
    labels, gaps = _nearest(x, centroids)
    k = len(centroids)
    w = np.ones(len(x)) if weights is None else weights
    columns = [np.bincount(labels, weights=w, minlength=k), np.bincount(labels, weights=w * gaps, minlength=k)]
    columns += [np.bincount(labels, weights=w * x[:, j], minlength=k) for j in range(x.shape[1])]
    return np.column_stack(columns)


def _moved(centroids: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, bool]:
    """Centroids at their cluster means (an empty cluster stays), and if any moved."""
    filled = sums[:, 0] > 0
    updated = centroids.copy()
    updated[filled] = sums[filled, 2:] / sums[filled, :1]
    return updated, ((updated - centroids) ** 2).sum() > SHIFT_TOLERANCE


def _candidates(
    points: DataFrame, features: list[str], per_round: int, seed: int
) -> tuple[np.ndarray, np.ndarray]:
    """Candidate starts drawn from the whole table, and how many points each is nearest to.

    k-means|| (Bahmani et al. 2012): every round scans all points and draws some with
    a chance in proportion to their squared distance from the candidates so far. The
    draw keeps the smallest keys -log(u)/d^2 with u from a hash of the row, which
    needs no total beforehand and does not depend on the partitioning. Bounded: at
    most 1 + rounds x ``per_round`` candidates.
    """
    first = points.orderBy("draw", *features).select(*features).limit(1).collect()
    if not first:
        return np.zeros((0, len(features))), np.zeros(0)
    found = np.array([list(first[0])], dtype=float)
    schema = "key double, " + ", ".join(f"`{c}` double" for c in features)

    for number in range(CANDIDATE_ROUNDS):
        centres = found

        def pick(batches: Iterator[pa.RecordBatch], centres=centres, number=number) -> Iterator[pa.RecordBatch]:
            best = np.zeros((0, 1 + len(features)))
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _matrix(batch, features)
                gaps = _nearest(x, centres)[1]
                mixed = _mixed(batch.column("draw").to_numpy(zero_copy_only=False), seed + number)
                far = gaps > 1e-12
                keys = -np.log(mixed[far]) / gaps[far]
                best = np.vstack([best, np.column_stack([keys, x[far]])])
                best = best[np.argsort(best[:, 0], kind="stable")[:per_round]]
            names = ["key", *features]
            yield pa.RecordBatch.from_arrays([pa.array(best[:, i]) for i in range(len(names))], names=names)

        drawn = points.select("draw", *features).mapInArrow(pick, schema)
        rows = drawn.orderBy("key", *features).limit(per_round).collect()
        if not rows:
            break
        found = np.vstack([found, np.array([list(r)[1:] for r in rows], dtype=float)])
    sums = _collect_sums(_assignment_sums(points, features, {0: found}), {0: found})
    return found, sums[0][:, 0]


def _mixed(draw: np.ndarray, seed: int) -> np.ndarray:
    """Uniform numbers in (0, 1] from 64-bit hashes and a seed (a finalising bit mix)."""
    z = draw.astype(np.int64).view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 1) % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / float(1 << 53) + 2.0**-54


def _starting_centroids(pool: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ (Arthur and Vassilvitskii 2007) on the weighted candidates, refined on them."""
    chosen = [pool[rng.choice(len(pool), p=weights / weights.sum())]]
    nearest = weights * ((pool - chosen[0]) ** 2).sum(1)
    for _ in range(1, k):
        total = nearest.sum()
        pick = rng.choice(len(pool), p=nearest / total) if total > 0 else rng.integers(len(pool))
        chosen.append(pool[pick])
        nearest = np.minimum(nearest, weights * ((pool - chosen[-1]) ** 2).sum(1))
    centroids, moving = np.array(chosen), True
    for _ in range(MAX_ITERATIONS):
        if not moving:
            break
        centroids, moving = _moved(centroids, _batch_sums(pool, centroids, weights))
    return centroids


@dataclass
class KMeansFit:
    """Centroids of the best start for one k."""

    k: int
    centroids: np.ndarray
    inertia: float

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, [float(v) for v in c]) for i, c in enumerate(self.centroids)]
        return spark.createDataFrame(rows, CENTROID_SCHEMA).coalesce(1)


def fit_kmeans(
    points: DataFrame,
    ks: Sequence[int],
    seed: int = S.SEED,
    starts: int = S.KMEANS_STARTS,
    features: Sequence[str] = S.SEGMENT_FEATURES,
    key: str = "customer_hash",
    max_iterations: int = MAX_ITERATIONS,
) -> dict[int, KMeansFit]:
    """Lloyd's algorithm for all ``ks`` with ``starts`` starts each, best inertia per k.

    All models advance together: one iteration is one scan that assigns every row
    to every still-moving model, instead of one scan per k and start. The driver
    only holds centroids. Starts come from candidates drawn over the whole table, by
    a hash of the key, so a seed gives the same models however the table is
    partitioned.
    """
    features = list(features)
    draw = F.xxhash64(F.col(key), F.lit(seed)).alias("draw")
    points = spread(points.select(draw, *features), "draw", *features).persist(StorageLevel.MEMORY_AND_DISK)
    models: dict[int, np.ndarray] = {}
    k_of: dict[int, int] = {}
    try:
        pool, weights = _candidates(points, features, max(CANDIDATES, 2 * max(ks)), seed)
        if weights.sum() < max(ks):
            raise ValueError(f"cannot fit {max(ks)} clusters to {int(weights.sum())} rows")
        for k in ks:
            for s in range(starts):
                rng = np.random.default_rng([seed, k, s])
                k_of[len(models)] = k
                models[len(models)] = _starting_centroids(pool, weights, k, rng)
        moving = dict(models)
        for _ in range(max_iterations):
            sums = _collect_sums(_assignment_sums(points, features, moving), moving)
            for m, total in sums.items():
                models[m], still = _moved(models[m], total)
                if still:
                    moving[m] = models[m]
                else:
                    del moving[m]
            if not moving:
                break
        final = _collect_sums(_assignment_sums(points, features, models), models)
    finally:
        points.unpersist()
    best: dict[int, KMeansFit] = {}
    for m, total in final.items():
        fit = KMeansFit(k_of[m], models[m], float(total[:, 1].sum()))
        if fit.k not in best or fit.inertia < best[fit.k].inertia:
            best[fit.k] = fit
    return best


def nearest_cluster(centroids: Sequence[Sequence[float]], features: Sequence[str]) -> Column:
    """Index of the closest centroid, as one generated-code expression."""
    distances = []
    for centre in centroids:
        gaps = [F.col(c) - F.lit(float(v)) for c, v in zip(features, centre, strict=True)]
        terms = [g * g for g in gaps]
        distances.append(sum(terms[1:], terms[0]))
    if len(distances) == 1:
        return F.lit(0)
    all_distances = F.array(*distances)
    return (F.array_position(all_distances, F.array_min(all_distances)) - 1).cast("int")


def read_centroids(centroids: DataFrame) -> list[list[float]]:
    """Bounded: one row per cluster."""
    return [list(r["centroid"]) for r in sorted(centroids.collect(), key=lambda r: r["cluster_id"])]


def assign_clusters(
    points: DataFrame, centroids: DataFrame, features: Sequence[str] = S.SEGMENT_FEATURES
) -> DataFrame:
    """Add ``cluster_id`` of the nearest centroid to scaled points."""
    return points.withColumn("cluster_id", nearest_cluster(read_centroids(centroids), features))


# --- quality of given labels ---------------------------------------------------
def cluster_quality(
    labelled: DataFrame, features: Sequence[str], label_columns: dict[int, str]
) -> DataFrame:
    """Inertia, silhouette and Davies-Bouldin of several labelings in three passes.

    ``label_columns`` maps k to the column holding its cluster number. The
    silhouette uses squared Euclidean distance: the mean squared distance to a
    whole cluster follows from its count, sum and sum of squares, so the measure is
    exact over all rows and linear in them. Returns ``k_values, inertias,
    silhouette_scores, davies_bouldin_scores`` (silhouette null with one cluster).
    """
    features = list(features)
    fold = F.aggregate
    squares = sum([F.col(c) * F.col(c) for c in features[1:]], F.col(features[0]) * F.col(features[0]))
    labels = F.array(
        *[F.struct(F.lit(k).alias("k"), F.col(c).alias("cluster")) for k, c in label_columns.items()]
    )
    long = labelled.select(
        F.array(*[F.col(c).cast("double") for c in features]).alias("x"),
        *features,
        squares.alias("sq"),
        F.inline(labels),
    ).where(F.col("cluster").isNotNull())
    shapes = long.groupBy("k", "cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(c) for c in features]).alias("total"),
        F.sum("sq").alias("sq_total"),
    )
    # One row per k with the shapes of its clusters: bounded by the label counts.
    per_k = shapes.groupBy("k").agg(
        F.array_sort(F.collect_list(F.struct("cluster", "n", "total", "sq_total"))).alias("shapes")
    )

    def dot(a: Column, b: Column) -> Column:
        return fold(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)

    own = F.filter("shapes", lambda s: s["cluster"] == F.col("cluster"))[0]
    own_n = F.col("own")["n"]
    # Sum over the cluster of |x - y|^2 = n|x|^2 - 2 x.S + Q
    spread = F.transform(
        "shapes",
        lambda s: F.struct(
            s["cluster"].alias("cluster"),
            s["n"].alias("n"),
            (F.col("sq") * s["n"] - 2 * dot(F.col("x"), s["total"]) + s["sq_total"]).alias("sum"),
        ),
    )
    a = F.filter("spread", lambda s: s["cluster"] == F.col("cluster"))[0]["sum"] / (own_n - 1)
    b = F.array_min(
        F.transform(
            F.filter("spread", lambda s: s["cluster"] != F.col("cluster")), lambda s: s["sum"] / s["n"]
        )
    )
    measured = (
        long.join(F.broadcast(per_k), "k")
        .withColumns({"own": own, "spread": spread})
        .withColumns(
            {
                "a": F.when(own_n > 1, a),
                "b": b,
                "gap": fold(
                    F.zip_with("x", F.col("own")["total"], lambda p, q: (p - q / own_n) * (p - q / own_n)),
                    F.lit(0.0),
                    lambda acc, v: acc + v,
                ),
            }
        )
    )
    silhouette = F.when(own_n == 1, F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    )
    per_cluster = measured.groupBy("k", "cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("gap").alias("inertia"),
        F.avg(F.sqrt("gap")).alias("scatter"),
        F.sum(silhouette).alias("silhouette"),
    )
    # One row per k and cluster on both sides.
    centres = shapes.select("k", "cluster", F.transform("total", lambda v: v / F.col("n")).alias("centre"))
    gathered = (
        per_cluster.join(F.broadcast(centres), ["k", "cluster"])
        .groupBy("k")
        .agg(
            F.sum("inertia").alias("inertias"),
            (F.sum("silhouette") / F.sum("n")).alias("silhouette_scores"),
            F.collect_list(F.struct("cluster", "scatter", "centre")).alias("c"),
        )
    )

    def overlap(i: Column, j: Column) -> Column:
        apart = F.sqrt(
            fold(
                F.zip_with(i["centre"], j["centre"], lambda p, q: (p - q) * (p - q)),
                F.lit(0.0),
                lambda acc, v: acc + v,
            )
        )
        return F.coalesce(F.try_divide(i["scatter"] + j["scatter"], apart), F.lit(0.0))

    worst = F.transform(
        "c",
        lambda i: F.array_max(
            F.transform(F.filter("c", lambda j: j["cluster"] != i["cluster"]), lambda j: overlap(i, j))
        ),
    )
    several = F.size("c") > 1
    mean_worst = fold(worst, F.lit(0.0), lambda acc, v: acc + v) / F.size("c")
    return gathered.select(
        F.col("k").cast("int").alias("k_values"),
        "inertias",
        F.when(several, F.col("silhouette_scores")).alias("silhouette_scores"),
        F.when(several, mean_worst).alias("davies_bouldin_scores"),
    )


def find_optimal_k(
    points: DataFrame,
    k_min: int = S.K_MIN,
    k_max: int = S.K_MAX,
    seed: int = S.SEED,
    starts: int = S.KMEANS_STARTS,
    key: str = "customer_hash",
) -> tuple[DataFrame, dict[int, KMeansFit]]:
    """Quality table for each k in ``k_min..k_max`` and the fitted models.

    ``silhouette_scores`` is the squared-distance silhouette of :func:`cluster_quality`,
    which is linear in the rows; the k it prefers can differ from that of the plain one.
    """
    fits = fit_kmeans(points, range(k_min, k_max + 1), seed, starts, key=key)
    columns = {k: f"_c{k}" for k in fits}
    labelled = points.select(
        *S.SEGMENT_FEATURES,
        *[nearest_cluster(f.centroids, S.SEGMENT_FEATURES).alias(columns[k]) for k, f in fits.items()],
    )
    quality = cluster_quality(labelled, S.SEGMENT_FEATURES, columns)
    names = ["k_values", "inertias", "silhouette_scores", "davies_bouldin_scores"]
    return quality.select(*names).orderBy("k_values"), fits


def select_optimal_k(k_analysis: DataFrame, default: int = S.DEFAULT_CLUSTERS) -> DataFrame:
    """One row ``k``: the smallest k with the highest silhouette, or the default."""
    best = F.max_by("k_values", F.struct("silhouette_scores", -F.col("k_values")))
    return k_analysis.where(F.col("silhouette_scores").isNotNull()).agg(
        F.coalesce(best, F.lit(default)).cast("int").alias("k")
    )


def train_kmeans(
    points: DataFrame, k: int, seed: int = S.SEED, starts: int = S.KMEANS_STARTS, key: str = "customer_hash"
) -> tuple[DataFrame, DataFrame]:
    """Centroid table of the best of ``starts`` fits, and a one-row metrics table."""
    fit = fit_kmeans(points, [k], seed, starts, key=key)[k]
    centroids = fit.to_frame(points.sparkSession)
    labelled = assign_clusters(points, centroids)
    metrics = cluster_quality(labelled, S.SEGMENT_FEATURES, {k: "cluster_id"}).select(
        F.col("silhouette_scores").alias("silhouette_score"),
        F.col("davies_bouldin_scores").alias("davies_bouldin_score"),
        F.col("inertias").alias("inertia"),
        F.col("k_values").cast("double").alias("n_clusters"),
    )
    return centroids, metrics


# --- labels and profiles -------------------------------------------------------
def cluster_profiles(feature_matrix: DataFrame, clusters: DataFrame, key: str = "customer_hash") -> DataFrame:
    """Mean of the raw features per cluster."""
    joined = feature_matrix.select(key, *S.SEGMENT_FEATURES).join(
        clusters.select(key, "cluster_id"), key
    )
    return joined.groupBy("cluster_id").agg(*[F.avg(c).alias(c) for c in S.SEGMENT_FEATURES])


def feature_percentiles(
    feature_matrix: DataFrame, features: Sequence[str] = S.SEGMENT_FEATURES
) -> DataFrame:
    """``feature, p25, p50, p75, p90`` with linear interpolation, exact over all rows."""
    long = selected_quantiles(feature_matrix, features, QUANTILE_SHARES)
    return long.groupBy("feature").agg(
        *[
            F.max(F.when(F.col("share") == s, F.col("value"))).alias(f"p{round(s * 100)}")
            for s in QUANTILE_SHARES
        ]
    )


def label_clusters(profiles: DataFrame, percentiles: DataFrame) -> DataFrame:
    """``cluster_id, segment_label`` by additive rules on the cluster means.

    The label with most points wins; ties, and clusters where no rule fires, go to
    the first label in the declared order.
    """
    # One row: the three features' percentiles as a map of structs.
    marks = percentiles.agg(
        F.map_from_entries(
            F.collect_list(F.struct("feature", F.struct("p25", "p50", "p75", "p90")))
        ).alias("m")
    ).scalar()
    r, f, m = F.col("recency_days"), F.col("frequency"), F.col("monetary_total")

    def mark(feature: str, name: str) -> Column:
        return marks[feature][name]

    low_r, mid_r, top_r = (mark("recency_days", p) for p in ("p25", "p50", "p90"))
    low_f, mid_f, high_f = (mark("frequency", p) for p in ("p25", "p50", "p75"))
    rules = {
        "champions": (3, (f >= high_f) & (m >= mark("monetary_total", "p75")) & (r <= low_r)),
        "loyal": (2, f >= mid_f),
        "at_risk": (2, (f >= low_f) & (r >= mid_r)),
        "new_customers": (2, (f <= 2) & (r <= mid_r)),
        "hibernating": (2, (f <= mid_f) & (r >= mid_r)),
        "lost": (3, (r >= top_r) & (f <= low_f)),
    }
    points = F.array(
        *[F.when(rules[s][1], F.lit(rules[s][0])).otherwise(F.lit(0)) for s in S.SEGMENT_LABELS]
    )
    names = F.array(*[F.lit(s) for s in S.SEGMENT_LABELS])
    best = F.array_position(points, F.array_max(points)).cast("int")
    return profiles.select("cluster_id", F.element_at(names, best).alias("segment_label"))


def assign_segments(
    feature_matrix: DataFrame, clusters: DataFrame, key: str = "customer_hash"
) -> DataFrame:
    """``customer_hash, cluster_id, segment_label`` for every clustered customer."""
    labels = label_clusters(
        cluster_profiles(feature_matrix, clusters, key),
        feature_percentiles(feature_matrix, ["recency_days", "frequency", "monetary_total"]),
    )
    # One row per cluster.
    return clusters.join(F.broadcast(labels), "cluster_id").select(key, "cluster_id", "segment_label")


def segment_profiles(
    feature_matrix: DataFrame, assignments: DataFrame, key: str = "customer_hash"
) -> DataFrame:
    """Size and means per label, highest mean spend first."""
    joined = feature_matrix.drop("segment_label").join(
        assignments.select(key, "segment_label"), key
    )
    return (
        joined.groupBy("segment_label")
        .agg(
            F.count(key).alias("count"),
            F.avg("recency_days").alias("avg_recency_days"),
            F.avg("frequency").alias("avg_frequency"),
            F.avg("monetary_total").alias("avg_monetary_total"),
            F.avg("monetary_avg").alias("avg_monetary_avg"),
            F.avg("avg_review_score").alias("avg_review_score"),
            F.avg("late_delivery_rate").alias("avg_late_delivery_rate"),
        )
        .orderBy(F.desc("avg_monetary_total"), "segment_label")
    )


def project_clusters(
    assigned: DataFrame, features: Sequence[str] = S.SEGMENT_FEATURES, key: str = "customer_hash"
) -> DataFrame:
    """Two principal components of the scaled features of every clustered customer."""
    vectors = VectorAssembler(inputCols=list(features), outputCol="v").transform(assigned)
    projected = PCA(k=2, inputCol="v", outputCol="p").fit(vectors).transform(vectors)
    parts = vector_to_array("p")
    return projected.select(key, "cluster_id", parts[0].alias("pc1"), parts[1].alias("pc2"))
