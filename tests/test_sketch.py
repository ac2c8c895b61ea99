import numpy as np
import pytest

from clientela.functions import ranks, sketch
from clientela.functions.sketch import RankSketch
from clientela.operators import monitoring
from clientela.sources import publish

RNG = np.random.default_rng(5)
SAMPLES = {
    "spread": RNG.random(700),
    "ties": np.round(RNG.random(500), 1),
    "one value": np.full(300, 0.25),
    "signs": RNG.normal(size=401),
    "one row": np.array([0.5]),
}


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "p double")


def brute(values, parts):
    """Ranks of the values at every part's end, counted row by row."""
    ordered, n = np.sort(values), len(values)
    edges = sorted({ordered[max(1, -(-i * n // parts)) - 1] for i in range(parts + 1)})
    return [(e, (values < e).sum(), (values <= e).sum()) for e in edges]


def distance(a, b):
    at = np.concatenate([a, b])
    return max(abs((a <= x).mean() - (b <= x).mean()) for x in at)


def counted(values, edges):
    return np.array([(values < e).sum() for e in edges]), np.array([(values <= e).sum() for e in edges]), len(values)


@pytest.mark.parametrize("name", SAMPLES)
def test_sketch_matches_brute_force(spark, name):
    values = SAMPLES[name]
    got = RankSketch.of(frame(spark, values), "p", 16)
    want = brute(values, 16)
    assert list(zip(got.values, got.below_least, got.upto_least, strict=True)) == want
    assert got.rows == len(values) and len(got.values) <= 17 and got.slack <= 1 / 16
    again = RankSketch.from_frame(got.to_frame(spark))
    assert all((getattr(again, c) == getattr(got, c)).all() for c in ["values", *sketch.RANKS]) and again.rows == got.rows


def of(values, parts):
    e, below, upto = (np.array(c) for c in zip(*brute(values, parts), strict=True))
    return RankSketch(e, below, below, upto, upto, len(values))


def test_exact_distance_lies_within_the_bounds():
    for a in SAMPLES.values():
        for b in [*SAMPLES.values(), SAMPLES["spread"] ** 2, SAMPLES["ties"] + 0.05]:
            for parts in (1, 4, 32):
                s = of(a, parts)
                low, high = s.ks_bounds(*counted(b, s.values))
                assert low - 1e-12 <= distance(a, b) <= high + 1e-12
                assert high - low <= s.slack + 1e-12 <= 1 / parts + 2e-12


def test_merged_sketches_bound_the_union():
    b = SAMPLES["spread"] ** 2
    parts = [of(SAMPLES[n], 20) for n in ("spread", "ties", "one value")]
    whole = sketch.merged([*parts, RankSketch(*[np.zeros(0)] * 5, 0)])
    union = np.concatenate([SAMPLES[n] for n in ("spread", "ties", "one value")])
    assert whole.rows == len(union) and whole.slack <= max(s.slack for s in parts) + 1e-12
    for s, extra in ((whole, 0.0), (whole.thinned(20), 1 / 20)):
        for at, e in enumerate(s.values):
            assert s.below_least[at] <= (union < e).sum() <= s.below_most[at]
            assert s.upto_least[at] <= (union <= e).sum() <= s.upto_most[at]
        low, high = s.ks_bounds(*counted(b, s.values))
        assert low - 1e-12 <= distance(union, b) <= high + 1e-12 and high - low <= s.slack + 1e-12
        assert s.slack <= whole.slack + extra + 1e-12
    assert len(whole.thinned(8).values) <= 2 * 9 < len(whole.values)


def test_merging_nothing():
    assert sketch.merged([]).rows == 0 and sketch.merged([]).slack == 0.0
    assert sketch.merged([]).thinned().rows == 0


def test_bounds_of_tables_and_drift(spark):
    a, b = SAMPLES["spread"], SAMPLES["spread"] ** 1.6
    first, second = (frame(spark, v).withColumnRenamed("p", "churn_probability") for v in (a, b))
    stored = RankSketch.of(first, "churn_probability", 64).to_frame(spark)
    got = sketch.ks_bounds(stored, second, "churn_probability").first()
    exact = ranks.ks_distance(first, second, "churn_probability").first()["ks_statistic"]
    assert got["ks_low"] <= exact <= got["ks_high"]
    assert got["ks_high"] - got["ks_low"] <= got["slack"] + 1e-12 and got["slack"] <= 1 / 64
    assert (got["n_first"], got["n_second"]) == (700, 700)
    drift = monitoring.bounded_drift(stored, second).first()
    plain = monitoring.model_drift(first, second).first()
    assert drift["p_value_low"] <= plain["p_value"] <= drift["p_value_high"]
    assert drift["drift_detected"] == plain["drift_detected"]
    between = (got["ks_low"] + got["ks_high"]) / 2
    assert monitoring.bounded_drift(stored, second, threshold=between).first()["drift_detected"] is None


def test_empty_sides(spark):
    rows = frame(spark, SAMPLES["ties"]).withColumnRenamed("p", "churn_probability")
    nothing = RankSketch.of(rows.limit(0), "churn_probability").to_frame(spark)
    assert nothing.count() == 0
    assert monitoring.bounded_drift(nothing, rows).first()["status"] == "no_data"
    some = RankSketch.of(rows, "churn_probability").to_frame(spark)
    assert monitoring.bounded_drift(some, rows.limit(0)).first()["status"] == "no_data"
    assert monitoring.bounded_drift(some, rows).first()["drift_detected"] is False


def test_baseline_is_kept_as_a_sketch(spark, tmp_path):
    rows = frame(spark, SAMPLES["spread"]).withColumnRenamed("p", "churn_probability")
    stored, created = publish.sketch_or_create(rows, str(tmp_path / "root"), 8)
    again, created_again = publish.sketch_or_create(rows.limit(3), str(tmp_path / "root"), 8)
    assert (created, created_again) == (True, False)
    assert stored.count() == 9 and sorted(stored.collect()) == sorted(again.collect())
