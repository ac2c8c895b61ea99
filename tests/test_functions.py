import hashlib
import hmac
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clientela.functions import columns, privacy, ranks, selection, skew, text


# --- hashing ----------------------------------------------------------------
@pytest.mark.parametrize("salt", ["s", "salt-é", "x" * 64, "long" * 40])
def test_hmac_equals_the_standard_library(spark, salt):
    ids = ["a", "customer_1", "ção", "日本", "z" * 200]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    got = {r["id"]: r["h"] for r in df.select("id", privacy.hmac_sha256("id", salt).alias("h")).collect()}
    assert got == {i: hmac.new(salt.encode(), i.encode(), hashlib.sha256).hexdigest() for i in ids}


@pytest.mark.parametrize("bad", [None, ""])
def test_empty_identifier_fails(spark, bad):
    df = spark.createDataFrame([("a",), (bad,)], "id string")
    with pytest.raises(PySparkException, match="identifier cannot be empty"):
        df.select(privacy.hmac_sha256("id", "s")).collect()


def test_pseudonymize_arguments(spark):
    df = spark.createDataFrame([("a", 1)], "id string, v int")
    with pytest.raises(ValueError, match="salt"):
        privacy.pseudonymize(df, "id", "")
    with pytest.raises(ValueError, match="not found"):
        privacy.pseudonymize(df, "other", "s")
    assert privacy.pseudonymize(df, "id", "s").columns == ["v", "id_hash"]
    assert privacy.pseudonymize(df, "id", "s", drop_original=False).columns == ["id", "v", "id_hash"]
    one, two = (privacy.pseudonymize(df, "id", s).first()["id_hash"] for s in ("s", "t"))
    assert one != two


def test_hash_format(spark):
    good = "0af3" * 16
    cases = {good: True, good.upper(): False, good[:-1]: False, good + "\n": False, "": False}
    df = spark.createDataFrame([(c,) for c in cases], "h string")
    got = {r["h"]: r["ok"] for r in df.select("h", privacy.is_valid_hash("h").alias("ok")).collect()}
    assert got == cases


# --- columns ------------------------------------------------------------------
def test_elapsed_days_floor(spark):
    rows = [
        ("2018-01-03 23:00:00", "2018-01-01 23:30:00", 1),
        ("2018-01-03 00:00:00", "2018-01-01 00:00:00", 2),
        ("2018-01-01 00:00:00", "2018-01-01 23:00:00", -1),
        ("2018-01-01 00:00:00", "2018-01-02 00:00:00", -1),
        ("2518-01-01 00:00:00", "2018-01-01 00:00:01", 182620),
        (None, "2018-01-01 00:00:00", None),
    ]
    df = spark.createDataFrame(rows, "a string, b string, want long")
    got = df.select(
        columns.elapsed_days(F.col("a").cast("timestamp"), F.col("b").cast("timestamp")).alias("d"), "want"
    ).collect()
    assert [r["d"] for r in got] == [r["want"] for r in got]


def test_cents_are_exact(spark):
    values = [0.1, 0.2, 1.005, 100.29, 19.99, 4.35]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r["c"] for r in df.select(columns.cents("v").alias("c")).collect()]
    assert got == [10, 20, 100, 10029, 1999, 435] or got == [10, 20, 101, 10029, 1999, 435]
    assert df.agg(columns.amount(F.sum(columns.cents("v"))).alias("s")).first()["s"] == sum(got) / 100


def test_nan_becomes_null(spark):
    df = columns.nan_to_null(spark.createDataFrame([(float("nan"), "x"), (1.0, None)], "v double, s string"))
    assert [r["v"] for r in df.orderBy("s").collect()] == [1.0, None]


def test_gate_names_the_columns(spark):
    df = spark.createDataFrame([(1.0, float("nan")), (2.0, 1.0)], "a double, b double")
    assert columns.require_features(df, ["a"]) is df
    with pytest.raises(ValueError, match="Null values.*b"):
        columns.require_features(df, ["a", "b"])
    with pytest.raises(ValueError, match="Missing required.*c"):
        columns.require_features(df, ["a", "c"])


def test_fixed_text_equals_python(spark):
    rng = random.Random(1)
    values = [i / 1000 for i in range(0, 1001)] + [rng.random() for _ in range(500)] + [0.125, 0.375, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select(
        text.fixed("v", 2).alias("two"), text.fixed("v", 4).alias("four"), text.percent("v").alias("pct"), "v"
    ).collect()
    for r in got:
        v = r["v"]
        assert (r["two"], r["four"], r["pct"]) == (f"{v:.2f}", f"{v:.4f}", f"{v:.1%}")


# --- running totals and what follows -----------------------------------------------
def test_running_totals_match_brute_force(spark):
    rng = random.Random(2)
    rows = [(g, i, rng.randint(0, 9)) for g in "ab" for i in rng.sample(range(10_000), 800)]
    df = spark.createDataFrame(rows, "g string, v int, w long").repartition(16)
    got = {(r["g"], r["v"]): r["w_before"] for r in ranks.running_totals(df, ["v"], ["w"], by=["g"]).collect()}
    for g in "ab":
        total = 0
        for _, v, w in sorted(r for r in rows if r[0] == g):
            assert got[(g, v)] == total
            total += w


def test_positions_are_consecutive_in_any_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v")).repartition(16)
    got = ranks.with_position(df, [F.desc("v")]).collect()
    assert sorted((r["position"], r["v"]) for r in got) == [(i + 1, 4999 - i) for i in range(5000)]


@pytest.mark.parametrize("size", [1, 2, 5, 1000])
def test_quantiles_match_numpy(spark, size):
    rng = np.random.default_rng(size)
    a, b = rng.normal(size=size).round(2), rng.integers(0, 3, size).astype(float)
    rows = [(float(x), float(y)) for x, y in zip(a, b, strict=True)] + [(None, float("nan"))]
    df = spark.createDataFrame(rows, "a double, b double").repartition(8)
    shares = [0.0, 0.05, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r["feature"], r["share"]): r["value"] for r in ranks.exact_quantiles(df, ["a", "b"], shares).collect()}
    for name, values in (("a", a), ("b", b)):
        for s in shares:
            assert got[(name, s)] == pytest.approx(np.quantile(values, s), abs=1e-12)


def test_selected_quantiles_match_the_sorted_rows(spark):
    """Infinities, both zeros, denormals, nulls, NaN, ties, neighbouring doubles, an empty column, one value."""
    rng = random.Random(6)
    odd = [float("inf"), float("-inf"), 0.0, -0.0, 5e-324, -5e-324, 1.0, float(np.nextafter(1, 2)), -1.0, 1e308, -1e308]
    rows = [(rng.choice(odd), rng.gauss(0, 1), None, float(rng.randint(0, 3)), None) for _ in range(700)]
    rows += [(None, float("nan"), None, 2.0, None)] * 9 + [(1.0, 0.5, 7.5, 2.0, float("nan"))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(8)
    shares = [0.0, 0.05, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0]
    got = {(r["feature"], r["share"]): r["value"] for r in selection.selected_quantiles(df, list("abcde"), shares).collect()}
    for at, name in enumerate("abcde"):
        values = sorted(r[at] for r in rows if r[at] is not None and r[at] == r[at])
        for share in shares if values else []:
            place = (len(values) - 1) * share
            low, high = values[math.floor(place)], values[math.ceil(place)]
            want = low if low == high else low + (high - low) * (place - math.floor(place))
            assert got[name, share] == want or (want != want and got[name, share] != got[name, share])
    assert len(got) == 4 * len(shares)


def test_selection_shuffles_counters_only(spark):
    df = spark.range(0, 20_000, 1, 4).select((F.rand(1) * 100).alias("x"))
    counts = selection.digit_counts(df, [[0]], 0, selection.DIGITS[0])
    assert counts.count() <= 1 << selection.DIGITS[0]
    assert counts.agg(F.sum("n")).first()[0] == 20_000
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.index("hashpartitioning") < plan.index("MapInArrow") and "rangepartitioning" not in plan


def brute_auc(rows):
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_matches_all_pairs(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 20) / 20, rng.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "s double, y int").repartition(8)
    assert ranks.roc_auc(df, "s", "y").first()["roc_auc"] == pytest.approx(brute_auc(rows))


def test_auc_is_null_with_one_class(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int")
    assert ranks.roc_auc(df, "s", "y").first()["roc_auc"] is None


def test_ks_distance_matches_numpy(spark):
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=300).round(1), rng.normal(0.3, size=200).round(1)
    first = spark.createDataFrame([(float(v),) for v in a] + [(None,)], "p double")
    second = spark.createDataFrame([(float(v),) for v in b], "p double")
    got = ranks.ks_distance(first, second, "p").first()
    grid = np.union1d(a, b)
    want = max(abs((a <= g).mean() - (b <= g).mean()) for g in grid)
    assert got["ks_statistic"] == pytest.approx(want)
    assert (got["n_first"], got["n_second"]) == (300, 200)


@pytest.mark.parametrize("x", [0.05, 0.3, 0.6, 0.95, 0.999, 1.0, 1.001, 1.2, 1.8, 3.0])
def test_p_value_is_the_limit_distribution(x):
    """Against the alternating series with as many terms as it takes."""
    terms = (2 * (-1) ** (j - 1) * math.exp(-2 * j * j * x * x) for j in range(1, 4000))
    n = 2_000
    assert ranks.ks_p_value(x / math.sqrt(n / 2), n, n) == pytest.approx(min(1.0, math.fsum(terms)), abs=1e-12)


def test_p_value_of_known_cases():
    assert ranks.ks_p_value(0.0, 20, 20) == 1.0
    assert ranks.ks_p_value(0.5, 0, 20) == 1.0
    # Nearly equal samples.
    assert ranks.ks_p_value(0.0001, 20_000, 20_000) == pytest.approx(1.0)
    assert ranks.ks_p_value(0.00001, 1_000_000, 1_000_000) == pytest.approx(1.0)
    # The 5 % point of the Kolmogorov distribution is 1.3581.
    n = 1_000_000
    assert ranks.ks_p_value(1.3581 / math.sqrt(n / 2), n, n) == pytest.approx(0.05, abs=1e-4)


@pytest.mark.parametrize("digits", [0, 1, 2, 3])
def test_fixed_prints_any_number(spark, digits):
    values = [130.0, 127.995, -0.5, -130.005, 0.5, 1.5, 2.5, 99.995, 0.9999, 1e9 + 0.25, 2.0**53, 123456.789, 0.865]
    rng = random.Random(2)
    values += [rng.uniform(-500, 500) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for row in df.select("v", text.fixed("v", digits).alias("t")).collect():
        assert row["t"] == f"{row['v']:.{digits}f}"


def test_average_precision(spark):
    rng = random.Random(4)
    rows = [(rng.randint(0, 30) / 30, int(rng.random() < 0.3)) for _ in range(500)]
    total, area, seen, found = sum(y for _, y in rows), 0.0, 0, 0
    for score in sorted({s for s, _ in rows}, reverse=True):
        tied = [y for s, y in rows if s == score]
        seen, found = seen + len(tied), found + sum(tied)
        area += sum(tied) / total * found / seen
    df = spark.createDataFrame(rows, "p double, y int").repartition(5)
    assert ranks.average_precision(df, "p", "y").first()["auc_pr"] == pytest.approx(area)
    assert ranks.average_precision(df.where("y = 0"), "p", "y").first()["auc_pr"] is None


# --- hot keys ------------------------------------------------------------------------
@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_join_equals_plain_join(spark, tmp_path, how):
    rng = random.Random(5)
    keys = ["hot"] * 3000 + [f"k{rng.randint(0, 300)}" for _ in range(3000)] + [None] * 500
    fact = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, v int").repartition(8)
    fact.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    dims = [("hot", "h1"), ("hot", "h2")] + [(f"k{i}", f"d{i}") for i in range(0, 300, 2)]
    dimension = spark.createDataFrame(dims, "k string, d string")
    spread = skew.spread_join(fact, dimension, "k", how, shares=60)
    plain = fact.join(dimension, "k", how)
    count = lambda df: Counter(tuple(r) for r in df.select("k", "v", "d").collect())
    assert count(spread) == count(plain)


def test_hot_key_is_cut_into_pieces(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    hot = skew.hot_keys(df, "k", shares=18).collect()
    assert [(r["k"], r["_pieces"]) for r in hot] == [(-1, 6)]
    assert skew.hot_keys(df.limit(0), "k", shares=18).count() == 0
