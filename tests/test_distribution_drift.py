from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voltide.operators import distribution, drift, profile


def long(spark, samples: dict[str, np.ndarray], repartition: int = 4):
    rows = [(k, None if v is None else float(v)) for k, values in samples.items() for v in values]
    return spark.createDataFrame(rows, "feature string, value double").repartition(repartition)


def cdf(sample: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(np.sort(sample), at, side="right") / len(sample)


def brute_force(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    points = np.unique(np.concatenate([a, b]))
    gap = np.abs(cdf(a, points) - cdf(b, points))
    return gap.max(), float(np.sum(gap[:-1] * np.diff(points)))


@pytest.fixture(scope="module")
def samples():
    rng = np.random.default_rng(42)
    reference = {"f1": rng.normal(0, 1, 1000), "f2": rng.normal(100, 10, 1000), "f3": rng.uniform(0, 1, 1000)}
    rng = np.random.default_rng(43)
    current = {"f1": rng.normal(5, 1, 500), "f2": rng.normal(100, 10, 500), "f3": np.round(rng.uniform(0, 1, 500), 1)}
    return reference, current


def test_quantiles_match_numpy(spark, samples):
    probabilities = {"a": 0.0, "b": 0.1, "c": 0.25, "d": 0.5, "e": 0.999, "f": 1.0}
    values = {**samples[0], "ties": np.repeat([1.0, 2.0, 7.0], [5, 1, 9]), "one": np.array([3.5])}
    got = distribution.exact_quantiles(long(spark, values), ["feature"], "value", probabilities).collect()
    assert len(got) == len(values)
    for row in got:
        for name, p in probabilities.items():
            assert row[name] == pytest.approx(np.quantile(values[row["feature"]], p), abs=1e-12)


def test_ranked_values_span_slices(spark):
    """A key with nearly all rows is cut into several slices and still ranked as a whole."""
    rng = np.random.default_rng(1)
    values = np.round(rng.normal(0, 1, 20_000), 3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = distribution.ranked_values(long(spark, {"hot": values, "small": values[:10]}), ["feature"], "value")
        hot = ranked.where("feature = 'hot'").toPandas().sort_values("value")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    distinct, counts = np.unique(values + 0.0, return_counts=True)
    assert hot["value"].tolist() == distinct.tolist()
    assert hot["cum_n"].tolist() == np.cumsum(counts).tolist()
    assert set(hot["total_n"]) == {20_000}
    assert hot["next_value"].tolist()[:-1] == distinct[1:].tolist()
    assert math.isnan(hot["next_value"].iloc[-1])


def test_distances_match_brute_force(spark, samples):
    got = {r["feature"]: r for r in drift.compare(long(spark, samples[0]), long(spark, samples[1])).collect()}
    for name, reference in samples[0].items():
        ks, w = brute_force(reference, samples[1][name])
        assert got[name]["statistic"] == pytest.approx(ks, abs=1e-12)
        assert got[name]["wasserstein"] == pytest.approx(w, abs=1e-9)


def test_windows_against_one_reference(spark):
    """Every window equals a brute-force comparison, with ties, values outside the reference and single rows."""
    rng = np.random.default_rng(9)
    reference = {"x": np.round(rng.normal(0, 1, 300), 1), "y": rng.uniform(5, 6, 80)}
    windows = {
        ("a", "x"): np.round(rng.normal(0.2, 1, 120), 1), ("a", "y"): rng.uniform(5.5, 7, 30),
        ("b", "x"): np.array([-9.0, 9.0]), ("b", "y"): np.array([5.5]), ("c", "x"): np.full(15, 0.1),
        ("c", "y"): np.array([8.0, 9.0, 9.0]), ("d", "y"): np.array([1.0, 2.0]), ("d", "x"): reference["x"],
        ("d", "unknown"): np.array([1.0]),
    }
    rows = [(w, f, float(v)) for (w, f), values in windows.items() for v in values]
    current = spark.createDataFrame(rows, "w string, feature string, value double")
    got = {(r["w"], r["feature"]): r for r in drift.compare_windows(long(spark, reference), current, "w").collect()}
    assert set(got) == {k for k in windows if k[1] != "unknown"}
    for key, row in got.items():
        ks, distance = brute_force(reference[key[1]], windows[key])
        assert row["statistic"] == pytest.approx(ks, abs=1e-12), key
        assert row["wasserstein"] == pytest.approx(distance, abs=1e-9), key
        assert (row["n_ref"], row["n_cur"]) == (len(reference[key[1]]), len(windows[key]))


def test_drift_is_found_where_the_mean_moved(spark, samples):
    reference = long(spark, samples[0])
    verdicts = {r["feature_name"]: r["is_drift"] for r in drift.ks_drift(reference, long(spark, samples[1])).collect()}
    assert verdicts["f1"] is True and verdicts["f2"] is False
    same = drift.drift_metrics(reference, reference).first()
    assert same["num_drifted_features"] == 0 and same["total_features"] == 3
    assert same["max_wasserstein_distance"] == pytest.approx(0)
    moved = drift.drift_metrics(reference, long(spark, samples[1])).first()
    assert moved["drift_ratio"] > 0 and moved["max_wasserstein_distance"] == pytest.approx(5, abs=0.2)


def test_small_and_one_sided_features(spark):
    reference = long(spark, {"few": np.arange(50.0), "gone": np.arange(20.0)})
    current = long(spark, {"few": np.arange(9.0), "new": np.arange(30.0)})
    assert drift.ks_drift(reference, current).count() == 0
    assert [r["feature"] for r in drift.wasserstein(reference, current).collect()] == ["few"]
    empty = drift.drift_metrics(reference, current.limit(0)).first()
    assert (empty["drift_ratio"], empty["total_features"], empty["avg_wasserstein_distance"]) == (0.0, 0, 0.0)


def test_p_value_series(spark):
    row = spark.range(1).select(
        drift.ks_p_value(F.lit(0.1), F.lit(1000.0), F.lit(500.0)).alias("p"),
        drift.ks_p_value(F.lit(0.001), F.lit(100.0), F.lit(100.0)).alias("one"),
    ).first()
    x = 0.1 * math.sqrt(1000 * 500 / 1500)
    expected = 2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * x * x) for j in range(1, 101))
    assert row["p"] == pytest.approx(expected, rel=1e-9) and row["one"] == 1.0


def test_profile_and_point_drift(spark, samples):
    fitted = drift.fit_profile(long(spark, {**samples[0], "flat": np.ones(20)}))
    for name, values in samples[0].items():
        series, stats = pd.Series(values), fitted.statistics(name)
        assert stats["mean"] == pytest.approx(series.mean()) and stats["std"] == pytest.approx(series.std())
        assert stats["q1"] == pytest.approx(series.quantile(0.25)) and stats["median"] == pytest.approx(series.median())
    assert fitted.statistics("nothing") is None
    maps = spark.createDataFrame(
        [(1, {"f1": 0.5, "f2": 105.0, "f3": 0.5}), (2, {"f1": 10.0, "f2": 200.0, "f3": 5.0}),
         (3, {"unknown": 1.0}), (4, {"f1": 10.0, "flat": 99.0})],
        "id int, features map<string,double>",
    )
    got = {r["id"]: r for r in fitted.point_drift(maps).collect()}
    assert got[1]["point_drift_detected"] is False and got[1]["drifted_features"] == []
    assert got[2]["drifted_features"] == ["f1", "f2", "f3"] and got[2]["point_drift_ratio"] == 1.0
    assert got[3]["point_drift_ratio"] == 0.0
    assert got[4]["point_drift_ratio"] == 0.5  # no deviation: counted, never drifted
    with pytest.raises(ValueError, match="fit"):
        drift.DriftProfile({}).point_drift(maps)


def test_train_test_drift(spark):
    rng = np.random.default_rng(3)
    rows = [("train" if i < 400 else "test", float(rng.normal()), float(i)) for i in range(500)]
    split = spark.createDataFrame(rows, "split string, still double, trend double")
    got = drift.train_test_drift(split, ["still", "trend"]).first()
    assert (got["num_drifted_features"], got["total_features"], got["drift_ratio"]) == (1, 2, 0.5)


def test_profile_moments(spark):
    rng = np.random.default_rng(5)
    values = np.round(rng.gamma(2, 2, 500), 2)
    table = spark.createDataFrame([(float(v), 0.0) for v in values] + [(None, None)], "x double, zero double")
    got = {r["feature"]: r for r in profile.columns(table, ["x", "zero"]).collect()}
    d = values - values.mean()
    assert got["x"]["skewness"] == pytest.approx((d**3).mean() / (d**2).mean() ** 1.5)
    assert got["x"]["kurtosis"] == pytest.approx((d**4).mean() / (d**2).mean() ** 2 - 3)
    assert (got["x"]["count"], got["x"]["nulls"], got["x"]["n_distinct"]) == (500, 1, len(set(values)))
    assert got["zero"]["zeros"] == 500 and got["zero"]["skewness"] is None
    bins = profile.histogram(table, ["x", "zero"], 5).collect()
    assert sum(r["count"] for r in bins if r["feature"] == "x") == 500
    assert [r["count"] for r in bins if r["feature"] == "zero"] == [500]


def test_correlation_of_many_columns_with_gaps_and_constants(spark):
    rng = np.random.default_rng(4)
    frame = pd.DataFrame(rng.normal(size=(300, 5)), columns=list("abcde")) + 100
    frame["d"] = frame["a"] * 2 + frame["b"]
    frame["e"] = 7.1
    frame.loc[::7, "c"] = None
    rows = [tuple(None if pd.isna(v) else float(v) for v in row) for row in frame.itertuples(index=False)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(4)
    got = {(r.left_column, r.right_column): r.correlation for r in profile.correlation(df, list("abcde")).collect()}
    assert len(got) == 10
    want = frame.corr()
    for (a, b), value in got.items():
        assert value is None if "e" in (a, b) else abs(value - want.loc[a, b]) < 1e-9
