from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.helpers import assert_same, bars, collected, walk
from voltide import schema as S
from voltide.operators import alerts, features, models, split
from voltide.session import stage, staging_path
from voltide.streaming import jobs


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(0, 1, 300), rng.normal(10, 5, 300)
    data = [("s", dt.datetime(2025, 1, 1) + dt.timedelta(hours=i), float(a[i]), float(b[i]), float(2 * a[i] - 0.3 * b[i] + rng.normal(0, 0.1)))
            for i in range(300)]
    frame = spark.createDataFrame(data, "symbol string, datetime timestamp_ntz, a double, b double, target_volatility double")
    splits = {"split": split.split_label(), "fold": split.block_fold(), "test_fold": split.expanding_fold()}
    return stage(split.with_splits(frame, splits), "rows")


def test_ridge_matches_the_closed_form(spark, rows):
    model = models.train_ridge(rows, ["a", "b"], alpha=1.0)
    frame = rows.toPandas()
    x = frame[["a", "b"]].to_numpy()
    q = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    x, y = (x - q[1]) / (q[2] - q[0]), frame["target_volatility"].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + np.eye(2), xc.T @ yc)
    expected = y.mean() + xc @ w
    got = model.transform(rows).toPandas()
    np.testing.assert_allclose(got["prediction"], expected, atol=1e-6)


def test_stack_beats_the_mean_and_survives_saving(spark, rows, tmp_path):
    small = {"maxIter": 3, "maxDepth": 3}
    model = models.train_stack(
        rows.where("split = 'train'"), ["a", "b"], folds=3,
        boosted={**models.BOOSTED, **small}, trees={**models.FOREST, "numTrees": 5, "maxDepth": 4},
        shallow={**models.SHALLOW, **small},
    )
    metrics = {r["split"]: r for r in models.evaluate(model, rows, ["a", "b"]).collect()}
    assert metrics["test"]["r2"] > 0.5 and metrics["test"]["n_features"] == 2
    path = str(tmp_path / "models")
    for version in ("20250102_000000", "20250101_000000"):
        models.save(model, path, version, ["a", "b"], {"rmse": metrics["test"]["rmse"]}, spark)
    loaded, name = models.load(spark, path)
    assert name == "20250102_000000"
    assert_same(collected(models.score(loaded, rows)), collected(models.score(model, rows)))
    assert models.versions(spark, path).count() == 2


def test_importance_and_cross_validation(spark, rows):
    model = models.fit(rows, ["a", "b"], models.forest({"numTrees": 5, "maxDepth": 3}), scale=False)
    table = models.feature_importance(model, ["a", "b"], spark).collect()
    assert len(table) == 2 and table[0]["importance"] <= table[1]["importance"]
    got = models.cross_validate(rows, lambda train: models.train_ridge(train, ["a", "b"])).first()
    assert got["folds"] == 5 and got["cv_rmse"] < 0.5


def test_fold_penalties_equal_the_closed_form(spark):
    n, alpha = 120, 50.0
    x = np.sin(np.arange(n) * 1.7)
    y = 3 * x + np.where(np.arange(n) < 60, 0.1, 2.0) * np.cos(np.arange(n) * 0.9)
    fold = np.where(np.arange(n) < 20, -1, (np.arange(n) - 20) // 20)
    table = spark.createDataFrame(
        [(float(a), float(b), int(f)) for a, b, f in zip(x, y, fold)], f"a double, {S.TARGET} double, test_fold int"
    )
    errors = []
    for f in range(5):
        train, test = fold < f, fold == f
        q1, center, q3 = np.quantile(x[train], [0.25, 0.5, 0.75])
        scaled = (x - center) / (q3 - q1)
        mean_x, mean_y = scaled[train].mean(), y[train].mean()
        dx = scaled[train] - mean_x
        slope = (dx * (y[train] - mean_y)).sum() / ((dx**2).sum() + alpha)
        errors.append(((y[test] - mean_y - slope * (scaled[test] - mean_x)) ** 2).mean())
    got = models.cross_validate(table, lambda train: models.train_ridge(train, ["a"], alpha)).first()
    assert got["cv_rmse"] == pytest.approx(np.mean(errors) ** 0.5, abs=1e-9)


def written(df, name, **options):
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    reader = df.sparkSession.readStream.schema(df.schema)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.parquet(path), path


def test_failing_sink_does_not_stop_the_others(spark):
    metrics = spark.createDataFrame(
        [(dt.datetime(2025, 1, 1), "drift_ratio", 0.9)], "ts timestamp_ntz, metric_name string, value double"
    )
    stream, _ = written(metrics, "metrics")
    seen = []

    def broken(fired, batch):
        raise RuntimeError("no connection")

    jobs.run_batches(stream, jobs.alert_writer([broken, lambda fired, batch: seen.append(fired.count())]), "alerts")
    assert seen == [2]


def test_stream_score_with_a_model(spark):
    rows = spark.createDataFrame(
        [(dt.datetime(2025, 1, 1, i), {"a": float(i), "z": 1.0}, float(i)) for i in range(20)],
        "datetime timestamp_ntz, features map<string,double>, target_volatility double",
    )
    from voltide.operators.scoring import align_features

    model = models.train_ridge(align_features(rows, ["a"]), ["a"])
    stream, _ = written(rows.drop("target_volatility"), "requests")
    got = jobs.run_to_table(jobs.score(stream, model.transform, ["a"], "v1", F.lit(1.0)), "scored")
    expected = model.transform(align_features(rows, ["a"])).agg(F.sum("prediction")).first()[0]
    assert got.count() == 20 and got.agg(F.sum("prediction")).first()[0] == pytest.approx(expected)


def test_default_alert_rules_are_untouched():
    assert [r.threshold for r in alerts.DEFAULT_RULES] == [0.5, 1.0, 0.2, 0.5, 0.05, 0.1]


def test_a_failed_durable_sink_fails_the_batch_after_the_others(spark):
    seen = []

    def broken(fired, batch):
        raise OSError("sink is away")

    metrics = spark.createDataFrame([(dt.datetime(2025, 1, 1), "drift_ratio", 0.9)], "ts timestamp_ntz, metric_name string, value double")
    write = jobs.alert_writer([jobs.durable(broken), lambda fired, batch: seen.append(fired.count())])
    with pytest.raises(OSError, match="away"):
        write(metrics, 0)
    assert seen == [2]
