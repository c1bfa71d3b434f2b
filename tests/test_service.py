"""Scoring, prediction log, alerts and service metrics."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltide.operators import alerts, evaluation, predlog, scoring, split, telemetry

T0 = dt.datetime(2025, 11, 1)


def log(spark, latencies, start=0):
    rows = [
        (i, T0 + dt.timedelta(seconds=i), 0.01 * i, float(v), (i % 10) / 10, i % 10 > 3, i % 4 == 0, "v1", "s")
        for i, v in enumerate(latencies, start)
    ]
    return spark.createDataFrame(
        rows,
        "id long, timestamp timestamp_ntz, prediction double, latency_ms double, drift_ratio double, "
        "drift_detected boolean, is_error boolean, model_version string, series string",
    )


def metric_rows(spark, **values):
    return spark.createDataFrame([(T0, k, v) for k, v in values.items()], "ts timestamp_ntz, metric_name string, value double")


def test_alignment(spark):
    maps = spark.createDataFrame([({"a": 1.0, "x": 9.0},), ({},)], "features map<string,double>")
    got = scoring.align_features(maps, ["b", "a"]).select("b", "a").collect()
    assert [tuple(r) for r in got] == [(0.0, 1.0), (0.0, 0.0)]


@pytest.mark.parametrize(
    ("p", "risk", "confidence"),
    [(0.0049, "Low", "High"), (0.005, "Medium", "Medium"), (0.0149, "Medium", "Medium"), (0.015, "High", "High")],
)
def test_risk(spark, p, risk, confidence):
    row = scoring.risk_level(spark.createDataFrame([(p,)], "prediction double")).first()
    assert (row["risk_level"], row["confidence"]) == (risk, confidence)
    assert f"({p:.4f} or {p * 100:.2f}%)" in row["interpretation"]


def test_range_drift(spark):
    inside = {"close_lag_1": 0.9, "log_return": 0.1, "hour_sin": -1.0}
    maps = spark.createDataFrame(
        [(1, inside), (2, {**inside, "close_lag_1": 2.0}), (3, {"close_lag_1": 2.0, "other": 5.0}), (4, {})],
        "id int, features map<string,double>",
    )
    got = {r["id"]: (r["drift_ratio"], r["drift_detected"]) for r in scoring.range_drift(maps).collect()}
    assert got[1] == (0.0, False) and got[2] == (pytest.approx(1 / 3), True)
    assert got[3] == (0.5, True) and got[4] == (0.0, False)


def test_records_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(T0, 0.01, {"a": 1.5})], "datetime timestamp_ntz, prediction double, features map<string,double>")
    records = scoring.score_records(rows, "v7", F.lit(12.5))
    assert records.columns == ["timestamp", "prediction", "features", "latency_ms", "drift_detected", "drift_ratio", "model_version"]
    scoring.append_records(records, str(tmp_path / "log"))
    scoring.append_records(records, str(tmp_path / "log"))
    stored = spark.read.parquet(str(tmp_path / "log"))
    assert stored.count() == 2 and stored.first()["features"] == '{"a":1.5}'


def test_log_statistics(spark):
    table = log(spark, range(1, 151))
    row = predlog.stats(table).first()
    assert row["total_predictions"] == 150
    assert row["avg_latency_ms"] == pytest.approx(sum(range(51, 151)) / 100)
    assert row["drift_alerts"] == sum(1 for i in range(50, 150) if i % 10 > 3) and row["model_accuracy"] == 0.0
    metrics = spark.createDataFrame([(18.26,)], "mape double")
    assert predlog.stats(table, metrics).first()["model_accuracy"] == 81.7
    empty = predlog.stats(table.limit(0)).first()
    assert tuple(empty) == (0, 0.0, 0, 0.0)


def test_log_views(spark):
    table = log(spark, range(1, 151))
    assert [r["timestamp"] for r in predlog.recent(table, 2).collect()] == [T0 + dt.timedelta(seconds=s) for s in (149, 148)]
    assert predlog.history(table).count() == 100
    scores = predlog.drift_history(table).collect()
    assert len(scores) == 24 and scores[0]["id"] == 126 and scores[-1]["score"] == 90.0
    assert [r["id"] for r in predlog.volatility_series(table, 3).collect()] == [147, 148, 149]


def test_latency_classes(spark):
    got = predlog.latency_distribution(log(spark, [9.99, 10, 24, 25, 49, 100, 500])).collect()
    assert [r["count"] for r in sorted(got, key=lambda r: r["position"])] == [1, 2, 2, 0, 2]
    assert predlog.latency_distribution(log(spark, [1.0]).limit(0)).count() == 0
    assert predlog.latency_distribution(log(spark, [1.0, 200.0]), last=1).where("count > 0").first()["bucket"] == ">100ms"


def test_rules(spark):
    assert len(alerts.DEFAULT_RULES) == 6
    changed = alerts.upsert_rule(alerts.DEFAULT_RULES, alerts.Rule("high_drift", "d", 1.0, "lt", "info", "x"))
    assert len(changed) == 6 and alerts.rule_table(spark, changed).where("name = 'high_drift'").first()["metric_name"] == "d"
    assert len(alerts.upsert_rule(changed, alerts.Rule("more", "d", 1.0, "lt", "info", "x"))) == 7
    assert len(alerts.remove_rule(changed, "high_drift")) == 5 and len(alerts.remove_rule(changed, "none")) == 6


def test_alerts_fire(spark):
    assert [r["name"] for r in alerts.evaluate(metric_rows(spark, prediction_latency_seconds=0.8)).collect()] == ["high_latency"]
    two = alerts.evaluate(metric_rows(spark, prediction_latency_seconds=1.2, drift_ratio=0.2)).collect()
    assert sorted(r["name"] for r in two) == ["critical_latency", "high_latency"]
    message = {r["name"]: r["message"] for r in two}
    assert message["high_latency"] == "Prediction latency (1.200s) exceeds threshold (0.500s)"
    drifted = alerts.evaluate(metric_rows(spark, drift_ratio=0.256, rmse_increase_pct=0.25)).collect()
    assert {r["message"] for r in drifted} == {
        "Data drift ratio (25.60%) exceeds threshold (20.00%)",
        "Model RMSE increased by 25.0%, exceeds threshold (10.0%)",
    }


@pytest.mark.parametrize(("how", "fires"), [("gt", [3]), ("gte", [2, 3]), ("lt", [1]), ("lte", [1, 2]), ("ne", [])])
def test_comparisons(spark, how, fires):
    rows = spark.createDataFrame([(T0, "m", float(v)) for v in (1, 2, 3)], "ts timestamp_ntz, metric_name string, value double")
    fired = alerts.evaluate(rows, [alerts.Rule("r", "m", 2.0, how, "info", "{value}")]).collect()
    assert sorted(r["metric_value"] for r in fired) == fires


def test_history_and_summary(spark):
    rows = spark.createDataFrame(
        [(T0 + dt.timedelta(hours=i), "prediction_latency_seconds", v) for i, v in enumerate((0.6, 1.5, 0.1))],
        "ts timestamp_ntz, metric_name string, value double",
    )
    fired = alerts.evaluate(rows)
    assert [r["name"] for r in alerts.history(fired).collect()] == ["high_latency", "critical_latency", "high_latency"]
    assert alerts.history(fired, "critical").count() == 1 and alerts.history(fired, limit=1).first()["ts"].hour == 1
    got = {(r["scope"], r["label"]): r["count"] for r in alerts.summary(fired).collect()}
    assert got == {
        ("total", "all"): 3, ("severity", "info"): 0, ("severity", "warning"): 2, ("severity", "critical"): 1,
        ("metric", "prediction_latency_seconds"): 3,
    }
    nothing = {(r["scope"], r["label"]): r["count"] for r in alerts.summary(fired.limit(0)).collect()}
    assert nothing[("total", "all")] == 0 and len(nothing) == 4


def samples(spark, points, keys="s"):
    rows = [(keys, T0 + dt.timedelta(seconds=s), i, None if v is None else float(v)) for i, (s, v) in enumerate(points)]
    return spark.createDataFrame(rows, "series string, timestamp timestamp_ntz, id long, v double")


def test_counter_rate_with_reset(spark):
    points = [(0, 10), (60, 16), (310, 20), (320, 3), (330, 5)]
    got = {r["window_start"].minute: r["increase"] for r in
           telemetry.counter_rate(samples(spark, points), "v").collect()}
    assert got == {0: 6.0, 5: 4.0 + 3.0 + 2.0}


def test_rates(spark):
    table = log(spark, [1.0] * 90)
    slide = {r["window_start"]: r["requests"] for r in telemetry.request_rate(table, seconds=120, slide=60).collect()}
    assert [slide[k] for k in sorted(slide)] == [60, 90, 30]
    first = telemetry.error_rate(table, seconds=60).orderBy("window_start").first()
    assert (first["requests"], first["errors"], first["error_rate"]) == (60, 15, 0.25)


def test_low_rate_fills_empty_windows(spark):
    points = [(i * 10, 1.0) for i in range(60)] + [(200_000, 1.0)]
    got = telemetry.low_rate(samples(spark, points)).collect()
    starts = sorted(r["window_start"] for r in got)
    assert len(starts) == 333 and sum(r["requests"] for r in got) == 1
    assert starts[0] == T0 + dt.timedelta(minutes=10)


def test_histogram_quantile(spark):
    table = log(spark, [2, 7, 20, 30, 40, 60, 80, 200, 300, 5000])
    cells = telemetry.latency_histogram(table)
    by_bound = {r["le"]: r["cumulative"] for r in cells.collect()}
    assert by_bound[0.05] == 5 and by_bound[1.0] == 9 and by_bound[float("inf")] == 10
    assert telemetry.histogram_quantile(cells, 0.5).first()[0] == pytest.approx(0.05)
    assert telemetry.histogram_quantile(cells, 0.6).first()[0] == pytest.approx(0.05 + 0.05 * 0.5)
    assert telemetry.histogram_quantile(cells, 0.99).first()[0] == 1.0
    assert telemetry.histogram_quantile(telemetry.latency_histogram(table.limit(0)), 0.5).first()[0] is None


@pytest.mark.parametrize("chunk", [60, 86_400])
def test_sustained_and_gaps(spark, chunk):
    points = [(0, 1), (60, 1), (120, 0), (180, 1), (240, 1), (300, 1), (4200, None), (4300, 1)]
    table = samples(spark, points)
    held = telemetry.sustained(table, F.col("v") > 0, 120, ["series"], "timestamp", ["id"], chunk).collect()
    assert [(r["samples"], r["held_seconds"]) for r in held] == [(3, 120.0)]
    gaps = telemetry.service_gaps(table, 3600, chunk_seconds=chunk).collect()
    assert [(r["gap_seconds"], r["is_open"]) for r in gaps] == [(3900.0, False)]
    later = T0 + dt.timedelta(seconds=4300 + 7200)
    silent = telemetry.service_gaps(table, 3600, chunk_seconds=chunk, as_of=later).where("is_open").collect()
    assert [(r["gap_seconds"], r["resumed"]) for r in silent] == [(7200.0, None)]


def test_metrics_and_folds(spark):
    rows = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0), (None, 1.0)], "target_volatility double, prediction double")
    got = evaluation.regression_metrics(rows).first()
    assert got["rmse"] == pytest.approx((1.25 / 3) ** 0.5) and got["mae"] == pytest.approx(0.5)
    assert got["mape"] == pytest.approx(25.0) and got["r2"] == pytest.approx(1 - 1.25 / (14 / 3)) and got["samples"] == 3
    series = spark.createDataFrame([("a", T0 + dt.timedelta(hours=i), float(i)) for i in range(23)],
                                   "symbol string, datetime timestamp_ntz, x double")
    everything = split.with_splits(
        series, {"split": split.split_label(), "fold": split.block_fold(), "test_fold": split.expanding_fold()}, chunk_seconds=7200
    ).orderBy("x").collect()
    assert [r["split"] for r in everything].count("train") == 18
    assert [r["fold"] for r in everything] == [0] * 5 + [1] * 5 + [2] * 5 + [3] * 4 + [4] * 4
    assert [r["test_fold"] for r in everything] == [-1] * 8 + [0] * 3 + [1] * 3 + [2] * 3 + [3] * 3 + [4] * 3
    sizes = split.fold_sizes(split.expanding_folds(series)).orderBy("fold").collect()
    assert [(r["train_rows"], r["test_rows"]) for r in sizes] == [(8, 3), (11, 3), (14, 3), (17, 3), (20, 3)]


def test_robust_scale(spark):
    rows = spark.createDataFrame(
        [("train", 1.0, 5.0), ("train", 2.0, 5.0), ("train", 3.0, 5.0), ("train", 10.0, 5.0), ("test", 4.5, 6.0)],
        "split string, x double, flat double",
    )
    got = split.robust_scale(rows, ["x", "flat"]).where("split = 'test'").first()
    assert got["x"] == pytest.approx((4.5 - 2.5) / 3.0) and got["flat"] == 1.0


def test_promotion_and_retraining(spark):
    def table(**values):
        return spark.createDataFrame(list(values.items()), "metric string, value double")

    compared = evaluation.compare_metrics(table(rmse=1.2, mae=1.0), table(rmse=1.0, mae=2.0))
    got = {r["metric"]: r for r in compared.collect()}
    assert got["rmse"]["blocks_promotion"] is True and got["mae"]["relative_change"] == -0.5
    drifted = spark.createDataFrame([(0.1,)], "drift_ratio double")
    assert evaluation.retrain_decision(drifted, compared).first()["retrain"] is True
    calm = evaluation.compare_metrics(table(rmse=1.0), table(rmse=1.0))
    assert evaluation.retrain_decision(drifted, calm).first()["retrain"] is False
    runs = spark.createDataFrame([("a", 0.3, 0.5), ("b", 0.2, 0.6), ("c", 0.2, 0.7)], "model_version string, rmse double, r2 double")
    best = evaluation.best_runs(runs, 2).collect()
    assert {r["model_version"]: r["is_best"] for r in best} == {"b": False, "c": True}
    gate = evaluation.quality_gate(spark.createDataFrame([(19.0, 0.002, 34)], "mape double, rmse double, n_features int"))
    assert {r["metric"]: r["passed"] for r in gate.collect()} == {"mape": True, "rmse": False, "n_features": True}


def test_rules_with_hold_times(spark):
    values = [0.1, 0.3, 0.4, 0.1, 0.3, 0.1, 0.6, 0.7, 0.8]
    rows = [(T0 + dt.timedelta(seconds=60 * i), "drift_ratio", v) for i, v in enumerate(values)]
    table = spark.createDataFrame(rows, "ts timestamp_ntz, metric_name string, value double")
    rule = alerts.Rule("drift", "drift_ratio", 0.2, "gt", "warning", "{value}", "percent2", 60)
    for chunk in (120, 86_400):
        found = alerts.states(table, [rule], chunk_seconds=chunk).orderBy("pending_at").collect()
        assert [(r["state"], r["samples"]) for r in found] == [("resolved", 2), ("cleared", 1), ("firing", 3)]
        assert found[0]["fired_at"] == T0 + dt.timedelta(seconds=120)
        assert found[0]["resolved_at"] == T0 + dt.timedelta(seconds=180) and found[2]["resolved_at"] is None


def logged(spark, ids, start=dt.datetime(2024, 1, 1), hours=1):
    rows = [(i, start + dt.timedelta(hours=hours * i) if i is not None else None, 0.5, 1.0, False, 0.25) for i in ids]
    columns = "id long, timestamp timestamp_ntz, prediction double, latency_ms double, drift_detected boolean, drift_ratio double"
    return spark.createDataFrame(rows, columns)


def test_newest_of_the_log_reads_few_days(spark, tmp_path):
    path, schema = str(tmp_path), logged(spark, [1]).schema
    assert predlog.newest_logged(spark, path, 3, schema).count() == 0
    assert predlog.total(spark, path).first()[0] == 0
    predlog.append(logged(spark, range(240)), path)
    predlog.append(logged(spark, [*range(240, 300), None]), path)
    predlog.append(logged(spark, []), path)
    newest = predlog.newest_logged(spark, path, 20, schema)
    assert [r["id"] for r in newest.collect()] == list(range(299, 279, -1))
    assert {name.split("_day=")[1].split("/")[0] for name in newest.inputFiles()} == {"2024-01-12", "2024-01-13"}
    assert predlog.total(spark, path).first()[0] == 301
    assert predlog.newest_logged(spark, path, 1000, schema).count() == 301


def test_newest_of_the_log_with_late_ids(spark, tmp_path):
    path, ids = str(tmp_path), [7, 3, 250, 11, 90, 4, 180, 260, 1, 33]
    for part in (ids[:4], ids[4:7], ids[7:]):
        predlog.append(logged(spark, part, hours=-5), path)
    (tmp_path / "data" / "unfinished" / "_day=2030-01-01").mkdir(parents=True)  # left behind, in no line
    for n in (1, 3, 6, 10):
        got = predlog.newest_logged(spark, path, n, logged(spark, [1]).schema)
        assert [r["id"] for r in got.collect()] == sorted(ids, reverse=True)[:n]


def test_bucket_quantiles_with_resets_in_single_buckets(spark):
    at, inf = dt.datetime(2024, 1, 1), float("inf")
    steps = {0.1: [5, 9, 2, 4], 0.5: [6, 12, 14, 16], inf: [8, 14, 20, 3]}
    rows = [
        (s, le, at + dt.timedelta(seconds=20 * i), i, v) for s in (None, "b") for le, vs in steps.items() for i, v in enumerate(vs)
    ]
    df = spark.createDataFrame(rows, "series string, le double, timestamp timestamp_ntz, id long, cumulative long")
    # increases of one series: 4 + 2 + 2 = 8, 6 + 2 + 2 = 10, 6 + 6 + 3 = 15
    for phi, want in ((0.25, 0.1 * 3.75 / 8), (0.6, 0.1 + 0.4 * 1 / 2), (0.9, 0.5)):
        got = telemetry.bucket_quantiles(df, phi).collect()
        assert [(r["window_start"], round(r["quantile"], 12)) for r in got] == [(at, round(want, 12))]
    # a bucket below a smaller bound takes that bound's count: 8, 8 (counted 2), 15
    low = df.withColumn("cumulative", F.when(F.col("le") == 0.5, F.least("id", F.lit(2))).otherwise(F.col("cumulative")))
    assert telemetry.bucket_quantiles(low, 0.9).first()["quantile"] == 0.5
    assert round(telemetry.bucket_quantiles(low, 0.5, by=["series"]).first()["quantile"], 12) == round(0.1 * 7.5 / 8, 12)
    assert telemetry.bucket_quantiles(df.limit(0), 0.9).count() == 0
