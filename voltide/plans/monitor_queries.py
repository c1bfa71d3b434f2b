"""Registered queries for the prediction log, drift, alerts, service metrics and profiles."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide import schema as S
from voltide.operators import alerts, drift, features, predlog, profile, split, telemetry
from voltide.operators import evaluation as E
from voltide.plans import views as V
from voltide.plans.feature_queries import ALL_COLUMNS, NOT_NULL, Query, feature_ctes, r, rcols, tidy
from voltide.session import stage, staging_path
from voltide.plans.model_queries import (
    COMPARED, FORECASTS, INDEXED, RUN_METRICS, RUNS, SPLIT, forecasts, metric_sql, samples,
)

DRIFT_FEATURES = S.FEATURES_WITH_VOLATILITY


def _split_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir).select("symbol", "datetime", *DRIFT_FEATURES)
    return split.time_split(rows)


def _point_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hourly map of values against the reference statistics of the events."""
    fitted = drift.fit_profile(V.drift_samples(spark, sf_dir)[0])
    bars = V.bars(spark, sf_dir)
    maps = bars.select(
        "symbol",
        "datetime",
        F.create_map(
            F.when(F.col("symbol") == "view", F.lit("click")).otherwise(F.col("symbol")),
            F.col("close"),
            F.lit("view"),
            F.col("high"),
            F.lit("unknown"),
            F.lit(1.0),
        ).alias("features"),
    )
    scored = fitted.point_drift(maps)
    return tidy(
        scored.select(
            "symbol",
            "datetime",
            F.concat_ws(",", "drifted_features").alias("drifted_features"),
            "point_drift_ratio",
            "point_drift_detected",
        )
    )


def _drift_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = V.drift_samples(spark, sf_dir)
    daily = current.select("feature", "value", telemetry.floor_time(F.col("ts"), telemetry.DAY).alias("day"))
    return tidy(drift.drift_by_window(reference, daily, "day"))


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.evaluate(V.metrics(spark, sf_dir))


def _histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = telemetry.window_start("timestamp", 3600)
    return telemetry.latency_histogram(V.predictions(spark, sf_dir), [at])


def _logged(spark: SparkSession, sf_dir: str) -> str:
    """The predictions appended to a log in three parts that follow each other by id."""
    path = staging_path(spark, "log")
    rows = stage(V.predictions(spark, sf_dir), "predictions")
    last = rows.agg(F.max("id")).first()[0] or 0
    for low, high in ((None, last // 2), (last // 2, last - last // 20), (last - last // 20, None)):
        above = F.lit(True) if low is None else F.col("id") > low
        predlog.append(rows.where(above if high is None else above & (F.col("id") <= high)), path)
    return path


def _newest_logged(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    return predlog.newest_logged(spark, _logged(spark, sf_dir), n, V.predictions(spark, sf_dir).schema)


FRAME_COLUMNS = [*S.PRICES, *S.FEATURES_WITH_VOLATILITY, S.TARGET]


def _frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feature frame, with its values rounded as the feature queries give them."""
    return stage(tidy(features.feature_frame(V.bars(spark, sf_dir))), "frame")


QUERIES: dict[str, Query] = {
    # prediction log
    "pred_stats": lambda s, d: tidy(
        predlog.stats(V.predictions(s, d), E.regression_metrics(forecasts(s, d)))
    ),
    "pred_recent": lambda s, d: predlog.recent(V.predictions(s, d)),
    "pred_history": lambda s, d: tidy(predlog.history(V.predictions(s, d)), 8),
    "latency_distribution": lambda s, d: predlog.latency_distribution(V.predictions(s, d)),
    "drift_history": lambda s, d: predlog.drift_history(V.predictions(s, d)),
    "volatility_series": lambda s, d: tidy(predlog.volatility_series(V.predictions(s, d)), 8),
    "pred_log_total": lambda s, d: predlog.total(s, _logged(s, d)),
    "pred_log_recent": lambda s, d: predlog.recent(_newest_logged(s, d, 20)),
    "pred_log_history": lambda s, d: tidy(predlog.history(_newest_logged(s, d, 100)), 8),
    "pred_log_drift": lambda s, d: predlog.drift_history(_newest_logged(s, d, 24)),
    # drift
    "reference_stats": lambda s, d: tidy(drift.reference_stats(V.drift_samples(s, d)[0])),
    "ks_statistic": lambda s, d: tidy(
        drift.ks_drift(*V.drift_samples(s, d)).select("feature_name", "test_statistic"), 8
    ),
    "ks_pvalue": lambda s, d: tidy(drift.ks_drift(*V.drift_samples(s, d)).drop("test_statistic")),
    "drift_train_test": lambda s, d: tidy(drift.train_test_drift(_split_samples(s, d), DRIFT_FEATURES)),
    "wasserstein": lambda s, d: tidy(drift.wasserstein(*V.drift_samples(s, d))),
    "drift_metrics": lambda s, d: tidy(drift.drift_metrics(*V.drift_samples(s, d))),
    "point_drift": _point_drift,
    "drift_by_window": _drift_by_window,
    # alerts
    "alert_rules": lambda s, d: _rules_with_hits(s, d),
    "alert_eval": lambda s, d: tidy(_alerts(s, d).drop("message")),
    "alert_message": lambda s, d: _alerts(s, d).select("ts", "name", "message"),
    "alert_history": lambda s, d: tidy(alerts.history(_alerts(s, d), "warning").drop("message")),
    "alert_summary": lambda s, d: alerts.summary(_alerts(s, d)),
    "alert_rule_states": lambda s, d: alerts.states(V.metrics(s, d)),
    "tiered_thresholds": lambda s, d: tidy(alerts.evaluate(V.metrics(s, d), alerts.TIERED_RULES).drop("message")),
    # service metrics
    "error_rate": lambda s, d: tidy(telemetry.error_rate(V.predictions(s, d))),
    "request_rate": lambda s, d: tidy(telemetry.request_rate(V.predictions(s, d))),
    "counter_rate": lambda s, d: tidy(
        telemetry.counter_rate(V.predictions(s, d).withColumn("counter", F.col("id") % 500), "counter")
    ),
    "latency_avg": lambda s, d: tidy(telemetry.latency_avg(V.predictions(s, d))),
    "latency_quantiles": lambda s, d: tidy(telemetry.latency_quantiles(V.predictions(s, d))),
    "latency_histogram": lambda s, d: _histogram(s, d).withColumn("le", F.col("le").cast("string")),
    "histogram_quantile": lambda s, d: tidy(
        telemetry.histogram_quantile(_histogram(s, d), 0.95, ["window_start"])
    ),
    "bucket_quantiles": lambda s, d: tidy(telemetry.bucket_quantiles(V.bucket_counters(s, d), 0.95, seconds=3600)),
    "sustained_condition": lambda s, d: tidy(
        telemetry.sustained(stage(V.metrics(s, d), "metrics"), F.col("value") > 0.2, 7200)
    ),
    "service_gaps": lambda s, d: tidy(telemetry.service_gaps(V.predictions(s, d))),
    "low_rate": lambda s, d: tidy(telemetry.low_rate(V.predictions(s, d))),
    "slowest_topk": lambda s, d: tidy(telemetry.slowest(V.predictions(s, d)), 8),
    # profiles
    "profile_columns": lambda s, d: tidy(profile.columns(V.gappy_table(s, d), S.PRICES)),
    "profile_correlation": lambda s, d: tidy(profile.correlation(V.bars_gappy(s, d), S.PRICES)),
    "profile_histogram": lambda s, d: tidy(profile.histogram(V.gappy_table(s, d), S.PRICES)),
    "profile_frame_columns": lambda s, d: tidy(profile.columns(_frame(s, d), FRAME_COLUMNS)),
    "profile_frame_correlation": lambda s, d: tidy(profile.correlation(_frame(s, d), FRAME_COLUMNS)),
    "profile_frame_histogram": lambda s, d: tidy(profile.histogram(_frame(s, d), FRAME_COLUMNS)),
    "profile_duplicates": lambda s, d: profile.duplicates(
        V.events(s, d), ["event_type", "user_id", "value"]
    ),
    "profile_topvalues": lambda s, d: profile.top_values(V.events(s, d), "user_id"),
}


def _rules_with_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule table after a replacement and a removal, with the number of metric rows that break each rule."""
    rules = alerts.upsert_rule(
        alerts.DEFAULT_RULES,
        alerts.Rule("high_drift", "drift_ratio", 0.45, "gte", "info", "Drift {value} of {threshold}", "percent2"),
    )
    rules = alerts.remove_rule(rules, "critical_latency")
    hits = alerts.evaluate(V.metrics(spark, sf_dir), rules).groupBy("name").agg(F.count(F.lit(1)).alias("hits"))
    table = alerts.rule_table(spark, rules).drop("template", "style", "hold_seconds")
    return table.join(hits, "name", "left").fillna(0, ["hits"])


# ---- oracle -------------------------------------------------------------------------------------

ALERT_RULES_SQL = (
    "rules AS (SELECT * FROM (VALUES ('high_latency', 'prediction_latency_seconds', 0.5::DOUBLE, 'warning'), "
    "('critical_latency', 'prediction_latency_seconds', 1.0, 'critical'), ('high_drift', 'drift_ratio', 0.2, 'warning'), "
    "('critical_drift', 'drift_ratio', 0.5, 'critical'), ('high_error_rate', 'error_rate', 0.05, 'warning'), "
    "('model_degradation', 'rmse_increase_pct', 0.1, 'warning')) t(name, metric_name, threshold, severity))"
)
TIERS_SQL = (
    "rules AS (SELECT * FROM (VALUES ('latency_tier_1', 'prediction_latency_seconds', 0.3::DOUBLE, 'warning'), "
    "('latency_tier_2', 'prediction_latency_seconds', 0.5, 'critical'), ('drift_tier_1', 'drift_ratio', 0.15, 'warning'), "
    "('drift_tier_2', 'drift_ratio', 0.2, 'critical'), ('error_tier_1', 'error_rate', 0.01, 'warning')) "
    "t(name, metric_name, threshold, severity))"
)
HELD_RULES_SQL = (
    "rules AS (SELECT * FROM (VALUES ('high_prediction_latency', 'prediction_latency_seconds', 0.5::DOUBLE, 'warning', 300), "
    "('critical_prediction_latency', 'prediction_latency_seconds', 1.0, 'critical', 120), "
    "('high_data_drift', 'drift_ratio', 0.2, 'warning', 600), ('critical_data_drift', 'drift_ratio', 0.5, 'critical', 300), "
    "('high_error_rate', 'error_rate', 0.05, 'warning', 300)) t(name, metric_name, threshold, severity, hold))"
)
FIRED = (
    "fired AS (SELECT ts, name, severity, metric_name, value AS metric_value, threshold "
    "FROM metrics JOIN rules USING (metric_name) WHERE value > threshold)"
)
FIRED_COLUMNS = f"ts, name, severity, metric_name, {rcols(['metric_value', 'threshold'])}"
MESSAGE = (
    "CASE name WHEN 'high_latency' THEN printf('Prediction latency (%.3fs) exceeds threshold (%.3fs)', metric_value, threshold) "
    "WHEN 'critical_latency' THEN printf('CRITICAL: Prediction latency (%.3fs) exceeds %.3fs', metric_value, threshold) "
    "WHEN 'high_drift' THEN printf('Data drift ratio (%.2f%%) exceeds threshold (%.2f%%)', metric_value * 100, threshold * 100) "
    "WHEN 'critical_drift' THEN printf('CRITICAL: Data drift ratio (%.2f%%) exceeds %.2f%%', metric_value * 100, threshold * 100) "
    "WHEN 'high_error_rate' THEN printf('Error rate (%.2f%%) exceeds threshold (%.2f%%)', metric_value * 100, threshold * 100) "
    "END"
)


def compare_ctes(keys: str = "feature", ref: str = "ref", cur: str = "cur") -> list[str]:
    """KS and Wasserstein parts per ``keys`` from two long samples."""
    return [
        f"cnt AS (SELECT {keys}, value, sum(a) AS a, sum(b) AS b FROM (SELECT {keys}, value, 1 AS a, 0 AS b FROM {ref} "
        f"UNION ALL SELECT {keys}, value, 0, 1 FROM {cur}) u WHERE value IS NOT NULL GROUP BY ALL)",
        f"cum AS (SELECT {keys}, value, sum(a) OVER o::DOUBLE / nullif(sum(a) OVER p, 0) AS fa, "
        "sum(b) OVER o::DOUBLE / nullif(sum(b) OVER p, 0) AS fb, lead(value) OVER o - value AS dx, "
        f"sum(a) OVER p AS na, sum(b) OVER p AS nb FROM cnt WINDOW o AS (PARTITION BY {keys} ORDER BY value), "
        f"p AS (PARTITION BY {keys}))",
        f"dist AS (SELECT {keys}, max(abs(fa - fb)) AS d, coalesce(sum(abs(fa - fb) * dx), 0) AS w, "
        f"max(na)::DOUBLE AS n, max(nb)::DOUBLE AS m FROM cum GROUP BY {keys})",
        "lam AS (SELECT *, d * sqrt(n * m / (n + m)) AS l FROM dist)",
        "tested AS (SELECT *, CASE WHEN l < 0.2 THEN 1.0::DOUBLE ELSE least(greatest(list_sum(list_transform("
        "range(1, 101), lambda j: CASE WHEN j % 2 = 1 THEN 2.0::DOUBLE ELSE -2.0::DOUBLE END * exp(-2.0::DOUBLE * j * j * l * l)"
        ")), 0.0), 1.0) END AS p, n > 0 AND m >= 10 AS ok FROM lam)",
    ]


SUMMARY = (
    "coalesce(count(*) FILTER (WHERE ok AND p < 0.05)::DOUBLE / nullif(count(*) FILTER (WHERE ok), 0), 0) AS drift_ratio, "
    "count(*) FILTER (WHERE ok AND p < 0.05) AS num_drifted_features, count(*) FILTER (WHERE ok) AS total_features, "
    "coalesce(avg(w) FILTER (WHERE n > 0 AND m > 0), 0) AS avg_wasserstein_distance, "
    "coalesce(max(w) FILTER (WHERE n > 0 AND m > 0), 0) AS max_wasserstein_distance"
)
SUMMARY_DOUBLES = ["drift_ratio", "avg_wasserstein_distance", "max_wasserstein_distance"]
SUMMARY_COLUMNS = f"{rcols(SUMMARY_DOUBLES)}, num_drifted_features, total_features"


def _drift(select: str) -> str:
    return V.with_views("ref cur", *compare_ctes(), select)


def bucket(seconds: int, at: str = '"timestamp"') -> str:
    return f"time_bucket(INTERVAL {seconds} SECOND, {at}, TIMESTAMP '1970-01-01')"


BOUNDS = [repr(float(b)) for b in telemetry.LATENCY_BOUNDS]
HISTOGRAM = (
    f"hist AS (SELECT {bucket(3600)} AS window_start, le, count(*) FILTER (WHERE latency_ms / 1000 <= le) AS cumulative "
    f"FROM predictions, (VALUES {', '.join(f'({b}::DOUBLE)' for b in BOUNDS)}, ('inf'::DOUBLE)) b(le) GROUP BY 1, 2)"
)


def _profile_column(c: str) -> str:
    return (
        f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS nulls, count({c}) AS count, "
        f"count(DISTINCT {c}) AS n_distinct, count(*) FILTER (WHERE {c} = 0) AS zeros, avg({c}) AS mean, "
        f"stddev_samp({c}) AS std, min({c}) AS min, max({c}) AS max, "
        + ", ".join(f"quantile_cont({c}, {q}) AS {n}" for n, q in profile.QUANTILES.items())
        + f", avg(({c} - mu_{c}) ** 3) / avg(({c} - mu_{c}) ** 2) ** 1.5 AS skewness, "
        f"avg(({c} - mu_{c}) ** 4) / avg(({c} - mu_{c}) ** 2) ** 2 - 3 AS kurtosis FROM bars_gappy, mu"
    )


FRAME = [*feature_ctes("bars"), f"fr AS (SELECT {ALL_COLUMNS} FROM f)"]
FRAME_LONG = "lg AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c}::DOUBLE AS value FROM fr" for c in FRAME_COLUMNS) + ")"
PROFILE_DOUBLES = ["mean", "std", "min", "max", *profile.QUANTILES, "skewness", "kurtosis"]
_PAIRS = [("open", "high"), ("open", "low"), ("open", "close"), ("high", "low"), ("high", "close"), ("low", "close")]

ORACLE: dict[str, str] = {
    "pred_stats": V.with_views(
        "bars predictions",
        *feature_ctes("bars"),
        FORECASTS,
        f"m AS (SELECT {metric_sql()} FROM fc)",
        "last AS (SELECT * FROM predictions ORDER BY id DESC LIMIT 100)",
        "SELECT (SELECT count(*) FROM predictions) AS total_predictions, "
        "(SELECT printf('%.2f', avg(latency_ms))::DOUBLE FROM last) AS avg_latency_ms, "
        "(SELECT count(*) FROM last WHERE drift_detected) AS drift_alerts, "
        "(SELECT printf('%.1f', (1 - mape / 100) * 100)::DOUBLE FROM m) AS model_accuracy",
    ),
    "pred_recent": V.with_views(
        "predictions",
        "SELECT \"timestamp\", printf('%.6f', prediction)::DOUBLE AS prediction, "
        "printf('%.2f', latency_ms)::DOUBLE AS latency_ms, drift_detected, "
        "printf('%.4f', drift_ratio)::DOUBLE AS drift_ratio FROM predictions ORDER BY id DESC LIMIT 20",
    ),
    "pred_history": V.with_views(
        "predictions",
        f"SELECT \"timestamp\", {rcols(['prediction', 'latency_ms', 'drift_ratio'], 8)}, drift_detected "
        "FROM predictions ORDER BY id DESC LIMIT 100",
    ),
    "pred_log_total": "SELECT count(*) AS total_predictions FROM events",
    "latency_distribution": V.with_views(
        "predictions",
        "SELECT position::INTEGER AS position, bucket, count(*) FILTER (WHERE latency_ms >= low AND latency_ms < high) AS count "
        "FROM predictions, (VALUES (0, '<10ms', '-inf'::DOUBLE, 10), (1, '10-25ms', 10, 25), (2, '25-50ms', 25, 50), "
        "(3, '50-100ms', 50, 100), (4, '>100ms', 100, 'inf'::DOUBLE)) b(position, bucket, low, high) GROUP BY 1, 2",
    ),
    "drift_history": V.with_views(
        "predictions",
        "SELECT id, \"timestamp\", printf('%.1f', drift_ratio * 100)::DOUBLE AS score, 20 AS threshold "
        "FROM predictions ORDER BY id DESC LIMIT 24",
    ),
    "volatility_series": V.with_views(
        "predictions",
        f"SELECT id, \"timestamp\", {r('prediction', 8)} AS prediction FROM predictions ORDER BY id DESC LIMIT 24",
    ),
    "reference_stats": V.with_views(
        "ref",
        "s AS (SELECT feature, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max, "
        "quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 "
        "FROM ref GROUP BY 1)",
        f"SELECT feature, {rcols(drift.STATS)} FROM s",
    ),
    "ks_statistic": _drift(f"SELECT feature AS feature_name, {r('d', 8)} AS test_statistic FROM tested WHERE ok"),
    "ks_pvalue": _drift(
        f"SELECT feature AS feature_name, p < 0.05 AS is_drift, {r('p')} AS p_value, "
        "'kolmogorov_smirnov' AS test_type FROM tested WHERE ok"
    ),
    "drift_train_test": V.with_views(
        "bars",
        *feature_ctes("bars"),
        f"fc AS (SELECT * FROM f WHERE {NOT_NULL})",
        INDEXED,
        SPLIT,
        "lg AS (" + " UNION ALL ".join(
            f"SELECT split, '{c}' AS feature, {c}::DOUBLE AS value FROM sp" for c in DRIFT_FEATURES
        ) + ")",
        "tr AS (SELECT * FROM lg WHERE split = 'train')",
        "te AS (SELECT * FROM lg WHERE split = 'test')",
        *compare_ctes(ref="tr", cur="te"),
        "SELECT " + r(f"count(*) FILTER (WHERE ok AND p < 0.05) / {len(DRIFT_FEATURES)}.0::DOUBLE") + " AS drift_ratio, "
        "count(*) FILTER (WHERE ok AND p < 0.05) AS num_drifted_features, "
        f"{len(DRIFT_FEATURES)}::BIGINT AS total_features FROM tested",
    ),
    "wasserstein": _drift(f"SELECT feature, {r('w')} AS distance FROM tested WHERE n > 0 AND m > 0"),
    "drift_metrics": _drift(f"SELECT {SUMMARY_COLUMNS} FROM (SELECT {SUMMARY} FROM tested) q"),
    "drift_by_window": V.with_views(
        "ref cur",
        "days AS (SELECT feature, value, date_trunc('day', ts)::TIMESTAMP AS day FROM cur)",
        "each AS (SELECT feature, value, day FROM ref, (SELECT DISTINCT day FROM days) d)",
        *compare_ctes("day, feature", "each", "days"),
        f"SELECT day, {SUMMARY_COLUMNS} FROM (SELECT day, {SUMMARY} FROM tested GROUP BY day) q",
    ),
    "point_drift": V.with_views(
        "bars ref",
        "s AS (SELECT feature, avg(value) AS mean, stddev_samp(value) AS std FROM ref GROUP BY 1)",
        "e AS (SELECT symbol, datetime, CASE WHEN symbol = 'view' THEN 'click' ELSE symbol END AS feature, close AS value "
        "FROM bars UNION ALL SELECT symbol, datetime, 'view', high FROM bars)",
        "z AS (SELECT symbol, datetime, feature, coalesce(std > 0 AND abs((value - mean) / std) > 3.0, false) AS far "
        "FROM e JOIN s USING (feature))",
        "g AS (SELECT symbol, datetime, coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE far), '') "
        "AS drifted_features, count(*) FILTER (WHERE far)::DOUBLE / count(*) AS x FROM z GROUP BY 1, 2)",
        f"SELECT symbol, datetime, drifted_features, {r('x')} AS point_drift_ratio, x > 0.2 AS point_drift_detected FROM g",
    ),
    "alert_rules": V.with_views(
        "metrics",
        "rules AS (SELECT * FROM (VALUES ('high_latency', 'prediction_latency_seconds', 0.5::DOUBLE, 'gt', 'warning'), "
        "('high_drift', 'drift_ratio', 0.45, 'gte', 'info'), ('critical_drift', 'drift_ratio', 0.5, 'gt', 'critical'), "
        "('high_error_rate', 'error_rate', 0.05, 'gt', 'warning'), "
        "('model_degradation', 'rmse_increase_pct', 0.1, 'gt', 'warning')) "
        "t(name, metric_name, threshold, comparison, severity))",
        "SELECT name, metric_name, threshold, comparison, severity, (SELECT count(*) FROM metrics m WHERE "
        "m.metric_name = rules.metric_name AND (value > threshold OR (comparison = 'gte' AND value = threshold))) AS hits "
        "FROM rules",
    ),
    "alert_eval": V.with_views("metrics", ALERT_RULES_SQL, FIRED, f"SELECT {FIRED_COLUMNS} FROM fired"),
    "alert_message": V.with_views(
        "metrics", ALERT_RULES_SQL, FIRED, f"SELECT ts, name, {MESSAGE} AS message FROM fired"
    ),
    "alert_history": V.with_views(
        "metrics", ALERT_RULES_SQL, FIRED,
        f"SELECT {FIRED_COLUMNS} FROM fired WHERE severity = 'warning' ORDER BY ts DESC, name DESC LIMIT 100",
    ),
    "alert_summary": V.with_views(
        "metrics", ALERT_RULES_SQL, FIRED,
        "SELECT 'total' AS scope, 'all' AS label, count(*) AS count FROM fired UNION ALL "
        "SELECT 'severity', s, (SELECT count(*) FROM fired WHERE severity = s) FROM "
        "(VALUES ('info'), ('warning'), ('critical')) t(s) UNION ALL "
        "SELECT 'metric', metric_name, count(*) FROM fired GROUP BY metric_name",
    ),
    "alert_rule_states": V.with_views(
        "metrics",
        HELD_RULES_SQL,
        "mk AS (SELECT name, severity, hold, ts, value > threshold AS is_on FROM metrics JOIN rules USING (metric_name))",
        "nb AS (SELECT *, lag(is_on) OVER w AS before, lead(ts) OVER w AS following FROM mk "
        "WINDOW w AS (PARTITION BY name ORDER BY ts))",
        "st AS (SELECT *, sum((is_on <> coalesce(before, is_on))::INTEGER) OVER (PARTITION BY name ORDER BY ts) AS stretch FROM nb)",
        "iv AS (SELECT name, severity, min(ts) AS pending_at, "
        "CASE WHEN epoch(max(ts)) - epoch(min(ts)) >= max(hold) THEN min(ts) + to_seconds(max(hold)) END AS fired_at, "
        "CASE WHEN count(*) = count(following) THEN max(following) END AS resolved_at, count(*) AS samples "
        "FROM st WHERE is_on GROUP BY name, severity, stretch)",
        "SELECT *, CASE WHEN fired_at IS NOT NULL AND resolved_at IS NOT NULL THEN 'resolved' WHEN fired_at IS NOT NULL "
        "THEN 'firing' WHEN resolved_at IS NOT NULL THEN 'cleared' ELSE 'pending' END AS state FROM iv",
    ),
    "tiered_thresholds": V.with_views("metrics", TIERS_SQL, FIRED, f"SELECT {FIRED_COLUMNS} FROM fired"),
    "error_rate": V.with_views(
        "predictions",
        f"SELECT {bucket(300)} AS window_start, count(*) AS requests, count(*) FILTER (WHERE is_error) AS errors, "
        + r("count(*) FILTER (WHERE is_error)::DOUBLE / count(*)") + " AS error_rate FROM predictions GROUP BY 1",
    ),
    "request_rate": V.with_views(
        "predictions",
        f"SELECT {bucket(60)} - INTERVAL (k) MINUTE AS window_start, count(*) AS requests, "
        + r("count(*) / 600.0::DOUBLE") + " AS rate FROM predictions, range(10) t(k) GROUP BY 1",
    ),
    "counter_rate": V.with_views(
        "predictions",
        "c AS (SELECT series, \"timestamp\", id % 500 AS v, lag(id % 500) OVER (PARTITION BY series ORDER BY "
        "\"timestamp\", id) AS b FROM predictions)",
        f"SELECT series, {bucket(300)} AS window_start, "
        "sum(CASE WHEN b IS NULL THEN 0 WHEN v >= b THEN v - b ELSE v END)::DOUBLE AS increase, "
        + r("sum(CASE WHEN b IS NULL THEN 0 WHEN v >= b THEN v - b ELSE v END) / 300.0::DOUBLE")
        + " AS rate FROM c GROUP BY 1, 2",
    ),
    "latency_avg": V.with_views(
        "predictions",
        f"SELECT {bucket(300)} AS window_start, count(latency_ms) AS requests, {r('avg(latency_ms)')} AS avg_latency_ms "
        "FROM predictions GROUP BY 1",
    ),
    "latency_quantiles": V.with_views(
        "predictions",
        f"SELECT {bucket(300)} AS window_start, {r('avg(latency_ms)')} AS avg_latency_ms, "
        f"{r('quantile_cont(latency_ms, 0.95)')} AS p95, {r('quantile_cont(latency_ms, 0.99)')} AS p99 "
        "FROM predictions GROUP BY 1",
    ),
    "latency_histogram": V.with_views(
        "predictions", HISTOGRAM,
        "SELECT window_start, CASE WHEN isinf(le) THEN 'Infinity' ELSE le::VARCHAR END AS le, cumulative FROM hist",
    ),
    "histogram_quantile": V.with_views(
        "predictions", HISTOGRAM,
        "h AS (SELECT *, coalesce(lag(le) OVER w, 0) AS low, coalesce(lag(cumulative) OVER w, 0) AS below, "
        "max(cumulative) OVER (PARTITION BY window_start) * 0.95::DOUBLE AS rank FROM hist "
        "WINDOW w AS (PARTITION BY window_start ORDER BY le))",
        "q AS (SELECT window_start, first(CASE WHEN isinf(le) THEN low ELSE low + (le - low) * (rank - below) / "
        "nullif(cumulative - below, 0) END ORDER BY le) AS quantile FROM h WHERE cumulative >= rank AND rank > 0 GROUP BY 1)",
        f"SELECT window_start, {r('quantile')} AS quantile FROM q",
    ),
    "bucket_quantiles": V.with_views(
        "bucket_counters",
        "st AS (SELECT *, lag(cumulative) OVER (PARTITION BY series, le ORDER BY \"timestamp\", id) AS b FROM bucket_counters)",
        f"inc AS (SELECT {bucket(3600)} AS window_start, le, sum(CASE WHEN b IS NULL THEN 0 WHEN cumulative >= b "
        "THEN cumulative - b ELSE cumulative END)::DOUBLE AS increase FROM st GROUP BY 1, 2)",
        "rep AS (SELECT window_start, le, max(increase) OVER (PARTITION BY window_start ORDER BY le) AS cumulative FROM inc)",
        "h AS (SELECT *, coalesce(lag(le) OVER w, 0) AS low, coalesce(lag(cumulative) OVER w, 0) AS below, "
        "max(cumulative) OVER (PARTITION BY window_start) * 0.95::DOUBLE AS rank FROM rep "
        "WINDOW w AS (PARTITION BY window_start ORDER BY le))",
        "q AS (SELECT window_start, first(CASE WHEN isinf(le) THEN low ELSE low + (le - low) * (rank - below) / "
        "nullif(cumulative - below, 0) END ORDER BY le) AS quantile FROM h WHERE cumulative >= rank AND rank > 0 GROUP BY 1)",
        f"SELECT window_start, {r('quantile')} AS quantile FROM q",
    ),
    "sustained_condition": V.with_views(
        "metrics",
        "s AS (SELECT *, value > 0.2 AS cond, row_number() OVER (PARTITION BY metric_name ORDER BY ts) - "
        "row_number() OVER (PARTITION BY metric_name, value > 0.2 ORDER BY ts) AS island FROM metrics)",
        "SELECT metric_name, min(ts) AS began, max(ts) AS ended, count(*) AS samples, "
        + r("epoch(max(ts)) - epoch(min(ts))") + " AS held_seconds "
        "FROM s WHERE cond GROUP BY metric_name, island HAVING epoch(max(ts)) - epoch(min(ts)) >= 7200",
    ),
    "service_gaps": V.with_views(
        "predictions",
        "g AS (SELECT series, \"timestamp\" AS last_seen, lead(\"timestamp\") OVER (PARTITION BY series ORDER BY "
        "\"timestamp\", id) AS resumed FROM predictions)",
        "e AS (SELECT series, last_seen, resumed, resumed IS NULL AS is_open, "
        "coalesce(resumed, (SELECT max(\"timestamp\") FROM predictions)) AS until FROM g)",
        "SELECT series, last_seen, resumed, is_open, "
        + r("(epoch_us(until) - epoch_us(last_seen)) / 1000000.0::DOUBLE") + " AS gap_seconds "
        "FROM e WHERE epoch_us(until) - epoch_us(last_seen) > 3600000000",
    ),
    "low_rate": V.with_views(
        "predictions",
        f"c AS (SELECT {bucket(600)} AS window_start, count(*) AS requests FROM predictions GROUP BY 1)",
        "spine AS (SELECT unnest(generate_series((SELECT min(window_start) FROM c), (SELECT max(window_start) FROM c), "
        "INTERVAL 10 MINUTE)) AS window_start)",
        "SELECT window_start, coalesce(requests, 0) AS requests, " + r("coalesce(requests, 0) / 600.0::DOUBLE")
        + " AS rate FROM spine LEFT JOIN c USING (window_start) WHERE coalesce(requests, 0) / 600.0::DOUBLE < 0.01",
    ),
    "slowest_topk": V.with_views(
        "predictions",
        "s AS (SELECT series, model_version, count(*) AS requests, sum(latency_ms) / 1000 / "
        "nullif((epoch_us(max(\"timestamp\")) - epoch_us(min(\"timestamp\"))) / 1000000.0::DOUBLE, 0) AS latency_rate "
        "FROM predictions GROUP BY 1, 2)",
        f"SELECT series, model_version, requests, {r('latency_rate', 8)} AS latency_rate FROM s "
        "ORDER BY s.latency_rate DESC, series, model_version LIMIT 10",
    ),
    "profile_columns": V.with_views(
        "bars_gappy",
        "mu AS (SELECT " + ", ".join(f"avg({c}) AS mu_{c}" for c in S.PRICES) + " FROM bars_gappy)",
        "pr AS (" + " UNION ALL ".join(_profile_column(c) for c in S.PRICES) + ")",
        f"SELECT feature, nulls, count, n_distinct, zeros, {rcols(PROFILE_DOUBLES)} FROM pr",
    ),
    "profile_correlation": V.with_views(
        "bars_gappy",
        " UNION ALL ".join(
            f"SELECT '{a}' AS left_column, '{b}' AS right_column, {r(f'corr({a}, {b})')} AS correlation FROM bars_gappy"
            for a, b in _PAIRS
        ),
    ),
    "profile_histogram": V.with_views(
        "bars_gappy",
        "lg AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value FROM bars_gappy" for c in S.PRICES) + ")",
        "sp AS (SELECT feature, min(value) AS low, max(value) AS high FROM lg GROUP BY 1)",
        "b AS (SELECT feature, low, high, least(coalesce(floor((value - low) * 10 / nullif(high - low, 0)), 0), 9)::INTEGER "
        "AS bin FROM lg JOIN sp USING (feature) WHERE value IS NOT NULL)",
        f"SELECT feature, bin, {r('low + (high - low) / 10 * bin')} AS bin_start, "
        f"{r('low + (high - low) / 10 * (bin + 1)')} AS bin_end, count(*) AS count FROM b GROUP BY feature, bin, low, high",
    ),
    "profile_frame_columns": V.with_views(
        "bars", *FRAME, FRAME_LONG,
        "mu AS (SELECT feature, avg(value) AS mu FROM lg GROUP BY 1)",
        "pr AS (SELECT feature, count(*) FILTER (WHERE value IS NULL) AS nulls, count(value) AS count, "
        "count(DISTINCT value) AS n_distinct, count(*) FILTER (WHERE value = 0) AS zeros, avg(value) AS mean, "
        "stddev_samp(value) AS std, min(value) AS min, max(value) AS max, "
        + ", ".join(f"quantile_cont(value, {q}) AS {n}" for n, q in profile.QUANTILES.items())
        + ", avg((value - mu) ** 3) / nullif(avg((value - mu) ** 2) ** 1.5, 0) AS skewness, "
        "avg((value - mu) ** 4) / nullif(avg((value - mu) ** 2) ** 2, 0) - 3 AS kurtosis FROM lg JOIN mu USING (feature) GROUP BY 1)",
        f"SELECT feature, nulls, count, n_distinct, zeros, {rcols(PROFILE_DOUBLES)} FROM pr",
    ),
    "profile_frame_correlation": V.with_views(
        "bars", *FRAME,
        "co AS (SELECT " + ", ".join(
            f"corr({a}, {b}) AS r{k}" for k, (a, b) in enumerate(combinations(FRAME_COLUMNS, 2))
        ) + " FROM fr)",
        " UNION ALL ".join(
            f"SELECT '{a}' AS left_column, '{b}' AS right_column, {r(f'r{k}')} AS correlation FROM co"
            for k, (a, b) in enumerate(combinations(FRAME_COLUMNS, 2))
        ),
    ),
    "profile_frame_histogram": V.with_views(
        "bars", *FRAME, FRAME_LONG,
        "sp AS (SELECT feature, min(value) AS low, max(value) AS high FROM lg GROUP BY 1)",
        "b AS (SELECT feature, low, high, least(coalesce(floor((value - low) * 10 / nullif(high - low, 0)), 0), 9)::INTEGER "
        "AS bin FROM lg JOIN sp USING (feature) WHERE value IS NOT NULL)",
        f"SELECT feature, bin, {r('low + (high - low) / 10 * bin')} AS bin_start, "
        f"{r('low + (high - low) / 10 * (bin + 1)')} AS bin_end, count(*) AS count FROM b GROUP BY feature, bin, low, high",
    ),
    "profile_duplicates": (
        "SELECT event_type, user_id, value, count(*) AS copies FROM events GROUP BY ALL HAVING count(*) > 1"
    ),
    "profile_topvalues": (
        "SELECT user_id AS value, count(*) AS count FROM events GROUP BY 1 ORDER BY count DESC, value LIMIT 10"
    ),
    "retrain_decision": V.with_views(
        "bars ref cur",
        *feature_ctes("bars"),
        FORECASTS, RUNS, RUN_METRICS, COMPARED,
        *compare_ctes(),
        f"ds AS (SELECT {SUMMARY} FROM tested)",
        f"SELECT {r('ds.drift_ratio')} AS drift_ratio, {r('relative_change')} AS rmse_increase_pct, "
        "ds.drift_ratio > 0.5 OR relative_change > 0.1 AS retrain FROM ds, cmp WHERE metric = 'rmse'",
    ),
}

# the log gives what a scan of all predictions gives
ORACLE |= {
    "pred_log_recent": ORACLE["pred_recent"],
    "pred_log_history": ORACLE["pred_history"],
    "pred_log_drift": ORACLE["drift_history"],
}
