"""Registered queries for splits, scaling, evaluation and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide import schema as S
from voltide.operators import evaluation as E
from voltide.operators import features, scoring, split
from voltide.operators.drift import drift_metrics
from voltide.plans import views as V
from voltide.plans.feature_queries import ALL_COLUMNS, NOT_NULL, Query, W, feature_ctes, r, rcols, tidy
from voltide.session import stage

KEY = ["symbol", "datetime"]
SCALED = S.FEATURES_WITH_VOLATILITY


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete feature rows of all bars, stored: splits and folds read them more than once."""
    frame = features.feature_frame(V.bar_table(spark, sf_dir))
    return stage(split.drop_incomplete(frame, split.feature_names(frame)), "samples")


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a volatility, its next value and the persistence forecast."""
    rows = features.next_volatility(V.bar_table(spark, sf_dir)).where(
        F.col("volatility").isNotNull() & F.col(S.TARGET).isNotNull()
    )
    return E.naive_forecast(stage(rows.select(*KEY, "log_return", "volatility", S.TARGET), "forecasts"))


def candidate_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three simple forecasts as model versions, scored."""
    v = F.col("volatility")
    runs = F.explode(
        F.array(
            F.struct(F.lit("v1").alias("model_version"), v.alias("prediction")),
            F.struct(F.lit("v2").alias("model_version"), (v * 0.95).alias("prediction")),
            F.struct(F.lit("v3").alias("model_version"), F.abs("log_return").alias("prediction")),
        )
    )
    rows = forecasts(spark, sf_dir).select(S.TARGET, runs.alias("run"))
    scored = rows.select(S.TARGET, "run.model_version", "run.prediction")
    return E.regression_metrics(scored, ["model_version"])


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = stage(E.long_metrics(candidate_runs(spark, sf_dir), ids=["model_version"]), "runs")
    return E.compare_metrics(
        long.where(F.col("model_version") == "v2"), long.where(F.col("model_version") == "v1")
    )


def _scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    split_rows = stage(split.time_split(samples(spark, sf_dir).select(*KEY, *SCALED)), "split")
    return tidy(split.robust_scale(split_rows, SCALED))


def scored_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests with a fixed linear predictor in place of a trained model."""
    aligned = scoring.align_features(V.requests(spark, sf_dir), list(S.EXPECTED_RANGES))
    prediction = F.abs(F.col("close_rolling_std_24")) * 0.5 + F.abs(F.col("log_return")) * 0.1
    return aligned.withColumn("prediction", prediction)


def json_values(records: DataFrame) -> DataFrame:
    """The JSON features read back: their number and the value of every expected one."""
    values = F.from_json("features", "map<string,double>")
    names = {f"json_{name}": F.try_element_at(values, F.lit(name)) for name in S.EXPECTED_RANGES}
    return records.withColumns({"json_size": F.size(values), **names}).drop("features")


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored_requests(spark, sf_dir)
    # latency is a property of the row here, so that the log is reproducible
    return tidy(json_values(scoring.score_records(rows, "v1", F.hour("datetime").cast("double"))))


QUERIES: dict[str, Query] = {
    "select_features": lambda s, d: tidy(
        split.select_features(features.feature_frame(V.bar_table(s, d)), with_volatility=False)
    ),
    "drop_incomplete_samples": lambda s, d: tidy(samples(s, d).select(*KEY, "volatility", S.TARGET), 8),
    "time_split": lambda s, d: tidy(split.time_split(forecasts(s, d)).select(*KEY, S.TARGET, "split"), 8),
    "robust_scale": _scaled,
    "ts_cv_folds": lambda s, d: split.expanding_folds(forecasts(s, d)).select(*KEY, "test_fold"),
    "ts_cv_fold_sizes": lambda s, d: split.fold_sizes(split.expanding_folds(forecasts(s, d))),
    "block_cv_folds": lambda s, d: split.block_folds(forecasts(s, d)).select(*KEY, "fold"),
    "sample_head": lambda s, d: tidy(
        split.sample_head(forecasts(s, d)).select(*KEY, S.TARGET, "prediction"), 8
    ),
    "naive_forecast": lambda s, d: tidy(forecasts(s, d).select(*KEY, "prediction", S.TARGET), 8),
    "cv_rmse": lambda s, d: tidy(E.cv_rmse(split.expanding_folds(forecasts(s, d)))),
    "regression_metrics": lambda s, d: tidy(E.regression_metrics(forecasts(s, d))),
    "regression_metrics_split": lambda s, d: tidy(
        E.split_metrics(split.time_split(forecasts(s, d)), len(S.FEATURES_WITH_VOLATILITY))
    ),
    "metrics_compare": lambda s, d: tidy(_compared(s, d)),
    "model_quality_gate": lambda s, d: tidy(
        E.quality_gate(
            E.split_metrics(split.time_split(forecasts(s, d)), 34), [*E.GATES, *E.TARGETS]
        )
    ),
    "best_run_topk": lambda s, d: tidy(E.best_runs(stage(candidate_runs(s, d), "runs"), 3)),
    "retrain_decision": lambda s, d: tidy(
        E.retrain_decision(drift_metrics(*V.drift_samples(s, d)), _compared(s, d))
    ),
    # scoring
    "align_features": lambda s, d: tidy(
        scoring.align_features(V.requests(s, d), S.FEATURES_WITH_VOLATILITY).drop("features"), 8
    ),
    "risk_level": lambda s, d: tidy(
        scoring.risk_level(V.predictions(s, d)).select(
            "id", "prediction", "risk_level", "confidence", "interpretation"
        )
    ),
    "range_drift": lambda s, d: tidy(scoring.range_drift(V.requests(s, d)).drop("features")),
    "score_record": _records,
}

# ---- oracle -------------------------------------------------------------------------------------

FORECASTS = (
    "fc AS (SELECT symbol, datetime, log_return, volatility, target_volatility, volatility AS prediction "
    "FROM f WHERE volatility IS NOT NULL AND target_volatility IS NOT NULL)"
)
INDEXED = (
    f"ix AS (SELECT *, row_number() OVER ({W}) - 1 AS i, count(*) OVER (PARTITION BY symbol) AS n FROM fc)"
)
SPLIT = "sp AS (SELECT *, CASE WHEN i < floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM ix)"
EXPANDING = (
    "ex AS (SELECT *, CASE WHEN i < n - (n // 6) * 5 THEN -1 "
    "ELSE (i - (n - (n // 6) * 5)) // (n // 6) END::INTEGER AS test_fold FROM ix)"
)
RUNS = (
    "runs AS (SELECT target_volatility, 'v1' AS model_version, volatility AS prediction FROM fc UNION ALL "
    "SELECT target_volatility, 'v2', volatility * 0.95::DOUBLE FROM fc UNION ALL "
    "SELECT target_volatility, 'v3', abs(log_return) FROM fc)"
)


def metric_sql(clip: bool = False) -> str:
    y, e = "target_volatility", "(target_volatility - prediction)"
    scale = f"greatest(abs({y}), 2.220446049250313e-16)" if clip else f"nullif(abs({y}), 0)"
    return (
        f"sqrt(avg({e} * {e})) AS rmse, avg(abs({e})) AS mae, "
        f"1 - sum({e} * {e}) / nullif(var_pop({y}) * count({y}), 0) AS r2, "
        f"avg(abs({e}) / {scale}) * 100 AS mape, count(*) AS samples"
    )


def base(*tail: str) -> str:
    return V.with_views("bars", *feature_ctes("bars"), FORECASTS, *tail)


METRIC_COLUMNS = rcols(E.METRICS)
SPLIT_METRICS = f"m AS (SELECT split, {metric_sql(True)}, 34 AS n_features FROM sp GROUP BY 1)"
RUN_METRICS = f"rm AS (SELECT model_version, {metric_sql()} FROM runs GROUP BY 1)"
COMPARED = (
    "lm AS (" + " UNION ALL ".join(
        f"SELECT model_version, '{m}' AS metric, {m} AS value FROM rm" for m in E.METRICS
    ) + "), cmp AS (SELECT metric, a.value AS new_value, b.value AS current_value, "
    "(a.value - b.value) / nullif(b.value, 0) AS relative_change, "
    "metric = 'rmse' AND a.value > b.value * 1.1::DOUBLE AS blocks_promotion "
    "FROM lm a JOIN lm b USING (metric) WHERE a.model_version = 'v2' AND b.model_version = 'v1')"
)


def _gate_sql() -> str:
    signs = {"lt": "<", "gt": ">", "gte": ">="}
    return " UNION ALL ".join(
        f"SELECT split, '{m}' AS metric, {r(f'{m}::DOUBLE')} AS value, '{c}' AS comparison, "
        f"{limit}::DOUBLE AS limit_value, {m} {signs[c]} {limit} AS passed FROM m"
        for m, c, limit in [*E.GATES, *E.TARGETS]
    )


SAMPLES = f"smp AS (SELECT symbol, datetime, {', '.join(SCALED)} FROM f WHERE {NOT_NULL})"
EXPECTED = list(S.EXPECTED_RANGES)
SIZE = " + ".join(f"({c} IS NOT NULL)::INTEGER" for c in [*EXPECTED, "custom"])
OUTSIDE = " + ".join(
    f"coalesce(({c} < {low} OR {c} > {high})::INTEGER, 0)" for c, (low, high) in S.EXPECTED_RANGES.items()
)
RANGED = (
    f"rd AS (SELECT *, coalesce(({OUTSIDE})::DOUBLE / nullif({SIZE}, 0), 0.0::DOUBLE) AS drift_ratio FROM requests)"
)
RISK_SQL = (
    "CASE WHEN prediction < 0.005 THEN '{0}' WHEN prediction < 0.015 THEN '{1}' ELSE '{2}' END"
)
INTERPRETATION = (
    "CASE WHEN prediction < 0.005 THEN printf('Low volatility expected (%.4f or %.2f%%). Market conditions appear "
    "stable with minimal price fluctuations.', prediction, prediction * 100) WHEN prediction < 0.015 THEN "
    "printf('Moderate volatility expected (%.4f or %.2f%%). Normal market activity with typical price movements.', "
    "prediction, prediction * 100) ELSE printf('High volatility expected (%.4f or %.2f%%). Market conditions are "
    "turbulent with significant price swings.', prediction, prediction * 100) END"
)

JSON_VALUES = ", ".join(
    [f"({SIZE}) AS json_size", *(f"{r(name if name in EXPECTED else 'NULL::DOUBLE')} AS json_{name}" for name in S.EXPECTED_RANGES)]
)

ORACLE: dict[str, str] = {
    "select_features": V.with_views(
        "bars",
        *feature_ctes("bars"),
        "SELECT * EXCLUDE (open, high, low, close, volatility) FROM (SELECT " + ALL_COLUMNS + " FROM f) q",
    ),
    "drop_incomplete_samples": V.with_views(
        "bars", *feature_ctes("bars"),
        f"SELECT symbol, datetime, {rcols(['volatility', S.TARGET], 8)} FROM f WHERE {NOT_NULL}",
    ),
    "time_split": base(INDEXED, SPLIT, f"SELECT symbol, datetime, {rcols([S.TARGET], 8)}, split FROM sp"),
    "robust_scale": V.with_views(
        "bars",
        *feature_ctes("bars"),
        SAMPLES,
        f"ix AS (SELECT *, row_number() OVER ({W}) - 1 AS i, count(*) OVER (PARTITION BY symbol) AS n FROM smp)",
        SPLIT,
        "q AS (SELECT " + ", ".join(
            f"quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}"
            for c in SCALED
        ) + " FROM sp WHERE split = 'train')",
        "SELECT symbol, datetime, " + ", ".join(
            f"{r(f'({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END')} AS {c}" for c in SCALED
        ) + ", split FROM sp, q",
    ),
    "ts_cv_folds": base(INDEXED, EXPANDING, "SELECT symbol, datetime, test_fold FROM ex"),
    "ts_cv_fold_sizes": base(
        INDEXED, EXPANDING,
        "SELECT symbol, fold::INTEGER AS fold, count(*) FILTER (WHERE test_fold < fold) AS train_rows, "
        "count(*) FILTER (WHERE test_fold = fold) AS test_rows FROM ex, range(5) t(fold) GROUP BY 1, 2",
    ),
    "block_cv_folds": base(
        INDEXED,
        "SELECT symbol, datetime, CASE WHEN i < (n % 5) * (n // 5 + 1) THEN i // (n // 5 + 1) "
        "ELSE (n % 5) + (i - (n % 5) * (n // 5 + 1)) // (n // 5) END::INTEGER AS fold FROM ix",
    ),
    "sample_head": base(
        f"SELECT symbol, datetime, {rcols([S.TARGET, 'prediction'], 8)} FROM fc ORDER BY datetime, symbol LIMIT 200"
    ),
    "naive_forecast": base(f"SELECT symbol, datetime, {rcols(['prediction', S.TARGET], 8)} FROM fc"),
    "cv_rmse": base(
        INDEXED, EXPANDING,
        "SELECT " + r("sqrt(avg(mse))") + " AS cv_rmse, count(*) AS folds FROM (SELECT test_fold, "
        "avg((target_volatility - prediction) * (target_volatility - prediction)) AS mse FROM ex "
        "WHERE test_fold >= 0 GROUP BY 1) q",
    ),
    "regression_metrics": base(f"m AS (SELECT {metric_sql()} FROM fc)", f"SELECT {METRIC_COLUMNS}, samples FROM m"),
    "regression_metrics_split": base(
        INDEXED, SPLIT, SPLIT_METRICS, f"SELECT split, {METRIC_COLUMNS}, samples, n_features FROM m"
    ),
    "metrics_compare": base(
        RUNS, RUN_METRICS, COMPARED,
        f"SELECT metric, {rcols(['new_value', 'current_value', 'relative_change'])}, blocks_promotion FROM cmp",
    ),
    "model_quality_gate": base(INDEXED, SPLIT, SPLIT_METRICS, _gate_sql()),
    "best_run_topk": base(
        RUNS, RUN_METRICS,
        f"SELECT model_version, {METRIC_COLUMNS}, samples, row_number() OVER (ORDER BY rmse, r2 DESC, "
        "model_version) = 1 AS is_best FROM rm ORDER BY rmse, r2 DESC, model_version LIMIT 3",
    ),
    "align_features": V.with_views(
        "requests",
        "SELECT symbol, datetime, " + ", ".join(
            f"{r(f'coalesce({c}, 0.0)' if c in EXPECTED else '0.0::DOUBLE', 8)} AS {c}" for c in S.FEATURES_WITH_VOLATILITY
        )
        + " FROM requests",
    ),
    "risk_level": V.with_views(
        "predictions",
        f"SELECT id, {r('prediction')} AS prediction, {RISK_SQL.format('Low', 'Medium', 'High')} AS risk_level, "
        f"{RISK_SQL.format('High', 'Medium', 'High')} AS confidence, {INTERPRETATION} AS interpretation "
        "FROM predictions",
    ),
    "range_drift": V.with_views(
        "requests", RANGED,
        f"SELECT symbol, datetime, {r('drift_ratio')} AS drift_ratio, drift_ratio > 0.3 AS drift_detected FROM rd",
    ),
    "score_record": V.with_views(
        "requests", RANGED,
        "SELECT datetime AS \"timestamp\", "
        + r("abs(coalesce(close_rolling_std_24, 0)) * 0.5::DOUBLE + abs(coalesce(log_return, 0)) * 0.1::DOUBLE")
        + " AS prediction, hour(datetime)::DOUBLE AS latency_ms, (drift_ratio > 0.3)::INTEGER AS drift_detected, "
        + r("drift_ratio") + f" AS drift_ratio, 'v1' AS model_version, {JSON_VALUES} FROM rd",
    ),
}
