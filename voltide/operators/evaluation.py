"""Regression metrics, model comparison, gates and the retraining decision."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltide import schema as S

METRICS = ["rmse", "mae", "r2", "mape"]

# Promotion and quality limits.
MAX_RMSE_FACTOR = 1.10
GATES = [("mape", "lt", 20.0), ("rmse", "lt", 0.001), ("n_features", "gte", 20.0)]
TARGETS = [("r2", "gt", 0.70), ("mape", "lt", 15.0)]
RETRAIN_DRIFT = 0.5
RETRAIN_RMSE_INCREASE = 0.1


def naive_forecast(df: DataFrame) -> DataFrame:
    """Persistence: the next volatility is predicted to be the present one."""
    return df.withColumn("prediction", F.col("volatility"))


def _scores(label: str, prediction: str, clip: bool) -> list[Column]:
    y, error = F.col(label), F.col(label) - F.col(prediction)
    squares, spread = F.sum(error * error), F.var_pop(y) * F.count(y)
    scale = F.greatest(F.abs(y), F.lit(sys.float_info.epsilon)) if clip else F.abs(y)
    return [
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(squares, spread)).alias("r2"),
        (F.avg(F.try_divide(F.abs(error), scale)) * 100).alias("mape"),
    ]


def regression_metrics(
    df: DataFrame,
    keys: Sequence[str] = (),
    label: str = S.TARGET,
    prediction: str = "prediction",
    clip: bool = False,
) -> DataFrame:
    """RMSE, MAE, R2 and MAPE in one aggregation over scored rows.

    Rows with a zero label do not enter the MAPE unless ``clip`` replaces tiny labels by machine epsilon.
    """
    scored = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    return scored.groupBy(*keys).agg(*_scores(label, prediction, clip), F.count(F.lit(1)).alias("samples"))


def split_metrics(df: DataFrame, n_features: int, **columns: str) -> DataFrame:
    """Metrics of the train and the test rows, with sample and feature counts."""
    scored = regression_metrics(df, ["split"], clip=True, **columns)
    return scored.withColumn("n_features", F.lit(n_features))


def cv_rmse(df: DataFrame, label: str = S.TARGET, prediction: str = "prediction") -> DataFrame:
    """Root of the mean of the fold MSEs over rows with a ``test_fold`` from 0 up."""
    error = F.col(label) - F.col(prediction)
    folds = df.where(F.col("test_fold") >= 0).groupBy("test_fold").agg(F.avg(error * error).alias("mse"))
    return folds.agg(F.sqrt(F.avg("mse")).alias("cv_rmse"), F.count("mse").alias("folds"))


def long_metrics(df: DataFrame, names: Sequence[str] = tuple(METRICS), ids: Sequence[str] = ()) -> DataFrame:
    doubles = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in names])
    return doubles.unpivot(list(ids), list(names), "metric", "value")


def compare_metrics(new: DataFrame, current: DataFrame) -> DataFrame:
    """Relative change of each metric; a new RMSE above 1.10 times the current one blocks promotion."""
    both = new.select("metric", F.col("value").alias("new_value")).join(
        current.select("metric", F.col("value").alias("current_value")), "metric"
    )
    too_high = (F.col("metric") == "rmse") & (
        F.col("new_value") > F.col("current_value") * F.lit(MAX_RMSE_FACTOR)
    )
    change = F.try_divide(F.col("new_value") - F.col("current_value"), F.col("current_value"))
    return both.withColumns({"relative_change": change, "blocks_promotion": too_high})


def _holds(comparison: str, value: Column, limit: float) -> Column:
    return {"lt": value < limit, "gt": value > limit, "gte": value >= limit}[comparison]


def quality_gate(metrics: DataFrame, rules: Sequence[tuple[str, str, float]] = tuple(GATES)) -> DataFrame:
    """One verdict per rule over a wide metrics frame."""
    verdicts = [
        F.struct(
            F.lit(name).alias("metric"),
            F.col(name).cast("double").alias("value"),
            F.lit(comparison).alias("comparison"),
            F.lit(limit).alias("limit_value"),
            F.coalesce(_holds(comparison, F.col(name), limit), F.lit(False)).alias("passed"),
        )
        for name, comparison, limit in rules
    ]
    ids = [c for c in metrics.columns if c in ("split", "model_version")]
    return metrics.select(*ids, F.inline(F.array(*verdicts)))


def best_runs(runs: DataFrame, k: int = 10) -> DataFrame:
    """Runs ranked by RMSE, then R2, then name; the first is the one to serve."""
    best = runs.agg(F.min(F.struct("rmse", (-F.col("r2")).alias("r2"), "model_version")).alias("b"))
    top = runs.orderBy(F.col("rmse"), F.col("r2").desc(), F.col("model_version")).limit(k)
    chosen = best.select(F.col("b.model_version").alias("model_version"), F.lit(True).alias("_best"))
    return top.join(chosen, "model_version", "left").select(
        *runs.columns, F.coalesce("_best", F.lit(False)).alias("is_best")
    )


def retrain_decision(drift: DataFrame, compared: DataFrame) -> DataFrame:
    """Retrain when the drift ratio or the relative RMSE increase passes its limit."""
    facts = drift.select(
        F.col("drift_ratio"), F.lit(None).cast("double").alias("rmse_increase_pct")
    ).unionByName(
        compared.where(F.col("metric") == "rmse").select(
            F.lit(None).cast("double").alias("drift_ratio"), F.col("relative_change").alias("rmse_increase_pct")
        )
    )
    wide = facts.agg(
        F.max("drift_ratio").alias("drift_ratio"), F.max("rmse_increase_pct").alias("rmse_increase_pct")
    )
    reasons = F.coalesce(F.col("drift_ratio") > RETRAIN_DRIFT, F.lit(False)) | F.coalesce(
        F.col("rmse_increase_pct") > RETRAIN_RMSE_INCREASE, F.lit(False)
    )
    return wide.withColumn("retrain", reasons)
