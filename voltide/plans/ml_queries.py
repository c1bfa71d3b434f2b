"""Registered queries that train models on the feature rows.

All train on all rows with the full settings of the library. Tree ensembles have no SQL form, so these have no oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide import schema as S
from voltide.operators import boosting, evaluation, models, scoring, split
from voltide.plans import model_queries
from voltide.plans.feature_queries import Query
from voltide.session import stage, staging_path

ALL = S.FEATURES_WITH_VOLATILITY


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete rows with split, block fold and expanding test fold, staged once."""
    splits = {"split": split.split_label(), "fold": split.block_fold(), "test_fold": split.expanding_fold()}
    return stage(split.with_splits(model_queries.samples(spark, sf_dir), splits), "training")


def _train_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("split") == "train")


def _plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training_rows(spark, sf_dir)
    model = boosting.fit(_train_rows(rows), S.FEATURES, S.TARGET, boosting.PLAIN)
    return evaluation.split_metrics(boosting.predict(model, rows), len(S.FEATURES))


def _forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training_rows(spark, sf_dir)
    model = models.fit(_train_rows(rows), ALL, models.forest())
    return models.evaluate(model, rows, ALL)


def _tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two boosted base models; the first has leaf and split penalties, which only ``boosting`` knows."""
    rows = training_rows(spark, sf_dir)
    train = _train_rows(rows)
    penalised, shallow = models.together(
        [
            lambda: boosting.fit(train, ALL, S.TARGET, boosting.PENALISED),
            lambda: models.fit(train, ALL, models.gbt(models.SHALLOW)),
        ]
    )
    scored = evaluation.split_metrics(boosting.predict(penalised, rows), len(ALL)).withColumn("model", F.lit("boosted"))
    return scored.unionByName(models.evaluate(shallow, rows, ALL).withColumn("model", F.lit("shallow")))


def _ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training_rows(spark, sf_dir)
    return models.evaluate(models.train_ridge(_train_rows(rows), ALL), rows, ALL)


def _ridge_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folds lie in the train rows; scaling and penalty come from the rows of each fold."""
    kept = stage(_train_rows(training_rows(spark, sf_dir)).drop("test_fold"), "cv-rows")
    rows = stage(split.expanding_folds(kept), "cv-folds")
    return models.cross_validate(rows, lambda train: models.train_ridge(train, ALL))


def _stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training_rows(spark, sf_dir)
    return models.evaluate(models.train_stack(_train_rows(rows), ALL), rows, ALL)


def _importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training_rows(spark, sf_dir)
    model = models.fit(_train_rows(rows), ALL, models.forest(), scale=False)
    return models.feature_importance(model, ALL, spark)


def _save_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training_rows(spark, sf_dir)
    model = models.train_ridge(_train_rows(rows), ALL)
    path = staging_path(spark, "models")
    for version in ("20240101_000000", "20240102_000000"):
        metrics = {f"{r['split']}_rmse": r["rmse"] for r in models.evaluate(model, rows, ALL).collect()}
        models.save(model, path, version, ALL, metrics, spark, "ridge")
    loaded, name = models.load(spark, path)
    return models.score(loaded, rows).withColumn("model_version", F.lit(name))


def _score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training_rows(spark, sf_dir)
    model = models.train_ridge(_train_rows(rows), ALL)
    return scoring.risk_level(models.score(model, rows))


QUERIES: dict[str, Query] = {
    "train_gbt": _plain,
    "train_rf": _forest,
    "train_gbt_tuned": _tuned,
    "train_ridge": _ridge,
    "cross_validate_ridge": _ridge_cv,
    "train_stack": _stack,
    "feature_importance_topk": _importance,
    "model_save_load": _save_load,
    "score_batch": _score_batch,
}

ORACLE: dict[str, str] = {}
