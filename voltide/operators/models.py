"""Regressors as Spark ML pipelines: training, stacking, importance, saving and scoring.

The scaler is a stage of every pipeline, so a model scores raw feature columns the same way everywhere.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide import schema as S
from voltide.operators.evaluation import cv_rmse, split_metrics
from voltide.operators.split import fit_robust
from voltide.session import stage

# Hyperparameters of the plain model and of the three base models.
PLAIN = {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
BOOSTED = {"maxIter": 200, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8",
           "minInstancesPerNode": 3}
FOREST = {"numTrees": 150, "maxDepth": 10, "featureSubsetStrategy": "sqrt", "minInstancesPerNode": 2}
SHALLOW = {"maxIter": 150, "maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 0.8, "minInstancesPerNode": 2}
SPLIT_PENALTY = 0.1
RIDGE_ALPHA = 1.0
SEED = 42

VECTOR = "feature_vector"
# Independent fits that are submitted together; small fits leave most of a cluster idle.
PARALLEL_FITS = 6
# How trees are grown, with no influence on the result: node ids are kept between levels, all nodes of a level fit one pass.
GROWING = {"cacheNodeIds": True, "checkpointInterval": 10, "maxMemoryInMB": 1024}

Result = TypeVar("Result")


def together(jobs: Sequence[Callable[[], Result]], parallel: int = PARALLEL_FITS) -> list[Result]:
    """Results of independent jobs, submitted from a few threads as Spark's own cross-validator does."""
    with ThreadPool(max(1, min(parallel, len(jobs)))) as pool:
        return pool.map(inheritable_thread_target(lambda job: job()), jobs, chunksize=1)


def gbt(params: Mapping[str, object] = PLAIN, label: str = S.TARGET, output: str = "prediction") -> GBTRegressor:
    return GBTRegressor(featuresCol=VECTOR, labelCol=label, predictionCol=output, seed=SEED, **GROWING, **params)


def forest(params: Mapping[str, object] = FOREST, label: str = S.TARGET, output: str = "prediction") -> RandomForestRegressor:
    return RandomForestRegressor(featuresCol=VECTOR, labelCol=label, predictionCol=output, seed=SEED, **GROWING, **params)


def ridge(
    train: DataFrame, alpha: float = RIDGE_ALPHA, label: str = S.TARGET, features: str = VECTOR
) -> LinearRegression:
    """Ridge with penalty ``alpha`` on the summed squares.

    Spark averages the squares and divides the penalty by the label's deviation, hence the factor.
    """
    size = train.agg(F.count(label).alias("rows"), F.stddev_pop(label).alias("deviation")).first()
    return LinearRegression(
        featuresCol=features,
        labelCol=label,
        regParam=alpha * (size["deviation"] or 1.0) / size["rows"],
        elasticNetParam=0.0,
        standardization=False,
        solver="normal",
    )


def scaling_stages(train: DataFrame, features: Sequence[str], scale: bool = True) -> list:
    """Robust scaling (fitted on ``train``) into temporary columns, and the feature vector."""
    if not scale:
        return [VectorAssembler(inputCols=list(features), outputCol=VECTOR)]
    fitted = fit_robust(train, features)
    scaled = ", ".join(
        f"(`{c}` - ({center!r}D)) / ({(spread or 1.0)!r}D) AS `_scaled_{c}`" for c, (center, spread) in fitted.items()
    )
    return [
        SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__"),
        VectorAssembler(inputCols=[f"_scaled_{c}" for c in features], outputCol=VECTOR),
    ]


def fit(train: DataFrame, features: Sequence[str], estimator: Estimator, scale: bool = True) -> PipelineModel:
    return Pipeline(stages=[*scaling_stages(train, features, scale), estimator]).fit(train)


def train_ridge(train: DataFrame, features: Sequence[str], alpha: float = RIDGE_ALPHA, label: str = S.TARGET) -> PipelineModel:
    return fit(train, features, ridge(train, alpha, label))


def base_models(
    rows: int,
    label: str = S.TARGET,
    boosted: Mapping[str, object] = BOOSTED,
    trees: Mapping[str, object] = FOREST,
    shallow: Mapping[str, object] = SHALLOW,
) -> dict[str, Estimator]:
    """The three base regressors, each with its own output column.

    The split penalty is a limit on the summed loss of a node; Spark's gain is a mean of squares, so it
    becomes ``2 * penalty / rows``.
    """
    penalised = {"minInfoGain": 2 * SPLIT_PENALTY / rows, **boosted}
    return {
        "boosted": gbt(penalised, label, "p_boosted"),
        "forest": forest(trees, label, "p_forest"),
        "shallow": gbt(shallow, label, "p_shallow"),
    }


def train_stack(
    train: DataFrame,
    features: Sequence[str],
    folds: int = 5,
    label: str = S.TARGET,
    alpha: float = RIDGE_ALPHA,
    parallel: int = PARALLEL_FITS,
    **base_params: Mapping[str, object],
) -> PipelineModel:
    """Out-of-fold predictions of the base models feed a ridge; base models are refitted on all rows.

    ``train`` has a ``fold`` column (contiguous blocks). The result is one pipeline.
    """
    rows = train.count()
    prepare = PipelineModel(stages=scaling_stages(train, features))
    prepared = stage(prepare.transform(train).select("fold", VECTOR, label), "stack")
    bases = base_models(rows, label, **base_params)
    outputs = [f"p_{name}" for name in bases]
    prepared = prepared.persist()
    inputs = [*(prepared.where(F.col("fold") != f) for f in range(folds)), prepared]
    # the last fits are those on all rows; the slowest estimators are started first
    fitted = together([lambda e=e, rows=rows: e.fit(rows) for e in bases.values() for rows in inputs], parallel)
    by_base = [fitted[k : k + folds + 1] for k in range(0, len(fitted), folds + 1)]
    held_out = None
    for f in range(folds):
        scorer = PipelineModel(stages=[models[f] for models in by_base])
        scored = scorer.transform(prepared.where(F.col("fold") == f)).select(*outputs, label)
        held_out = scored if held_out is None else held_out.unionByName(scored)
    meta_rows = stage(held_out, "held_out")
    gather = VectorAssembler(inputCols=outputs, outputCol="stacked")
    meta = ridge(meta_rows, alpha, label, "stacked").fit(gather.transform(meta_rows))
    refitted = [models[-1] for models in by_base]
    prepared.unpersist()
    return PipelineModel(stages=[*prepare.stages, *refitted, gather, meta])


def cross_validate(
    df: DataFrame, train: Callable[[DataFrame], PipelineModel], folds: int = 5, label: str = S.TARGET
) -> DataFrame:
    """RMSE over expanding folds: ``train`` sees the rows with an earlier ``test_fold`` only, its model scores the fold."""
    scored = None
    for f in range(folds):
        model = train(df.where(F.col("test_fold") < f))
        part = model.transform(df.where(F.col("test_fold") == f)).select("test_fold", label, "prediction")
        scored = part if scored is None else scored.unionByName(part)
    return cv_rmse(scored, label)


def evaluate(model: PipelineModel, rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Metrics of the train and test rows of a frame with a ``split`` column."""
    return split_metrics(model.transform(rows), len(features))


def feature_importance(model: PipelineModel, features: Sequence[str], spark: SparkSession, k: int = 20) -> DataFrame:
    """The ``k`` most important features of the last tree stage, least important first."""
    weights = next(s for s in reversed(model.stages) if hasattr(s, "featureImportances")).featureImportances
    rows = [(name, float(weights[i])) for i, name in enumerate(features)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.col("importance").desc(), "feature").limit(k).orderBy("importance", F.col("feature").desc())


# ---- persistence -------------------------------------------------------------------------------


def save(
    model: PipelineModel,
    path: str,
    version: str,
    features: Sequence[str],
    metrics: Mapping[str, float],
    spark: SparkSession,
    model_type: str = "stack",
) -> None:
    """Model under ``version=…`` and one metadata row; the metadata row is written last."""
    model.write().overwrite().save(f"{path}/version={version}")
    row = [(version, model_type, list(features), {k: float(v) for k, v in metrics.items()})]
    columns = "version string, model_type string, features array<string>, metrics map<string,double>"
    spark.createDataFrame(row, columns).coalesce(1).write.mode("append").json(f"{path}/metadata")


def versions(spark: SparkSession, path: str) -> DataFrame:
    columns = "version string, model_type string, features array<string>, metrics map<string,double>"
    return spark.read.schema(columns).json(f"{path}/metadata")


def load(spark: SparkSession, path: str, version: str | None = None) -> tuple[PipelineModel, str]:
    """The named version, or the newest one by name."""
    name = version or versions(spark, path).agg(F.max("version")).first()[0]
    if name is None:
        raise ValueError(f"no model found under {path}")
    return PipelineModel.load(f"{path}/version={name}"), name


def score(model: PipelineModel, rows: DataFrame, keep: Sequence[str] = ("symbol", "datetime")) -> DataFrame:
    """Predictions for every row: one narrow stage."""
    return model.transform(rows).select(*keep, "prediction")
