"""The prediction log, and statistics and views over it.

An append writes its rows below a folder of its own, by day, and then one line per day with rows, smallest and largest id;
the lines make the rows visible. What an interrupted append left behind is in no line and never read.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from voltide.functions.numeric import exact_round

# Latency classes (lower bound inclusive) and the charted drift threshold.
LATENCY_CLASSES = [
    ("<10ms", None, 10.0), ("10-25ms", 10.0, 25.0), ("25-50ms", 25.0, 50.0),
    ("50-100ms", 50.0, 100.0), (">100ms", 100.0, None),
]
DRIFT_CHART_THRESHOLD = 20
LINE_SCHEMA = "folder string, day string, n_rows long, n_ids long, min_id long, max_id long"


def append(predictions: DataFrame, path: str) -> None:
    """Add predictions to the log under ``path``; rows without a time share a day of their own."""
    spark, folder = predictions.sparkSession, f"data/{uuid.uuid4().hex}"
    day = F.coalesce(F.date_format("timestamp", "yyyy-MM-dd"), F.lit("none"))
    predictions.withColumn("_day", day).write.partitionBy("_day").parquet(f"{path}/{folder}")
    stored = StructType([*predictions.schema.fields, StructField("_day", StringType())])
    found = spark.read.schema(stored).parquet(f"{path}/{folder}").groupBy(F.col("_day").alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("id").alias("n_ids"),
        F.min("id").alias("min_id"),
        F.max("id").alias("max_id"),
    )
    found.select(F.lit(folder).alias("folder"), "*").coalesce(1).write.mode("append").json(f"{path}/lines")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per append and day; none if nothing was appended."""
    try:
        return spark.read.schema(LINE_SCHEMA).json(f"{path}/lines")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LINE_SCHEMA)


def total(spark: SparkSession, path: str) -> DataFrame:
    """All predictions of the log, counted from its lines."""
    return lines(spark, path).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_predictions"))


def newest_logged(spark: SparkSession, path: str, n: int, schema: StructType) -> DataFrame:
    """The ``n`` rows of the log with the largest ids, read from the folders that can hold one of them.

    Taking lines from the largest smallest id on until they hold ``n`` ids gives a bound that none of the ``n`` lies below, in
    whatever order ids were appended. Only the names of the chosen folders come to the driver.
    """
    known = lines(spark, path)
    order = Window.orderBy(F.col("min_id").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    running = known.where("n_ids > 0").select("min_id", F.sum("n_ids").over(order).alias("held"))
    bound = running.where(F.col("held") >= n).agg(F.max("min_id")).first()[0]
    chosen = known if bound is None else known.where(F.col("max_id") >= bound)
    folders = [f"{path}/{row['folder']}/_day={row['day']}" for row in chosen.select("folder", "day").distinct().collect()]
    if not folders or n <= 0:
        return spark.createDataFrame([], schema)
    return newest(spark.read.schema(schema).parquet(*folders), n)


def newest(predictions: DataFrame, n: int) -> DataFrame:
    return predictions.orderBy(F.col("id").desc()).limit(n)


def stats(predictions: DataFrame, metrics: DataFrame | None = None, last: int = 100) -> DataFrame:
    """Total predictions, latency and drift alerts of the last ones, and model accuracy from its MAPE."""
    none = F.lit(None)
    total = predictions.agg(F.count(F.lit(1)).alias("total_predictions")).select(
        "total_predictions",
        none.cast("double").alias("avg_latency_ms"),
        none.cast("long").alias("drift_alerts"),
        none.cast("double").alias("model_accuracy"),
    )
    recent = newest(predictions, last).agg(
        exact_round(F.avg("latency_ms"), 2).alias("avg_latency_ms"),
        F.count_if("drift_detected").alias("drift_alerts"),
    )
    parts = total.unionByName(recent, allowMissingColumns=True)
    if metrics is not None:
        accuracy = metrics.select(exact_round((1 - F.col("mape") / 100) * 100, 1).alias("model_accuracy"))
        parts = parts.unionByName(accuracy, allowMissingColumns=True)
    return parts.agg(
        F.max("total_predictions").alias("total_predictions"),
        F.coalesce(F.max("avg_latency_ms"), F.lit(0.0)).alias("avg_latency_ms"),
        F.coalesce(F.max("drift_alerts"), F.lit(0)).alias("drift_alerts"),
        F.coalesce(F.max("model_accuracy"), F.lit(0.0)).alias("model_accuracy"),
    )


def recent(predictions: DataFrame, n: int = 20) -> DataFrame:
    """Newest predictions with display rounding."""
    return newest(predictions, n).select(
        "timestamp",
        exact_round(F.col("prediction"), 6).alias("prediction"),
        exact_round(F.col("latency_ms"), 2).alias("latency_ms"),
        "drift_detected",
        exact_round(F.col("drift_ratio"), 4).alias("drift_ratio"),
    )


def history(predictions: DataFrame, n: int = 100) -> DataFrame:
    return newest(predictions, n).select(
        "timestamp", "prediction", "latency_ms", "drift_detected", "drift_ratio"
    )


def latency_distribution(predictions: DataFrame, last: int | None = None) -> DataFrame:
    """Rows per latency class, empty classes included; no rows at all give no classes."""
    rows = predictions if last is None else newest(predictions, last)
    latency = F.col("latency_ms")

    def inside(low: float | None, high: float | None):
        above = F.lit(True) if low is None else latency >= low
        return above if high is None else above & (latency < high)

    counts = [F.count_if(inside(low, high)).alias(f"c{i}") for i, (_, low, high) in enumerate(LATENCY_CLASSES)]
    pairs = [
        F.struct(F.lit(i).alias("position"), F.lit(label).alias("bucket"), F.col(f"c{i}").alias("count"))
        for i, (label, _, _) in enumerate(LATENCY_CLASSES)
    ]
    counted = rows.agg(F.count(latency).alias("rows"), *counts).where(F.col("rows") > 0)
    return counted.select(F.inline(F.array(*pairs)))


def drift_history(predictions: DataFrame, n: int = 24) -> DataFrame:
    """Newest drift scores in percent, oldest first."""
    return newest(predictions, n).orderBy("id").select(
        "id",
        "timestamp",
        exact_round(F.col("drift_ratio") * 100, 1).alias("score"),
        F.lit(DRIFT_CHART_THRESHOLD).alias("threshold"),
    )


def volatility_series(predictions: DataFrame, n: int = 24) -> DataFrame:
    """Newest predictions for the chart, oldest first."""
    return newest(predictions, n).orderBy("id").select("id", "timestamp", "prediction")
