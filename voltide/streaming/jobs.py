"""Structured Streaming versions of ingest, scoring, service metrics, alerts and drift.

Every function takes a streaming DataFrame and returns one (or a foreachBatch writer), so that sources,
sinks and triggers stay the caller's choice. ``run_to_table`` drains what is available into a Parquet
table, the cadence of a scheduled job.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide import schema as S
from voltide.functions.clock import utc_instant, utc_wall
from voltide.operators import alerts, drift, scoring
from voltide.operators.distribution import ranked_values
from voltide.operators.telemetry import DAY, LATENCY_BOUNDS
from voltide.session import staging_path
from voltide.sources.bars import coerce_types, payload_bars

log = logging.getLogger(__name__)


# ---- driving -------------------------------------------------------------------------------------


def run_to_table(stream: DataFrame, tag: str, path: str | None = None) -> DataFrame:
    """Process all available input once, append the result to a Parquet table and return that table.

    The checkpoint lives beside the table, so the next call with the same ``path`` continues.
    """
    spark = stream.sparkSession
    path = path or staging_path(spark, tag)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{path}/table")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/table")


def run_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], tag: str, path: str | None = None) -> None:
    """Process all available input once through a foreachBatch writer."""
    path = path or staging_path(stream.sparkSession, tag)
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


# ---- ingest --------------------------------------------------------------------------------------


def payload_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(S.PAYLOAD_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def ingest(payloads: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Typed bars, one per symbol and time; repeats that arrive within the delay are dropped."""
    bars = coerce_types(payload_bars(payloads)).withColumn("_event_time", utc_instant(F.col("datetime")))
    unique = bars.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(["symbol", "datetime"])
    return unique.drop("_event_time")


# ---- scoring -------------------------------------------------------------------------------------


def score(
    requests: DataFrame, predict: Callable[[DataFrame], DataFrame], expected: Sequence[str], version: str, latency_ms: Column
) -> DataFrame:
    """Prediction-log rows for a stream of feature maps; ``predict`` adds ``prediction`` (a model's transform)."""
    return scoring.score_records(predict(scoring.align_features(requests, expected)), version, latency_ms)


# ---- service metrics -----------------------------------------------------------------------------


def service_windows(
    predictions: DataFrame, seconds: int = 300, slide: int | None = None, delay: str = "10 minutes", at: str = "timestamp"
) -> DataFrame:
    """Requests, errors, rates, mean latency and cumulative latency buckets per event-time window."""
    span = F.window(at, f"{seconds} seconds", f"{slide or seconds} seconds")
    value = F.col("latency_ms") / F.lit(1000.0)
    buckets = [
        F.count_if(value <= b).alias(f"le_{str(b).replace('.', '_')}") for b in LATENCY_BOUNDS
    ]
    timed = predictions.withColumn(at, utc_instant(F.col(at))).withWatermark(at, delay)
    grouped = timed.groupBy(span.alias("span")).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if("is_error").alias("errors"),
        (F.count_if("is_error") / F.count(F.lit(1))).alias("error_rate"),
        (F.count(F.lit(1)) / F.lit(float(seconds))).alias("rate"),
        F.avg("latency_ms").alias("avg_latency_ms"),
        F.max("drift_ratio").alias("max_drift_ratio"),
        *buckets,
    )
    return grouped.select(
        utc_wall(F.col("span.start")).alias("window_start"),
        utc_wall(F.col("span.end")).alias("window_end"),
        *[c for c in grouped.columns if c != "span"],
    )


def sessions(rows: DataFrame, keys: Sequence[str] = ("series",), gap: str = "1 hour", delay: str = "10 minutes", at: str = "timestamp") -> DataFrame:
    """Activity sessions per series that end after ``gap`` without a row."""
    timed = rows.withColumn(at, utc_instant(F.col(at))).withWatermark(at, delay)
    grouped = timed.groupBy(*keys, F.session_window(at, gap).alias("span")).agg(F.count(F.lit(1)).alias("rows"))
    return grouped.select(
        *keys, utc_wall(F.col("span.start")).alias("began"), utc_wall(F.col("span.end")).alias("closed"), "rows"
    )


# ---- alerts --------------------------------------------------------------------------------------


def window_metrics(windows: DataFrame) -> DataFrame:
    """Long metric rows of service windows, as the alert rules name them."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("metric_name"), value.alias("value"))
            for name, value in (
                ("prediction_latency_seconds", F.col("avg_latency_ms") / 1000),
                ("error_rate", F.col("error_rate")),
                ("drift_ratio", F.col("max_drift_ratio")),
            )
        ]
    )
    return windows.select(F.col("window_end").alias("ts"), F.inline(pairs))


def durable(sink: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Marks a sink whose failure must stop the batch; it has to replace what an earlier try of the batch wrote."""
    sink.durable = True
    return sink


def alert_writer(
    sinks: Sequence[Callable[[DataFrame, int], None]], rules: Sequence[alerts.Rule] = tuple(alerts.DEFAULT_RULES)
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer that evaluates the rules and hands the alerts to every sink.

    A failing sink is logged and does not keep the alerts from the others. If a durable one failed, the batch fails
    after all have run, so that the stream tries it again.
    """

    def write(metrics: DataFrame, batch: int) -> None:
        fired, failed = alerts.evaluate(metrics, rules).persist(), None
        try:
            for sink in sinks:
                try:
                    sink(fired, batch)
                except Exception as error:
                    log.exception("alert sink failed in batch %s", batch)
                    if getattr(sink, "durable", False):
                        failed = failed or error
        finally:
            fired.unpersist()
        if failed is not None:
            raise failed

    return write


# ---- drift ---------------------------------------------------------------------------------------


def value_counts(samples: DataFrame, seconds: int = DAY, delay: str = "10 minutes", at: str = "ts") -> DataFrame:
    """Rows per (window, feature, value) of long samples, once the watermark has closed the window."""
    timed = samples.withColumn(at, utc_instant(F.col(at))).withWatermark(at, delay)
    counted = timed.groupBy(F.window(at, f"{seconds} seconds").alias("span"), "feature", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.select(utc_wall(F.col("span.start")).alias("window_start"), "feature", "value", "n")


def drift_writer(reference: drift.RankedReference, path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer for ``value_counts``: drift metrics of every closed window against a reference ranked before.

    A window closes as a whole, so it lies in one batch, however its rows fell into triggers. A batch writes its own
    partition, so a repeated batch replaces its result.
    """

    def write(counts: DataFrame, batch: int) -> None:
        keys = ["window_start", "feature"]
        points = ranked_values(counts, keys, "value", {"n": F.sum("n")})
        metrics = drift.summarise(drift.compare_points(reference, points), ["window_start"])
        metrics.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return write
