"""Registered streaming queries: the given tables read as streams and drained."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide import schema as S
from voltide.operators import drift
from voltide.operators.telemetry import LATENCY_BOUNDS
from voltide.plans import views as V
from voltide.plans.feature_queries import ALL_COLUMNS, Query, feature_ctes, r, rcols, tidy
from voltide.plans.ingest_queries import ORACLE as INGEST_ORACLE
from voltide.plans.model_queries import JSON_VALUES, RANGED, json_values
from voltide.plans.monitor_queries import ALERT_RULES_SQL, HELD_RULES_SQL, ORACLE as MONITOR_ORACLE, bucket
from voltide.session import stage, staging_path
from voltide.sources import bars as source
from voltide.streaming import jobs, lifecycle, revisions


def table_stream(df: DataFrame, tag: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stage a frame and read the staged files as a stream."""
    path = staging_path(df.sparkSession, tag)
    df.write.parquet(path)
    reader = df.sparkSession.readStream.schema(df.schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def ordered_stream(df: DataFrame, tag: str, at: str, parts: int = 4) -> DataFrame:
    """Stage a frame as files that follow each other in time, and read one file per trigger."""
    spark, path = df.sparkSession, staging_path(df.sparkSession, tag)
    held = stage(df, tag)
    first, last = held.agg(F.min(at), F.max(at)).first()
    for k in range(parts):
        low, high = first + (last - first) * k / parts, first + (last - first) * (k + 1) / parts
        inside = (F.col(at) >= F.lit(low)) & ((F.col(at) <= F.lit(high)) if k == parts - 1 else (F.col(at) < F.lit(high)))
        held.where(inside).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def prediction_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = V.events(spark, sf_dir).schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return V.predictions_of(raw)


def _ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "landed")
    payloads = source.payloads_of(V.bars_raw(spark, sf_dir))
    payloads.unionByName(payloads.where(F.col("symbol") == "view")).write.json(path)
    return tidy(jobs.run_to_table(jobs.ingest(jobs.payload_stream(spark, path)), "bars"))


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars arrive in four batches, each of them from all times."""
    path = staging_path(spark, "features")
    dealt = V.bars(spark, sf_dir).repartition(4, F.xxhash64("symbol", "datetime"))
    jobs.run_batches(table_stream(dealt, "bars", 1), revisions.feature_writer(path), "features")
    return tidy(revisions.newest(spark, path))


def _score(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = table_stream(V.requests(spark, sf_dir).repartition(3, F.xxhash64("symbol", "datetime")), "requests", 1)

    def predict(rows: DataFrame) -> DataFrame:
        value = F.abs(F.col("close_rolling_std_24")) * 0.5 + F.abs(F.col("log_return")) * 0.1
        return rows.withColumn("prediction", value)

    latency = F.hour("datetime").cast("double")
    scored = jobs.score(stream, predict, list(S.EXPECTED_RANGES), "v1", latency)
    return tidy(json_values(jobs.run_to_table(scored, "scored")))


def _windows(seconds: int, slide: int | None) -> Query:
    return lambda s, d: tidy(
        jobs.run_to_table(jobs.service_windows(prediction_stream(s, d), seconds, slide), "windows")
    )


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "alerts")

    def to_table(fired: DataFrame, batch: int) -> None:
        fired.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    metrics = jobs.window_metrics(jobs.service_windows(prediction_stream(spark, sf_dir)))
    jobs.run_batches(metrics, jobs.alert_writer([jobs.durable(to_table)]), "alerts")
    return tidy(spark.read.parquet(path).drop("batch", "message"))


def _alert_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lifecycle of every rule over four triggers, up to the last watermark."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", lifecycle.ROCKSDB)
    metrics = ordered_stream(V.metrics(spark, sf_dir), "metrics", "ts")
    return lifecycle.stretches(jobs.run_to_table(lifecycle.events(metrics), "alert-events"))


def _drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of every closed day, the samples arriving in four triggers."""
    reference, current = V.drift_samples(spark, sf_dir)
    path, kept = staging_path(spark, "drift"), staging_path(spark, "ranked")
    drift.rank_reference(reference).save(kept)
    counts = jobs.value_counts(ordered_stream(current, "current", "ts"))
    jobs.run_batches(counts, jobs.drift_writer(drift.RankedReference.load(spark, kept), path), "drift")
    return tidy(spark.read.parquet(path).drop("batch"))


QUERIES: dict[str, Query] = {
    "stream_ingest": _ingest,
    "stream_features": _features,
    "stream_score": _score,
    "stream_latency_windows": _windows(300, None),
    "stream_sliding_windows": _windows(600, 60),
    "stream_alerts": _alerts,
    "stream_alert_states": _alert_states,
    "stream_drift": _drift,
    "stream_sessions": lambda s, d: jobs.run_to_table(jobs.sessions(prediction_stream(s, d)), "sessions"),
}

# ---- oracle: a window or session is in the result once the watermark has passed its end ----------

CLOSED = "(SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"
BUCKETS = ", ".join(
    f"count(*) FILTER (WHERE latency_ms / 1000 <= {b}::DOUBLE) AS le_{str(b).replace('.', '_')}" for b in LATENCY_BOUNDS
)


def _window_parts(seconds: int, slide: int) -> list[str]:
    return [
        f"w AS (SELECT {bucket(slide)} - INTERVAL (k * {slide}) SECOND AS window_start, * FROM predictions, "
        f"range({seconds // slide}) t(k))",
        f"g AS (SELECT window_start, window_start + INTERVAL {seconds} SECOND AS window_end, count(*) AS requests, "
        "count(*) FILTER (WHERE is_error) AS errors, count(*) FILTER (WHERE is_error)::DOUBLE / count(*) AS error_rate, "
        f"count(*) / {seconds}.0::DOUBLE AS rate, avg(latency_ms) AS avg_latency_ms, max(drift_ratio) AS max_drift_ratio, "
        f"{BUCKETS} FROM w GROUP BY 1)",
        f"c AS (SELECT * FROM g WHERE window_end <= {CLOSED})",
    ]


DOUBLES = ["error_rate", "rate", "avg_latency_ms", "max_drift_ratio"]


def _window_oracle(seconds: int, slide: int) -> str:
    return V.with_views(
        "predictions", *_window_parts(seconds, slide),
        f"SELECT * EXCLUDE ({', '.join(DOUBLES)}), {rcols(DOUBLES)} FROM c",
    )


ORACLE: dict[str, str] = {
    "stream_ingest": INGEST_ORACLE["coerce_types"],
    "stream_features": V.with_views(
        "bars", *feature_ctes("bars"),
        f"SELECT {ALL_COLUMNS} FROM f WHERE datetime < (SELECT max(datetime) FROM bars b WHERE b.symbol = f.symbol)",
    ),
    "stream_score": V.with_views(
        "requests", RANGED,
        "SELECT datetime AS \"timestamp\", "
        + r("abs(coalesce(close_rolling_std_24, 0)) * 0.5::DOUBLE + abs(coalesce(log_return, 0)) * 0.1::DOUBLE")
        + " AS prediction, hour(datetime)::DOUBLE AS latency_ms, (drift_ratio > 0.3)::INTEGER AS drift_detected, "
        + r("drift_ratio") + f" AS drift_ratio, 'v1' AS model_version, {JSON_VALUES} FROM rd",
    ),
    "stream_latency_windows": _window_oracle(300, 300),
    "stream_sliding_windows": _window_oracle(600, 60),
    "stream_alerts": V.with_views(
        "predictions", *_window_parts(300, 300), ALERT_RULES_SQL,
        "m AS (SELECT window_end AS ts, 'prediction_latency_seconds' AS metric_name, avg_latency_ms / 1000 AS value FROM c "
        "UNION ALL SELECT window_end, 'error_rate', error_rate FROM c "
        "UNION ALL SELECT window_end, 'drift_ratio', max_drift_ratio FROM c)",
        f"SELECT ts, name, severity, metric_name, {r('value')} AS metric_value, {r('threshold')} AS threshold "
        "FROM m JOIN rules USING (metric_name) WHERE value > threshold",
    ),
    "stream_alert_states": V.with_views(
        "metrics",
        HELD_RULES_SQL,
        "wm AS (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM metrics)",
        "mk AS (SELECT name, severity, hold, ts, value > threshold AS is_on, mark FROM metrics JOIN rules USING (metric_name), wm "
        "WHERE ts <= mark)",
        "nb AS (SELECT *, lag(is_on) OVER w AS before, lead(ts) OVER w AS following FROM mk "
        "WINDOW w AS (PARTITION BY name ORDER BY ts))",
        "st AS (SELECT *, sum((is_on <> coalesce(before, is_on))::INTEGER) OVER (PARTITION BY name ORDER BY ts) AS stretch FROM nb)",
        "iv AS (SELECT name, severity, min(ts) AS pending_at, "
        "CASE WHEN epoch(max(coalesce(following, mark))) - epoch(min(ts)) >= max(hold) THEN min(ts) + to_seconds(max(hold)) END "
        "AS fired_at, CASE WHEN count(*) = count(following) THEN max(following) END AS resolved_at "
        "FROM st WHERE is_on GROUP BY name, severity, stretch)",
        "SELECT *, CASE WHEN fired_at IS NOT NULL AND resolved_at IS NOT NULL THEN 'resolved' WHEN fired_at IS NOT NULL "
        "THEN 'firing' WHEN resolved_at IS NOT NULL THEN 'cleared' ELSE 'pending' END AS state FROM iv",
    ),
    "stream_drift": (
        "SELECT day AS window_start, * EXCLUDE (day) FROM (" + MONITOR_ORACLE["drift_by_window"] + ") "
        f"WHERE day + INTERVAL 1 DAY <= {CLOSED}"
    ),
    "stream_sessions": V.with_views(
        "predictions",
        "p AS (SELECT series, \"timestamp\" AS t, coalesce((\"timestamp\" >= lag(\"timestamp\") OVER (PARTITION BY series "
        "ORDER BY \"timestamp\", id) + INTERVAL 1 HOUR)::INTEGER, 0) AS fresh, id FROM predictions)",
        "i AS (SELECT series, t, sum(fresh) OVER (PARTITION BY series ORDER BY t, id ROWS UNBOUNDED PRECEDING) AS n FROM p)",
        "s AS (SELECT series, min(t) AS began, max(t) + INTERVAL 1 HOUR AS closed, count(*) AS rows FROM i GROUP BY series, n)",
        f"SELECT * FROM s WHERE closed <= {CLOSED}",
    ),
}
