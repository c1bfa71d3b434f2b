"""Input views over the given tables: bars, predictions, metrics, drift samples, requests.

Each view exists twice: as a DataFrame (``bars(spark, dir)`` …) and as the SQL text that defines the
same rows for the oracle (``SQL["bars"]`` …).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide import schema as S
from voltide.functions.clock import floor_time, plus_seconds
from voltide.operators.features import cyclic_hour, calendar, lags_of, log_return_of, rolling_of
from voltide.operators.series import chunk_window, drop_halo, running_sum, sliced, with_halo
from voltide.operators.telemetry import LATENCY_BOUNDS
from voltide.session import stage


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly OHLC per event type. Partial aggregation collapses a hot symbol before the exchange."""
    at = F.struct("ts", "event_id")
    return (
        events(spark, sf_dir)
        .groupBy(F.col("event_type").alias("symbol"), floor_time(F.col("ts"), 3600).alias("datetime"))
        .agg(
            F.min_by("value", at).alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", at).alias("close"),
        )
    )


def bar_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bars as a stored table, for operators that read their input more than once.

    The events are scanned once; each branch of the operator then reads the few columns it needs.
    """
    return stage(bars(spark, sf_dir), "bars")


def gappy_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(bars_gappy(spark, sf_dir), "gappy")


def bars_gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    gap = (F.hour("datetime") + F.dayofmonth("datetime")) % 11 == 0
    return bars(spark, sf_dir).withColumn("close", F.when(~gap, F.col("close")))


def bars_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gappy bars, one symbol of which has lost its name; some rows have lost their time."""
    lost = (F.hour("datetime") == 3) & (F.dayofmonth("datetime") % 3 == 0)
    return bars_gappy(spark, sf_dir).select(
        F.when(F.col("symbol") != "view", F.col("symbol")).alias("symbol"),
        F.when(~lost, F.col("datetime")).alias("datetime"),
        *S.PRICES,
    )


def bars_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars as text, numbers with two decimals, some of them unparsable."""
    text = {c: F.call_function("format_number", F.col(c), F.lit("0.00")) for c in S.PRICES}
    damaged = (F.hour("datetime") == 7) & (F.dayofmonth("datetime") % 2 == 0)
    return bars(spark, sf_dir).select(
        "symbol",
        F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"),
        *[text[c].alias(c) for c in ("open", "high", "low")],
        F.when(damaged, F.lit("n/a")).otherwise(text["close"]).alias("close"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions_of(events(spark, sf_dir))


def predictions_of(rows: DataFrame) -> DataFrame:
    """One prediction per event; also for a stream of events."""
    ratio = (F.col("event_id") % 100) / F.lit(100.0)
    return rows.select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("timestamp"),
        (F.col("value") / 10000).alias("prediction"),
        F.col("value").alias("latency_ms"),
        ratio.alias("drift_ratio"),
        (ratio > S.RANGE_DRIFT_RATIO).alias("drift_detected"),
        (F.col("event_type") == "error").alias("is_error"),
        F.concat(F.lit("v"), (F.col("user_id") % 3).cast("string")).alias("model_version"),
        F.col("event_type").alias("series"),
    )


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly long metric table derived from the predictions."""
    hourly = (
        predictions(spark, sf_dir)
        .groupBy(floor_time(F.col("timestamp"), 3600).alias("ts"))
        .agg(
            (F.max("latency_ms") / 200).alias("prediction_latency_seconds"),
            F.avg("drift_ratio").alias("drift_ratio"),
            (F.count_if("is_error") / F.count(F.lit(1))).alias("error_rate"),
        )
    )
    return hourly.unpivot(
        ["ts"], ["prediction_latency_seconds", "drift_ratio", "error_rate"], "metric_name", "value"
    )


def bucket_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scrapes of latency bucket counters after every prediction; every bucket starts again at a count of its own."""
    bounds = [*LATENCY_BOUNDS, float("inf")]
    cells = F.array(
        *[F.struct(F.lit(b).alias("le"), F.lit(200 + 30 * k).alias("wraps")) for k, b in enumerate(bounds)]
    )
    rows = predictions(spark, sf_dir).select("series", "timestamp", "id", "latency_ms", F.inline(cells))
    hit = rows.withColumn("hit", (F.col("latency_ms") / F.lit(1000.0) <= F.col("le")).cast("long"))
    keys = ["series", "le"]
    counted = running_sum(sliced(hit, keys, "timestamp", ["id"]), "hit", "n", keys, "timestamp", ["id"])
    return counted.select(*keys, "timestamp", "id", (F.col("n") % F.col("wraps")).alias("cumulative"))


DRIFT_SPLIT = "2024-01-16"


def drift_samples(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Long reference and current samples: events before and from the split date."""
    rows = events(spark, sf_dir).select(F.col("event_type").alias("feature"), "value", "ts")
    split = F.lit(DRIFT_SPLIT).cast("timestamp_ntz")
    reference = rows.where(F.col("ts") < split).select("feature", "value")
    return reference, rows.where(F.col("ts") >= split).select("feature", "value", "ts")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse feature maps of rescaled bars; some keys are missing, one is unknown."""
    scaled = bar_table(spark, sf_dir).select("symbol", "datetime", (1 + F.col("close") / 1000).alias("close"))
    w = chunk_window()
    rows = with_halo(scaled, lookback=24)
    rows = rows.withColumns(
        {
            **lags_of("close", [1], w),
            "close_rolling_mean_24": rolling_of("close", "mean", 24, w),
            "close_rolling_std_24": rolling_of("close", "std", 24, w),
            "log_return": log_return_of("close", w),
        }
    )
    rows = cyclic_hour(calendar(drop_halo(rows)))
    values = {
        "close_lag_1": F.col("close_lag_1"),
        "close_rolling_mean_24": F.col("close_rolling_mean_24"),
        "close_rolling_std_24": F.col("close_rolling_std_24"),
        "log_return": F.when(F.col("hour") % 5 != 0, F.col("log_return")),
        "hour_sin": F.col("hour_sin"),
        "hour_cos": F.when(F.col("hour") % 7 != 0, F.col("hour_cos")),
        "custom": F.when(F.col("hour") % 4 == 0, F.lit(1.0)),
    }
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in values.items()])
    return rows.select(
        "symbol",
        "datetime",
        F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())).alias("features"),
    )


def single_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All symbols put one after another in time as one long series."""
    order = F.array_position(F.array(*[F.lit(s) for s in SYMBOLS]), F.col("symbol")).cast("long")
    shift = (order - 1) * (30 * 86400)
    return bars(spark, sf_dir).select(
        F.lit("ALL").alias("symbol"), plus_seconds(F.col("datetime"), shift).alias("datetime"), *S.PRICES
    )


SYMBOLS = ["click", "error", "purchase", "signup", "view"]

# ---- the same views for the oracle --------------------------------------------------------------

_BARS = """
    SELECT event_type AS symbol, date_trunc('hour', ts)::TIMESTAMP AS datetime,
           first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
           last(value ORDER BY ts, event_id) AS close
    FROM events GROUP BY 1, 2"""

SQL = {
    "bars": _BARS,
    "bars_gappy": """
    SELECT symbol, datetime, open, high, low,
           CASE WHEN (hour(datetime) + day(datetime)) % 11 <> 0 THEN close END AS close
    FROM bars""",
    "bars_null_keys": """
    SELECT CASE WHEN symbol <> 'view' THEN symbol END AS symbol,
           CASE WHEN NOT (hour(datetime) = 3 AND day(datetime) % 3 = 0) THEN datetime END AS datetime,
           open, high, low, close
    FROM bars_gappy""",
    "bars_raw": """
    SELECT symbol, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, printf('%.2f', open) AS open,
           printf('%.2f', high) AS high, printf('%.2f', low) AS low,
           CASE WHEN hour(datetime) = 7 AND day(datetime) % 2 = 0 THEN 'n/a'
                ELSE printf('%.2f', close) END AS close
    FROM bars""",
    "predictions": """
    SELECT event_id AS id, ts AS "timestamp", value / 10000 AS prediction, value AS latency_ms,
           (event_id % 100) / 100.0::DOUBLE AS drift_ratio,
           (event_id % 100) / 100.0::DOUBLE > 0.3::DOUBLE AS drift_detected,
           event_type = 'error' AS is_error, 'v' || (user_id % 3)::VARCHAR AS model_version,
           event_type AS series
    FROM events""",
    "hourly": """
    SELECT date_trunc('hour', "timestamp")::TIMESTAMP AS ts,
           max(latency_ms) / 200 AS prediction_latency_seconds, avg(drift_ratio) AS drift_ratio,
           count(*) FILTER (WHERE is_error)::DOUBLE / count(*) AS error_rate
    FROM predictions GROUP BY 1""",
    "metrics": """
    SELECT ts, 'prediction_latency_seconds' AS metric_name, prediction_latency_seconds AS value FROM hourly
    UNION ALL SELECT ts, 'drift_ratio', drift_ratio FROM hourly
    UNION ALL SELECT ts, 'error_rate', error_rate FROM hourly""",
    "bucket_counters": """
    SELECT series, le, "timestamp", id, sum((latency_ms / 1000.0::DOUBLE <= le)::INTEGER) OVER (
           PARTITION BY series, le ORDER BY "timestamp", id ROWS UNBOUNDED PRECEDING) % wraps AS cumulative
    FROM predictions, (VALUES """ + ", ".join(
        f"({b}, {200 + 30 * k})" for k, b in enumerate([*(f"{b}::DOUBLE" for b in LATENCY_BOUNDS), "'inf'::DOUBLE"])
    ) + ") v(le, wraps)",
    "ref": f"SELECT event_type AS feature, value FROM events WHERE ts < TIMESTAMP '{DRIFT_SPLIT}'",
    "cur": f"SELECT event_type AS feature, value, ts FROM events WHERE ts >= TIMESTAMP '{DRIFT_SPLIT}'",
    "scaled": "SELECT symbol, datetime, 1 + close / 1000 AS close FROM bars",
    "scaled_features": """
    SELECT symbol, datetime, hour(datetime) AS hour,
           lag(close) OVER w AS close_lag_1,
           CASE WHEN count(close) OVER f = 24 THEN avg(close) OVER f END AS close_rolling_mean_24,
           CASE WHEN count(close) OVER f = 24 THEN stddev_samp(close) OVER f END AS close_rolling_std_24,
           ln(close / lag(close) OVER w) AS log_return
    FROM scaled
    WINDOW w AS (PARTITION BY symbol ORDER BY datetime),
           f AS (PARTITION BY symbol ORDER BY datetime ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)""",
    "requests": """
    SELECT symbol, datetime, close_lag_1, close_rolling_mean_24, close_rolling_std_24,
           CASE WHEN hour % 5 <> 0 THEN log_return END AS log_return,
           sin(2 * pi() * hour / 24) AS hour_sin,
           CASE WHEN hour % 7 <> 0 THEN cos(2 * pi() * hour / 24) END AS hour_cos,
           CASE WHEN hour % 4 = 0 THEN 1.0::DOUBLE END AS custom
    FROM scaled_features""",
}

_NEEDS = {
    "bars": [],
    "bars_gappy": ["bars"],
    "bars_null_keys": ["bars_gappy"],
    "bars_raw": ["bars"],
    "predictions": [],
    "hourly": ["predictions"],
    "metrics": ["hourly"],
    "bucket_counters": ["predictions"],
    "ref": [],
    "cur": [],
    "scaled": ["bars"],
    "scaled_features": ["scaled"],
    "requests": ["scaled_features"],
}


def with_views(names: str, *tail: str) -> str:
    """``WITH`` text that defines the named views, what they need, and further ``name AS (…)`` parts.

    The last element of ``tail`` is the final SELECT.
    """
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in _NEEDS[name]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        visit(name)
    parts = [f"{name} AS ({SQL[name]})" for name in ordered] + list(tail[:-1])
    return "WITH " + ",\n".join(parts) + "\n" + tail[-1]
