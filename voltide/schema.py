"""Table layouts and the fixed values that the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

PRICES = ["open", "high", "low", "close"]
BAR_COLUMNS = ["datetime", *PRICES]
SERIES_KEYS = ["symbol"]

BAR_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("datetime", T.TimestampNTZType()),
        *[T.StructField(c, T.DoubleType()) for c in PRICES],
    ]
)

PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField(
            "values",
            T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in BAR_COLUMNS])),
        ),
    ]
)

PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("prediction", T.DoubleType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("drift_ratio", T.DoubleType()),
        T.StructField("drift_detected", T.BooleanType()),
        T.StructField("is_error", T.BooleanType()),
        T.StructField("model_version", T.StringType()),
    ]
)

# Defaults of the pipeline.
FETCH_SIZE = 168
VOLATILITY_WINDOW = 24
LAGS = [1, 2, 3, 4, 6, 8, 12, 24]
ROLLING_WINDOWS = [4, 8, 24]
TRAIN_RATIO = 0.8
MAX_NULL_PCT = 1.0
MIN_POINTS = 24
OUTLIER_STD = 3.0
OUTLIER_ORDER = ["close", "open", "high", "low"]

# Drift rules.
KS_ALPHA = 0.05
KS_MIN_CURRENT = 10
POINT_Z = 3.0
POINT_DRIFT_RATIO = 0.2
RANGE_DRIFT_RATIO = 0.3
EXPECTED_RANGES = {
    "close_lag_1": (0.9, 1.2),
    "close_rolling_mean_24": (0.9, 1.2),
    "close_rolling_std_24": (0.0, 0.05),
    "log_return": (-0.1, 0.1),
    "hour_sin": (-1.0, 1.0),
    "hour_cos": (-1.0, 1.0),
}

TIME_FEATURES = [
    "hour", "day_of_week", "day_of_month", "month", "hour_sin", "hour_cos", "day_sin", "day_cos",
]
PRICE_FEATURES = ["price_range", "price_change", "price_change_pct", "avg_price"]
LAG_FEATURES = [f"close_lag_{k}" for k in LAGS]
ROLLING_FEATURES = [
    f"close_rolling_{stat}_{n}" for n in ROLLING_WINDOWS for stat in ("mean", "std", "min", "max")
]
FEATURES = [*TIME_FEATURES, *PRICE_FEATURES, *LAG_FEATURES, *ROLLING_FEATURES, "log_return"]
FEATURES_WITH_VOLATILITY = [*FEATURES, "volatility"]
TARGET = "target_volatility"
