"""Batch scoring of sparse feature maps: alignment, risk text, range drift, prediction records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltide import schema as S
from voltide.functions.numeric import fixed_text, percent_text

# Risk limits and wording.
RISK_LIMITS = {"Low": 0.005, "Medium": 0.015}
RISK_TEXT = {
    "Low": ("Low volatility expected", "Market conditions appear stable with minimal price fluctuations.", "High"),
    "Medium": ("Moderate volatility expected", "Normal market activity with typical price movements.", "Medium"),
    "High": ("High volatility expected", "Market conditions are turbulent with significant price swings.", "High"),
}


def align_features(df: DataFrame, expected: Sequence[str], features: str = "features") -> DataFrame:
    """One column per expected feature; missing ones are 0.0 and unknown keys are ignored."""
    return df.withColumns(
        {
            name: F.coalesce(F.try_element_at(F.col(features), F.lit(name)), F.lit(0.0))
            for name in expected
        }
    )


def risk_level(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Risk class, confidence and a readable sentence for a predicted volatility."""
    p = F.col(prediction)

    def by_level(choose) -> Column:
        return (
            F.when(p < RISK_LIMITS["Low"], choose("Low"))
            .when(p < RISK_LIMITS["Medium"], choose("Medium"))
            .otherwise(choose("High"))
        )

    numbers = F.concat(F.lit(" ("), fixed_text(p, 4), F.lit(" or "), percent_text(p, 2), F.lit("). "))
    return df.withColumns(
        {
            "risk_level": by_level(F.lit),
            "confidence": by_level(lambda level: F.lit(RISK_TEXT[level][2])),
            "interpretation": by_level(
                lambda level: F.concat(F.lit(RISK_TEXT[level][0]), numbers, F.lit(RISK_TEXT[level][1]))
            ),
        }
    )


def range_drift(
    df: DataFrame,
    features: str = "features",
    ranges: Mapping[str, tuple[float, float]] = S.EXPECTED_RANGES,
    ratio_threshold: float = S.RANGE_DRIFT_RATIO,
) -> DataFrame:
    """Share of supplied features outside their fixed range, judged inside the row."""
    outside = F.lit(0)
    for name, (low, high) in ranges.items():
        value = F.try_element_at(F.col(features), F.lit(name))
        outside = outside + F.coalesce(((value < low) | (value > high)).cast("int"), F.lit(0))
    ratio = F.coalesce(F.try_divide(outside, F.size(features)), F.lit(0.0))
    return df.withColumns({"drift_ratio": ratio, "drift_detected": ratio > ratio_threshold})


def score_records(
    df: DataFrame, model_version: str, latency_ms: Column, features: str = "features"
) -> DataFrame:
    """Rows of the prediction log: JSON features, latency, drift flag and ratio, model version."""
    return range_drift(df, features).select(
        F.col("datetime").alias("timestamp"),
        "prediction",
        F.to_json(features).alias("features"),
        latency_ms.alias("latency_ms"),
        F.col("drift_detected").cast("int").alias("drift_detected"),
        "drift_ratio",
        F.lit(model_version).alias("model_version"),
    )


def append_records(records: DataFrame, path: str) -> None:
    """Append to the prediction log, partitioned by day."""
    dated = records.withColumn("day", F.to_date("timestamp"))
    dated.write.mode("append").partitionBy("day").parquet(path)
