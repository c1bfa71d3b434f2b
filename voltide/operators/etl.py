"""Gate, transformation and publication of bars as one run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltide.operators import clean, quality
from voltide.session import stage
from voltide.sources import bars, commits


def run(spark: SparkSession, table: DataFrame, path: str, version: str, keys: tuple[str, ...] = (), **limits) -> DataFrame:
    """Check typed bars, transform them, publish the result as ``version`` and return it as published.

    ``keys`` and ``limits`` are those of the quality checks. A failed check raises, and nothing is published.
    """
    accepted = quality.validate(stage(table, "extracted"), keys, **limits)
    commits.publish(clean.transform(accepted), path, version)
    return commits.read(spark, path, version)


def run_new(spark: SparkSession, table: DataFrame, path: str, version: str) -> DataFrame:
    """Publish the bars that are newer than the high-water mark of their symbol, as they are, and return them."""
    fresh = bars.newer_than(table, commits.high_water_marks(spark, path))
    commits.publish(fresh, path, version)
    return commits.read(spark, path, version)
