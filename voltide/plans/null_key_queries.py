"""Registered queries over bars with missing symbols and missing times: no row may vanish."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide import schema as S
from voltide.operators import clean, quality, series
from voltide.plans import views as V
from voltide.plans.feature_queries import Query, outlier_ctes, rcols, tidy
from voltide.session import stage
from voltide.sources import bars as source

OHLC = rcols(S.PRICES)
LEAST = 600


def _table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(V.bars_null_keys(spark, sf_dir), "null-keys")


def _indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = series.row_index(_table(spark, sf_dir), index="row_index", size="series_rows")
    return tidy(rows.select("symbol", "datetime", "open", "row_index", "series_rows").fillna(-1))


def _quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed, failed = quality.quarantine(_table(spark, sf_dir), max_null_pct=100.0, min_points=LEAST)
    marked = passed.withColumn("passed", F.lit(True)).unionByName(failed.withColumn("passed", F.lit(False)))
    return tidy(marked)


def _incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir)
    done = rows.where(F.col("datetime") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return tidy(source.newer_than(rows, done))


QUERIES: dict[str, Query] = {
    "fill_forward_null_keys": lambda s, d: tidy(clean.handle_missing(_table(s, d), "forward")),
    "row_index_null_keys": _indexed,
    "outliers_null_keys": lambda s, d: tidy(clean.remove_outliers(_table(s, d))),
    "quarantine_null_keys": _quarantined,
    "incremental_null_keys": _incremental,
}

SPAN = "PARTITION BY symbol, datetime IS NULL ORDER BY datetime"
FILLED = ", ".join(
    f"CASE WHEN datetime IS NULL THEN {c} ELSE last_value({c} IGNORE NULLS) OVER ({SPAN} "
    f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS {c}"
    for c in S.PRICES
)

ORACLE: dict[str, str] = {
    "fill_forward_null_keys": V.with_views(
        "bars_null_keys",
        f"x AS (SELECT symbol, datetime, {FILLED} FROM bars_null_keys)",
        f"SELECT symbol, datetime, {OHLC} FROM x",
    ),
    "row_index_null_keys": V.with_views(
        "bars_null_keys",
        f"SELECT symbol, datetime, {rcols(['open'])}, "
        f"CASE WHEN datetime IS NULL THEN -1 ELSE row_number() OVER ({SPAN}) - 1 END AS row_index, "
        "CASE WHEN datetime IS NULL THEN -1 ELSE count(datetime) OVER (PARTITION BY symbol) END AS series_rows "
        "FROM bars_null_keys",
    ),
    "outliers_null_keys": V.with_views(
        "bars_null_keys", *outlier_ctes("bars_null_keys"), f"SELECT symbol, datetime, {OHLC} FROM o3"
    ),
    "quarantine_null_keys": V.with_views(
        "bars_null_keys",
        f"SELECT symbol, datetime, {OHLC}, count(*) OVER (PARTITION BY symbol) >= {LEAST} AS passed FROM bars_null_keys",
    ),
    "incremental_null_keys": V.with_views(
        "bars_null_keys",
        "m AS (SELECT symbol, max(datetime) AS mark FROM bars_null_keys WHERE datetime < TIMESTAMP '2024-01-20' GROUP BY 1)",
        f"SELECT b.symbol, datetime, {OHLC} FROM bars_null_keys b LEFT JOIN m "
        "ON b.symbol IS NOT DISTINCT FROM m.symbol WHERE mark IS NULL OR datetime > mark",
    ),
}
