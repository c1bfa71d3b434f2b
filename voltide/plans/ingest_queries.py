"""Registered queries for sources, versions and data quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide import schema as S
from voltide.operators import etl, quality
from voltide.plans import views as V
from voltide.plans.feature_queries import OHLC, ORACLE as FEATURE_ORACLE, Query, r, tidy
from voltide.session import stage, staging_path
from voltide.sources import bars as source
from voltide.sources import commits


def landed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw bars written as response files, with one error and one empty payload per symbol, read back."""
    raw = stage(V.bars_raw(spark, sf_dir), "raw")
    good = source.payloads_of(raw)
    symbols = raw.select("symbol").distinct()
    empty = F.lit(None).cast(S.PAYLOAD_SCHEMA["values"].dataType).alias("values")
    failed = symbols.select(
        "symbol", F.lit("error").alias("status"), F.lit("limit reached").alias("message"), empty
    )
    hollow = symbols.select(
        "symbol", F.lit("ok").alias("status"), F.lit(None).cast("string").alias("message"), empty
    )
    path = staging_path(spark, "payloads")
    good.unionByName(failed).unionByName(hollow).write.json(path)
    return source.read_payloads(spark, path)


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "csv")
    source.write_csv(V.bars_gappy(spark, sf_dir), path)
    return source.read_csv(spark, path)


def _versioned(spark: SparkSession, sf_dir: str) -> str:
    """Bars stored as three dated dataset versions."""
    part = F.least(F.floor((F.dayofmonth("datetime") - 1) / 10), F.lit(2))
    name = F.concat(F.lit("processed_data_2024010"), (part + 1).cast("string"), F.lit("_120000"))
    path = staging_path(spark, "versions")
    source.write_versions(V.bars(spark, sf_dir).withColumn("version", name), path)
    return path


def _read_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.read_versions(spark, _versioned(spark, sf_dir))


def _published(spark: SparkSession, sf_dir: str) -> str:
    """The same three versions, published by the commit log."""
    table, path = stage(_read_versions(spark, sf_dir), "versioned"), staging_path(spark, "published")
    for k in (1, 3, 2):
        name = f"processed_data_2024010{k}_120000"
        commits.publish(table.where(F.col("version") == name).drop("version"), path, name)
    return path


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _published(spark, sf_dir)
    name = commits.latest_name(spark, path)
    return tidy(commits.read_latest(spark, path).withColumn("version", F.lit(name)))


def _etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate, cleaning, features and publication; the published version is read back."""
    path = staging_path(spark, "etl")
    return tidy(etl.run(spark, V.gappy_table(spark, sf_dir), path, "processed_data_20240131_120000", max_null_pct=60.0))


def _incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = V.bar_table(spark, sf_dir)
    done = bars.where(
        (F.col("datetime") < F.lit("2024-01-20").cast("timestamp_ntz")) & (F.col("symbol") != "view")
    )
    path = staging_path(spark, "increment")
    commits.publish(done, path, "raw_1")
    return tidy(etl.run_new(spark, bars, path, "raw_2"))


def _gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(quality.quality_report(V.bars_gappy(spark, sf_dir)))


QUERIES: dict[str, Query] = {
    "ingest_json_bars": lambda s, d: tidy(
        source.coerce_types(source.payload_bars(landed_payloads(s, d)))
    ),
    "ingest_rejects": lambda s, d: source.rejected_payloads(landed_payloads(s, d)),
    "coerce_types": lambda s, d: tidy(source.coerce_types(V.bars_raw(s, d))),
    "source_date_range": lambda s, d: tidy(
        source.date_range(V.bar_table(s, d), "2024-01-05 00:00:00", "2024-01-12 12:00:00")
    ),
    "source_latest_n": lambda s, d: tidy(source.latest_n(V.bar_table(s, d))),
    "sort_bars": lambda s, d: tidy(source.sort_bars(V.bars(s, d))),
    "csv_bars_roundtrip": lambda s, d: tidy(_csv_roundtrip(s, d)),
    "parquet_features_roundtrip": lambda s, d: tidy(_read_versions(s, d)),
    "latest_version": _latest,
    "etl_run": _etl,
    "dataset_manifest": lambda s, d: commits.manifest(s, _published(s, d)).drop("content_hash"),
    "dataset_hash": lambda s, d: source.manifest(_read_versions(s, d)).select("version", "content_hash"),
    "incremental_ingest": _incremental,
    "dq_null_pct": lambda s, d: tidy(quality.null_pct_report(V.bars_gappy(s, d))),
    "dq_schema": lambda s, d: quality.schema_report(V.bars(s, d)),
    "dq_schema_cells": lambda s, d: quality.cell_report(V.bars_raw(s, d)),
    "dq_min_points": lambda s, d: tidy(quality.min_points_report(V.bars(s, d), min_points=175)),
    "dq_gate": _gate,
    "dq_quarantine": lambda s, d: tidy(quality.quarantine(V.bar_table(s, d), min_points=680)[0]),
}

VERSION_SQL = (
    "v AS (SELECT *, 'processed_data_2024010' || (least((day(datetime) - 1) // 10, 2) + 1)::VARCHAR "
    "|| '_120000' AS version FROM bars)"
)
COERCED = (
    "SELECT symbol, datetime::TIMESTAMP AS datetime, "
    + ", ".join(f"{r(f'TRY_CAST({c} AS DOUBLE)')} AS {c}" for c in S.PRICES)
    + " FROM bars_raw"
)


def _null_checks(source_name: str) -> str:
    return " UNION ALL ".join(
        f"SELECT symbol, 'null_pct' AS check_name, '{c}' AS column_name, "
        f"{r(f'count(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / count(*)')} AS observed, "
        f"1.0::DOUBLE AS limit_value, count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*) <= 1.0 AS passed "
        f"FROM {source_name} GROUP BY symbol"
        for c in S.BAR_COLUMNS
    )


def _point_check(source_name: str, least: int) -> str:
    return (
        "SELECT symbol, 'min_points' AS check_name, '*' AS column_name, count(*)::DOUBLE AS observed, "
        f"{least}.0::DOUBLE AS limit_value, count(*) >= {least} AS passed FROM {source_name} GROUP BY symbol"
    )


ORACLE: dict[str, str] = {
    "ingest_json_bars": V.with_views("bars_raw", COERCED),
    "ingest_rejects": (
        "SELECT DISTINCT event_type AS symbol, s.status, s.reason FROM events, "
        "(VALUES ('error', 'limit reached'), ('ok', 'no values in response')) s(status, reason)"
    ),
    "coerce_types": V.with_views("bars_raw", COERCED),
    "source_date_range": V.with_views(
        "bars",
        f"SELECT symbol, datetime, {OHLC} FROM bars WHERE datetime BETWEEN TIMESTAMP '2024-01-05 00:00:00' "
        "AND TIMESTAMP '2024-01-12 12:00:00'",
    ),
    "source_latest_n": V.with_views(
        "bars",
        f"SELECT symbol, datetime, {OHLC} FROM bars "
        "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) <= 168",
    ),
    "sort_bars": V.with_views("bars", f"SELECT symbol, datetime, {OHLC} FROM bars ORDER BY 1, 2"),
    "csv_bars_roundtrip": V.with_views("bars_gappy", f"SELECT symbol, datetime, {OHLC} FROM bars_gappy"),
    "parquet_features_roundtrip": V.with_views(
        "bars", VERSION_SQL, f"SELECT symbol, datetime, {OHLC}, version FROM v"
    ),
    "etl_run": FEATURE_ORACLE["transform_end_to_end"],
    "latest_version": V.with_views(
        "bars", VERSION_SQL,
        f"SELECT symbol, datetime, {OHLC}, version FROM v WHERE version = (SELECT max(version) FROM v)",
    ),
    "dataset_manifest": V.with_views(
        "bars", VERSION_SQL,
        "SELECT version, count(*) AS n_rows, 6 AS n_columns, min(datetime) AS min_time, max(datetime) AS max_time "
        "FROM v GROUP BY 1",
    ),
    "incremental_ingest": V.with_views(
        "bars",
        f"SELECT symbol, datetime, {OHLC} FROM bars b WHERE symbol = 'view' OR datetime > "
        "(SELECT max(datetime) FROM bars x WHERE x.symbol = b.symbol AND x.datetime < TIMESTAMP '2024-01-20')",
    ),
    "dq_null_pct": V.with_views("bars_gappy", _null_checks("bars_gappy")),
    "dq_schema": (
        "SELECT * FROM (VALUES ('datetime', true, 'timestamp_ntz', true), ('open', true, 'double', true), "
        "('high', true, 'double', true), ('low', true, 'double', true), ('close', true, 'double', true)) "
        "t(column_name, present, data_type, passed)"
    ),
    "dq_schema_cells": V.with_views(
        "bars_raw",
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, true AS present, 'string' AS data_type, count(*) FILTER (WHERE {c} IS NOT NULL AND "
            f"TRY_CAST({c} AS {'TIMESTAMP' if c == 'datetime' else 'DOUBLE'}) IS NULL) AS failed_cells, failed_cells = 0 AS passed "
            "FROM bars_raw"
            for c in S.BAR_COLUMNS
        ),
    ),
    "dq_min_points": V.with_views("bars", _point_check("bars", 175)),
    "dq_gate": V.with_views(
        "bars_gappy", f"{_null_checks('bars_gappy')} UNION ALL {_point_check('bars_gappy', 24)}"
    ),
    "dq_quarantine": V.with_views(
        "bars",
        f"SELECT symbol, datetime, {OHLC} FROM bars WHERE symbol IN "
        "(SELECT symbol FROM bars GROUP BY 1 HAVING count(*) >= 680)",
    ),
}
