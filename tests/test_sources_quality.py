from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.helpers import assert_same, bars, collected, walk
from voltide import schema as S
from voltide.operators import clean, distribution, quality, series, split
from voltide.session import stage
from voltide.sources import bars as source

T0 = dt.datetime(2025, 1, 1)

PAYLOADS = [
    {"symbol": "EUR/USD", "values": [
        {"datetime": "2025-11-01 01:00:00", "open": "1.1", "high": "1.2", "low": "1.0", "close": "1.15"},
        {"datetime": "2025-11-01 00:00:00", "open": "1.0", "high": "1.1", "low": "0.9", "close": "abc"},
    ]},
    {"symbol": "EUR/USD", "status": "error", "message": "API limit"},
    {"symbol": "EUR/USD", "status": "ok"},
]


@pytest.fixture
def landed(tmp_path):
    path = tmp_path / "landed"
    path.mkdir()
    (path / "a.json").write_text("\n".join(json.dumps(p) for p in PAYLOADS))
    return str(path)


def test_ingest(spark, landed):
    got = collected(source.ingest_json(spark, landed))
    assert got["open"].tolist() == [1.0, 1.1]
    assert got["close"].isna().tolist() == [True, False]
    rejected = source.rejected_payloads(source.read_payloads(spark, landed)).collect()
    assert sorted(r["reason"] for r in rejected) == ["API limit", "no values in response"]


def test_number_and_datetime_coercion(spark):
    rows = spark.createDataFrame(
        [("a", "2025-11-01 00:00:00", v) for v in ("1.5", " 2 ", "1e-3", "nan", "inf", "1.5d", "", None, "-0.25")],
        "symbol string, datetime string, close string",
    )
    got = [r["close"] for r in source.coerce_types(rows).collect()]
    assert got == [1.5, 2.0, 0.001, None, None, None, None, None, -0.25]
    broken = spark.createDataFrame([("a", "not a time", "1")], "symbol string, datetime string, close string")
    with pytest.raises(PySparkException, match="unparsable datetime"):
        source.coerce_types(broken).collect()


def test_range_latest_and_increment(spark):
    frame = walk(50)
    table = bars(spark, frame)
    part = source.date_range(table, "2025-11-01 05:00:00", "2025-11-01 09:00:00")
    assert part.count() == 5
    assert_same(collected(source.latest_n(table, 7)), frame.tail(7).reset_index(drop=True))
    for chunk in (3600, 5 * 3600, 86_400):
        small = source.latest_n(table, 7, chunk_seconds=chunk)
        assert_same(collected(small), frame.tail(7).reset_index(drop=True))
    assert source.latest_n(table).count() == 50
    done = table.where(F.dayofmonth("datetime") < 2)
    last = done.agg(F.max("datetime")).first()[0]
    fresh = source.newer_than(table, done)
    assert fresh.agg(F.min("datetime")).first()[0] > last
    assert source.newer_than(table, table.limit(0)).count() == 50


def test_csv_and_versions(spark, tmp_path):
    frame = walk(30)
    frame.loc[3, "close"] = None
    table = bars(spark, frame)
    source.write_csv(table, str(tmp_path / "csv"))
    assert_same(collected(source.read_csv(spark, str(tmp_path / "csv"))), frame)
    path = str(tmp_path / "versions")
    for name in ("processed_data_20250101_000000", "processed_data_20250102_000000", "other_9"):
        source.write_versions(table.withColumn("version", F.lit(name)), path)
    assert source.read_latest(spark, path).select("version").distinct().first()[0] == "processed_data_20250102_000000"
    rows = {r["version"]: r for r in source.manifest(source.read_versions(spark, path)).collect()}
    assert {r["n_rows"] for r in rows.values()} == {30} and {r["n_columns"] for r in rows.values()} == {6}
    assert len({r["content_hash"] for r in rows.values()}) == 1
    with pytest.raises(ValueError, match="no version"):
        source.read_latest(spark, path, prefix="missing")


def test_version_scan_is_pruned(spark, tmp_path):
    path = str(tmp_path / "v")
    source.write_versions(bars(spark, walk(5)).withColumn("version", F.lit("processed_data_1")), path)
    plan = source.read_latest(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in plan


def test_payloads_hold_at_most_a_week(spark):
    text = bars(spark, walk(1000)).select("symbol", *[F.col(c).cast("string").alias(c) for c in S.BAR_COLUMNS])
    sizes = source.payloads_of(text).select(F.size("values").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] == S.FETCH_SIZE


def test_null_share(spark):
    frame = walk(100)
    assert quality.validate(bars(spark, frame)) is not None
    frame.loc[95:, "close"] = None
    failed = quality.quality_report(bars(spark, frame), keys=()).where(~F.col("passed")).collect()
    assert [(r["column_name"], r["observed"]) for r in failed] == [("close", 5.0)]
    with pytest.raises(quality.DataQualityError, match="close"):
        quality.validate(bars(spark, frame))


def test_limit_is_strict_and_zero_is_a_limit(spark):
    frame = walk(100)
    frame.loc[0, "close"] = None
    assert quality.validate(bars(spark, frame)) is not None  # exactly 1 %
    with pytest.raises(quality.DataQualityError):
        quality.validate(bars(spark, frame), max_null_pct=0.0)


def test_schema_check(spark):
    narrow = bars(spark, walk(30)).select("datetime", "open")
    assert not quality.schema_ok(narrow)
    with pytest.raises(quality.DataQualityError, match="schema"):
        quality.validate(narrow)
    text = bars(spark, walk(30)).withColumn("close", F.col("close").cast("string"))
    verdicts = {r["column_name"]: r["passed"] for r in quality.schema_report(text).collect()}
    assert verdicts == {"datetime": True, "open": True, "high": True, "low": True, "close": False}


@pytest.mark.parametrize(("rows", "passes"), [(30, True), (24, True), (10, False)])
def test_minimum_points(spark, rows, passes):
    report = quality.min_points_report(bars(spark, walk(rows))).first()
    assert report["passed"] is passes


def test_empty_input_passes_the_null_check(spark):
    report = quality.quality_report(bars(spark, walk(1)).limit(0), keys=()).collect()
    assert {r["passed"] for r in report if r["check_name"] == "null_pct"} == {True}


def test_quarantine(spark):
    import pandas as pd

    table = bars(spark, pd.concat([walk(30, symbol="A"), walk(10, symbol="B")]))
    good, bad = quality.quarantine(table)
    assert good.select("symbol").distinct().collect()[0][0] == "A" and good.count() == 30
    assert bad.count() == 10


def null_keys(spark):
    rows = [("a", T0 + dt.timedelta(hours=i), float(i)) for i in range(30)]
    rows += [(None, T0 + dt.timedelta(hours=i), float(i) if i % 2 else None) for i in range(30)]
    rows += [("a", None, 5.0), (None, None, None)]
    return spark.createDataFrame([(s, t, v, v, v, v) for s, t, v in rows], S.BAR_SCHEMA)


def test_no_row_vanishes_for_a_missing_key(spark):
    table = null_keys(spark)
    filled = clean.handle_missing(table, "forward")
    assert filled.count() == 62 and filled.where("close is null").count() == 2
    assert clean.handle_missing(table, "backward").count() == 62
    indexed = series.row_index(table, index="i", size="n")
    assert indexed.count() == 62 and indexed.where("i is null").count() == 2
    assert indexed.groupBy("symbol").agg(F.max("n").alias("n")).where("n = 30").count() == 2
    assert series.running_sum(table, "open", "total").count() == 62
    assert clean.remove_outliers(table).count() == 62
    passed, failed = quality.quarantine(table, min_points=1000)
    assert passed.count() == 0 and failed.count() == 62
    assert source.newer_than(table, table).count() == 0
    halo = series.drop_halo(series.with_halo(table, lookback=2, chunk_seconds=7200))
    assert halo.count() == 62
    ranked = distribution.ranked_values(table, ["symbol"], "close")
    assert ranked.where("symbol is null").count() == 15
    assert split.time_split(table).where("split is null").count() == 2


def test_the_outlier_plan_grows_by_one_scan_per_column(spark):
    table = stage(null_keys(spark), "outliers")
    plan = clean.remove_outliers(table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= 5


def test_all_failed_checks_are_counted(spark):
    table = spark.createDataFrame([(f"s{i}", T0, 1.0, 1.0, 1.0, 1.0) for i in range(40)], S.BAR_SCHEMA)
    with pytest.raises(quality.DataQualityError, match="40 checks failed"):
        quality.validate(table, keys=["symbol"])


def test_cells_that_do_not_convert_are_counted(spark):
    rows = [("2024-01-01 00:00:00", "1.0", "x", None), ("no time", "2", "n/a", "3")]
    df = spark.createDataFrame(rows, "datetime string, open string, high string, low string")
    got = {r.column_name: (r.present, r.failed_cells, r.passed) for r in quality.cell_report(df).collect()}
    assert got["datetime"] == (True, 1, False) and got["high"] == (True, 2, False)
    assert got["low"] == got["open"] == (True, 0, True) and got["close"] == (False, 0, False)
