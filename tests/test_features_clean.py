from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.helpers import assert_same, bars, collected, walk
from voltide import schema as S
from voltide.operators import clean, features


def pandas_features(frame: pd.DataFrame) -> pd.DataFrame:
    """Independent whole-column computation on one ordered series."""
    out = frame.copy()
    at, close = out["datetime"].dt, out["close"]
    out["hour"], out["day_of_week"], out["day_of_month"], out["month"] = at.hour, at.dayofweek, at.day, at.month
    for name, unit, period in (("hour", "hour", 24), ("day", "day_of_week", 7)):
        out[f"{name}_sin"] = np.sin(2 * np.pi * out[unit] / period)
        out[f"{name}_cos"] = np.cos(2 * np.pi * out[unit] / period)
    out["price_range"] = out["high"] - out["low"]
    out["price_change"] = close - out["open"]
    out["price_change_pct"] = out["price_change"] / out["open"]
    out["avg_price"] = (out["high"] + out["low"]) / 2
    for k in S.LAGS:
        out[f"close_lag_{k}"] = close.shift(k)
    for n in S.ROLLING_WINDOWS:
        for stat in ("mean", "std", "min", "max"):
            out[f"close_rolling_{stat}_{n}"] = getattr(close.rolling(n), stat)()
    out["log_return"] = np.log(close / close.shift(1))
    out["volatility"] = out["log_return"].rolling(24).std()
    out["target_volatility"] = out["volatility"].shift(-1)
    return out


def test_feature_frame_matches_pandas(spark):
    frame = walk(200)
    got = collected(features.feature_frame(bars(spark, frame), chunk_seconds=86_400))
    assert len(got.columns) == 41  # 40 and the symbol
    assert_same(got, pandas_features(frame), 9)


@pytest.mark.parametrize(("rows", "volatilities", "left"), [(24, 0, 0), (25, 1, 0), (26, 2, 1), (200, 176, 175)])
def test_warm_up_rows(spark, rows, volatilities, left):
    source = bars(spark, walk(rows))
    frame = features.feature_frame(source)
    assert frame.where(F.col("volatility").isNotNull()).count() == volatilities
    whole = clean.drop_null_target(frame).na.drop("any")
    assert whole.count() == left


def test_single_row(spark):
    row = features.feature_frame(bars(spark, walk(1))).first()
    assert row["hour"] == 0 and row["close_lag_1"] is None and row["log_return"] is None


def test_division_and_logarithm_edges(spark):
    frame = walk(4)
    frame["close"] = [1.0, 0.0, 2.0, -1.0]
    frame["open"] = [0.0, 1.0, 1.0, 1.0]
    got = collected(features.log_returns(features.price_features(bars(spark, frame))))
    assert got["price_change_pct"].isna().tolist() == [True, False, False, False]
    assert got["log_return"].isna().all()


def test_custom_window_lags_and_column(spark):
    source = bars(spark, walk(30))
    got = collected(features.lag_features(source, "open", [1, 5]))
    assert got["open_lag_5"].isna().sum() == 5
    assert collected(features.rolling_volatility(source, window=4))["volatility"].notna().sum() == 26


def test_forward_fill_golden(spark):
    frame = walk(5)
    frame["close"] = [1.085, None, None, 1.087, 1.088]
    source = bars(spark, frame)
    assert collected(clean.handle_missing(source))["close"].tolist() == [1.085, 1.085, 1.085, 1.087, 1.088]
    assert collected(clean.handle_missing(source, "backward"))["close"].tolist() == [1.085, 1.087, 1.087, 1.087, 1.088]
    assert clean.handle_missing(source, "drop").count() == 3
    assert clean.handle_missing(source, "other").count() == 5


def test_leading_null_stays(spark):
    frame = walk(3)
    frame.loc[0, "close"] = None
    assert collected(clean.handle_missing(bars(spark, frame)))["close"].isna().tolist() == [True, False, False]


def test_outliers_of_the_spike_series(spark):
    frame = walk(200)
    frame.loc[50, "close"], frame.loc[100, "close"] = 100.0, -50.0
    kept = collected(clean.remove_outliers(bars(spark, frame)))
    assert kept["close"].max() < 100 and kept["close"].min() > -50


def test_outliers_rate(spark):
    frame = walk(100)
    for c in S.PRICES:
        frame[c] = [1.085] * 95 + [10.0] * 5
    kept = collected(clean.remove_outliers(bars(spark, frame), ["close"]))
    assert len(kept) == 95 and kept["close"].max() == 1.085


def sequential_zscore(frame: pd.DataFrame) -> pd.DataFrame:
    for c in S.OUTLIER_ORDER:
        z = (frame[c] - frame[c].mean()).abs() / frame[c].std(ddof=0)
        frame = frame[(z < 3.0) | frame[c].isna()]
    return frame


def test_outliers_are_removed_column_after_column(spark):
    frame = walk(150, 7)
    frame["open"] = frame["open"] * np.where(frame.index % 40 == 3, 1.05, 1)
    frame.loc[20, "close"] = None
    frame.loc[60, "high"] = 5.0
    expected = sequential_zscore(frame).reset_index(drop=True)
    assert_same(collected(clean.remove_outliers(bars(spark, frame))), expected)


def test_constant_column_loses_its_rows(spark):
    frame = walk(20)
    frame["close"] = 1.0
    source = bars(spark, frame)
    assert clean.remove_outliers(source, ["close"]).count() == 0
    assert collected(clean.outlier_counts(source), "symbol")["rows_removed"].tolist() == [20]


def test_missing_columns_are_skipped(spark):
    source = bars(spark, walk(20)).drop("high")
    assert clean.remove_outliers(source).columns == ["symbol", "datetime", "open", "low", "close"]


def test_null_target(spark):
    rows = spark.createDataFrame([(1, 0.001), (2, 0.002), (3, None), (4, 0.003), (5, None)], "feature int, target_volatility double")
    assert clean.drop_null_target(rows).count() == 3


def test_numbers_are_normalised(spark):
    rows = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.0,)], "x double")
    assert [r[0] for r in clean.normalise_numbers(rows).collect()] == [None, None, 1.0]


@pytest.mark.parametrize("staged", [True, False])
def test_transform(spark, staged):
    frame = walk(200)
    frame.loc[10, "close"] = None
    got = collected(clean.transform(bars(spark, frame), staged=staged, chunk_seconds=86_400))
    cleaned = sequential_zscore(frame.ffill()).reset_index(drop=True)
    expected = pandas_features(cleaned).dropna().reset_index(drop=True)
    assert_same(got, expected, 9)
    assert len(got) == len(cleaned) - 25
