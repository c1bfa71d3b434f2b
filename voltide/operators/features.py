"""Calendar, price, lag, rolling and volatility features."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from voltide import schema as S
from voltide.operators.series import DEFAULT_CHUNK, chunk_window, drop_halo, with_halo


# ---- per-row features -------------------------------------------------------------------------


def calendar(df: DataFrame, at: str = "datetime") -> DataFrame:
    """Hour, weekday (Monday is 0), day of month and month."""
    return df.withColumns(
        {
            "hour": F.hour(at),
            "day_of_week": F.weekday(at),
            "day_of_month": F.dayofmonth(at),
            "month": F.month(at),
        }
    )


def _cycle(value: Column, period: int) -> Column:
    return value * F.lit(2 * math.pi) / F.lit(period)


def cyclic_hour(df: DataFrame) -> DataFrame:
    angle = _cycle(F.col("hour"), 24)
    return df.withColumns({"hour_sin": F.sin(angle), "hour_cos": F.cos(angle)})


def cyclic_weekday(df: DataFrame) -> DataFrame:
    angle = _cycle(F.col("day_of_week"), 7)
    return df.withColumns({"day_sin": F.sin(angle), "day_cos": F.cos(angle)})


def time_features(df: DataFrame) -> DataFrame:
    return cyclic_weekday(cyclic_hour(calendar(df)))


PRICE_EXPRESSIONS = {
    "price_range": lambda: F.col("high") - F.col("low"),
    "price_change": lambda: F.col("close") - F.col("open"),
    # NULL where open is 0
    "price_change_pct": lambda: F.try_divide(F.col("close") - F.col("open"), F.col("open")),
    "avg_price": lambda: (F.col("high") + F.col("low")) / 2,
}


def price_features(df: DataFrame, names: Sequence[str] = tuple(PRICE_EXPRESSIONS)) -> DataFrame:
    return df.withColumns({name: PRICE_EXPRESSIONS[name]() for name in names})


# ---- window expressions, for use over ``chunk_window`` on rows with a halo -----------------------


def log_return_of(column: str, w: WindowSpec) -> Column:
    """ln(x_t / x_{t-1}); NULL on the first row and where the ratio is not positive."""
    ratio = F.try_divide(F.col(column), F.lag(column, 1).over(w))
    return F.when(ratio > 0, F.ln(ratio))


def lags_of(column: str, lags: Sequence[int], w: WindowSpec) -> dict[str, Column]:
    return {f"{column}_lag_{k}": F.lag(column, k).over(w) for k in lags}


ROLLING_STATS = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def rolling_of(column: str, stat: str, rows: int, w: WindowSpec) -> Column:
    """Statistic of the last ``rows`` rows; NULL until all of them are there and non-null."""
    frame = w.rowsBetween(1 - rows, 0)
    full = F.count(column).over(frame) == rows
    return F.when(full, ROLLING_STATS[stat](F.col(column)).over(frame))


# ---- frame-level operators ---------------------------------------------------------------------


def log_returns(
    df: DataFrame, column: str = "close", into: str = "log_return", chunk_seconds: int = DEFAULT_CHUNK
) -> DataFrame:
    rows = with_halo(df, lookback=1, carry=[column], chunk_seconds=chunk_seconds)
    return drop_halo(rows.withColumn(into, log_return_of(column, chunk_window())))


def lag_features(
    df: DataFrame,
    column: str = "close",
    lags: Sequence[int] = tuple(S.LAGS),
    chunk_seconds: int = DEFAULT_CHUNK,
) -> DataFrame:
    rows = with_halo(df, lookback=max(lags), carry=[column], chunk_seconds=chunk_seconds)
    return drop_halo(rows.withColumns(lags_of(column, lags, chunk_window())))


def rolling_features(
    df: DataFrame,
    column: str = "close",
    windows: Sequence[int] = tuple(S.ROLLING_WINDOWS),
    stats: Sequence[str] = tuple(ROLLING_STATS),
    chunk_seconds: int = DEFAULT_CHUNK,
) -> DataFrame:
    rows = with_halo(df, lookback=max(windows) - 1, carry=[column], chunk_seconds=chunk_seconds)
    w = chunk_window()
    return drop_halo(
        rows.withColumns(
            {
                f"{column}_rolling_{stat}_{n}": rolling_of(column, stat, n, w)
                for n in windows
                for stat in stats
            }
        )
    )


def _volatility_columns(df: DataFrame, window: int) -> DataFrame:
    w = chunk_window()
    return df.withColumn("log_return", log_return_of("close", w)).withColumn(
        "volatility", rolling_of("log_return", "std", window, w)
    )


def rolling_volatility(
    df: DataFrame, window: int = S.VOLATILITY_WINDOW, chunk_seconds: int = DEFAULT_CHUNK
) -> DataFrame:
    """Sample standard deviation of the last ``window`` log returns."""
    rows = with_halo(df, lookback=window, carry=["close"], chunk_seconds=chunk_seconds)
    return drop_halo(_volatility_columns(rows, window))


def next_volatility(
    df: DataFrame, window: int = S.VOLATILITY_WINDOW, chunk_seconds: int = DEFAULT_CHUNK
) -> DataFrame:
    """Volatility and the volatility of the following row as the target."""
    rows = with_halo(df, lookback=window, lookahead=1, carry=["close"], chunk_seconds=chunk_seconds)
    target = F.lead("volatility", 1).over(chunk_window())
    return drop_halo(_volatility_columns(rows, window).withColumn(S.TARGET, target))


def feature_frame(
    df: DataFrame, window: int = S.VOLATILITY_WINDOW, chunk_seconds: int = DEFAULT_CHUNK
) -> DataFrame:
    """All derived columns: one exchange and one sort serve every window."""
    lookback = max(window, *S.LAGS, *[n - 1 for n in S.ROLLING_WINDOWS])
    rows = with_halo(df, lookback=lookback, lookahead=1, carry=["close"], chunk_seconds=chunk_seconds)
    w = chunk_window()
    windowed = lags_of("close", S.LAGS, w)
    for n in S.ROLLING_WINDOWS:
        for stat in ROLLING_STATS:
            windowed[f"close_rolling_{stat}_{n}"] = rolling_of("close", stat, n, w)
    windowed["log_return"] = log_return_of("close", w)
    wide = rows.withColumns(windowed)
    wide = wide.withColumn("volatility", rolling_of("log_return", "std", window, w))
    wide = wide.withColumn(S.TARGET, F.lead("volatility", 1).over(w))
    wide = price_features(time_features(drop_halo(wide)))
    return wide.select(*df.columns, *S.FEATURES_WITH_VOLATILITY, S.TARGET)
