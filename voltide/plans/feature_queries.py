"""Registered queries for cleaning, scalar features and window features, with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide import schema as S
from voltide.functions.numeric import rounded
from voltide.operators import clean, features
from voltide.plans import views as V
from voltide.session import stage

Query = Callable[[SparkSession, str], DataFrame]


# Means of short decimals often lie exactly between two rounded values, where engines differ. The nudge
# moves them off the tie, in the query and in the oracle alike.
def _nudge(digits: int) -> float:
    return 3.0 * 10.0 ** -(digits + 3)


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison; other columns as they are."""
    return df.select(
        *[
            rounded(F.col(f.name) + F.lit(_nudge(digits)), digits).alias(f.name)
            if f.dataType.simpleString() == "double"
            else F.col(f.name)
            for f in df.schema
        ]
    )


def r(expression: str, digits: int = 6) -> str:
    """Oracle text of the rounding in ``tidy``."""
    return f"round(({expression}) + {_nudge(digits)!r}::DOUBLE, {digits}) + 0.0::DOUBLE"


def rcols(columns: list[str], digits: int = 6) -> str:
    return ", ".join(f"{r(c, digits)} AS {c}" for c in columns)


KEY = ["symbol", "datetime"]
OHLC = rcols(S.PRICES)


def _price(name: str) -> Query:
    return lambda s, d: tidy(features.price_features(V.bars(s, d), [name]).select(*KEY, name))


def _rolling(stats: list[str]) -> Query:
    return lambda s, d: tidy(
        features.rolling_features(V.gappy_table(s, d), stats=stats).drop(*S.PRICES)
    )


def _columns(fn: Callable[[DataFrame], DataFrame], view: Callable, *columns: str) -> Query:
    return lambda s, d: tidy(fn(view(s, d)).select(*KEY, *columns), 8)


QUERIES: dict[str, Query] = {
    # cleaning
    "fill_forward": lambda s, d: tidy(clean.handle_missing(V.gappy_table(s, d), "forward")),
    "fill_backward": lambda s, d: tidy(clean.handle_missing(V.gappy_table(s, d), "backward")),
    "drop_null_rows": lambda s, d: tidy(clean.handle_missing(V.bars_gappy(s, d), "drop")),
    "null_counts": lambda s, d: clean.null_counts(V.bars_gappy(s, d)),
    "outliers_zscore": lambda s, d: tidy(clean.remove_outliers(V.gappy_table(s, d))),
    "outliers_count": lambda s, d: clean.outlier_counts(V.bar_table(s, d)),
    "drop_null_target": lambda s, d: tidy(
        clean.drop_null_target(features.next_volatility(V.bar_table(s, d))).select(*KEY, S.TARGET), 8
    ),
    # per-row features
    "feat_calendar": lambda s, d: features.calendar(V.bars(s, d)).select(*KEY, *S.TIME_FEATURES[:4]),
    "feat_cyclic_hour": lambda s, d: tidy(
        features.cyclic_hour(features.calendar(V.bars(s, d))).select(*KEY, "hour_sin", "hour_cos")
    ),
    "feat_cyclic_dow": lambda s, d: tidy(
        features.cyclic_weekday(features.calendar(V.bars(s, d))).select(*KEY, "day_sin", "day_cos")
    ),
    "feat_price_range": _price("price_range"),
    "feat_price_change": _price("price_change"),
    "feat_price_change_pct": _price("price_change_pct"),
    "feat_avg_price": _price("avg_price"),
    # window features
    "log_return": _columns(features.log_returns, V.bar_table, "log_return"),
    "lag_features": lambda s, d: tidy(features.lag_features(V.bar_table(s, d)).drop(*S.PRICES)),
    "rolling_mean": _rolling(["mean"]),
    "rolling_std": _rolling(["std"]),
    "rolling_min": _rolling(["min"]),
    "rolling_max": _rolling(["max"]),
    "rolling_volatility": _columns(features.rolling_volatility, V.bar_table, "log_return", "volatility"),
    "target_next_volatility": _columns(features.next_volatility, V.bar_table, "volatility", S.TARGET),
    "feature_pipeline": lambda s, d: tidy(features.feature_frame(V.bar_table(s, d))),
    "transform_end_to_end": lambda s, d: tidy(clean.transform(V.gappy_table(s, d))),
    "halo_window": lambda s, d: tidy(
        features.rolling_volatility(stage(V.single_series(s, d), "series")).select(*KEY, "log_return", "volatility"), 8
    ),
}

# ---- oracle -------------------------------------------------------------------------------------

W = "PARTITION BY symbol ORDER BY datetime"


def frame(rows: int) -> str:
    return f"({W} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"


STAT_SQL = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


def rolling_sql(stat: str, n: int, column: str = "close") -> str:
    f = frame(n)
    return f"CASE WHEN count({column}) OVER {f} = {n} THEN {STAT_SQL[stat]}({column}) OVER {f} END"


CALENDAR_SQL = (
    "hour(datetime) AS hour, isodow(datetime) - 1 AS day_of_week, day(datetime) AS day_of_month, "
    "month(datetime) AS month"
)
TRIG_SQL = {
    "hour_sin": "sin(2 * pi() * hour(datetime) / 24)",
    "hour_cos": "cos(2 * pi() * hour(datetime) / 24)",
    "day_sin": "sin(2 * pi() * (isodow(datetime) - 1) / 7)",
    "day_cos": "cos(2 * pi() * (isodow(datetime) - 1) / 7)",
}
PRICE_SQL = {
    "price_range": "high - low",
    "price_change": "close - open",
    "price_change_pct": "(close - open) / nullif(open, 0)",
    "avg_price": "(high + low) / 2",
}


def _ratio() -> str:
    return f"close / nullif(lag(close) OVER ({W}), 0)"


LOG_RETURN_SQL = f"CASE WHEN {_ratio()} > 0 THEN ln({_ratio()}) END"


def fill_sql(source: str, forward: bool) -> str:
    fn, side = ("last_value", "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW") if forward else (
        "first_value", "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING")
    cols = ", ".join(f"{fn}({c} IGNORE NULLS) OVER ({W} {side}) AS {c}" for c in S.PRICES)
    return f"SELECT symbol, datetime, {cols} FROM {source}"


def outlier_ctes(source: str, prefix: str = "o") -> list[str]:
    ctes = []
    for i, c in enumerate(S.OUTLIER_ORDER):
        z = f"abs({c} - avg({c}) OVER p) / nullif(stddev_pop({c}) OVER p, 0)"
        ctes.append(
            f"{prefix}{i} AS (SELECT symbol, datetime, open, high, low, close FROM "
            f"(SELECT *, {z} AS z FROM {source} WINDOW p AS (PARTITION BY symbol)) q "
            f"WHERE z < 3.0 OR {c} IS NULL)"
        )
        source = f"{prefix}{i}"
    return ctes


def feature_ctes(source: str, prefix: str = "f") -> list[str]:
    """Feature frame over ``source``; the last part is named ``<prefix>``."""
    base = [f"{e} AS {c}" for c, e in TRIG_SQL.items()] + [f"{e} AS {c}" for c, e in PRICE_SQL.items()]
    lags = [f"lag(close, {k}) OVER ({W}) AS close_lag_{k}" for k in S.LAGS]
    rolls = [
        f"{rolling_sql(stat, n)} AS close_rolling_{stat}_{n}" for n in S.ROLLING_WINDOWS for stat in STAT_SQL
    ]
    select = ", ".join([CALENDAR_SQL, *base, *lags, *rolls, f"{LOG_RETURN_SQL} AS log_return"])
    return [
        f"{prefix}0 AS (SELECT symbol, datetime, open, high, low, close, {select} FROM {source})",
        f"{prefix}1 AS (SELECT *, {rolling_sql('std', 24, 'log_return')} AS volatility FROM {prefix}0)",
        f"{prefix} AS (SELECT *, lead(volatility) OVER ({W}) AS target_volatility FROM {prefix}1)",
    ]


DOUBLES = [*S.PRICES, *S.TIME_FEATURES[4:], *S.PRICE_FEATURES, *S.LAG_FEATURES, *S.ROLLING_FEATURES,
           "log_return", "volatility", S.TARGET]
ALL_COLUMNS = f"symbol, datetime, hour, day_of_week, day_of_month, month, {rcols(DOUBLES)}"

NOT_NULL = " AND ".join(f"{c} IS NOT NULL" for c in DOUBLES)


def _price_sql(name: str) -> str:
    return V.with_views("bars", f"SELECT symbol, datetime, {r(PRICE_SQL[name])} AS {name} FROM bars")


def _rolling_oracle(stat: str) -> str:
    cols = ", ".join(f"{r(rolling_sql(stat, n))} AS close_rolling_{stat}_{n}" for n in S.ROLLING_WINDOWS)
    return V.with_views("bars_gappy", f"SELECT symbol, datetime, {cols} FROM bars_gappy")


def _feature_oracle(select: str, where: str = "") -> str:
    return V.with_views("bars", *feature_ctes("bars"), f"SELECT {select} FROM f {where}")


SERIES_SQL = (
    "one AS (SELECT 'ALL' AS symbol, datetime + INTERVAL (30 * (list_position(['click', 'error', "
    "'purchase', 'signup', 'view'], symbol) - 1)) DAY AS datetime, open, high, low, close FROM bars)"
)

ORACLE: dict[str, str] = {
    "fill_forward": V.with_views(
        "bars_gappy", f"x AS ({fill_sql('bars_gappy', True)})", f"SELECT symbol, datetime, {OHLC} FROM x"
    ),
    "fill_backward": V.with_views(
        "bars_gappy", f"x AS ({fill_sql('bars_gappy', False)})", f"SELECT symbol, datetime, {OHLC} FROM x"
    ),
    "drop_null_rows": V.with_views(
        "bars_gappy",
        f"SELECT symbol, datetime, {OHLC} FROM bars_gappy WHERE open IS NOT NULL AND high IS NOT NULL "
        "AND low IS NOT NULL AND close IS NOT NULL",
    ),
    "null_counts": V.with_views(
        "bars_gappy",
        "n AS (SELECT " + ", ".join(
            f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in ["symbol", *S.BAR_COLUMNS]
        ) + " FROM bars_gappy)",
        "SELECT *, symbol + datetime + open + high + low + close AS total_nulls FROM n",
    ),
    "outliers_zscore": V.with_views(
        "bars_gappy", *outlier_ctes("bars_gappy"), f"SELECT symbol, datetime, {OHLC} FROM o3"
    ),
    "outliers_count": V.with_views(
        "bars",
        *outlier_ctes("bars"),
        "a AS (SELECT symbol, count(*) AS rows_before FROM bars GROUP BY 1)",
        "b AS (SELECT symbol, count(*) AS n FROM o3 GROUP BY 1)",
        "SELECT symbol, rows_before, coalesce(n, 0) AS rows_after, rows_before - coalesce(n, 0) AS rows_removed "
        "FROM a LEFT JOIN b USING (symbol)",
    ),
    "drop_null_target": _feature_oracle(
        f"symbol, datetime, {r('target_volatility', 8)} AS target_volatility",
        "WHERE target_volatility IS NOT NULL",
    ),
    "feat_calendar": V.with_views("bars", f"SELECT symbol, datetime, {CALENDAR_SQL} FROM bars"),
    "feat_cyclic_hour": V.with_views(
        "bars",
        "SELECT symbol, datetime, "
        + ", ".join(f"{r(TRIG_SQL[c])} AS {c}" for c in ("hour_sin", "hour_cos")) + " FROM bars",
    ),
    "feat_cyclic_dow": V.with_views(
        "bars",
        "SELECT symbol, datetime, "
        + ", ".join(f"{r(TRIG_SQL[c])} AS {c}" for c in ("day_sin", "day_cos")) + " FROM bars",
    ),
    **{f"feat_{name}": _price_sql(name) for name in PRICE_SQL},
    "log_return": V.with_views(
        "bars", f"x AS (SELECT symbol, datetime, {LOG_RETURN_SQL} AS log_return FROM bars)",
        f"SELECT symbol, datetime, {r('log_return', 8)} AS log_return FROM x",
    ),
    "lag_features": V.with_views(
        "bars",
        "SELECT symbol, datetime, "
        + ", ".join(f"{r(f'lag(close, {k}) OVER ({W})')} AS close_lag_{k}" for k in S.LAGS) + " FROM bars",
    ),
    **{f"rolling_{stat}": _rolling_oracle(stat) for stat in STAT_SQL},
    "rolling_volatility": _feature_oracle(f"symbol, datetime, {rcols(['log_return', 'volatility'], 8)}"),
    "target_next_volatility": _feature_oracle(f"symbol, datetime, {rcols(['volatility', S.TARGET], 8)}"),
    "feature_pipeline": _feature_oracle(ALL_COLUMNS),
    "transform_end_to_end": V.with_views(
        "bars_gappy",
        f"filled AS ({fill_sql('bars_gappy', True)})",
        *outlier_ctes("filled"),
        *feature_ctes("o3"),
        f"SELECT {ALL_COLUMNS} FROM f WHERE {NOT_NULL}",
    ),
    "halo_window": V.with_views(
        "bars", SERIES_SQL, *feature_ctes("one"),
        f"SELECT symbol, datetime, {rcols(['log_return', 'volatility'], 8)} FROM f",
    ),
}
