from __future__ import annotations

import numpy as np
import pandas as pd

from voltide import schema as S


def walk(n: int, seed: int = 42, symbol: str = "EUR/USD", start: str = "2025-11-01", gaps: float = 0.0) -> pd.DataFrame:
    """Seeded random-walk hourly bars; ``gaps`` drops that share of the hours, some of them in long runs."""
    rng = np.random.default_rng(seed)
    close = 1.085 + np.cumsum(rng.normal(0, 0.0005, n))
    at = pd.date_range(start, periods=n, freq="h")
    frame = pd.DataFrame(
        {
            "symbol": symbol,
            "datetime": at,
            "open": close + rng.normal(0, 0.0002, n),
            "high": close + rng.uniform(0, 0.001, n),
            "low": close - rng.uniform(0, 0.001, n),
            "close": close,
        }
    )
    if gaps:
        keep = rng.random(n) > gaps
        keep[n // 3 : n // 2] = False
        frame = frame[keep]
    return frame.reset_index(drop=True)


def bars(spark, frame: pd.DataFrame):
    rows = [
        tuple(None if pd.isna(v) else (v.to_pydatetime() if isinstance(v, pd.Timestamp) else v) for v in row)
        for row in frame[["symbol", *S.BAR_COLUMNS]].itertuples(index=False)
    ]
    return spark.createDataFrame(rows, S.BAR_SCHEMA)


def collected(df, *order: str) -> pd.DataFrame:
    return df.toPandas().sort_values(list(order) or ["symbol", "datetime"]).reset_index(drop=True)


def assert_same(left: pd.DataFrame, right: pd.DataFrame, digits: int = 10) -> None:
    assert sorted(left.columns) == sorted(right.columns)
    assert len(left) == len(right)
    for c in left.columns:
        a, b = left[c], right[c]
        if pd.api.types.is_numeric_dtype(a) and pd.api.types.is_numeric_dtype(b):
            np.testing.assert_allclose(a.astype(float), b.astype(float), atol=10.0**-digits, err_msg=c)
        else:
            assert a.astype(str).tolist() == b.astype(str).tolist(), c
