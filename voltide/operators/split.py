"""Training frames: feature selection, time-ordered splits, folds and scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltide import schema as S
from voltide.operators.distribution import exact_quantiles, long_form
from voltide.operators.series import DEFAULT_CHUNK, row_index

INDEX, SIZE = "_index", "_series_rows"

# Columns that are never features; the plain trainer leaves out ``volatility`` too.
NOT_FEATURES = ["symbol", *S.BAR_COLUMNS, S.TARGET]


def feature_names(df: DataFrame, with_volatility: bool = True) -> list[str]:
    excluded = NOT_FEATURES if with_volatility else [*NOT_FEATURES, "volatility"]
    return [c for c in df.columns if c not in excluded]


def select_features(df: DataFrame, with_volatility: bool = True, keep: Sequence[str] = ("symbol", "datetime")) -> DataFrame:
    return df.select(*keep, *feature_names(df, with_volatility), S.TARGET)


def drop_incomplete(df: DataFrame, features: Sequence[str], target: str = S.TARGET) -> DataFrame:
    return df.na.drop("any", subset=[*features, target])


# ---- positions turned into splits; use on rows with ``row_index`` columns -------------------------


def split_label(ratio: float = S.TRAIN_RATIO) -> Column:
    """``train`` for the first ``int(n * ratio)`` rows of a series, ``test`` for the rest, NULL without a position."""
    first_test = F.floor(F.col(SIZE) * F.lit(ratio))
    i = F.col(INDEX)
    return F.when(i < first_test, F.lit("train")).when(i.isNotNull(), F.lit("test"))


def block_fold(folds: int = 5) -> Column:
    """Contiguous blocks from 0; the first ``n mod folds`` of them are one row longer."""
    size, i = F.col(SIZE), F.col(INDEX)
    short = F.floor(size / folds)
    longer = size - short * folds
    in_longer = F.try_divide(i, short + 1)
    in_short = longer + F.try_divide(i - longer * (short + 1), short)
    return F.when(i < longer * (short + 1), F.floor(in_longer)).otherwise(F.floor(in_short)).cast("int")


def expanding_fold(folds: int = 5) -> Column:
    """The fold (from 0) that tests the row, -1 for rows that are only trained on.

    Fold f trains on every row of the series before its first test row: ``test_fold < f``.
    """
    size, i = F.col(SIZE), F.col(INDEX)
    test_rows = F.floor(size / (folds + 1))
    first = size - test_rows * folds
    tested = F.floor(F.try_divide(i - first, test_rows))
    return F.when(i < first, F.lit(-1)).when(i.isNotNull(), tested).cast("int")


def with_splits(
    df: DataFrame,
    splits: Mapping[str, Column],
    keys: Sequence[str] = ("symbol",),
    chunk_seconds: int = DEFAULT_CHUNK,
) -> DataFrame:
    """Adds split columns from one shared row index."""
    indexed = row_index(df, keys, chunk_seconds=chunk_seconds, index=INDEX, size=SIZE)
    return indexed.withColumns(dict(splits)).drop(INDEX, SIZE)


def time_split(df: DataFrame, ratio: float = S.TRAIN_RATIO, **where) -> DataFrame:
    return with_splits(df, {"split": split_label(ratio)}, **where)


def block_folds(df: DataFrame, folds: int = 5, **where) -> DataFrame:
    return with_splits(df, {"fold": block_fold(folds)}, **where)


def expanding_folds(df: DataFrame, folds: int = 5, **where) -> DataFrame:
    return with_splits(df, {"test_fold": expanding_fold(folds)}, **where)


def fold_sizes(df: DataFrame, folds: int = 5, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Train and test rows of every expanding fold, from one count per series and fold id."""
    counts = df.groupBy(*keys, "test_fold").agg(F.count(F.lit(1)).alias("rows"))
    per_fold = [
        F.struct(
            F.lit(f).alias("fold"),
            F.when(F.col("test_fold") < f, F.col("rows")).otherwise(0).alias("train"),
            F.when(F.col("test_fold") == f, F.col("rows")).otherwise(0).alias("test"),
        )
        for f in range(folds)
    ]
    spread = counts.select(*keys, F.explode(F.array(*per_fold)).alias("x"))
    return spread.groupBy(*keys, F.col("x.fold").alias("fold")).agg(
        F.sum("x.train").alias("train_rows"), F.sum("x.test").alias("test_rows")
    )


def fit_robust(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Median and interquartile range per feature, exact; one small row per feature reaches the driver."""
    quartiles = exact_quantiles(
        long_form(df, features), ["feature"], "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}
    )
    return {r["feature"]: (r["median"], r["q3"] - r["q1"]) for r in quartiles.collect()}


def apply_robust(df: DataFrame, fitted: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(x - median) / IQR as plain column arithmetic; an IQR of 0 divides by 1."""
    return df.withColumns(
        {c: (F.col(c) - F.lit(center)) / F.lit(spread or 1.0) for c, (center, spread) in fitted.items()}
    )


def robust_scale(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Scale a frame with a ``split`` column by statistics of its train rows."""
    return apply_robust(df, fit_robust(df.where(F.col("split") == "train"), features))


def sample_head(df: DataFrame, n: int = 200, order: Sequence[str] = ("datetime", "symbol")) -> DataFrame:
    """First ``n`` rows in time order."""
    return df.orderBy(*order).limit(n)
