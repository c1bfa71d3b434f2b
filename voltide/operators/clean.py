"""Missing values and outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide import schema as S
from voltide.functions.joins import join_keys
from voltide.functions.numeric import finite_or_null
from voltide.operators.features import feature_frame
from voltide.operators.series import DEFAULT_CHUNK, fill
from voltide.session import stage


def normalise_numbers(df: DataFrame) -> DataFrame:
    """NaN and infinities in double columns become NULL."""
    doubles = [f.name for f in df.schema if f.dataType.simpleString() in ("double", "float")]
    return df.withColumns({c: finite_or_null(F.col(c)) for c in doubles})


def handle_missing(
    df: DataFrame,
    method: str = "forward",
    keys: Sequence[str] = ("symbol",),
    order: str = "datetime",
    chunk_seconds: int = DEFAULT_CHUNK,
) -> DataFrame:
    """Fill every value column along the series, or drop incomplete rows.

    The order column itself cannot be filled: a row without a time has no place in its series and stays as
    it is. An unknown method leaves the data as it is.
    """
    if method == "drop":
        return df.na.drop("any")
    if method not in ("forward", "backward"):
        return df
    columns = [c for c in df.columns if c not in (*keys, order)]
    return fill(df, columns, method == "forward", keys, order, chunk_seconds=chunk_seconds)


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of null cells per column and in total."""
    counts = {c: F.count_if(F.col(c).isNull()) for c in df.columns}
    wide = df.agg(*[e.alias(c) for c, e in counts.items()])
    total = sum((F.col(c) for c in df.columns), start=F.lit(0).cast("long"))
    return wide.withColumn("total_nulls", total)


def remove_outliers(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    threshold: float | None = None,
    keys: Sequence[str] = ("symbol",),
) -> DataFrame:
    """Drop rows whose population z-score is not below the threshold, one column after another.

    The moments for each column come from the rows that survived the previous column; NULL values
    stay. A column with zero deviation has no z-score, so its non-null rows go. Moments are partial
    aggregates (no series is gathered anywhere) and have one row per series. They are written before
    the next column reads them, so the plan grows by one join per column and nothing runs twice.
    """
    threshold = S.OUTLIER_STD if threshold is None else threshold
    kept = df
    for c in S.OUTLIER_ORDER if columns is None else columns:
        if c not in df.columns:
            continue
        moments = stage(
            kept.groupBy(*keys).agg(F.avg(c).alias("_mean"), F.stddev_pop(c).alias("_deviation")), "moments"
        )
        z = F.try_divide(F.abs(F.col(c) - F.col("_mean")), F.col("_deviation"))
        kept = (
            join_keys(kept, moments, keys)
            .where((z < threshold) | F.col(c).isNull())
            .select(*df.columns)
        )
    return kept


def outlier_counts(
    df: DataFrame, threshold: float | None = None, keys: Sequence[str] = ("symbol",)
) -> DataFrame:
    """Rows before, after and removed per series."""
    before = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_before"))
    after = remove_outliers(df, threshold=threshold, keys=keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows_kept")
    )
    kept = F.coalesce("rows_kept", F.lit(0).cast("long"))
    return join_keys(before, after, keys, "left").select(
        *keys,
        "rows_before",
        kept.alias("rows_after"),
        (F.col("rows_before") - kept).alias("rows_removed"),
    )


def drop_null_target(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    return df.na.drop(subset=[target])


def transform(
    df: DataFrame,
    window: int = S.VOLATILITY_WINDOW,
    chunk_seconds: int = DEFAULT_CHUNK,
    staged: bool = True,
) -> DataFrame:
    """Fill forward, remove outliers, build features, keep complete rows.

    The outlier steps and the halo copies read their input several times. ``staged`` writes the
    filled and the cleaned bars once, so that these passes are narrow scans and not recomputations.
    """
    keep = (lambda frame, tag: stage(frame, tag)) if staged else (lambda frame, tag: frame)
    filled = keep(handle_missing(df, "forward", chunk_seconds=chunk_seconds), "filled")
    cleaned = keep(remove_outliers(filled), "cleaned")
    features = feature_frame(cleaned, window, chunk_seconds)
    return drop_null_target(features).na.drop("any")
