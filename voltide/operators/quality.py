"""Data-quality checks as report rows, and the gate over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltide import schema as S
from voltide.functions.joins import join_keys
from voltide.session import stage

REPORT = ["check_name", "column_name", "observed", "limit_value", "passed"]


class DataQualityError(ValueError):
    """Raised when a quality check fails."""


def schema_report(df: DataFrame) -> DataFrame:
    """Required columns with presence and type verdict; reads the schema only."""
    fields = {f.name: f.dataType for f in df.schema}
    rows = []
    for c in S.BAR_COLUMNS:
        kind = fields.get(c)
        numeric_ok = c == "datetime" or isinstance(kind, T.NumericType)
        rows.append((c, kind is not None, kind.simpleString() if kind else None, kind is not None and numeric_ok))
    columns = "column_name string, present boolean, data_type string, passed boolean"
    return df.sparkSession.createDataFrame(rows, columns)


def cell_report(df: DataFrame) -> DataFrame:
    """Required columns of a text table: presence, type, and the number of cells that do not convert."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    wanted = {c: "timestamp_ntz" if c == "datetime" else "double" for c in S.BAR_COLUMNS}
    bad = {
        c: F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull()) if c in kinds else F.lit(0).cast("long")
        for c, kind in wanted.items()
    }
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *[n.alias(f"bad_{c}") for c, n in bad.items()])
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(c in kinds).alias("present"),
            F.lit(kinds.get(c)).cast("string").alias("data_type"),
            F.col(f"bad_{c}").alias("failed_cells"),
            (F.lit(c in kinds) & (F.col(f"bad_{c}") == 0)).alias("passed"),
        )
        for c in S.BAR_COLUMNS
    ]
    return counted.select(F.inline(F.array(*cells)))


def schema_ok(df: DataFrame) -> bool:
    fields = {f.name: f.dataType for f in df.schema}
    return all(c in fields for c in S.BAR_COLUMNS) and all(
        isinstance(fields[c], T.NumericType) for c in S.PRICES
    )


def quality_report(
    df: DataFrame,
    keys: Sequence[str] = ("symbol",),
    max_null_pct: float | None = None,
    min_points: int | None = None,
) -> DataFrame:
    """Null share per required column and row count, per series (or overall with no keys).

    One aggregation; the share is NULL on no rows, which passes.
    """
    max_null_pct = S.MAX_NULL_PCT if max_null_pct is None else max_null_pct
    min_points = S.MIN_POINTS if min_points is None else min_points
    rows = F.count(F.lit(1)).alias("_rows")
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_nulls_{c}") for c in S.BAR_COLUMNS]
    counted = df.groupBy(*keys).agg(rows, *nulls) if keys else df.agg(rows, *nulls)

    def null_check(c: str):
        pct = F.try_divide(F.col(f"_nulls_{c}") * F.lit(100.0), F.col("_rows"))
        passed = F.coalesce(pct <= max_null_pct, F.lit(True))
        return F.struct(F.lit("null_pct"), F.lit(c), pct, F.lit(float(max_null_pct)), passed)

    enough = F.struct(
        F.lit("min_points"),
        F.lit("*"),
        F.col("_rows").cast("double"),
        F.lit(float(min_points)),
        F.col("_rows") >= min_points,
    )
    checks = F.explode(F.array(*[null_check(c) for c in S.BAR_COLUMNS], enough)).alias("_check")
    names = ["col1", "col2", "col3", "col4", "col5"]
    return counted.select(*keys, checks).select(
        *keys, *[F.col(f"_check.{old}").alias(new) for old, new in zip(names, REPORT, strict=True)]
    )


def null_pct_report(df: DataFrame, **options) -> DataFrame:
    return quality_report(df, **options).where(F.col("check_name") == "null_pct")


def min_points_report(df: DataFrame, **options) -> DataFrame:
    return quality_report(df, **options).where(F.col("check_name") == "min_points")


def validate(df: DataFrame, keys: Sequence[str] = (), **options) -> DataFrame:
    """Return ``df`` if every check passes, else raise with the failed checks. Schema goes first."""
    if not schema_ok(df):
        raise DataQualityError("schema check failed: required columns are missing or not numeric")
    failed = stage(quality_report(df, keys, **options).where(~F.col("passed")), "failed-checks")
    n = failed.count()
    if n:
        named = failed.groupBy("check_name", "column_name").agg(F.count(F.lit(1)).alias("n"), F.min("observed"), F.max("observed"))
        spelled = "; ".join(f"{r[0]}({r[1]}): {r[2]} failed, observed {r[3]} to {r[4]}" for r in named.collect())
        raise DataQualityError(f"{n} checks failed: {spelled}")
    return df


def quarantine(
    df: DataFrame, keys: Sequence[str] = ("symbol",), **options
) -> tuple[DataFrame, DataFrame]:
    """Rows of passing series, and rows of series with a failed check."""
    failed = quality_report(df, keys, **options).where(~F.col("passed")).select(*keys).distinct()
    return join_keys(df, failed, keys, "left_anti"), join_keys(df, failed, keys, "left_semi")
