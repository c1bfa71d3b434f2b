"""Column profiles of a frame as tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.operators.distribution import long_form, pick_quantiles, ranked_values

QUANTILES = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95}


def columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Counts, extremes, moments and exact quantiles per numeric column.

    Skewness is m3 / m2^1.5 and kurtosis m4 / m2^2 - 3 of the population moments, centred on the mean.
    """
    long = long_form(df, names)
    ranked = ranked_values(long, ["feature"], "value")
    n, v = F.col("n"), F.col("value")
    first = ranked.groupBy("feature").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.sum(F.when(v == 0, n).otherwise(0)).alias("zeros"),
        (F.sum(v * n) / F.sum("n")).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        *pick_quantiles(QUANTILES, "value"),
    )
    d = v - F.col("mean")
    moments = (
        ranked.join(first.select("feature", "mean"), "feature")
        .groupBy("feature")
        .agg(*[F.sum(n * d**k).alias(f"s{k}") for k in (2, 3, 4)])
    )
    nulls = long.groupBy("feature").agg(F.count_if(F.col("value").isNull()).alias("nulls"))
    m2, m3, m4 = (F.col(f"s{k}") / F.col("count") for k in (2, 3, 4))
    shaped = first.join(moments, "feature").withColumns(
        {
            "std": F.sqrt(F.try_divide(F.col("s2"), F.col("count") - 1)),
            "skewness": F.try_divide(m3, m2**1.5),
            "kurtosis": F.try_divide(m4, m2 * m2) - 3,
        }
    )
    zero = F.lit(0).cast("long")
    return nulls.join(shaped.drop("s2", "s3", "s4"), "feature", "left").withColumns(
        {c: F.coalesce(c, zero) for c in ("count", "n_distinct", "zeros")}
    )


def correlation(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns in one pass (rows where both are present); NULL if one does not vary.

    Sums are centred on the column means and added up per task, one row for each pair.
    """
    names, pairs = list(names), list(combinations(range(len(names)), 2))
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in names])
    means = doubles.agg(*[F.avg(c) for c in names]).first()
    centre = np.asarray([0.0 if m is None else m for m in means])
    i, j = np.asarray(pairs).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((6, len(names), len(names)))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) - centre
            there = np.asarray([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]).T
            x, n = np.where(there, x, 0.0), there.astype(float)
            sums += [n.T @ n, x.T @ n, n.T @ x, (x * x).T @ n, n.T @ (x * x), x.T @ x]
        columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *(pa.array(s[i, j]) for s in sums)]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", *parts])

    parts = ["n", "a", "b", "aa", "bb", "ab"]
    added = doubles.mapInArrow(run, "i int, j int, " + ", ".join(f"{c} double" for c in parts)).groupBy("i", "j")
    s = added.agg(*[F.sum(c).alias(c) for c in parts]).withColumns(
        {
            "va": F.col("aa") - F.try_divide(F.col("a") * F.col("a"), F.col("n")),
            "vb": F.col("bb") - F.try_divide(F.col("b") * F.col("b"), F.col("n")),
            "cov": F.col("ab") - F.try_divide(F.col("a") * F.col("b"), F.col("n")),
        }
    )
    varies = (F.col("va") > 1e-13 * F.col("aa")) & (F.col("vb") > 1e-13 * F.col("bb"))
    named = F.array(*map(F.lit, names))
    return s.select(
        named[F.col("i")].alias("left_column"),
        named[F.col("j")].alias("right_column"),
        F.when(varies, F.try_divide(F.col("cov"), F.sqrt("va") * F.sqrt("vb"))).alias("correlation"),
    )


def histogram(df: DataFrame, names: Sequence[str], bins: int = 10) -> DataFrame:
    """Equal-width histogram per column between its minimum and maximum."""
    long = long_form(df, names).where(F.col("value").isNotNull())
    spans = long.groupBy("feature").agg(F.min("value").alias("_low"), F.max("value").alias("_high"))
    place = F.floor(F.try_divide((F.col("value") - F.col("_low")) * bins, F.col("_high") - F.col("_low")))
    inside = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int")
    counted = long.join(spans, "feature").groupBy("feature", inside.alias("bin")).agg(
        F.first("_low").alias("_low"), F.first("_high").alias("_high"), F.count(F.lit(1)).alias("count")
    )
    width = (F.col("_high") - F.col("_low")) / bins
    return counted.select(
        "feature",
        "bin",
        (F.col("_low") + width * F.col("bin")).alias("bin_start"),
        (F.col("_low") + width * (F.col("bin") + 1)).alias("bin_end"),
        "count",
    )


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def top_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """Most frequent values; equal counts are ordered by value."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.col("count").desc(), F.col("value")).limit(k)
