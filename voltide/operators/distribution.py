"""Empirical distributions of many keys at once, without gathering any key in one task.

Values are first counted per (key, value). The counted rows are range-partitioned on (key, value), so a
key with many distinct values spans many slices, and staged with their slice number. Running counts are
sums inside a slice plus the totals of the earlier slices of the key; the only window over a whole key
runs on one row per slice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltide.functions.joins import join_keys
from voltide.session import stage

SLICE = "_slice"


def ranked_values(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    counts: Mapping[str, Column] | None = None,
    keep_slice: bool = False,
) -> DataFrame:
    """One row per key and distinct value, in value order, with running and total counts.

    For every entry ``name`` of ``counts`` (an aggregate; default: row count ``n``) the result has
    ``name``, ``cum_name`` (inclusive) and ``total_name``; ``next_value`` is the next distinct value.
    """
    counts = counts or {"n": F.count(F.lit(1))}
    counted = (
        df.where(F.col(value).isNotNull() & ~F.isnan(value))
        .groupBy(*keys, value)
        .agg(*[e.alias(name) for name, e in counts.items()])
    )
    sliced = stage(
        counted.repartitionByRange(*keys, value).withColumn(SLICE, F.spark_partition_id()), "ranked"
    )
    across = Window.partitionBy(*keys).orderBy(SLICE)
    earlier, whole = across.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*keys)
    slices = (
        sliced.groupBy(*keys, SLICE)
        .agg(F.min(value).alias("_first"), *[F.sum(n).alias(f"_sum_{n}") for n in counts])
        .select(
            *keys,
            SLICE,
            F.lead("_first").over(across).alias("_after"),
            *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in counts],
            *[F.sum(f"_sum_{n}").over(whole).alias(f"total_{n}") for n in counts],
        )
    )
    inside = Window.partitionBy(*keys, SLICE).orderBy(value)
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    local = sliced.withColumns(
        {
            "_next": F.lead(value).over(inside),
            **{f"_inside_{n}": F.sum(n).over(running) for n in counts},
        }
    )
    return join_keys(local, slices, [*keys, SLICE]).select(
        *keys,
        value,
        F.coalesce("_next", "_after").alias("next_value"),
        *counts,
        *[(F.col(f"_inside_{n}") + F.col(f"_before_{n}")).alias(f"cum_{n}") for n in counts],
        *[f"total_{n}" for n in counts],
        *([SLICE] if keep_slice else []),
    )


def sum_before(ranked: DataFrame, keys: Sequence[str], value: str, column: str, into: str) -> DataFrame:
    """Sum of ``column`` over the smaller values of the key, for ranked values with their slice."""
    across = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranked.groupBy(*keys, SLICE).agg(F.sum(column).alias("_total"))
    earlier = totals.select(*keys, SLICE, F.coalesce(F.sum("_total").over(across), F.lit(0.0)).alias("_earlier"))
    inside = Window.partitionBy(*keys, SLICE).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = ranked.withColumn("_local", F.coalesce(F.sum(column).over(inside), F.lit(0.0)))
    return (
        join_keys(local, earlier, [*keys, SLICE])
        .withColumn(into, F.col("_local") + F.col("_earlier"))
        .drop("_local", "_earlier")
    )


def pick_quantiles(probabilities: Mapping[str, float], value: str, count: str = "n") -> list[Column]:
    """Aggregates over ranked values: exact quantiles with linear interpolation."""
    picked = []
    for name, p in probabilities.items():
        position = (F.col(f"total_{count}") - 1) * F.lit(float(p))
        low = F.min(F.when(F.col(f"cum_{count}") > F.floor(position), F.col(value)))
        high = F.min(F.when(F.col(f"cum_{count}") > F.ceil(position), F.col(value)))
        share = F.max(position - F.floor(position))
        picked.append((low + (high - low) * share).alias(name))
    return picked


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: Mapping[str, float]
) -> DataFrame:
    ranked = ranked_values(df, keys, value)
    return ranked.groupBy(*keys).agg(*pick_quantiles(probabilities, value))


def long_form(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Unpivot numeric columns to (feature, value)."""
    doubles = [F.col(c).cast("double").alias(c) for c in columns]
    ids = list(ids)
    return df.select(*ids, *doubles).unpivot(ids, list(columns), "feature", "value")
