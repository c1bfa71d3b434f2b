"""Joins in which a missing key is a key like any other."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, NULL being equal to NULL; the keys come from ``left``.

    Spark hashes and sorts null-safe equalities as it does plain ones, so the plan stays the same.
    """
    other = right.withColumnsRenamed({k: f"_other_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_other_{k}")) for k in keys])
    return left.join(other, same, how).drop(*[f"_other_{k}" for k in keys])
