"""Reading the tables that the queries of this package work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltide.session import stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(taken: list[str], wanted: str) -> str:
    """``wanted``, or with underscores before it, so that it clashes with no column in ``taken``."""
    lowered = {name.lower() for name in taken}
    while wanted.lower() in lowered:
        wanted = f"_{wanted}"
    return wanted


def row_mark(*parts: Column) -> Column:
    """One text for several values, NULL among them, to join and group rows on."""
    return F.concat_ws("/", *(F.coalesce(part.cast("string"), F.lit("null")) for part in parts))


def first_of_each(rows: DataFrame, key: str) -> DataFrame:
    """One row per key: the first by all its columns. After a join on the key nothing is shuffled again."""
    turn = free_name(rows.columns, "turn")
    order = [F.to_json(F.struct(F.col(c))) if "<" in kind else F.col(c) for c, kind in rows.dtypes if c != key]
    ranked = rows.withColumn(turn, F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.filter(F.col(turn) == 1).drop(turn)


def positions(rows: DataFrame, order: list[Column], tag: str) -> DataFrame:
    """The rows with their ``position`` (from 0) in the global order; written once, so positions stay.

    Rows are range-partitioned and sorted where they lie; what runs in one task is one row per partition. Rows that
    tie on ``order`` get neighbouring positions.
    """
    local_bits = 33
    placed = stage(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()),
        tag,
    )
    part = F.shiftright("at", local_bits)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    offsets = counts.select(F.col("part").alias("offset_part"), before.alias("offset"))
    local = F.col("at").bitwiseAND(F.lit((1 << local_bits) - 1))
    return (
        placed.join(offsets, part == F.col("offset_part"))
        .withColumn("position", F.col("offset") + local)
        .drop("at", "offset", "offset_part")
    )
