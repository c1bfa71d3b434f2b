"""Dataset versions published by a commit log.

A version is written in full below a folder of its own first; then one line is added to the log, which makes it visible. What an
interrupted write left behind is in no line and never read. Every line has the version's rows, columns, first and last time and
content sum, and those of each of its files, so the newest version, the manifest and the high-water marks are answered
from the log and the small marks table and no data is read.

Content sums add up 64-bit hashes of rows and do not depend on their order. A version that is published again is replaced by its
last line. A missing key is a key like any other; a version without rows has no times and no marks.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FIGURES = "n_rows long, min_time timestamp_ntz, max_time timestamp_ntz, content_hash decimal(38,0)"
LOG_SCHEMA = (
    "version string, committed_at timestamp, data string, marks string, columns string, n_columns int, "
    f"{FIGURES}, files array<struct<file: string, n_rows: long, min_time: timestamp_ntz, max_time: timestamp_ntz, "
    "content_hash: decimal(38,0)>>"
)


def publish(df: DataFrame, path: str, version: str, at: str = "datetime", key: str = "symbol") -> None:
    """Write ``df`` as ``version`` and make it visible with the last step."""
    spark, mark = df.sparkSession, uuid.uuid4().hex
    data, marks = f"data/{version}-{mark}", f"marks/{version}-{mark}"
    df.write.parquet(f"{path}/{data}")
    written = spark.read.schema(df.schema).parquet(f"{path}/{data}")
    newest = written.groupBy(F.col(key).alias("key")).agg(F.max(at).alias("newest"))
    newest.write.parquet(f"{path}/{marks}")
    hashed = F.xxhash64(*df.columns).cast("decimal(38,0)")
    by_file = written.groupBy(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(at).alias("min_time"),
        F.max(at).alias("max_time"),
        F.sum(hashed).alias("content_hash"),
    )
    line = by_file.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.min("min_time").alias("min_time"),
        F.max("max_time").alias("max_time"),
        F.coalesce(F.sum("content_hash"), F.lit(0)).cast("decimal(38,0)").alias("content_hash"),
        F.sort_array(F.collect_list(F.struct(*by_file.columns))).alias("files"),
    ).select(
        F.lit(version).alias("version"),
        F.current_timestamp().alias("committed_at"),
        F.lit(data).alias("data"),
        F.lit(marks).alias("marks"),
        F.lit(df.schema.json()).alias("columns"),
        F.lit(len(df.columns)).alias("n_columns"),
        "n_rows",
        "min_time",
        "max_time",
        "content_hash",
        "files",
    )
    line.coalesce(1).write.mode("append").json(f"{path}/log")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """The log, one row per version: its last line."""
    try:
        found = spark.read.schema(LOG_SCHEMA).json(f"{path}/log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)
    names = [c for c in found.columns if c != "version"]
    last = F.max_by(F.struct(*names), F.struct("committed_at", "data")).alias("line")
    return found.groupBy("version").agg(last).select("version", "line.*")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Rows, columns, times and content sum of every version."""
    return lines(spark, path).drop("committed_at", "data", "marks", "columns", "files")


def read(spark: SparkSession, path: str, prefix: str = "", below: str | None = None) -> DataFrame | None:
    """The newest version by name (with a prefix, before another name); None if there is none."""
    known = lines(spark, path).where(F.col("version").startswith(prefix))
    if below is not None:
        known = known.where(F.col("version") < below)
    newest = known.select("version", "data", "columns").orderBy(F.col("version").desc()).limit(1).collect()
    if not newest:
        return None
    schema = StructType.fromJson(json.loads(newest[0]["columns"]))
    return spark.read.schema(schema).parquet(f"{path}/{newest[0]['data']}")


def latest_name(spark: SparkSession, path: str, prefix: str = "processed_data") -> str:
    """The newest version by name; an error if there is none."""
    name = lines(spark, path).where(F.col("version").startswith(prefix)).agg(F.max("version")).first()[0]
    if name is None:
        raise ValueError(f"no version found with prefix '{prefix}'")
    return name


def read_latest(spark: SparkSession, path: str, prefix: str = "processed_data") -> DataFrame:
    return read(spark, path, latest_name(spark, path, prefix))


def high_water_marks(spark: SparkSession, path: str, key: str = "symbol", at: str = "datetime") -> DataFrame:
    """The newest published time of every key over all versions."""
    folders = [f"{path}/{row['marks']}" for row in lines(spark, path).select("marks").collect()]
    if not folders:
        return spark.createDataFrame([], f"{key} string, {at} timestamp_ntz")
    marks = spark.read.parquet(*folders)
    return marks.groupBy(F.col("key").alias(key)).agg(F.max("newest").alias(at))
