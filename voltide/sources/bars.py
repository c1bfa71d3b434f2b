"""Reading, typing, versioning and writing bar tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltide import schema as S
from voltide.functions.numeric import finite_or_null
from voltide.functions.joins import join_keys
from voltide.operators.series import CHUNK, DEFAULT_CHUNK, chunked

VERSION_FORMAT = "yyyyMMdd_HHmmss"


# ---- landed payloads -----------------------------------------------------------------------------


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed response files, one JSON object per line, with a declared schema."""
    return spark.read.schema(S.PAYLOAD_SCHEMA).json(path)


def _usable() -> Column:
    return F.col("values").isNotNull() & (F.coalesce(F.col("status"), F.lit("ok")) != "error")


def payload_bars(payloads: DataFrame) -> DataFrame:
    """One text row per bar of every usable payload."""
    return (
        payloads.where(_usable())
        .select("symbol", F.explode("values").alias("bar"))
        .select("symbol", *[F.col(f"bar.{c}").alias(c) for c in S.BAR_COLUMNS])
    )


def rejected_payloads(payloads: DataFrame) -> DataFrame:
    reason = F.when(F.col("status") == "error", F.coalesce("message", F.lit("unknown error"))).otherwise(
        F.lit("no values in response")
    )
    return payloads.where(~_usable()).select("symbol", "status", reason.alias("reason"))


def _number(text: Column) -> Column:
    # a trailing d or f is a Java literal suffix and not part of a number
    return finite_or_null(F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text.try_cast("double")))


def _moment(text: Column) -> Column:
    parsed = text.try_cast("timestamp_ntz")
    broken = text.isNotNull() & parsed.isNull()
    message = F.concat(F.lit("unparsable datetime: "), text)
    return F.when(broken, F.raise_error(message).cast("timestamp_ntz")).otherwise(parsed)


def coerce_types(df: DataFrame) -> DataFrame:
    """Text to types: an unparsable number becomes NULL, an unparsable datetime is an error."""
    typed = {c: _number(F.col(c)) for c in S.PRICES if c in df.columns}
    return df.withColumns({"datetime": _moment(F.col("datetime")), **typed})


def ingest_json(spark: SparkSession, path: str) -> DataFrame:
    return coerce_types(payload_bars(read_payloads(spark, path)))


def payloads_of(df: DataFrame) -> DataFrame:
    """Bars as text payloads of at most one week per symbol, the size of one fetch, newest first."""
    week = F.floor(F.unix_date(F.to_date("datetime")) / 7).alias("week")
    bar = F.struct(*[F.col(c) for c in S.BAR_COLUMNS])
    return (
        df.groupBy("symbol", week)
        .agg(F.sort_array(F.collect_list(bar), asc=False).alias("values"))
        .select("symbol", F.lit("ok").alias("status"), F.lit(None).cast("string").alias("message"), "values")
    )


# ---- selection -----------------------------------------------------------------------------------


def date_range(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows from ``start`` to ``end``, both inclusive; a plain predicate that reaches the scan."""
    at = F.col("datetime")
    if start is not None:
        df = df.where(at >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.where(at <= F.lit(end).cast("timestamp_ntz"))
    return df


def latest_n(
    df: DataFrame,
    n: int = S.FETCH_SIZE,
    keys: Sequence[str] = ("symbol",),
    chunk_seconds: int = DEFAULT_CHUNK,
) -> DataFrame:
    """Newest ``n`` rows per series.

    Counts per time chunk tell how many rows are newer than each chunk; only chunks that can still hold
    one of the newest rows are kept, and rows are ranked inside their chunk.
    """
    group = [*keys, CHUNK]
    rows = chunked(df, "datetime", chunk_seconds)
    newest_first = Window.partitionBy(*keys).orderBy(F.col(CHUNK).desc())
    newer = F.sum("_count").over(newest_first.rowsBetween(Window.unboundedPreceding, -1))
    wanted = (
        rows.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("_count"))
        .withColumn("_newer", F.coalesce(newer, F.lit(0)))
        .where(F.col("_newer") < n)
        .select(*group, "_newer")
    )
    inside = Window.partitionBy(*group).orderBy(F.col("datetime").desc())
    ranked = rows.withColumn("_rank", F.row_number().over(inside)).where(F.col("_rank") <= n)
    return join_keys(ranked, wanted, group).where(F.col("_rank") + F.col("_newer") <= n).select(*df.columns)


def sort_bars(df: DataFrame) -> DataFrame:
    return df.orderBy("symbol", "datetime")


def newer_than(df: DataFrame, processed: DataFrame) -> DataFrame:
    """Rows later than the last processed time of their symbol; unknown symbols are all new."""
    marks = processed.groupBy("symbol").agg(F.max("datetime").alias("_mark"))
    return (
        join_keys(df, marks, ["symbol"], "left")
        .where(F.col("_mark").isNull() | (F.col("datetime") > F.col("_mark")))
        .select(*df.columns)
    )


# ---- files and versions --------------------------------------------------------------------------


def write_csv(df: DataFrame, path: str) -> None:
    """Raw snapshot as CSV with a header."""
    text = df.withColumn("datetime", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"))
    text.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.schema(S.BAR_SCHEMA).option("header", True)
    return reader.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)


def write_versions(df: DataFrame, path: str) -> None:
    """Append a frame with a ``version`` column as version partitions."""
    df.write.mode("append").partitionBy("version").parquet(path)


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def manifest(df: DataFrame) -> DataFrame:
    """Rows, columns and an order-insensitive content hash per version."""
    content = [c for c in df.columns if c != "version"]
    return df.groupBy("version").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.first(F.lit(len(content))).alias("n_columns"),
        F.sum(F.xxhash64(*[F.col(c) for c in content]).cast("decimal(38,0)")).alias("content_hash"),
    )


def latest_version_name(versions: DataFrame, prefix: str = "processed_data") -> str:
    """Lexicographically last version with the prefix; an error if there is none."""
    named = versions.where(F.col("version").startswith(prefix))
    name = named.agg(F.max("version").alias("version")).first()["version"]
    if name is None:
        raise ValueError(f"no version found with prefix '{prefix}'")
    return name


def read_latest(spark: SparkSession, path: str, prefix: str = "processed_data") -> DataFrame:
    """The newest version, selected by a literal so that other partitions are never listed for reading."""
    table = read_versions(spark, path)
    return table.where(F.col("version") == latest_version_name(table.select("version"), prefix))
