"""Features on a stream whose bars may arrive late.

Every micro-batch is merged with a tail table of earlier bars, and the batch operator ``feature_frame`` runs over the rows whose windows a
new bar can reach: the bar itself, the one before it (whose target it gives) and the 25 behind it. These rows are emitted again
as a new revision, so the newest revision of every bar equals the batch frame over all bars so far. A bar is emitted once its
successor has arrived.

The tail is a version of a commit log, one per batch; it holds the bars of the last ``lateness`` of every symbol and the 52 before
them, so its size follows from that span and not from the stream's length. Bars older than that are written to
``rejected`` and counted. Without a ``lateness`` all bars are kept. A batch reads the newest tail before its own number and overwrites
what an earlier try of it wrote, so a repeated batch has one result.

Of several bars of one symbol and time the latest batch wins, and within a batch the one with the greatest values. A missing
symbol is a symbol like any other; bars without a time are rejected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide import schema as S
from voltide.functions.clock import plus_seconds
from voltide.functions.joins import join_keys
from voltide.operators.features import feature_frame
from voltide.operators.series import DEFAULT_CHUNK, chunk_window, drop_halo, with_halo
from voltide.session import stage
from voltide.sources import bars as source
from voltide.sources import commits

REACH = max(*S.LAGS, *S.ROLLING_WINDOWS, S.VOLATILITY_WINDOW) + 1
BAR = ["symbol", "datetime", *S.PRICES]
EMITTED = [*BAR, *S.FEATURES_WITH_VOLATILITY, S.TARGET]


def _merged(known: DataFrame | None, batch: DataFrame) -> DataFrame:
    """One bar per symbol and time, with ``_fresh`` for those of the batch."""
    rows = batch.select(*BAR, F.lit(True).alias("_fresh"))
    if known is not None:
        rows = rows.unionByName(known.select(*BAR, F.lit(False).alias("_fresh")))
    best = F.max(F.struct("_fresh", *S.PRICES)).alias("bar")
    return rows.groupBy("symbol", "datetime").agg(best).select("symbol", "datetime", "bar.*")


def _touched(rows: DataFrame, chunk_seconds: int) -> DataFrame:
    """Rows in the reach of a fresh one, with ``_emit`` for those whose features it changes and whose successor is known."""
    w = chunk_window()
    around = with_halo(rows, REACH + 1, REACH + 1, carry=["_fresh"], chunk_seconds=chunk_seconds)
    fresh = F.col("_fresh").cast("int")
    marked = around.withColumns(
        {
            "_near": F.max(fresh).over(w.rowsBetween(-REACH - 1, REACH + 1)),
            "_changed": F.max(fresh).over(w.rowsBetween(-REACH, 1)),
            "_following": F.lead("datetime", 1).over(w),
        }
    )
    emit = (F.col("_changed") == 1) & F.col("_following").isNotNull()
    return drop_halo(marked).where("_near = 1").select(*BAR, emit.alias("_emit"))


def _kept(rows: DataFrame, lateness: int | None, chunk_seconds: int) -> DataFrame:
    """The tail for the next batch."""
    bars = rows.select(*BAR)
    if lateness is None:
        return bars
    marks = bars.groupBy("symbol").agg(F.max("datetime").alias("_newest"))
    aged = join_keys(bars, marks, ["symbol"])
    recent = F.col("datetime") >= plus_seconds(F.col("_newest"), F.lit(-lateness))
    older = source.latest_n(aged.where(~recent).select(*BAR), 2 * (REACH + 1), chunk_seconds=chunk_seconds)
    return aged.where(recent).select(*BAR).unionByName(older)


def _admitted(batch: DataFrame, marks: DataFrame | None, lateness: int | None) -> tuple[DataFrame, DataFrame]:
    """Bars of a batch that may come in, and those without a time or too late."""
    timed = F.col("datetime").isNotNull()
    if marks is None or lateness is None:
        return batch.where(timed), batch.where(~timed)
    rows = join_keys(batch, marks.withColumnRenamed("datetime", "_newest"), ["symbol"], "left")
    late = F.coalesce(F.col("datetime") < plus_seconds(F.col("_newest"), F.lit(-lateness)), F.lit(False))
    return rows.where(timed & ~late).select(*BAR), rows.where(~timed | late).select(*BAR)


def _name(batch: int) -> str:
    return f"tail-{batch:012d}"


def feature_writer(
    path: str, lateness: int | None = None, chunk_seconds: int = DEFAULT_CHUNK
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer of feature revisions below ``path``; ``lateness`` is in seconds."""

    def write(batch: DataFrame, number: int) -> None:
        spark, tail = batch.sparkSession, f"{path}/tail"
        known = commits.read(spark, tail, below=_name(number))
        marks = None if known is None else known.groupBy("symbol").agg(F.max("datetime").alias("datetime"))
        arrived = stage(batch.select(*BAR), "arrived")
        admitted, rejected = _admitted(arrived, marks, lateness)
        rows = stage(_merged(known, admitted), "merged")
        near = stage(_touched(rows, chunk_seconds), "touched")
        emitted = feature_frame(near, chunk_seconds=chunk_seconds).where("_emit").select(*EMITTED)
        emitted.write.mode("overwrite").parquet(f"{path}/features/revision={number}")
        rejected.write.mode("overwrite").parquet(f"{path}/rejected/batch={number}")
        commits.publish(_kept(rows, lateness, chunk_seconds), tail, _name(number))

    return write


def revisions(spark: SparkSession, path: str) -> DataFrame:
    """Everything that was emitted, with its ``revision`` (the number of the batch)."""
    return spark.read.parquet(f"{path}/features")


def newest(spark: SparkSession, path: str) -> DataFrame:
    """The newest revision of every bar."""
    rows = revisions(spark, path)
    kept = [c for c in rows.columns if c not in ("symbol", "datetime", "revision")]
    last = F.max_by(F.struct(*kept), "revision").alias("row")
    return rows.groupBy("symbol", "datetime").agg(last).select("symbol", "datetime", "row.*")


def rejected_counts(spark: SparkSession, path: str) -> DataFrame:
    """Bars that came too late or without a time, per symbol."""
    return spark.read.parquet(f"{path}/rejected").groupBy("symbol").agg(F.count(F.lit(1)).alias("rejected_bars"))
