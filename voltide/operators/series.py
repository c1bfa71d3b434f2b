"""Windows over ordered series whose work is split inside each series.

A series (one symbol, one metric, one label set) may hold a large share of all rows, so no operator
here puts a whole series into one window partition. Rows are cut into fixed-width time chunks and
windows run on ``(keys, chunk)``. What a window needs from outside its chunk travels separately:

* a bounded frame (lag, lead, rolling) gets copies of the last or first few rows of the neighbouring
  chunks (``with_halo``);
* an unbounded frame (fill, running sum, row index) gets one carried value per chunk, taken from a
  summary with one row per series and chunk. The only window over a whole series runs on that summary,
  whose length is bounded by time span / chunk width and does not depend on the number of rows.

Time chunks suit bars: their grid bounds the rows of a chunk. Logs have no such bound, as one burst may
hold much of the table; ``sliced`` cuts them into equally large ranges of (keys, order, tie) instead and
every operator here accepts its result.

A missing key is a key like any other. A row without an order value has no place in its series: fills leave it as it is,
positions and running sums of it are NULL, and it is nobody's neighbour. Ties are ordered by ``tie`` columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from voltide.functions.clock import time_chunk
from voltide.functions.joins import join_keys
from voltide.session import stage

CHUNK = "_chunk"
HALO = "_halo"
DAY = 86_400
DEFAULT_CHUNK = 30 * DAY


def _order(order: str, tie: Sequence[str], descending: bool = False) -> list[Column]:
    columns = [F.col(c) for c in (order, *tie)]
    return [c.desc() if descending else c.asc() for c in columns]


def chunked(df: DataFrame, order: str = "datetime", chunk_seconds: int = DEFAULT_CHUNK) -> DataFrame:
    """Adds the chunk number, unless the rows are ``sliced`` already."""
    if CHUNK in df.columns:
        return df
    return df.withColumn(CHUNK, time_chunk(F.col(order), chunk_seconds))


def sliced(df: DataFrame, keys: Sequence[str], order: str, tie: Sequence[str] = ()) -> DataFrame:
    """Rows range-partitioned on (keys, order, tie), with the partition number as the chunk.

    Spark samples the range bounds, so the result is staged: every later branch must see one numbering.
    """
    ranged = df.repartitionByRange(*keys, order, *tie)
    return stage(ranged.withColumn(CHUNK, F.spark_partition_id().cast("long")), "sliced")


def chunk_window(
    keys: Sequence[str] = ("symbol",), order: str = "datetime", tie: Sequence[str] = ()
) -> WindowSpec:
    return Window.partitionBy(*keys, CHUNK).orderBy(*_order(order, tie))


def _series_window(keys: Sequence[str], descending: bool = False) -> WindowSpec:
    chunk = F.col(CHUNK)
    return Window.partitionBy(*keys).orderBy(chunk.desc() if descending else chunk.asc())


def _placed(rows: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """Rows with and without an order value."""
    return rows.where(F.col(order).isNotNull()), rows.where(F.col(order).isNull())


def _neighbour_rows(
    rows: DataFrame, keys: Sequence[str], order: str, tie: Sequence[str], count: int, following: bool
) -> DataFrame:
    """Copies of the ``count`` rows before (or after) each chunk, labelled with that chunk.

    The rows at the near edge of every chunk are found with a row_number limit, which Spark applies
    before the exchange as well. When chunks are sparse the wanted rows lie in several earlier chunks;
    ``reach`` lists for each chunk the (at most ``count``) chunks that its edge rows can serve.
    """
    group = [*keys, CHUNK]
    nearest = Window.partitionBy(*group).orderBy(*_order(order, tie, descending=not following))
    edge = rows.withColumn("_rank", F.row_number().over(nearest)).where(F.col("_rank") <= count)

    along = _series_window(keys, descending=following)
    sizes = edge.groupBy(*group).agg(F.count(F.lit(1)).alias("_size"))
    passed = sizes.withColumn(
        "_passed", F.sum("_size").over(along.rowsBetween(Window.unboundedPreceding, 0))
    )
    reach = (
        passed.withColumn(
            "_targets",
            F.collect_list(
                F.struct(F.col(CHUNK).alias("chunk"), (F.col("_passed") - F.col("_size")).alias("before"))
            ).over(along.rowsBetween(1, count)),
        )
        .select(*group, "_passed", F.explode("_targets").alias("_target"))
        .select(
            *group,
            F.col("_target.chunk").alias("_serves"),
            (F.col("_target.before") - F.col("_passed")).alias("_gap"),
        )
        .where(F.col("_gap") < count)
    )
    return (
        join_keys(edge, reach, group)
        .where(F.col("_rank") + F.col("_gap") <= count)
        .drop(CHUNK, "_rank", "_gap")
        .withColumnRenamed("_serves", CHUNK)
    )


def with_halo(
    df: DataFrame,
    lookback: int = 0,
    lookahead: int = 0,
    keys: Sequence[str] = ("symbol",),
    order: str = "datetime",
    tie: Sequence[str] = (),
    carry: Sequence[str] | None = None,
    chunk_seconds: int = DEFAULT_CHUNK,
) -> DataFrame:
    """Chunked rows plus the neighbouring rows that bounded frames reach into.

    ``carry`` names the columns the frames read; other columns are NULL in the copies, so that their
    scan stays narrow. Follow with windows over ``chunk_window`` and then ``drop_halo``.
    """
    own = chunked(df, order, chunk_seconds)
    needed = list(dict.fromkeys([*keys, order, *tie, *(df.columns if carry is None else carry), CHUNK]))
    narrow = own.where(F.col(order).isNotNull()).select(*needed)
    result = own.withColumn(HALO, F.lit(False))
    for count, following in ((lookback, False), (lookahead, True)):
        if count:
            copies = _neighbour_rows(narrow, keys, order, tie, count, following)
            result = result.unionByName(copies.withColumn(HALO, F.lit(True)), allowMissingColumns=True)
    return result


def drop_halo(df: DataFrame) -> DataFrame:
    return df.where(~F.col(HALO)).drop(HALO, CHUNK)


def _chunk_prefix(summary: DataFrame, keys: Sequence[str], total: str, before: str) -> DataFrame:
    """Sum of ``total`` over all earlier chunks of the series."""
    earlier = _series_window(keys).rowsBetween(Window.unboundedPreceding, -1)
    return summary.withColumn(before, F.coalesce(F.sum(total).over(earlier), F.lit(0)))


def running_sum(
    df: DataFrame,
    value: str,
    into: str,
    keys: Sequence[str] = ("symbol",),
    order: str = "datetime",
    tie: Sequence[str] = (),
    chunk_seconds: int = DEFAULT_CHUNK,
) -> DataFrame:
    """Inclusive running sum along each series."""
    group = [*keys, CHUNK]
    rows, placeless = _placed(chunked(df, order, chunk_seconds), order)
    totals = rows.groupBy(*group).agg(F.sum(value).alias("_total"))
    before = _chunk_prefix(totals, keys, "_total", "_before").select(*group, "_before")
    frame = chunk_window(keys, order, tie).rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumn("_inside", F.sum(value).over(frame))
    summed = (
        join_keys(inside, before, group)
        .withColumn(into, F.col("_inside") + F.col("_before"))
        .drop("_inside", "_before", CHUNK)
    )
    return summed.unionByName(placeless.drop(CHUNK), allowMissingColumns=True)


def row_index(
    df: DataFrame,
    keys: Sequence[str] = ("symbol",),
    order: str = "datetime",
    tie: Sequence[str] = (),
    chunk_seconds: int = DEFAULT_CHUNK,
    index: str = "_index",
    size: str = "_series_rows",
) -> DataFrame:
    """Zero-based position of every row in its series, and the length of the series."""
    group = [*keys, CHUNK]
    rows, placeless = _placed(chunked(df, order, chunk_seconds), order)
    counts = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_count"))
    whole = Window.partitionBy(*keys)
    offsets = (
        _chunk_prefix(counts, keys, "_count", "_before")
        .withColumn(size, F.sum("_count").over(whole))
        .select(*group, "_before", size)
    )
    inside = rows.withColumn("_inside", F.row_number().over(chunk_window(keys, order, tie)))
    indexed = (
        join_keys(inside, offsets, group)
        .withColumn(index, F.col("_before") + F.col("_inside") - 1)
        .drop("_before", "_inside", CHUNK)
    )
    return indexed.unionByName(placeless.drop(CHUNK), allowMissingColumns=True)


def fill(
    df: DataFrame,
    columns: Sequence[str],
    forward: bool = True,
    keys: Sequence[str] = ("symbol",),
    order: str = "datetime",
    tie: Sequence[str] = (),
    chunk_seconds: int = DEFAULT_CHUNK,
) -> DataFrame:
    """Replace nulls by the last (or next) non-null value of the series, over any distance."""
    group = [*keys, CHUNK]
    rows, placeless = _placed(chunked(df, order, chunk_seconds), order)
    position = F.struct(*[F.col(c) for c in (order, *tie)])
    pick = F.max_by if forward else F.min_by
    edges = rows.groupBy(*group).agg(
        *[
            pick(F.col(c), F.when(F.col(c).isNotNull(), position)).alias(f"_edge_{c}")
            for c in columns
        ]
    )
    across = _series_window(keys, descending=not forward).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        *group,
        *[F.last(f"_edge_{c}", ignorenulls=True).over(across).alias(f"_carried_{c}") for c in columns],
    )
    # a backward fill reads the reversed order: frames that end at the last row cost a pass per row
    base = Window.partitionBy(*group).orderBy(*_order(order, tie, descending=not forward))
    so_far = base.rowsBetween(Window.unboundedPreceding, 0)
    inside = {c: F.last(c, True).over(so_far) for c in columns}
    local = rows.withColumns({f"_local_{c}": e for c, e in inside.items()})
    filled = join_keys(local, carried, group).select(
        *[
            F.coalesce(f"_local_{c}", f"_carried_{c}").alias(c) if c in columns else F.col(c)
            for c in df.columns
            if c != CHUNK
        ]
    )
    return filled.unionByName(placeless.drop(CHUNK))
