"""Chunked windows must equal plain windows over the whole series."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tests.helpers import assert_same, bars, collected, walk
from voltide.operators import features, series

HOUR = 3600


def plain():
    return Window.partitionBy("symbol").orderBy("datetime")


@pytest.fixture(scope="module")
def gappy(spark):
    frames = [
        walk(400, 1, "A", gaps=0.3),
        walk(60, 2, "B", gaps=0.9),
        walk(30, 3, "C"),
        walk(1, 4, "D"),
    ]
    # two bars far away, so that halo rows come from chunks long before
    frames.append(walk(2, 5, "A", start="2027-03-01"))
    frame = pd.concat(frames)
    frame.loc[frame.index % 13 == 5, "close"] = None
    return bars(spark, frame).cache()


@pytest.mark.parametrize("chunk", [HOUR, 5 * HOUR, 24 * HOUR, 30 * 24 * HOUR])
def test_bounded_frames(gappy, chunk):
    rows = series.with_halo(gappy, lookback=24, lookahead=2, carry=["close"], chunk_seconds=chunk)
    w = series.chunk_window()

    def columns(spec):
        return {
            "l1": F.lag("close", 1).over(spec),
            "l24": F.lag("close", 24).over(spec),
            "f2": F.lead("close", 2).over(spec),
            "s": F.sum("close").over(spec.rowsBetween(-24, 2)),
        }

    got = series.drop_halo(rows.withColumns(columns(w)))
    assert_same(collected(got), collected(gappy.withColumns(columns(plain()))))


@pytest.mark.parametrize("chunk", [HOUR, 24 * HOUR])
def test_feature_frame_does_not_depend_on_chunks(gappy, chunk):
    small = features.feature_frame(gappy, chunk_seconds=chunk)
    whole = features.feature_frame(gappy, chunk_seconds=100 * 365 * 24 * HOUR)
    assert_same(collected(small), collected(whole))


@pytest.mark.parametrize("chunk", [HOUR, 24 * HOUR])
@pytest.mark.parametrize("forward", [True, False])
def test_fill(gappy, chunk, forward):
    got = series.fill(gappy, ["close"], forward, chunk_seconds=chunk)
    if forward:
        expected = F.last("close", True).over(plain().rowsBetween(Window.unboundedPreceding, 0))
    else:
        expected = F.first("close", True).over(plain().rowsBetween(0, Window.unboundedFollowing))
    assert_same(collected(got), collected(gappy.withColumn("close", expected)))


@pytest.mark.parametrize("chunk", [HOUR, 24 * HOUR])
def test_running_sum_and_row_index(gappy, chunk):
    source = gappy.withColumn("one", F.hour("datetime"))
    total = F.sum("one").over(plain().rowsBetween(Window.unboundedPreceding, 0))
    got = series.running_sum(source, "one", "total", chunk_seconds=chunk)
    assert_same(collected(got), collected(source.withColumn("total", total)))
    indexed = series.row_index(gappy, chunk_seconds=chunk)
    expected = gappy.withColumn("_index", F.row_number().over(plain()) - 1).withColumn(
        "_series_rows", F.count(F.lit(1)).over(Window.partitionBy("symbol"))
    )
    assert_same(collected(indexed), collected(expected))


def test_slices_by_range(spark, gappy):
    """Range slices instead of time chunks give the same frames, fills, sums and positions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = series.sliced(gappy, ["symbol"], "datetime")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert cut.where("symbol = 'A'").select(series.CHUNK).distinct().count() > 2
    lagged = series.with_halo(cut, lookback=24).withColumn("l24", F.lag("close", 24).over(series.chunk_window()))
    assert_same(
        collected(series.drop_halo(lagged)), collected(gappy.withColumn("l24", F.lag("close", 24).over(plain())))
    )
    assert_same(collected(series.fill(cut, ["close"])), collected(series.fill(gappy, ["close"])))
    assert_same(collected(series.row_index(cut)), collected(series.row_index(gappy)))


def test_one_long_series_is_spread_over_tasks(spark):
    """A single symbol must not end up in one window partition."""
    long = bars(spark, walk(3000)).coalesce(1)
    rows = series.with_halo(long, lookback=24, chunk_seconds=5 * 24 * HOUR)
    assert rows.select("symbol", series.CHUNK).distinct().count() >= 25
    biggest = rows.groupBy("symbol", series.CHUNK).count().agg(F.max("count")).first()[0]
    assert biggest <= 5 * 24 + 24


def test_empty_input(spark):
    empty = bars(spark, walk(1)).limit(0)
    assert features.feature_frame(empty).count() == 0
    assert series.fill(empty, ["close"]).count() == 0
