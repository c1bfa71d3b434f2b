"""Rates, latency statistics and conditions over time for service metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltide.functions.clock import epoch_seconds, floor_time, plus_seconds, seconds_between
from voltide.operators.distribution import pick_quantiles, ranked_values
from voltide.operators.series import CHUNK, DAY, HALO, chunk_window, drop_halo, running_sum, sliced, with_halo
from voltide.session import stage

# Histogram bounds of the latency metric in seconds.
LATENCY_BOUNDS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0]
INF = float("inf")


def window_start(at: str, seconds: int) -> Column:
    return floor_time(F.col(at), seconds).alias("window_start")


# ---- rates ---------------------------------------------------------------------------------------


def error_rate(df: DataFrame, at: str = "timestamp", seconds: int = 300) -> DataFrame:
    return df.groupBy(window_start(at, seconds)).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if("is_error").alias("errors"),
        F.try_divide(F.count_if("is_error"), F.count(F.lit(1))).alias("error_rate"),
    )


def request_rate(
    df: DataFrame, at: str = "timestamp", seconds: int = 600, slide: int = 60
) -> DataFrame:
    """Requests per second in sliding windows.

    Rows are counted per slide first; only these counts are copied into the windows that cover them.
    """
    slides = df.groupBy(floor_time(F.col(at), slide).alias("_slide")).agg(F.count(F.lit(1)).alias("_n"))
    back = F.explode(F.sequence(F.lit(0), F.lit(seconds - slide), F.lit(slide))).alias("_back")
    spread = slides.select("_slide", "_n", back)
    start = plus_seconds(F.col("_slide"), -F.col("_back")).alias("window_start")
    return spread.groupBy(start).agg(
        F.sum("_n").alias("requests"), (F.sum("_n") / F.lit(float(seconds))).alias("rate")
    )


def low_rate(
    df: DataFrame, at: str = "timestamp", seconds: int = 600, threshold: float = 0.01
) -> DataFrame:
    """Windows whose request rate is below the threshold, windows without any request included.

    The rows are counted once; the spine of windows is expanded per day, so it is bounded by the time span.
    """
    counts = stage(df.groupBy(window_start(at, seconds)).agg(F.count(F.lit(1)).alias("requests")), "counts")
    bounds = counts.agg(
        F.min(epoch_seconds(F.col("window_start"))).alias("low"),
        F.max(epoch_seconds(F.col("window_start"))).alias("high"),
        F.min("window_start").alias("origin"),
    )
    days = bounds.select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("high") - F.col("low"), F.lit(DAY))).alias("day")
    )
    last = F.least(F.col("day") + DAY - seconds, F.col("high") - F.col("low"))
    spine = days.select("origin", F.explode(F.sequence(F.col("day"), last, F.lit(seconds))).alias("offset"))
    spine = spine.select(plus_seconds(F.col("origin"), F.col("offset")).alias("window_start"))
    requests = F.coalesce("requests", F.lit(0).cast("long"))
    return (
        spine.join(counts, "window_start", "left")
        .select("window_start", requests.alias("requests"), (requests / F.lit(float(seconds))).alias("rate"))
        .where(F.col("rate") < threshold)
    )


def counter_rate(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = ("series",),
    at: str = "timestamp",
    tie: Sequence[str] = ("id",),
    seconds: int = 300,
) -> DataFrame:
    """Per-second increase of a cumulative counter per series and window.

    A smaller value than before is a reset and counts in full; the first sample of a series adds nothing;
    nothing is extrapolated to the window edges. Samples are cut by range, as a burst may fill any window.
    """
    samples = sliced(df.select(*keys, at, *tie, value), keys, at, tie)
    rows = with_halo(samples, lookback=1, keys=keys, order=at, tie=tie)
    before = F.lag(value, 1).over(chunk_window(keys, at, tie))
    step = F.when(F.col(value) >= before, F.col(value) - before).when(before.isNotNull(), F.col(value))
    stepped = drop_halo(rows.withColumn("_step", F.coalesce(step, F.lit(0))))
    return stepped.groupBy(*keys, window_start(at, seconds)).agg(
        F.sum("_step").cast("double").alias("increase"),
        (F.sum("_step") / F.lit(float(seconds))).alias("rate"),
    )


# ---- latency -------------------------------------------------------------------------------------


def latency_avg(df: DataFrame, at: str = "timestamp", seconds: int = 300) -> DataFrame:
    return df.groupBy(window_start(at, seconds)).agg(
        F.count("latency_ms").alias("requests"), F.avg("latency_ms").alias("avg_latency_ms")
    )


def latency_quantiles(df: DataFrame, at: str = "timestamp", seconds: int = 300) -> DataFrame:
    """Mean and exact 95th and 99th percentile per window."""
    ranked = ranked_values(
        df.select(window_start(at, seconds), "latency_ms"), ["window_start"], "latency_ms"
    )
    mean = F.sum(F.col("latency_ms") * F.col("n")) / F.sum("n")
    return ranked.groupBy("window_start").agg(
        mean.alias("avg_latency_ms"), *pick_quantiles({"p95": 0.95, "p99": 0.99}, "latency_ms")
    )


def latency_histogram(
    df: DataFrame,
    keys: Sequence[Column] = (),
    bounds: Sequence[float] = tuple(LATENCY_BOUNDS),
    latency_ms: str = "latency_ms",
) -> DataFrame:
    """Cumulative counts per upper bound in seconds, the infinite one last; one aggregation."""
    value = F.col(latency_ms) / F.lit(1000.0)
    counts = [F.count_if(value <= b).alias(f"c{i}") for i, b in enumerate(bounds)]
    wide = df.groupBy(*keys).agg(*counts, F.count(value).alias("c_all"))
    cells = [
        F.struct(F.lit(float(b)).alias("le"), F.col(f"c{i}").alias("cumulative")) for i, b in enumerate(bounds)
    ]
    cells.append(F.struct(F.lit(INF).alias("le"), F.col("c_all").alias("cumulative")))
    names = [c for c in wide.columns if not c.startswith("c")] if keys else []
    return wide.select(*names, F.inline(F.array(*cells)))


def histogram_quantile(histogram: DataFrame, phi: float, keys: Sequence[str] = ()) -> DataFrame:
    """Quantile by linear interpolation inside the bucket that holds it.

    A group has one row per bound, a fixed small number. In the infinite bucket the answer is the highest
    finite bound; an empty histogram has none.
    """
    along = Window.partitionBy(*keys).orderBy("le") if keys else Window.orderBy("le")
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy()
    cells = histogram.withColumns(
        {
            "_low": F.coalesce(F.lag("le").over(along), F.lit(0.0)),
            "_below": F.coalesce(F.lag("cumulative").over(along), F.lit(0)),
            "_rank": F.max("cumulative").over(whole) * F.lit(phi),
        }
    )
    inside = F.try_divide(F.col("_rank") - F.col("_below"), F.col("cumulative") - F.col("_below"))
    answer = F.when(F.col("le") == INF, F.col("_low")).otherwise(
        F.col("_low") + (F.col("le") - F.col("_low")) * inside
    )
    reached = cells.where((F.col("cumulative") >= F.col("_rank")) & (F.col("_rank") > 0))
    return reached.groupBy(*keys).agg(F.min_by(answer, "le").alias("quantile"))


def bucket_quantiles(
    df: DataFrame,
    phi: float,
    value: str = "cumulative",
    keys: Sequence[str] = ("series",),
    by: Sequence[str] = (),
    at: str = "timestamp",
    tie: Sequence[str] = ("id",),
    seconds: int = 300,
) -> DataFrame:
    """Quantile per window from samples of bucket counters: one row per series, bound ``le`` and scrape.

    Every bucket is a counter of its own, which may start again alone; its increases are added up over series (but for
    ``by``). A bucket that then lies below a smaller bound takes that bound's count, and the quantile is interpolated. Only the
    increases look at neighbouring samples, in range slices; what follows has one row per window and bound.
    """
    increases = counter_rate(df, value, [*keys, "le"], at, tie, seconds)
    summed = increases.groupBy(*by, "window_start", "le").agg(F.sum("increase").alias("increase"))
    upwards = Window.partitionBy(*by, "window_start").orderBy("le")
    repaired = summed.select(*by, "window_start", "le", F.max("increase").over(upwards).alias("cumulative"))
    return histogram_quantile(repaired, phi, [*by, "window_start"])


def slowest(
    df: DataFrame, keys: Sequence[str] = ("series", "model_version"), at: str = "timestamp", k: int = 10
) -> DataFrame:
    """Series with the highest latency per second of observed time."""
    span = seconds_between(F.max(at), F.min(at))
    rates = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("requests"),
        F.try_divide(F.sum("latency_ms") / 1000, span).alias("latency_rate"),
    )
    return rates.orderBy(F.col("latency_rate").desc(), *keys).limit(k)


# ---- conditions over time ------------------------------------------------------------------------


def sustained(
    df: DataFrame,
    condition: Column,
    seconds: int,
    keys: Sequence[str] = ("metric_name",),
    at: str = "ts",
    tie: Sequence[str] = (),
    chunk_seconds: int = DAY,
) -> DataFrame:
    """Stretches in which the condition holds on every sample for at least ``seconds``.

    A stretch gets its number from a running sum of state changes; both steps work per time chunk.
    """
    slices = [CHUNK] if CHUNK in df.columns else []
    marked = df.select(*keys, at, *tie, *slices, F.coalesce(condition, F.lit(False)).alias("_on"))
    rows = with_halo(marked, lookback=1, keys=keys, order=at, tie=tie, chunk_seconds=chunk_seconds)
    before = F.lag("_on", 1).over(chunk_window(keys, at, tie))
    changed = F.coalesce((F.col("_on") != before).cast("int"), F.lit(0))
    changes = rows.withColumn("_changed", changed).where(~F.col(HALO)).drop(HALO)  # keeps the chunk of sliced rows
    islands = running_sum(changes, "_changed", "_island", keys, at, tie, chunk_seconds)
    held = seconds_between(F.col("ended"), F.col("began"))
    return (
        islands.where("_on")
        .groupBy(*keys, "_island")
        .agg(F.min(at).alias("began"), F.max(at).alias("ended"), F.count(F.lit(1)).alias("samples"))
        .withColumn("held_seconds", held)
        .where(F.col("held_seconds") >= seconds)
        .drop("_island")
    )


def service_gaps(
    df: DataFrame,
    seconds: int = 3600,
    keys: Sequence[str] = ("series",),
    at: str = "timestamp",
    chunk_seconds: int = 365 * DAY,
    as_of: object = None,
) -> DataFrame:
    """Times without any row for longer than ``seconds``, with ``is_open`` for those that last until ``as_of``.

    ``as_of`` is the newest time of all series if not given; a series that is silent by then has an open gap.

    A slot of that width cannot hold such a gap inside, so first and last time per slot are enough. They
    are partial aggregates, and what is left has at most one row per slot.
    """
    until = df.agg(F.max(at)).first()[0] if as_of is None else as_of
    slot = F.floor(epoch_seconds(F.col(at)) / F.lit(seconds)).alias("_slot")
    slots = df.groupBy(*keys, slot).agg(F.min(at).alias("_first"), F.max(at).alias("last_seen")).drop("_slot")
    rows = with_halo(slots, lookahead=1, keys=keys, order="last_seen", carry=["_first"], chunk_seconds=chunk_seconds)
    following = F.lead("_first", 1).over(chunk_window(keys, "last_seen"))
    return (
        drop_halo(rows.withColumn("resumed", following))
        .select(*keys, "last_seen", "resumed", F.col("resumed").isNull().alias("is_open"))
        .withColumn("gap_seconds", seconds_between(F.coalesce("resumed", F.lit(until)), F.col("last_seen")))
        .where(F.col("gap_seconds") > seconds)
    )
