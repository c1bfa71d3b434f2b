"""Distribution drift between a reference and a current sample, and drift of single rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltide import schema as S
from voltide.operators.distribution import SLICE, long_form, pick_quantiles, ranked_values, sum_before
from voltide.operators.series import fill, sliced
from voltide.session import stage

STATS = ["mean", "std", "min", "max", "median", "q1", "q3"]


def reference_stats(reference: DataFrame) -> DataFrame:
    """Per feature of a long (feature, value) sample: moments, extremes and exact quartiles.

    Moments come from the ranked counts as well, so the sample is read once. The deviation is centred
    on the mean before squaring.
    """
    ranked = ranked_values(reference, ["feature"], "value")
    first = ranked.groupBy("feature").agg(
        F.sum("n").alias("_rows"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        *pick_quantiles({"q1": 0.25, "median": 0.5, "q3": 0.75}, "value"),
    )
    squares = (
        ranked.join(first.select("feature", "mean"), "feature")
        .groupBy("feature")
        .agg(F.sum(F.col("n") * (F.col("value") - F.col("mean")) ** 2).alias("_squares"))
    )
    return first.join(squares, "feature").select(
        "feature",
        "mean",
        F.sqrt(F.try_divide(F.col("_squares"), F.col("_rows") - 1)).alias("std"),
        "min",
        "max",
        "median",
        "q1",
        "q3",
    )


def ks_p_value(statistic: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value: the alternating Kolmogorov series, clipped to [0, 1]."""
    scaled = statistic * F.sqrt(n * m / (n + m))

    def term(total: Column, j: Column) -> Column:
        sign = F.when(j % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0))
        return total + sign * F.exp(F.lit(-2.0) * j * j * scaled * scaled)

    series = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), term)
    clipped = F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0))
    return F.when(scaled < 0.2, F.lit(1.0)).otherwise(clipped)


def compare(reference: DataFrame, current: DataFrame) -> DataFrame:
    """KS statistic, Wasserstein distance and sample sizes per feature of two long samples."""
    return compare_sides(
        reference.select("feature", "value", F.lit(True).alias("is_ref")).unionByName(
            current.select("feature", "value", F.lit(False).alias("is_ref"))
        )
    )


def compare_sides(sides: DataFrame) -> DataFrame:
    """``compare`` for one long frame with a flag ``is_ref``.

    Both distances come from one pass over the merged distinct values.
    """
    counts = {"ref": F.count_if("is_ref"), "cur": F.count_if(~F.col("is_ref"))}
    ranked = ranked_values(sides, ["feature"], "value", counts)
    gap = F.abs(
        F.try_divide(F.col("cum_ref"), F.col("total_ref")) - F.try_divide(F.col("cum_cur"), F.col("total_cur"))
    )
    return ranked.groupBy("feature").agg(
        F.max(gap).alias("statistic"),
        F.coalesce(F.sum(gap * (F.col("next_value") - F.col("value"))), F.lit(0.0)).alias("wasserstein"),
        F.max("total_ref").alias("n_ref"),
        F.max("total_cur").alias("n_cur"),
    )


def ks_tested(compared: DataFrame, alpha: float = S.KS_ALPHA) -> DataFrame:
    """KS verdict for features with a reference and at least the minimum of current values."""
    p = ks_p_value(F.col("statistic"), F.col("n_ref").cast("double"), F.col("n_cur").cast("double"))
    return (
        compared.where((F.col("n_ref") > 0) & (F.col("n_cur") >= S.KS_MIN_CURRENT))
        .withColumn("p_value", p)
        .withColumn("is_drift", F.col("p_value") < alpha)
    )


def ks_drift(reference: DataFrame, current: DataFrame, alpha: float = S.KS_ALPHA) -> DataFrame:
    return ks_tested(compare(reference, current), alpha).select(
        F.col("feature").alias("feature_name"),
        "is_drift",
        "p_value",
        F.col("statistic").alias("test_statistic"),
        F.lit("kolmogorov_smirnov").alias("test_type"),
    )


def wasserstein(reference: DataFrame, current: DataFrame) -> DataFrame:
    compared = compare(reference, current)
    present = compared.where((F.col("n_ref") > 0) & (F.col("n_cur") > 0))
    return present.select("feature", F.col("wasserstein").alias("distance"))


def summarise(compared: DataFrame, keys: Sequence[str] = (), alpha: float = S.KS_ALPHA) -> DataFrame:
    """Drift metrics over compared features; zeros where nothing could be compared."""
    p = ks_p_value(F.col("statistic"), F.col("n_ref").cast("double"), F.col("n_cur").cast("double"))
    both = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    tested = (F.col("n_ref") > 0) & (F.col("n_cur") >= S.KS_MIN_CURRENT)
    drifted = F.count_if(tested & (p < alpha))
    zero = F.lit(0.0)
    return compared.groupBy(*keys).agg(
        F.coalesce(F.try_divide(drifted, F.count_if(tested)), zero).alias("drift_ratio"),
        drifted.alias("num_drifted_features"),
        F.count_if(tested).alias("total_features"),
        F.coalesce(F.avg(F.when(both, F.col("wasserstein"))), zero).alias("avg_wasserstein_distance"),
        F.coalesce(F.max(F.when(both, F.col("wasserstein"))), zero).alias("max_wasserstein_distance"),
    )


def drift_metrics(reference: DataFrame, current: DataFrame, alpha: float = S.KS_ALPHA) -> DataFrame:
    return summarise(compare(reference, current), alpha=alpha)


BLOCK = 128


@dataclass(frozen=True)
class RankedReference:
    """A reference sample ranked once: its distinct values in blocks, and one row per feature.

    A block holds at most ``BLOCK`` neighbouring values of a feature with the distribution up to and below each, and the area
    under the distribution up to it. A lookup finds its block among the blocks' bounds and its place inside the block, so the
    reference is neither ranked nor sorted again, however many samples are compared with it.
    """

    blocks: DataFrame
    totals: DataFrame

    def save(self, path: str) -> None:
        self.blocks.write.parquet(f"{path}/blocks")
        self.totals.write.parquet(f"{path}/totals")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> RankedReference:
        return cls(spark.read.parquet(f"{path}/blocks"), spark.read.parquet(f"{path}/totals"))


def rank_reference(reference: DataFrame) -> RankedReference:
    """Rank long (feature, value) rows; null and NaN values are left out."""
    known = ranked_values(reference, ["feature"], "value", {"ref": F.count(F.lit(1))}, keep_slice=True)
    height = F.col("cum_ref") / F.col("total_ref")
    step = F.coalesce(height * (F.col("next_value") - F.col("value")), F.lit(0.0))
    known = sum_before(known.withColumn("_step", step), ["feature"], "value", "_step", "area")
    place = F.row_number().over(Window.partitionBy("feature", SLICE).orderBy("value")) - 1
    block = F.shiftleft(F.col(SLICE).cast("long"), 32) + F.floor(place / BLOCK)
    rows = known.select(
        "feature",
        block.alias("block"),
        "value",
        "area",
        height.alias("upto"),
        ((F.col("cum_ref") - F.col("ref")) / F.col("total_ref")).alias("below"),
        F.col("cum_ref").alias("rank"),
        "total_ref",
    )
    rows = stage(rows, "ranked-reference")
    item = F.struct("value", "area", "upto", "below", "rank")
    blocks = rows.groupBy("feature", "block").agg(
        F.min("value").alias("first_value"),
        F.max("rank").alias("last_rank"),
        F.sort_array(F.collect_list(item)).alias("items"),
    )
    totals = rows.groupBy("feature").agg(
        F.max("total_ref").alias("total_ref"), F.max(F.struct("value", "area")).alias("_end")
    )
    return RankedReference(stage(blocks, "reference-blocks"), stage(totals, "reference-totals"))


def _in_blocks(ranked: RankedReference, asked: DataFrame, of: str, bound: str, forward: bool) -> DataFrame:
    """The asked (feature, ``of``) rows with the items of their block; null before the first or behind the last block."""
    marks = ranked.blocks.select("feature", F.col(bound).alias(of), F.lit(int(not forward)).alias("_kind"), "block")
    rows = asked.select("feature", of, F.lit(int(forward)).alias("_kind"))
    axis = sliced(marks.unionByName(rows, allowMissingColumns=True), ["feature"], of, ["_kind"])
    filled = fill(axis, ["block"], forward=forward, keys=["feature"], order=of, tie=["_kind"])
    wanted = filled.where(F.col("_kind") == int(forward)).drop("_kind")
    return wanted.join(ranked.blocks.select("feature", "block", "items"), ["feature", "block"], "left")


def _reference_at(ranked: RankedReference, asked: DataFrame) -> DataFrame:
    """(feature, value, area, upto, below, total_ref) of the reference at the asked values of its features."""
    held = _in_blocks(ranked, asked.join(ranked.totals, "feature", "left_semi"), "value", "first_value", True)
    last = F.try_element_at(F.filter("items", lambda item: item["value"] <= F.col("value")), F.lit(-1))
    at = held.withColumn("_at", last)
    zero, here = F.lit(0.0), F.col("_at")
    beyond = here["upto"] * (F.col("value") - here["value"])
    found = at.select(
        "feature",
        "value",
        F.coalesce(here["area"] + beyond, zero).alias("area"),
        F.coalesce(here["upto"], zero).alias("upto"),
        F.coalesce(F.when(here["value"] == F.col("value"), here["below"]).otherwise(here["upto"]), zero).alias("below"),
    )
    return found.join(ranked.totals.select("feature", "total_ref"), "feature")


def _value_at_rank(ranked: RankedReference, wanted: DataFrame) -> DataFrame:
    """The first reference value whose cumulative count reaches each wanted rank, and the area up to it."""
    held = _in_blocks(ranked, wanted, "rank", "last_rank", False)
    first = F.get(F.filter("items", lambda item: item["rank"] >= F.col("rank")), F.lit(0))
    at = held.withColumn("_at", first)
    return at.select("feature", "rank", F.col("_at.value").alias("at"), F.col("_at.area").alias("at_area"))


def compare_points(ranked: RankedReference, points: DataFrame, window: str = "window_start") -> DataFrame:
    """``compare`` of every window with one fixed reference, from the windows' ranked values.

    ``points`` is what ``ranked_values`` gives for the keys (window, feature). Between two neighbouring values of a
    window its distribution is a constant b, so the largest gap is at the ends of that stretch, and the
    area between it and the rising reference follows from the integral of the reference up to both ends
    and up to the value where the reference passes b, which is looked up by its rank.
    """
    points = stage(points, "window-points")
    level = F.col("cum_n") / F.col("total_n")
    here = stage(_reference_at(ranked, points.select("feature", "value").distinct()), "reference-at")
    there = here.select(
        "feature", F.col("value").alias("next_value"), F.col("area").alias("next_area"), F.col("below").alias("next_below")
    )
    stretches = (
        points.join(here, ["feature", "value"])
        .join(there, ["feature", "next_value"], "left")
        .withColumn("level", level)
        # smallest reference rank that reaches the level; counts are multiplied as decimals
        .withColumn("rank", _ceil_share("cum_n", "total_ref", "total_n"))
    )
    stretches = stage(stretches, "stretches")
    crossing = (F.col("upto") < F.col("level")) & (F.col("next_below") > F.col("level"))
    wanted = stretches.where(crossing).select("feature", "rank").distinct()
    passed = _value_at_rank(ranked, wanted)
    area = F.col("next_area") - F.col("area")
    width = F.col("next_value") - F.col("value")
    rest = F.col("next_area") - F.col("at_area") - F.col("level") * (F.col("next_value") - F.col("at"))
    before = F.col("level") * (F.col("at") - F.col("value")) - (F.col("at_area") - F.col("area"))
    between = F.when(crossing, before + rest).otherwise(F.abs(area - F.col("level") * width))
    per_window = (
        stretches.join(passed, ["feature", "rank"], "left")
        .groupBy(window, "feature")
        .agg(
            F.max(
                F.greatest(
                    F.abs(F.col("upto") - F.col("level")),
                    F.abs(F.col("next_below") - F.col("level")),
                    F.when(F.col("cum_n") == F.col("n"), F.col("below")),
                )
            ).alias("statistic"),
            F.sum(F.when(F.col("next_value").isNotNull(), between)).alias("_inner"),
            F.min(F.struct("value", "area")).alias("_low"),
            F.max(F.struct("value", "area")).alias("_high"),
            F.max("total_ref").alias("n_ref"),
            F.max("total_n").alias("n_cur"),
        )
    )
    past = F.col("_end.value") - F.col("_high.value")
    after = F.when(past > 0, past - (F.col("_end.area") - F.col("_high.area"))).otherwise(F.lit(0.0))
    return per_window.join(ranked.totals.select("feature", "_end"), "feature").select(
        window,
        "feature",
        "statistic",
        (F.col("_low.area") + F.coalesce("_inner", F.lit(0.0)) + after).alias("wasserstein"),
        "n_ref",
        "n_cur",
    )


def compare_windows(reference: DataFrame, current: DataFrame, window: str = "window_start") -> DataFrame:
    """``compare`` of every window of a long current sample with one fixed reference, which is ranked once."""
    points = ranked_values(current.select("feature", "value", window), [window, "feature"], "value")
    return compare_points(rank_reference(reference), points, window)


def _ceil_share(part: str, whole: str, of: str) -> Column:
    product = F.col(part).cast("decimal(19,0)") * F.col(whole).cast("decimal(19,0)")
    return F.ceil(product / F.col(of).cast("decimal(19,0)")).cast("long")


def drift_by_window(
    reference: DataFrame, current: DataFrame, window: str = "window_start", alpha: float = S.KS_ALPHA
) -> DataFrame:
    """Drift metrics of each window of the current sample against the fixed reference."""
    return summarise(compare_windows(reference, current, window), [window], alpha)


def train_test_drift(split: DataFrame, features: Sequence[str], alpha: float = S.KS_ALPHA) -> DataFrame:
    """Drift of all features between the train and test rows; untested features stay in the denominator."""
    long = long_form(split, features, ids=["split"])
    sides = long.select("feature", "value", (F.col("split") == "train").alias("is_ref"))
    tested = ks_tested(compare_sides(sides), alpha)
    drifted = F.count_if("is_drift")
    return tested.agg(
        (drifted / F.lit(len(features))).alias("drift_ratio"),
        drifted.alias("num_drifted_features"),
        F.lit(len(features)).cast("long").alias("total_features"),
    )


# ---- fitted detector ------------------------------------------------------------------------------


@dataclass(frozen=True)
class DriftProfile:
    """Reference statistics of a sample: one small record per feature column."""

    stats: Mapping[str, Mapping[str, float]]
    z_threshold: float = S.POINT_Z
    ratio_threshold: float = S.POINT_DRIFT_RATIO

    def statistics(self, feature: str) -> Mapping[str, float] | None:
        return self.stats.get(feature)

    def point_drift(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Score a map column row by row: share and names of features far from the reference mean."""
        if not self.stats:
            raise ValueError("fit the profile on reference data first")
        known = F.create_map(
            *[
                part
                for name, s in sorted(self.stats.items())
                for part in (
                    F.lit(name),
                    F.struct(
                        F.lit(s["mean"]).cast("double").alias("mean"),
                        F.lit(s["std"]).cast("double").alias("std"),
                    ),
                )
            ]
        )
        entries = F.filter(
            F.map_entries(features), lambda e: F.try_element_at(known, e["key"]).isNotNull()
        )

        def far(e: Column) -> Column:
            s = F.try_element_at(known, e["key"])
            z = F.abs(F.try_divide(e["value"] - s["mean"], s["std"]))
            return F.coalesce((s["std"] > 0) & (z > self.z_threshold), F.lit(False))

        names = F.array_sort(F.transform(F.filter(entries, far), lambda e: e["key"]))
        ratio = F.coalesce(F.try_divide(F.size(names), F.size(entries)), F.lit(0.0))
        return df.withColumns(
            {
                "drifted_features": names,
                "point_drift_ratio": ratio,
                "point_drift_detected": ratio > self.ratio_threshold,
            }
        )


def fit_profile(reference: DataFrame, **thresholds: float) -> DriftProfile:
    """Fit on a long (feature, value) sample; one row per feature reaches the driver."""
    rows = reference_stats(reference).collect()
    return DriftProfile({r["feature"]: {k: r[k] for k in STATS} for r in rows}, **thresholds)
