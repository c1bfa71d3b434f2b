"""Alert rules, their evaluation over metric rows, alert history and summary."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.functions.clock import plus_seconds, seconds_between
from voltide.functions.numeric import fixed_text, percent_text
from voltide.operators.series import DEFAULT_CHUNK, chunk_window, drop_halo, running_sum, with_halo
from voltide.session import stage


@dataclass(frozen=True)
class Rule:
    """One threshold rule. ``style`` says how value and threshold are written into the message."""

    name: str
    metric_name: str
    threshold: float
    comparison: str
    severity: str
    template: str
    style: str = "number3"
    hold_seconds: int = 0


SEVERITIES = ["info", "warning", "critical"]

# Default rules and their messages.
DEFAULT_RULES = [
    Rule("high_latency", "prediction_latency_seconds", 0.5, "gt", "warning",
         "Prediction latency ({value}s) exceeds threshold ({threshold}s)", "number3"),
    Rule("critical_latency", "prediction_latency_seconds", 1.0, "gt", "critical",
         "CRITICAL: Prediction latency ({value}s) exceeds {threshold}s", "number3"),
    Rule("high_drift", "drift_ratio", 0.2, "gt", "warning",
         "Data drift ratio ({value}) exceeds threshold ({threshold})", "percent2"),
    Rule("critical_drift", "drift_ratio", 0.5, "gt", "critical",
         "CRITICAL: Data drift ratio ({value}) exceeds {threshold}", "percent2"),
    Rule("high_error_rate", "error_rate", 0.05, "gt", "warning",
         "Error rate ({value}) exceeds threshold ({threshold})", "percent2"),
    Rule("model_degradation", "rmse_increase_pct", 0.1, "gt", "warning",
         "Model RMSE increased by {value}, exceeds threshold ({threshold})", "percent1"),
]

# Documented alarm tiers.
TIERED_RULES = [
    Rule("latency_tier_1", "prediction_latency_seconds", 0.3, "gt", "warning",
         "Latency {value}s above {threshold}s", "number3"),
    Rule("latency_tier_2", "prediction_latency_seconds", 0.5, "gt", "critical",
         "Latency {value}s above {threshold}s", "number3"),
    Rule("drift_tier_1", "drift_ratio", 0.15, "gt", "warning", "Drift {value} above {threshold}", "percent2"),
    Rule("drift_tier_2", "drift_ratio", 0.20, "gt", "critical", "Drift {value} above {threshold}", "percent2"),
    Rule("error_tier_1", "error_rate", 0.01, "gt", "warning", "Error rate {value} above {threshold}", "percent2"),
]

# Alarm rules that must hold for a time before they fire.
HELD_RULES = [
    Rule("high_prediction_latency", "prediction_latency_seconds", 0.5, "gt", "warning", "{value}", "number3", 300),
    Rule("critical_prediction_latency", "prediction_latency_seconds", 1.0, "gt", "critical", "{value}", "number3", 120),
    Rule("high_data_drift", "drift_ratio", 0.2, "gt", "warning", "{value}", "percent2", 600),
    Rule("critical_data_drift", "drift_ratio", 0.5, "gt", "critical", "{value}", "percent2", 300),
    Rule("high_error_rate", "error_rate", 0.05, "gt", "warning", "{value}", "percent2", 300),
    Rule("low_prediction_rate", "request_rate", 0.01, "lt", "info", "{value}", "number3", 900),
]

RULE_COLUMNS = (
    "name string, metric_name string, threshold double, comparison string, severity string, "
    "template string, style string, hold_seconds long"
)


_RULED = ["metric_name", "threshold", "comparison"]


def upsert_rule(rules: Sequence[Rule], rule: Rule) -> list[Rule]:
    """A rule with the same name is replaced in place."""
    if any(r.name == rule.name for r in rules):
        return [rule if r.name == rule.name else r for r in rules]
    return [*rules, rule]


def remove_rule(rules: Sequence[Rule], name: str) -> list[Rule]:
    return [r for r in rules if r.name != name]


def rule_table(spark: SparkSession, rules: Sequence[Rule] = tuple(DEFAULT_RULES)) -> DataFrame:
    assert [f.name for f in fields(Rule)] == [c.split()[0] for c in RULE_COLUMNS.split(", ")]
    return spark.createDataFrame([astuple(r) for r in rules], RULE_COLUMNS)


def _text(column: str):
    c, style = F.col(column), F.col("style")
    return (
        F.when(style == "percent2", percent_text(c, 2))
        .when(style == "percent1", percent_text(c, 1))
        .otherwise(fixed_text(c, 3))
    )


def _breaks() -> Column:
    value, limit, how = F.col("value"), F.col("threshold"), F.col("comparison")
    return (
        F.when(how == "gt", value > limit)
        .when(how == "lt", value < limit)
        .when(how == "gte", value >= limit)
        .when(how == "lte", value <= limit)
        .otherwise(F.lit(False))
    )


def broken() -> Column:
    """Whether a metric row breaks the rule beside it; a missing value breaks nothing."""
    return F.coalesce(_breaks(), F.lit(False))


def state_of(fired_at: Column, resolved_at: Column) -> Column:
    fired, over = fired_at.isNotNull(), resolved_at.isNotNull()
    return F.when(fired & over, "resolved").when(fired, "firing").when(over, "cleared").otherwise("pending")


def states(
    metrics: DataFrame,
    rules: Sequence[Rule] = tuple(HELD_RULES),
    chunk_seconds: int = DEFAULT_CHUNK,
    as_of: object = None,
) -> DataFrame:
    """One row per stretch of samples that break a rule, with when it became pending, fired and was resolved.

    A rule fires once it has been broken on every sample for its hold time. With ``as_of``, a time, samples after it are left
    out and each holds until the next one, the last until ``as_of``, so a rule also fires between samples. The sample behind a stretch resolves it; a
    stretch that reaches the last sample is open. States: ``pending`` (open, not yet held), ``firing`` (open, held),
    ``resolved`` (held, over) and ``cleared`` (over before it was held). Stretches are numbered by a running sum of changes per
    time chunk, so no rule's samples are gathered in one task.
    """
    keys, at = ["name"], "ts"
    table = rule_table(metrics.sparkSession, rules).select("name", "severity", "hold_seconds", *_RULED)
    until = None if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    seen = metrics if until is None else metrics.where(F.col(at) <= until)
    marked = seen.join(F.broadcast(table), "metric_name").select(
        "name", "severity", "hold_seconds", at, broken().alias("_on")
    )
    rows = with_halo(
        stage(marked, "ruled"), 1, 1, keys=keys, order=at, carry=["_on"], chunk_seconds=chunk_seconds
    )
    window = chunk_window(keys, at)
    changed = F.coalesce((F.col("_on") != F.lag("_on", 1).over(window)).cast("int"), F.lit(0))
    steps = drop_halo(rows.withColumns({"_changed": changed, "_next": F.lead(at, 1).over(window)}))
    stretches = running_sum(steps, "_changed", "_stretch", keys, at, chunk_seconds=chunk_seconds).where("_on")
    open_end = F.max(F.col("_next").isNull())
    last = F.max(at) if until is None else F.max(F.coalesce("_next", until))
    held = seconds_between(last, F.min(at)) >= F.first("hold_seconds")
    found = stretches.groupBy("name", "severity", "_stretch").agg(
        F.min(at).alias("pending_at"),
        F.when(held, plus_seconds(F.min(at), F.first("hold_seconds"))).alias("fired_at"),
        F.when(~open_end, F.max("_next")).alias("resolved_at"),
        F.count(F.lit(1)).alias("samples"),
    )
    return found.withColumn("state", state_of(F.col("fired_at"), F.col("resolved_at"))).drop("_stretch")


def evaluate(metrics: DataFrame, rules: Sequence[Rule] = tuple(DEFAULT_RULES)) -> DataFrame:
    """Every rule that a metric row breaks. The rules are a driver-side list, so their table is broadcast."""
    table = rule_table(metrics.sparkSession, rules)
    message = F.replace(
        F.replace(F.col("template"), F.lit("{value}"), _text("value")),
        F.lit("{threshold}"),
        _text("threshold"),
    )
    return (
        metrics.join(F.broadcast(table), "metric_name")
        .where(_breaks())
        .select(
            "ts",
            "name",
            "severity",
            "metric_name",
            F.col("value").alias("metric_value"),
            "threshold",
            message.alias("message"),
        )
    )


def history(alerts: DataFrame, severity: str | None = None, limit: int = 100) -> DataFrame:
    """Last alerts in time order, optionally of one severity."""
    chosen = alerts if severity is None else alerts.where(F.col("severity") == severity)
    return chosen.orderBy(F.col("ts").desc(), F.col("name").desc()).limit(limit).orderBy("ts", "name")


def summary(alerts: DataFrame) -> DataFrame:
    """Counts in total, per severity (all three always) and per metric (those present)."""
    spark = alerts.sparkSession
    zeros = spark.createDataFrame([(s, None, 0) for s in SEVERITIES], "severity string, metric_name string, c long")
    rows = alerts.select("severity", "metric_name", F.lit(1).cast("long").alias("c")).unionByName(zeros)
    grouped = rows.groupingSets([[], ["severity"], ["metric_name"]], "severity", "metric_name").agg(
        F.grouping_id().alias("g"), F.sum("c").alias("count")
    )
    scope = F.when(F.col("g") == 3, "total").when(F.col("g") == 1, "severity").otherwise("metric")
    return (
        grouped.withColumn("scope", scope)
        .where((F.col("scope") != "metric") | F.col("metric_name").isNotNull())
        .select("scope", F.coalesce("severity", "metric_name", F.lit("all")).alias("label"), "count")
    )
