"""Alert lifecycle on a stream: pending, firing, resolved or cleared, across triggers.

State is kept per rule. Samples wait in it until the watermark has passed them and are then taken in order of time, so neither
the split into triggers nor the order within the delay has an influence. A rule that is broken becomes pending; it fires
when it has been broken for its hold time, by an event-time timer and without a further sample; the first sample that does not
break it resolves it, or clears it if it had not fired. A sample holds until the next one of its metric.

What a task sees of a rule in a trigger are its samples of that trigger: window aggregates, whose number follows from event time
and not from the rows behind them. Of several samples of one time the rule counts as broken if one breaks it. Samples
without a time or a value break nothing, samples later than the delay are dropped by the watermark. ``alerts.states`` with
``as_of`` is the same on a batch. Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from voltide.functions.clock import utc_instant, utc_wall
from voltide.operators import alerts

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PENDING, FIRING, RESOLVED, CLEARED = "pending", "firing", "resolved", "cleared"
EVENT = "name string, severity string, state string, at_us long, pending_us long"
SECOND = 1_000_000


class RuleState(StatefulProcessor):
    """The state of one rule: waiting samples, and since when it is broken and whether it has fired."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "ts_us long", "broken boolean")
        self.current = handle.getValueState("current", "pending_us long, fired boolean, hold_us long, severity string")
        self.taken = handle.getValueState("taken", "watermark_ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        fresh: dict[int, bool] = {}
        for row in rows:
            fresh[row["ts_us"]] = fresh.get(row["ts_us"], False) or row["broken"]
            hold, severity = row["hold_us"], row["severity"]
        for at, broken in fresh.items():
            before = self.waiting.getValue((at,)) if self.waiting.containsKey((at,)) else (False,)
            self.waiting.updateValue((at,), (bool(broken or before[0]),))
            self.handle.registerTimer(at // 1000 + 1)
        since, fired, *_ = self.current.get() or (None, False)
        self.current.update((since, fired, hold, severity))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Everything up to the watermark at once; the other timers of the trigger then find nothing."""
        watermark = timerValues.getCurrentWatermarkInMs()
        if (self.taken.get() or (None,))[0] == watermark:
            return
        self.taken.update((watermark,))
        until = watermark * 1000
        since, fired, hold, severity = self.current.get()

        def event(state: str, at: int) -> Row:
            return Row(name=key[0], severity=severity, state=state, at_us=at, pending_us=since)

        due = sorted((at[0], broken[0]) for at, broken in self.waiting.iterator() if at[0] <= until)
        for at, broken in [*due, (until, None)]:
            if since is not None and not fired and at - since >= hold:
                fired = True
                yield event(FIRING, since + hold)
            if broken and since is None:
                since = at
                yield event(PENDING, at)
                self.handle.registerTimer((at + hold) // 1000 + 1)
            elif broken is False and since is not None:
                yield event(RESOLVED if fired else CLEARED, at)
                since, fired = None, False
        for at, _ in due:
            self.waiting.removeKey((at,))
        self.current.update((since, fired, hold, severity))

    def close(self) -> None:
        pass


def events(
    metrics: DataFrame, rules: Sequence[alerts.Rule] = tuple(alerts.HELD_RULES), delay: str = "10 minutes"
) -> DataFrame:
    """Changes of state (name, severity, state, at, pending_at) of a stream of (ts, metric_name, value)."""
    table = alerts.rule_table(metrics.sparkSession, rules)
    timed = metrics.where(F.col("ts").isNotNull()).withColumn("_at", utc_instant(F.col("ts"))).withWatermark("_at", delay)
    ruled = timed.join(F.broadcast(table), "metric_name").select(
        "name",
        "severity",
        "_at",
        F.unix_micros("_at").alias("ts_us"),
        alerts.broken().alias("broken"),
        (F.col("hold_seconds") * SECOND).alias("hold_us"),
    )
    changed = ruled.groupBy("name").transformWithState(RuleState(), EVENT, "append", "eventTime")
    at, pending = (utc_wall(F.timestamp_micros(c)) for c in ("at_us", "pending_us"))
    return changed.select("name", "severity", "state", at.alias("at"), pending.alias("pending_at"))


def stretches(changes: DataFrame) -> DataFrame:
    """One row per stretch from a table of changes, as ``alerts.states`` has them."""

    def at(*states: str):
        return F.max(F.when(F.col("state").isin(*states), F.col("at")))

    found = changes.groupBy("name", "severity", "pending_at").agg(
        at(FIRING).alias("fired_at"), at(RESOLVED, CLEARED).alias("resolved_at")
    )
    return found.withColumn("state", alerts.state_of(F.col("fired_at"), F.col("resolved_at")))
