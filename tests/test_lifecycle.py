"""Alert lifecycle on a stream against the batch states."""

import datetime as dt

import numpy as np
import pytest

from voltide.operators import alerts
from voltide.streaming import jobs, lifecycle

RULES = [
    alerts.Rule("short", "m", 0.5, "gt", "warning", "{value}", "number3", 120),
    alerts.Rule("long", "m", 0.5, "gt", "critical", "{value}", "number3", 900),
    alerts.Rule("low", "n", 0.2, "lt", "info", "{value}", "number3", 300),
]
SCHEMA = "ts timestamp_ntz, metric_name string, value double"
START = dt.datetime(2025, 1, 1)


def samples(n=150, seed=2):
    rng = np.random.default_rng(seed)
    rows, at = [], START
    for k in range(n):
        at += dt.timedelta(seconds=int(rng.integers(20, 200)), microseconds=int(rng.integers(0, 999_999)))
        value = None if k % 29 == 7 else float((np.sin(k / 5) + rng.normal(0, 0.3)) > 0)
        rows.append((at, "m" if rng.random() < 0.6 else "n", value))
    return rows


def table_of(spark, parts, path, delay="10 minutes"):
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{path}/in")
        table = jobs.run_to_table(lifecycle.events(stream, RULES, delay), "events", f"{path}/out")
    return lifecycle.stretches(table)


COLUMNS = ["name", "severity", "pending_at", "fired_at", "resolved_at", "state"]


def rows_of(table):
    return sorted(map(str, table.select(*COLUMNS).collect()))


@pytest.mark.parametrize("split", ["one", "five", "shuffled within the delay"])
def test_equals_batch_states_for_any_split(spark, tmp_path, split):
    rows = samples()
    if split == "one":
        parts = [rows]
    elif split == "five":
        parts = [rows[k : k + 30] for k in range(0, 150, 30)]
    else:
        swapped = [*rows[:40], *rows[43:46], *rows[40:43], *rows[46:]]
        parts = [swapped[:43], swapped[43:100], swapped[100:]]
    got = rows_of(table_of(spark, parts, tmp_path))
    as_of = rows[-1][0] - dt.timedelta(minutes=10)
    as_of = as_of.replace(microsecond=as_of.microsecond // 1000 * 1000)  # watermarks are whole milliseconds
    want = rows_of(alerts.states(spark.createDataFrame(rows, SCHEMA), RULES, as_of=as_of))
    assert got == want and len({r.split("state=")[1] for r in got}) >= 3


def test_fires_without_a_further_sample(spark, tmp_path):
    def at(seconds):
        return START + dt.timedelta(seconds=seconds)

    parts = [[(at(0), "m", 1.0)], [(at(2000), "other", 0.0)]]
    (short, long) = sorted(table_of(spark, parts, tmp_path).collect(), key=lambda r: r.fired_at)
    assert (short.name, short.fired_at, short.state) == ("short", at(120), "firing")
    assert (long.name, long.fired_at, long.state) == ("long", at(900), "firing")
    parts = [[(at(2100), "m", 0.0)], [(at(9000), "m", 0.0)]]
    later = table_of(spark, parts, tmp_path)
    assert {(r.name, r.state, r.resolved_at) for r in later.collect()} == {
        ("short", "resolved", at(2100)), ("long", "resolved", at(2100))
    }
