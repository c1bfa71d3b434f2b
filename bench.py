"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local cores.
Every query runs once to warm the JVM and is then timed as the better of two runs, results written to a
sink that keeps all columns.
"""

from __future__ import annotations

import json
import os
import time

from voltide.session import local_session

HEADLINE = [
    "rolling_volatility",
    "feature_pipeline",
    "transform_end_to_end",
    "halo_window",
    "outliers_zscore",
    "time_split",
    "regression_metrics_split",
    "reference_stats",
    "ks_pvalue",
    "wasserstein",
    "drift_metrics",
    "drift_by_window",
    "risk_level",
    "range_drift",
    "latency_distribution",
    "alert_eval",
    "error_rate",
    "request_rate",
    "counter_rate",
    "latency_quantiles",
    "latency_histogram",
    "histogram_quantile",
    "sustained_condition",
    "service_gaps",
    "profile_columns",
]


def main() -> None:
    from voltide.plans.catalog import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)

    def run(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(min(run(name), run(name)), 3)
    n_events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "input_events": n_events,
                "events_per_sec": {k: round(n_events / v) for k, v in seconds.items()},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
