"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all), BENCH_RUNS (default 3 timed
runs after one warm-up, the median counts), BENCH_BUDGET (seconds, default 420; once a query's share is
used up it gets one timed run), BENCH_QUERIES (comma list, default the headline set).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hangarflow.plans.catalogue import QUERIES  # noqa: E402
from hangarflow.session import build  # noqa: E402

HEADLINE = [
    "load_verify", "entity_topk", "rolling_features", "trend_features", "anomaly_scores", "gold_daily",
    "dq_report", "dq_rules", "impute_ffill", "impute_ffill_readings", "impute_context", "outlier_iqr", "dedup_first",
    "silver_readings", "hourly_features", "stat_features", "failure_label", "asof_since", "interval_counts",
    "aircraft_features", "rul_label", "describe", "corr_matrix", "window_stats", "inv_kpis", "upsert", "scd2_build",
    "scd2_pit", "inv_recommend", "kpi_summary", "drift_psi", "drift_ks", "metrics", "roc_curve", "time_split",
    "model_lr", "iso_forest", "stream_tumbling",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    budget = float(os.environ.get("BENCH_BUDGET", "420"))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = build("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
                  spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"))
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    timed: dict[str, int] = {}
    began = time.perf_counter()
    for at, name in enumerate(wanted):
        taken = []
        for i in range(runs + 1):
            if taken and time.perf_counter() - began > budget * (at + 1) / len(wanted):
                break
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            if i:
                taken.append(time.perf_counter() - start)
        times[name], timed[name] = round(statistics.median(taken), 3), len(taken)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "timed_runs": timed, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
