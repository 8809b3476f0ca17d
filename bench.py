"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   test tables, default /root/testdata/sf0.1
BENCH_CPUS     cores, default 8
BENCH_REPEATS  timed runs per query after one warm-up, default 3 (the median counts)
BENCH_QUERIES  comma-separated names, default the list below
"""

from __future__ import annotations

import json
import os
import statistics
import time

from fleetmeter.session import build_session
from verification.queries import QUERIES

HEADLINE = [
    "valid_runs",
    "gpu_count",
    "run_days",
    "metrics_daily",
    "run_days_with_metrics",
    "merge_history",
    "usage_facts",
    "gpu_hours_daily",
    "report_daily",
    "report_weekly",
    "report_monthly",
    "report_overall",
    "project_summary",
    "weekly_project_report",
    "overlapping_runs",
    "low_utilization_alerts",
    "company_row_counts",
    "health_checks",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        "fleetmeter-bench",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(repeats)), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
