"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   table directory (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_RUNS     runs per query; the fastest counts (default 2)

A run covers building the query, including the statistics it materialises, and
producing all result rows.
"""

from __future__ import annotations

import json
import os
import time

from meterlake.checks.queries import QUERIES
from meterlake.session import build_session

HEADLINE = (
    "conform_usage",
    "dq_breakdown",
    "enrich_usage",
    "service_statistics",
    "outlier_flags",
    "daily_usage",
    "cost_rolling_14d",
    "tickets_by_day",
    "revenue_by_org_month",
    "genai_by_day",
    "anomaly_mart",
    "q_daily_range",
    "q_top_services",
    "q_tickets",
    "q_worst_anomalies",
    "master_dedupe",
    "stream_dedupe",
    "stream_daily_window",
    "upsert_merge",
    "zone_manifest",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench", f"local[{cpus}]", int(cpus),
        spark_driver_memory="16g", spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            result = QUERIES[name](spark, sf_dir)
            result.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
