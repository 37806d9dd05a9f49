"""Time the headline queries: median of warm runs into a sink that discards the rows. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from slotledger.catalog import queries
from slotledger.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "daily_channel_performance",
    "booking_time_patterns",
    "employee_meeting_load",
    "latest_webhook",
    "latest_spend",
    "silver_webhooks",
    "silver_spend",
    "upsert_replace",
    "upsert_conditional",
    "headline_kpis",
    "daily_cpb",
    "rolling_by_channel",
    "weekly_bookings_wmon",
    "trend_kpis",
    "channel_leaderboard",
    "metric_heatmap",
    "busiest_slots",
    "employee_kpis",
    "load_level_summary",
)


def main() -> None:
    options = {
        "spark.master": f"local[{CPUS}]",
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.enabled": "false",
    }
    spark = build_session("slotledger-bench", options)
    spark.sparkContext.setLogLevel("ERROR")
    chosen, known = sys.argv[1:] or HEADLINE, queries()

    def timed(name: str) -> float:
        started = time.perf_counter()
        known[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    for name in chosen:  # one pass to warm up the JVM and the file cache
        timed(name)
    seconds = {name: round(statistics.median(timed(name) for _ in range(RUNS)), 4) for name in chosen}
    total = round(sum(seconds.values()), 4)
    scale = os.path.basename(SF_DIR.rstrip("/"))
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
