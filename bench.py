"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores.
Every query runs in full: its rows go to a sink that takes and drops them. Each is
run once to warm up, then three times; the median counts.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time
from pathlib import Path

from martlane.demo import registry
from martlane.session import local_session

HEADLINE = [
    "stg_order_line_item",
    "stg_sbb_stationboard",
    "mart_customer_overview",
    "mart_fleet_status",
    "mart_warehouse_capacity",
    "mart_order_summary",
    "mart_product_catalog",
    "mart_shipment_tracking",
    "mart_merchant_overview",
    "mart_transaction_summary",
    "mart_swiss_rail_overview",
    "mart_weather_station_catalog",
    "fulfillment_lifecycle",
    "customer_overview_360",
    "revenue_by_route",
    "transaction_report",
    "largest_orders_by_lines",
    "risk_by_customer",
    "metric_fulfillment_by_status",
    "metric_compliance_by_method",
    "metric_fanout_guard",
    "apply_policies",
    "dq_report",
    "stream_dedupe_by_key",
    "stream_flatten",
]


RUNS = 3  # timed runs of each query, after one that is not


def plan_size(frame) -> dict[str, int]:
    """Scans, joins and aggregates of the physical plan as first made."""
    plan = frame._jdf.queryExecution().sparkPlan().toString()
    return {
        "scans": len(re.findall(r"FileScan|BatchScan", plan)),
        "joins": len(re.findall(r"Join\b", plan)),
        "aggregates": len(re.findall(r"\w+Aggregate\b", plan)),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores)
    seconds, plans = {}, {}
    for name in HEADLINE:
        times = []
        for run in range(RUNS + 1):
            start = time.perf_counter()
            frame = registry.run(name, spark, folder)
            frame.write.format("noop").mode("overwrite").save()
            if run:
                times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        plans[name] = plan_size(frame)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "plans": plans,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
