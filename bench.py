"""Time the headline queries and print one JSON line.

BENCH_SF_DIR picks the tables and BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks.queries import QUERIES
from faremill.session import local_session

HEADLINE = (
    "dq_report",
    "silver_trips",
    "bad_records",
    "daily_mart",
    "hourly_mart",
    "payment_mart",
    "route_mart",
    "gate_silver",
    "gate_month",
    "daily_kpis",
    "top_pickup_zones",
    "peak_hours_by_type",
    "top_zones_by_type",
    "payment_trends",
    "rideshare_candidates",
    "zone_demand_map",
    "processed_periods",
    "new_periods",
)


def run(frame) -> None:
    """Compute every column of every row without moving rows to the driver."""
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus=cpus, partitions=int(cpus))
    run(QUERIES["daily_mart"](spark, sf_dir))  # start-up is not a query
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        started = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
