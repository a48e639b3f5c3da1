"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) on ``local[BENCH_CPUS]``.
Every query is run once, in full, into a sink that discards its rows; one small
query before the first makes the session ready. Queries read stored trips and a stored
fact; writing them is timed as ``store_trips`` and ``store_fact``. ``BENCH_QUERIES`` may name others.
``operations`` are timed apart and not part of the total: a load of all months, an incremental
build, and facts kept by deltas. ``BENCH_OPERATIONS`` may name others, or none.
"""

from __future__ import annotations

import json
import os
import time

from tripstar.catalog import stored
from tripstar.catalog.registry import all_queries
from tripstar.session import new_session

HEADLINE = [
    "fact_trips", "fact_trips_incremental", "fact_trips_daily_agg", "fact_trips_hourly_agg",
    "fact_trip_summary", "fact_fare_summary", "fact_trip_locations",
    "trip_analytics", "revenue_analytics", "location_performance", "time_patterns",
    "payment_behavior", "executive_kpis", "service_comparison", "hourly_demand_heatmap",
    "top_routes", "monthly_trends", "airport_traffic", "vendor_performance",
    "rush_hour_analysis", "heatmap_overall_pivot", "peak_insights", "route_insights",
    "airport_performance", "trend_extremes", "trip_data_union", "merge_upsert", "log_latest",
    "audit_pk_duplicates", "audit_fk_orphans", "audit_stray_months", "stream_hourly_demand",
]
OPERATIONS = ["load_month_idempotent", "build_facts_incremental", "delta_upkeep_daily"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = new_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    queries["file_status_latest"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    operations = os.environ.get("BENCH_OPERATIONS", " ".join(OPERATIONS)).split()
    seconds, apart = {}, {}
    for name, store in (("store_trips", stored.trips), ("store_fact", stored.fact)):
        start = time.perf_counter()
        store(spark, sf_dir)
        seconds[name] = round(time.perf_counter() - start, 3)
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    for name in operations:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        apart[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "operations": apart,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
