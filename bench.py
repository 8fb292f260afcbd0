"""Time the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_QUERIES`` (comma-separated names, default the list below),
``BENCH_RUNS`` (default 2; the best run counts).
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "gold_hourly", "route_performance", "fleet_stats", "slow_zones", "heat_map_grid", "radius_search", "radius_join",
    "silver_filter", "silver_anti_join", "validate_vehicle", "validate_trip_update", "quality_split", "quarantine",
    "flatten_vehicles", "flatten_trip_updates", "feed_stats", "longest_routes", "route_stop_join",
    "schedule_enrich", "stop_density", "coverage_summary", "coverage_gaps", "isolated_stops",
    "stop_nearest_neighbour", "desert_summary", "weather_correlate", "weather_grid_correlate", "weather_impact",
    "weather_forecast", "upsert_gold", "layer_metrics", "publish_vehicle_positions", "append_bronze",
    "stream_hourly_gold", "stream_medallion",
]


def main() -> None:
    from headway.session import local_session

    import checks

    checks.load()
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = local_session("bench", cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            checks.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
        print(name, [round(x, 2) for x in times], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
    }))


if __name__ == "__main__":
    main()
