"""All schedule analytics of one feed folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headway.operators import coverage, schedule
from headway.sources.schedule import load_schedule_bundle, load_stop_times

# fixed values: the downtown box of the stop listing
DOWNTOWN = {"min_lat": 45.50, "max_lat": 45.53, "min_lon": -122.69, "max_lon": -122.66}


def schedule_report(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Named results over the schedule files of ``folder``."""
    bundle = load_schedule_bundle(spark, folder)
    stops, routes, trips = bundle["stops"], bundle["routes"], bundle["trips"]
    return {
        "routes_by_type": schedule.routes_by_type(routes),
        "network_bounds": schedule.network_bounds(stops),
        "downtown_stops": schedule.stops_in_box(stops, top=10, **DOWNTOWN),
        "busiest_cells": schedule.busiest_cells(stops),
        "longest_routes": schedule.longest_routes(routes, trips, load_stop_times(spark, folder)),
        "coverage_summary": schedule.coverage_summary(stops),
        "coverage_gaps": coverage.coverage_gaps(stops),
        "isolated_stops": coverage.isolated_stops(stops),
        "desert_summary": coverage.desert_summary(stops, routes),
    }
