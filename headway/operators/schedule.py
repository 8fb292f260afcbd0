"""Analytics over the static schedule, and the schedule as reference data for positions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.codes import coverage_class, route_type_label
from headway.functions.geo import in_box, round_cell


def route_stop_join(routes: DataFrame, trips: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Every scheduled stop with its route: routes, trips and stop times joined by their keys.

    Trips meet their routes first, so the large stop-times side is shuffled once.
    """
    routed = trips.select("trip_id", "route_id").join(
        routes.select("route_id", "route_short_name", "route_long_name"), "route_id"
    )
    return stop_times.select("trip_id", "stop_id").join(routed, "trip_id")


def longest_routes(routes: DataFrame, trips: DataFrame, stop_times: DataFrame, *, top: int = 10) -> DataFrame:
    """Routes with the most distinct stops, grouped by their two names."""
    return (
        route_stop_join(routes, trips, stop_times)
        .groupBy("route_short_name", "route_long_name")
        .agg(F.count_distinct("stop_id").alias("unique_stops"))
        .orderBy(F.desc("unique_stops"), "route_short_name", "route_long_name")
        .limit(top)
    )


def routes_by_type(routes: DataFrame) -> DataFrame:
    """Routes per raw type code; several codes may share the label Other."""
    return (
        routes.groupBy("route_type")
        .agg(F.count(F.lit(1)).alias("route_count"))
        .select("route_type", route_type_label(F.col("route_type")).alias("type_label"), "route_count")
        .orderBy(F.desc("route_count"), "route_type")
    )


def network_bounds(stops: DataFrame) -> DataFrame:
    return stops.agg(
        F.min("stop_lat").alias("min_lat"),
        F.max("stop_lat").alias("max_lat"),
        F.min("stop_lon").alias("min_lon"),
        F.max("stop_lon").alias("max_lon"),
    )


def stops_in_box(stops: DataFrame, *, min_lat: float, max_lat: float, min_lon: float,
                 max_lon: float, top: int | None = None) -> DataFrame:
    """Stops in a closed box, in stop_id order when cut to ``top`` rows."""
    found = stops.where(
        in_box(F.col("stop_lat"), F.col("stop_lon"), min_lat, max_lat, min_lon, max_lon)
    ).select("stop_id", "stop_name", "stop_lat", "stop_lon")
    return found if top is None else found.orderBy("stop_id").limit(top)


def stop_density(stops: DataFrame) -> DataFrame:
    """Stops per 0.01 degree cell."""
    return stops.groupBy(
        round_cell(F.col("stop_lat")).alias("lat_cell"),
        round_cell(F.col("stop_lon")).alias("lon_cell"),
    ).agg(F.count(F.lit(1)).alias("stop_count"))


def busiest_cells(stops: DataFrame, *, top: int = 10) -> DataFrame:
    return stop_density(stops).orderBy(F.desc("stop_count"), "lat_cell", "lon_cell").limit(top)


def coverage_classes(stops: DataFrame, *, half_side: float = 0.005) -> DataFrame:
    """Every cell with its class and the rectangle drawn for it."""
    lat, lon = F.col("lat_cell"), F.col("lon_cell")
    return stop_density(stops).select(
        "lat_cell", "lon_cell", "stop_count",
        coverage_class(F.col("stop_count")).alias("coverage"),
        (lat - half_side).alias("south"), (lat + half_side).alias("north"),
        (lon - half_side).alias("west"), (lon + half_side).alias("east"),
    )


def coverage_summary(stops: DataFrame) -> DataFrame:
    """One row over all cells: cells per class, shares, best cell against a desert, mean stops.

    The ratio is 0 without deserts and NULL when there are deserts but no high cell.
    """
    count = F.col("stop_count")
    label = coverage_class(count)
    totals = stop_density(stops).agg(
        F.count(F.lit(1)).alias("total_cells"),
        F.count_if(label == "high").alias("high_cells"),
        F.count_if(label == "medium").alias("medium_cells"),
        F.count_if(label == "low").alias("low_cells"),
        F.count_if(label == "desert").alias("desert_cells"),
        F.max(F.when(label == "high", count)).alias("best"),
        F.sum(count).alias("stops"),
    )
    cells, deserts = F.col("total_cells"), F.col("desert_cells")
    poor = deserts + F.col("low_cells")

    def percent(part):
        return F.coalesce(F.try_divide(part * 100.0, cells), F.lit(0.0))

    return totals.select(
        "total_cells", "high_cells", "medium_cells", "low_cells", "desert_cells",
        poor.alias("poor_cells"),
        percent(poor).alias("poor_percent"),
        percent(deserts).alias("desert_percent"),
        F.when(deserts > 0, F.col("best")).otherwise(F.lit(0).cast("bigint")).alias("best_to_desert_ratio"),
        F.coalesce(F.try_divide(F.col("stops"), cells), F.lit(0.0)).alias("avg_stops_per_cell"),
    )


def monitored_routes(routes: DataFrame, agencies: DataFrame) -> DataFrame:
    """Routes of the types that an enabled agency monitors."""
    wanted = agencies.where("enabled").select(F.explode("route_types").alias("route_type"))
    return routes.join(wanted, "route_type", "left_semi")


def unknown_routes(positions: DataFrame, routes: DataFrame) -> DataFrame:
    """Positions that name a route the schedule does not have; a position without a route is left out."""
    return positions.where(F.col("route_id").isNotNull()).join(
        routes.select("route_id"), "route_id", "left_anti"
    )


def with_schedule_names(positions: DataFrame, routes: DataFrame, stops: DataFrame) -> DataFrame:
    """Positions with the names of their route and stop; unknown ids keep NULL names."""
    route_names = routes.select("route_id", "route_short_name", "route_long_name")
    stop_names = stops.select("stop_id", "stop_name")
    return positions.join(route_names, "route_id", "left").join(stop_names, "stop_id", "left")
