"""Fleet metrics over vehicle positions and trip updates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway import contracts as C
from headway.functions.codes import congestion_score, speed_kmh
from headway.functions.geo import cell_origin, grid_cell, in_box, round_cell


def gold_hourly(positions: DataFrame) -> DataFrame:
    """Metrics per hour, agency and route.

    The distinct count makes Spark aggregate by (group, vehicle) first, so a
    hot route or hour is spread over its vehicles before the last step.
    """
    kmh = speed_kmh(F.col("speed"))
    return (
        positions.where(F.col("route_id").isNotNull())
        .groupBy(
            F.date_trunc("hour", "timestamp").alias("hour_timestamp"), "agency_id", "route_id"
        )
        .agg(
            F.count_distinct("vehicle_id").alias("total_vehicles"),
            F.avg(kmh).alias("avg_speed_kmh"),
            F.max(kmh).alias("max_speed_kmh"),
            F.avg(congestion_score(F.col("congestion_level"))).alias("avg_congestion_score"),
            F.count(F.lit(1)).alias("total_observations"),
        )
    )


def route_performance(trip_updates: DataFrame, *, on_time_s: tuple[int, int] = C.ON_TIME_S) -> DataFrame:
    """Delay summary per date, agency and route; on time is a closed range of arrival delays."""
    delay = F.col("arrival_delay")
    on_time = F.when(delay.between(*on_time_s), 100.0).when(delay.isNotNull(), 0.0)
    return (
        trip_updates.where(F.col("route_id").isNotNull())
        .groupBy(F.to_date("timestamp").alias("date"), "agency_id", "route_id")
        .agg(
            F.avg(delay).alias("avg_delay_seconds"),
            F.max(delay).alias("max_delay_seconds"),
            F.min(delay).alias("min_delay_seconds"),
            F.avg(on_time).alias("on_time_percentage"),
            F.count_distinct("trip_id").alias("total_trips"),
        )
    )


def hourly_partials(positions: DataFrame) -> DataFrame:
    """Sums per hour, agency, route and vehicle, from which hourly metrics add up exactly, however the rows were cut."""
    kmh = speed_kmh(F.col("speed"))
    return (
        positions.where(F.col("route_id").isNotNull())
        .groupBy(F.date_trunc("hour", "timestamp").alias("hour_timestamp"), "agency_id", "route_id", "vehicle_id")
        .agg(
            F.sum(kmh).alias("speed_sum"), F.count(kmh).alias("speeds"), F.max(kmh).alias("max_speed_kmh"),
            F.sum(congestion_score(F.col("congestion_level"))).cast("bigint").alias("score_sum"),
            F.count(F.lit(1)).alias("observations"),
        )
    )


def merged_hourly_partials(partials: DataFrame, *extra: str) -> DataFrame:
    """Partial sums of several batches as one row per hour, agency, route and vehicle (and ``extra`` columns)."""
    return partials.groupBy(*extra, "hour_timestamp", "agency_id", "route_id", "vehicle_id").agg(
        F.sum("speed_sum").alias("speed_sum"), F.sum("speeds").alias("speeds"), F.max("max_speed_kmh").alias("max_speed_kmh"),
        F.sum("score_sum").alias("score_sum"), F.sum("observations").alias("observations"))


def hourly_from_partials(partials: DataFrame) -> DataFrame:
    """The metrics of `gold_hourly` from partial sums; a vehicle counts once, in whatever batches it came."""
    return (
        merged_hourly_partials(partials)
        .groupBy("hour_timestamp", "agency_id", "route_id")
        .agg(
            F.count("vehicle_id").cast("int").alias("total_vehicles"),
            F.try_divide(F.sum("speed_sum"), F.sum("speeds")).alias("avg_speed_kmh"),
            F.max("max_speed_kmh").alias("max_speed_kmh"),
            (F.sum("score_sum") / F.sum("observations")).alias("avg_congestion_score"),
            F.sum("observations").cast("int").alias("total_observations"),
        )
    )


def route_partials(trip_updates: DataFrame, *, on_time_s: tuple[int, int] = C.ON_TIME_S) -> DataFrame:
    """Sums per date, agency, route and trip, from which route performance adds up."""
    delay = F.col("arrival_delay")
    return (
        trip_updates.where(F.col("route_id").isNotNull())
        .groupBy(F.to_date("timestamp").alias("date"), "agency_id", "route_id", "trip_id")
        .agg(
            F.sum(delay).cast("bigint").alias("delay_sum"), F.count(delay).alias("delays"),
            F.max(delay).alias("max_delay_seconds"), F.min(delay).alias("min_delay_seconds"),
            F.count_if(delay.between(*on_time_s)).alias("on_time"),
        )
    )


def merged_route_partials(partials: DataFrame, *extra: str) -> DataFrame:
    return partials.groupBy(*extra, "date", "agency_id", "route_id", "trip_id").agg(
        F.sum("delay_sum").alias("delay_sum"), F.sum("delays").alias("delays"),
        F.max("max_delay_seconds").alias("max_delay_seconds"), F.min("min_delay_seconds").alias("min_delay_seconds"),
        F.sum("on_time").alias("on_time"))


def route_from_partials(partials: DataFrame) -> DataFrame:
    """The summary of `route_performance` from partial sums."""
    return (
        merged_route_partials(partials)
        .groupBy("date", "agency_id", "route_id")
        .agg(
            F.try_divide(F.sum("delay_sum"), F.sum("delays")).alias("avg_delay_seconds"),
            F.max("max_delay_seconds").alias("max_delay_seconds"),
            F.min("min_delay_seconds").alias("min_delay_seconds"),
            F.try_divide(F.sum("on_time") * 100.0, F.sum("delays")).alias("on_time_percentage"),
            F.count("trip_id").cast("int").alias("total_trips"),
        )
    )


def fleet_stats(positions: DataFrame, *, with_speed_only: bool = True) -> DataFrame:
    """Vehicles, routes, average and top speed of the whole fleet, as one row.

    Rows collapse to (vehicle, route) before the two distinct counts, which
    would otherwise copy every input row once per count.
    """
    rows = positions.where(F.col("speed").isNotNull()) if with_speed_only else positions
    kmh = speed_kmh(F.col("speed"))
    pairs = rows.groupBy("vehicle_id", "route_id").agg(
        F.sum(kmh).alias("speed_sum"), F.count(kmh).alias("speeds"), F.max(kmh).alias("top")
    )
    return pairs.agg(
        F.count_distinct("vehicle_id").alias("active_vehicles"),
        F.count_distinct("route_id").alias("routes_covered"),
        F.try_divide(F.sum("speed_sum"), F.sum("speeds")).alias("avg_speed_kmh"),
        F.max("top").alias("max_speed_kmh"),
    )


def heat_map_grid(positions: DataFrame, *, min_lat: float, max_lat: float, min_lon: float,
                  max_lon: float, grid_size: int = 20, ordered: bool = True) -> DataFrame:
    """Vehicles per cell of an n x n grid over a closed box, fullest first.

    A point on the upper edge falls in the extra cell ``n``. ``cell_origin_*``
    is the lower corner of the cell.
    """
    lat, lon = F.col("latitude"), F.col("longitude")
    cells = (
        positions.where(in_box(lat, lon, min_lat, max_lat, min_lon, max_lon))
        .select(
            grid_cell(lat, min_lat, max_lat, grid_size).alias("lat_cell"),
            grid_cell(lon, min_lon, max_lon, grid_size).alias("lon_cell"),
        )
        .groupBy("lat_cell", "lon_cell")
        .agg(F.count(F.lit(1)).alias("vehicle_count"))
        .select(
            "*",
            cell_origin(F.col("lat_cell"), min_lat, max_lat, grid_size).alias("cell_origin_lat"),
            cell_origin(F.col("lon_cell"), min_lon, max_lon, grid_size).alias("cell_origin_lon"),
        )
    )
    return cells.orderBy(F.desc("vehicle_count"), "lat_cell", "lon_cell") if ordered else cells


def zone_speeds(positions: DataFrame) -> DataFrame:
    """Average speed, rows and the sorted list of routes per 0.01 degree cell.

    Rows collapse to (cell, route) before the routes are listed, so a list is
    built from one row per route and never from the rows of a crowded cell.
    """
    kmh = speed_kmh(F.col("speed"))
    per_route = (
        positions.where(F.col("speed").isNotNull())
        .groupBy(
            round_cell(F.col("latitude")).alias("lat_zone"),
            round_cell(F.col("longitude")).alias("lon_zone"),
            "route_id",
        )
        .agg(F.sum(kmh).alias("speed_sum"), F.count(F.lit(1)).alias("n"))
    )
    return per_route.groupBy("lat_zone", "lon_zone").agg(
        (F.sum("speed_sum") / F.sum("n")).alias("avg_speed_kmh"),
        F.sum("n").alias("observation_count"),
        F.array_sort(F.collect_set("route_id")).alias("routes"),
    )


def slow_zones(positions: DataFrame, *, threshold_kmh: float = 10.0, top: int = 50) -> DataFrame:
    """The slowest cells below a speed threshold; a zone without any route has NULL routes."""
    return (
        zone_speeds(positions)
        .where(F.col("avg_speed_kmh") < threshold_kmh)
        .orderBy("avg_speed_kmh", "lat_zone", "lon_zone")
        .limit(top)
        .select(
            "lat_zone", "lon_zone", "avg_speed_kmh", "observation_count",
            F.when(F.size("routes") > 0, F.array_join("routes", ", ")).alias("affected_routes"),
        )
    )
