"""Queries for aggregates and top-k reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import query
from checks.functions import R6
from checks.joins import GOLD_SQL, rounded_gold
from checks.validation import UPDATE_RULES_SQL, VEHICLE_RULES_FEED_SQL, bad_sql
from checks.views import AS_OF, rounded
from headway.operators import fleet, schedule
from headway.operators.medallion import layer_metrics, silver_filter
from headway.operators.validate import feed_stats

BOX = {"min_lat": 45.3, "max_lat": 45.6, "min_lon": -122.9, "max_lon": -122.4}


@query("gold_hourly", GOLD_SQL.format("silver_positions"))
def _(t):
    return rounded_gold(fleet.gold_hourly(silver_filter(t.positions, as_of=AS_OF)))


@query("route_performance", f"""
SELECT CAST(CAST(timestamp AS DATE) AS VARCHAR) AS date, agency_id, route_id, {R6('AVG(arrival_delay)')} AS avg_delay_seconds,
  MAX(arrival_delay) AS max_delay_seconds, MIN(arrival_delay) AS min_delay_seconds,
  {R6('AVG(CASE WHEN arrival_delay BETWEEN -60 AND 300 THEN 100e0 WHEN arrival_delay IS NOT NULL THEN 0e0 END)')}
    AS on_time_percentage, COUNT(DISTINCT trip_id) AS total_trips
FROM trip_updates WHERE route_id IS NOT NULL GROUP BY 1, 2, 3""")
def _(t):
    summary = fleet.route_performance(t.trip_updates)
    # a date has different Python types on the two sides, its text has not
    return summary.withColumns({
        "date": F.col("date").cast("string"),
        **{c: rounded(F.col(c)) for c in ("avg_delay_seconds", "on_time_percentage")}})


@query("heat_map_grid", f"""
WITH grid AS (SELECT FLOOR((latitude - 45.3e0) / (45.6e0 - 45.3e0) * 20) AS lat_cell,
  FLOOR((longitude - -122.9e0) / (-122.4e0 - -122.9e0) * 20) AS lon_cell FROM vehicle_positions
  WHERE latitude BETWEEN 45.3e0 AND 45.6e0 AND longitude BETWEEN -122.9e0 AND -122.4e0)
SELECT CAST(lat_cell AS DOUBLE) AS lat_cell, CAST(lon_cell AS DOUBLE) AS lon_cell, COUNT(*) AS vehicle_count,
  {R6('45.3e0 + (lat_cell / 20) * (45.6e0 - 45.3e0)')} AS cell_origin_lat,
  {R6('-122.9e0 + (lon_cell / 20) * (-122.4e0 - -122.9e0)')} AS cell_origin_lon
FROM grid GROUP BY lat_cell, lon_cell""")
def _(t):
    grid = fleet.heat_map_grid(t.positions, **BOX)
    return grid.withColumns({c: rounded(F.col(c)) for c in ("cell_origin_lat", "cell_origin_lon")})


@query("slow_zones", f"""
SELECT lat_zone, lon_zone, {R6('kmh')} AS avg_speed_kmh, observation_count, affected_routes FROM (
  SELECT ROUND(latitude, 2) AS lat_zone, ROUND(longitude, 2) AS lon_zone, AVG(speed * 3.6e0) AS kmh,
    COUNT(*) AS observation_count, STRING_AGG(DISTINCT route_id, ', ' ORDER BY route_id) AS affected_routes
  FROM vehicle_positions WHERE speed IS NOT NULL GROUP BY 1, 2 HAVING kmh < 10)
ORDER BY avg_speed_kmh, lat_zone, lon_zone LIMIT 50""")
def _(t):
    zones = fleet.slow_zones(t.positions, threshold_kmh=10.0)
    return zones.withColumn("avg_speed_kmh", rounded(F.col("avg_speed_kmh")))


@query("routes_by_type", """
SELECT route_type, CASE route_type WHEN 0 THEN 'Tram/Light Rail' WHEN 1 THEN 'Subway/Metro' WHEN 3 THEN 'Bus'
  ELSE 'Other' END AS type_label, COUNT(*) AS route_count FROM routes GROUP BY route_type""")
def _(t):
    return schedule.routes_by_type(t.routes)


@query("network_bounds", f"""
SELECT {R6('MIN(stop_lat)')} AS min_lat, {R6('MAX(stop_lat)')} AS max_lat,
  {R6('MIN(stop_lon)')} AS min_lon, {R6('MAX(stop_lon)')} AS max_lon FROM stops""")
def _(t):
    bounds = schedule.network_bounds(t.stops)
    return bounds.select(*[rounded(F.col(c)).alias(c) for c in bounds.columns])


@query("busiest_cells", """
SELECT ROUND(stop_lat, 2) AS lat_cell, ROUND(stop_lon, 2) AS lon_cell, COUNT(*) AS stop_count FROM stops
GROUP BY 1, 2 ORDER BY stop_count DESC, lat_cell, lon_cell LIMIT 10""")
def _(t):
    return schedule.busiest_cells(t.stops)


@query("longest_routes", """
SELECT r.route_short_name, r.route_long_name, COUNT(DISTINCT st.stop_id) AS unique_stops
FROM routes r JOIN trips t ON r.route_id = t.route_id JOIN stop_times st ON t.trip_id = st.trip_id
GROUP BY r.route_short_name, r.route_long_name
ORDER BY unique_stops DESC, r.route_short_name, r.route_long_name LIMIT 10""")
def _(t):
    return schedule.longest_routes(t.routes, t.trips, t.stop_times)


@query("stop_density", """
SELECT ROUND(stop_lat, 2) AS lat_cell, ROUND(stop_lon, 2) AS lon_cell, COUNT(*) AS stop_count FROM stops
GROUP BY 1, 2""")
def _(t):
    return schedule.stop_density(t.stops)


@query("coverage_summary", f"""
WITH cells AS (SELECT ROUND(stop_lat, 2) AS lat, ROUND(stop_lon, 2) AS lon, COUNT(*) AS n FROM stops GROUP BY 1, 2)
SELECT COUNT(*) AS total_cells, COUNT(*) FILTER (WHERE n >= 20) AS high_cells,
  COUNT(*) FILTER (WHERE n BETWEEN 5 AND 19) AS medium_cells, COUNT(*) FILTER (WHERE n BETWEEN 2 AND 4) AS low_cells,
  COUNT(*) FILTER (WHERE n = 1) AS desert_cells, COUNT(*) FILTER (WHERE n < 5) AS poor_cells,
  {R6('100e0 * COUNT(*) FILTER (WHERE n < 5) / COUNT(*)')} AS poor_percent,
  {R6('100e0 * COUNT(*) FILTER (WHERE n = 1) / COUNT(*)')} AS desert_percent,
  CASE WHEN COUNT(*) FILTER (WHERE n = 1) > 0 THEN MAX(n) FILTER (WHERE n >= 20) ELSE 0 END AS best_to_desert_ratio,
  {R6('AVG(n)')} AS avg_stops_per_cell FROM cells""")
def _(t):
    summary = schedule.coverage_summary(t.stops)
    return summary.withColumns({
        c: rounded(F.col(c)) for c in ("poor_percent", "desert_percent", "avg_stops_per_cell")})


@query("fleet_stats", f"""
SELECT COUNT(DISTINCT vehicle_id) AS active_vehicles, COUNT(DISTINCT route_id) AS routes_covered,
  {R6('AVG(speed * 3.6e0)')} AS avg_speed_kmh, {R6('MAX(speed * 3.6e0)')} AS max_speed_kmh
FROM silver_positions WHERE speed IS NOT NULL""")
def _(t):
    stats = fleet.fleet_stats(silver_filter(t.positions, as_of=AS_OF))
    return stats.withColumns({c: rounded(F.col(c)) for c in ("avg_speed_kmh", "max_speed_kmh")})


@query("layer_metrics", f"""
WITH counts AS (SELECT (SELECT COUNT(*) FROM vehicle_positions) AS bronze_vehicle_positions,
  (SELECT COUNT(*) FROM trip_updates) AS bronze_trip_updates, (SELECT COUNT(*) FROM weather) AS bronze_weather,
  (SELECT COUNT(*) FROM silver_positions) AS silver_vehicle_positions,
  (SELECT COUNT(*) FROM ({GOLD_SQL.format("silver_positions")})) AS gold_hourly_metrics)
SELECT *, {R6('silver_vehicle_positions / bronze_vehicle_positions')} AS data_quality_rate FROM counts""")
def _(t):
    silver = silver_filter(t.positions, as_of=AS_OF)
    metrics = layer_metrics(t.positions, t.trip_updates, t.weather, silver, fleet.gold_hourly(silver))
    return metrics.withColumn("data_quality_rate", rounded(F.col("data_quality_rate")))


@query("feed_stats", f"""
WITH counts AS (SELECT (SELECT COUNT(*) FROM events) AS total_polls, (SELECT COUNT(*) FROM events) AS successful_polls,
  (SELECT 2 * COUNT(*) FROM events) AS total_entities,
  (SELECT COUNT(*) FROM flat_vehicles WHERE NOT {bad_sql(VEHICLE_RULES_FEED_SQL)})
    + (SELECT COUNT(*) FROM flat_updates WHERE NOT {bad_sql(UPDATE_RULES_SQL)}) AS valid_entities,
  (SELECT COUNT(*) FROM events WHERE event_id % 11 <> 0)
    - (SELECT COUNT(*) FROM flat_vehicles WHERE NOT {bad_sql(VEHICLE_RULES_FEED_SQL)}) AS invalid_entities,
  (SELECT COUNT(*) FROM events WHERE event_id % 11 <> 0) + (SELECT COUNT(*) FROM flat_updates) AS all_rows)
SELECT total_polls, successful_polls, total_entities, valid_entities, invalid_entities,
  successful_polls / total_polls AS success_rate, {R6('valid_entities / total_entities')} AS validation_rate,
  {R6('valid_entities / all_rows')} AS row_validation_rate FROM counts""")
def _(t):
    stats = feed_stats(t.feed, agency_id="city", as_of="feed")
    return stats.withColumns({c: rounded(F.col(c)) for c in ("validation_rate", "row_validation_rate")})
