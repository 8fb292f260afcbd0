"""Queries for joins and spatial operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import query
from checks.functions import CENTRE, CENTRE_DISTANCE_SQL, R3, R6
from checks.views import AS_OF, rounded
from headway.operators import coverage, schedule, spatial, weather
from headway.operators.medallion import first_batch_only, silver_filter, upsert
from headway.operators.fleet import gold_hourly

# the nearest stop of every grid point, over all pairs
GRID_SQL = """
grid AS (SELECT 45.40e0 + CAST(i AS DOUBLE) * 0.02e0 AS lat, -122.80e0 + CAST(j AS DOUBLE) * 0.02e0 AS lon
  FROM range(12) a(i), range(25) b(j)),
nearest AS (SELECT lat, lon, MIN(SQRT(POW(stop_lat - lat, 2) + POW(stop_lon - lon, 2)) * 111) AS km
  FROM grid LEFT JOIN stops ON ABS(stop_lat - lat) < 0.01e0 AND ABS(stop_lon - lon) < 0.01e0 GROUP BY lat, lon)"""
# the nearest other stop of every stop, over all pairs
NEIGHBOUR_SQL = """
numbered AS MATERIALIZED (SELECT *, ROW_NUMBER() OVER () AS nth FROM stops),
neighbours AS (SELECT s.nth, s.stop_id, s.stop_name, s.stop_lat, s.stop_lon,
  MIN(SQRT(POW(s.stop_lat - o.stop_lat, 2) + POW(s.stop_lon - o.stop_lon, 2)) * 111) AS km
  FROM numbered s LEFT JOIN numbered o ON s.nth <> o.nth AND ABS(s.stop_lat - o.stop_lat) < 0.05e0
    AND ABS(s.stop_lon - o.stop_lon) < 0.05e0 GROUP BY ALL)"""


def asof_sql(rows: str, keys: list[str], observations: str) -> str:
    """Latest observation per row: one observation per key and instant, then an as-of join."""
    key_list = ", ".join(keys)
    on = " AND ".join(f"p.{k} = w.{k}" for k in keys)
    fresh = "p.timestamp - w.observation_time <= INTERVAL '3600' SECOND"
    return f"""
instants AS (SELECT {key_list}, observation_time, weather_condition, weather_code, temperature_celsius,
    precipitation_mm, wind_speed_kmh,
    ROW_NUMBER() OVER (PARTITION BY {key_list}, observation_time ORDER BY weather_condition DESC,
      weather_code DESC, temperature_celsius DESC, precipitation_mm DESC, wind_speed_kmh DESC) AS nth
  FROM {observations}),
correlated AS (SELECT p.*, CASE WHEN {fresh} THEN w.observation_time END AS observation_time,
    CASE WHEN {fresh} THEN w.weather_condition END AS weather_condition,
    CASE WHEN {fresh} THEN w.weather_code END AS weather_code,
    CASE WHEN {fresh} THEN w.temperature_celsius END AS temperature_celsius
  FROM {rows} p ASOF LEFT JOIN (SELECT * FROM instants WHERE nth = 1) w
    ON {on} AND p.timestamp >= w.observation_time)"""


SEVERE_SQL = "weather_condition IN ('HEAVY_RAIN', 'SNOW', 'THUNDERSTORM')"


@query("route_stop_join", """
SELECT route_short_name, route_long_name, t.trip_id, st.stop_id FROM routes r JOIN trips t ON r.route_id = t.route_id
JOIN stop_times st ON t.trip_id = st.trip_id""")
def _(t):
    joined = schedule.route_stop_join(t.routes, t.trips, t.stop_times)
    return joined.select("route_short_name", "route_long_name", "trip_id", "stop_id")


@query("silver_anti_join", """
SELECT event_id, vehicle_id, timestamp FROM silver_positions WHERE vehicle_id NOT IN (
  SELECT vehicle_id FROM vehicle_positions WHERE timestamp < TIMESTAMP '2024-01-01 06:00:00')""")
def _(t):
    seen = t.positions.where("timestamp < TIMESTAMP '2024-01-01 06:00:00'")
    return first_batch_only(silver_filter(t.positions, as_of=AS_OF), seen).select(
        "event_id", "vehicle_id", "timestamp")


@query("radius_search", f"""
SELECT vehicle_id, route_id, latitude, longitude, speed, timestamp, {R3('d')} AS distance_meters
FROM (SELECT *, {CENTRE_DISTANCE_SQL} AS d FROM vehicle_positions) WHERE d <= 1000 ORDER BY d""")
def _(t):
    found = spatial.radius_search(t.positions, lat=CENTRE[0], lon=CENTRE[1], radius_m=1000.0)
    return found.select("vehicle_id", "route_id", "latitude", "longitude", "speed", "timestamp",
                        rounded(F.col("distance_meters"), 3).alias("distance_meters"))


@query("radius_join", f"""
SELECT point_id, event_id, {R3('d')} AS distance_meters FROM (SELECT point_id, event_id,
  6371000e0 * 2 * ASIN(SQRT(POW(SIN((RADIANS(point_lat) - RADIANS(latitude)) / 2), 2) + COS(RADIANS(point_lat))
    * COS(RADIANS(latitude)) * POW(SIN((RADIANS(point_lon) - RADIANS(longitude)) / 2), 2))) AS d
  FROM points JOIN vehicle_positions ON ABS(point_lat - latitude) < 0.01e0) WHERE d <= 500""")
def _(t):
    pairs = spatial.radius_join(t.points, t.positions, radius_m=500.0)
    return pairs.select("point_id", "event_id", rounded(F.col("distance_meters"), 3).alias("distance_meters"))


@query("gap_nearest_stop", f"""
WITH {GRID_SQL}
SELECT {R6('lat')} AS lat, {R6('lon')} AS lon, {R6('km')} AS distance_km,
  km IS NULL AS is_unbounded FROM nearest""")
def _(t):
    found = coverage.gap_nearest_stop(t.stops)
    return found.select(*[rounded(F.col(c)).alias(c) for c in ("lat", "lon", "distance_km")], "is_unbounded")


@query("coverage_gaps", f"""
WITH {GRID_SQL}
SELECT {R6('lat')} AS lat, {R6('lon')} AS lon, {R6('km')} AS distance_km,
  km IS NULL AS is_unbounded, CASE WHEN km IS NULL OR km > 1.5e0 THEN 'severe' ELSE 'desert' END AS severity,
  {R6('km * 0.621e0')} AS miles, {R6('km * 12.5e0')} AS walk_minutes
FROM nearest WHERE km IS NULL OR km > 0.8e0 ORDER BY km DESC NULLS FIRST""")
def _(t):
    found = coverage.coverage_gaps(t.stops)
    return found.select(*[rounded(F.col(c)).alias(c) for c in ("lat", "lon", "distance_km", "miles", "walk_minutes")],
                        "is_unbounded", "severity")


@query("stop_nearest_neighbour", f"""
WITH {NEIGHBOUR_SQL}
SELECT stop_id, {R6('km')} AS distance_km, km IS NULL AS is_unbounded FROM neighbours""")
def _(t):
    found = coverage.stop_nearest_neighbour(t.stops)
    return found.select("stop_id", rounded(F.col("distance_km")).alias("distance_km"), "is_unbounded")


@query("isolated_stops", f"""
WITH {NEIGHBOUR_SQL}
SELECT stop_id, stop_name, {R6('stop_lat')} AS stop_lat, {R6('stop_lon')} AS stop_lon,
  {R6('km')} AS distance_km FROM neighbours WHERE km IS NULL OR km > 1.0e0""")
def _(t):
    found = coverage.isolated_stops(t.stops)
    return found.select("stop_id", "stop_name",
                        *[rounded(F.col(c)).alias(c) for c in ("stop_lat", "stop_lon", "distance_km")])


@query("desert_summary", f"""
WITH {GRID_SQL}, {NEIGHBOUR_SQL},
gaps AS (SELECT * FROM nearest WHERE km IS NULL OR km > 0.8e0)
SELECT COUNT(*) AS gaps, COUNT(*) FILTER (WHERE km IS NULL OR km > 1.5e0) AS severe_gaps,
  COUNT(*) FILTER (WHERE km IS NULL) AS unbounded_gaps, {R6('MAX(km)')} AS largest_gap_km,
  (SELECT COUNT(*) FROM neighbours WHERE km IS NULL OR km > 1.0e0) AS isolated_stops,
  (SELECT COUNT(*) FROM routes WHERE route_type = 3) AS bus_routes,
  (SELECT COUNT(*) FROM routes WHERE route_type = 0) AS tram_routes FROM gaps""")
def _(t):
    summary = coverage.desert_summary(t.stops, t.routes)
    return summary.withColumn("largest_gap_km", rounded(F.col("largest_gap_km")))


@query("map_layers", f"""
WITH {GRID_SQL}, {NEIGHBOUR_SQL}
SELECT 'gaps' AS layer, {R6('lat')} AS lat, {R6('lon')} AS lon, CAST(NULL AS VARCHAR) AS label,
  {R6('km')} AS size FROM nearest WHERE km IS NULL OR km > 0.8e0
UNION ALL SELECT 'isolated_stops', {R6('stop_lat')}, {R6('stop_lon')}, stop_name, {R6('km')}
  FROM neighbours WHERE km IS NULL OR km > 1.0e0
UNION ALL SELECT * FROM (SELECT 'stop_sample', {R6('stop_lat')}, {R6('stop_lon')}, stop_name,
  CAST(NULL AS DOUBLE) FROM stops ORDER BY stop_lat, stop_lon, stop_id, stop_name LIMIT 500)
UNION ALL SELECT 'coverage_cells', {R6('lat_cell - 0.005e0')}, {R6('lon_cell - 0.005e0')},
  CASE WHEN n >= 20 THEN 'high' WHEN n >= 5 THEN 'medium' WHEN n >= 2 THEN 'low' ELSE 'desert' END,
  CAST(n AS DOUBLE) FROM (SELECT ROUND(stop_lat, 2) AS lat_cell, ROUND(stop_lon, 2) AS lon_cell, COUNT(*) AS n
  FROM stops GROUP BY 1, 2)""")
def _(t):
    from headway.plans.map_layers import map_layers

    layers = map_layers(t.stops)
    none = F.lit(None)
    shapes = {
        "gaps": ("lat", "lon", none.cast("string"), F.col("distance_km")),
        "isolated_stops": ("stop_lat", "stop_lon", F.col("stop_name"), F.col("distance_km")),
        "stop_sample": ("stop_lat", "stop_lon", F.col("stop_name"), none.cast("double")),
        "coverage_cells": ("south", "west", F.col("coverage"), F.col("stop_count").cast("double")),
    }
    result = None
    for name, (lat, lon, label, size) in shapes.items():
        one = layers[name].select(F.lit(name).alias("layer"), rounded(F.col(lat)).alias("lat"),
                                  rounded(F.col(lon)).alias("lon"), label.alias("label"),
                                  rounded(size).alias("size"))
        result = one if result is None else result.unionByName(one)
    return result


@query("weather_correlate", f"""
WITH {asof_sql('vehicle_positions', ['agency_id'], 'weather')}
SELECT event_id, agency_id, timestamp, observation_time, weather_condition, weather_code,
  {R6('temperature_celsius')} AS temperature_celsius, COALESCE({SEVERE_SQL}, FALSE) AS is_severe FROM correlated""")
def _(t):
    joined = weather.weather_correlate(t.positions, t.weather)
    return joined.select("event_id", "agency_id", "timestamp", "observation_time", "weather_condition",
                         "weather_code", rounded(F.col("temperature_celsius")).alias("temperature_celsius"),
                         F.coalesce("is_severe", F.lit(False)).alias("is_severe"))


@query("weather_grid_correlate", f"""
WITH keyed AS (SELECT *, printf('%.2f,%.2f', latitude, longitude) AS location_key FROM vehicle_positions),
stations AS (SELECT *, printf('%.2f,%.2f', latitude, longitude) AS location_key FROM weather),
{asof_sql('keyed', ['location_key'], 'stations')}
SELECT event_id, location_key, observation_time, weather_condition, COALESCE({SEVERE_SQL}, FALSE) AS is_severe FROM correlated""")
def _(t):
    joined = weather.weather_grid_correlate(t.positions, t.weather)
    return joined.select("event_id", "location_key", "observation_time", "weather_condition",
                         F.coalesce("is_severe", F.lit(False)).alias("is_severe"))


@query("weather_impact", f"""
WITH {asof_sql('vehicle_positions', ['agency_id'], 'weather')}
SELECT route_id, COALESCE(weather_condition, 'UNKNOWN') AS weather_condition,
  COALESCE(BOOL_OR({SEVERE_SQL}), FALSE) AS is_severe, COUNT(*) AS observations,
  {R6('AVG(speed * 3.6e0)')} AS avg_speed_kmh
FROM correlated WHERE route_id IS NOT NULL GROUP BY 1, 2""")
def _(t):
    impact = weather.weather_impact(t.positions, t.weather)
    return impact.withColumn("avg_speed_kmh", rounded(F.col("avg_speed_kmh")))




@query("delay_by_weather", f"""
WITH moved AS (SELECT agency_id, route_id, arrival_delay,
  TIMESTAMP '2024-01-01' + to_days(CAST(day(timestamp) AS INT) - 1) AS timestamp FROM trip_updates),
{asof_sql('moved', ['agency_id'], 'weather')}
SELECT route_id, COALESCE(weather_condition, 'UNKNOWN') AS weather_condition, COUNT(*) AS observations,
  {R6('AVG(arrival_delay)')} AS avg_delay_seconds, MAX(arrival_delay) AS max_delay_seconds
FROM correlated GROUP BY 1, 2""")
def _(t):
    # all shipping dates moved into the one month that has weather
    moved = t.trip_updates.withColumn("timestamp", F.expr(
        "TIMESTAMP '2024-01-01' + make_dt_interval(day(timestamp) - 1)"))
    delays = weather.delay_by_weather(moved, t.weather)
    return delays.withColumn("avg_delay_seconds", rounded(F.col("avg_delay_seconds")))


@query("schedule_validity", """
SELECT trip_id, route_id, stop_sequence FROM (SELECT *, CAST(CAST(route_id AS BIGINT) + CAST(trip_id AS BIGINT) % 3
  AS VARCHAR) AS named FROM trip_updates) WHERE named NOT IN (SELECT route_id FROM routes)""")
def _(t):
    # a trip names a route up to two numbers beyond its own, so some names are unknown
    named = t.trip_updates.select(
        "trip_id", F.col("route_id").alias("own"), "stop_sequence",
        (F.col("route_id").cast("bigint") + F.col("trip_id").cast("bigint") % 3).cast("string").alias("route_id"))
    return schedule.unknown_routes(named, t.routes).select(
        "trip_id", F.col("own").alias("route_id"), "stop_sequence")


@query("schedule_enrich", """
SELECT trip_id, stop_sequence, u.route_id, u.stop_id, route_short_name, route_long_name, stop_name
FROM trip_updates u LEFT JOIN routes r ON u.route_id = r.route_id LEFT JOIN stops s ON u.stop_id = s.stop_id""")
def _(t):
    named = schedule.with_schedule_names(t.trip_updates, t.routes, t.stops)
    return named.select("trip_id", "stop_sequence", "route_id", "stop_id", "route_short_name", "route_long_name",
                        "stop_name")


GOLD_SQL = f"""
SELECT DATE_TRUNC('hour', timestamp) AS hour_timestamp, agency_id, route_id,
  COUNT(DISTINCT vehicle_id) AS total_vehicles, {R6('AVG(speed * 3.6e0)')} AS avg_speed_kmh,
  {R6('MAX(speed * 3.6e0)')} AS max_speed_kmh,
  {R6("AVG(CASE WHEN congestion_level = 'RUNNING_SMOOTHLY' THEN 1 WHEN congestion_level = 'STOP_AND_GO' THEN 2 WHEN congestion_level = 'CONGESTION' THEN 3 WHEN congestion_level = 'SEVERE_CONGESTION' THEN 4 ELSE 0 END)")}
    AS avg_congestion_score, COUNT(*) AS total_observations
FROM {{}} WHERE route_id IS NOT NULL GROUP BY 1, 2, 3"""


def rounded_gold(df):
    return df.withColumns({
        c: rounded(F.col(c)) for c in ("avg_speed_kmh", "max_speed_kmh", "avg_congestion_score")})


@query("upsert_gold", f"""
WITH old AS ({GOLD_SQL.format("vehicle_positions")}), new AS ({GOLD_SQL.format("silver_positions")})
SELECT * FROM new UNION ALL SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE
  new.hour_timestamp = old.hour_timestamp AND new.agency_id = old.agency_id AND new.route_id = old.route_id)""")
def _(t):
    old, new = gold_hourly(t.positions), gold_hourly(silver_filter(t.positions, as_of=AS_OF))
    return rounded_gold(upsert(old, new, ["hour_timestamp", "agency_id", "route_id"]))
