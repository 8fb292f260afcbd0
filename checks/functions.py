"""Queries for the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import query
from checks.views import AS_OF, WEATHER_CONDITION_SQL, rounded, rounded_sql
from headway.functions import codes, geo, times
from headway.operators.flatten import flatten_trip_updates, flatten_vehicles
from headway.operators.schedule import stop_density



def R6(expression: str) -> str:  # noqa: N802
    return rounded_sql(expression)


def R3(expression: str) -> str:  # noqa: N802
    return rounded_sql(expression, 3)


HAVERSINE_SQL = (
    "6371000e0 * 2 * ASIN(SQRT(POW(SIN((RADIANS({lat}) - RADIANS(latitude)) / 2), 2) + COS(RADIANS({lat}))"
    " * COS(RADIANS(latitude)) * POW(SIN((RADIANS({lon}) - RADIANS(longitude)) / 2), 2)))"
)
CENTRE = (45.5152, -122.6784)
CENTRE_DISTANCE_SQL = HAVERSINE_SQL.format(lat="45.5152e0", lon="-122.6784e0")
POSITION_COLUMNS = (
    "vehicle_id, trip_id, route_id, latitude, longitude, bearing, speed, timestamp, current_stop_sequence, "
    "stop_id, current_status, congestion_level, occupancy_status, agency_id, feed_timestamp"
)


@query("flatten_vehicles", f"SELECT {POSITION_COLUMNS} FROM flat_vehicles")
def _(t):
    return flatten_vehicles(t.feed, agency_id="city")


@query("flatten_trip_updates", "SELECT * FROM flat_updates")
def _(t):
    return flatten_trip_updates(t.feed, agency_id="city")


@query("presence_fallbacks", """
SELECT 'vehicle' AS record, vehicle_id AS id, timestamp, COUNT(*) AS n FROM flat_vehicles GROUP BY ALL
UNION ALL
SELECT 'stop', concat(trip_id, '/', CAST(stop_sequence AS VARCHAR), '/', stop_id), timestamp, COUNT(*)
FROM flat_updates GROUP BY ALL""")
def _(t):
    vehicles = flatten_vehicles(t.feed, agency_id="city").select(
        F.lit("vehicle").alias("record"), F.col("vehicle_id").alias("id"), "timestamp")
    stops = flatten_trip_updates(t.feed, agency_id="city").select(
        F.lit("stop").alias("record"),
        F.concat_ws("/", "trip_id", F.col("stop_sequence").cast("string"), "stop_id").alias("id"), "timestamp")
    return vehicles.unionByName(stops).groupBy("record", "id", "timestamp").agg(F.count("*").alias("n"))


@query("decode_enums", """
SELECT current_status, congestion_level, occupancy_status, CAST(NULL AS VARCHAR) AS schedule_relationship,
  COUNT(*) AS n FROM flat_vehicles GROUP BY ALL
UNION ALL
SELECT NULL, NULL, NULL, schedule_relationship, COUNT(*) FROM flat_updates GROUP BY ALL""")
def _(t):
    vehicles = flatten_vehicles(t.feed, agency_id="city").select(
        "current_status", "congestion_level", "occupancy_status",
        F.lit(None).cast("string").alias("schedule_relationship"))
    stops = flatten_trip_updates(t.feed, agency_id="city").select("schedule_relationship")
    return vehicles.unionByName(stops, allowMissingColumns=True).groupBy(
        "current_status", "congestion_level", "occupancy_status", "schedule_relationship"
    ).agg(F.count("*").alias("n"))


@query("epoch_to_ts", """
SELECT event_id, make_timestamp(1000000 * sec) AS moment, strftime(make_timestamp(1000000 * sec),
  '%Y-%m-%dT%H:%M:%SZ') AS text FROM feed_base""")
def _(t):
    moment = times.epoch_to_ts(F.unix_seconds(F.col("timestamp")))
    return t.positions.select("event_id", moment.alias("moment"), times.iso_utc(moment).alias("text"))


@query("ensure_utc", """
SELECT event_id, ts AS assumed_utc, ts - INTERVAL '2' HOUR AS from_zone FROM events""")
def _(t):
    return t.raw("events").select(
        "event_id", times.ensure_utc(F.col("ts")).alias("assumed_utc"),
        times.ensure_utc(F.col("ts"), "+02:00").alias("from_zone"))


@query("speed_kmh", f"SELECT event_id, {R6('speed * 3.6e0')} AS kmh FROM vehicle_positions")
def _(t):
    return t.positions.select("event_id", rounded(codes.speed_kmh(F.col("speed"))).alias("kmh"))


@query("congestion_score", """
SELECT event_id, CASE WHEN congestion_level = 'RUNNING_SMOOTHLY' THEN 1 WHEN congestion_level = 'STOP_AND_GO' THEN 2
  WHEN congestion_level = 'CONGESTION' THEN 3 WHEN congestion_level = 'SEVERE_CONGESTION' THEN 4 ELSE 0 END AS score
FROM vehicle_positions""")
def _(t):
    return t.positions.select("event_id", codes.congestion_score(F.col("congestion_level")).alias("score"))


@query("weather_condition", f"SELECT event_id, {WEATHER_CONDITION_SQL} AS condition FROM weather_raw")
def _(t):
    return t.weather.select("event_id", codes.weather_condition(F.col("weather_code")).alias("condition"))


@query("severe_weather", """
SELECT event_id, weather_condition IN ('HEAVY_RAIN', 'SNOW', 'THUNDERSTORM') AS severe FROM weather""")
def _(t):
    return t.weather.select("event_id", codes.is_severe(F.col("weather_condition")).alias("severe"))


@query("route_type_label", """
SELECT route_id, CASE route_type WHEN 0 THEN 'Tram/Light Rail' WHEN 1 THEN 'Subway/Metro' WHEN 3 THEN 'Bus'
  ELSE 'Other' END AS label FROM routes""")
def _(t):
    return t.routes.select("route_id", codes.route_type_label(F.col("route_type")).alias("label"))


@query("haversine", f"SELECT event_id, {R3(CENTRE_DISTANCE_SQL)} AS metres FROM vehicle_positions")
def _(t):
    metres = geo.haversine_m(*CENTRE, F.col("latitude"), F.col("longitude"))
    return t.positions.select("event_id", rounded(metres, 3).alias("metres"))


@query("flat_distance_km", f"""
SELECT event_id, {R6('SQRT(POW(latitude - 45.5152e0, 2) + POW(longitude - -122.6784e0, 2)) * 111')} AS km
FROM vehicle_positions""")
def _(t):
    km = geo.flat_km(F.col("latitude"), F.col("longitude"), *CENTRE)
    return t.positions.select("event_id", rounded(km).alias("km"))


@query("round_cell", """
SELECT event_id, ROUND(latitude, 2) AS lat_cell, ROUND(longitude, 2) AS lon_cell FROM vehicle_positions""")
def _(t):
    return t.positions.select(
        "event_id", geo.round_cell(F.col("latitude")).alias("lat_cell"),
        geo.round_cell(F.col("longitude")).alias("lon_cell"))


@query("grid_cell", """
SELECT event_id, CAST(FLOOR((latitude - 45.2e0) / (45.7e0 - 45.2e0) * 20) AS DOUBLE) AS lat_cell,
  CAST(FLOOR((longitude - -123e0) / (-122.3e0 - -123e0) * 20) AS DOUBLE) AS lon_cell FROM vehicle_positions""")
def _(t):
    return t.positions.select(
        "event_id", geo.grid_cell(F.col("latitude"), 45.2, 45.7, 20).alias("lat_cell"),
        geo.grid_cell(F.col("longitude"), -123.0, -122.3, 20).alias("lon_cell"))


@query("cell_origin", f"""
SELECT event_id, {R6('45.2e0 + (FLOOR((latitude - 45.2e0) / (45.7e0 - 45.2e0) * 20) / 20) * (45.7e0 - 45.2e0)')}
  AS origin_lat FROM vehicle_positions""")
def _(t):
    cell = geo.grid_cell(F.col("latitude"), 45.2, 45.7, 20)
    return t.positions.select("event_id", rounded(geo.cell_origin(cell, 45.2, 45.7, 20)).alias("origin_lat"))


COVERAGE_SQL = """CASE WHEN stop_count >= 20 THEN 'high' WHEN stop_count >= 5 THEN 'medium'
  WHEN stop_count >= 2 THEN 'low' ELSE 'desert' END"""


@query("coverage_class", f"""
SELECT lat_cell, lon_cell, {COVERAGE_SQL} AS coverage FROM (SELECT ROUND(stop_lat, 2) AS lat_cell,
  ROUND(stop_lon, 2) AS lon_cell, COUNT(*) AS stop_count FROM stops GROUP BY 1, 2)""")
def _(t):
    return stop_density(t.stops).select(
        "lat_cell", "lon_cell", codes.coverage_class(F.col("stop_count")).alias("coverage"))


@query("gap_severity", f"""
SELECT event_id, CASE WHEN {CENTRE_DISTANCE_SQL} / 1000 > 1.5e0 THEN 'severe' ELSE 'desert' END AS severity
FROM vehicle_positions""")
def _(t):
    km = geo.haversine_m(*CENTRE, F.col("latitude"), F.col("longitude")) / 1000
    return t.positions.select("event_id", codes.gap_severity(km).alias("severity"))


@query("walk_units", f"""
SELECT event_id, {R6('speed * 0.621e0')} AS miles, {R6('speed * 12.5e0')} AS minutes
FROM vehicle_positions""")
def _(t):
    return t.positions.select(
        "event_id", rounded(codes.miles(F.col("speed"))).alias("miles"),
        rounded(codes.walk_minutes(F.col("speed"))).alias("minutes"))


@query("location_key", """
SELECT event_id, printf('%.2f,%.2f', latitude, longitude) AS key FROM vehicle_positions""")
def _(t):
    return t.positions.select(
        "event_id", times.location_key(F.col("latitude"), F.col("longitude")).alias("key"))


@query("alert_id", f"""
SELECT event_id, concat('dqa_', strftime(TIMESTAMP '{AS_OF}', '%Y%m%d_%H%M%S'), '_',
  COALESCE(vehicle_id, 'unknown')) AS alert_id FROM vehicle_records""")
def _(t):
    return t.records.select(
        "event_id", times.alert_id(times.moment(AS_OF), F.col("vehicle_id")).alias("alert_id"))
