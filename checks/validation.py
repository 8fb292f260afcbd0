"""Queries for contract checks, filters and the quarantine."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import query
from checks.views import AS_OF
from headway.operators import validate as V
from headway.operators.medallion import silver_filter
from headway.operators.schedule import monitored_routes, stops_in_box
from headway.plans.schedule_report import DOWNTOWN

AS_OF_SQL = f"TIMESTAMP '{AS_OF}'"

VEHICLE_RULES_SQL = [
    ("vehicle_id_missing", "COALESCE(vehicle_id, '') = ''"),
    ("latitude_out_of_range", "latitude IS NULL OR NOT (latitude BETWEEN -90 AND 90)"),
    ("longitude_out_of_range", "longitude IS NULL OR NOT (longitude BETWEEN -180 AND 180)"),
    ("bearing_out_of_range", "bearing IS NOT NULL AND NOT (bearing >= 0 AND bearing < 360)"),
    ("speed_out_of_range", "speed IS NOT NULL AND NOT (speed BETWEEN 0 AND 33.3e0)"),
    ("stop_sequence_negative", "current_stop_sequence IS NOT NULL AND current_stop_sequence < 0"),
    ("current_status_unknown",
     "current_status IS NOT NULL AND current_status NOT IN ('INCOMING_AT', 'STOPPED_AT', 'IN_TRANSIT_TO')"),
    ("congestion_level_unknown", "congestion_level IS NOT NULL AND congestion_level NOT IN ("
     "'UNKNOWN_CONGESTION_LEVEL', 'RUNNING_SMOOTHLY', 'STOP_AND_GO', 'CONGESTION', 'SEVERE_CONGESTION')"),
    ("occupancy_status_unknown", "occupancy_status IS NOT NULL AND occupancy_status NOT IN ('EMPTY', "
     "'MANY_SEATS_AVAILABLE', 'FEW_SEATS_AVAILABLE', 'STANDING_ROOM_ONLY', 'CRUSHED_STANDING_ROOM_ONLY', 'FULL', "
     "'NOT_ACCEPTING_PASSENGERS')"),
    ("agency_id_missing", "agency_id IS NULL"),
    ("feed_timestamp_missing", "feed_timestamp IS NULL"),
    ("timestamp_missing", "timestamp IS NULL"),
    ("position_stale", f"timestamp IS NOT NULL AND timestamp < {AS_OF_SQL} - INTERVAL '300' SECOND"),
]
# age measured against the feed time instead
VEHICLE_RULES_FEED_SQL = VEHICLE_RULES_SQL[:-1] + [
    ("position_stale", "timestamp < feed_timestamp - INTERVAL '300' SECOND"),
]
UPDATE_RULES_SQL = [
    ("trip_id_missing", "COALESCE(trip_id, '') = ''"),
    ("stop_id_missing", "COALESCE(stop_id, '') = ''"),
    ("stop_sequence_negative", "stop_sequence IS NULL OR stop_sequence < 0"),
    ("arrival_delay_out_of_range", "arrival_delay IS NOT NULL AND NOT (arrival_delay BETWEEN -3600 AND 7200)"),
    ("departure_delay_out_of_range", "departure_delay IS NOT NULL AND NOT (departure_delay BETWEEN -3600 AND 7200)"),
    ("arrival_after_departure", "COALESCE(arrival_time > departure_time, FALSE)"),
    ("schedule_relationship_unknown", "schedule_relationship IS NULL OR schedule_relationship NOT IN "
     "('SCHEDULED', 'SKIPPED', 'NO_DATA', 'UNSCHEDULED')"),
    ("agency_id_missing", "agency_id IS NULL"),
    ("timestamp_missing", "timestamp IS NULL"),
]
WEATHER_RULES_SQL = [
    ("latitude_out_of_range", "latitude IS NULL OR NOT (latitude BETWEEN -90 AND 90)"),
    ("longitude_out_of_range", "longitude IS NULL OR NOT (longitude BETWEEN -180 AND 180)"),
    ("temperature_out_of_range", "temperature_celsius IS NULL OR NOT (temperature_celsius BETWEEN -50 AND 60)"),
    ("precipitation_negative", "precipitation_mm IS NULL OR precipitation_mm < 0"),
    ("wind_speed_out_of_range", "wind_speed_kmh IS NULL OR NOT (wind_speed_kmh BETWEEN 0 AND 200)"),
    ("weather_code_out_of_range", "weather_code IS NULL OR NOT (weather_code BETWEEN 0 AND 99)"),
    ("weather_condition_unknown", "weather_condition IS NULL"),
    ("agency_id_missing", "agency_id IS NULL"),
    ("observation_time_missing", "observation_time IS NULL"),
    ("observation_stale",
     f"observation_time IS NOT NULL AND observation_time < {AS_OF_SQL} - INTERVAL '3600' SECOND"),
]


def names_sql(rules) -> str:
    parts = ", ".join(f"CASE WHEN {bad} THEN '{name}' END" for name, bad in rules)
    return f"concat_ws(';', {parts})"


def bad_sql(rules) -> str:
    return "(" + " OR ".join(f"({bad})" for _, bad in rules) + ")"


def case_sql(rules, values) -> str:
    return "CASE " + " ".join(f"WHEN {bad} THEN {value}" for (_, bad), value in zip(rules, values)) + " END"


def listed(df, *ids):
    return df.select(*ids, F.array_join("violations", ";").alias("violations"),
                     (F.size("violations") == 0).alias("is_valid"))


@query("validate_vehicle", f"""
SELECT event_id, {names_sql(VEHICLE_RULES_SQL)} AS violations, NOT {bad_sql(VEHICLE_RULES_SQL)} AS is_valid
FROM vehicle_records""")
def _(t):
    return listed(V.validate_vehicles(t.records, as_of=AS_OF), "event_id")


@query("validate_trip_update", f"""
SELECT trip_id, stop_sequence, {names_sql(UPDATE_RULES_SQL)} AS violations,
  NOT {bad_sql(UPDATE_RULES_SQL)} AS is_valid FROM trip_updates""")
def _(t):
    return listed(V.validate_trip_updates(t.trip_updates), "trip_id", "stop_sequence")


@query("validate_weather", f"""
SELECT event_id, {names_sql(WEATHER_RULES_SQL)} AS violations, NOT {bad_sql(WEATHER_RULES_SQL)} AS is_valid
FROM weather""")
def _(t):
    return listed(V.validate_weather(t.weather, as_of=AS_OF), "event_id")


@query("coerce_types", """
SELECT event_id,
  TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(event_id % 90 AS VARCHAR) END AS DOUBLE) AS latitude,
  CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 50 AS INT) END
    AS current_stop_sequence,
  concat_ws(';', CASE WHEN event_id % 7 = 0 THEN 'latitude_not_double' END,
    CASE WHEN event_id % 11 <> 0 AND event_id % 3 = 0 THEN 'current_stop_sequence_not_int' END) AS violations
FROM events""")
def _(t):
    text = t.raw("events").selectExpr(
        "event_id",
        "CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE concat(' ', event_id % 90) END AS latitude",
        "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 3 = 0 THEN concat(event_id % 50, '.5')"
        " WHEN event_id % 3 = 1 THEN concat(event_id % 50, '.0') ELSE CAST(event_id % 50 AS STRING) END"
        " AS current_stop_sequence",
    )
    typed = V.coerce_types(text, {"latitude": "double", "current_stop_sequence": "int"})
    return typed.withColumn("violations", F.array_join("violations", ";"))


@query("silver_filter", "SELECT event_id, vehicle_id, speed, timestamp FROM silver_positions")
def _(t):
    return silver_filter(t.positions, as_of=AS_OF).select("event_id", "vehicle_id", "speed", "timestamp")


@query("bbox_filter", """
SELECT stop_id, stop_name, stop_lat, stop_lon FROM stops WHERE stop_lat BETWEEN 45.50e0 AND 45.53e0
  AND stop_lon BETWEEN -122.69e0 AND -122.66e0 ORDER BY stop_id LIMIT 10""")
def _(t):
    return stops_in_box(t.stops, top=10, **DOWNTOWN)


@query("agency_bounds", """
SELECT event_id, CASE WHEN NOT (latitude BETWEEN min_latitude AND max_latitude)
  OR NOT (longitude BETWEEN min_longitude AND max_longitude) THEN 'outside_agency_bounds' ELSE '' END AS violations
FROM vehicle_positions LEFT JOIN agencies USING (agency_id)""")
def _(t):
    checked = V.check_agency_bounds(t.positions, t.agencies)
    return checked.select("event_id", F.array_join("violations", ";").alias("violations"))


@query("monitored_route_types", """
SELECT route_id, route_type FROM routes WHERE route_type IN (
  SELECT unnest(route_types) FROM agencies WHERE enabled)""")
def _(t):
    return monitored_routes(t.routes, t.agencies).select("route_id", "route_type")


@query("quality_split", f"""
WITH outcomes AS (SELECT {names_sql(VEHICLE_RULES_SQL)} AS names FROM vehicle_records)
SELECT outcome, COUNT(*) AS records FROM (
  SELECT CASE WHEN names = '' THEN 'valid' ELSE 'invalid' END AS outcome FROM outcomes
  UNION ALL SELECT unnest(string_split(names, ';')) FROM outcomes WHERE names <> '') GROUP BY outcome""")
def _(t):
    return V.quality_split(t.records, V.vehicle_rules(AS_OF))


@query("quarantine", f"""
SELECT concat('dqa_', strftime({AS_OF_SQL}, '%Y%m%d_%H%M%S'), '_', COALESCE(vehicle_id, 'unknown')) AS alert_id,
  {case_sql(VEHICLE_RULES_SQL, ["'" + k + "'" for k in ["VALIDATION_ERROR", "GEOGRAPHIC_VIOLATION",
    "GEOGRAPHIC_VIOLATION", "VALIDATION_ERROR", "SPEED_VIOLATION"] + ["VALIDATION_ERROR"] * 7 + ["STALE_DATA"]])}
    AS alert_type,
  'MEDIUM' AS severity, 'vehicle_position' AS entity_type, vehicle_id AS entity_id, agency_id,
  replace({names_sql(VEHICLE_RULES_SQL)}, ';', '; ') AS error_message,
  {case_sql(VEHICLE_RULES_SQL, ["'" + k + "'" for k in ["vehicle_id", "latitude", "longitude", "bearing", "speed",
    "current_stop_sequence", "current_status", "congestion_level", "occupancy_status", "agency_id",
    "feed_timestamp", "timestamp", "timestamp"]])} AS field_name,
  {AS_OF_SQL} AS detected_at
FROM vehicle_records WHERE {bad_sql(VEHICLE_RULES_SQL)}""")
def _(t):
    rows = V.alerts(t.records, V.vehicle_rules(AS_OF), entity_type="vehicle_position",
                    entity_id="vehicle_id", as_of=AS_OF)
    # the text of a number differs between engines, so field_value is left to the tests
    return rows.drop("field_value")
