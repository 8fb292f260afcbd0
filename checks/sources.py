"""Queries for sources, sinks and the table lifecycle; each writes with Spark and reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import query
from checks.functions import POSITION_COLUMNS
from checks.joins import GOLD_SQL, rounded_gold
from checks.views import AS_OF, WEATHER_CONDITION_SQL
from headway import contracts as C
from headway.functions.times import moment
from headway.operators.fleet import gold_hourly
from headway.operators.flatten import flatten_vehicles
from headway.operators.medallion import silver_filter
from headway.sources import schedule, topics, weather
from headway.sources.feed import scan_feed
from headway.sources.tables import Layers, replace_table


def schedule_folder(t) -> str:
    """The schedule tables as CSV files, one folder per file name, as Spark writes them."""
    folder = t.scratch("schedule")
    tables = {"stops": t.stops, "routes": t.routes, "trips": t.trips, "stop_times": t.stop_times}
    for name, table in tables.items():
        table.write.option("header", True).csv(f"{folder}/{name}.txt")
    return folder


def layers(t) -> Layers:
    return Layers(t.spark, t.scratch("layers"), prefix=f"t{uuid.uuid4().hex[:12]}_").init()


@query("scan_gtfs_csv", "SELECT trip_id, stop_sequence, stop_id FROM stop_times")
def _(t):
    path = t.scratch("csv")
    t.stop_times.write.option("header", True).csv(path)
    return schedule.scan_gtfs_csv(t.spark, path, "trip_id STRING, stop_sequence INT, stop_id STRING")


@query("load_stops", """
SELECT stop_id, stop_name, stop_lat, stop_lon, '0' AS location_type, '' AS parent_station FROM stops""")
def _(t):
    folder = t.scratch("schedule")
    t.stops.write.option("header", True).csv(f"{folder}/stops.txt")
    return schedule.load_stops(t.spark, folder)


@query("load_routes", """
SELECT route_id, route_short_name, route_long_name, route_type, '' AS route_color, '' AS route_text_color
FROM routes""")
def _(t):
    folder = t.scratch("schedule")
    t.routes.write.option("header", True).csv(f"{folder}/routes.txt")
    return schedule.load_routes(t.spark, folder)


@query("load_trips", """
SELECT trip_id, route_id, service_id, '' AS trip_headsign, '' AS direction_id, '' AS shape_id FROM trips""")
def _(t):
    folder = t.scratch("schedule")
    t.trips.write.option("header", True).csv(f"{folder}/trips.txt")
    return schedule.load_trips(t.spark, folder)


@query("load_schedule_bundle", """
SELECT 'stops' AS table_name, COUNT(*) AS records FROM stops UNION ALL
SELECT 'routes', COUNT(*) FROM routes UNION ALL SELECT 'trips', COUNT(*) FROM trips""")
def _(t):
    return schedule.bundle_counts(schedule.load_schedule_bundle(t.spark, schedule_folder(t)))


@query("preview_bundle", """
SELECT * FROM (SELECT 'routes' AS table_name, route_id AS id, route_long_name AS name FROM routes
  ORDER BY route_id LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'stops', stop_id, stop_name FROM stops ORDER BY stop_id LIMIT 10)""")
def _(t):
    routes = schedule.preview(t.routes, by="route_id").select(
        F.lit("routes").alias("table_name"), F.col("route_id").alias("id"), F.col("route_long_name").alias("name"))
    stops = schedule.preview(t.stops, by="stop_id").select(
        F.lit("stops").alias("table_name"), F.col("stop_id").alias("id"), F.col("stop_name").alias("name"))
    return routes.unionByName(stops)


@query("scan_feed", f"SELECT {POSITION_COLUMNS} FROM flat_vehicles")
def _(t):
    path = t.scratch("feed")
    t.feed.write.json(path)
    return flatten_vehicles(scan_feed(t.spark, path, file_format="json"), agency_id="city")


def as_positions(df):
    return df.select(*C.column_names(C.VEHICLE_POSITION))


def as_updates(df):
    return df.select(*C.column_names(C.TRIP_UPDATE))


def as_observations(df):
    return df.select(*C.column_names(C.WEATHER_OBSERVATION))


def landed(messages, path):
    """Messages kept the way a topic hands them out: partition, offset, time, binary key and value."""
    messages.select(
        "topic", F.pmod(F.xxhash64("key"), F.lit(8)).cast("int").alias("partition"),
        F.monotonically_increasing_id().alias("offset"), F.current_timestamp().alias("timestamp"),
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
    ).write.parquet(path)
    return messages.sparkSession.read.parquet(path)


def round_trip(t, messages, schema):
    rows = topics.parse_envelope(topics.envelope(landed(messages, t.scratch("topic"))), schema)
    return rows.select("topic", "key", "record.*")


@query("publish_vehicle_positions", f"""
SELECT 'transit.vehicle.positions' AS topic, vehicle_id AS key, {POSITION_COLUMNS} FROM vehicle_positions""")
def _(t):
    return round_trip(t, topics.vehicle_messages(as_positions(t.positions)), C.VEHICLE_POSITION)


UPDATE_COLUMNS = ", ".join(C.column_names(C.TRIP_UPDATE))
WEATHER_COLUMNS = ", ".join(C.column_names(C.WEATHER_OBSERVATION))


@query("publish_trip_updates", f"""
SELECT 'transit.trip.updates' AS topic, trip_id AS key, {UPDATE_COLUMNS} FROM trip_updates""")
def _(t):
    return round_trip(t, topics.trip_update_messages(as_updates(t.trip_updates)), C.TRIP_UPDATE)


@query("publish_weather", f"""
SELECT 'transit.weather.observations' AS topic, agency_id AS key, {WEATHER_COLUMNS} FROM weather""")
def _(t):
    return round_trip(t, topics.weather_messages(as_observations(t.weather)), C.WEATHER_OBSERVATION)


# --- weather responses -----------------------------------------------------------

@query("weather_current", f"""
WITH readings AS (SELECT event_id, latitude, longitude, agency_id,
  CASE WHEN event_id % 10 = 0 THEN NULL ELSE temperature_celsius END AS t,
  CASE WHEN event_id % 15 = 0 THEN NULL ELSE precipitation_mm END AS p,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE wind_speed_kmh END AS w,
  CASE WHEN event_id % 12 = 0 THEN NULL ELSE weather_code END AS c FROM weather WHERE event_id % 25 <> 0),
filled AS (SELECT *, COALESCE(c, 0) AS weather_code FROM readings WHERE COALESCE(t, p, w, c) IS NOT NULL)
SELECT latitude, longitude, COALESCE(t, 0e0) AS temperature_celsius, COALESCE(p, 0e0) AS precipitation_mm,
  COALESCE(w, 0e0) AS wind_speed_kmh, weather_code, {WEATHER_CONDITION_SQL} AS weather_condition,
  TIMESTAMP '{AS_OF}' AS observation_time, agency_id,
  t IS NULL OR p IS NULL OR w IS NULL OR c IS NULL AS is_defaulted FROM filled""")
def _(t):
    responses = t.weather.selectExpr(
        "latitude", "longitude", "agency_id",
        """to_json(named_struct('current_weather', CASE WHEN event_id % 25 <> 0 THEN named_struct(
            'temperature_2m', CASE WHEN event_id % 10 <> 0 THEN temperature_celsius END,
            'precipitation', CASE WHEN event_id % 15 <> 0 THEN precipitation_mm END,
            'windspeed_10m', CASE WHEN event_id % 6 <> 0 THEN wind_speed_kmh END,
            'weathercode', CASE WHEN event_id % 12 <> 0 THEN weather_code END) END)) AS response""")
    return weather.weather_current(weather.parse_response(responses), observed_at=AS_OF)


@query("weather_forecast", """
SELECT event_id, CAST(i AS INT) AS hour_index, date_trunc('hour', observation_time) + to_hours(i) AS time,
  CASE WHEN i < event_id % 31 THEN temperature_celsius + CAST(i AS DOUBLE) END AS temperature_celsius,
  CASE WHEN i < 30 THEN precipitation_mm END AS precipitation_mm,
  CASE WHEN i < 12 THEN wind_speed_kmh END AS wind_speed_kmh,
  CASE WHEN i < 20 THEN weather_code END AS weather_code
FROM (SELECT *, unnest(range(24)) AS i FROM weather)""")
def _(t):
    hours = "sequence(0, 29)"
    responses = t.weather.selectExpr("event_id", f"""to_json(named_struct('hourly', named_struct(
        'time', transform({hours}, i -> date_format(timestamp_seconds(
            unix_seconds(date_trunc('hour', observation_time)) + i * 3600), "yyyy-MM-dd'T'HH:mm")),
        'temperature_2m', slice(transform({hours}, i -> temperature_celsius + CAST(i AS DOUBLE)), 1,
            CAST(event_id % 31 AS INT)),
        'precipitation', transform({hours}, i -> precipitation_mm),
        'windspeed_10m', slice(transform({hours}, i -> wind_speed_kmh), 1, 12),
        'weathercode', slice(transform({hours}, i -> weather_code), 1, 20)))) AS response""")
    return weather.weather_forecast(weather.parse_response(responses), hours_ahead=24, keep=("event_id",))


# --- tables -----------------------------------------------------------------------

@query("init_layers", """
WITH before AS (SELECT COUNT(*) AS n FROM vehicle_positions)
SELECT 'bronze.vehicle_positions' AS table_name, n AS records FROM before
UNION ALL SELECT 'bronze.trip_updates', 0 UNION ALL SELECT 'bronze.weather_observations', 0
UNION ALL SELECT 'silver.vehicle_positions', 0 UNION ALL SELECT 'gold.hourly_vehicle_metrics', 0
UNION ALL SELECT 'gold.route_performance', 0""")
def _(t):
    """A second init leaves a filled table as it is and the others empty."""
    tables = layers(t)
    tables.append_positions(t.positions, 0)
    tables.init()
    names = ["bronze.vehicle_positions", "bronze.trip_updates", "bronze.weather_observations",
             "silver.vehicle_positions", "gold.hourly_vehicle_metrics", "gold.route_performance"]
    return schedule.bundle_counts({name: tables.table(name) for name in names})


@query("replace_table", "SELECT route_id, route_short_name, route_long_name, route_type FROM routes")
def _(t):
    tables = layers(t)
    name = tables.name("bronze.routes")
    replace_table(t.stops, name)
    replace_table(t.routes, name)
    return t.spark.table(name)


@query("append_bronze", f"""
SELECT TIMESTAMP '{AS_OF}' AS ingestion_timestamp, {POSITION_COLUMNS} FROM vehicle_positions""")
def _(t):
    """A batch written twice is there once."""
    tables = layers(t)
    for _repeat in range(2):
        tables.append_positions(t.positions, 7, ingested_at=moment(AS_OF))
    return tables.table("bronze.vehicle_positions")


@query("append_bronze_trip_updates", f"""
SELECT TIMESTAMP '{AS_OF}' AS ingestion_timestamp, {UPDATE_COLUMNS} FROM trip_updates""")
def _(t):
    """Updates under their own dates, which span years."""
    tables = layers(t)
    tables.append_trip_updates(t.trip_updates, 0, ingested_at=moment(AS_OF))
    return tables.table("bronze.trip_updates")


@query("append_bronze_weather", f"""
SELECT TIMESTAMP '{AS_OF}' AS ingestion_timestamp, {WEATHER_COLUMNS} FROM weather""")
def _(t):
    tables = layers(t)
    tables.append_weather(t.weather, 0, ingested_at=moment(AS_OF))
    return tables.table("bronze.weather_observations")


GOLD_KEYS = ["hour_timestamp", "agency_id", "route_id"]
GOLD_TABLE_SQL = GOLD_SQL.replace("COUNT(DISTINCT vehicle_id)", "CAST(COUNT(DISTINCT vehicle_id) AS INT)").replace(
    "COUNT(*) AS total_obs", "CAST(COUNT(*) AS INT) AS total_obs")


@query("upsert_gold_table", f"""
WITH old AS ({GOLD_TABLE_SQL.format("vehicle_positions")}), new AS ({GOLD_TABLE_SQL.format("silver_positions")})
SELECT * FROM new UNION ALL SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE
  new.hour_timestamp = old.hour_timestamp AND new.agency_id = old.agency_id AND new.route_id = old.route_id)""")
def _(t):
    """Two upserts into the table, and a third that is written but cut short before its commit."""
    tables, name = layers(t), "gold.hourly_vehicle_metrics"
    tables.upsert(name, gold_hourly(t.positions), GOLD_KEYS)
    tables.upsert(name, gold_hourly(silver_filter(t.positions, as_of=AS_OF)), GOLD_KEYS)
    tables.stage_upsert(name, gold_hourly(t.positions).withColumn("total_observations", F.lit(-1)), GOLD_KEYS)
    return rounded_gold(tables.table(name))


@query("refresh_gold", GOLD_SQL.format("silver_positions").replace(
    "COUNT(DISTINCT vehicle_id)", "CAST(COUNT(DISTINCT vehicle_id) AS INT)").replace(
    "COUNT(*) AS total_obs", "CAST(COUNT(*) AS INT) AS total_obs"))
def _(t):
    """Bronze to silver to gold through the tables."""
    tables = layers(t)
    tables.append_positions(t.positions, 0)
    tables.promote(tables.batch("bronze.vehicle_positions", 0), 0, as_of=AS_OF)
    tables.refresh_hourly()
    return rounded_gold(tables.table("gold.hourly_vehicle_metrics"))
