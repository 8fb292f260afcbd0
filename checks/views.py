"""The driver tables seen as transit data.

Each view is one list of expressions that Spark and DuckDB both read, so both
sides start from the same rows. Decimal constants carry an exponent, which
makes them doubles in both.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import contracts as C
from headway.session import configure, scratch_dir

AS_OF = "2024-01-15 00:00:00"

# Sums of doubles differ in their last bits with the order of the rows. Both sides
# are cut to a fixed number of digits, at an offset that no short decimal falls on.
_OFFSET = 0.37


def rounded(column: Column, digits: int = 6) -> Column:
    factor = float(10**digits)
    return F.floor(column * factor + _OFFSET) / factor


def rounded_sql(expression: str, digits: int = 6) -> str:
    return f"FLOOR(({expression}) * 1e{digits} + {_OFFSET}e0) / 1e{digits}"


POSITIONS = [
    "event_id",
    "CAST(user_id AS STRING) AS vehicle_id",
    "concat('trip_', CAST(user_id AS STRING)) AS trip_id",
    "CASE WHEN event_id % 50 = 0 THEN NULL ELSE event_type END AS route_id",
    "45.2e0 + ((event_id * 7919) % 5003) / 10000e0 AS latitude",
    "-123.0e0 + ((event_id * 104729) % 7001) / 10000e0 AS longitude",
    "CAST((event_id * 41) % 370 AS DOUBLE) AS bearing",
    "CASE WHEN event_id % 20 = 0 THEN NULL ELSE value / 10e0 END AS speed",
    "CAST(ts AS TIMESTAMP) AS timestamp",
    "CAST(event_id % 40 AS INT) - 1 AS current_stop_sequence",
    "CAST((event_id * 31) % 3000 AS STRING) AS stop_id",
    "CASE event_id % 5 WHEN 1 THEN 'INCOMING_AT' WHEN 2 THEN 'STOPPED_AT' "
    "WHEN 3 THEN 'IN_TRANSIT_TO' WHEN 4 THEN 'PARKED' END AS current_status",
    "CASE event_id % 6 WHEN 1 THEN 'RUNNING_SMOOTHLY' WHEN 2 THEN 'STOP_AND_GO' WHEN 3 THEN 'CONGESTION' "
    "WHEN 4 THEN 'SEVERE_CONGESTION' WHEN 5 THEN 'UNKNOWN_CONGESTION_LEVEL' END AS congestion_level",
    "CASE event_id % 4 WHEN 1 THEN 'EMPTY' WHEN 2 THEN 'FULL' WHEN 3 THEN 'PACKED' END AS occupancy_status",
    "concat('agency_', CAST(user_id % 4 AS STRING)) AS agency_id",
    "CAST(ts AS TIMESTAMP) AS feed_timestamp",
]
# the same positions with broken ids, coordinates, agencies and times
RECORDS = [
    "event_id",
    "CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 101 = 0 THEN NULL ELSE vehicle_id END AS vehicle_id",
    "trip_id",
    "route_id",
    "CASE WHEN event_id % 53 = 0 THEN latitude * 2.5e0 WHEN event_id % 59 = 0 THEN CAST('NaN' AS DOUBLE) "
    "WHEN event_id % 67 = 0 THEN NULL ELSE latitude END AS latitude",
    "CASE WHEN event_id % 61 = 0 THEN longitude - 60e0 ELSE longitude END AS longitude",
    "bearing",
    "CASE WHEN event_id % 79 = 0 THEN -0.1e0 WHEN event_id % 83 = 0 THEN 33.3e0 ELSE speed END AS speed",
    "CASE WHEN event_id % 73 = 0 THEN NULL ELSE timestamp END AS timestamp",
    "current_stop_sequence",
    "stop_id",
    "current_status",
    "congestion_level",
    "occupancy_status",
    "CASE WHEN event_id % 71 = 0 THEN NULL ELSE agency_id END AS agency_id",
    "CASE WHEN event_id % 89 = 0 THEN NULL ELSE feed_timestamp END AS feed_timestamp",
]
STOPS = [
    "CAST(p_partkey AS STRING) AS stop_id",
    "p_name AS stop_name",
    "45.40e0 + 0.25e0 * (((p_partkey * 7919) % 2503) / 2503e0) * (((p_partkey * 7919) % 2503) / 2503e0) AS stop_lat",
    "-122.80e0 + 0.50e0 * (((p_partkey * 104729) % 4999) / 4999e0) * (((p_partkey * 104729) % 4999) / 4999e0)"
    " AS stop_lon",
]
ROUTES = [
    "CAST(n_nationkey AS STRING) AS route_id",
    "n_name AS route_short_name",
    "concat('Line ', n_name) AS route_long_name",
    "CAST(n_nationkey % 5 AS INT) AS route_type",
]
TRIPS = [
    "CAST(o_orderkey AS STRING) AS trip_id",
    "CAST(o_custkey % 25 AS STRING) AS route_id",
    "o_orderpriority AS service_id",
]
STOP_TIMES = [
    "CAST(l_orderkey AS STRING) AS trip_id",
    "l_linenumber AS stop_sequence",
    "CAST(l_partkey AS STRING) AS stop_id",
]
# lineitem joined to orders, with d = days from order to shipment
TRIP_UPDATES = [
    "CAST(l_orderkey AS STRING) AS trip_id",
    "CAST(o_custkey % 25 AS STRING) AS route_id",
    "CAST(o_custkey AS STRING) AS vehicle_id",
    "l_linenumber AS stop_sequence",
    "CASE WHEN l_partkey % 97 = 0 THEN '' ELSE CAST(l_partkey AS STRING) END AS stop_id",
    "CAST(3 * d AS INT) AS arrival_delay",
    "CASE WHEN l_suppkey % 20 = 0 THEN NULL ELSE CAST(3 * d + 15 * l_linenumber - 30 AS INT) END AS departure_delay",
    "CAST(o_orderdate AS TIMESTAMP) AS arrival_time",
    "CASE WHEN l_suppkey % 9 = 0 THEN NULL WHEN l_suppkey % 50 = 1 THEN CAST(o_orderdate AS TIMESTAMP) - INTERVAL '1' DAY"
    " ELSE CAST(l_shipdate AS TIMESTAMP) END AS departure_time",
    "CASE l_linenumber % 7 WHEN 1 THEN 'SKIPPED' WHEN 2 THEN 'NO_DATA' WHEN 3 THEN 'UNSCHEDULED'"
    " WHEN 4 THEN 'CANCELED' ELSE 'SCHEDULED' END AS schedule_relationship",
    "concat('agency_', CAST(o_custkey % 4 AS STRING)) AS agency_id",
    "CAST(l_shipdate AS TIMESTAMP) AS timestamp",
]
# weather stations report through the signup events
WEATHER = [
    "event_id",
    "45.2e0 + ((event_id * 7919) % 5003) / 10000e0 AS latitude",
    "-123.0e0 + ((event_id * 104729) % 7001) / 10000e0 AS longitude",
    "value / 3e0 - 55e0 AS temperature_celsius",
    "value / 20e0 AS precipitation_mm",
    "value * 0.75e0 AS wind_speed_kmh",
    "CAST(event_id % 104 AS INT) AS weather_code",
    "CAST(ts AS TIMESTAMP) AS observation_time",
    "concat('agency_', CAST(user_id % 4 AS STRING)) AS agency_id",
]
POINTS = [
    "CAST(s_suppkey AS STRING) AS point_id",
    "45.2e0 + ((s_suppkey * 7919) % 5003) / 10000e0 AS point_lat",
    "-123.0e0 + ((s_suppkey * 104729) % 7001) / 10000e0 AS point_lon",
]
# agency_0 .. agency_3 with narrower and narrower boxes around the same centre
AGENCIES = [
    (f"agency_{k}", f"Agency {k}", "UTC", k != 2,
     45.2 + 0.05 * k, 45.7 - 0.05 * k, -123.0 + 0.05 * k, -122.3 - 0.05 * k, 45.5152, -122.6784, types)
    for k, types in enumerate([[0, 1, 3], [1, 3], [4], [1]])
]
WEATHER_CONDITION_SQL = (
    "CASE WHEN weather_code = 0 THEN 'CLEAR' WHEN weather_code IN (1, 2) THEN 'PARTLY_CLOUDY' "
    "WHEN weather_code = 3 THEN 'OVERCAST' WHEN weather_code IN (45, 48) THEN 'FOG' "
    "WHEN weather_code BETWEEN 51 AND 67 THEN 'RAIN' WHEN weather_code BETWEEN 71 AND 77 THEN 'SNOW' "
    "WHEN weather_code BETWEEN 80 AND 82 THEN 'HEAVY_RAIN' WHEN weather_code BETWEEN 95 AND 99 "
    "THEN 'THUNDERSTORM' ELSE 'CLEAR' END"
)


def _select(columns: list[str], source: str) -> str:
    return f"SELECT {', '.join(columns)} FROM {source}"


# in dependency order
SQL_VIEWS = {
    "vehicle_positions": _select(POSITIONS, "events"),
    "vehicle_records": _select(RECORDS, "vehicle_positions"),
    "silver_positions": (
        "SELECT * FROM vehicle_positions WHERE latitude IS NOT NULL AND longitude IS NOT NULL "
        "AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 "
        "AND (speed IS NULL OR speed BETWEEN 0 AND 33.3e0) "
        f"AND timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL '10' MINUTE"
    ),
    "stops": _select(STOPS, "part"),
    "routes": _select(ROUTES, "nation"),
    "trips": _select(TRIPS, "orders"),
    "stop_times": _select(STOP_TIMES, "lineitem"),
    "trip_updates": _select(
        TRIP_UPDATES,
        "(SELECT *, date_diff('day', o_orderdate, l_shipdate) AS d "
        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey)",
    ),
    "weather_raw": _select(WEATHER, "events WHERE event_type = 'signup'"),
    "weather": f"SELECT *, {WEATHER_CONDITION_SQL} AS weather_condition FROM weather_raw",
    "points": _select(POINTS, "supplier"),
    "agencies": "SELECT * FROM (VALUES " + ", ".join(
        f"('{a[0]}', {a[3]}, {a[4]!r}e0, {a[5]!r}e0, {a[6]!r}e0, {a[7]!r}e0, {a[10]!r})" for a in AGENCIES
    ) + ") AS t(agency_id, enabled, min_latitude, max_latitude, min_longitude, max_longitude, route_types)",
}


def with_views(sql: str) -> str:
    """Put the views a statement uses, directly or through other views, in front of it."""
    needed: set[str] = set()
    pending = sql
    for name in reversed(SQL_VIEWS):
        if re.search(rf"\b{name}\b", pending):
            needed.add(name)
            pending += " " + SQL_VIEWS[name]
    views = ", ".join(f"{n} AS ({body})" for n, body in SQL_VIEWS.items() if n in needed)
    if not views:
        return sql
    rest = sql.strip()
    return f"WITH {views}, {rest[5:]}" if rest.upper().startswith("WITH ") else f"WITH {views} {rest}"


class Tables:
    """The same views as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def scratch(self, label: str) -> str:
        return scratch_dir(self.spark, label)

    @property
    def positions(self) -> DataFrame:
        return self.raw("events").selectExpr(*POSITIONS)

    @property
    def records(self) -> DataFrame:
        return self.positions.selectExpr(*RECORDS)

    @property
    def stops(self) -> DataFrame:
        return self.raw("part").selectExpr(*STOPS)

    @property
    def routes(self) -> DataFrame:
        return self.raw("nation").selectExpr(*ROUTES)

    @property
    def trips(self) -> DataFrame:
        return self.raw("orders").selectExpr(*TRIPS)

    @property
    def stop_times(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(*STOP_TIMES)

    @property
    def trip_updates(self) -> DataFrame:
        lines, orders = self.raw("lineitem"), self.raw("orders")
        joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        return joined.withColumn("d", F.date_diff("l_shipdate", "o_orderdate")).selectExpr(*TRIP_UPDATES)

    @property
    def weather(self) -> DataFrame:
        from headway.functions.codes import weather_condition

        return (
            self.raw("events").where("event_type = 'signup'").selectExpr(*WEATHER)
            .withColumn("weather_condition", weather_condition(F.col("weather_code")))
        )

    @property
    def points(self) -> DataFrame:
        return self.raw("supplier").selectExpr(*POINTS)

    @property
    def agencies(self) -> DataFrame:
        return self.spark.createDataFrame(AGENCIES, C.AGENCY)

    @property
    def feed(self) -> DataFrame:
        """One message per event with a vehicle entity and a trip-update entity, parts of them absent."""
        second = "unix_seconds(CAST(ts AS TIMESTAMP))"
        vehicle = f"""CASE WHEN event_id % 11 <> 0 THEN named_struct(
            'vehicle', CASE WHEN event_id % 7 <> 0 THEN named_struct(
                'id', CASE WHEN event_id % 13 = 0 THEN '' ELSE CAST(user_id AS STRING) END) END,
            'trip', CASE WHEN event_id % 50 <> 0 THEN named_struct(
                'trip_id', concat('trip_', user_id), 'route_id', event_type) END,
            'position', CASE WHEN event_id % 17 <> 0 THEN named_struct(
                'latitude', 45.2e0 + ((event_id * 7919) % 5003) / 10000e0,
                'longitude', -123.0e0 + ((event_id * 104729) % 7001) / 10000e0,
                'bearing', CASE WHEN event_id % 9 <> 0 THEN CAST((event_id * 41) % 370 AS DOUBLE) END,
                'speed', CASE WHEN event_id % 20 <> 0 THEN value / 10e0 END) END,
            'timestamp', CASE WHEN event_id % 5 <> 0 THEN {second} - event_id % 400 END,
            'current_stop_sequence', CASE WHEN event_id % 4 <> 0 THEN CAST(event_id % 40 AS INT) END,
            'stop_id', CASE WHEN event_id % 6 <> 0 THEN CAST((event_id * 31) % 3000 AS STRING) END,
            'current_status', CASE WHEN event_id % 8 <> 0 THEN CAST(event_id % 4 AS INT) END,
            'congestion_level', CAST(event_id % 6 AS INT),
            'occupancy_status', CASE WHEN event_id % 10 <> 0 THEN CAST(event_id % 9 AS INT) END) END"""
        stop = f"""named_struct(
            'stop_sequence', CASE WHEN (event_id + k) % 6 <> 0 THEN k END,
            'stop_id', CASE WHEN (event_id + k) % 10 <> 0 THEN concat('s', k) END,
            'arrival', CASE WHEN (event_id + k) % 4 <> 0 THEN named_struct(
                'delay', CAST((event_id * 37 + k * 101) % 12000 - 4000 AS INT), 'time', {second} + 60 * k) END,
            'departure', CASE WHEN (event_id + k) % 5 <> 0 THEN named_struct(
                'delay', CAST(NULL AS INT), 'time', {second} + 60 * k + 30 * ((event_id + k) % 7 - 2)) END,
            'schedule_relationship', CASE WHEN (event_id + k) % 8 <> 0 THEN CAST((event_id + k) % 6 AS INT) END)"""
        update = f"""CASE WHEN event_id % 3 <> 0 THEN named_struct(
            'vehicle', CASE WHEN event_id % 5 <> 0 THEN named_struct('id', CAST(user_id AS STRING)) END,
            'trip', CASE WHEN event_id % 19 <> 0 THEN named_struct(
                'trip_id', CASE WHEN event_id % 23 = 0 THEN '' ELSE concat('trip_', user_id) END,
                'route_id', event_type) END,
            'stop_time_update', transform(slice(array(0, 1, 2), 1, CAST(event_id % 4 AS INT)), k -> {stop})) END"""
        return self.raw("events").selectExpr(
            f"named_struct('timestamp', {second}) AS header",
            f"""array(
                named_struct('id', concat('e', event_id), 'vehicle', {vehicle}, 'trip_update', NULL),
                named_struct('id', concat('u', event_id), 'vehicle', NULL, 'trip_update', {update})) AS entity""",
        )


# what flattening that feed must give, straight from the events
SQL_VIEWS["feed_base"] = "SELECT *, epoch_us(ts) // 1000000 AS sec FROM events"
SQL_VIEWS["flat_vehicles"] = """
SELECT event_id,
  CASE WHEN event_id % 7 = 0 THEN concat('e', event_id) WHEN event_id % 13 = 0 THEN ''
    ELSE CAST(user_id AS VARCHAR) END AS vehicle_id,
  CASE WHEN event_id % 50 <> 0 THEN concat('trip_', user_id) END AS trip_id,
  CASE WHEN event_id % 50 <> 0 THEN event_type END AS route_id,
  45.2e0 + ((event_id * 7919) % 5003) / 10000e0 AS latitude,
  -123.0e0 + ((event_id * 104729) % 7001) / 10000e0 AS longitude,
  CASE WHEN event_id % 9 <> 0 THEN CAST((event_id * 41) % 370 AS DOUBLE) END AS bearing,
  CASE WHEN event_id % 20 <> 0 THEN value / 10e0 END AS speed,
  make_timestamp(1000000 * CASE WHEN event_id % 5 <> 0 THEN sec - event_id % 400 ELSE sec END) AS timestamp,
  CASE WHEN event_id % 4 <> 0 THEN CAST(event_id % 40 AS INT) END AS current_stop_sequence,
  CASE WHEN event_id % 6 <> 0 THEN CAST((event_id * 31) % 3000 AS VARCHAR) END AS stop_id,
  CASE WHEN event_id % 8 <> 0 THEN
    CASE event_id % 4 WHEN 0 THEN 'INCOMING_AT' WHEN 1 THEN 'STOPPED_AT' WHEN 2 THEN 'IN_TRANSIT_TO' END
  END AS current_status,
  CASE event_id % 6 WHEN 0 THEN 'UNKNOWN_CONGESTION_LEVEL' WHEN 1 THEN 'RUNNING_SMOOTHLY'
    WHEN 2 THEN 'STOP_AND_GO' WHEN 3 THEN 'CONGESTION' WHEN 4 THEN 'SEVERE_CONGESTION' END AS congestion_level,
  CASE WHEN event_id % 10 <> 0 THEN CASE event_id % 9 WHEN 0 THEN 'EMPTY' WHEN 1 THEN 'MANY_SEATS_AVAILABLE'
    WHEN 2 THEN 'FEW_SEATS_AVAILABLE' WHEN 3 THEN 'STANDING_ROOM_ONLY'
    WHEN 4 THEN 'CRUSHED_STANDING_ROOM_ONLY' WHEN 5 THEN 'FULL' WHEN 6 THEN 'NOT_ACCEPTING_PASSENGERS' END
  END AS occupancy_status,
  'city' AS agency_id,
  make_timestamp(1000000 * sec) AS feed_timestamp
FROM feed_base WHERE event_id % 11 <> 0 AND event_id % 17 <> 0"""
SQL_VIEWS["flat_updates"] = """
SELECT
  concat('trip_', user_id) AS trip_id,
  event_type AS route_id,
  CASE WHEN event_id % 5 <> 0 THEN CAST(user_id AS VARCHAR) END AS vehicle_id,
  CASE WHEN (event_id + k) % 6 <> 0 THEN CAST(k AS INT) ELSE 0 END AS stop_sequence,
  CASE WHEN (event_id + k) % 10 <> 0 THEN concat('s', k) ELSE '' END AS stop_id,
  CASE WHEN (event_id + k) % 4 <> 0 THEN CAST((event_id * 37 + k * 101) % 12000 - 4000 AS INT) END AS arrival_delay,
  CAST(NULL AS INT) AS departure_delay,
  CASE WHEN (event_id + k) % 4 <> 0 THEN make_timestamp(1000000 * (sec + 60 * k)) END AS arrival_time,
  CASE WHEN (event_id + k) % 5 <> 0 THEN
    make_timestamp(1000000 * (sec + 60 * k + 30 * ((event_id + k) % 7 - 2))) END AS departure_time,
  CASE WHEN (event_id + k) % 8 <> 0 THEN CASE (event_id + k) % 6 WHEN 1 THEN 'SKIPPED' WHEN 2 THEN 'NO_DATA'
    WHEN 3 THEN 'UNSCHEDULED' ELSE 'SCHEDULED' END ELSE 'SCHEDULED' END AS schedule_relationship,
  'city' AS agency_id,
  make_timestamp(1000000 * sec) AS timestamp
FROM (SELECT *, unnest(range(event_id % 4)) AS k FROM feed_base
  WHERE event_id % 3 <> 0 AND event_id % 19 <> 0 AND event_id % 23 <> 0)"""
