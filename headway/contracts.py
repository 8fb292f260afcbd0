"""Data contracts: table schemas, allowed values and limits.

Schemas are DDL strings, so the same text serves ``spark.read.schema``,
``from_json`` and ``CREATE TABLE``.
"""

from __future__ import annotations

# --- schedule files (CSV with a header row) ---------------------------------

# column -> (type, required, default for an absent optional column)
STOP_COLUMNS = {
    "stop_id": ("STRING", True, None),
    "stop_name": ("STRING", False, ""),
    "stop_lat": ("DOUBLE", True, None),
    "stop_lon": ("DOUBLE", True, None),
    "location_type": ("STRING", False, "0"),
    "parent_station": ("STRING", False, ""),
}
ROUTE_COLUMNS = {
    "route_id": ("STRING", True, None),
    "route_short_name": ("STRING", False, ""),
    "route_long_name": ("STRING", False, ""),
    "route_type": ("INT", True, None),
    "route_color": ("STRING", False, ""),
    "route_text_color": ("STRING", False, ""),
}
TRIP_COLUMNS = {
    "trip_id": ("STRING", True, None),
    "route_id": ("STRING", True, None),
    "service_id": ("STRING", False, ""),
    "trip_headsign": ("STRING", False, ""),
    "direction_id": ("STRING", False, ""),
    "shape_id": ("STRING", False, ""),
}
STOP_TIME_COLUMNS = {
    "trip_id": ("STRING", True, None),
    "stop_id": ("STRING", True, None),
}

# --- feed message, nested; an absent field is NULL ---------------------------

FEED_MESSAGE = """
header STRUCT<timestamp: BIGINT>,
entity ARRAY<STRUCT<
  id: STRING,
  vehicle: STRUCT<
    vehicle: STRUCT<id: STRING>,
    trip: STRUCT<trip_id: STRING, route_id: STRING>,
    position: STRUCT<latitude: DOUBLE, longitude: DOUBLE, bearing: DOUBLE, speed: DOUBLE>,
    timestamp: BIGINT,
    current_stop_sequence: INT,
    stop_id: STRING,
    current_status: INT,
    congestion_level: INT,
    occupancy_status: INT>,
  trip_update: STRUCT<
    vehicle: STRUCT<id: STRING>,
    trip: STRUCT<trip_id: STRING, route_id: STRING>,
    stop_time_update: ARRAY<STRUCT<
      stop_sequence: INT,
      stop_id: STRING,
      arrival: STRUCT<delay: INT, time: BIGINT>,
      departure: STRUCT<delay: INT, time: BIGINT>,
      schedule_relationship: INT>>>>>
"""

# --- flat records ------------------------------------------------------------

VEHICLE_POSITION = """
vehicle_id STRING, trip_id STRING, route_id STRING,
latitude DOUBLE, longitude DOUBLE, bearing DOUBLE, speed DOUBLE,
timestamp TIMESTAMP, current_stop_sequence INT, stop_id STRING,
current_status STRING, congestion_level STRING, occupancy_status STRING,
agency_id STRING, feed_timestamp TIMESTAMP
"""

TRIP_UPDATE = """
trip_id STRING, route_id STRING, vehicle_id STRING,
stop_sequence INT, stop_id STRING, arrival_delay INT, departure_delay INT,
arrival_time TIMESTAMP, departure_time TIMESTAMP,
schedule_relationship STRING, agency_id STRING, timestamp TIMESTAMP
"""

WEATHER_OBSERVATION = """
latitude DOUBLE, longitude DOUBLE, temperature_celsius DOUBLE,
precipitation_mm DOUBLE, wind_speed_kmh DOUBLE, weather_code INT,
weather_condition STRING, observation_time TIMESTAMP, agency_id STRING
"""

QUALITY_ALERT = """
alert_id STRING, alert_type STRING, severity STRING, entity_type STRING,
entity_id STRING, agency_id STRING, error_message STRING,
field_name STRING, field_value STRING, detected_at TIMESTAMP
"""

HOURLY_METRICS = """
hour_timestamp TIMESTAMP, agency_id STRING, route_id STRING,
total_vehicles INT, avg_speed_kmh DOUBLE, max_speed_kmh DOUBLE,
avg_congestion_score DOUBLE, total_observations INT
"""

# sums that can be added up: of the positions of a vehicle in an hour, of the stop updates of a trip on a day
HOURLY_PARTIALS = """
hour_timestamp TIMESTAMP, agency_id STRING, route_id STRING, vehicle_id STRING,
speed_sum DOUBLE, speeds BIGINT, max_speed_kmh DOUBLE, score_sum BIGINT, observations BIGINT
"""

ROUTE_PARTIALS = """
date DATE, agency_id STRING, route_id STRING, trip_id STRING, delay_sum BIGINT,
delays BIGINT, max_delay_seconds INT, min_delay_seconds INT, on_time BIGINT
"""

MESSAGE = "topic STRING, key STRING, value STRING"

ROUTE_PERFORMANCE = """
date DATE, agency_id STRING, route_id STRING, avg_delay_seconds DOUBLE,
max_delay_seconds INT, min_delay_seconds INT, on_time_percentage DOUBLE,
total_trips INT
"""

MESSAGE_ENVELOPE = (
    "topic STRING, partition INT, offset BIGINT, timestamp BIGINT, key STRING, value STRING"
)

CURRENT_WEATHER = (
    "STRUCT<temperature_2m: DOUBLE, precipitation: DOUBLE, windspeed_10m: DOUBLE, weathercode: INT>"
)
HOURLY_FORECAST = (
    "STRUCT<time: ARRAY<STRING>, temperature_2m: ARRAY<DOUBLE>, precipitation: ARRAY<DOUBLE>, "
    "windspeed_10m: ARRAY<DOUBLE>, weathercode: ARRAY<INT>>"
)


def column_names(ddl: str) -> list[str]:
    """Top-level column names of a flat DDL string."""
    return [part.split()[0] for part in ddl.strip().split(",")]


# --- fixed values: code -> name, as published in the realtime feed format -----

VEHICLE_STOP_STATUS = {0: "INCOMING_AT", 1: "STOPPED_AT", 2: "IN_TRANSIT_TO"}
CONGESTION_LEVEL = {
    0: "UNKNOWN_CONGESTION_LEVEL",
    1: "RUNNING_SMOOTHLY",
    2: "STOP_AND_GO",
    3: "CONGESTION",
    4: "SEVERE_CONGESTION",
}
OCCUPANCY_STATUS = {
    0: "EMPTY",
    1: "MANY_SEATS_AVAILABLE",
    2: "FEW_SEATS_AVAILABLE",
    3: "STANDING_ROOM_ONLY",
    4: "CRUSHED_STANDING_ROOM_ONLY",
    5: "FULL",
    6: "NOT_ACCEPTING_PASSENGERS",
}
SCHEDULE_RELATIONSHIP = {0: "SCHEDULED", 1: "SKIPPED", 2: "NO_DATA", 3: "UNSCHEDULED"}
CONGESTION_SCORE = {
    "RUNNING_SMOOTHLY": 1,
    "STOP_AND_GO": 2,
    "CONGESTION": 3,
    "SEVERE_CONGESTION": 4,
}
ROUTE_TYPE_LABEL = {0: "Tram/Light Rail", 1: "Subway/Metro", 3: "Bus"}

# --- fixed values: weather condition -> inclusive ranges of WMO codes ---------

WEATHER_CODE_RANGES = {
    "CLEAR": [(0, 0)],
    "PARTLY_CLOUDY": [(1, 2)],
    "OVERCAST": [(3, 3)],
    "FOG": [(45, 45), (48, 48)],
    "RAIN": [(51, 67)],
    "SNOW": [(71, 77)],
    "HEAVY_RAIN": [(80, 82)],
    "THUNDERSTORM": [(95, 99)],
}
SEVERE_CONDITIONS = ("HEAVY_RAIN", "SNOW", "THUNDERSTORM")

# --- fixed values: limits of the contracts ------------------------------------

MAX_SPEED_MS = 33.3
MAX_POSITION_AGE_S = 300
SILVER_MAX_AGE_S = 600
MIN_DELAY_S = -3600
MAX_DELAY_S = 7200
TEMPERATURE_C = (-50.0, 60.0)
MAX_WIND_KMH = 200.0
MAX_WEATHER_CODE = 99
MAX_WEATHER_AGE_S = 3600
ON_TIME_S = (-60, 300)
EARTH_RADIUS_M = 6371000.0
KM_PER_DEGREE = 111.0

# --- fixed values: message topics ---------------------------------------------

TOPIC_VEHICLES = "transit.vehicle.positions"
TOPIC_TRIP_UPDATES = "transit.trip.updates"
TOPIC_WEATHER = "transit.weather.observations"
TOPIC_ALERTS = "transit.quality.alerts"

# --- agency table ----------------------------------------------------------------

AGENCY = """
agency_id STRING, name STRING, timezone STRING, enabled BOOLEAN,
min_latitude DOUBLE, max_latitude DOUBLE, min_longitude DOUBLE, max_longitude DOUBLE,
center_latitude DOUBLE, center_longitude DOUBLE, route_types ARRAY<INT>
"""
# fixed values: service areas, weather centre points and monitored route types
DEFAULT_AGENCIES = [
    ("trimet", "TriMet", "America/Los_Angeles", True,
     45.2, 45.7, -123.0, -122.3, 45.5152, -122.6784, [0, 1, 3]),
    ("mta", "MTA New York City Transit", "America/New_York", False,
     40.5, 40.9, -74.3, -73.7, 40.7128, -74.0060, [1, 3]),
    ("bart", "Bay Area Rapid Transit", "America/Los_Angeles", False,
     37.4, 38.0, -122.5, -121.7, 37.7749, -122.4194, [1]),
    ("tfl", "Transport for London", "Europe/London", False,
     51.3, 51.7, -0.5, 0.3, 51.5074, -0.1278, [1, 2, 3]),
]


def default_agencies(spark):
    """The configured agencies as a DataFrame; replace it with your own rows of ``AGENCY``."""
    return spark.createDataFrame(DEFAULT_AGENCIES, AGENCY)
