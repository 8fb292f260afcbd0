"""Both sides of every limit of the contracts."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from headway import contracts as C
from headway.functions.codes import coverage_class, gap_severity, weather_condition
from headway.functions.times import iso_utc, location_key
from headway.operators import validate as V
from headway.operators.medallion import silver_filter

NOW = datetime(2026, 1, 31, 12, 30)


def position(**changes):
    base = dict(vehicle_id="4012", trip_id="10293847", route_id="100", latitude=45.5152, longitude=-122.6784,
                bearing=180.5, speed=12.5, timestamp=NOW, current_stop_sequence=5, stop_id="7625",
                current_status="IN_TRANSIT_TO", congestion_level="RUNNING_SMOOTHLY",
                occupancy_status="FEW_SEATS_AVAILABLE", agency_id="city", feed_timestamp=NOW)
    return {**base, **changes}


def update(**changes):
    base = dict(trip_id="10293847", route_id="100", vehicle_id="4012", stop_sequence=5, stop_id="7625",
                arrival_delay=120, departure_delay=180, arrival_time=None, departure_time=None,
                schedule_relationship="SCHEDULED", agency_id="city", timestamp=NOW)
    return {**base, **changes}


def observation(**changes):
    base = dict(latitude=45.5152, longitude=-122.6784, temperature_celsius=15.5, precipitation_mm=2.3,
                wind_speed_kmh=12.5, weather_code=61, weather_condition="RAIN", observation_time=NOW,
                agency_id="city")
    return {**base, **changes}


def frame(spark, rows, ddl):
    names = C.column_names(ddl)
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ddl)


def broken(spark, rows, ddl, rules):
    found = V.annotate(frame(spark, rows, ddl).coalesce(1), rules).select("violations").collect()
    return [r.violations for r in found]


POSITION_CASES = [
    ({}, []),
    ({"speed": None}, []), ({"speed": 0.0}, []), ({"speed": 33.3}, []),
    ({"speed": -0.1}, ["speed_out_of_range"]), ({"speed": 33.31}, ["speed_out_of_range"]),
    ({"speed": 50.0}, ["speed_out_of_range"]), ({"speed": float("nan")}, ["speed_out_of_range"]),
    ({"bearing": None}, []), ({"bearing": 0.0}, []), ({"bearing": 359.9}, []),
    ({"bearing": 360.0}, ["bearing_out_of_range"]), ({"bearing": -1.0}, ["bearing_out_of_range"]),
    ({"bearing": float("nan")}, ["bearing_out_of_range"]),
    ({"latitude": 90.0, "longitude": -180.0}, []), ({"latitude": -90.0, "longitude": 180.0}, []),
    ({"latitude": 90.1}, ["latitude_out_of_range"]), ({"latitude": None}, ["latitude_out_of_range"]),
    ({"latitude": float("nan")}, ["latitude_out_of_range"]),
    ({"longitude": 180.1}, ["longitude_out_of_range"]), ({"longitude": None}, ["longitude_out_of_range"]),
    ({"timestamp": NOW - timedelta(seconds=300)}, []), ({"timestamp": NOW + timedelta(hours=1)}, []),
    ({"timestamp": NOW - timedelta(seconds=301)}, ["position_stale"]),
    ({"timestamp": NOW - timedelta(seconds=600)}, ["position_stale"]),
    ({"timestamp": None}, ["timestamp_missing"]), ({"feed_timestamp": None}, ["feed_timestamp_missing"]),
    ({"vehicle_id": ""}, ["vehicle_id_missing"]), ({"vehicle_id": None}, ["vehicle_id_missing"]),
    ({"agency_id": None}, ["agency_id_missing"]),
    ({"current_stop_sequence": 0}, []), ({"current_stop_sequence": -1}, ["stop_sequence_negative"]),
    ({"current_status": None, "congestion_level": None, "occupancy_status": None}, []),
    ({"current_status": "PARKED"}, ["current_status_unknown"]),
    ({"congestion_level": "JAM"}, ["congestion_level_unknown"]),
    ({"occupancy_status": "PACKED"}, ["occupancy_status_unknown"]),
    ({"speed": 50.0, "vehicle_id": ""}, ["vehicle_id_missing", "speed_out_of_range"]),
]


def test_position_limits(spark):
    rows = [position(**changes) for changes, _ in POSITION_CASES]
    rules = V.vehicle_rules(NOW)
    assert broken(spark, rows, C.VEHICLE_POSITION, rules) == [want for _, want in POSITION_CASES]
    valid = V.keep_valid(frame(spark, rows, C.VEHICLE_POSITION), rules).count()
    assert valid == sum(1 for _, want in POSITION_CASES if not want)


UPDATE_CASES = [
    ({}, []),
    ({"arrival_delay": None, "departure_delay": None}, []), ({"arrival_delay": -3600}, []),
    ({"arrival_delay": 7200}, []), ({"arrival_delay": -3601}, ["arrival_delay_out_of_range"]),
    ({"arrival_delay": 7201}, ["arrival_delay_out_of_range"]),
    ({"departure_delay": 7201}, ["departure_delay_out_of_range"]),
    ({"arrival_time": NOW, "departure_time": NOW}, []), ({"arrival_time": NOW}, []),
    ({"arrival_time": NOW, "departure_time": NOW - timedelta(seconds=1)}, ["arrival_after_departure"]),
    ({"stop_id": ""}, ["stop_id_missing"]), ({"trip_id": None}, ["trip_id_missing"]),
    ({"stop_sequence": -1}, ["stop_sequence_negative"]), ({"stop_sequence": None}, ["stop_sequence_negative"]),
    ({"schedule_relationship": "CANCELED"}, ["schedule_relationship_unknown"]),
]


def test_trip_update_limits(spark):
    rows = [update(**changes) for changes, _ in UPDATE_CASES]
    assert broken(spark, rows, C.TRIP_UPDATE, V.trip_update_rules()) == [want for _, want in UPDATE_CASES]


WEATHER_CASES = [
    ({}, []),
    ({"temperature_celsius": -50.0}, []), ({"temperature_celsius": 60.0}, []),
    ({"temperature_celsius": -50.1}, ["temperature_out_of_range"]),
    ({"temperature_celsius": 60.1}, ["temperature_out_of_range"]),
    ({"wind_speed_kmh": 200.0}, []), ({"wind_speed_kmh": 200.1}, ["wind_speed_out_of_range"]),
    ({"weather_code": 99}, []), ({"weather_code": 100}, ["weather_code_out_of_range"]),
    ({"precipitation_mm": -0.1}, ["precipitation_negative"]),
    ({"precipitation_mm": float("nan")}, ["precipitation_negative"]),
    ({"observation_time": NOW - timedelta(seconds=3600)}, []),
    ({"observation_time": NOW - timedelta(seconds=3601)}, ["observation_stale"]),
    ({"weather_condition": "HAIL"}, ["weather_condition_unknown"]),
]


def test_weather_limits(spark):
    rows = [observation(**changes) for changes, _ in WEATHER_CASES]
    assert broken(spark, rows, C.WEATHER_OBSERVATION, V.weather_rules(NOW)) == [want for _, want in WEATHER_CASES]


@pytest.mark.parametrize("age, kept", [(0, 1), (600, 1), (601, 0), (-60, 1)])
def test_silver_age(spark, age, kept):
    rows = frame(spark, [position(timestamp=NOW - timedelta(seconds=age))], C.VEHICLE_POSITION)
    assert silver_filter(rows, as_of=NOW).count() == kept


def test_silver_drops_nan_speed_and_missing_coordinates(spark):
    rows = frame(spark, [position(speed=float("nan")), position(latitude=None), position(speed=None)],
                 C.VEHICLE_POSITION)
    assert silver_filter(rows, as_of=NOW).count() == 1


def test_alert_row(spark):
    rows = frame(spark, [position(speed=45.2, vehicle_id="vehicle_4012")], C.VEHICLE_POSITION)
    alert = V.alerts(rows, V.vehicle_rules(NOW), entity_type="vehicle_position", entity_id="vehicle_id",
                     as_of=NOW).collect()
    assert [a.asDict() for a in alert] == [dict(
        alert_id="dqa_20260131_123000_vehicle_4012", alert_type="SPEED_VIOLATION", severity="MEDIUM",
        entity_type="vehicle_position", entity_id="vehicle_4012", agency_id="city",
        error_message="speed_out_of_range", field_name="speed", field_value="45.2", detected_at=NOW)]


def test_weather_codes(spark):
    want = {0: "CLEAR", 1: "PARTLY_CLOUDY", 2: "PARTLY_CLOUDY", 3: "OVERCAST", 45: "FOG", 46: "CLEAR", 48: "FOG",
            51: "RAIN", 67: "RAIN", 68: "CLEAR", 71: "SNOW", 77: "SNOW", 80: "HEAVY_RAIN", 82: "HEAVY_RAIN",
            85: "CLEAR", 86: "CLEAR", 95: "THUNDERSTORM", 99: "THUNDERSTORM", 100: "CLEAR"}
    rows = spark.createDataFrame([(k,) for k in want], "code INT")
    got = {r.code: r.label for r in rows.select("code", weather_condition(F.col("code")).alias("label")).collect()}
    assert got == want


def test_location_key_rounds_like_a_decimal_formatter(spark):
    import random

    rng = random.Random(7)
    values = [0.0, -0.001, 0.125, 0.375, 1.005, 2.675, 45.205, -122.675, 1.115, 0.285, 89.995, -0.005, 179.995]
    values += [rng.randrange(-180_000, 180_000) / 1000 for _ in range(4000)]
    values += [rng.uniform(-180, 180) for _ in range(1000)]
    rows = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    got = {r.v: r.key for r in rows.select("v", location_key(F.col("v"), F.col("v")).alias("key")).collect()}
    assert {v: k for v, k in got.items() if k != f"{v:.2f},{v:.2f}"} == {}


def test_iso_text(spark):
    rows = spark.createDataFrame([(NOW,), (NOW.replace(microsecond=120),)], "ts TIMESTAMP")
    assert [r[0] for r in rows.select(iso_utc(F.col("ts"))).collect()] == [
        "2026-01-31T12:30:00Z", "2026-01-31T12:30:00.000120Z"]


def test_labels(spark):
    rows = spark.createDataFrame([(20, 1.51), (19, 1.5), (5, None), (4, 0.9), (2, 0.9), (1, 0.9)], "n INT, km DOUBLE")
    got = rows.select(coverage_class(F.col("n")), gap_severity(F.col("km"))).collect()
    assert [tuple(r) for r in got] == [("high", "severe"), ("medium", "desert"), ("medium", "severe"),
                                       ("low", "desert"), ("low", "desert"), ("desert", "desert")]


def test_agency_bounds(spark):
    rows = frame(spark, [position(agency_id="trimet"), position(agency_id="trimet", latitude=45.71),
                         position(agency_id="other", latitude=10.0)], C.VEHICLE_POSITION)
    checked = V.check_agency_bounds(rows, C.default_agencies(spark))
    assert {(r.agency_id, r.latitude): r.violations for r in checked.collect()} == {
        ("trimet", 45.5152): [], ("trimet", 45.71): ["outside_agency_bounds"], ("other", 10.0): []}
