"""Schedule files, feed snapshots, topic messages and flattening of odd entities."""

import json
from datetime import datetime

import pytest

from headway import contracts as C
from headway.operators import schedule as S
from headway.operators.flatten import flatten_trip_updates, flatten_vehicles
from headway.operators.medallion import first_batch_only, first_per_event, upsert
from headway.operators.validate import coerce_types, feed_stats
from headway.plans.map_layers import write_map_layers
from headway.plans.schedule_report import schedule_report
from headway.sources import schedule, topics
from headway.sources.feed import scan_feed

NOW = datetime(2026, 1, 31, 12, 30)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("gtfs")
    (path / "stops.txt").write_text(
        "stop_lat,stop_id,stop_name,stop_lon,zone\n45.51,1,\"Main, 1st\",-122.67,B\n45.52,2,,-122.68,B\n",
        encoding="utf-8-sig")
    (path / "routes.txt").write_text(
        "route_id,route_short_name,route_long_name,route_type\n100,B,Blue Line,0\n4,4,Fessenden,3\n9,9,Ferry,4\n")
    (path / "trips.txt").write_text("route_id,service_id,trip_id\n100,W,t1\n100,W,t2\n4,W,t3\n")
    (path / "stop_times.txt").write_text(
        "trip_id,arrival_time,stop_id\nt1,08:00:00,1\nt1,08:05:00,2\nt2,08:00:00,1\nt3,09:00:00,2\n")
    return str(path)


def test_stops(spark, folder):
    rows = [r.asDict() for r in schedule.load_stops(spark, folder).orderBy("stop_id").collect()]
    assert rows == [
        dict(stop_id="1", stop_name="Main, 1st", stop_lat=45.51, stop_lon=-122.67, location_type="0", parent_station=""),
        dict(stop_id="2", stop_name="", stop_lat=45.52, stop_lon=-122.68, location_type="0", parent_station="")]


def test_bundle(spark, folder):
    bundle = schedule.load_schedule_bundle(spark, folder)
    assert {r.table_name: r.records for r in schedule.bundle_counts(bundle).collect()} == {
        "stops": 2, "routes": 3, "trips": 3}
    assert bundle["routes"].schema["route_type"].dataType.simpleString() == "int"
    assert bundle["trips"].columns == list(C.TRIP_COLUMNS)


def test_missing_required_column(spark, tmp_path):
    (tmp_path / "stops.txt").write_text("stop_id,stop_lat\n1,45\n")
    with pytest.raises(ValueError, match="stop_lon"):
        schedule.load_stops(spark, str(tmp_path))


def test_scan_infers_types(spark, folder):
    kinds = dict(schedule.scan_gtfs_csv(spark, f"{folder}/routes.txt").dtypes)
    assert (kinds["route_id"], kinds["route_short_name"], kinds["route_type"]) == ("int", "string", "int")


def test_report(spark, folder, tmp_path):
    report = schedule_report(spark, folder)
    assert [(r.route_short_name, r.unique_stops) for r in report["longest_routes"].collect()] == [("B", 2), ("4", 1)]
    assert {r.route_type: r.type_label for r in report["routes_by_type"].collect()} == {
        0: "Tram/Light Rail", 3: "Bus", 4: "Other"}
    assert report["desert_summary"].first().bus_routes == 1
    assert [r.stop_id for r in report["downtown_stops"].collect()] == ["1", "2"]
    write_map_layers(schedule.load_stops(spark, folder), str(tmp_path))
    assert spark.read.json(f"{tmp_path}/coverage_cells").count() == 2


def test_monitored_and_unknown_routes(spark, folder):
    routes = schedule.load_routes(spark, folder)
    watched = S.monitored_routes(routes, C.default_agencies(spark))
    assert {r.route_id for r in watched.collect()} == {"100", "4"}
    rows = spark.createDataFrame([("v", "100", "1"), ("v", "x", "7"), ("v", None, None)],
                                 "vehicle_id STRING, route_id STRING, stop_id STRING")
    assert [r.route_id for r in S.unknown_routes(rows, routes).collect()] == ["x"]
    named = S.with_schedule_names(rows, routes, schedule.load_stops(spark, folder)).collect()
    assert {(r.route_id, r.route_long_name, r.stop_name) for r in named} == {
        ("100", "Blue Line", "Main, 1st"), ("x", None, None), (None, None, None)}


ENTITIES = [
    {"id": "1", "vehicle": {"vehicle": {"id": "A"}, "trip": {"trip_id": "t", "route_id": "r"},
                            "position": {"latitude": 45.0, "longitude": -122.0, "speed": 3.0},
                            "timestamp": 1769862600, "current_status": 9, "congestion_level": 1}},
    {"id": "2", "vehicle": {"position": {"latitude": 45.0, "longitude": -122.0}}},
    {"id": "3", "vehicle": {"vehicle": {}, "position": {"latitude": 45.0, "longitude": -122.0}}},
    {"id": "4", "vehicle": {"vehicle": {"id": "B"}}},
    {"id": "5"},
    {"id": "6", "trip_update": {"trip": {"trip_id": "t9"}, "stop_time_update": [
        {"stop_sequence": 3, "stop_id": "s", "arrival": {"delay": 60, "time": 1769862600}, "schedule_relationship": 1},
        {"schedule_relationship": 8}]}},
    {"id": "7", "trip_update": {"stop_time_update": [{"stop_id": "s"}]}},
]


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("feed") / "snapshot.json"
    path.write_text(json.dumps({"header": {"timestamp": 1769862615}, "entity": ENTITIES}) + "\n")
    return scan_feed(spark, str(path), file_format="json")


def test_flatten_odd_vehicles(feed):
    rows = flatten_vehicles(feed, agency_id="city").collect()
    at, sent = datetime(2026, 1, 31, 12, 30), datetime(2026, 1, 31, 12, 30, 15)
    assert [(r.vehicle_id, r.timestamp, r.current_status, r.congestion_level, r.route_id) for r in rows] == [
        ("A", at, None, "RUNNING_SMOOTHLY", "r"), ("2", sent, None, None, None), ("", sent, None, None, None)]


def test_flatten_odd_updates(feed):
    rows = flatten_trip_updates(feed, agency_id="city").collect()
    assert [(r.trip_id, r.stop_sequence, r.stop_id, r.arrival_delay, r.schedule_relationship) for r in rows] == [
        ("t9", 3, "s", 60, "SKIPPED"), ("t9", 0, "", None, "SCHEDULED")]


def test_feed_stats(feed):
    row = feed_stats(feed, agency_id="city", as_of="feed").first()
    # valid: vehicles A and 2 and one stop update; invalid: the empty id and the one without a position
    assert (row.total_polls, row.total_entities, row.valid_entities, row.invalid_entities) == (1, 7, 3, 2)
    assert row.validation_rate == pytest.approx(3 / 7)
    assert row.row_validation_rate == pytest.approx(3 / 6)
    empty = feed_stats(feed.limit(0), agency_id="city").first()
    assert (empty.total_entities, empty.success_rate, empty.validation_rate) == (0, 0.0, 0.0)


def test_messages(spark):
    rows = spark.createDataFrame([("4012", None, 12.5, NOW)],
                                 "vehicle_id STRING, route_id STRING, speed DOUBLE, timestamp TIMESTAMP")
    message = topics.vehicle_messages(rows).first()
    assert (message.key, message.topic) == ("4012", "transit.vehicle.positions")
    assert json.loads(message.value) == {
        "vehicle_id": "4012", "route_id": None, "speed": 12.5, "timestamp": "2026-01-31T12:30:00Z"}
    alerts = spark.createDataFrame([("a", None)], "entity_id STRING, agency_id STRING")
    assert topics.alert_messages(alerts).first().topic == "transit.quality.alerts"


def test_consumer_options():
    options = topics.consumer_options(["a", "b"], servers="host:9092")
    assert options["subscribe"] == "a,b"
    assert options["startingOffsets"] == "latest"
    assert "maxOffsetsPerTrigger" not in options


def test_not_in_rules(spark):
    rows = spark.createDataFrame([("a", NOW, 1.0, 1.0), ("a", NOW, 1.0, 1.0), ("b", NOW, 1.0, 1.0), (None, NOW, 1.0, 1.0)],
                                 "vehicle_id STRING, timestamp TIMESTAMP, latitude DOUBLE, longitude DOUBLE")

    def passed(*ids):
        seen = spark.createDataFrame([(i,) for i in ids], "vehicle_id STRING")
        return sorted(r.vehicle_id or "" for r in first_batch_only(rows, seen).collect())

    assert passed() == ["", "a", "a", "b"]
    assert passed("b", "c") == ["a", "a"]
    assert passed("b", None) == []
    seen = rows.where("vehicle_id = 'b'")
    assert [r.vehicle_id for r in first_per_event(rows.where("vehicle_id IS NOT NULL"), seen).collect()] == ["a"]


def test_upsert_keeps_one_change_per_key(spark):
    old = spark.createDataFrame([(1, "a", 0)], "k int, v string, at int")
    new = spark.createDataFrame([(1, "b", 2), (1, "z", 1), (2, "c", 1), (2, "c", 1)], "k int, v string, at int")
    assert {tuple(r) for r in upsert(old, new, ["k"], order_by="at").collect()} == {(1, "b", 2), (2, "c", 1)}
    assert upsert(old, new, ["k"], order_by="at").count() == 2


def test_quoted_schedule_fields(spark, tmp_path):
    from headway.sources.schedule import load_stops

    (tmp_path / "stops.txt").write_text('stop_id,stop_name,stop_lat,stop_lon\n1,"The ""Old"" Mill, east",45.5,-122.6\n')
    row = load_stops(spark, str(tmp_path)).first()
    assert (row["stop_name"], row["stop_lat"], row["stop_lon"]) == ('The "Old" Mill, east', 45.5, -122.6)


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING")
    new = spark.createDataFrame([("c", 2), ("d", 3)], "v STRING, k INT")
    assert {tuple(r) for r in upsert(old, new, ["k"]).collect()} == {(1, "a"), (2, "c"), (3, "d")}


def test_coercion(spark):
    rows = spark.createDataFrame(
        [(" 12.5 ", "5", "2026-01-31T12:30:00Z"), ("x", "5.0", None), (None, "5.5", "soon"), ("1e2", "", "2026-01-31")],
        "speed STRING, seq STRING, ts STRING")
    got = coerce_types(rows, {"speed": "double", "seq": "int", "ts": "timestamp"}).collect()
    assert [(r.speed, r.seq, r.ts, r.violations) for r in got] == [
        (12.5, 5, NOW, []), (None, 5, None, ["speed_not_double"]), (None, None, None, ["seq_not_int", "ts_not_timestamp"]),
        (100.0, None, datetime(2026, 1, 31), ["seq_not_int"])]
