"""The mock fleet through the layers, with answers derived by hand."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from headway.operators import fleet, schedule, spatial
from headway.sources.tables import Layers

NOW = datetime(2026, 1, 31, 12, 30)


@pytest.fixture(scope="module")
def mock_fleet(spark):
    return spark.range(50).select(
        F.concat(F.lit("vehicle_"), "id").alias("vehicle_id"), F.concat(F.lit("trip_"), "id").alias("trip_id"),
        F.concat(F.lit("route_"), F.col("id") % 5).alias("route_id"),
        (45.5152 + F.col("id") * 0.01).alias("latitude"), (-122.6784 + F.col("id") * 0.01).alias("longitude"),
        (F.col("id") * 10 % 360).cast("double").alias("bearing"), (10 + F.col("id") % 20).cast("double").alias("speed"),
        F.lit(NOW).alias("timestamp"), F.lit(None).cast("int").alias("current_stop_sequence"),
        *[F.lit(None).cast("string").alias(c)
          for c in ("stop_id", "current_status", "congestion_level", "occupancy_status")],
        F.lit("test_agency").alias("agency_id"), F.lit(NOW).alias("feed_timestamp"),
    )


def test_layers(spark, mock_fleet, tmp_path):
    layers = Layers(spark, str(tmp_path), prefix="golden_").init()
    assert layers.append_positions(mock_fleet, 0) == 50
    layers.promote(layers.batch("bronze.vehicle_positions", 0), 0, as_of=NOW)
    layers.refresh_hourly()
    assert layers.metrics().first().asDict() == dict(
        bronze_vehicle_positions=50, bronze_trip_updates=0, bronze_weather=0, silver_vehicle_positions=50,
        gold_hourly_metrics=5, data_quality_rate=1.0)
    gold = {r.route_id: r for r in layers.table("gold.hourly_vehicle_metrics").collect()}
    for k in range(5):
        row = gold[f"route_{k}"]
        assert (row.total_vehicles, row.total_observations, row.avg_congestion_score) == (10, 10, 0.0)
        assert row.avg_speed_kmh == pytest.approx(59.4 + 3.6 * k)
        assert row.max_speed_kmh == pytest.approx(90.0 + 3.6 * k)
        assert row.hour_timestamp == datetime(2026, 1, 31, 12)

    # the same load again: bronze doubles, the vehicles are in silver already
    layers.append_positions(mock_fleet, 1)
    layers.promote(layers.batch("bronze.vehicle_positions", 1), 1, as_of=NOW)
    metrics = layers.metrics().first()
    assert (metrics.bronze_vehicle_positions, metrics.silver_vehicle_positions) == (100, 50)
    assert metrics.data_quality_rate == 0.5

    # a batch that runs again leaves everything as it was
    layers.append_positions(mock_fleet, 0)
    layers.promote(layers.batch("bronze.vehicle_positions", 0), 0, as_of=NOW)
    layers.refresh_hourly(0)
    assert layers.metrics().first() == metrics


def test_empty_append(spark, mock_fleet, tmp_path):
    layers = Layers(spark, str(tmp_path), prefix="golden_empty_").init()
    assert layers.append_positions(mock_fleet.limit(0), 0) == 0
    metrics = layers.metrics().first()
    assert (metrics.bronze_vehicle_positions, metrics.data_quality_rate) == (0, 0.0)


def test_fleet_stats(mock_fleet):
    row = fleet.fleet_stats(mock_fleet).first()
    assert (row.active_vehicles, row.routes_covered) == (50, 5)
    assert row.avg_speed_kmh == pytest.approx(66.6)
    assert row.max_speed_kmh == pytest.approx(104.4)


def test_fleet_stats_without_speeds(mock_fleet):
    silent = mock_fleet.withColumn("speed", F.lit(None).cast("double"))
    assert fleet.fleet_stats(silent).first().active_vehicles == 0
    row = fleet.fleet_stats(silent, with_speed_only=False).first()
    assert (row.active_vehicles, row.avg_speed_kmh) == (50, None)


def test_radius(mock_fleet):
    near = spatial.radius_search(mock_fleet, lat=45.5152, lon=-122.6784, radius_m=1000.0).collect()
    assert [r.vehicle_id for r in near] == ["vehicle_0"]


def test_coverage_summary(spark):
    counts = [25, 20, 19, 5, 4, 2, 1, 1]
    stops = [(f"s{c}_{i}", "", 45.0 + 0.01 * c, -122.0) for c, n in enumerate(counts) for i in range(n)]
    frame = spark.createDataFrame(stops, "stop_id STRING, stop_name STRING, stop_lat DOUBLE, stop_lon DOUBLE")
    assert schedule.coverage_summary(frame).first().asDict() == dict(
        total_cells=8, high_cells=2, medium_cells=2, low_cells=2, desert_cells=2, poor_cells=4, poor_percent=50.0,
        desert_percent=25.0, best_to_desert_ratio=25, avg_stops_per_cell=9.625)


def test_coverage_summary_edges(spark):
    ddl = "stop_id STRING, stop_name STRING, stop_lat DOUBLE, stop_lon DOUBLE"
    empty = schedule.coverage_summary(spark.createDataFrame([], ddl)).first()
    assert (empty.total_cells, empty.poor_percent, empty.best_to_desert_ratio) == (0, 0.0, 0)
    desert = schedule.coverage_summary(spark.createDataFrame([("a", "", 45.0, -122.0)], ddl)).first()
    assert (desert.desert_cells, desert.best_to_desert_ratio) == (1, None)


def test_heat_map_upper_edge(spark):
    rows = spark.createDataFrame([(45.7, -122.3), (45.2, -123.0), (45.71, -122.5)], "latitude DOUBLE, longitude DOUBLE")
    grid = fleet.heat_map_grid(rows, min_lat=45.2, max_lat=45.7, min_lon=-123.0, max_lon=-122.3).collect()
    assert {(r.lat_cell, r.lon_cell, r.vehicle_count) for r in grid} == {(20.0, 20.0, 1), (0.0, 0.0, 1)}


def test_slow_zone_routes(spark):
    rows = spark.createDataFrame(
        [(45.501, -122.6, 1.0, "b"), (45.502, -122.6, 1.0, "a"), (45.502, -122.6, 2.0, "a"), (45.9, -122.6, 1.0, None)],
        "latitude DOUBLE, longitude DOUBLE, speed DOUBLE, route_id STRING")
    zones = fleet.slow_zones(rows, threshold_kmh=10.0).collect()
    assert [(r.lat_zone, r.observation_count, r.affected_routes) for r in zones] == [(45.9, 1, None), (45.5, 3, "a, b")]


def test_promoted_ids_are_folded(spark, mock_fleet, tmp_path, monkeypatch):
    """Full copies of the ids every third batch, with and without gaps in the batch ids."""
    monkeypatch.setattr("headway.sources.tables.SEEN_FOLD", 3)
    layers = Layers(spark, str(tmp_path), prefix="fold_").init()
    for n, batch in enumerate([0, 1, 2, 3, 4, 6, 7, 11]):
        # each batch brings two vehicles of the one before and two new ones
        rows = mock_fleet.withColumn("ingestion_timestamp", F.lit(NOW)).where(
            F.substring_index("vehicle_id", "_", -1).cast("int").between(2 * n - 2, 2 * n + 1))
        layers.promote(rows, batch, as_of=NOW)
    silver = layers.table("silver.vehicle_positions")
    assert silver.count() == silver.select("vehicle_id").distinct().count() == 16
    folded = layers.with_partitions("silver.seen_vehicles").groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in folded} == {0: 2, 1: 2, 2: 2, 3: 8, 4: 2, 6: 12, 7: 2, 11: 2}
    assert layers.seen_before(8).count() == 14
