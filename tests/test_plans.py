"""What the physical plans may and may not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from headway.operators import fleet, spatial
from headway.operators.medallion import silver_filter
from headway.operators.skew import salted_join

SF_DIR = "/root/testdata/sf0.001"
# these run streams first
STREAMS = ("stream_", "compact_layers", "dead_letters")
BATCH = sorted(n for n in entry.queries() if not n.startswith(STREAMS))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_nested_loops_and_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "PythonUDF", "InPandas"):
        assert word not in plan


@pytest.fixture(scope="module")
def stored_positions(spark, tmp_path_factory):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    path = str(tmp_path_factory.mktemp("positions") / "p")
    rows = spark.range(100).selectExpr(
        "CAST(id AS STRING) AS vehicle_id", "CAST(id % 3 AS STRING) AS route_id", "45.5D AS latitude",
        "-122.5D AS longitude", "10D AS speed", "TIMESTAMP '2026-01-31 12:00:00' AS timestamp",
        "'x' AS stop_id", "'city' AS agency_id", "'STOP_AND_GO' AS congestion_level")
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_silver_filter_reaches_the_scan(stored_positions):
    plan = plan_of(silver_filter(stored_positions, as_of="2026-01-31").select("vehicle_id"))
    pushed = plan[plan.index("PushedFilters"):]
    for column in ("latitude", "longitude", "timestamp", "speed"):
        assert column in pushed[: pushed.index("ReadSchema")]


def test_radius_box_reaches_the_scan(stored_positions):
    plan = plan_of(spatial.radius_search(stored_positions, lat=45.5, lon=-122.5, ordered=False).select("vehicle_id"))
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(latitude" in pushed and "LessThanOrEqual(longitude" in pushed


def test_gold_reads_only_its_columns(stored_positions):
    plan = plan_of(fleet.gold_hourly(stored_positions))
    assert "stop_id" not in plan[plan.index("ReadSchema"):]


def test_silver_partitions_are_pruned_for_gold(spark, tmp_path, stored_positions):
    from headway.sources.tables import Layers

    layers = Layers(spark, str(tmp_path), prefix="plan_").init()
    silver = layers.with_partitions("silver.vehicle_positions")
    touched = silver.where("batch_id >= 3").select("event_date").distinct()
    plan = plan_of(silver.join(F.broadcast(touched), "event_date", "left_semi"))
    assert "batch_id" in plan[plan.index("PartitionFilters"):]


def test_salted_join_spreads_one_key_and_stays_exact(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        large = spark.range(0, 3000, 1, 4).selectExpr("'hot' AS k", "id")
        small = spark.createDataFrame([("hot", 1), ("hot", 2), ("cold", 3)], "k STRING, v INT")
        joined = salted_join(large, small, ["k"], spread_by=["id"], salts=16)
        assert joined.count() == 6000
        sizes = [r.n for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) > 1 and max(sizes) < 6000
        assert salted_join(large, small, ["k"], "left_anti", spread_by=["id"]).count() == 0
        assert salted_join(large, small, ["k"], "left_semi", spread_by=["id"]).count() == 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_salted_join_refuses_outer_kinds(spark):
    one = spark.createDataFrame([(1,)], "k INT")
    with pytest.raises(ValueError):
        salted_join(one, one, ["k"], "full", spread_by=["k"])
