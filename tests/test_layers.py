"""The tables of the run: merged gold, staged upserts, compaction, bucketed ids, the outbox, dead letters, agency areas."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from headway import contracts as C
from headway.operators.fleet import gold_hourly
from headway.sources.feed import dead_letters, readable, scan_feed
from headway.sources.tables import Layers, RetiredBatch
from headway.sources.topics import to_folder
from headway.streaming.medallion import MedallionWriter, deliver, progress
from tests.test_plans import plan_of
from tests.test_streaming import EPOCH, START, position_feed, position_rows

GOLD = "gold.hourly_vehicle_metrics"
KEYS = ["hour_timestamp", "agency_id", "route_id"]


@pytest.fixture
def layers(spark, tmp_path):
    return Layers(spark, f"{tmp_path}/l", prefix=f"l{abs(hash(str(tmp_path))) % 10**9}_").init()


def gold(layers):
    return {(r.hour_timestamp, r.route_id): (r.total_vehicles, r.total_observations) for r in layers.table(GOLD).collect()}


def stamped(spark, rows):
    return position_rows(spark, rows).withColumn("ingestion_timestamp", F.lit(START))


def put(layers, rows, batch):
    layers.append_positions(rows, batch)
    layers.write_batch("silver.vehicle_positions", layers.batch("bronze.vehicle_positions", batch), batch)
    layers.add_partials("gold.hourly_partials", batch)


def test_gold_adds_up_over_batches_and_counts_a_vehicle_once(spark, layers):
    hour, later = START, START + timedelta(hours=1)
    put(layers, position_rows(spark, [("v1", "r", 1.0, hour), ("v2", "r", None, hour)]), 0)
    put(layers, position_rows(spark, [("v1", "r", 3.0, hour), (None, "r", 2.0, hour), ("v1", "r", 9.0, later)]), 1)
    layers.refresh_hourly()
    assert gold(layers) == {(hour, "r"): (2, 4), (later, "r"): (1, 1)}
    both = layers.table("silver.vehicle_positions")
    assert layers.table(GOLD).exceptAll(gold_hourly(both).select([F.col(f.name).cast(f.dataType) for f in layers.table(GOLD).schema])).count() == 0
    # a replay that no longer has an hour takes its rows out of gold at once
    put(layers, position_rows(spark, [("v3", "r", 3.0, hour)]), 1)
    layers.refresh_hourly(1)
    assert gold(layers) == {(hour, "r"): (3, 3)}


def test_promoted_rows_reach_gold_with_the_next_refresh(spark, layers):
    rows = [("v1", "r", 1.0, START), ("v2", "r", 2.0, START)]
    for batch, history in ((0, False), (1, True)):
        later = START + timedelta(hours=batch)
        layers.append_positions(position_rows(spark, [(*r[:3], later) for r in rows]), batch)
        layers.promote(layers.batch("bronze.vehicle_positions", batch), batch, as_of=later, history=history)
    layers.refresh_hourly()
    assert gold(layers) == {(START, "r"): (2, 2), (START + timedelta(hours=1), "r"): (2, 2)}


def test_a_refresh_reads_touched_hours_only(spark, layers):
    for batch in range(3):
        put(layers, position_rows(spark, [("v1", "r", 1.0, START + timedelta(days=batch, hours=batch))]), batch)
    marks = layers._touched("gold.hourly_partials", 2)
    assert len(marks) == 1
    rows = layers.partials_of("gold.hourly_partials", marks)
    plan = plan_of(rows)
    assert "PartitionFilters" in plan and "EqualTo(hour_timestamp" in plan and len(rows.inputFiles()) >= 1
    assert [r.hour_timestamp for r in rows.collect()] == [START + timedelta(days=2, hours=2)]
    layers.refresh_hourly()
    files = lambda: {(r[0], r[1]) for r in layers.table(GOLD).select("hour_timestamp", F.input_file_name()).collect()}
    before = files()
    layers.refresh_hourly(2)
    # other dates keep their files
    assert sorted(h for h, _ in before & files()) == [START, START + timedelta(days=1, hours=1)]


def test_an_upsert_is_not_seen_before_its_commit(spark, layers):
    row = lambda hour, n: spark.createDataFrame([(hour, "city", "r", 1, 1.0, 1.0, 0.0, n)], C.HOURLY_METRICS)
    layers.upsert(GOLD, row(START, 1).unionByName(row(START + timedelta(days=1), 1)), KEYS)
    staged = layers.stage_upsert(GOLD, row(START, 2).unionByName(row(START + timedelta(days=2), 2)), KEYS)
    assert sorted(r.total_observations for r in layers.table(GOLD).collect()) == [1, 1]
    staged.commit()
    staged.commit()
    assert sorted(r.total_observations for r in layers.table(GOLD).collect()) == [1, 2, 2]
    # of several changes for a key the one that comes last counts; a row named in ``replace`` goes without one
    layers.upsert(GOLD, row(START, 5).unionByName(row(START, 4)), KEYS, order_by="total_observations",
                  replace=row(START + timedelta(days=2), 0).select("hour_timestamp"))
    assert sorted(r.total_observations for r in layers.table(GOLD).collect()) == [1, 5]


def test_compaction_keeps_rows_and_refuses_old_batches(spark, layers, monkeypatch):
    for batch in range(6):
        put(layers, position_rows(spark, [(f"v{batch}", "r", 1.0, START + timedelta(days=batch // 3)), ("w", "r", 2.0, START)]), batch)
        layers.write_batch("gold.feed_progress", spark.createDataFrame([(2, 2, 0, 2)], "processed_rows BIGINT, valid_rows BIGINT, "
                           "invalid_rows BIGINT, silver_rows BIGINT").withColumn("as_of", F.lit(None).cast("timestamp")), batch)
    names = ("bronze.vehicle_positions", "silver.vehicle_positions", "gold.feed_progress")
    state = lambda: {n: sorted(map(str, layers.table(n).collect())) for n in names}
    before, totals = state(), progress(layers).first()
    # cut short after the rows are written, before they count
    with monkeypatch.context() as m:
        m.setattr(layers, "_drop_batches", lambda table, low: (_ for _ in ()).throw(RuntimeError("lost")) if low >= 0 else None)
        with pytest.raises(RuntimeError):
            layers.compact(keep=2, tables=["bronze.vehicle_positions"])
    assert state() == before
    assert layers.compact(keep=2)["bronze.vehicle_positions"] == 3
    assert state() == before and progress(layers).first() == totals
    assert {b for _, b in layers.partitions("bronze.vehicle_positions")} == {-1, 4, 5}
    assert len(layers.partitions("bronze.vehicle_positions")) == 6  # three on each of two dates; nine before
    layers.refresh_hourly()
    assert gold(layers) == {(START, "r"): (4, 9), (START + timedelta(days=1), "r"): (3, 3)}
    with pytest.raises(RetiredBatch):
        put(layers, position_rows(spark, [("x", "r", 1.0, START)]), 3)
    put(layers, position_rows(spark, [("x", "r", 1.0, START)]), 5)
    assert layers.table("bronze.vehicle_positions").count() == 11
    assert layers.compact(keep=2)["bronze.vehicle_positions"] == 3 and layers.compact(keep=0)["bronze.vehicle_positions"] == 5
    assert layers.table("bronze.vehicle_positions").count() == 11
    folded = layers.table("gold.hourly_partials")
    assert folded.count() == layers.table("bronze.vehicle_positions").select("vehicle_id", F.date_trunc("hour", "feed_timestamp")).distinct().count() + 1


def test_promoted_ids_are_not_shuffled(spark, layers):
    layers.promote(stamped(spark, [(f"v{i}", "r", 1.0, START) for i in range(50)]), 0, as_of=START)
    from headway.operators.medallion import first_batch_only

    rows = position_rows(spark, [("v1", "r", 1.0, START), ("new", "r", 1.0, START), ("new", "r", 2.0, START), (None, "r", 2.0, START)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = first_batch_only(rows, layers.seen_before(1))
        assert sorted(r.speed for r in fresh.collect()) == [1.0, 2.0]
        plan = plan_of(fresh)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = [i for i, line in enumerate(plan.split("\n")) if "seen_vehicles" in line and "Bucketed: true" in line]
    assert scans and "LeftAnti" in plan
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if "LeftAnti" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*(0123456789)"))
    below = [line for line in lines[at + 1:] if depth(line) > depth(lines[at])]
    right = "\n".join(below[next(i for i, line in enumerate(below) if "seen_vehicles" in line) - 4:])
    assert "Exchange" not in right.split("seen_vehicles")[0]


def test_history_keeps_new_times_of_known_vehicles(spark, layers):
    at = START + timedelta(minutes=1)
    layers.promote(stamped(spark, [("v1", "r", 1.0, START)]), 0, as_of=at, history=True)
    layers.promote(stamped(spark, [("v1", "r", 1.0, START), ("v1", "r", 1.0, at)]), 1, as_of=at, history=True)
    assert sorted(r.timestamp for r in layers.table("silver.vehicle_positions").collect()) == [START, at]


def test_a_batch_is_delivered_once(spark, layers, tmp_path):
    sent, folder = [], f"{tmp_path}/sent"

    def publish(messages, batch_id):
        to_folder(folder)(messages, batch_id)
        sent.append(batch_id)
        if len(sent) == 1:
            raise RuntimeError("lost after sending")

    feed = position_feed(spark, EPOCH, 10.0, 90.0)
    writer = MedallionWriter(layers, agency_id="city", as_of="feed", publish=publish)
    with pytest.raises(RuntimeError):
        writer(feed, 0)
    assert layers.table("gold.feed_progress").count() == 0
    writer(feed, 0)
    writer(feed, 0)
    assert sent == [0, 0] and not deliver(layers, 0, publish)
    rows = spark.read.schema(C.MESSAGE).json(f"{folder}/batch=0").collect()
    assert sorted((r.topic, r.key) for r in rows) == [("transit.quality.alerts", "v1"), ("transit.vehicle.positions", "v0")]
    assert [r.messages for r in layers.table("silver.deliveries").collect()] == [2]


def test_broken_lines_are_kept_and_no_messages(spark, layers, tmp_path):
    lines = ['{"header": {"timestamp": 1}, "entity": []}', '{"header": {"timestamp"', "", '{"header": {"timestamp": "soon"}, "entity": []}', "[]x"]
    path = f"{tmp_path}/lines.json"
    with open(path, "w") as f:
        f.write("\n".join(lines))
    messages = scan_feed(spark, path, file_format="json", keep_unreadable=True).cache()
    assert sorted(r.message for r in dead_letters(messages).collect()) == sorted([lines[1], lines[3], lines[4]])
    assert [r.header.timestamp for r in readable(messages).collect()] == [1]
    MedallionWriter(layers, agency_id="city", as_of="feed")(messages, 0)
    assert layers.table("bronze.dead_letters").count() == 3
    with pytest.raises(ValueError):
        scan_feed(spark, path, keep_unreadable=True)


def test_positions_outside_their_area_raise_alerts(spark, layers):
    agencies = spark.createDataFrame([("city", 45.0, 45.2, -123.0, -122.0), ("other", 0.0, 1.0, 0.0, 1.0)],
                                     "agency_id STRING, min_latitude DOUBLE, max_latitude DOUBLE, min_longitude DOUBLE, max_longitude DOUBLE")
    feed = position_feed(spark, EPOCH, 10.0)
    MedallionWriter(layers, agency_id="city", as_of="feed", agencies=agencies)(feed, 0)
    assert [(r.alert_type, r.error_message) for r in layers.table("bronze.quality_alerts").collect()] == [
        ("GEOGRAPHIC_VIOLATION", "outside_agency_bounds")]
    assert layers.table("silver.vehicle_positions").count() == 0 and layers.table("bronze.vehicle_positions").count() == 1
    wide = agencies.withColumn("max_latitude", F.lit(46.0))
    MedallionWriter(layers, agency_id="city", as_of="feed", agencies=lambda batch: wide if batch else agencies)(feed, 1)
    assert layers.table("silver.vehicle_positions").count() == 1


def test_appends_return_what_they_wrote(spark, layers):
    rows = position_rows(spark, [("v1", "r", 1.0, START), ("v2", "r", 1.0, datetime(2026, 2, 1))])
    assert [layers.append_positions(rows, 0), layers.append_positions(rows.limit(0), 0), layers.append_positions(rows, 1)] == [2, 0, 2]
    assert layers.table("bronze.vehicle_positions").count() == 2
