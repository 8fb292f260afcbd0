"""Streams give what the batch gives, however the input is cut and however often it is replayed."""

import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from headway import contracts as C
from headway.operators.flatten import flatten_vehicles
from headway.plans.batch_load import load_messages
from headway.sources.feed import stream_feed
from headway.sources.tables import Layers
from headway.streaming import events
from headway.streaming.medallion import MedallionWriter, progress, start_medallion

START = datetime(2026, 1, 31, 10, 0)
EPOCH = int(START.replace(tzinfo=timezone.utc).timestamp())


def messages(spark, count):
    """One message per ten minutes with three vehicles; every fourth has one vehicle too fast."""
    rows = spark.range(count).withColumn("at", F.lit(EPOCH) + F.col("id") * 600)

    def entity(k, speed):
        return (
            f"named_struct('id', 'e{k}', 'vehicle', named_struct('vehicle', named_struct('id', 'v{k}'), "
            f"'trip', named_struct('trip_id', 't{k}', 'route_id', 'r'), 'position', named_struct('latitude', 45.5D, "
            f"'longitude', -122.6D, 'speed', {speed}), 'timestamp', at, "
            "'current_status', 1, 'congestion_level', 2))")

    return rows.selectExpr(
        "named_struct('timestamp', at) AS header",
        f"array({entity(0, '10.0D')}, {entity(1, 'CAST(id AS DOUBLE)')}, "
        f"{entity(2, 'CASE WHEN id % 4 = 0 THEN 50.0D ELSE 5.0D END')}) AS entity")


def run(spark, path, tmp_path, prefix, **options):
    layers = Layers(spark, f"{tmp_path}/{prefix}", prefix=prefix).init()
    start_medallion(stream_feed(spark, path, file_format="json", **options), layers, checkpoint=f"{tmp_path}/{prefix}-checkpoint",
                    agency_id="city", as_of="feed", gold_every=1, available_now=True).awaitTermination()
    return layers


def test_one_batch_equals_the_batch_run(spark, tmp_path):
    path = f"{tmp_path}/feed"
    messages(spark, 12).coalesce(1).write.json(path)
    streamed = run(spark, path, tmp_path, "s1_")
    batch = Layers(spark, f"{tmp_path}/b1", prefix="b1_")
    load_messages(spark.read.schema(C.FEED_MESSAGE).json(path), batch, agency_id="city", batch_id=0, as_of="feed")
    for table in ("silver.vehicle_positions", "gold.hourly_vehicle_metrics", "bronze.quality_alerts"):
        one = streamed.table(table).drop("ingestion_timestamp")
        two = batch.table(table).drop("ingestion_timestamp")
        assert one.count() > 0 and one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0, table
    # 36 rows of which 3 are too fast
    assert progress(streamed).first().asDict() == dict(
        batches=1, processed_rows=36, valid_rows=33, invalid_rows=3, silver_rows=33)


def test_first_batch_wins_and_a_replay_changes_nothing(spark, tmp_path):
    path = f"{tmp_path}/feed"
    for n in (0, 1):
        messages(spark, 12).where(f"header.timestamp >= {EPOCH} + {n} * 3600 AND "
                                  f"header.timestamp < {EPOCH} + {n + 1} * 3600"
                                  ).coalesce(1).write.mode("append").json(path)
    layers = run(spark, path, tmp_path, "s2_", max_files_per_trigger=1)
    silver = layers.table("silver.vehicle_positions")
    # the second batch brings the same three vehicles, so only the first six messages count
    assert silver.agg(F.max("timestamp")).first()[0] == START + timedelta(minutes=50)
    totals = progress(layers).first()
    assert (totals.batches, totals.processed_rows, totals.silver_rows) == (2, 36, 16)
    before = {r.hour_timestamp: r.total_observations for r in layers.table("gold.hourly_vehicle_metrics").collect()}

    # the last batch again, as after a restart
    again = MedallionWriter(layers, agency_id="city", as_of="feed", gold_every=1)
    replay = f"header.timestamp >= {EPOCH} + 3600"
    again(spark.read.schema(C.FEED_MESSAGE).json(path).where(replay), 1)
    assert progress(layers).first() == totals
    after = {r.hour_timestamp: r.total_observations for r in layers.table("gold.hourly_vehicle_metrics").collect()}
    assert after == before


def position_feed(spark, at, *speeds):
    entities = [{"id": f"e{k}", "vehicle": {
        "vehicle": {"id": f"v{k}"}, "trip": {"trip_id": "t", "route_id": "r"}, "timestamp": at, "current_status": 1,
        "position": {"latitude": 45.5, "longitude": -122.6, "speed": s}, "congestion_level": 2}} for k, s in enumerate(speeds)]
    rows = spark.createDataFrame([(json.dumps({"header": {"timestamp": at}, "entity": entities}),)], "message STRING")
    return rows.select(F.from_json("message", C.FEED_MESSAGE).alias("m")).select("m.*")


def test_a_replay_keeps_its_time_and_leaves_no_old_row(spark, tmp_path):
    layers = Layers(spark, f"{tmp_path}/r", prefix="r_").init()
    feed = position_feed(spark, EPOCH, 10.0, 90.0)
    tables = ("bronze.vehicle_positions", "bronze.quality_alerts", "silver.vehicle_positions", "gold.feed_progress")

    def state():
        return {t: sorted(map(str, layers.table(t).drop("ingestion_timestamp").collect())) for t in tables}

    MedallionWriter(layers, agency_id="city", as_of=START + timedelta(minutes=1))(feed, 0)
    first = state()
    assert [len(first[t]) for t in tables] == [2, 1, 1, 1]
    MedallionWriter(layers, agency_id="city", as_of=START + timedelta(days=1))(feed, 0)
    assert state() == first
    # the batch comes again with rows of another day, then with none
    MedallionWriter(layers, agency_id="city")(position_feed(spark, EPOCH + 86_400, 10.0), 0)
    assert layers.table("bronze.vehicle_positions").count() == 1 and layers.table("bronze.quality_alerts").count() == 0
    MedallionWriter(layers, agency_id="city")(feed.where("false"), 0)
    assert [len(state()[t]) for t in tables] == [0, 0, 0, 1] and progress(layers).first().processed_rows == 0
    assert layers.table("silver.seen_vehicles").count() == 0


def test_rows_without_a_date_are_replaced_too(spark, tmp_path):
    layers = Layers(spark, f"{tmp_path}/n", prefix="n_").init()
    rows = position_rows(spark, [("v1", "r", 1.0, None), ("v2", "r", 1.0, START)])
    for _ in range(2):
        layers.append_positions(rows, 3)
    assert layers.table("bronze.vehicle_positions").count() == 2
    layers.append_positions(rows.where("vehicle_id = 'v2'"), 3)
    assert layers.table("bronze.vehicle_positions").count() == 1


def test_delays_off_the_limits_stay_out_of_gold(spark, tmp_path):
    layers = Layers(spark, f"{tmp_path}/u", prefix="u_").init()
    row = lambda trip, delay: (trip, "r", "v", 1, "s", delay, None, None, None, "SCHEDULED", "city", START)
    layers.append_trip_updates(spark.createDataFrame([row("t1", 60), row("t2", 999_999)], C.TRIP_UPDATE), 0)
    MedallionWriter(layers, agency_id="city", as_of="feed", gold_every=1).settle(0)
    assert [r.avg_delay_seconds for r in layers.table("gold.route_performance").collect()] == [60.0]
    assert [(r.entity_type, r.entity_id) for r in layers.table("bronze.quality_alerts").collect()] == [("trip_update", "t2")]


def test_failed_batch_is_taken_up_again(spark, tmp_path):
    path = f"{tmp_path}/feed"
    messages(spark, 6).coalesce(1).write.json(path)
    layers = Layers(spark, f"{tmp_path}/f", prefix="f_").init()
    writer = MedallionWriter(layers, agency_id="city", as_of="feed", gold_every=1)

    def half_way(rows, batch_id):
        layers.append_positions(flatten_vehicles(rows, agency_id="city"), batch_id)
        raise RuntimeError("lost in the middle")

    def start(function):
        return (stream_feed(spark, path, file_format="json").writeStream.foreachBatch(function)
                .option("checkpointLocation", f"{tmp_path}/f-checkpoint").trigger(availableNow=True).start())

    with pytest.raises(Exception, match="lost in the middle"):
        start(half_way).awaitTermination()
    start(writer).awaitTermination()
    assert layers.table("bronze.vehicle_positions").count() == 18
    assert layers.table("silver.vehicle_positions").count() == 16


def position_rows(spark, rows):
    filled = [(v, None, r, 45.5, -122.6, None, s, at, None, None, None, "STOP_AND_GO", None, "city", at)
              for v, r, s, at in rows]
    return spark.createDataFrame(filled, C.VEHICLE_POSITION)


def collect(spark, stream, tmp_path, name):
    out = f"{tmp_path}/{name}"
    stream.writeStream.format("parquet").option("checkpointLocation", f"{out}-checkpoint").trigger(
        availableNow=True).start(out).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out).collect()


def test_hourly_stream_over_time_ordered_files(spark, tmp_path):
    path = f"{tmp_path}/positions"
    for hour in range(4):
        at = START + timedelta(hours=hour)
        position_rows(spark, [("v1", "r", 1.0, at + timedelta(minutes=5)), ("v1", "r", 3.0, at + timedelta(minutes=6)),
                              ("v2", "r", None, at + timedelta(minutes=17)), ("v3", None, 1.0, at)]
                      ).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(C.VEHICLE_POSITION).option("maxFilesPerTrigger", 1).parquet(path)
    rows = collect(spark, events.hourly_metrics(stream), tmp_path, "hourly")
    # the last hour stays open
    assert sorted(r.hour_timestamp for r in rows) == [START + timedelta(hours=h) for h in range(3)]
    for r in rows:
        assert (r.total_vehicles, r.total_observations, r.avg_congestion_score) == (2, 3, 2.0)
        assert (r.avg_speed_kmh, r.max_speed_kmh) == (pytest.approx(7.2), pytest.approx(10.8))


def test_replayed_delivery_is_dropped(spark, tmp_path):
    path = f"{tmp_path}/positions"
    for _ in range(3):
        position_rows(spark, [("v1", "r", 1.0, START), ("v2", "r", 1.0, START)]).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(C.VEHICLE_POSITION).option("maxFilesPerTrigger", 1).parquet(path)
    assert sorted(r.vehicle_id for r in collect(spark, events.deduplicated(stream), tmp_path, "dedup")) == ["v1", "v2"]


def test_freshness_is_measured_at_the_batch(spark, tmp_path):
    path = f"{tmp_path}/positions"
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    position_rows(spark, [("old", "r", 1.0, now - timedelta(hours=1)), ("new", "r", 1.0, now)]).write.parquet(path)
    stream = spark.readStream.schema(C.VEHICLE_POSITION).parquet(path)
    assert [r.vehicle_id for r in collect(spark, events.fresh_only(stream), tmp_path, "fresh")] == ["new"]
    found = collect(spark, events.alert_stream(stream, as_of=now.replace(tzinfo=None)), tmp_path, "alerts")
    assert [(r.entity_id, r.alert_type) for r in found] == [("old", "STALE_DATA")]


def weather_join(spark, tmp_path, positions, observations, **options):
    """Rows and progress of the stream join; each part is a file, and a last one far ahead closes all before it."""
    ahead = START + timedelta(days=60)
    parts = [*positions, [("ahead", ahead, "ahead", 0.0)]], [*observations, [("ahead", ahead, 0, 0.0)]]
    for name, files in zip(("positions", "weather"), parts):
        for part in files:
            if name == "positions":
                frame = spark.createDataFrame([(v, None, "r", 45.5, -122.6, None, s, at, None, None, None, None, None, a, at)
                                               for v, at, a, s in part], C.VEHICLE_POSITION)
            else:
                frame = spark.createDataFrame([(45.5, -122.6, c, 0.0, 0.0, w, f"W{w}", at, a)
                                               for a, at, w, c in part], C.WEATHER_OBSERVATION)
            frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    read = lambda schema, name: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}")
    joined = events.with_weather(read(C.VEHICLE_POSITION, "positions"), read(C.WEATHER_OBSERVATION, "weather"), **options)
    query = joined.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(
        availableNow=True).start(f"{tmp_path}/joined")
    query.awaitTermination()
    return spark.read.schema(joined.schema).parquet(f"{tmp_path}/joined").collect(), query.recentProgress


@pytest.mark.parametrize("max_age_s, salts", [(3600, 1), (3601, 3), (7, 1), (0, 2)])
def test_weather_join_equals_a_plain_search(spark, tmp_path, max_age_s, salts):
    rng = random.Random(max_age_s)

    def moment():
        # ties, exact age limits, and instants apart by less than a second, over many slots
        middle = START + timedelta(hours=3)
        if rng.random() < 0.2:
            return middle
        if rng.random() < 0.5:
            return middle + timedelta(seconds=rng.randrange(-2 * max_age_s - 2, 2 * max_age_s + 3))
        return START + timedelta(microseconds=rng.randrange(int(20e6 * (max_age_s + 1))))

    positions = [(f"v{k}", moment() if k % 41 else None, rng.choice(["a", "b", "b", None]), rng.choice([None, 0.0, 2.0]))
                 for k in range(300)]
    positions += positions[:40]
    observations = [(rng.choice(["a", "b", "b", None]), moment() if k % 31 else None, rng.randrange(3), float(rng.randrange(3)))
                    for k in range(200)]
    cut = lambda rows: [rows[k::3] for k in range(3)]
    # the weather comes a file after its positions
    rows, _ = weather_join(spark, tmp_path, cut(positions), [[], *cut(observations)], max_age_s=max_age_s,
                           late_by="30 days", weather_late_by="30 days", salts=salts)
    want = set()
    for v, at, a, s in positions:
        if at is not None:
            fit = [(o, f"W{w}", w, c) for b, o, w, c in observations
                   if a is not None and a == b and o is not None and o <= at <= o + timedelta(seconds=max_age_s)]
            want.add((v, at, a, s, *max(fit, default=(None,) * 4)))
    got = [(r.vehicle_id, r.timestamp, r.agency_id, r.speed, r.observation_time, r.weather_condition, r.weather_code,
            r.temperature_celsius) for r in rows]
    assert len(got) == len(want) and set(got) == want
    assert any(r[4] for r in got) and not all(r[4] for r in got)


def test_weather_join_pairs_no_position_with_all_observations(spark, tmp_path):
    """One agency's crowded hour: the state has a row per slot, where a join would hold and meet each position and observation."""
    hour = START + timedelta(hours=1)
    positions = [(f"v{k}", hour + timedelta(seconds=k % 3600, microseconds=k), "a", 1.0) for k in range(8000)]
    observations = [("a", hour + timedelta(seconds=k % 3600), k % 100, float(k)) for k in range(4000)]
    rows, batches = weather_join(spark, tmp_path, [positions], [observations], late_by="1 day", weather_late_by="1 day")
    assert len(rows) == 8000
    newest = {o: max((f"W{w}", w) for _, p, w, _ in observations if p == o) for o in {o for _, o, _, _ in observations}}
    for r in rows:
        at = r.timestamp.replace(microsecond=0)
        assert (r.observation_time, (r.weather_condition, r.weather_code)) == (at, newest[at])
    states = [s for b in batches for s in b.stateOperators]
    assert {s.operatorName for s in states} == {"stateStoreSave"}
    assert 0 < max(s.numRowsTotal for s in states) < 50
