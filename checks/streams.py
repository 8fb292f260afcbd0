"""Queries that run a stream over the tables to its end and return what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import query
from checks.functions import POSITION_COLUMNS
from checks.joins import GOLD_SQL, asof_sql, rounded_gold
from checks.sources import as_observations, as_positions, layers
from checks.validation import (
    UPDATE_RULES_SQL, VEHICLE_RULES_FEED_SQL, VEHICLE_RULES_SQL, WEATHER_RULES_SQL, bad_sql, case_sql, names_sql,
)
from checks.views import AS_OF, POSITIONS, TRIP_UPDATES, WEATHER, rounded, rounded_sql
from headway import contracts as C
from headway.functions.codes import weather_condition
from headway.operators.validate import feed_stats
from headway.sources import topics
from headway.sources.feed import scan_feed, stream_feed
from headway.sources.tables import RetiredBatch
from headway.streaming import events, medallion


# the month of the events in twelve parts; hours and days lie across their borders
PARTS, PART_S, FIRST_S = 12, 217_000, 1_704_067_200
# files of one part; a micro-batch takes that many
PART_FILES = 2


def raw_stream(t, name):
    """A file of the driver's tables as a stream."""
    return t.spark.readStream.schema(t.raw(name).schema).option("pathGlobFilter", f"{name}.parquet").parquet(t.dir)


def position_stream(t):
    """The events file as a stream."""
    return raw_stream(t, "events").selectExpr(*POSITIONS)


def in_time_order(rows, seconds):
    """Rows in twelve parts by a column of seconds."""
    part = F.least(F.lit(PARTS - 1), F.floor((seconds - FIRST_S) / PART_S))
    return [rows.where(part == k) for k in range(PARTS)]


def part_sql(column):
    return f"LEAST({PARTS - 1}, (epoch_us({column}) // 1000000 - {FIRST_S}) // {PART_S})"


def stored(t, parts, label):
    """Frames written one after the other in a few files each, so that a stream takes up one after the other."""
    path = t.scratch(label)
    for part in parts:
        part.repartition(PART_FILES).write.mode("append").parquet(path)
    return path


def to_files(t, stream, *, mode="append"):
    """Run a stream to its end into Parquet files and read them."""
    out = t.scratch("out")
    stream.writeStream.format("parquet").outputMode(mode).option(
        "checkpointLocation", t.scratch("checkpoint")).trigger(availableNow=True).start(out).awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(out)


RUNS = {}


def finished_run(t):
    """Tables and published messages of one run over all messages, gold every four batches.

    Made once in an application for the queries that read what a run leaves; a replay leaves it as it was.
    """
    key = (t.spark.sparkContext.applicationId, t.dir)
    if key not in RUNS:
        sent = t.scratch("published")
        RUNS[key] = run_medallion(t, gold_every=4, publish=topics.to_folder(sent)), sent
    return RUNS[key]


def run_medallion(t, **options):
    """The continuous run over the nested feed in twelve micro-batches; age is measured against the feed time."""
    path = stored(t, in_time_order(t.feed, F.col("header.timestamp")), "messages")
    tables = layers(t)
    medallion.start_medallion(
        stream_feed(t.spark, path, max_files_per_trigger=PART_FILES), tables, checkpoint=t.scratch("checkpoint"),
        agency_id="city", as_of="feed", available_now=True, **options).awaitTermination()
    return tables


VALID_SQL = f"SELECT * FROM flat_vehicles WHERE NOT {bad_sql(VEHICLE_RULES_FEED_SQL)}"
# a vehicle enters silver with its first batch only
FIRST_SQL = f"""SELECT * EXCLUDE b FROM (SELECT *, {part_sql("feed_timestamp")} AS b FROM ({VALID_SQL}))
QUALIFY b = MIN(b) OVER (PARTITION BY vehicle_id)"""
GOLD_TABLE_SQL = GOLD_SQL.replace("COUNT(DISTINCT vehicle_id)", "CAST(COUNT(DISTINCT vehicle_id) AS INT)").replace(
    "COUNT(*) AS total_obs", "CAST(COUNT(*) AS INT) AS total_obs")


@query("stream_medallion", f"SELECT {POSITION_COLUMNS} FROM ({FIRST_SQL})")
def _(t):
    return as_positions(run_medallion(t).table("silver.vehicle_positions"))


@query("stream_history", f"SELECT {POSITION_COLUMNS} FROM ({VALID_SQL})")
def _(t):
    """A silver that keeps every new vehicle and time."""
    return as_positions(run_medallion(t, history=True).table("silver.vehicle_positions"))


@query("stream_progress", f"""
SELECT CAST({PARTS} AS BIGINT) AS batches, COUNT(*) AS processed_rows,
  COUNT(*) FILTER (WHERE NOT {bad_sql(VEHICLE_RULES_FEED_SQL)}) AS valid_rows,
  COUNT(*) FILTER (WHERE {bad_sql(VEHICLE_RULES_FEED_SQL)}) AS invalid_rows,
  (SELECT COUNT(*) FROM ({FIRST_SQL})) AS silver_rows FROM flat_vehicles""")
def _(t):
    """Counters that the writes of twelve batches observed."""
    return medallion.progress(finished_run(t)[0])


@query("stream_medallion_gold", GOLD_TABLE_SQL.format(f"({FIRST_SQL})"))
def _(t):
    """Twelve batches merged into gold, four at a time; their borders cut hours."""
    return rounded_gold(finished_run(t)[0].table("gold.hourly_vehicle_metrics"))


@query("stream_route_gold", f"""
SELECT CAST(CAST(timestamp AS DATE) AS VARCHAR) AS date, agency_id, route_id, {rounded_sql("AVG(arrival_delay)")} AS avg_delay_seconds,
  MAX(arrival_delay) AS max_delay_seconds, MIN(arrival_delay) AS min_delay_seconds,
  {rounded_sql("100e0 * COUNT(*) FILTER (WHERE arrival_delay BETWEEN -60 AND 300) / NULLIF(COUNT(arrival_delay), 0)")} AS on_time_percentage,
  CAST(COUNT(DISTINCT trip_id) AS INT) AS total_trips
FROM flat_updates WHERE NOT {bad_sql(UPDATE_RULES_SQL)} AND route_id IS NOT NULL GROUP BY 1, 2, 3""")
def _(t):
    """Delays of the days, merged from the partial sums of twelve batches."""
    gold = finished_run(t)[0].table("gold.route_performance").withColumn("date", F.col("date").cast("string"))
    return gold.withColumns({c: rounded(F.col(c)) for c in ("avg_delay_seconds", "on_time_percentage")})


@query("compact_layers", f"""
WITH gold AS ({GOLD_TABLE_SQL.format(f"({FIRST_SQL})")})
SELECT gold.*, (SELECT COUNT(*) FROM flat_vehicles) AS bronze_rows, TRUE AS refused, TRUE AS fewer FROM gold""")
def _(t):
    """All but the last three batches compacted, twice, a compacted batch written again, and gold made anew from what is left."""
    tables = run_medallion(t)
    first = tables.batch("bronze.vehicle_positions", 0)
    before = len(tables.partitions("bronze.vehicle_positions"))
    tables.compact(keep=6)
    tables.compact(keep=3)
    try:
        tables.append_positions(first, 0)
        refused = False
    except RetiredBatch:
        refused = True
    fewer = len(tables.partitions("bronze.vehicle_positions")) < before
    tables.refresh_hourly()
    rows = tables.table("bronze.vehicle_positions").agg(F.count(F.lit(1)).alias("bronze_rows"))
    return rounded_gold(tables.table("gold.hourly_vehicle_metrics")).select(
        "*", rows.scalar().alias("bronze_rows"), F.lit(refused).alias("refused"), F.lit(fewer).alias("fewer"))


@query("stream_publish", f"""
WITH checked AS (SELECT *, {bad_sql(VEHICLE_RULES_FEED_SQL)} AS bad FROM flat_vehicles),
updates AS (SELECT *, {bad_sql(UPDATE_RULES_SQL)} AS bad FROM flat_updates),
observed AS (SELECT *, {bad_sql([r for r in WEATHER_RULES_SQL if r[0] != 'observation_stale'])} AS bad FROM weather)
SELECT CASE WHEN bad THEN 'transit.quality.alerts' ELSE topic END AS topic, key,
  CASE WHEN epoch_us(moment) % 1000000 = 0 THEN strftime(moment, '%Y-%m-%dT%H:%M:%SZ') ELSE strftime(moment, '%Y-%m-%dT%H:%M:%S.%fZ') END AS sent_at FROM (
  SELECT bad, 'transit.vehicle.positions' AS topic, vehicle_id AS key, CASE WHEN bad THEN feed_timestamp ELSE timestamp END AS moment FROM checked
  UNION ALL SELECT bad, 'transit.trip.updates', trip_id, timestamp FROM updates
  UNION ALL SELECT bad, 'transit.weather.observations', agency_id, observation_time FROM observed)""")
def _(t):
    """Valid records and alerts of every batch in one folder per batch; a replayed batch is not handed over again."""
    weather = t.scratch("published")
    tables, feed = finished_run(t)
    path = stored(t, [as_observations(t.weather)], "weather")
    observations = t.spark.readStream.schema(C.WEATHER_OBSERVATION).parquet(path)
    medallion.start_weather(observations, tables, checkpoint=t.scratch("checkpoint"), publish=topics.to_folder(weather),
                            available_now=True).awaitTermination()

    def again(messages, batch_id):
        messages.write.mode("append").json(f"{feed}/batch=again")

    medallion.MedallionWriter(tables, agency_id="city", as_of="feed", publish=again)(
        in_time_order(t.feed, F.col("header.timestamp"))[PARTS - 1], PARTS - 1)
    sent = t.spark.read.schema(C.MESSAGE).json(feed + "/*").unionByName(t.spark.read.schema(C.MESSAGE).json(weather + "/*"))
    at = [F.get_json_object("value", f"$.{name}") for name in ("detected_at", "observation_time", "timestamp")]
    return sent.select("topic", "key", F.coalesce(*at).alias("sent_at"))


@query("dead_letters", f"""
SELECT concat('{{"header": ', event_id, ' and no end') AS message, (SELECT COUNT(*) FROM events) AS total_polls,
  (SELECT COUNT(*) FROM events WHERE event_id % 37 <> 0) AS successful_polls,
  (SELECT COUNT(*) FROM flat_vehicles WHERE event_id % 37 <> 0) AS bronze_rows
FROM events WHERE event_id % 37 = 0""")
def _(t):
    """A run over JSON lines of which some break off: they are kept, counted and no part of the layers."""
    path = t.scratch("messages")
    number = F.substring(F.element_at("entity", 1)["id"], 2, 20).cast("bigint")
    t.feed.select(F.when(number % 37 == 0, F.format_string('{"header": %d and no end', number)).otherwise(
        F.to_json(F.struct("header", "entity"))).alias("value")).write.text(path)
    tables = layers(t)
    medallion.start_medallion(
        stream_feed(t.spark, path, file_format="json", keep_unreadable=True), tables, checkpoint=t.scratch("checkpoint"),
        agency_id="city", as_of="feed", available_now=True).awaitTermination()
    stats = feed_stats(scan_feed(t.spark, path, file_format="json", keep_unreadable=True), agency_id="city", as_of="feed")
    rows = tables.table("bronze.vehicle_positions").agg(F.count(F.lit(1)).alias("bronze_rows"))
    return tables.table("bronze.dead_letters").select(
        "message", *[stats.select(c).scalar().alias(c) for c in ("total_polls", "successful_polls")],
        rows.scalar().alias("bronze_rows"))


def update_stream(t):
    """The lines of the orders as a stream of trip updates."""
    lines, orders = raw_stream(t, "lineitem"), t.raw("orders")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.withColumn("d", F.date_diff("l_shipdate", "o_orderdate")).selectExpr(*TRIP_UPDATES)


def weather_stream(t):
    rows = raw_stream(t, "events").where("event_type = 'signup'").selectExpr(*WEATHER)
    return rows.withColumn("weather_condition", weather_condition(F.col("weather_code")))


def alerts_sql(source, rules, kind, entity_id, of):
    """All columns of an alert; ``of`` has the field and, where it is no plain error, the type of each rule."""
    bad = bad_sql(rules)
    fields = [of.get(name, (None,))[0] for name, _ in rules]
    kinds = [of[name][1] if len(of[name]) > 1 else "VALIDATION_ERROR" for name, _ in rules]
    return f"""
SELECT concat('dqa_', strftime(TIMESTAMP '{AS_OF}', '%Y%m%d_%H%M%S'), '_', COALESCE({entity_id}, 'unknown')) AS alert_id,
  {case_sql(rules, [f"'{k}'" for k in kinds])} AS alert_type, 'MEDIUM' AS severity, '{kind}' AS entity_type,
  {entity_id} AS entity_id, agency_id, replace({names_sql(rules)}, ';', '; ') AS error_message,
  {case_sql(rules, [f"'{f}'" for f in fields])} AS field_name,
  {case_sql(rules, [f"CAST({f} AS VARCHAR)" for f in fields])} AS field_value, TIMESTAMP '{AS_OF}' AS detected_at
FROM {source} WHERE {bad}"""


PLACE, STALE = "GEOGRAPHIC_VIOLATION", "STALE_DATA"
VEHICLE_FIELDS = {
    "vehicle_id_missing": ("vehicle_id",), "latitude_out_of_range": ("latitude", PLACE),
    "longitude_out_of_range": ("longitude", PLACE), "bearing_out_of_range": ("bearing",),
    "speed_out_of_range": ("speed", "SPEED_VIOLATION"), "stop_sequence_negative": ("current_stop_sequence",),
    "current_status_unknown": ("current_status",), "congestion_level_unknown": ("congestion_level",),
    "occupancy_status_unknown": ("occupancy_status",), "agency_id_missing": ("agency_id",),
    "feed_timestamp_missing": ("feed_timestamp",), "timestamp_missing": ("timestamp",), "position_stale": ("timestamp", STALE)}
UPDATE_FIELDS = {
    "trip_id_missing": ("trip_id",), "stop_id_missing": ("stop_id",), "stop_sequence_negative": ("stop_sequence",),
    "arrival_delay_out_of_range": ("arrival_delay",), "departure_delay_out_of_range": ("departure_delay",),
    "arrival_after_departure": ("arrival_time",), "schedule_relationship_unknown": ("schedule_relationship",),
    "agency_id_missing": ("agency_id",), "timestamp_missing": ("timestamp",)}
WEATHER_FIELDS = {
    "latitude_out_of_range": ("latitude", PLACE), "longitude_out_of_range": ("longitude", PLACE),
    "temperature_out_of_range": ("temperature_celsius",), "precipitation_negative": ("precipitation_mm",),
    "wind_speed_out_of_range": ("wind_speed_kmh",), "weather_code_out_of_range": ("weather_code",),
    "weather_condition_unknown": ("weather_condition",), "agency_id_missing": ("agency_id",),
    "observation_time_missing": ("observation_time",), "observation_stale": ("observation_time", STALE)}


@query("stream_alerts", " UNION ALL ".join([
    alerts_sql("vehicle_positions", VEHICLE_RULES_SQL, "vehicle_position", "vehicle_id", VEHICLE_FIELDS),
    alerts_sql("trip_updates", UPDATE_RULES_SQL, "trip_update", "trip_id", UPDATE_FIELDS),
    alerts_sql("weather", WEATHER_RULES_SQL, "weather_observation", "agency_id", WEATHER_FIELDS)]))
def _(t):
    """Alerts of three kinds of records from three streams, as one stream."""
    found = events.alert_stream(position_stream(t), as_of=AS_OF).unionByName(
        events.alert_stream(update_stream(t), kind="trip_update", as_of=AS_OF)).unionByName(
        events.alert_stream(weather_stream(t), kind="weather_observation", as_of=AS_OF))
    return to_files(t, found)


@query("stream_freshness", f"""
SELECT {POSITION_COLUMNS} FROM vehicle_positions WHERE timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL '300' SECOND""")
def _(t):
    return as_positions(to_files(t, events.fresh_only(position_stream(t), as_of=AS_OF)))


@query("stream_dedup", "SELECT DISTINCT vehicle_id, timestamp FROM vehicle_positions")
def _(t):
    """Every position delivered twice, in two files."""
    schema = t.positions.schema
    path = t.scratch("delivered")
    for _repeat in range(2):
        t.positions.write.mode("append").parquet(path)
    twice = t.spark.readStream.schema(schema).parquet(path)
    return to_files(t, events.deduplicated(twice, within="10 minutes").select("vehicle_id", "timestamp"))


@query("stream_first_seen", """
WITH early AS (SELECT * FROM vehicle_positions WHERE timestamp < TIMESTAMP '2024-01-01 06:00:00'
  AND (speed IS NULL OR speed BETWEEN 0 AND 33.3e0)),
late AS (SELECT * FROM vehicle_positions WHERE timestamp >= TIMESTAMP '2024-01-01 06:00:00'
  AND (speed IS NULL OR speed BETWEEN 0 AND 33.3e0) AND vehicle_id NOT IN (SELECT vehicle_id FROM early))
SELECT vehicle_id, timestamp, speed FROM early UNION ALL SELECT vehicle_id, timestamp, speed FROM late""")
def _(t):
    """Two batches: the first six hours, then the rest."""
    first = F.col("timestamp") < F.lit("2024-01-01 06:00:00").cast("timestamp")
    rows = as_positions(t.positions)
    path = stored(t, [rows.where(first), rows.where(~first)], "positions")
    tables = layers(t)
    stream = t.spark.readStream.schema(C.VEHICLE_POSITION).option("maxFilesPerTrigger", PART_FILES).parquet(path)
    medallion.start_first_seen(stream, tables, checkpoint=t.scratch("checkpoint"), as_of="2024-01-01",
                               available_now=True).awaitTermination()
    return tables.table("silver.vehicle_positions").select("vehicle_id", "timestamp", "speed")


@query("stream_hourly_gold", f"""
SELECT * FROM ({GOLD_SQL.format("vehicle_positions")})
WHERE hour_timestamp + INTERVAL '1' HOUR <= (SELECT MAX(timestamp) FROM vehicle_positions WHERE route_id IS NOT NULL)
  - INTERVAL '10' MINUTE""")
def _(t):
    """Hours the watermark has passed; the last one stays open."""
    return rounded_gold(to_files(t, events.hourly_metrics(position_stream(t))))


# an old observation is no bad one here: the join looks at its age
FIT_WEATHER_SQL = f"(SELECT * FROM weather WHERE NOT {bad_sql([r for r in WEATHER_RULES_SQL if r[0] != 'observation_stale'])})"


@query("stream_weather", f"""
WITH {asof_sql('vehicle_positions', ['agency_id'], FIT_WEATHER_SQL)}
SELECT vehicle_id, timestamp, observation_time, weather_condition,
  COALESCE(weather_condition IN ('HEAVY_RAIN', 'SNOW', 'THUNDERSTORM'), FALSE) AS is_severe FROM correlated""")
def _(t):
    """One stream fills the weather tables, a second joins positions to the observations that passed."""
    tables = layers(t)
    path = stored(t, [as_observations(t.weather)], "weather")
    observations = t.spark.readStream.schema(C.WEATHER_OBSERVATION).parquet(path)
    medallion.start_weather(observations, tables, checkpoint=t.scratch("checkpoint"),
                            available_now=True).awaitTermination()
    out = t.scratch("joined")
    medallion.start_weather_join(position_stream(t).drop("event_id"), tables, checkpoint=t.scratch("checkpoint"),
                                 path=out, available_now=True).awaitTermination()
    joined = t.spark.read.parquet(out)
    return joined.select("vehicle_id", "timestamp", "observation_time", "weather_condition",
                         F.coalesce("is_severe", F.lit(False)).alias("is_severe"))


@query("stream_weather_join", f"""
WITH {asof_sql('vehicle_positions', ['agency_id'], 'weather')}
SELECT vehicle_id, timestamp, speed, observation_time, weather_condition, weather_code,
  COALESCE(weather_condition IN ('HEAVY_RAIN', 'SNOW', 'THUNDERSTORM'), FALSE) AS is_severe FROM correlated""")
def _(t):
    """Two streams joined, each part of the weather landing one part after its positions.

    A last position and observation two months on let the watermark pass all others; they stay open themselves.
    """
    positions, weather = as_positions(t.positions), as_observations(t.weather)
    moved = lambda rows, c: rows.limit(1).withColumn(c, F.lit("2024-04-01").cast("timestamp"))
    parts = in_time_order(positions, F.unix_seconds("timestamp"))
    late = in_time_order(weather, F.unix_seconds("observation_time"))
    rows = stored(t, [*parts, moved(positions, "timestamp")], "positions")
    seen = stored(t, [weather.limit(0), *late, moved(weather, "observation_time")], "weather")
    read = lambda schema, path: t.spark.readStream.schema(schema).option("maxFilesPerTrigger", PART_FILES).parquet(path)
    joined = events.with_weather(read(C.VEHICLE_POSITION, rows), read(C.WEATHER_OBSERVATION, seen), weather_late_by="6 days")
    return to_files(t, joined).select("vehicle_id", "timestamp", "speed", "observation_time", "weather_condition", "weather_code",
                                      F.coalesce("is_severe", F.lit(False)).alias("is_severe"))
