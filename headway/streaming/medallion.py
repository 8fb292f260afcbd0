"""The continuous run: landed messages to bronze, alerts, silver and gold, batch by batch.

A batch that fails stops the query; on restart the checkpoint replays it, and
every table write replaces all that the batch wrote before, so nothing is
doubled. The time that a batch measures age against is stored with its counters
and used again when the batch is replayed.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from headway import contracts as C
from headway.functions.times import moment
from headway.operators.flatten import flatten_trip_updates, flatten_vehicles
from headway.operators.validate import (
    agency_bounds_rules, alerts, any_broken, keep_valid, trip_update_rules, vehicle_rules, weather_rules, with_agency_bounds,
)
from headway.operators.weather import weather_correlate
from headway.session import observed
from headway.sources.feed import dead_letters, readable
from headway.sources.tables import Layers
from headway.sources.topics import alert_messages, trip_update_messages, vehicle_messages, weather_messages

POLL_INTERVAL = "30 seconds"
WEATHER_INTERVAL = "300 seconds"
GOLD_EVERY = 10


def _schedule(writer, interval: str, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


class MedallionWriter:
    """``foreachBatch`` function over feed messages.

    ``publish(messages, batch_id)`` is given the batch's messages for the topics, see `deliver`. ``agencies`` is a
    table of service areas, or a function of the batch that returns it: positions outside their agency's area raise
    alerts and do not reach silver. ``history`` keeps every new (vehicle, time) instead of a vehicle's first batch.
    """

    def __init__(self, layers: Layers, *, agency_id, as_of=None, gold_every: int = GOLD_EVERY, publish=None,
                 agencies=None, history: bool = False):
        self.layers = layers
        self.agency_id = agency_id
        self.as_of = as_of
        self.gold_every = gold_every
        self.publish = publish
        self.agencies = agencies
        self.history = history

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        layers = self.layers
        as_of = batch_time(layers, batch_id, self.as_of)
        rules = vehicle_rules(as_of)
        bad = F.coalesce(any_broken(rules), F.lit(True))
        messages.persist()
        try:
            if "unreadable" in messages.columns:
                layers.write_batch("bronze.dead_letters", dead_letters(messages), batch_id)
                messages = readable(messages)
            counts, _ = together(
                lambda: layers.store_bronze(
                    "bronze.vehicle_positions", flatten_vehicles(messages, agency_id=self.agency_id), batch_id,
                    measures={"valid_rows": F.count_if(~bad), "invalid_rows": F.count_if(bad)}),
                lambda: layers.store_bronze(
                    "bronze.trip_updates", flatten_trip_updates(messages, agency_id=self.agency_id), batch_id))
        finally:
            messages.unpersist()
        self.settle(batch_id, as_of, counts)

    def settle(self, batch_id: int, as_of=None, counts: dict | None = None) -> None:
        """Alerts, silver, partial sums, messages, counters and, every n-th batch, gold, from the stored bronze batch.

        ``counts`` are what the bronze write observed; a batch that was stored before is counted here.
        """
        layers = self.layers
        as_of = batch_time(layers, batch_id, self.as_of) if as_of is None else as_of
        rules, update_rules = vehicle_rules(as_of), trip_update_rules()
        rows = layers.batch("bronze.vehicle_positions", batch_id)
        updates = layers.batch("bronze.trip_updates", batch_id)
        if counts is None:
            bad = F.coalesce(any_broken(rules), F.lit(True))
            counts = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~bad).alias("valid_rows"),
                              F.count_if(bad).alias("invalid_rows")).first()
        if self.agencies is not None:
            agencies = self.agencies(batch_id) if callable(self.agencies) else self.agencies
            rows, rules = with_agency_bounds(rows, agencies), rules + agency_bounds_rules()
        found = alerts(rows, rules, entity_type="vehicle_position", entity_id="vehicle_id", as_of=as_of).unionByName(
            alerts(updates, update_rules, entity_type="trip_update", entity_id="trip_id",
                   as_of=F.col("timestamp") if as_of == "feed" else as_of))
        valid, fit_updates = keep_valid(rows, rules), keep_valid(updates, update_rules)

        def updates_on() -> None:
            layers.write_batch("silver.trip_updates", fit_updates, batch_id)
            layers.add_partials("gold.route_partials", batch_id)

        _, promoted, _ = together(
            lambda: layers.write_batch("bronze.quality_alerts", found, batch_id),
            lambda: layers.promote(valid, batch_id, as_of=as_of, history=self.history), updates_on)
        if self.publish is not None:
            positions = valid.select(*C.column_names(C.VEHICLE_POSITION))
            outgoing = vehicle_messages(positions).unionByName(
                trip_update_messages(fit_updates.select(*C.column_names(C.TRIP_UPDATE)))).unionByName(
                alert_messages(layers.batch("bronze.quality_alerts", batch_id)))
            layers.write_batch("silver.outbox", outgoing, batch_id)
            deliver(layers, batch_id, self.publish)
        # the counters come last but gold: with them the batch is known to be settled
        progress_row = layers.spark.createDataFrame(
            [(counts["rows"], counts["valid_rows"], counts["invalid_rows"], promoted)],
            "processed_rows BIGINT, valid_rows BIGINT, invalid_rows BIGINT, silver_rows BIGINT")
        layers.write_batch("gold.feed_progress", progress_row.withColumn(
            "as_of", F.lit(None).cast("timestamp") if as_of == "feed" else moment(as_of)), batch_id)
        if (batch_id + 1) % self.gold_every == 0:
            since = batch_id + 1 - self.gold_every
            together(lambda: layers.refresh_hourly(since), lambda: layers.refresh_route_performance(since))


def together(*steps) -> list:
    """Run steps that write different tables side by side, as each alone leaves most of a cluster idle; their results."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(step) for step in steps]]


def deliver(layers: Layers, batch_id: int, publish, *, box: str = "outbox", done: str = "deliveries") -> bool:
    """Hand a batch's stored messages to ``publish(messages, batch_id)`` unless that has succeeded before.

    A delivery is noted after ``publish`` returns. A failure in between hands the same batch over again, under the same
    number, so a function that replaces what it has of a number (as `to_folder` does) delivers each batch once.
    """
    if layers.with_partitions(f"silver.{done}").where(F.col("batch_id") == batch_id).limit(1).count():
        return False
    messages = layers.batch(f"silver.{box}", batch_id)
    seen = Observation(f"delivery {uuid.uuid4().hex}")
    publish(messages.observe(seen, F.count(F.lit(1)).alias("n")), batch_id)
    note = layers.spark.createDataFrame([(observed(seen, "n")["n"],)], "messages BIGINT")
    layers.write_batch(f"silver.{done}", note.withColumn("delivered_at", F.current_timestamp()), batch_id)
    return True


def batch_time(layers: Layers, batch_id: int, as_of=None):
    """The time a batch measures age against: that of its first run, else ``as_of``, else now."""
    if as_of == "feed":
        return as_of
    known = layers.with_partitions("gold.feed_progress").where(
        (F.col("batch_id") == batch_id) & F.col("as_of").isNotNull()).select(F.unix_micros("as_of")).first()
    if known:
        return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=known[0])
    return as_of or datetime.now(timezone.utc)


def progress(layers: Layers) -> DataFrame:
    """Totals over all batches so far."""
    return layers.with_partitions("gold.feed_progress").agg(
        F.count(F.lit(1)).alias("batches"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c)
          for c in ("processed_rows", "valid_rows", "invalid_rows", "silver_rows")],
    )


def start_medallion(messages: DataFrame, layers: Layers, *, checkpoint: str, agency_id: str, as_of=None,
                    gold_every: int = GOLD_EVERY, interval: str = POLL_INTERVAL,
                    available_now: bool = False, **options):
    """Start the continuous run over a stream of feed messages; returns the streaming query. Options: `MedallionWriter`."""
    writer = messages.writeStream.foreachBatch(
        MedallionWriter(layers, agency_id=agency_id, as_of=as_of, gold_every=gold_every, **options)
    ).option("checkpointLocation", checkpoint)
    return _schedule(writer, interval, available_now).start()


def start_first_seen(positions: DataFrame, layers: Layers, *, checkpoint: str, as_of=None,
                     interval: str = POLL_INTERVAL, available_now: bool = False):
    """Promote a stream of flat positions: a vehicle enters silver with its first batch only."""
    def promote(rows: DataFrame, batch_id: int) -> None:
        layers.store_bronze("bronze.vehicle_positions", rows, batch_id)
        stored = layers.batch("bronze.vehicle_positions", batch_id)
        layers.promote(stored, batch_id, as_of=as_of or datetime.now(timezone.utc))

    writer = positions.writeStream.foreachBatch(promote).option("checkpointLocation", checkpoint)
    return _schedule(writer, interval, available_now).start()


def start_weather(observations: DataFrame, layers: Layers, *, checkpoint: str, publish=None,
                  interval: str = WEATHER_INTERVAL, available_now: bool = False):
    """Keep the weather tables up to date from a stream of observations.

    Bronze takes all rows, silver those that pass the contract. Age is no reason to refuse one here: the as-of join
    looks at it, against the time of each row. Rows that fail raise alerts; rows that pass and alerts go to ``publish``.
    """
    rules = weather_rules(F.col("observation_time"))

    def store(rows: DataFrame, batch_id: int) -> None:
        layers.store_bronze("bronze.weather_observations", rows, batch_id)
        stored = layers.batch("bronze.weather_observations", batch_id)
        layers.write_batch("bronze.weather_alerts", alerts(
            stored, rules, entity_type="weather_observation", entity_id="agency_id",
            as_of=F.coalesce("observation_time", "ingestion_timestamp")), batch_id)
        layers.write_batch("silver.weather_observations", keep_valid(stored, rules), batch_id)
        if publish is not None:
            kept = layers.batch("silver.weather_observations", batch_id).select(*C.column_names(C.WEATHER_OBSERVATION))
            layers.write_batch("silver.weather_outbox", weather_messages(kept).unionByName(
                alert_messages(layers.batch("bronze.weather_alerts", batch_id))), batch_id)
            deliver(layers, batch_id, publish, box="weather_outbox", done="weather_deliveries")

    writer = observations.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return _schedule(writer, interval, available_now).start()


def start_weather_join(positions: DataFrame, layers: Layers, *, checkpoint: str, path: str,
                       interval: str = POLL_INTERVAL, available_now: bool = False):
    """Write each batch of positions with the stored weather of its time to ``path``.

    Only the weather of the batch's dates, and the day before, is read.
    """
    def enrich(rows: DataFrame, batch_id: int) -> None:
        rows.persist()  # read for its dates, for its crowded slots and for the join
        try:
            dates = rows.select(F.explode(F.array(
                F.to_date("timestamp"), F.date_sub(F.to_date("timestamp"), 1))).alias("event_date")).distinct()
            weather = layers.with_partitions("silver.weather_observations").join(
                dates, "event_date", "left_semi"
            )
            joined = weather_correlate(rows, weather).withColumn("batch_id", F.lit(batch_id))
            joined.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                "batch_id").parquet(path)
        finally:
            rows.unpersist()

    writer = positions.writeStream.foreachBatch(enrich).option("checkpointLocation", checkpoint)
    return _schedule(writer, interval, available_now).start()
