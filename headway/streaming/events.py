"""Transformations of a stream of flat records; each returns a streaming DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway import contracts as C
from headway.functions.codes import congestion_score, is_severe, speed_kmh
from headway.functions.times import older_than
from headway.operators.skew import with_every_salt
from headway.operators.validate import alerts, trip_update_rules, vehicle_rules, weather_rules
from headway.operators.weather import WEATHER_VALUES

_SLOTS_PER_AGE = 8


def fresh_only(stream: DataFrame, *, max_age_s: int = C.MAX_POSITION_AGE_S, as_of=None) -> DataFrame:
    """Drop records older than the limit; by default age is measured at each micro-batch's own time."""
    return stream.where(~older_than(F.col("timestamp"), as_of, max_age_s))


def deduplicated(stream: DataFrame, *, keys: tuple[str, ...] = ("vehicle_id", "timestamp"),
                 within: str = "10 minutes") -> DataFrame:
    """One record per key however often it is delivered; state is kept for ``within`` only."""
    return stream.withWatermark("timestamp", within).dropDuplicatesWithinWatermark(list(keys))


def hourly_metrics(stream: DataFrame, *, late_by: str = "10 minutes") -> DataFrame:
    """The hourly metrics as an append-mode stream; an hour is emitted once the watermark passes it.

    The first aggregation keeps one state row per hour, route and vehicle, the
    second counts those rows, so vehicle numbers are exact.
    """
    kmh = speed_kmh(F.col("speed"))
    per_vehicle = (
        stream.where(F.col("route_id").isNotNull())
        .withWatermark("timestamp", late_by)
        .groupBy(F.window("timestamp", "1 hour"), "agency_id", "route_id", "vehicle_id")
        .agg(
            F.sum(kmh).alias("speed_sum"), F.count(kmh).alias("speeds"), F.max(kmh).alias("top"),
            F.sum(congestion_score(F.col("congestion_level"))).alias("score_sum"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    return (
        per_vehicle.groupBy(F.window("window", "1 hour"), "agency_id", "route_id")
        .agg(
            F.count(F.lit(1)).alias("total_vehicles"),
            F.try_divide(F.sum("speed_sum"), F.sum("speeds")).alias("avg_speed_kmh"),
            F.max("top").alias("max_speed_kmh"),
            (F.sum("score_sum") / F.sum("n")).alias("avg_congestion_score"),
            F.sum("n").alias("total_observations"),
        )
        .select(F.col("window.start").alias("hour_timestamp"), "agency_id", "route_id", "total_vehicles",
                "avg_speed_kmh", "max_speed_kmh", "avg_congestion_score", "total_observations")
    )


def alert_stream(stream: DataFrame, *, kind: str = "vehicle_position", as_of=None) -> DataFrame:
    """Alerts for the records of a stream that break their contract: positions, trip updates or weather observations."""
    rules, entity_id = {
        "vehicle_position": (lambda: vehicle_rules(as_of), "vehicle_id"),
        "trip_update": (trip_update_rules, "trip_id"),
        "weather_observation": (lambda: weather_rules(as_of), "agency_id"),
    }[kind]
    return alerts(stream, rules(), entity_type=kind, entity_id=entity_id, as_of=as_of)


def with_weather(positions: DataFrame, observations: DataFrame, *, max_age_s: int = C.MAX_WEATHER_AGE_S,
                 late_by: str = "10 minutes", weather_late_by: str = "2 hours", salts: int = 1) -> DataFrame:
    """Each position with its agency's latest observation, as an append-mode as-of join of two streams.

    Both sides keep state: an observation that comes after the positions it belongs to, by up to
    ``weather_late_by``, still counts. A position is emitted once the watermark has passed its slot,
    an eighth of the age limit, with the greatest of the observations at the latest instant, or
    without one. Records equal in all columns are one; a position without a time is never emitted.

    Positions and observations of an agency meet in the group of a slot. It keeps the slot's
    positions, its observations, and of the slots before it within reach the last observation only.
    When it closes, each position looks its observation up in their sorted array by halving, so the
    work is that of sorting both sides. One task holds a group's rows; where an agency has millions
    of positions a slot, ``salts`` deals them over as many groups, each with all observations.
    """
    age_s = int(max_age_s)
    slot_s = max(1, age_s // _SLOTS_PER_AGE)
    slot, reach = f"{slot_s} seconds", f"{slot_s * (1 - (-age_s // slot_s))} seconds"
    in_slot = F.col("observation_time") >= F.col("_window.end") - F.expr(f"INTERVAL {slot_s} SECONDS")
    seen = F.struct("observation_time", *WEATHER_VALUES)
    left = positions.withWatermark("timestamp", late_by).select(
        F.window("timestamp", slot).alias("_window"), F.col("agency_id").alias("_agency"),
        F.struct(*positions.columns).alias("_row")).withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(salts)).cast("int"))
    # an observation enters the windows of its own slot and of the later ones that it can reach
    right = observations.where(F.col("agency_id").isNotNull()).withWatermark("observation_time", weather_late_by).select(
        F.window("observation_time", reach, slot).alias("_window"), F.col("agency_id").alias("_agency"),
        "observation_time", *WEATHER_VALUES)
    key = [F.window_time("_window").alias("_until"), "_agency", "_salt"]
    slots = (
        left.select(*key, "_row")
        .unionByName(with_every_salt(right, salts).select(
            *key, F.when(in_slot, seen).alias("_seen"), F.when(~in_slot, seen).alias("_earlier")), allowMissingColumns=True)
        .groupBy("_until", "_agency", "_salt")
        .agg(F.collect_list("_row").alias("rows"), F.collect_list("_seen").alias("seen"), F.max("_earlier").alias("earlier"))
    )
    age = F.expr(f"INTERVAL {age_s} SECONDS")
    fresh = F.when(F.col("_last.observation_time") >= F.col("_row.timestamp") - age, F.col("_last"))
    joined = slots.select(F.inline(_with_last_seen("rows", "seen", "earlier"))).select("_row", fresh.alias("_last"))
    return joined.select("_row.*", "_last.*").withColumn("is_severe", is_severe(F.col("weather_condition")))


def _with_last_seen(rows: str, seen: str, earlier: str) -> Column:
    """Each different row of an array, with the last of the observations up to its time, as ``_row`` and ``_last``."""
    once = F.struct(
        F.sort_array(rows).alias("rows"),
        F.concat(F.array_compact(F.array(earlier)), F.sort_array(seen)).alias("seen"),
        F.filter(F.array(*[F.lit(2**k) for k in range(30, -1, -1)]), lambda step: step <= F.size(seen) + 1).alias("steps"),
    )

    def matched(slot: Column) -> Column:
        def last(row: Column) -> Column:
            """How many observations are no later than the row, found bit by bit."""
            count = F.aggregate(slot["steps"], F.lit(0), lambda n, step: F.when(
                F.get(slot["seen"], n + step - 1)["observation_time"] <= row["timestamp"], n + step).otherwise(n))
            return F.get(slot["seen"], count - 1)

        first_of_its_kind = F.filter(
            slot["rows"], lambda row, k: (k == 0) | ~row.eqNullSafe(F.get(slot["rows"], k - 1)))
        return F.transform(first_of_its_kind, lambda row: F.struct(row.alias("_row"), last(row).alias("_last")))

    # an array of one binds the sorted arrays to a name; written in place they would be sorted again for every row
    return F.element_at(F.transform(F.array(once), matched), 1)
