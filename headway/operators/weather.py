"""Weather joined to fleets: the latest observation that is not too old."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway import contracts as C
from headway.functions.codes import is_severe, speed_kmh
from headway.functions.times import location_key
from headway.operators.skew import crowded_groups, with_every_salt, with_salt

_SLOTS_PER_AGE = 4
_SALTS_WITHOUT_KEY = 4096
ROWS_PER_TASK = 2_000_000


def latest_before(rows: DataFrame, observations: DataFrame, *, keys: list[str], row_time: str,
                  observation_time: str, values: list[str], max_age_s: int,
                  rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """As-of join: each row with ``values`` of its key's latest observation at or before it.

    Nothing matches when that observation is more than ``max_age_s`` old. Of
    several observations at one instant the greatest ``values`` win.

    Time is cut into slots of a quarter of the age limit. A slot's window holds
    its rows, its observations, and the last observation of each of the few
    slots before it, which are all an answer can come from. Rows are shuffled
    once, by (key, slot, salt). A slot of more than ``rows_per_task`` rows, found
    by a count over the key and time columns alone, gets as many salts as it
    needs, and its observations, one per key and instant, are copied to each.
    """
    slot_s = max(1, max_age_s // _SLOTS_PER_AGE)
    carried_slots = -(-max_age_s // slot_s)
    slot_us = slot_s * 1_000_000

    def slot_of(column: Column) -> Column:
        return F.floor(F.unix_micros(column) / slot_us).cast("long")

    def all_present(columns: list[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])

    group = [*keys, "_slot"]
    slotted = rows.withColumn("_slot", slot_of(F.col(row_time)))
    crowded = crowded_groups(slotted.where(all_present(keys)).select(*group), group, rows_per_task)
    salts = F.coalesce("_salts", F.lit(1))

    per_instant = (
        observations.where(all_present([*keys, observation_time]))
        .groupBy(*keys, F.col(observation_time).alias("_at"))
        .agg(F.max(F.struct(*values)).alias("_values"))
        .withColumn("_slot", slot_of(F.col("_at")))
    )
    last_of_slot = per_instant.groupBy(*group).agg(
        F.max_by("_values", "_at").alias("_values"), F.max("_at").alias("_at")
    )
    carried = last_of_slot.withColumn(
        "_slot", F.explode(F.sequence(F.col("_slot") + 1, F.col("_slot") + carried_slots))
    )
    sources = with_every_salt(per_instant.unionByName(carried).join(crowded, group, "left"), salts)
    tagged = with_salt(
        slotted.select(*group, F.col(row_time).alias("_at"), F.struct(*rows.columns).alias("_row"))
        .join(crowded, group, "left"),
        ["_at"],
        # rows without a key or a time match nothing, so any salt is right for them
        F.when(all_present(group), salts).otherwise(_SALTS_WITHOUT_KEY),
    ).drop("_salts")
    both = tagged.unionByName(
        sources.select(*group, "_at", "_salt",
                       F.struct(F.col("_at").alias("_seen_at"), "_values").alias("_seen")),
        allowMissingColumns=True,
    )
    # at one instant the observation (no row) sorts before the rows
    window = (
        Window.partitionBy(*keys, "_slot", "_salt")
        .orderBy("_at", F.col("_row").isNotNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    matched = both.withColumn("_last", F.last("_seen", ignorenulls=True).over(window)).where(
        F.col("_row").isNotNull()
    )
    age_us = F.unix_micros(F.col(f"_row.{row_time}")) - F.unix_micros(F.col("_last._seen_at"))
    fresh = age_us <= max_age_s * 1_000_000
    return matched.select(
        "_row.*",
        F.when(fresh, F.col("_last._seen_at")).alias(observation_time),
        *[F.when(fresh, F.col(f"_last._values.{v}")).alias(v) for v in values],
    )


WEATHER_VALUES = ["weather_condition", "weather_code", "temperature_celsius", "precipitation_mm", "wind_speed_kmh"]


def weather_correlate(positions: DataFrame, observations: DataFrame, *,
                      max_age_s: int = C.MAX_WEATHER_AGE_S, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Positions with the latest observation of their agency, and whether it is severe."""
    joined = latest_before(
        positions, observations, keys=["agency_id"], row_time="timestamp",
        observation_time="observation_time", values=WEATHER_VALUES, max_age_s=max_age_s, rows_per_task=rows_per_task,
    )
    return joined.withColumn("is_severe", is_severe(F.col("weather_condition")))


def weather_grid_correlate(positions: DataFrame, observations: DataFrame, *,
                           max_age_s: int = C.MAX_WEATHER_AGE_S, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Positions with the latest observation of their own 0.01 degree location."""
    joined = latest_before(
        positions.withColumn("location_key", location_key(F.col("latitude"), F.col("longitude"))),
        observations.withColumn("location_key", location_key(F.col("latitude"), F.col("longitude"))),
        keys=["location_key"], row_time="timestamp", observation_time="observation_time",
        values=WEATHER_VALUES, max_age_s=max_age_s, rows_per_task=rows_per_task,
    )
    return joined.withColumn("is_severe", is_severe(F.col("weather_condition")))


def weather_impact(positions: DataFrame, observations: DataFrame, *,
                   max_age_s: int = C.MAX_WEATHER_AGE_S, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Speed per route and weather condition; rows without a fresh observation are UNKNOWN."""
    kmh = speed_kmh(F.col("speed"))
    needed = positions.where(F.col("route_id").isNotNull()).select(
        "agency_id", "timestamp", "route_id", "speed"
    )
    return (
        weather_correlate(needed, observations, max_age_s=max_age_s, rows_per_task=rows_per_task)
        .groupBy("route_id", F.coalesce("weather_condition", F.lit("UNKNOWN")).alias("weather_condition"))
        .agg(
            F.coalesce(F.first("is_severe"), F.lit(False)).alias("is_severe"),
            F.count(F.lit(1)).alias("observations"),
            F.avg(kmh).alias("avg_speed_kmh"),
        )
    )


def delay_by_weather(trip_updates: DataFrame, observations: DataFrame, *,
                     max_age_s: int = C.MAX_WEATHER_AGE_S, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Arrival delay per route and weather condition."""
    needed = trip_updates.where(F.col("route_id").isNotNull()).select(
        "agency_id", "timestamp", "route_id", "arrival_delay"
    )
    return (
        weather_correlate(needed, observations, max_age_s=max_age_s, rows_per_task=rows_per_task)
        .groupBy("route_id", F.coalesce("weather_condition", F.lit("UNKNOWN")).alias("weather_condition"))
        .agg(
            F.count(F.lit(1)).alias("observations"),
            F.avg("arrival_delay").alias("avg_delay_seconds"),
            F.max("arrival_delay").alias("max_delay_seconds"),
        )
    )
