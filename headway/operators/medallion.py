"""Row logic of the bronze, silver and gold layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway import contracts as C
from headway.functions.times import older_than


def silver_filter(positions: DataFrame, *, as_of=None, max_speed: float = C.MAX_SPEED_MS,
                  max_age_s: int = C.SILVER_MAX_AGE_S) -> DataFrame:
    """Rows fit for silver; every condition is a plain comparison the file scan can use."""
    speed = F.col("speed")
    return positions.where(
        F.col("latitude").between(-90.0, 90.0)
        & F.col("longitude").between(-180.0, 180.0)
        & (speed.isNull() | speed.between(0.0, max_speed))
        & ~older_than(F.col("timestamp"), as_of, max_age_s)
    )


def first_batch_only(positions: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows whose ``vehicle_id`` is ``NOT IN`` the ids already promoted.

    All rows of a vehicle's first batch pass and later batches never do. The
    NULL rule of NOT IN holds: an empty ``seen`` passes every row; otherwise a
    NULL id never passes, and a NULL in ``seen`` stops all rows. The two facts
    about ``seen`` are subqueries.

    The batch's ids are reduced to one row each before they meet ``seen``, so a
    vehicle with very many rows is one row there, and a ``seen`` that is bucketed
    by id is read where it lies: neither shuffled nor copied. The rows then meet
    the new ids in a join that AQE can split.
    """
    ids = seen.select("vehicle_id")
    is_empty = ~ids.limit(1).exists()
    has_null = ids.where(F.col("vehicle_id").isNull()).limit(1).exists()
    named = F.col("vehicle_id").isNotNull()
    fresh = positions.where(named & ~has_null).select("vehicle_id").distinct().join(ids, "vehicle_id", "left_anti")
    return positions.where(named).join(fresh, "vehicle_id", "left_semi").unionByName(
        positions.where(F.col("vehicle_id").isNull() & is_empty)).select(*positions.columns)


def first_per_event(positions: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows whose (vehicle_id, timestamp) is new, one per key: keeps the position history."""
    key = ["vehicle_id", "timestamp"]
    return positions.dropDuplicates(key).join(seen.select(*key).distinct(), key, "left_anti")


def upsert(current: DataFrame, changes: DataFrame, keys: list[str], *, order_by: str | None = None) -> DataFrame:
    """Current rows with the changed ones put in their place, one row per key.

    Of several changes for a key the one with the largest ``order_by`` counts; without an order the largest row does,
    so the result does not depend on partitions.
    """
    last = F.struct(*([order_by] if order_by else []), *[c for c in current.columns if c not in keys])
    rest = F.struct(*[c for c in current.columns if c not in keys])
    changes = changes.groupBy(*keys).agg(F.max_by(rest, last).alias("__last")).select(*keys, "__last.*")
    kept = current.join(changes.select(*keys), keys, "left_anti")
    return kept.select(*current.columns).unionByName(changes.select(*current.columns))


def layer_metrics(bronze_positions: DataFrame, bronze_trip_updates: DataFrame,
                  bronze_weather: DataFrame, silver_positions: DataFrame,
                  gold_hourly: DataFrame) -> DataFrame:
    """Row counts of the five tables and the silver share of bronze, as one row."""
    tables = {
        "bronze_vehicle_positions": bronze_positions,
        "bronze_trip_updates": bronze_trip_updates,
        "bronze_weather": bronze_weather,
        "silver_vehicle_positions": silver_positions,
        "gold_hourly_metrics": gold_hourly,
    }
    counts = None
    for name, table in tables.items():
        one = table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        counts = one if counts is None else counts.unionByName(one)
    row = counts.agg(*[F.sum(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in tables])
    share = F.try_divide(F.col("silver_vehicle_positions"), F.col("bronze_vehicle_positions"))
    return row.select("*", F.coalesce(share, F.lit(0.0)).alias("data_quality_rate"))
