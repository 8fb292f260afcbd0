"""Nested feed messages to flat records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway import contracts as C
from headway.functions.codes import decode, schedule_relationship
from headway.functions.times import epoch_to_ts


def _agency(agency_id) -> Column:
    return agency_id if isinstance(agency_id, Column) else F.lit(agency_id)


def vehicle_fields(entity: Column, feed_timestamp: Column, agency_id) -> dict[str, Column]:
    """The columns of a vehicle position, read from one feed entity.

    The entity id stands in only for an absent vehicle descriptor: a present
    descriptor with an empty id stays empty, for validation to reject.
    """
    vehicle = entity["vehicle"]
    position = vehicle["position"]
    return {
        "vehicle_id": F.when(vehicle["vehicle"].isNull(), entity["id"]).otherwise(
            F.coalesce(vehicle["vehicle"]["id"], F.lit(""))
        ),
        "trip_id": vehicle["trip"]["trip_id"],
        "route_id": vehicle["trip"]["route_id"],
        "latitude": position["latitude"].cast("double"),
        "longitude": position["longitude"].cast("double"),
        "bearing": position["bearing"].cast("double"),
        "speed": position["speed"].cast("double"),
        "timestamp": F.coalesce(epoch_to_ts(vehicle["timestamp"]), feed_timestamp),
        "current_stop_sequence": vehicle["current_stop_sequence"],
        "stop_id": vehicle["stop_id"],
        "current_status": decode(vehicle["current_status"], C.VEHICLE_STOP_STATUS),
        "congestion_level": decode(vehicle["congestion_level"], C.CONGESTION_LEVEL),
        "occupancy_status": decode(vehicle["occupancy_status"], C.OCCUPANCY_STATUS),
        "agency_id": _agency(agency_id),
        "feed_timestamp": feed_timestamp,
    }


def trip_update_fields(
    trip_update: Column, stop_update: Column, feed_timestamp: Column, agency_id
) -> dict[str, Column]:
    """The columns of a trip update, read from one stop-time update."""
    arrival, departure = stop_update["arrival"], stop_update["departure"]
    return {
        "trip_id": trip_update["trip"]["trip_id"],
        "route_id": trip_update["trip"]["route_id"],
        "vehicle_id": trip_update["vehicle"]["id"],
        "stop_sequence": F.coalesce(stop_update["stop_sequence"], F.lit(0)),
        "stop_id": F.coalesce(stop_update["stop_id"], F.lit("")),
        "arrival_delay": arrival["delay"],
        "departure_delay": departure["delay"],
        "arrival_time": epoch_to_ts(arrival["time"]),
        "departure_time": epoch_to_ts(departure["time"]),
        "schedule_relationship": schedule_relationship(stop_update["schedule_relationship"]),
        "agency_id": _agency(agency_id),
        "timestamp": feed_timestamp,
    }


def _aliased(fields: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in fields.items()]


def _entities(feed: DataFrame) -> DataFrame:
    return feed.select(
        epoch_to_ts(F.col("header.timestamp")).alias("feed_ts"), F.explode("entity").alias("entity")
    )


def flatten_vehicles(feed: DataFrame, *, agency_id) -> DataFrame:
    """One row per entity that carries a vehicle with a position."""
    return (
        _entities(feed)
        .where(F.col("entity.vehicle.position").isNotNull())
        .select(*_aliased(vehicle_fields(F.col("entity"), F.col("feed_ts"), agency_id)))
    )


def has_trip(trip_update: Column) -> Column:
    return F.coalesce(trip_update["trip"]["trip_id"], F.lit("")) != ""


def flatten_trip_updates(feed: DataFrame, *, agency_id) -> DataFrame:
    """One row per stop-time update of every trip update that names its trip."""
    return (
        _entities(feed)
        .select("feed_ts", F.col("entity.trip_update").alias("trip_update"))
        .where(has_trip(F.col("trip_update")))
        .select("feed_ts", "trip_update", F.explode("trip_update.stop_time_update").alias("stu"))
        .select(
            *_aliased(
                trip_update_fields(F.col("trip_update"), F.col("stu"), F.col("feed_ts"), agency_id)
            )
        )
    )
