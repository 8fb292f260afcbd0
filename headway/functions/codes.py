"""Lookups from codes and values to labels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway import contracts as C


def decode(code: Column, names: dict) -> Column:
    """Name of a code; an unknown or absent code gives NULL."""
    pairs = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in names.items())
    return F.try_element_at(F.create_map(*pairs), code)


def schedule_relationship(code: Column) -> Column:
    """Unknown and absent relationships both count as SCHEDULED."""
    return F.coalesce(decode(code, C.SCHEDULE_RELATIONSHIP), F.lit("SCHEDULED"))


def congestion_score(level: Column) -> Column:
    return F.coalesce(decode(level, C.CONGESTION_SCORE), F.lit(0))


def weather_condition(code: Column) -> Column:
    """Condition of a WMO code; codes outside every range count as CLEAR."""
    label = F
    for name, ranges in C.WEATHER_CODE_RANGES.items():
        for low, high in ranges:
            label = label.when(code.between(low, high), name)
    return label.otherwise("CLEAR")


def is_severe(condition: Column) -> Column:
    return condition.isin(*C.SEVERE_CONDITIONS)


def route_type_label(route_type: Column) -> Column:
    return F.coalesce(decode(route_type, C.ROUTE_TYPE_LABEL), F.lit("Other"))


def coverage_class(stop_count: Column) -> Column:
    return (
        F.when(stop_count >= 20, "high")
        .when(stop_count >= 5, "medium")
        .when(stop_count >= 2, "low")
        .otherwise("desert")
    )


def gap_severity(distance_km: Column) -> Column:
    """An unbounded gap (NULL distance) is severe."""
    return F.when(distance_km.isNull() | (distance_km > 1.5), "severe").otherwise("desert")


def speed_kmh(speed_ms: Column) -> Column:
    return speed_ms * 3.6


def miles(distance_km: Column) -> Column:
    return distance_km * 0.621


def walk_minutes(distance_km: Column) -> Column:
    return distance_km * 12.5
