"""Contract checks, quality counts and the quarantine.

A rule is a named condition that holds for a bad record. The same rules give
the row filter (`keep_valid`), the list of broken rules (`annotate`) and the
alert rows (`alerts`).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway import contracts as C
from headway.functions.codes import decode
from headway.functions.times import alert_id, epoch_to_ts, moment, older_than
from headway.operators.flatten import has_trip, trip_update_fields, vehicle_fields


@dataclass(frozen=True)
class Rule:
    name: str
    field: str
    bad: Column
    alert_type: str = "VALIDATION_ERROR"


def _missing(column: Column) -> Column:
    return F.coalesce(column, F.lit("")) == ""


def _outside(column: Column, low, high) -> Column:
    """True for a value off the closed range; NaN is off every range."""
    return ~column.between(low, high)


def _not_member(column: Column, names) -> Column:
    return ~column.isin(*names)


def _if_present(column: Column, bad: Column) -> Column:
    return column.isNotNull() & bad


def _required(column: Column, bad: Column) -> Column:
    return column.isNull() | bad


def vehicle_rules(as_of=None, *, max_speed=C.MAX_SPEED_MS, max_age_s=C.MAX_POSITION_AGE_S,
                  prefix: str = "") -> list[Rule]:
    """Rules for vehicle positions; ``as_of="feed"`` measures age against each row's feed time."""
    def col(name):
        return F.col(prefix + name)

    if isinstance(as_of, str) and as_of == "feed":
        as_of = col("feed_timestamp")
    lat, lon, speed, bearing = col("latitude"), col("longitude"), col("speed"), col("bearing")
    sequence, ts = col("current_stop_sequence"), col("timestamp")
    return [
        Rule("vehicle_id_missing", "vehicle_id", _missing(col("vehicle_id"))),
        Rule("latitude_out_of_range", "latitude", _required(lat, _outside(lat, -90.0, 90.0)),
             "GEOGRAPHIC_VIOLATION"),
        Rule("longitude_out_of_range", "longitude", _required(lon, _outside(lon, -180.0, 180.0)),
             "GEOGRAPHIC_VIOLATION"),
        Rule("bearing_out_of_range", "bearing",
             _if_present(bearing, (bearing < 0.0) | (bearing >= 360.0))),
        Rule("speed_out_of_range", "speed", _if_present(speed, _outside(speed, 0.0, max_speed)),
             "SPEED_VIOLATION"),
        Rule("stop_sequence_negative", "current_stop_sequence", _if_present(sequence, sequence < 0)),
        Rule("current_status_unknown", "current_status",
             _if_present(col("current_status"),
                         _not_member(col("current_status"), C.VEHICLE_STOP_STATUS.values()))),
        Rule("congestion_level_unknown", "congestion_level",
             _if_present(col("congestion_level"),
                         _not_member(col("congestion_level"), C.CONGESTION_LEVEL.values()))),
        Rule("occupancy_status_unknown", "occupancy_status",
             _if_present(col("occupancy_status"),
                         _not_member(col("occupancy_status"), C.OCCUPANCY_STATUS.values()))),
        Rule("agency_id_missing", "agency_id", col("agency_id").isNull()),
        Rule("feed_timestamp_missing", "feed_timestamp", col("feed_timestamp").isNull()),
        Rule("timestamp_missing", "timestamp", ts.isNull()),
        Rule("position_stale", "timestamp", _if_present(ts, older_than(ts, as_of, max_age_s)),
             "STALE_DATA"),
    ]


def trip_update_rules(*, min_delay=C.MIN_DELAY_S, max_delay=C.MAX_DELAY_S,
                      prefix: str = "") -> list[Rule]:
    def col(name):
        return F.col(prefix + name)

    arrival, departure = col("arrival_delay"), col("departure_delay")
    relation = col("schedule_relationship")
    return [
        Rule("trip_id_missing", "trip_id", _missing(col("trip_id"))),
        Rule("stop_id_missing", "stop_id", _missing(col("stop_id"))),
        Rule("stop_sequence_negative", "stop_sequence",
             _required(col("stop_sequence"), col("stop_sequence") < 0)),
        Rule("arrival_delay_out_of_range", "arrival_delay",
             _if_present(arrival, _outside(arrival, min_delay, max_delay))),
        Rule("departure_delay_out_of_range", "departure_delay",
             _if_present(departure, _outside(departure, min_delay, max_delay))),
        Rule("arrival_after_departure", "arrival_time",
             F.coalesce(col("arrival_time") > col("departure_time"), F.lit(False))),
        Rule("schedule_relationship_unknown", "schedule_relationship",
             _required(relation, _not_member(relation, C.SCHEDULE_RELATIONSHIP.values()))),
        Rule("agency_id_missing", "agency_id", col("agency_id").isNull()),
        Rule("timestamp_missing", "timestamp", col("timestamp").isNull()),
    ]


def weather_rules(as_of=None, *, max_age_s=C.MAX_WEATHER_AGE_S) -> list[Rule]:
    def bounded(name, low, high, rule, kind="VALIDATION_ERROR"):
        column = F.col(name)
        return Rule(rule, name, _required(column, _outside(column, low, high)), kind)

    rain, seen, condition = F.col("precipitation_mm"), F.col("observation_time"), F.col("weather_condition")
    return [
        bounded("latitude", -90.0, 90.0, "latitude_out_of_range", "GEOGRAPHIC_VIOLATION"),
        bounded("longitude", -180.0, 180.0, "longitude_out_of_range", "GEOGRAPHIC_VIOLATION"),
        bounded("temperature_celsius", *C.TEMPERATURE_C, "temperature_out_of_range"),
        Rule("precipitation_negative", "precipitation_mm",
             _required(rain, (rain < 0.0) | F.isnan(rain))),
        bounded("wind_speed_kmh", 0.0, C.MAX_WIND_KMH, "wind_speed_out_of_range"),
        bounded("weather_code", 0, C.MAX_WEATHER_CODE, "weather_code_out_of_range"),
        Rule("weather_condition_unknown", "weather_condition",
             _required(condition, _not_member(condition, C.WEATHER_CODE_RANGES))),
        Rule("agency_id_missing", "agency_id", F.col("agency_id").isNull()),
        Rule("observation_time_missing", "observation_time", seen.isNull()),
        Rule("observation_stale", "observation_time",
             _if_present(seen, older_than(seen, as_of, max_age_s)), "STALE_DATA"),
    ]


def agency_bounds_rules() -> list[Rule]:
    """Rule over rows joined to the agency table; an agency without bounds has no limit."""
    lat, lon = F.col("latitude"), F.col("longitude")
    outside = _outside(lat, F.col("min_latitude"), F.col("max_latitude")) | _outside(
        lon, F.col("min_longitude"), F.col("max_longitude")
    )
    return [Rule("outside_agency_bounds", "latitude", F.coalesce(outside, F.lit(False)),
                 "GEOGRAPHIC_VIOLATION")]


def any_broken(rules: list[Rule]) -> Column:
    return reduce(lambda a, b: a | b, (rule.bad for rule in rules))


def broken_rules(rules: list[Rule]) -> Column:
    """Names of the broken rules, in rule order."""
    return F.array_compact(F.array(*[F.when(rule.bad, F.lit(rule.name)) for rule in rules]))


def annotate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``violations``, the names of the rules a row breaks."""
    return df.withColumn("violations", broken_rules(rules))


def keep_valid(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return df.where(~any_broken(rules))


def validate_vehicles(df: DataFrame, *, as_of=None, **limits) -> DataFrame:
    return annotate(df, vehicle_rules(as_of, **limits))


def validate_trip_updates(df: DataFrame, **limits) -> DataFrame:
    return annotate(df, trip_update_rules(**limits))


def validate_weather(df: DataFrame, *, as_of=None, **limits) -> DataFrame:
    return annotate(df, weather_rules(as_of, **limits))


def quality_split(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Row counts per outcome: ``valid``, ``invalid`` and one row per broken rule."""
    bad = broken_rules(rules)
    verdict = F.when(F.size(bad) == 0, "valid").otherwise("invalid")
    return df.select(F.explode(F.concat(F.array(verdict), bad)).alias("outcome")).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("records")
    )


def alerts(df: DataFrame, rules: list[Rule], *, entity_type: str, entity_id: str,
           as_of=None, severity: str = "MEDIUM") -> DataFrame:
    """One alert per row that breaks a rule; its first broken rule gives type, field and value."""
    detected = moment(as_of)
    first = F.element_at("_broken", 1)
    value = F
    for rule in rules:
        value = value.when(first == rule.name, F.col(rule.field).cast("string"))
    return (
        df.where(any_broken(rules))
        .withColumn("_broken", broken_rules(rules))
        .select(
            alert_id(detected, F.col(entity_id)).alias("alert_id"),
            decode(first, {rule.name: rule.alert_type for rule in rules}).alias("alert_type"),
            F.lit(severity).alias("severity"),
            F.lit(entity_type).alias("entity_type"),
            F.col(entity_id).alias("entity_id"),
            F.col("agency_id"),
            F.array_join("_broken", "; ").alias("error_message"),
            decode(first, {rule.name: rule.field for rule in rules}).alias("field_name"),
            value.alias("field_value"),
            detected.alias("detected_at"),
        )
    )


BOUNDS = ("min_latitude", "max_latitude", "min_longitude", "max_longitude")


def with_agency_bounds(positions: DataFrame, agencies: DataFrame) -> DataFrame:
    """Positions with the service area of their agency, for `agency_bounds_rules`; an unknown agency has none."""
    return positions.join(agencies.select("agency_id", *BOUNDS), "agency_id", "left")


def check_agency_bounds(positions: DataFrame, agencies: DataFrame) -> DataFrame:
    """Add ``violations`` for positions outside their own agency's service area."""
    return annotate(with_agency_bounds(positions, agencies), agency_bounds_rules()).drop(*BOUNDS)


# Java's number suffixes (5d, 1f) convert in Spark and are no numbers here
_NUMBER = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf(inity)?)$"
_WHOLE = r"^[+-]?\d+(\.0*)?$"


def _lax_double(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def _lax_int(text: Column) -> Column:
    """Whole number from text; a fraction such as 5.5 is refused, 5.0 is not, nor is an exponent taken."""
    number = F.when(text.rlike(_WHOLE), text.try_cast("double"))
    return F.when(number == F.floor(number), number.try_cast("int"))


def coerce_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Convert text columns to the named types and list the ones that failed.

    ``types`` maps a column to ``double``, ``int`` or ``timestamp``. A value
    that does not convert becomes NULL and adds ``<column>_not_<type>`` to
    ``violations``; NULL in stays NULL without a violation.
    """
    converted = {
        name: _lax_int(F.trim(F.col(name))) if kind == "int"
        else _lax_double(F.trim(F.col(name))) if kind == "double"
        else F.trim(F.col(name)).try_cast(kind)
        for name, kind in types.items()
    }
    failed = [
        F.when(F.col(name).isNotNull() & column.isNull(), F.lit(f"{name}_not_{types[name]}"))
        for name, column in converted.items()
    ]
    return df.withColumns({"violations": F.array_compact(F.array(*failed)), **converted})


def feed_stats(feed: DataFrame, *, agency_id, as_of=None) -> DataFrame:
    """Counters of a run over feed messages, in one pass.

    ``validation_rate`` follows the poller's counters: a valid stop-time update
    counts, an invalid one does not, and the base is entities, so it can exceed
    1. ``row_validation_rate`` is valid rows over all rows.
    """
    entity, stop = F.col("entity"), F.col("stu")
    trip_update = entity["trip_update"]

    def record(fields):
        return F.struct(*[column.alias(name) for name, column in fields.items()])

    rows = (
        feed.select(
            epoch_to_ts(F.col("header.timestamp")).alias("feed_ts"),
            F.col("header").isNotNull().alias("decoded"),
            F.posexplode_outer("entity").alias("entity_at", "entity"),
        )
        .select(
            "feed_ts", "decoded", "entity_at", "entity",
            F.posexplode_outer(
                F.when(has_trip(trip_update), trip_update["stop_time_update"])
            ).alias("stu_at", "stu"),
        )
        .select(
            (F.coalesce("stu_at", F.lit(0)) == 0).alias("first_row"),
            (F.coalesce("entity_at", F.lit(0)) == 0).alias("first_entity"),
            "decoded",
            entity.isNotNull().alias("is_entity"),
            entity["vehicle"].isNotNull().alias("has_vehicle"),
            entity["vehicle"]["position"].isNotNull().alias("has_position"),
            stop.isNotNull().alias("has_update"),
            record(vehicle_fields(entity, F.col("feed_ts"), agency_id)).alias("v"),
            record(trip_update_fields(trip_update, stop, F.col("feed_ts"), agency_id)).alias("t"),
        )
    )
    vehicle_ok = F.col("has_position") & ~any_broken(vehicle_rules(as_of, prefix="v."))
    update_ok = F.col("has_update") & ~any_broken(trip_update_rules(prefix="t."))
    first = F.col("first_row")
    counted = rows.agg(
        F.count_if(first & F.col("first_entity")).alias("total_polls"),
        F.count_if(first & F.col("first_entity") & F.col("decoded")).alias("successful_polls"),
        F.count_if(first & F.col("is_entity")).alias("total_entities"),
        F.count_if(first & F.col("has_vehicle") & vehicle_ok).alias("valid_vehicles"),
        F.count_if(first & F.col("has_vehicle") & ~vehicle_ok).alias("invalid_entities"),
        F.count_if(update_ok).alias("valid_updates"),
        F.count_if(F.col("has_update")).alias("updates"),
    )
    valid = F.col("valid_vehicles") + F.col("valid_updates")
    all_rows = F.col("valid_vehicles") + F.col("invalid_entities") + F.col("updates")

    def rate(part, whole):
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    return counted.select(
        "total_polls",
        "successful_polls",
        "total_entities",
        valid.alias("valid_entities"),
        "invalid_entities",
        rate(F.col("successful_polls"), F.col("total_polls")).alias("success_rate"),
        rate(valid, F.col("total_entities")).alias("validation_rate"),
        rate(valid, all_rows).alias("row_validation_rate"),
    )
