"""Weather service responses to observation and forecast rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.contracts import CURRENT_WEATHER, HOURLY_FORECAST
from headway.functions.codes import weather_condition
from headway.functions.times import moment


def parse_response(df: DataFrame, column: str = "response") -> DataFrame:
    """Parse response texts; adds ``current_weather`` and ``hourly`` structs, and ``current_fields``.

    The fields are the current-weather object as a map of texts, which tells an absent reading from a null one.
    """
    parsed = F.from_json(column, f"current_weather {CURRENT_WEATHER}, hourly {HOURLY_FORECAST}")
    fields = F.from_json(column, "current_weather MAP<STRING, STRING>")
    return df.withColumns({
        "current_weather": parsed["current_weather"], "hourly": parsed["hourly"],
        "current_fields": fields["current_weather"],
    })


def weather_current(responses: DataFrame, *, observed_at=None) -> DataFrame:
    """One observation per response with a current-weather object.

    ``responses`` has ``latitude, longitude, agency_id, current_weather, current_fields``.
    Absent readings count as 0; ``is_defaulted`` tells which rows had any. A
    response whose object is absent or empty gives no row, and neither does one
    with a reading that is there but null or no number.
    """
    current, fields = F.col("current_weather"), F.col("current_fields")
    any_absent, any_unfit = F.lit(False), F.lit(False)
    for name in ("temperature_2m", "precipitation", "windspeed_10m", "weathercode"):
        present = F.map_contains_key(fields, name)
        any_absent, any_unfit = any_absent | ~present, any_unfit | (present & current[name].isNull())
    code = F.coalesce(current["weathercode"], F.lit(0))

    def number(name: str) -> Column:
        return F.coalesce(current[name], F.lit(0.0))

    return responses.where((F.size(fields) > 0) & ~any_unfit).select(
        "latitude", "longitude",
        number("temperature_2m").alias("temperature_celsius"),
        number("precipitation").alias("precipitation_mm"),
        number("windspeed_10m").alias("wind_speed_kmh"),
        code.alias("weather_code"),
        weather_condition(code).alias("weather_condition"),
        moment(observed_at).alias("observation_time"),
        "agency_id",
        any_absent.alias("is_defaulted"),
    )


def _iso_time(text: Column) -> Column:
    """Timestamp of an ISO text, with or without seconds and zone; NULL for other text."""
    with_seconds = F.regexp_replace(text, r"(T\d\d:\d\d)(Z|[+-]|$)", "$1:00$2")
    return F.try_to_timestamp(with_seconds)


def weather_forecast(responses: DataFrame, *, hours_ahead: int = 24, keep: tuple[str, ...] = ()) -> DataFrame:
    """Hourly rows from parallel arrays: the first ``hours_ahead`` times, NULL where an array is short."""
    hourly = F.col("hourly")
    names = {"temperature_2m": "temperature_celsius", "precipitation": "precipitation_mm",
             "windspeed_10m": "wind_speed_kmh", "weathercode": "weather_code"}
    at = F.col("hour_index")
    return responses.select(
        *keep, "hourly", F.posexplode(F.slice(hourly["time"], 1, hours_ahead)).alias("hour_index", "time_text")
    ).select(
        *keep, "hour_index",
        _iso_time(F.col("time_text")).alias("time"),
        *[F.get(hourly[source], at).alias(name) for source, name in names.items()],
    )
