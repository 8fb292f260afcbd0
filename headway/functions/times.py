"""Timestamps and the text keys made from them."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_to_ts(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def ensure_utc(ts: Column, zone: str | None = None) -> Column:
    """Timestamp in UTC: a wall-clock value is taken as UTC unless its zone is named."""
    moment = ts.cast("timestamp")
    return moment if zone is None else F.to_utc_timestamp(moment, zone)


def moment(as_of) -> Column:
    """``as_of`` as a column: a Column, a datetime, an ISO string, "feed" for each row's own
    feed time, or None for now."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str) and as_of == "feed":
        return F.col("feed_timestamp")
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    micros = (as_of - datetime(1970, 1, 1, tzinfo=timezone.utc))
    total = (micros.days * 86400 + micros.seconds) * 1_000_000 + micros.microseconds
    return F.timestamp_micros(F.lit(total))


def older_than(ts: Column, as_of, seconds: int) -> Column:
    """True where ``ts`` lies more than ``seconds`` before ``as_of``; future values are never old."""
    return ts < moment(as_of) - F.lit(timedelta(seconds=seconds))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with Z; the fraction appears only when there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    fraction = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.when(F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(fraction)


def _two_decimals(degrees: Column) -> Column:
    """The value rounded to hundredths by its exact binary value, ties to even.

    ``x * 100`` is rounded itself, so values next to a tie (45.205) would fall
    on the wrong side. ``high`` has few enough bits that its products and
    differences lose none, so the signs of ``above`` and ``below`` are exact.
    """
    high = F.floor(degrees * 1048576.0).cast("double") / 1048576.0
    low = (degrees - high) * 100.0
    nearest = F.rint(degrees * 100.0)
    above = (high * 100.0 - nearest - 0.5) + low
    below = (high * 100.0 - nearest + 0.5) + low
    odd = nearest % 2 != 0
    return (
        F.when((above > 0) | ((above == 0) & odd), nearest + 1.0)
        .when((below < 0) | ((below == 0) & odd), nearest - 1.0)
        .otherwise(nearest)
    ) / 100.0


def location_key(lat: Column, lon: Column) -> Column:
    """Key shared by all points of one 0.01 degree location, such as ``45.52,-122.68``."""
    return F.format_string("%.2f,%.2f", _two_decimals(lat), _two_decimals(lon))


def alert_id(detected_at: Column, entity_id: Column) -> Column:
    return F.concat_ws(
        "_",
        F.lit("dqa"),
        F.date_format(detected_at, "yyyyMMdd_HHmmss"),
        F.coalesce(entity_id, F.lit("unknown")),
    )
