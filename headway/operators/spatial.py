"""Radius search around one point and radius join of many points."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.contracts import EARTH_RADIUS_M
from headway.functions.geo import degrees_for_metres, haversine_m
from headway.operators.skew import DEFAULT_SALTS, salted_join


def radius_search(positions: DataFrame, *, lat: float, lon: float, radius_m: float = 1000.0,
                  ordered: bool = True) -> DataFrame:
    """Positions within a radius of a point, nearest first.

    A latitude and longitude box around the circle goes to the file scan; the
    exact distance then decides. The longitude box is left out where the circle
    reaches a pole or crosses the 180th meridian.
    """
    d_lat = degrees_for_metres(radius_m) + 1e-9
    rows = positions.where(F.col("latitude").between(lat - d_lat, lat + d_lat))
    edge = max(abs(lat - d_lat), abs(lat + d_lat))
    if edge < 89.9:
        d_lon = _lon_reach(radius_m, edge)
        if -180.0 <= lon - d_lon and lon + d_lon <= 180.0:
            rows = rows.where(F.col("longitude").between(lon - d_lon, lon + d_lon))
    found = rows.withColumn(
        "distance_meters", haversine_m(lat, lon, F.col("latitude"), F.col("longitude"))
    ).where(F.col("distance_meters") <= radius_m)
    return found.orderBy("distance_meters", "vehicle_id", "timestamp") if ordered else found


def _lon_reach(radius_m: float, edge_lat: float) -> float:
    """Degrees of longitude no circle of this radius exceeds up to latitude ``edge_lat``."""
    half_chord = math.sin(radius_m / (2 * EARTH_RADIUS_M)) / math.cos(math.radians(edge_lat))
    if half_chord >= 1.0:
        return 360.0
    return math.degrees(2 * math.asin(half_chord)) * (1 + 1e-9) + 1e-9


def radius_join(points: DataFrame, positions: DataFrame, *, radius_m: float,
                salts: int = DEFAULT_SALTS) -> DataFrame:
    """Pairs of a point and a position within a radius of it.

    ``points`` has ``point_id, point_lat, point_lon``; ``positions`` has
    ``latitude, longitude``. Rows of cells: latitude bands one radius high; in
    each band the longitude cells are as wide as the radius reaches at the
    band's far edges, and cell numbers wrap at the 180th meridian. Each point is
    copied to the at most 9 cells around it, positions to their one cell, and
    the copies of a crowded cell's positions are shared out by salt.
    """
    band_deg = degrees_for_metres(radius_m) + 1e-9

    def band(lat: Column) -> Column:
        return F.floor((lat + 90.0) / band_deg).cast("long")

    def columns_in(band_no: Column) -> Column:
        """Number of longitude cells in a band; 1 near a pole, where a circle spans all of them."""
        south = band_no * band_deg - 90.0
        edge = F.greatest(F.abs(south - band_deg), F.abs(south + 2 * band_deg))
        half_chord = math.sin(radius_m / (2 * EARTH_RADIUS_M)) / F.cos(F.radians(edge))
        reach = F.degrees(F.asin(F.least(half_chord, F.lit(1.0))) * 2) * (1 + 1e-9) + 1e-9
        return F.when(
            (edge < 89.9) & (reach < 90.0), F.greatest(F.floor(360.0 / reach), F.lit(1))
        ).otherwise(F.lit(1)).cast("long")

    def column_of(lon: Column, columns: Column) -> Column:
        return F.pmod(F.floor((lon + 180.0) / 360.0 * columns).cast("long"), columns)

    placed = positions.withColumn("_band", band(F.col("latitude")))
    placed = placed.withColumn("_cell", column_of(F.col("longitude"), columns_in(F.col("_band"))))
    around = (
        points.withColumn("_band", F.explode(F.transform(
            F.sequence(F.lit(-1), F.lit(1)), lambda d: band(F.col("point_lat")) + d)))
        .withColumn("_columns", columns_in(F.col("_band")))
        .withColumn("_cell", F.explode(F.array_distinct(F.transform(
            F.sequence(F.lit(-1), F.lit(1)),
            lambda d: F.pmod(column_of(F.col("point_lon"), F.col("_columns")) + d, F.col("_columns")),
        ))))
        .drop("_columns")
    )
    pairs = salted_join(placed, around, ["_band", "_cell"],
                        spread_by=["latitude", "longitude"], salts=salts)
    return (
        pairs.withColumn(
            "distance_meters",
            haversine_m(F.col("point_lat"), F.col("point_lon"), F.col("latitude"), F.col("longitude")),
        )
        .where(F.col("distance_meters") <= radius_m)
        .drop("_band", "_cell")
    )
