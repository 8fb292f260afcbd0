"""Distances and grid cells."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.contracts import EARTH_RADIUS_M, KM_PER_DEGREE


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres."""
    phi1, phi2 = F.radians(as_column(lat1)), F.radians(as_column(lat2))
    half_lat = F.sin((phi1 - phi2) / 2)
    half_lon = F.sin((F.radians(as_column(lon1)) - F.radians(as_column(lon2))) / 2)
    chord = half_lat * half_lat + F.cos(phi1) * F.cos(phi2) * half_lon * half_lon
    # rounding can lift the chord of antipodes a hair above 1
    return F.asin(F.sqrt(F.least(chord, F.lit(1.0)))) * (2 * EARTH_RADIUS_M)


def flat_km(lat1, lon1, lat2, lon2) -> Column:
    """Plane distance in km at 111 km per degree in both directions."""
    d_lat = as_column(lat1) - as_column(lat2)
    d_lon = as_column(lon1) - as_column(lon2)
    return F.sqrt(d_lat * d_lat + d_lon * d_lon) * KM_PER_DEGREE


def round_cell(degrees: Column, cells_per_degree: int = 100) -> Column:
    """Centre of the 0.01 degree cell; halves round away from zero."""
    return F.round(degrees * float(cells_per_degree)) / float(cells_per_degree)


def grid_cell(degrees: Column, low: float, high: float, cells: int) -> Column:
    """Index of the grid column or row as a double; ``degrees == high`` falls in cell ``cells``."""
    return F.floor((degrees - float(low)) / float(high - low) * cells).cast("double")


def cell_origin(cell: Column, low: float, high: float, cells: int) -> Column:
    """Lower corner of a grid cell in degrees."""
    return F.lit(float(low)) + (cell / float(cells)) * float(high - low)


def in_box(lat: Column, lon: Column, min_lat, max_lat, min_lon, max_lon) -> Column:
    """Inclusive box test that reaches the file scan."""
    return lat.between(min_lat, max_lat) & lon.between(min_lon, max_lon)


def degrees_for_metres(metres: float) -> float:
    """Degrees of latitude spanned by a distance, rounded up a hair."""
    return math.degrees(metres / EARTH_RADIUS_M) * (1 + 1e-9)
