"""Coverage gaps and isolated stops."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.contracts import KM_PER_DEGREE
from headway.functions.codes import gap_severity, miles, walk_minutes
from headway.functions.geo import flat_km
from headway.operators.skew import DEFAULT_SALTS, salted_join

# fixed values: the area searched for gaps, its step and the reach of a grid point, in degrees
GAP_AREA = {"lat_min": 45.40, "lat_max": 45.65, "lon_min": -122.80, "lon_max": -122.30}
GAP_STEP = 0.02
GAP_REACH = 0.01
NEIGHBOUR_REACH = 0.05

_SPLIT = 4  # a cell of one level is split 4 x 4 by the next
_FINEST = 10  # 0.05 degrees / 4**10 is about 5 mm


def gap_nearest_stop(stops: DataFrame, *, lat_min: float = GAP_AREA["lat_min"],
                     lat_max: float = GAP_AREA["lat_max"], lon_min: float = GAP_AREA["lon_min"],
                     lon_max: float = GAP_AREA["lon_max"], step: float = GAP_STEP,
                     reach: float = GAP_REACH) -> DataFrame:
    """Distance in km from every grid point to the nearest stop in the open box around it.

    ``distance_km`` is NULL where the box holds no stop. Each stop is handed to
    the few grid points it can be near, so the work is linear in the stops and
    the shuffle carries at most one row per grid point and task.
    """
    rows, columns = int((lat_max - lat_min) / step), int((lon_max - lon_min) / step)
    span = max(1, math.ceil(reach / step))

    def grid(index, low):
        return F.lit(float(low)) + index * float(step)

    def near(degrees, low):
        base = F.floor((degrees - float(low)) / float(step)).cast("long")
        return F.explode(F.transform(F.sequence(F.lit(-span + 1), F.lit(span)), lambda d: base + d))

    lat, lon = F.col("stop_lat"), F.col("stop_lon")
    i, j = F.col("lat_index"), F.col("lon_index")
    nearest = (
        stops.select("stop_lat", "stop_lon")
        .where(lat.between(lat_min - reach - step, lat_max + reach + step)
               & lon.between(lon_min - reach - step, lon_max + reach + step))
        .withColumn("lat_index", near(lat, lat_min))
        .where(i.between(0, rows - 1) & (F.abs(lat - grid(i, lat_min)) < reach))
        .withColumn("lon_index", near(lon, lon_min))
        .where(j.between(0, columns - 1) & (F.abs(lon - grid(j, lon_min)) < reach))
        .groupBy("lat_index", "lon_index")
        .agg(F.min(flat_km(lat, lon, grid(i, lat_min), grid(j, lon_min))).alias("distance_km"))
    )
    points = stops.sparkSession.range(rows * columns).select(
        F.floor(F.col("id") / columns).alias("lat_index"), (F.col("id") % columns).alias("lon_index")
    )
    return points.join(nearest, ["lat_index", "lon_index"], "left").select(
        grid(i, lat_min).alias("lat"), grid(j, lon_min).alias("lon"), "distance_km",
        F.col("distance_km").isNull().alias("is_unbounded"),
    )


def coverage_gaps(stops: DataFrame, *, beyond_km: float = 0.8, ordered: bool = True,
                  **area) -> DataFrame:
    """Grid points farther than ``beyond_km`` from any stop, unbounded ones first."""
    distance = F.col("distance_km")
    gaps = gap_nearest_stop(stops, **area).where(distance.isNull() | (distance > beyond_km)).select(
        "*",
        gap_severity(distance).alias("severity"),
        miles(distance).alias("miles"),
        walk_minutes(distance).alias("walk_minutes"),
    )
    return gaps.orderBy(F.desc_nulls_first("distance_km"), "lat", "lon") if ordered else gaps


def _in_cells(points: DataFrame, sizes: list[float]) -> DataFrame:
    """One row per point and level, with the point's cell at that level."""
    cells = F.array(*[
        F.struct(
            F.lit(level).alias("level"),
            F.floor(F.col("stop_lat") / size).alias("lat_cell"),
            F.floor(F.col("stop_lon") / size).alias("lon_cell"),
        )
        for level, size in enumerate(sizes)
    ])
    return points.select("*", F.inline(cells))


def nearest_distances(stops: DataFrame, *, reach: float = NEIGHBOUR_REACH,
                      settled_km: float = 0.0, finest: int = _FINEST) -> DataFrame:
    """Distance from each distinct coordinate to the nearest other stop in the open box around it.

    Returns ``stop_lat, stop_lon, distance_km``; NULL means an empty box, and
    stops that share a coordinate are 0 apart. Coordinates certain to lie
    closer than ``settled_km`` to another are left out.

    A coordinate alone in its cell at one level but not at the level above has
    a neighbour within that larger cell's diagonal, so only the cells within
    that distance are searched. A cell of ``n`` stops is met by at most one
    searcher per cell of the next level: pairs grow with the stops however
    many of them crowd one cell, and each searcher's pairs fold into a minimum
    before they are shuffled.
    """
    base = reach * (1 + 2.0**-30)  # a hair above the box, so rounding cannot lose an edge match
    sizes = [base / _SPLIT**level for level in range(finest + 1)]
    if settled_km > 0:
        settled = [k for k, s in enumerate(sizes) if s * math.sqrt(2) * KM_PER_DEGREE < settled_km * 0.999]
        sizes = sizes[: settled[0] + 1] if settled else sizes
    points = stops.groupBy("stop_lat", "stop_lon").agg(F.count(F.lit(1)).alias("shared_by"))
    occupants = _in_cells(points, sizes)
    alone = (
        occupants.groupBy("level", "lat_cell", "lon_cell")
        .agg(F.count(F.lit(1)).alias("n"), F.min("stop_lat").alias("stop_lat"),
             F.min("stop_lon").alias("stop_lon"), F.min("shared_by").alias("shared_by"))
        .where("n = 1")
    )
    if settled_km <= 0:
        # beyond the finest cell the coordinate itself is the cell
        alone = alone.select("stop_lat", "stop_lon", "shared_by", "level").unionByName(
            points.withColumn("level", F.lit(len(sizes)))
        )
    searchers = alone.groupBy("stop_lat", "stop_lon").agg(
        F.greatest(F.min("level") - 1, F.lit(0)).alias("level"), F.min("shared_by").alias("shared_by")
    )

    # cells a searcher must look into: those closer than its own cell's diagonal
    size = F.element_at(F.array(*[F.lit(s) for s in sizes]), F.col("level") + 1)

    def offsets(degrees, cell):
        return F.transform(
            F.sequence(F.lit(-2), F.lit(2)),
            lambda d: F.struct(
                (cell + d).alias("cell"),
                F.greatest((cell + d) * size - degrees, degrees - (cell + d + 1) * size, F.lit(0.0))
                .alias("gap"),
            ),
        )

    lat, lon = F.col("stop_lat"), F.col("stop_lon")
    probes = (
        searchers.where("shared_by = 1")
        .withColumn("_lat", F.explode(offsets(lat, F.floor(lat / size))))
        .where((F.col("level") > 0) | (F.col("_lat.gap") <= reach))
        .withColumn("_lon", F.explode(offsets(lon, F.floor(lon / size))))
        .where(
            F.when(F.col("level") == 0, F.col("_lon.gap") <= reach).otherwise(
                F.col("_lat.gap") * F.col("_lat.gap") + F.col("_lon.gap") * F.col("_lon.gap")
                <= size * size * 2.000001
            )
        )
        .select(
            "level", F.col("_lat.cell").alias("lat_cell"), F.col("_lon.cell").alias("lon_cell"),
            F.col("stop_lat").alias("from_lat"), F.col("stop_lon").alias("from_lon"),
        )
    )
    d_lat, d_lon = F.abs(F.col("from_lat") - lat), F.abs(F.col("from_lon") - lon)
    found = (
        occupants.select("level", "lat_cell", "lon_cell", "stop_lat", "stop_lon")
        # Spark takes the cells for as small as the file they come from, and would broadcast them at all levels
        .join(probes.hint("merge"), ["level", "lat_cell", "lon_cell"])
        .where((d_lat < reach) & (d_lon < reach) & ((d_lat > 0) | (d_lon > 0)))
        .groupBy(F.col("from_lat").alias("stop_lat"), F.col("from_lon").alias("stop_lon"))
        .agg(F.min(flat_km(F.col("from_lat"), F.col("from_lon"), lat, lon)).alias("found_km"))
    )
    return searchers.join(found, ["stop_lat", "stop_lon"], "left").select(
        "stop_lat", "stop_lon",
        F.when(F.col("shared_by") > 1, 0.0).otherwise(F.col("found_km")).alias("distance_km"),
    )


def stop_nearest_neighbour(stops: DataFrame, *, reach: float = NEIGHBOUR_REACH,
                           salts: int = DEFAULT_SALTS) -> DataFrame:
    """Each stop with the distance to its nearest other stop; NULL when none is in reach."""
    nearest = nearest_distances(stops, reach=reach)
    return salted_join(
        stops.select("stop_id", "stop_name", "stop_lat", "stop_lon"), nearest,
        ["stop_lat", "stop_lon"], "left", spread_by=["stop_id"], salts=salts,
    ).withColumn("is_unbounded", F.col("distance_km").isNull())


def isolated_stops(stops: DataFrame, *, beyond_km: float = 1.0, reach: float = NEIGHBOUR_REACH,
                   ordered: bool = True) -> DataFrame:
    """Stops whose nearest other stop is farther than ``beyond_km``, unbounded ones first."""
    distance = F.col("distance_km")
    far = nearest_distances(stops, reach=reach, settled_km=beyond_km).where(
        distance.isNull() | (distance > beyond_km)
    )
    # an isolated coordinate belongs to one stop only, so this join has no frequent key
    found = (
        stops.select("stop_id", "stop_name", "stop_lat", "stop_lon")
        .join(far, ["stop_lat", "stop_lon"])
        .withColumn("is_unbounded", distance.isNull())
    )
    return found.orderBy(F.desc_nulls_first("distance_km"), "stop_id") if ordered else found


def desert_summary(stops: DataFrame, routes: DataFrame) -> DataFrame:
    """One row: gaps, severe and unbounded gaps, largest finite gap, isolated stops, bus and tram routes."""
    distance = F.col("distance_km")
    gaps = coverage_gaps(stops, ordered=False).agg(
        F.count(F.lit(1)).alias("gaps"),
        F.count_if(F.col("severity") == "severe").alias("severe_gaps"),
        F.count_if("is_unbounded").alias("unbounded_gaps"),
        F.max(distance).alias("largest_gap_km"),
    )
    isolated = isolated_stops(stops, ordered=False).agg(F.count(F.lit(1)).alias("n"))
    kinds = routes.agg(
        F.count_if(F.col("route_type") == 3).alias("bus"), F.count_if(F.col("route_type") == 0).alias("tram")
    )
    return gaps.select(
        "*",
        isolated.scalar().alias("isolated_stops"),
        kinds.select("bus").scalar().alias("bus_routes"),
        kinds.select("tram").scalar().alias("tram_routes"),
    )
