"""Cell-based operators against all pairs, with crowded cells, edges and copies."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from headway.operators import coverage, spatial

STOP = "stop_id STRING, stop_name STRING, stop_lat DOUBLE, stop_lon DOUBLE"


def stops_frame(spark, points):
    return spark.createDataFrame([(str(i), f"stop {i}", float(a), float(b)) for i, (a, b) in enumerate(points)], STOP)


def skewed_points(seed, n=500):
    """A third of the points in one tiny cell, copies, cell edges, loners, both hemispheres."""
    rng = random.Random(seed)
    points = [(45.5 + rng.random() * 1e-4, -122.5 + rng.random() * 1e-4) for _ in range(n // 3)]
    points += [(45.5 + rng.gauss(0, 0.05), -122.5 + rng.gauss(0, 0.05)) for _ in range(n // 3)]
    points += [(round(45.4 + rng.randrange(60) * 0.005, 3), round(-122.8 + rng.randrange(60) * 0.005, 3))
               for _ in range(n // 6)]
    points += [(45.5 + k * 0.0125, -122.45 + k * 0.0125) for k in range(8)]
    points += [(rng.uniform(-1, 1), rng.uniform(-1, 1)) for _ in range(n // 6)]
    points += [(0.0, 0.0), (0.05, 0.0), (-0.05, -0.0499), (60.0, 170.0), (45.5, -122.5), (45.5, -122.5)]
    return points


def brute_neighbour(points):
    result = []
    for i, (a, b) in enumerate(points):
        best = None
        for j, (c, d) in enumerate(points):
            x, y = abs(a - c), abs(b - d)
            if i != j and x < 0.05 and y < 0.05:
                km = math.sqrt(x**2 + y**2) * 111
                best = km if best is None else min(best, km)
        result.append(best)
    return result


def same(got, want):
    return (got is None and want is None) or (got is not None and want is not None and got == pytest.approx(want, abs=1e-12))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_nearest_neighbour_equals_all_pairs(spark, seed):
    points = skewed_points(seed)
    want = brute_neighbour(points)
    rows = coverage.stop_nearest_neighbour(stops_frame(spark, points)).collect()
    assert len(rows) == len(points)
    assert [r for r in rows if not same(r.distance_km, want[int(r.stop_id)])] == []
    far = {str(i) for i, km in enumerate(want) if km is None or km > 1.0}
    isolated = coverage.isolated_stops(stops_frame(spark, points)).collect()
    assert {r.stop_id for r in isolated} == far
    assert all(same(r.distance_km, want[int(r.stop_id)]) for r in isolated)


degrees = st.integers(0, 400).map(lambda k: k * 0.0005)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(degrees, degrees), min_size=1, max_size=40))
def test_nearest_neighbour_on_a_lattice(spark, points):
    points = [(45.4 + a, -122.8 + b) for a, b in points]
    want = brute_neighbour(points)
    rows = coverage.stop_nearest_neighbour(stops_frame(spark, points)).collect()
    assert [r for r in rows if not same(r.distance_km, want[int(r.stop_id)])] == []


def test_crowded_cell_makes_few_pairs(spark):
    """3000 stops in one cell must not meet each other pairwise."""
    rng = random.Random(5)
    points = [(45.5 + rng.random() * 0.01, -122.5 + rng.random() * 0.01) for _ in range(3000)]
    plan = coverage.stop_nearest_neighbour(stops_frame(spark, points))
    plan.collect()
    rows = _join_output_rows(plan)
    assert 0 < rows < 3000 * 200


def _join_output_rows(df):
    """Rows out of the largest join of an executed plan."""
    def metrics(node):
        values = []
        name = node.nodeName()
        if "Join" in name:
            metric = node.metrics().get("numOutputRows")
            if metric.isDefined():
                values.append(metric.get().value())
        if name == "AdaptiveSparkPlan":
            return values + metrics(node.executedPlan())
        if "QueryStage" in name:
            return values + metrics(node.plan())
        children = node.children()
        for i in range(children.size()):
            values += metrics(children.apply(i))
        return values

    return max(metrics(df._jdf.queryExecution().executedPlan()))


def test_cells_of_a_small_file_are_not_broadcast(spark, tmp_path):
    """The file is estimated at a few hundred kilobytes, its cells at all levels are eleven times as many rows."""
    count = 20_000
    spark.range(count).write.parquet(f"{tmp_path}/keys")
    stops = spark.read.parquet(f"{tmp_path}/keys").selectExpr(
        "CAST(id AS STRING) AS stop_id", "CAST(id AS STRING) AS stop_name", "45.4D + (id * 7919) % 2503 / 1e4D AS stop_lat",
        "-122.8D + (id * 104729) % 4999 / 1e4D AS stop_lon")
    plan = coverage.stop_nearest_neighbour(stops, salts=1)  # each salt would add a copy of the distances
    assert len(plan.collect()) == count
    assert max(_broadcast_rows(plan._jdf.queryExecution().executedPlan()), default=0) <= count


def _broadcast_rows(node):
    """Rows of each broadcast of an executed plan."""
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        return _broadcast_rows(node.executedPlan())
    if "QueryStage" in name:
        return _broadcast_rows(node.plan())
    rows = [node.metrics().apply("numOutputRows").value()] if name == "BroadcastExchange" else []
    children = node.children()
    return rows + [n for i in range(children.size()) for n in _broadcast_rows(children.apply(i))]


@pytest.mark.parametrize("seed", [4, 5])
def test_gaps_equal_all_pairs(spark, seed):
    points = skewed_points(seed) + [(45.41, -122.79), (45.40, -122.81), (45.39, -122.8), (45.43, -122.75)]
    want = {}
    for i in range(12):
        for j in range(25):
            lat, lon = 45.40 + i * 0.02, -122.80 + j * 0.02
            best = None
            for a, b in points:
                x, y = abs(a - lat), abs(b - lon)
                if x < 0.01 and y < 0.01:
                    km = math.sqrt(x**2 + y**2) * 111
                    best = km if best is None else min(best, km)
            want[(lat, lon)] = best
    rows = coverage.gap_nearest_stop(stops_frame(spark, points)).collect()
    assert len(rows) == 300
    assert [r for r in rows if not same(r.distance_km, want[(r.lat, r.lon)])] == []
    gaps = coverage.coverage_gaps(stops_frame(spark, points)).collect()
    assert {(r.lat, r.lon) for r in gaps} == {k for k, km in want.items() if km is None or km > 0.8}
    bounded = [r.distance_km for r in gaps if not r.is_unbounded]
    assert bounded == sorted(bounded, reverse=True)
    assert all(r.is_unbounded for r in gaps[: len(gaps) - len(bounded)])


def haversine(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((p - q) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b - d) / 2) ** 2
    return 2 * 6371000 * math.asin(min(1.0, math.sqrt(h)))


@pytest.mark.parametrize("radius", [250.0, 40_000.0, 900_000.0])
def test_radius_join_equals_all_pairs(spark, radius):
    """Poles, the 180th meridian, copies and a crowded cell included."""
    rng = random.Random(11)
    places = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(60)]
    places += [(89.999, k * 40.0 - 180) for k in range(9)] + [(-90.0, 10.0), (90.0, 0.0)]
    places += [(rng.uniform(-5, 5), s * (180 - rng.random() * 0.3)) for s in (1, -1) for _ in range(30)]
    places += [(45.5 + rng.random() * 1e-3, -122.5 + rng.random() * 1e-3) for _ in range(80)] + [(45.5, -122.5)] * 20
    points = [(f"p{i}", a + rng.uniform(-2e-3, 2e-3) if abs(a) < 89 else a, b) for i, (a, b) in enumerate(places[::2])]
    points += [("seam+", 0.0, 180.0), ("seam-", 0.0, -180.0), ("pole", 90.0, 77.0)]
    left = spark.createDataFrame(points, "point_id STRING, point_lat DOUBLE, point_lon DOUBLE")
    right = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(places)], "id INT, latitude DOUBLE, longitude DOUBLE")
    want = {(p, i) for p, a, b in points for i, (c, d) in enumerate(places) if haversine(a, b, c, d) <= radius}
    rows = spatial.radius_join(left, right, radius_m=radius).select("point_id", "id").collect()
    assert len(rows) == len(want)
    assert {tuple(r) for r in rows} == want


@pytest.mark.parametrize("lat, lon, radius", [(45.5, -122.5, 1000.0), (0.0, 179.99, 5000.0), (89.99, 20.0, 5000.0),
                                              (-45.0, -180.0, 3000.0)])
def test_radius_search_equals_scan(spark, lat, lon, radius):
    rng = random.Random(3)
    reach = radius / 60_000
    places = []
    for _ in range(400):
        a = max(-90.0, min(90.0, lat + rng.uniform(-reach, reach)))
        b = lon + rng.uniform(-reach, reach) * (60 if abs(lat) > 80 else 1)
        places.append((a, (b + 180) % 360 - 180))
    rows = [(f"v{i}", i, a, b) for i, (a, b) in enumerate(places)]
    frame = spark.createDataFrame(rows, "vehicle_id STRING, timestamp INT, latitude DOUBLE, longitude DOUBLE")
    found = spatial.radius_search(frame, lat=lat, lon=lon, radius_m=radius).collect()
    assert {r.timestamp for r in found} == {i for i, (a, b) in enumerate(places) if haversine(lat, lon, a, b) <= radius}
    assert [r.distance_meters for r in found] == sorted(r.distance_meters for r in found)
