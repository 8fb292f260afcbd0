"""As-of joins against a plain search, and the parsing of weather responses."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from headway.operators.weather import delay_by_weather, latest_before, weather_correlate, weather_impact
from headway.sources.weather import parse_response, weather_current, weather_forecast

START = datetime(2026, 1, 31)
OBSERVATION = ("agency_id STRING, observation_time TIMESTAMP, weather_condition STRING, weather_code INT, "
               "temperature_celsius DOUBLE, precipitation_mm DOUBLE, wind_speed_kmh DOUBLE")


def latest(rows, observations, max_age):
    result = []
    for key, at in rows:
        fit = [(o, v) for k, o, v in observations
               if k == key and key is not None and o <= at and (at - o).total_seconds() <= max_age]
        newest = [o for k, o, _ in observations if k == key and key is not None and o <= at]
        found = max(fit) if fit and max(newest) == max(fit)[0] else None
        result.append(found[1] if found else None)
    return result


@pytest.mark.parametrize("max_age, rows_per_task", [(3600, 2_000_000), (3600, 5), (10, 3), (7, 50), (1, 2)])
def test_latest_before(spark, max_age, rows_per_task):
    rng = random.Random(max_age)

    def moment():
        # crowded around one instant, with exact ties and age limits, over several slots
        kind = rng.random()
        if kind < 0.3:
            return START + timedelta(hours=2)
        if kind < 0.6:
            return START + timedelta(hours=2, seconds=rng.randrange(-2 * max_age, 2 * max_age + 1))
        return START + timedelta(microseconds=rng.randrange(int(20e6 * max_age)))

    rows = [(rng.choice(["a", "b", "b", "b", None]), moment()) for _ in range(400)]
    observations = [(rng.choice(["a", "b", "b", None]), moment(), rng.randrange(1000)) for _ in range(60)]
    left = spark.createDataFrame([(i, k, at) for i, (k, at) in enumerate(rows)], "id INT, k STRING, at TIMESTAMP")
    right = spark.createDataFrame(observations, "k STRING, seen TIMESTAMP, v INT")
    joined = latest_before(left, right, keys=["k"], row_time="at", observation_time="seen", values=["v"],
                           max_age_s=max_age, rows_per_task=rows_per_task).collect()
    got = {r.id: r.v for r in joined}
    assert len(joined) == len(rows)
    want = latest(rows, observations, max_age)
    assert [(i, got[i], want[i]) for i in range(len(rows)) if got[i] != want[i]] == []


def test_crowded_slot_is_shared_out(spark):
    """A third of the rows are copies of one row; no window may hold them all."""
    from headway.operators.skew import crowded_groups, with_salt

    rows = spark.range(0, 9000, 1, 30).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS k",
                                                  "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS at")
    crowded = crowded_groups(rows, ["k"], 100)
    assert [tuple(r) for r in crowded.collect()] == [("hot", 30)]
    salted = with_salt(rows.join(crowded, "k", "left").where("k = 'hot'"), ["at"], crowded.select("_salts").scalar())
    assert salted.groupBy("_salt").count().count() > 10


def test_correlate_flags_severe_weather(spark):
    seen = spark.createDataFrame([("a", START, "SNOW", 71, -3.0, 1.0, 5.0)], OBSERVATION)
    rows = spark.createDataFrame(
        [("a", START + timedelta(seconds=3600), "r", 10.0), ("a", START + timedelta(seconds=3601), "r", 20.0),
         ("b", START, "r", 5.0)], "agency_id STRING, timestamp TIMESTAMP, route_id STRING, speed DOUBLE")
    got = {(r.agency_id, r.speed): (r.weather_condition, r.is_severe) for r in weather_correlate(rows, seen).collect()}
    assert got == {("a", 10.0): ("SNOW", True), ("a", 20.0): (None, None), ("b", 5.0): (None, None)}
    impact = {(r.route_id, r.weather_condition): (r.is_severe, r.observations, r.avg_speed_kmh)
              for r in weather_impact(rows, seen).collect()}
    assert impact == {("r", "SNOW"): (True, 1, 36.0), ("r", "UNKNOWN"): (False, 2, 45.0)}
    assert weather_correlate(rows.limit(0), seen).count() == 0


def test_delay_by_weather(spark):
    seen = spark.createDataFrame([("a", START, "RAIN", 61, 3.0, 1.0, 5.0)], OBSERVATION)
    rows = spark.createDataFrame([("a", START, "r", 60), ("a", START, "r", 120), ("a", START, "r", None)],
                                 "agency_id STRING, timestamp TIMESTAMP, route_id STRING, arrival_delay INT")
    row = delay_by_weather(rows, seen).first()
    assert (row.weather_condition, row.observations, row.avg_delay_seconds, row.max_delay_seconds) == ("RAIN", 3, 90.0, 120)


def responses(spark, *texts):
    rows = [(45.5, -122.6, "city", json.dumps(t)) for t in texts]
    return parse_response(spark.createDataFrame(rows, "latitude DOUBLE, longitude DOUBLE, agency_id STRING, response STRING"))


def test_current(spark):
    found = weather_current(responses(
        spark, {"current_weather": {"temperature_2m": 15.5, "precipitation": 2.3, "windspeed_10m": 12.5, "weathercode": 61}},
        {"current_weather": {"weathercode": 95}}, {"current_weather": {}}, {"other": 1}), observed_at=START).collect()
    assert [(r.temperature_celsius, r.precipitation_mm, r.wind_speed_kmh, r.weather_condition, r.is_defaulted)
            for r in found] == [(15.5, 2.3, 12.5, "RAIN", False), (0.0, 0.0, 0.0, "THUNDERSTORM", True)]
    assert {r.observation_time for r in found} == {START}


def test_only_an_absent_reading_counts_as_zero(spark):
    found = weather_current(responses(
        spark, {"current_weather": {"time": "x", "is_day": 1}}, {"current_weather": {"temperature_2m": None}},
        {"current_weather": {"temperature_2m": "warm"}}, {"current_weather": {"weathercode": 0}},
        {"current_weather": None}), observed_at=START).collect()
    assert [(r.temperature_celsius, r.weather_code, r.is_defaulted) for r in found] == [(0.0, 0, True)] * 2


def test_rows_without_a_time_spread(spark):
    rows = spark.range(4000).selectExpr("'a' AS agency_id", "CAST(NULL AS TIMESTAMP) AS timestamp", "id")
    seen = spark.createDataFrame([("a", START, "RAIN", 61, 3.0, 1.0, 5.0)], OBSERVATION)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = weather_correlate(rows, seen).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in sizes) == 4000 and max(r["count"] for r in sizes) < 2000


def test_forecast(spark):
    text = {"hourly": {"time": ["2026-01-31T00:00", "2026-01-31T01:00", "2026-01-31T02:00Z"],
                       "temperature_2m": [1.0, 2.0], "weathercode": [3]}}
    rows = weather_forecast(responses(spark, text), hours_ahead=24).orderBy("hour_index").collect()
    assert [(r.time, r.temperature_celsius, r.weather_code, r.precipitation_mm) for r in rows] == [
        (START, 1.0, 3, None), (START + timedelta(hours=1), 2.0, None, None), (START + timedelta(hours=2), None, None, None)]
    assert weather_forecast(responses(spark, text), hours_ahead=2).count() == 2
    assert weather_forecast(responses(spark, {"hourly": {}}), hours_ahead=2).count() == 0
