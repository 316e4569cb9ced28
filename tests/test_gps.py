import json

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import gps


def message(**fields):
    base = {"event_id": "e", "taxi_id": 7, "timestamp_utc": "2024-01-01T10:00:00Z", "lat": 33.55, "lon": -7.6,
            "speed": 30.0, "status": "moving"}
    base.update(fields)
    return json.dumps({k: v for k, v in base.items() if v is not ...})


def parse(spark, *values):
    raw = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "arrival long, value string")
    return gps.parse_gps(raw).orderBy("arrival").collect()


@pytest.mark.parametrize("value, reason", [
    (message(), None),
    ('"42"', "missing_timestamp"),
    ("not json", "missing_timestamp"),
    (message(timestamp_utc=...), "missing_timestamp"),
    (message(timestamp_utc=""), "missing_timestamp"),
    (message(timestamp_utc="yesterday"), "bad_timestamp"),
    (message(lat=...), "bad_position"),
    (message(lon="east"), "bad_position"),
    (message(speed="NaN"), "bad_speed"),
    (message(speed=-1), "negative_speed"),
])
def test_reject_reasons(spark, value, reason):
    assert parse(spark, value)[0].reject_reason == reason


def test_other_field_names_and_defaults(spark):
    row = parse(spark, json.dumps({
        "vehicle_id": "V1", "timestamp": "2024-01-01T10:00:00+00:00", "latitude": 33.5731, "longitude": -7.5898}))[0]
    assert (row.taxi_id, row.lat, row.lon, row.speed, row.status) == ("V1", 33.5731, -7.5898, 0.0, "unknown")
    assert parse(spark, message(taxi_id=...))[0].taxi_id == "unknown"


def test_source_columns_with_the_name_of_a_field_are_kept(spark):
    raw = spark.createDataFrame([(1, message())], "timestamp long, value string")
    row = gps.parse_gps(raw).first()
    assert row.source_timestamp == 1 and row.reject_reason is None


def test_speed_cap_is_repeatable(spark):
    raw = spark.createDataFrame([(message(event_id=str(i), speed=95),) for i in range(200)], "value string")
    capped = gps.cap_speed(gps.parse_gps(raw)).select("event_id", "speed")
    first, second = sorted(map(tuple, capped.collect())), sorted(map(tuple, capped.collect()))
    assert first == second
    assert all(20 <= s <= 70 and round(s, 1) == pytest.approx(s) for _, s in first)
    assert len({s for _, s in first}) > 50
    kept = gps.cap_speed(gps.parse_gps(spark.createDataFrame([(message(speed=70.0),)], "value string")))
    assert kept.first().speed == 70.0


def test_grid_mode_keeps_the_box_edge_and_drops_blackouts(spark):
    raw = spark.createDataFrame([(v,) for v in (
        message(event_id="edge", lat=33.47, lon=-7.51), message(event_id="out", lat=33.4699),
        message(event_id="dark", lat=0.0, lon=0.0, status="blackout"))], "value string")
    out = gps.normalize(gps.parse_gps(raw), gps.GRID).collect()
    assert [(r.event_id, r.zone_id, r.city) for r in out] == [("edge", 16, "Casablanca")]


def test_polygon_mode_needs_a_lookup(spark):
    with pytest.raises(ValueError):
        gps.normalize(gps.parse_gps(spark.createDataFrame([(message(),)], "value string")))


def test_representative_points(spark):
    df = gps.representative_points(spark.createDataFrame([(1,), (99,)], "zone_id int")).orderBy("zone_id")
    assert [(r.zone_lat, r.zone_lon) for r in df.collect()] == [(33.5893, -7.6114), (33.5731, -7.5898)]


def test_latest_positions(spark):
    df = spark.sql("""SELECT 'Casablanca' AS city, CAST(id % 2 AS INT) AS zone_id, timestamp_seconds(id) AS event_time,
                      id AS taxi_id, 0.0D AS lat, 0.0D AS lon FROM range(50)""")
    assert [r.taxi_id for r in gps.latest_positions(df, "Casablanca", 1, 3).collect()] == [49, 47, 45]


def test_output_fields_follow_the_options(spark):
    out = gps.output_fields(gps.normalize(
        gps.parse_gps(spark.createDataFrame([(message(),)], "value string")), gps.GRID))
    assert out.columns == ["city", "zone_id", "event_time", "taxi_id", "lat", "lon", "speed", "status",
                           "trip_id", "vehicle_id", "origin_zone", "destination_zone"]


def test_rejects_keep_the_reason(spark):
    raw = spark.createDataFrame([(message(),), ('"x"',)], "value string")
    assert gps.rejects(gps.parse_gps(raw)).agg(F.count("*")).first()[0] == 1
