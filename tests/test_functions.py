import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fleetlens.functions import geo, text, timing, trips as tf


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("moment, expected", [
    ("2024-01-01 08:15:00", 2.5),  # Monday
    ("2024-01-02 18:00:00", 2.8),  # Tuesday
    ("2024-01-05 13:59:59", 0.30),  # Friday lunch
    ("2024-01-05 14:00:00", 0.7),  # Friday after lunch
    ("2024-01-07 03:00:00", 0.10),  # Sunday
])
def test_demand_multiplier(spark, moment, expected):
    assert one(spark, timing.demand_multiplier(F.lit(moment).cast("timestamp"))) == pytest.approx(expected)


def test_request_rate_has_a_floor(spark):
    assert one(spark, timing.request_delay_seconds(F.lit(2.5))) == pytest.approx(12.0)
    assert one(spark, timing.request_delay_seconds(F.lit(2.0), 1000.0)) == pytest.approx(0.05)
    assert one(spark, timing.requests_per_hour(F.lit(1.0))) == pytest.approx(120.0)


@pytest.mark.parametrize("name, expected", [
    ("arrondissement d'Aîn-Chock (عين الشق (المقاطعة", "Aîn-Chock"),
    ("Arrondissement de Sidi   Moumen", "Sidi Moumen"),
    ("ARRONDISSEMENT DES Roches Noires - ", "Roches Noires"),
    ("Anfa أنفا", "Anfa"),
    ("(x)", "unknown"),
    (None, "unknown"),
])
def test_clean_zone_name(spark, name, expected):
    assert one(spark, text.clean_zone_name(F.lit(name).cast("string"))) == expected


def test_property_prefers_exact_names_then_any_case(spark):
    names = ["zone_id", "id"]
    pick = lambda m: one(spark, text.pick_property(F.expr(m), names))
    assert pick("map('id', '5', 'ZONE_ID', '7')") == "5"
    assert pick("map('zone_id', '', 'Id', '8')") == "8"
    assert pick("map('zone_id', cast(null as string), 'ID', '')") is None


@pytest.mark.parametrize("value, expected", [
    ("moving", "🚕 MOVING"), ("blackout", "🔴 BLACKOUT"), ("parked", "[PARKED]"), (None, "[UNKNOWN]")])
def test_status_label(spark, value, expected):
    assert one(spark, text.status_label(F.lit(value).cast("string"))) == expected


@pytest.mark.parametrize("value, expected", [("", "normal"), (None, "normal"), ("rain_event", "rain_event")])
def test_anomaly_label(spark, value, expected):
    assert one(spark, text.anomaly_label(F.lit(value).cast("string"))) == expected


def test_haversine_is_symmetric_and_zero_on_itself(spark):
    a, b = (33.57, -7.59), (33.60, -7.50)
    there = one(spark, geo.haversine_km(*map(F.lit, (*a, *b))))
    back = one(spark, geo.haversine_km(*map(F.lit, (*b, *a))))
    assert there == pytest.approx(back) and one(spark, geo.haversine_km(*map(F.lit, (*a, *a)))) == 0
    p1, p2 = math.radians(a[0]), math.radians(b[0])
    chord = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(0.09) / 2) ** 2
    assert there == pytest.approx(2 * 6371 * math.asin(math.sqrt(chord)))


def test_grid_zone(spark):
    zone = lambda lat, lon: one(spark, geo.grid_zone(F.lit(lat), F.lit(lon)))
    assert zone(33.5731, -7.5898) == 7
    assert zone(33.63, -7.73) == 1 and zone(33.47, -7.51) == 16
    assert zone(40.0, -7.9) == 1 and zone(30.0, 0.0) == 16


def test_zone_neighbours(spark):
    around = lambda z: sorted(one(spark, geo.zone_neighbours(F.lit(z))))
    assert around(1) == [2, 5, 6]
    assert around(6) == [1, 2, 3, 5, 7, 9, 10, 11]


def test_durations(spark):
    three = "[[-7.60,33.55],[-7.61,33.56],[-7.62,33.57]]"
    text_seconds = lambda p: one(spark, tf.duration_from_text(F.lit(p)))
    parsed = lambda p: one(spark, tf.duration_from_points(tf.parse_polyline(F.lit(p))))
    assert text_seconds(three) == 45 and parsed(three) == 45
    assert text_seconds("[]") == 15 and parsed("[]") == 0
    assert text_seconds("[[-7.60,33.55]]") == 15


def test_hash_zone_stays_in_range(spark):
    zones = spark.range(5000).select(tf.hash_zone(F.col("id").cast("string")).alias("z")).agg(
        F.min("z"), F.max("z"), F.countDistinct("z")).first()
    assert tuple(zones) == (1, 16, 16)


def test_estimates(spark):
    minutes = lambda km: one(spark, tf.estimated_minutes(F.lit(km)))
    assert minutes(0.0) == 5.0 and minutes(0.1) == 2.0 and minutes(25.0) == 60.0
    assert one(spark, tf.base_fare(F.lit(10.0))) == pytest.approx(34.5)
    fares = spark.range(500).select(tf.quoted_fare(F.lit(10.0), F.col("id")).alias("f"))
    low, high = fares.agg(F.min("f"), F.max("f")).first()
    assert 34.5 * 0.9 - 0.01 <= low < high <= 34.5 * 1.1 + 0.01


def test_iso_times(spark):
    parsed = spark.createDataFrame(
        [("2024-01-01T10:00:00Z",), ("2024-01-01T12:00:00+02:00",), ("2024-01-01T10:00:00.250000+00:00",),
         ("junk",), ("2024",), (None,)], "s string").select(F.unix_millis(timing.parse_iso(F.col("s"))))
    assert [r[0] for r in parsed.collect()] == [1704103200000, 1704103200000, 1704103200250, None, None, None]


def test_stable_values_repeat(spark):
    df = spark.range(100).select(text.stable_number(F.col("id"), 501).alias("n"), text.stable_order(F.col("id"), 1))
    assert rows(df) == rows(df)
    assert df.agg(F.min("n"), F.max("n")).first()[1] < 501
