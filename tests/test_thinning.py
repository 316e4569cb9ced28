"""Thinning against a scan along each trip."""

import math
import random

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import thinning


def km(a, b):
    h = math.sin(math.radians(b[0] - a[0]) / 2) ** 2 + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * math.sin(
        math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(min(1.0, h)))


def scan(trip, min_km, min_seconds, seconds):
    kept = [0]
    for k in range(1, len(trip)):
        if km(trip[kept[-1]], trip[k]) >= min_km or (k - kept[-1]) * seconds >= min_seconds:
            kept.append(k)
    return kept


@pytest.mark.parametrize("size, min_seconds", [(1024, 60), (4, 60), (16, 100), (3, 15)])
def test_equals_a_scan(spark, monkeypatch, size, min_seconds):
    monkeypatch.setattr(thinning, "POINTS_PER_BLOCK", size)  # trips of one block and of many
    draw = random.Random(size)
    trips = {}
    for trip in range(30):
        lat, lon, points = 33.5, -7.6, []
        for _ in range(draw.choice((1, 2, 5, 40, 130))):
            lat, lon = lat + draw.uniform(-1, 1) * 0.0004, lon + draw.uniform(-1, 1) * 0.0004
            points.append((lat, lon))
        trips[trip] = points
    data = [(t, k, *p, "x") for t, points in trips.items() for k, p in enumerate(points)]
    points = spark.createDataFrame(data, "trip_id long, point_index int, lat double, lon double, block string")
    got = sorted((r.trip_id, r.point_index) for r in thinning.thin(points, 0.05, min_seconds).collect())
    assert got == sorted((t, k) for t, p in trips.items() for k in scan(p, 0.05, min_seconds, 15))


def test_a_trip_of_a_million_points(spark):
    n = 1_000_000
    # steps of 11 m to the north, and every 7th point a jump of 111 m, so the distance to the last kept point decides
    at = F.col("id")
    points = spark.range(n).select(F.lit(1).alias("trip_id"), at.alias("point_index"),
                                   (33 + (at + 9 * F.floor(at / 7)) / 1e7 * 1000 % 1e-0).alias("lat"), F.lit(-7.6).alias("lon"))
    rows = [(r.lat, -7.6) for r in points.orderBy("point_index").select("lat").toLocalIterator(prefetchPartitions=True)]
    want = scan(rows, 0.05, 60, 15)
    got = thinning.thin(points).agg(F.count("*"), F.sum("point_index"), F.sum(F.col("point_index") % 1009)).first()
    assert tuple(got) == (len(want), sum(want), sum(k % 1009 for k in want))
    assert 0.2 * n < len(want) < 0.9 * n


def test_nothing(spark):
    none = spark.createDataFrame([], "trip_id long, point_index int, lat double, lon double")
    assert thinning.thin(none).collect() == []
