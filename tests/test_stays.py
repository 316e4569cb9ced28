"""Stay points against a scan along each trip."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.operators import stays
from test_thinning import km


def scan(trip, radius_km=0.1, min_seconds=300, seconds=15):
    found, i = [], 0
    while i < len(trip):
        if trip[i] is None:
            i += 1
            continue
        end = next((j for j in range(i + 1, len(trip)) if trip[j] is not None and km(trip[i], trip[j]) > radius_km), len(trip))
        if (end - 1 - i) * seconds >= min_seconds:
            found.append((i, end - 1))
            i = end
        else:
            i += 1
    return found


def trip_of(draw, n):
    """Drives and stops in turn; some points have no position."""
    lat, lon, out = 33.5, -7.6, []
    while len(out) < n:
        stop, spread = draw.random() < 0.5, draw.choice((0.0002, 0.0004, 0.0006))
        base = lat, lon
        for _ in range(draw.choice((3, 25, 25, 60))):
            if stop:
                lat, lon = base[0] + draw.uniform(-1, 1) * spread, base[1] + draw.uniform(-1, 1) * spread
            else:
                lat, lon = lat + draw.uniform(0, 0.002), lon + draw.uniform(-1, 1) * 0.001
            out.append(None if draw.random() < 0.03 else (lat, lon))
    return out[:n]


def table(spark, trips):
    data = [(t, k, *(p or (None, 1.0)), "x") for t, points in trips.items() for k, p in enumerate(points)]
    return spark.createDataFrame(data, "trip_id long, point_index int, lat double, lon double, node string")


@pytest.mark.parametrize("size", [1024, 16, 3])
def test_equals_a_scan(spark, monkeypatch, size):
    monkeypatch.setattr(stays, "POINTS_PER_BLOCK", size)  # trips of one block and of many
    draw = random.Random(size)
    trips = {t: trip_of(draw, draw.choice((1, 30, 130, 260, 400))) for t in range(30)}
    trips[90] = [(33.5, -7.6)] * 200  # never moves
    trips[91] = [None] * 30
    trips[92] = [None] * 40 + [(33.5, -7.6)] * 21 + [(34.0, -7.6)]
    got = sorted((r.trip_id, r.first_index, r.last_index) for r in stays.stays(table(spark, trips)).collect())
    assert got == sorted((t, *s) for t, trip in trips.items() for s in scan(trip))
    assert len(got) > 20


def test_where_and_how_long(spark):
    row = stays.stays(table(spark, {7: [(33.0, -7.0)] + [(34.0, -7.0)] * 30})).collect()
    assert [tuple(r) for r in row] == [(7, 1, 30, 435, 34.0, -7.0)]


def test_a_hull_holds_all_points():
    draw = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 50):
        lat, lon = draw.integers(0, 6, n) / 7, draw.integers(0, 6, n) / 7
        y, x = stays.hull(np.append(lat, np.nan), np.append(lon, np.nan))
        for a, o in draw.uniform(-3, 3, (20, 2)):  # the farthest point in any direction is a corner
            assert not n or np.isclose((lat * a + lon * o).max(), (y * a + x * o).max())


def test_a_taxi_parked_for_very_long(spark):
    n, at = 40_000, F.col("id")
    lat = F.when(at.between(1_500, 36_000), 33.5 + (at * 7919 % 101) / 2e5).otherwise(34 + at / 100)
    points = spark.range(n).select(F.lit("a").alias("trip_id"), at.alias("point_index"), lat.alias("lat"), F.lit(-7.6).alias("lon"))
    got = [(r.first_index, r.last_index) for r in stays.stays(points).collect()]
    assert got == [(1_500, 36_000)]


def test_nothing(spark):
    assert stays.stays(table(spark, {}).limit(0)).collect() == []
