"""Smoothing by a motion model against a sequential smoother in covariance form."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.operators import motion


def sequential(z, noise_m=10.0, density=0.5, speed_ms=15.0, t=15.0):
    """Filter forwards, then correct backwards; the first point has a position."""
    z = np.asarray(z, dtype=float)
    f, q = np.array([[1, t], [0, 1]]), density * np.array([[t**3 / 3, t**2 / 2], [t**2 / 2, t]])
    x, p, xs, ps, ahead = None, None, [], [], []
    for k, at in enumerate(z):
        if k == 0:
            x, p = np.array([at, [0, 0]]), np.diag([noise_m**2, speed_ms**2])
        else:
            x, p = f @ x, f @ p @ f.T + q
            ahead.append((x, p))
            if not np.isnan(at).any():
                gain = p[:, :1] / (p[0, 0] + noise_m**2)
                x, p = x + gain @ (at - x[0])[None, :], p - gain @ p[:1]
        xs.append(x)
        ps.append(p)
    for k in range(len(z) - 2, -1, -1):
        gain = ps[k] @ f.T @ np.linalg.inv(ahead[k][1])
        xs[k] = xs[k] + gain @ (xs[k + 1] - ahead[k][0])
    return np.array([x[0] for x in xs])


def walk(draw, n):
    lat, lon, out = 33.5, -7.6, []
    for _ in range(n):
        lat, lon = lat + draw.gauss(0, 0.002), lon + draw.gauss(0, 0.002)
        out.append((lat, lon))
    return out


@pytest.mark.parametrize("size", [512, 8, 3, 1])
def test_equals_a_sequential_smoother(spark, monkeypatch, size):
    monkeypatch.setattr(motion, "POINTS_PER_BLOCK", size)  # trips of one block and of many
    monkeypatch.setattr(motion, "ROWS_IN_STEP", 4)
    draw = random.Random(size)
    trips = {t: walk(draw, draw.choice((1, 2, 7, 25, 60))) for t in range(12)}
    for t in (2, 5, 8):  # points without a position, never the first
        trips[t] = [p if k == 0 or draw.random() < 0.5 else (None, p[1]) for k, p in enumerate(trips[t])]
    data = [(f"t{t}", k, *p, "x") for t, points in trips.items() for k, p in enumerate(points)]
    points = spark.createDataFrame(data, "trip_id string, point_index int, lat double, lon double, block string")
    out = motion.smooth(points)
    assert out.columns == [*points.columns, "motion_lat", "motion_lon"]
    got = {(r.trip_id, r.point_index): (r.motion_lat, r.motion_lon) for r in out.collect()}
    assert len(got) == len(data)
    for t, trip in trips.items():
        want = sequential([(np.nan, np.nan) if p[0] is None else p for p in trip])
        assert np.abs(np.array([got[f"t{t}", k] for k in range(len(trip))]) - want).max() < 1e-9


def test_places_are_filled_in_and_trips_without_any_have_none(spark, monkeypatch):
    monkeypatch.setattr(motion, "POINTS_PER_BLOCK", 4)
    data = [(1, k, 33.0 + k / 1000 if k in (9, 15) else None, -7.0) for k in range(20)] + [(2, k, None, None) for k in range(9)] + [(3, 0, None, 1.0)]
    points = spark.createDataFrame(data, "trip_id long, point_index long, lat double, lon double")
    got = {(r.trip_id, r.point_index): r.motion_lat for r in motion.smooth(points, speed_ms=1e6).collect()}
    # two positions lie on one line, which the velocity may follow freely
    assert all(abs(got[1, k] - (33.0 + k / 1000)) < 1e-6 for k in range(20))
    assert all(got[2, k] is None for k in range(9)) and got[3, 0] is None


def test_a_long_trip(spark):
    n = 200_000
    turn = F.col("id") / 997
    points = spark.range(n).select(
        F.lit(1).alias("trip_id"), F.col("id").alias("point_index"),
        (33 + F.sin(turn) / 10 + (F.col("id") * 7919 % 101 - 50) / 1e5).alias("lat"), (-7 + F.cos(turn) / 10).alias("lon"))
    got = motion.smooth(points).select("point_index", "lat", "lon", "motion_lat", "motion_lon").toPandas().sort_values("point_index")
    want = sequential(got[["lat", "lon"]].to_numpy())
    assert len(got) == n and np.abs(got[["motion_lat", "motion_lon"]].to_numpy() - want).max() < 1e-9


def test_nothing(spark):
    none = spark.createDataFrame([], "trip_id long, point_index int, lat double, lon double")
    assert motion.smooth(none).collect() == []
