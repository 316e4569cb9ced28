"""Trips of one block are searched many at a time and written once."""

import numpy as np

from fleetlens.operators import stays


def test_trips_of_one_block_are_written_once(spark, monkeypatch):
    written, real = [], stays.materialize
    monkeypatch.setattr(stays, "materialize", lambda df, name: written.append(name) or real(df, name))
    points = [("a", i, lat, -7.6) for i, lat in enumerate([33.5, 33.5, 33.5, None, 33.6])]
    points += [("b", 0, None, None), ("b", 1, 33.5, -7.6), ("b", 2, 33.9, -7.6), (None, 0, 33.5, -7.6), (None, 1, 33.5, -7.6)]
    df = spark.createDataFrame(points, "trip_id string, point_index int, lat double, lon double")
    got = sorted((r.trip_id or "", r.first_index, r.last_index) for r in stays.stays(df, min_seconds=15, seconds=15).collect())
    assert got == [("", 0, 1), ("a", 0, 3)] and written == ["stays-blocks"]


def test_many_trips_at_once_equal_one_at_a_time():
    draw, sizes = np.random.default_rng(5), np.array([0, 1, 7, 40, 0, 256, 3])
    lat = np.where(draw.random(sizes.sum()) < 0.1, np.nan, 33.5 + draw.integers(0, 3, sizes.sum()) * 0.01)
    ends = stays._ends(lat, np.full(len(lat), -7.6), sizes, 1.5)
    got = list(zip(*map(np.ndarray.tolist, stays._short_walk(ends, lat, sizes, 2))))
    want = []
    for block, start in enumerate(np.cumsum(sizes) - sizes):
        some = slice(start, start + sizes[block])
        if sizes[block]:
            nexts = stays._nexts(ends[some], lat[some], 0, 256, 2, None)
            want += [(block, *stay) for stay in stays._walk(nexts, 0, 0)]
    assert sorted(got) == want and len(want) > 5
