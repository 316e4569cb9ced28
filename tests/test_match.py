import math
import random

import pytest
from pyspark.sql import functions as F

from fleetlens.functions.geo import grid_zone
from fleetlens.operators import match


def km(a, b):
    p1, p2 = math.radians(a[0]), math.radians(b[0])
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(h))


def zone(lat, lon):
    clamp = lambda v: max(0, min(3, math.floor(v)))
    return clamp((33.63 - lat) / (33.63 - 33.47) * 4) * 4 + clamp((lon + 7.73) / (-7.51 + 7.73) * 4) + 1


def near_zones(z):
    r, c = divmod(z - 1, 4)
    return {x * 4 + y + 1 for x in range(max(0, r - 1), min(3, r + 1) + 1) for y in range(max(0, c - 1), min(3, c + 1) + 1)}


def city(seed, pings, requests, taxis, crowded=0.0):
    """Pings and requests; a share of them sits in one corner of one zone."""
    rng = random.Random(seed)

    def place():
        if rng.random() < crowded:
            return 33.55 + rng.uniform(0, 0.003), -7.60 + rng.uniform(0, 0.003)
        return rng.uniform(33.47, 33.63), rng.uniform(-7.73, -7.51)

    p = [(i, rng.randint(1, taxis), rng.randint(0, 1200), *place(), "blackout" if rng.random() < 0.1 else "moving")
         for i in range(pings)]
    r = [(i, rng.randint(0, 1300), *place()) for i in range(requests)]
    return p, r


def frames(spark, pings, requests):
    at = F.timestamp_seconds(F.col("s") + 1_700_000_000)
    p = spark.createDataFrame(pings, "event_id long, taxi_id long, s long, lat double, lon double, status string")
    r = spark.createDataFrame(requests, "request_id long, s long, lat double, lon double")
    tag = lambda df: df.withColumns({"event_time": at, "zone_id": grid_zone(F.col("lat"), F.col("lon"))}).drop("s")
    return tag(p), tag(r)


def candidates(pings, request, fresh=180):
    """(ring, km, taxi, zone) of every usable taxi, best first."""
    _, at, lat, lon = request
    newest = {}
    for event_id, taxi, s, plat, plon, status in pings:
        if s <= at:
            newest[taxi] = max(newest.get(taxi, (-1,)), (s, event_id, plat, plon, status))
    home = zone(lat, lon)
    out = []
    for taxi, (s, _, plat, plon, status) in newest.items():
        z = zone(plat, plon)
        if at - s <= fresh and status != "blackout" and z in near_zones(home):
            out.append((int(z != home), km((lat, lon), (plat, plon)), taxi, z))
    return sorted(out)


@pytest.mark.parametrize("seed, crowded", [(1, 0.0), (2, 0.8)])
def test_nearest_equals_brute_force(spark, seed, crowded):
    pings, requests = city(seed, 400, 120, 40, crowded)
    p, r = frames(spark, pings, requests)
    got = {x.request_id: (x.ring, x.taxi_id, x.taxi_zone, x.distance_km) for x in match.match_nearest(r, p).collect()
           if x.taxi_id is not None}
    assert match.match_nearest(r, p).count() == len(requests)
    want = {}
    for request in requests:
        best = candidates(pings, request)
        if best:
            ring, d, taxi, z = best[0]
            want[request[0]] = (ring, taxi, z, pytest.approx(d, abs=1e-9))
    assert len(want) > 60 and got == want


def test_exclusive_gives_every_request_a_free_taxi(spark):
    place = (33.55, -7.60)
    p, r = frames(spark, [(i, i, 100, *place, "moving") for i in range(8)], [(i, 110, *place) for i in range(8)])
    got = match.match_exclusive(r, p, window_seconds=600).collect()
    assert {x.request_id for x in got} == {x.taxi_id for x in got} == set(range(8)) and len(got) == 8


def test_exclusive_equals_the_rounds_by_hand(spark):
    pings, requests = city(4, 300, 150, 12, 0.5)
    p, r = frames(spark, pings, requests)
    got = {(x.request_id, x.taxi_id, x.round) for x in match.match_exclusive(r, p, window_seconds=120).collect()}

    want, taken, done, number, offers = set(), set(), set(), 0, True
    while offers:
        number, offers = number + 1, {}
        for request in requests:
            if request[0] in done:
                continue
            window = (request[1] + 1_700_000_000) // 120
            free = [c for c in candidates(pings, request) if (window, c[2]) not in taken]
            if free:
                _, d, taxi, _ = free[0]
                offers.setdefault((window, taxi), []).append((d, request[0]))
        for (window, taxi), bids in offers.items():
            winner = min(bids)[1]
            want.add((winner, taxi, number))
            taken.add((window, taxi))
            done.add(winner)
    assert got == want
    assert {n for _, _, n in got} == {1, 2, 3}


def test_same_time_pings_and_the_age_limit(spark):
    pings = [(1, 1, 100, 33.55, -7.60, "moving"), (2, 1, 100, 33.56, -7.60, "moving")]
    requests = [(1, 100, 33.55, -7.60), (2, 280, 33.55, -7.60), (3, 281, 33.55, -7.60), (4, 99, 33.55, -7.60)]
    p, r = frames(spark, pings, requests)
    got = {x.request_id: x.distance_km for x in match.match_nearest(r, p).collect() if x.taxi_id is not None}
    assert set(got) == {1, 2}
    assert got[1] == pytest.approx(km((33.55, -7.60), (33.56, -7.60)))
