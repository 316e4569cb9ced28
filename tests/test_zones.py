import json
import math
import random

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import gps
from fleetlens.sources import zones as zs


def feature(props, kind, coordinates):
    return {"type": "Feature", "properties": props, "geometry": {"type": kind, "coordinates": coordinates}}


def box(x0, y0, x1, y1):
    return [[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]


@pytest.fixture
def load(spark, tmp_path):
    def read(features, **options):
        path = tmp_path / "zones.geojson"
        path.write_text(json.dumps({"type": "FeatureCollection", "features": features}), encoding="utf-8")
        return zs.zone_dimension(zs.read_features(spark, str(path)), **options)
    return read


def star(cx, cy, n, rng):
    points = []
    for i in range(n):
        r, a = rng.uniform(0.01, 0.04), 2 * math.pi * i / n
        points.append([cx + r * math.cos(a), cy + r * math.sin(a)])
    return points + [points[0]]


def in_ring(x, y, ring):
    inside = False
    for (xi, yi), (xj, yj) in zip(ring, [ring[-1]] + ring[:-1]):
        if (yi > y) != (yj > y) and x < (xj - xi) * (y - yi) / (yj - yi) + xi:
            inside = not inside
    return inside


def first_zone(x, y, shapes):
    for number, polygons in enumerate(shapes, 1):
        for rings in polygons:
            if in_ring(x, y, rings[0]) and not any(in_ring(x, y, h) for h in rings[1:]):
                return number
    return None


def test_dimension(load):
    zones = load([
        feature({"NOM": "arrondissement d'Aîn-Chock (x)", "id": "7", "Prefecture": "P", "Population": 100},
                "Polygon", [box(0, 0, 1, 1)]),
        feature({"name": "Mechouar Casablanca"}, "Polygon", [box(5, 5, 6, 6)]),
        feature({"name": "a point"}, "Point", [0, 0]),
        feature({"ARRONDISSEMENT": "b", "ID": "x9"}, "MultiPolygon", [[box(2, 0, 3, 1)], [box(2, 2, 3, 3)]]),
        feature({}, "Polygon", [box(8, 0, 9, 1)]),
    ]).orderBy("seq").collect()
    assert [(z.seq, z.zone_id, z.name, z.prefecture, z.population) for z in zones] == [
        (1, 7, "Aîn-Chock", "P", "100"), (2, 2, "b", "", None), (3, 3, "zone_3", "", None)]
    assert (zones[0].centroid_lon, zones[0].centroid_lat) == pytest.approx((0.4, 0.4))


def test_raw_names_stay_raw(load):
    zones = load([feature({"name": "arrondissement d'Anfa (x)"}, "Polygon", [box(0, 0, 1, 1)])], clean_names=False)
    assert zones.first().name == "arrondissement d'Anfa (x)"


def test_holes_parts_and_file_order(spark, load):
    zones = load([
        feature({"name": "ring", "id": 1}, "Polygon", [box(0, 0, 0.1, 0.1), box(0.04, 0.04, 0.06, 0.06)]),
        feature({"name": "over", "id": 2}, "MultiPolygon", [[box(0.05, 0.05, 0.15, 0.1)], [box(0.2, 0.2, 0.22, 0.22)]]),
    ])
    lookup = gps.ZoneLookup(zones)
    cases = {(0.02, 0.02): 1, (0.045, 0.045): None, (0.055, 0.055): 2, (0.09, 0.09): 1, (0.09, 0.12): 2,
             (0.21, 0.21): 2, (0.19, 0.19): None}
    points = spark.createDataFrame([(lat, lon) for lat, lon in cases], "lat double, lon double")
    strict = {(r.lat, r.lon): r.zone and r.zone.zone_id for r in lookup.assign(points, False).collect()}
    assert strict == cases
    loose = {(r.lat, r.lon): r.zone.zone_id for r in lookup.assign(points, True).collect()}
    assert loose[(0.045, 0.045)] == 1 and loose[(0.19, 0.19)] == 2


def test_box_has_a_margin(spark, load):
    lookup = gps.ZoneLookup(load([feature({"name": "a"}, "Polygon", [box(0, 0, 0.1, 0.1)])]))
    points = spark.createDataFrame([(-0.0099, 0.0), (0.1099, 0.1), (0.1101, 0.1), (0.05, -0.02)], "lat double, lon double")
    assert points.filter(lookup.inside_box(points)).count() == 2


@pytest.mark.parametrize("seed", [1, 2])
def test_lookup_equals_brute_force(spark, load, seed):
    rng = random.Random(seed)
    shapes = [[[star(rng.uniform(0.02, 0.2), rng.uniform(0.02, 0.2), rng.randint(4, 25), rng)]] for _ in range(12)]
    shapes[3].append([star(0.1, 0.1, 9, rng)])
    zones = load([feature({"name": f"z{i}"}, "MultiPolygon", s) for i, s in enumerate(shapes)])
    lookup = gps.ZoneLookup(zones)
    vertices = [tuple(p) for s in shapes for poly in s for ring in poly for p in ring]
    inside = [(x, y) for x, y in vertices if 0 <= x <= 0.22 and 0 <= y <= 0.22][:60]
    points = [(rng.uniform(0, 0.22), rng.uniform(0, 0.22)) for _ in range(1500)] + inside
    df = spark.createDataFrame([(i, y, x) for i, (x, y) in enumerate(points)], "i int, lat double, lon double")
    df = df.filter(lookup.inside_box(df))
    got = {r.i: (r.seq, r.fallback) for r in lookup.assign(df, False).select(
        "i", F.col("zone.zone_id").alias("seq"), F.lit(0).alias("fallback")).collect()}
    assert len(got) > 1000
    assert {i: s for i, (s, _) in got.items()} == {i: first_zone(*points[i], shapes) for i in got}
    centres = {r.seq: (r.centroid_lon, r.centroid_lat) for r in zones.collect()}
    for r in lookup.assign(df, True).collect():
        want = first_zone(*points[r.i], shapes)
        if want is None:
            x, y = points[r.i]
            want = min(centres, key=lambda s: ((x - centres[s][0]) ** 2 + (y - centres[s][1]) ** 2, s))
        assert r.zone.zone_id == want
