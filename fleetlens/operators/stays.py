"""Stay points: stretches of a trip that remain near the point they began with, for long enough.

The point that ends a stay may lie any number of blocks ahead. Each block is summed up by the convex hull of its points,
and hulls of neighbours are merged into a tree, so an open anchor skips in one look all blocks that stay near it and finds
the end in steps that grow with the logarithm of the distance. Where one stay ends the search goes on, which makes a trip a
chain; it is followed from block to block in pairs, like the chain of ``thinning``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions import geo
from fleetlens.session import materialize

POINTS_PER_BLOCK = 256
BLOCKS_IN_STEP = 1024  # blocks of a batch that are searched together


def _km(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    a, b = np.radians(lat1), np.radians(lat2)
    h = np.sin((b - a) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * K.EARTH_RADIUS_KM * np.arcsin(np.sqrt(np.minimum(h, 1.0)))


def hull(lat: np.ndarray, lon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The corners of the convex hull of the points that have a position."""
    known = ~(np.isnan(lat) | np.isnan(lon))
    places = np.unique(np.stack([lat[known], lon[known]], 1), axis=0)
    if len(places) < 3:
        return places[:, 0], places[:, 1]
    corners: list[np.ndarray] = []
    for run in (places, places[::-1]):
        side: list[np.ndarray] = []
        for p in run:
            while len(side) > 1 and np.linalg.det(np.stack([side[-1] - side[-2], p - side[-2]])) <= 0:
                side.pop()
            side.append(p)
        corners += side[:-1]
    out = np.array(corners)
    return out[:, 0], out[:, 1]


def _ends(lat: np.ndarray, lon: np.ndarray, sizes: np.ndarray, radius_km: float) -> np.ndarray:
    """For each point the first later one in its block that is too far from it; -1 if there is none. Blocks follow each other."""
    start, limit = np.repeat(np.cumsum(sizes) - sizes, sizes), np.repeat(np.cumsum(sizes), sizes)
    end = np.full(len(lat), -1)
    open_, step = np.flatnonzero(~np.isnan(lat)), 1
    while len(open_):
        open_ = open_[open_ + step < limit[open_]]
        far = _km(lat[open_], lon[open_], lat[open_ + step], lon[open_ + step]) > radius_km
        end[open_[far]] = open_[far] + step - start[open_[far]]
        open_, step = open_[~far], step + 1
    return end


def _flat(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Blocks that are searched together, with their numbers of points."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCKS_IN_STEP):
            part = batch.slice(at, BLOCKS_IN_STEP)
            yield part, np.diff(part["lats"].offsets.to_numpy())


def _short_walk(ends: np.ndarray, lat: np.ndarray, sizes: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block, first and last point of the stays of trips of a single block, all trips a step at a time."""
    start, length = np.cumsum(sizes) - sizes, np.repeat(sizes, sizes)
    at = np.arange(len(ends)) - np.repeat(start, sizes)
    end = np.where(ends >= 0, ends, length)
    nexts = np.where((end - at > need) & ~np.isnan(lat), end, at + 1)
    found = [np.zeros((3, 0), int)]
    open_, here = np.flatnonzero(sizes > 0), np.zeros(np.count_nonzero(sizes > 0), int)
    while len(open_):
        to = nexts[start[open_] + here]
        stay = to - here > 1
        found.append(np.stack([open_[stay], here[stay], to[stay] - 1]))
        on = to < sizes[open_]
        open_, here = open_[on], to[on]
    block, first, last = np.concatenate(found, axis=1)
    return block, first, last


def _first_far(y: np.ndarray, x: np.ndarray, lat: np.ndarray, lon: np.ndarray, radius_km: float) -> np.ndarray:
    """For each place (y, x) the first of the points that is too far from it; at least one is."""
    found, open_ = np.zeros(len(y), int), np.arange(len(y))
    for k in range(len(lat)):
        far = _km(y[open_], x[open_], lat[k], lon[k]) > radius_km
        found[open_[far]] = k
        open_ = open_[~far]
        if not len(open_):
            break
    return found


def _tree(blocks: DataFrame, key: str) -> DataFrame:
    """trip_id, level, node, lats, lons: corners of the hull of the 2^level blocks from node * 2^level on."""
    def hulls(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            corners = [hull(np.asarray(a, float), np.asarray(b, float)) for a, b in zip(f["lats"], f["lons"])]
            yield f[["trip_id", "node"]].assign(lats=[c[0] for c in corners], lons=[c[1] for c in corners])

    schema = f"trip_id {key}, node long, lats array<double>, lons array<double>"
    level, most = 0, blocks.agg(F.max("block")).first()[0] or 0
    at = materialize(blocks.select("trip_id", F.col("block").alias("node"), "lats", "lons").mapInPandas(hulls, schema), "stays-hulls")
    tree = at.withColumn("level", F.lit(level))
    while most >> level:
        level += 1
        pairs = at.groupBy("trip_id", F.floor(F.col("node") / 2).alias("node")).agg(
            F.flatten(F.collect_list(F.arrays_zip("lats", "lons"))).alias("c"))
        at = materialize(pairs.select("trip_id", "node", F.col("c.lats").alias("lats"), F.col("c.lons").alias("lons"))
                         .mapInPandas(hulls, schema), "stays-hulls")
        tree = tree.unionByName(at.withColumn("level", F.lit(level)))
    return tree


def _far_ends(blocks: DataFrame, key: str, radius_km: float, size: int) -> DataFrame:
    """trip_id, block, at, end for points of long trips with no end in their block; the trip's length ends all that is left.

    Points without a position end at the next one.
    """
    some = F.exists(F.arrays_zip(F.col("lats").alias("y"), F.col("lons").alias("x")), lambda p: geo.haversine_km(
        F.col("lat"), F.col("lon"), p["y"], p["x"]) > radius_km)

    def ended(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for trip, block, node, at, y, x, lat, lon in zip(*(f[c] for c in ("trip_id", "block", "node", "at", "y", "x", "lats", "lons"))):
                yield pd.DataFrame({"trip_id": trip, "block": block, "at": at, "end": node * size + _first_far(y, x, lat, lon, radius_km)})

    tree = _tree(blocks, key)
    lengths = blocks.groupBy("trip_id").agg(F.max(F.col("block") * size + F.size("lats")).alias("length"))
    points = blocks.select("trip_id", "block", F.posexplode(F.arrays_zip("lats", "lons", "ends")).alias("i", "p")).select(
        "trip_id", "block", (F.col("block") * size + F.col("i")).alias("at"), F.col("p.lats").alias("lat"),
        F.col("p.lons").alias("lon"), F.col("p.ends").alias("end"))
    start = F.col("block") + 1
    odd = F.col("node") % 2 == 1
    looking = points.filter("end < 0 AND NOT isnan(lat)").select(
        "trip_id", "block", "at", "lat", "lon", F.lit(0).alias("level"), start.alias("node"))
    looking, found, last = materialize(looking, "stays-open"), [], []
    while not looking.isEmpty():
        seen = looking.join(tree, ["trip_id", "level", "node"], "left").withColumns({
            "past": F.col("lats").isNull(), "some": some}).drop("lats", "lons")
        seen = materialize(seen, "stays-open")
        last.append(seen.filter("past"))
        found.append(seen.filter("NOT past AND some AND level = 0"))
        down = seen.filter("NOT past AND some AND level > 0").withColumns({"level": F.col("level") - 1, "node": F.col("node") * 2})
        # past a left child its sibling is looked at, past a right one the node that follows their parent
        on = seen.filter("NOT past AND NOT some").withColumns({
            "level": F.when(odd, F.col("level") + 1).otherwise(F.col("level")),
            "node": F.when(odd, F.floor(F.col("node") / 2) + 1).otherwise(F.col("node") + 1)})
        looking = down.unionByName(on).drop("past", "some")
    ends = points.filter("end < 0 AND isnan(lat)").select("trip_id", "block", "at", (F.col("at") + 1).alias("end"))
    if found:
        open_ = reduce(DataFrame.unionByName, found).groupBy("trip_id", "block", "node").agg(
            F.collect_list("at").alias("at"), F.collect_list("lat").alias("y"), F.collect_list("lon").alias("x"))
        where = open_.join(blocks.select("trip_id", F.col("block").alias("node"), "lats", "lons"), ["trip_id", "node"])
        ends = ends.unionByName(where.mapInPandas(ended, f"trip_id {key}, block long, at long, end long"))
        left = reduce(DataFrame.unionByName, last).join(lengths, "trip_id")
        ends = ends.unionByName(left.select("trip_id", "block", "at", F.col("length").alias("end")))
    return ends


def _nexts(ends: np.ndarray, lat: np.ndarray, block: int, size: int, need: int, opened: list | None) -> np.ndarray:
    """Where the search goes on after each point of a block: past its stay, or at the next point."""
    at = block * size + np.arange(len(ends))
    end = np.where(ends >= 0, ends + block * size, at[-1] + 1)
    for row in [] if opened is None else opened:
        end[row["at"] - block * size] = row["end"]
    return np.where((end - at > need) & ~np.isnan(lat), end, at + 1)


def _exits(nexts: np.ndarray, start: int, entries: np.ndarray) -> np.ndarray:
    """Where the search leaves a block that it enters at each of ``entries``."""
    past = start + len(nexts)
    anchors = np.flatnonzero(nexts - np.arange(start, past) > 1) + start
    out = np.full(len(anchors) + 1, past)
    for k in range(len(anchors) - 1, -1, -1):
        to = nexts[anchors[k] - start]
        out[k] = to if to >= past else out[np.searchsorted(anchors, to)]
    return out[np.searchsorted(anchors, entries)]


def _walk(nexts: np.ndarray, start: int, entry: int) -> list[tuple[int, int]]:
    """First and last point of the stays in a block that is entered at ``entry``."""
    anchors = np.flatnonzero(nexts - np.arange(start, start + len(nexts)) > 1) + start
    found, k = [], np.searchsorted(anchors, entry)
    while k < len(anchors):
        to = int(nexts[anchors[k] - start])
        found.append((int(anchors[k]), to - 1))
        k = np.searchsorted(anchors, to)
    return found


def _entries(blocks: DataFrame, key: str, size: int) -> DataFrame:
    """trip_id, block, entry: where the search enters the blocks of long trips; at most once each, since it only goes on."""
    def exits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            to = [_exits(n, b * size, np.asarray(e)) for n, b, e in zip(f["nexts"], f["block"], f["entries"])]
            yield pd.DataFrame({
                "trip_id": f["trip_id"].repeat(f["entries"].map(len)).to_numpy(),
                "entry": np.concatenate([*f["entries"], np.zeros(0, int)]), "exit": np.concatenate([*to, np.zeros(0, int)])})

    start = F.col("block") * size
    jumps = blocks.select("trip_id", "block", F.explode("nexts").alias("entry")).filter(F.col("entry") >= start + size)
    entries = jumps.select("trip_id", "entry").unionByName(blocks.select("trip_id", start.alias("entry"))).distinct()
    by_block = entries.groupBy("trip_id", F.floor(F.col("entry") / size).alias("block")).agg(F.collect_list("entry").alias("entries"))
    maps = materialize(blocks.join(by_block, ["trip_id", "block"]).select("trip_id", "block", "nexts", "entries")
                       .mapInPandas(exits, f"trip_id {key}, entry long, exit long"), "stays-maps")
    reached = materialize(blocks.filter("block = 0").select("trip_id", F.lit(0).cast("long").alias("entry")), "stays-entries")
    most, span = blocks.agg(F.max("block")).first()[0], 1
    while span <= most:
        on = reached.join(maps, ["trip_id", "entry"]).select("trip_id", F.col("exit").alias("entry"))
        reached = materialize(reached.unionByName(on), "stays-entries")
        then = maps.select("trip_id", F.col("entry").alias("exit"), F.col("exit").alias("to"))
        maps = materialize(maps.join(then, ["trip_id", "exit"]).select("trip_id", "entry", F.col("to").alias("exit")), "stays-maps")
        span *= 2
    return reached.select("trip_id", F.floor(F.col("entry") / size).alias("block"), "entry")


def stays(points: DataFrame, radius_km: float = 0.1, min_seconds: int = 300,
          seconds: int = K.GPS_INTERVAL_SECONDS) -> DataFrame:
    """trip_id, first_index, last_index, seconds, lat, lon: where a trip remains near a point for long enough.

    From a point on, a stay lasts until the first point more than ``radius_km`` away. If at least ``min_seconds`` pass
    between its first and last point it counts and the search goes on after it, else at the next point. lat and lon are those of
    the first point. ``points``: trip_id, point_index, lat, lon; the index counts from 0 without gaps, points are ``seconds``
    apart. Points without a position neither begin nor end a stay. The radius is to be small against the distance
    to the poles and the 180th meridian, so that the farthest of many points is a corner of their hull.
    """
    size, need = POINTS_PER_BLOCK, max(1, -(-min_seconds // seconds))
    key = dict(points.select("trip_id").dtypes)["trip_id"]
    known = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    place = F.struct("point_index", *[F.when(known, F.col(c)).otherwise(F.lit(float("nan"))).alias(c) for c in ("lat", "lon")])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sizes in _steps(batches):
            ends = _ends(_flat(part["lats"]), _flat(part["lons"]), sizes, radius_km)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(offsets, pa.array(ends, pa.int64()))],
                                             [*part.schema.names, "ends"])

    def walked_short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sizes in _steps(batches):
            lat, lon = _flat(part["lats"]), _flat(part["lons"])
            row, first, last = _short_walk(_flat(part["ends"]), lat, sizes, need)
            place = (np.cumsum(sizes) - sizes)[row] + first
            yield pa.RecordBatch.from_arrays(
                [part["trip_id"].take(pa.array(row)), *map(pa.array, (first, last, (last - first) * seconds, lat[place], lon[place]))],
                ["trip_id", "first_index", "last_index", "seconds", "lat", "lon"])

    def following(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = zip(f["ends"], f["lats"], f["block"], f["opened"])
            yield f[["trip_id", "block", "lats", "lons"]].assign(nexts=[_nexts(e, a, b, size, need, o) for e, a, b, o in rows])

    def walked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(trip, first, last, (last - first) * seconds, a[first - b * size], o[first - b * size])
                    for trip, b, a, o, n, e in zip(*(f[c] for c in ("trip_id", "block", "lats", "lons", "nexts", "entry")))
                    for first, last in _walk(n, b * size, e)]
            yield pd.DataFrame(rows, columns=["trip_id", "first_index", "last_index", "seconds", "lat", "lon"])

    block = f"trip_id {key}, block long, lats array<double>, lons array<double>"
    blocks = points.groupBy("trip_id", F.floor(F.col("point_index") / size).alias("block")).agg(
        F.sort_array(F.collect_list(place)).alias("p"))
    blocks = materialize(blocks.select("trip_id", "block", F.col("p.lat").alias("lats"), F.col("p.lon").alias("lons"))
                         .mapInArrow(near, f"{block}, ends array<long>"), "stays-blocks")
    stay = f"trip_id {key}, first_index long, last_index long, seconds long, lat double, lon double"
    trips = blocks.filter("block > 0").select("trip_id").distinct()
    if trips.isEmpty():
        return blocks.mapInArrow(walked_short, stay)
    short = blocks.join(trips, "trip_id", "left_anti").filter("block = 0").mapInArrow(walked_short, stay)
    long = blocks.join(trips, "trip_id", "left_semi")
    ends = _far_ends(long, key, radius_km, size).groupBy("trip_id", "block").agg(
        F.collect_list(F.struct("at", "end")).alias("opened"))
    ready = materialize(long.join(ends, ["trip_id", "block"], "left").mapInPandas(following, f"{block}, nexts array<long>"), "stays-nexts")
    first = ready.filter("block = 0").withColumn("entry", F.lit(0).cast("long"))
    entries = _entries(ready, key, size).filter("block > 0")
    first = first.unionByName(ready.join(entries, ["trip_id", "block"]).select(*first.columns))
    return short.unionByName(first.mapInPandas(walked, stay))
