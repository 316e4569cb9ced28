"""Geographic column expressions. All stay on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens import constants as K


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * K.EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.greatest(chord, F.lit(0.0)), F.lit(1.0))))


def speed_kmh(distance_km: Column, seconds: Column) -> Column:
    """Speed to one decimal; 0 where no time has passed."""
    return F.when(seconds > 0, F.round(distance_km / seconds * 3600, 1)).otherwise(F.lit(0.0))


def in_city_box(lat: Column, lon: Column) -> Column:
    """Inclusive test against the fixed city box."""
    return lat.between(K.LAT_MIN, K.LAT_MAX) & lon.between(K.LON_MIN, K.LON_MAX)


def _clamped_step(share: Column) -> Column:
    step = F.floor(share * K.GRID_SIDE)
    return F.greatest(F.lit(0), F.least(step, F.lit(K.GRID_SIDE - 1)))


def grid_zone(lat: Column, lon: Column) -> Column:
    """Zone 1..16 of the 4x4 grid; rows count from the north, points outside are clamped."""
    col = _clamped_step((lon - K.LON_MIN) / (K.LON_MAX - K.LON_MIN))
    row = _clamped_step((F.lit(K.LAT_MAX) - lat) / (K.LAT_MAX - K.LAT_MIN))
    return (row * K.GRID_SIDE + col + 1).cast("int")


def zone_neighbours(zone: Column) -> Column:
    """The up to 8 zones around a grid zone, as an array."""
    row, col = F.floor((zone - 1) / K.GRID_SIDE), (zone - 1) % K.GRID_SIDE
    around = [
        F.when(
            (row + dr).between(0, K.GRID_SIDE - 1) & (col + dc).between(0, K.GRID_SIDE - 1),
            ((row + dr) * K.GRID_SIDE + col + dc + 1).cast("int"),
        )
        for dr in (-1, 0, 1) for dc in (-1, 0, 1) if (dr, dc) != (0, 0)
    ]
    return F.array_compact(F.array(*around))


def zone_point_lat(zone: Column) -> Column:
    """Representative latitude of a numbered zone."""
    return F.lit(33.5) + zone * F.lit(0.01)


def zone_point_lon(zone: Column) -> Column:
    """Representative longitude of a numbered zone."""
    return F.lit(-7.6) + zone * F.lit(0.01)


def cell(value: Column, size: float) -> Column:
    """Index of the square cell a coordinate falls into."""
    return F.floor(value / F.lit(size))


def grid_key(lat: Column, lon: Column, size: float = 0.005) -> Column:
    """Readable id of the square cell of a point."""
    return F.concat_ws("_", F.lit("g"), cell(lat, size).cast("string"), cell(lon, size).cast("string"))


def crosses_ray(edge: Column, lat: Column, lon: Column) -> Column:
    """True if the ray from the point towards growing longitude crosses the edge.

    An edge is a struct (x, y, px, py): a vertex and the vertex before it.
    """
    straddles = (edge.y > lat) != (edge.py > lat)
    at = (edge.px - edge.x) * (lat - edge.y) / F.nullif(edge.py - edge.y, F.lit(0.0)) + edge.x
    return straddles & (lon < at)


def inside_ring(edges: Column, lat: Column, lon: Column) -> Column:
    """Even-odd rule over the edges of a ring."""
    return F.size(F.filter(edges, lambda e: crosses_ray(e, lat, lon))) % 2 == 1


def ring_edges(ring: Column) -> Column:
    """Edges of a closed ring given as array of [lon, lat]; rings below 3 points have none."""
    before = F.concat(F.slice(ring, -1, 1), F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0))))
    edges = F.zip_with(ring, before, lambda p, q: F.struct(
        p[0].alias("x"), p[1].alias("y"), q[0].alias("px"), q[1].alias("py")))
    return F.filter(edges, lambda _: F.size(ring) >= 3)


def rescale(value: Column, lo: float, hi: float, new_lo: float, new_hi: float) -> Column:
    """Linear map of [lo, hi] onto [new_lo, new_hi]."""
    return F.lit(new_lo) + (value - lo) / (hi - lo) * (new_hi - new_lo)
