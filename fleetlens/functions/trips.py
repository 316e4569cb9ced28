"""Trip column expressions: duration, zones, distance, fare."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions.geo import haversine_km
from fleetlens.functions.text import stable_number

POLYLINE_TYPE = "array<array<double>>"


def duration_from_text(polyline: Column) -> Column:
    """Seconds at 15 s per point, counting the points in the text."""
    return F.size(F.split(polyline, r"\],\[")) * K.GPS_INTERVAL_SECONDS


def parse_polyline(polyline: Column) -> Column:
    return F.from_json(polyline, POLYLINE_TYPE)


def duration_from_points(points: Column) -> Column:
    """Seconds at 15 s per parsed point."""
    return F.size(points) * K.GPS_INTERVAL_SECONDS


def hash_zone(trip_id: Column) -> Column:
    """Zone 1..16 from Spark's hash of the id; widened first, since abs of the lowest int overflows."""
    return (F.abs(F.hash(trip_id).cast("bigint")) % K.N_ZONES + 1).cast("int")


def key_zone(key: Column) -> Column:
    """Zone 1..16 straight from a numeric key."""
    return (key.cast("bigint") % K.N_ZONES + 1).cast("int")


def minutes_between(start: Column, end: Column) -> Column:
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / 60


def endpoint(points: Column, last: bool) -> Column:
    """First or last point as a struct (lat, lon)."""
    point = F.try_element_at(points, F.lit(-1 if last else 1))
    return F.struct(point[1].alias("lat"), point[0].alias("lon"))


def end_to_end_km(points: Column) -> Column:
    first, last = (F.try_element_at(points, F.lit(i)) for i in (1, -1))
    return haversine_km(first[1], first[0], last[1], last[0])


def estimated_minutes(distance_km: Column) -> Column:
    """Minutes at 25 km/h, at least 2; 5 where the distance is zero."""
    ride = F.greatest(F.lit(K.MIN_TRIP_MINUTES), distance_km / K.AVG_SPEED_KMH * 60)
    return F.when(distance_km > 0, ride).otherwise(K.ZERO_DISTANCE_MINUTES)


def base_fare(distance_km: Column) -> Column:
    return F.lit(K.BASE_FARE) + distance_km * K.PRICE_PER_KM


def quoted_fare(distance_km: Column, key: Column) -> Column:
    """Base fare with a factor in 0.90..1.10 that depends on the key only, to 2 decimals."""
    low, high = K.FARE_JITTER
    factor = F.lit(low) + stable_number(key, 1001) / 1000 * (high - low)
    return F.round(base_fare(distance_km) * factor, 2)
