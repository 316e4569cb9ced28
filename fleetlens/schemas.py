"""Explicit schemas of every source; nothing is inferred in production paths."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Raw trip file: every column is text, POLYLINE holds "[[lon,lat],...]".
RAW_TRIP = _strings("TRIP_ID", "CALL_TYPE", "TAXI_ID", "TIMESTAMP", "DAY_TYPE", "POLYLINE")

# Trips with parsed trajectories.
TRAJECTORY_TRIP = T.StructType([
    T.StructField("trip_id", T.LongType()),
    T.StructField("origin_zone", T.IntegerType()),
    T.StructField("destination_zone", T.IntegerType()),
    T.StructField("timestamp", T.IntegerType()),
    T.StructField("CALL_TYPE", T.StringType()),
    T.StructField("TAXI_ID", T.IntegerType()),
    T.StructField("DAY_TYPE", T.StringType()),
    T.StructField("polyline", T.ArrayType(T.ArrayType(T.DoubleType()))),
])

# Ride-hail trip records.
RIDE_HAIL_TRIP = T.StructType([
    T.StructField("tpep_pickup_datetime", T.TimestampType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampType()),
    T.StructField("PULocationID", T.IntegerType()),
])

# GPS event: producers disagree on names and types, so values are read as text and cast later.
GPS_EVENT = _strings(
    "event_id", "event_type", "taxi_id", "vehicle_id", "trip_id", "point_index",
    "timestamp_utc", "timestamp", "lat", "latitude", "lon", "longitude", "speed", "status",
    "origin_zone", "destination_zone", "call_type", "day_type", "anomaly_type", "simulation",
)

_POINT = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])

# Trip request, with the fields of injected anomalies.
TRIP_REQUEST = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("rider_id", T.StringType()),
    T.StructField("origin_zone", T.IntegerType()),
    T.StructField("destination_zone", T.IntegerType()),
    T.StructField("requested_at", T.TimestampType()),
    T.StructField("timestamp_utc", T.TimestampType()),
    T.StructField("call_type", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("dataset_trip_id", T.LongType()),
    T.StructField("taxi_id", T.LongType()),
    T.StructField("day_type", T.StringType()),
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("passenger_count", T.IntegerType()),
    T.StructField("origin", _POINT),
    T.StructField("destination", _POINT),
    T.StructField("estimated_distance_km", T.DoubleType()),
    T.StructField("estimated_duration_min", T.DoubleType()),
    T.StructField("estimated_fare_mad", T.DoubleType()),
    T.StructField("payment_type", T.StringType()),
    T.StructField("num_gps_points", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("demand_multiplier", T.DoubleType()),
    T.StructField("anomaly_type", T.StringType()),
    T.StructField("injected", T.BooleanType()),
    T.StructField("simulation", T.BooleanType()),
])

# Status update of a trip.
TRIP_STATUS = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("trip_id", T.StringType()),
    T.StructField("rider_id", T.StringType()),
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("origin_zone", T.IntegerType()),
    T.StructField("destination_zone", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("timestamp_utc", T.TimestampType()),
])

# GeoJSON: coordinates stay text because Polygon and MultiPolygon nest to different depths.
GEO_FEATURE = T.StructType([
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.StringType()),
    ])),
])
GEO_COLLECTION = T.StructType([T.StructField("features", T.ArrayType(GEO_FEATURE))])

# Forecast request.
FORECAST_REQUEST = T.StructType([
    T.StructField("zone_id", T.IntegerType()),
    T.StructField("datetime", T.StringType()),
])
