"""Zone and hour KPIs on curated trips and ride-hail records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.trips import minutes_between


def trips_per_zone(trips: DataFrame) -> DataFrame:
    return trips.groupBy("zone_id").agg(F.count(F.lit(1)).alias("trips")).orderBy("zone_id")


def average_minutes(trips: DataFrame) -> DataFrame:
    return trips.agg((F.avg("trip_duration_sec") / 60).alias("avg_minutes"))


def peak_hours(records: DataFrame, pickup: str = "tpep_pickup_datetime", name: str = "demand") -> DataFrame:
    """Trips per hour of day, busiest first."""
    return (
        records.groupBy(F.hour(pickup).alias("hour"))
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.desc(name), "hour"))


def zone_summary(trips: DataFrame) -> DataFrame:
    """Trips and mean duration in seconds per zone."""
    return trips.groupBy("zone_id").agg(
        F.count(F.lit(1)).alias("trips"), F.avg("trip_duration_sec").alias("avg_duration"))


def pickup_zone_demand(records: DataFrame) -> DataFrame:
    """Trips and mean minutes per pickup zone."""
    minutes = minutes_between(F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime"))
    return records.groupBy("PULocationID").agg(
        F.count(F.lit(1)).alias("trip_count"), F.avg(minutes).alias("avg_duration_min"))


def coverage_gap_const(trips: DataFrame, vehicles: int = 1, minimum: int = 2) -> DataFrame:
    """Zones with demand where a supply that is the same everywhere stays below the minimum."""
    demand = trips.groupBy("zone_id").agg(F.count(F.lit(1)).alias("demand"))
    return demand.withColumn("vehicles", F.lit(vehicles)).filter(F.col("vehicles") < minimum)


def coverage_gap(demand: DataFrame, positions: DataFrame, keys=("zone_id",), minimum: int = 2) -> DataFrame:
    """Groups with demand served by fewer than ``minimum`` distinct vehicles.

    ``demand`` and ``positions`` hold the key columns; ``positions`` also taxi_id and status. Both sides
    are aggregated before they meet, so the join sees one row per key.
    """
    keys = list(keys)
    wanted = demand.groupBy(*keys).agg(F.count(F.lit(1)).alias("demand"))
    active = (
        positions.filter(F.col("status") != "blackout")
        .groupBy(*keys, "taxi_id").agg(F.lit(1).alias("seen"))
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("vehicles")))
    return (
        wanted.join(active, keys, "left")
        .withColumn("vehicles", F.coalesce("vehicles", F.lit(0)))
        .filter(F.col("vehicles") < minimum))
