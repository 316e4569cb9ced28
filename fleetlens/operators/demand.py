"""Demand and supply per zone and window, spikes, slot series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions.timing import slot_index, slot_text


def demand_supply(
    positions: DataFrame, requests: DataFrame, window: str = K.DEMAND_WINDOW, watermark: str | None = None,
) -> DataFrame:
    """Per (zone, tumbling window): distinct active vehicles, pending requests and their ratio.

    ``positions``: zone_id, event_time, taxi_id. ``requests``: zone_id, event_time, status. Both sides
    become one table first; a first grouping per taxi removes repeated pings before the zone totals, so
    a busy zone never meets in one task as raw rows. Streams may come without watermarks and get one here, after
    the union, so that a silent side holds nothing back.
    """
    seen = positions.select("zone_id", "event_time", "taxi_id", F.lit(0).alias("pending"))
    asked = requests.select(
        "zone_id", "event_time", F.lit(None).cast(positions.schema["taxi_id"].dataType).alias("taxi_id"),
        (F.col("status") == "requested").cast("int").alias("pending"))
    both = seen.unionByName(asked)
    per_taxi = (
        (both.withWatermark("event_time", watermark) if watermark else both)
        .groupBy("zone_id", F.window("event_time", window).alias("w"), "taxi_id")
        .agg(F.sum("pending").alias("pending")))
    totals = per_taxi.groupBy("zone_id", "w").agg(
        F.count("taxi_id").alias("active_vehicles"), F.sum("pending").alias("pending_requests"))
    return totals.select(
        "zone_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "active_vehicles", "pending_requests", ratio())


def ratio():
    return F.try_divide(F.col("pending_requests").cast("double"), F.col("active_vehicles")).alias("ratio")


def demand_spikes(
    requests: DataFrame, window_seconds: int = 300, history: int = 24, factor: float = K.SPIKE_FACTOR,
    least: int = 2,
) -> DataFrame:
    """Windows with at least ``least`` requests and ``factor`` times the mean of the windows before.

    The mean is over the ``history`` windows before, as far as the zone's series reaches back; windows without
    requests count as 0 in it. The series is aggregated before it is ordered.
    """
    counts = requests.groupBy(
        "zone_id", slot_index(F.unix_timestamp("event_time"), window_seconds).alias("slot")
    ).agg(F.count(F.lit(1)).alias("requests"))
    before = Window.partitionBy("zone_id").orderBy("slot").rangeBetween(-history, -1)
    first = F.min("slot").over(Window.partitionBy("zone_id"))
    windows = F.least(F.lit(history), F.col("slot") - first)
    rated = counts.withColumn("usual", F.try_divide(F.coalesce(F.sum("requests").over(before), F.lit(0)), windows))
    enough = (F.col("requests") >= factor * F.col("usual")) & (F.col("requests") >= least)
    return rated.filter((F.col("usual") > 0) & enough).select(
        "zone_id", F.timestamp_seconds(F.col("slot") * window_seconds).alias("window_start"),
        "requests", "usual")


def demand_slots(trips: DataFrame, epoch: str = "TIMESTAMP") -> DataFrame:
    """Trips per (zone, 30-minute slot): zone_id, slot (index), slot_30min (text), demand."""
    return (
        trips.groupBy("zone_id", slot_index(F.col(epoch)).alias("slot"))
        .agg(F.count(F.lit(1)).alias("demand"))
        .withColumn("slot_30min", slot_text(F.col("slot"))))
