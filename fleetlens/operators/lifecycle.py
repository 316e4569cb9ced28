"""Trip states over time and GPS blackouts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.operators.ordered import Running, running

STAGES = ["requested", "accepted", "in_progress", "completed"]
BLOCK_SECONDS = 600


def _seconds(start: str, end: str):
    return (F.unix_timestamp(end) - F.unix_timestamp(start))


def stage_times(updates: DataFrame) -> DataFrame:
    """Per trip: newest status and the first time of each stage. Applies to its own output again, so
    stored rows and new updates can be merged.

    ``updates``: trip_id, status, timestamp_utc. At equal times the later stage counts as newer. Only
    mergeable aggregates are used, so a trip with very many updates is reduced before the shuffle.
    """
    rank = F.array_position(F.array(*[F.lit(s) for s in STAGES]), F.col("status"))
    known = {
        f"{s}_at": F.col(f"{s}_at") if f"{s}_at" in updates.columns
        else F.when(F.col("status") == s, F.col("timestamp_utc")) for s in STAGES}
    per_trip = updates.groupBy("trip_id").agg(
        F.max(F.struct("timestamp_utc", rank.alias("stage"), "status")).alias("newest"),
        *[F.min(at).alias(name) for name, at in known.items()])
    return per_trip.select("trip_id", "newest.status", "newest.timestamp_utc", *known)


def trip_lifecycle(updates: DataFrame) -> DataFrame:
    """Per trip: latest status, first time of each stage, seconds between the stages."""
    return stage_times(updates).withColumnRenamed("timestamp_utc", "updated_at").withColumns({
        "wait_sec": _seconds("requested_at", "accepted_at"),
        "pickup_sec": _seconds("accepted_at", "in_progress_at"),
        "ride_sec": _seconds("in_progress_at", "completed_at"),
    })


def blackouts(events: DataFrame, alert_seconds: int = K.BLACKOUT_ALERT_SECONDS) -> DataFrame:
    """Periods in which a vehicle reports ``blackout``, with the ping that ended them.

    ``events``: taxi_id, event_id, event_time, status; raw events, because blackout pings carry no
    position. ``alert`` is set where the period, up to recovery or the last blackout ping, exceeds the limit.
    """
    dark = F.col("status") == "blackout"
    moment = F.struct("event_time", "event_id")
    stamped = events.select("taxi_id", "event_id", "event_time", "status").withColumn("__at", moment)
    seen_at = F.when(~dark, F.col("__at"))
    both = running(
        stamped, ["taxi_id"], ["event_time", "event_id"],
        F.floor(F.unix_timestamp("event_time") / BLOCK_SECONDS),
        {"ok_before": Running("max", seen_at), "ok_after": Running("min", seen_at, backwards=True)})
    islands = both.filter(dark).groupBy("taxi_id", "ok_before", "ok_after").agg(
        F.min("event_time").alias("started_at"), F.max("event_time").alias("last_seen_at"),
        F.count(F.lit(1)).alias("pings"))
    length = F.unix_timestamp(F.coalesce("ok_after.event_time", "last_seen_at")) - F.unix_timestamp("started_at")
    return islands.select(
        "taxi_id", "started_at", "last_seen_at", F.col("ok_after.event_time").alias("recovered_at"),
        "pings", length.alias("seconds"), (length > alert_seconds).alias("alert"))


def blackout_sessions(events: DataFrame, gap: str = "3 minutes", alert_seconds: int = K.BLACKOUT_ALERT_SECONDS) -> DataFrame:
    """Runs of blackout pings of a vehicle with no pause of ``gap``; works on streams with a watermark."""
    runs = events.filter(F.col("status") == "blackout").groupBy(
        "taxi_id", F.session_window("event_time", gap).alias("w")
    ).agg(F.count(F.lit(1)).alias("pings"), F.max("event_time").alias("last_seen_at"))
    length = F.unix_timestamp("last_seen_at") - F.unix_timestamp("w.start")
    return runs.select(
        "taxi_id", F.col("w.start").alias("started_at"), "last_seen_at", "pings",
        length.alias("seconds"), (length > alert_seconds).alias("alert"))
