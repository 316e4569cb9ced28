"""Stateful streams: demand windows, duplicates, trip states, blackouts, matching."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.operators import demand, lifecycle, match
from fleetlens.session import materialize
from fleetlens.streaming.io import as_messages

WATERMARK = f"{K.LATENESS_MS // 1000} seconds"


def watermarked(events: DataFrame, delay: str = WATERMARK) -> DataFrame:
    return events.withWatermark("event_time", delay)


def demand_stream(positions: DataFrame, requests: DataFrame, window: str = K.DEMAND_WINDOW) -> DataFrame:
    """Demand and supply per zone and window, each window once, when the watermark has passed it.

    Same steps as the batch form: state per (zone, window, taxi), then per (zone, window).
    """
    return demand.demand_supply(positions, requests, window, WATERMARK)


def demand_approx(events: DataFrame, window: str = K.DEMAND_WINDOW) -> DataFrame:
    """Demand and supply with a constant-size sketch of the vehicles instead of a row per vehicle.

    ``events``: zone_id, event_time, taxi_id (null for requests), pending (1 for pending requests).
    """
    totals = watermarked(events).groupBy("zone_id", F.window("event_time", window).alias("w")).agg(
        F.approx_count_distinct("taxi_id").alias("active_vehicles"), F.sum("pending").alias("pending_requests"))
    return totals.select(
        "zone_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "active_vehicles", "pending_requests", demand.ratio())


def without_repeats(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Drop repeated events as long as the watermark remembers them."""
    return watermarked(events).dropDuplicatesWithinWatermark([key])


def blackout_stream(events: DataFrame, gap: str = "3 minutes", delay: str = WATERMARK) -> DataFrame:
    """Blackout runs per vehicle, reported when they are over."""
    return lifecycle.blackout_sessions(watermarked(events, delay), gap)


@dataclass
class LifecycleLog:
    """Trip states as an append-only log: one reduced row per trip and batch.

    No trip stays in stream state for ever and no stored row is rewritten; a repeated batch replaces its
    own folder. ``trips`` reduces the log, ``compact`` stores the reduced form as the base of a new log.
    """

    path: str

    def write(self, batch: DataFrame, batch_id: int) -> None:
        lifecycle.stage_times(batch).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{self.path}/batch_id={batch_id}")

    def trips(self, spark: SparkSession) -> DataFrame:
        return lifecycle.stage_times(spark.read.parquet(self.path))

    def compact(self, spark: SparkSession, path: str) -> None:
        self.trips(spark).write.mode("overwrite").parquet(f"{path}/batch_id=-1")


@dataclass
class Matcher:
    """Trip matching per micro-batch, with open requests carried over.

    Pings go to a log by day, in time order. A request is matched with the pings of its time as soon as events
    ``wait`` seconds after it have been seen, and again with every batch until it is matched or events
    ``patience`` seconds after it have come; then it is reported without a taxi. Time is that of the newest event of
    all batches so far, so neither an old batch nor an empty one sets it back. Requests that wait or stay open, and
    the newest time, are kept in one folder per batch, results in another, so a repeated batch replaces its own.
    """

    log: str
    matches: str
    open: str
    fresh: int = match.FRESH_SECONDS
    wait: int = 0
    patience: int = match.FRESH_SECONDS

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """``batch``: event_id, taxi_id, event_time, lat, lon, zone_id, status, is_request."""
        batch.persist()
        try:
            self._write(batch, batch_id)
        finally:
            batch.unpersist()

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        pings = batch.filter(~F.col("is_request")).withColumns({
            "day": F.to_date("event_time"), "batch_id": F.lit(batch_id)})
        (pings.sortWithinPartitions("day", "event_time").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id").parquet(self.log))
        asked = batch.filter("is_request").select(
            F.col("event_id").alias("request_id"), "event_time", "lat", "lon", "zone_id")
        if batch_id > 0:
            asked = asked.unionByName(spark.read.schema(asked.schema).parquet(f"{self.open}/{batch_id - 1}"))
        seen = batch.select("event_time")
        if batch_id > 0:
            seen = seen.unionByName(spark.read.schema(seen.schema).parquet(f"{self.open}_clock/{batch_id - 1}"))
        newest = seen.agg(F.max("event_time")).first()[0]
        seen.agg(F.max("event_time").alias("event_time")).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").parquet(f"{self.open}_clock/{batch_id}")
        self._settle(asked, pings.schema, newest, batch_id)

    def _settle(self, asked: DataFrame, ping_schema, newest, batch_id: int, close: bool = False) -> None:
        """Match what is due at the time of the ``newest`` event seen; everything to ``close``."""
        spark = asked.sparkSession
        age = F.unix_timestamp(F.lit(newest)) - F.unix_timestamp("event_time")
        due = asked if close else asked.filter(age >= self.wait)
        first, last = due.agg(F.min("event_time"), F.max("event_time")).first()
        target = f"{self.matches}/batch_id={batch_id}"
        if first is None:
            self._keep(asked, batch_id)
            return
        early = F.lit(first) - F.make_interval(secs=F.lit(self.fresh))
        known = spark.read.schema(ping_schema).parquet(self.log).filter(
            F.col("day").between(F.to_date(early), F.to_date(F.lit(last)))
            & F.col("event_time").between(early, F.lit(last)))
        found = materialize(match.match_nearest(due, known, self.fresh), "found")
        unmatched = asked.join(match.bulk(found.filter("taxi_id IS NOT NULL")), "request_id", "left_anti")
        still = unmatched.limit(0) if close else unmatched.filter(age < self.patience + self.wait)
        self._keep(still, batch_id)
        opened = spark.read.schema(asked.schema).parquet(f"{self.open}/{batch_id}")
        settled = found.join(match.bulk(opened), "request_id", "left_anti")
        settled.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(target)

    def _keep(self, requests: DataFrame, batch_id: int) -> None:
        requests.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.open}/{batch_id}")

    def close(self, spark: SparkSession, last_batch: int) -> None:
        """Settle what is still open after the last batch of a replay."""
        pings = spark.read.parquet(self.log).schema
        asked = spark.read.parquet(f"{self.open}/{last_batch}")
        self._settle(asked, pings, None, last_batch + 1, close=True)

    def results(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.matches).drop("batch_id")

    def publish(self, spark: SparkSession) -> DataFrame:
        """The results as keyed messages for a topic sink."""
        return as_messages(self.results(spark), F.col("request_id"))
