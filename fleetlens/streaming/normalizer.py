"""The GPS stream: parse, normalise, judge lateness, write to two sinks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from fleetlens.operators import gps
from fleetlens.operators.lateness import IDLE_SECONDS, flag_late, flag_late_by_source, source_state
from fleetlens.session import small_side
from fleetlens.sources.serving import newest_per_key


def normalized_stream(messages: DataFrame, options: gps.NormalizeOptions = gps.POLYGON,
                      lookup: gps.ZoneLookup | None = None) -> DataFrame:
    """Stateless part; the same on batch tables and streams."""
    return gps.normalize(gps.parse_gps(messages), options, lookup)


@dataclass
class LateFilter:
    """Lateness across micro-batches.

    Inside a batch the running maximum is computed in blocks (see ``ordered``), so a busy source is not
    tied to one task. Between batches one number per source is kept in a small table under ``state``,
    one folder per batch, which makes a repeated batch see the same past. ``arrival`` orders the events within
    ``sources``, by default the partition of the topic; an empty list says that it orders all events.
    """

    state: str
    sources: list[str] = field(default_factory=lambda: ["source"])

    def _past(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        if batch_id == 0:
            return None
        try:
            return spark.read.parquet(f"{self.state}/{batch_id - 1}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            raise RuntimeError(f"lateness state of batch {batch_id - 1} is missing in {self.state}") from missing

    def apply(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Flag late rows of a batch and store the newest event time seen so far."""
        past = self._past(batch.sparkSession, batch_id)
        newest = batch.groupBy(*self.sources).agg(F.max(F.unix_millis("event_time")).alias("seen_ms"))
        events = batch
        if past is not None:
            newest = newest.unionByName(past).groupBy(*self.sources).agg(F.max("seen_ms").alias("seen_ms"))
            if self.sources:
                events = batch.join(small_side(past), self.sources, "left")
            else:
                events = batch.withColumn("seen_ms", past.select("seen_ms").scalar())
        newest.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{self.state}/{batch_id}")
        if past is None:
            return flag_late(events, sources=self.sources)
        return flag_late(events, sources=self.sources, carried=F.col("seen_ms")).drop("seen_ms")


@dataclass
class SourceWatermark:
    """Lateness across micro-batches under one watermark over several sources (see ``flag_late_by_source``).

    A row per source is kept under ``state``, in one folder per batch, so a repeated batch sees the same past.
    """

    state: str
    idle_seconds: int = IDLE_SECONDS

    def apply(self, batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        past = spark.read.parquet(f"{self.state}/{batch_id - 1}") if batch_id else None
        judged = flag_late_by_source(batch, idle_seconds=self.idle_seconds, past=past)
        source_state(judged, past=past).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").parquet(f"{self.state}/{batch_id}")
        return judged


@dataclass
class GpsSinks:
    """Targets of one micro-batch below ``root``: judged events and vehicle positions.

    Both are append-only with one folder per batch, so nothing is read back and rewritten, and a repeated
    batch replaces exactly its own rows.
    """

    root: str
    late_filter: LateFilter

    def write(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        judged = f"{self.root}/judged/batch_id={batch_id}"
        batch.persist()
        try:
            flagged = self.late_filter.apply(batch, batch_id)
            by_lateness = flagged.withColumn("late", F.col("is_late").cast("int")).drop("is_late")
            (by_lateness.write.mode("overwrite").option("partitionOverwriteMode", "static")
             .partitionBy("late").parquet(judged))
        finally:
            batch.unpersist()
        kept = spark.read.schema(by_lateness.schema).parquet(judged).filter("late = 0").select(
            "city", "zone_id", "event_time", "taxi_id", "lat", "lon", "speed", "status",
            F.lit(batch_id).alias("batch_id"))
        (kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("city", "zone_id", "batch_id").parquet(f"{self.root}/positions"))

    def processed(self, spark: SparkSession) -> DataFrame:
        """Events on time."""
        return self._judged(spark).filter("late = 0")

    def late(self, spark: SparkSession) -> DataFrame:
        """Late events with the seconds they were behind."""
        return self._judged(spark).filter("late = 1")

    def _judged(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/judged").drop("batch_id")

    def positions(self, spark: SparkSession) -> DataFrame:
        """One row per (city, zone, time, taxi). Repeats can only come from repeated events; the row of
        the latest batch counts. Filters on city and zone prune folders."""
        rows = spark.read.parquet(f"{self.root}/positions")
        return newest_per_key(rows, ["city", "zone_id", "event_time", "taxi_id"], ["batch_id"])
