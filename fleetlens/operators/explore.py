"""Exploration tables on trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions.text import stable_order
from fleetlens.functions.timing import weekday_name
from fleetlens.session import fixed_rows


def count_by(df: DataFrame, column: str, name: str = "trips") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def trips_by_day_type(trips: DataFrame) -> DataFrame:
    return count_by(trips, "DAY_TYPE").orderBy("DAY_TYPE")


def trips_by_call_type(trips: DataFrame) -> DataFrame:
    return count_by(trips, "CALL_TYPE").orderBy(F.desc("trips"), "CALL_TYPE")


def busiest_taxis(trips: DataFrame, k: int = 10) -> DataFrame:
    return count_by(trips, "TAXI_ID").orderBy(F.desc("trips"), "TAXI_ID").limit(k)


def quietest_taxis(trips: DataFrame, k: int = 10) -> DataFrame:
    return count_by(trips, "TAXI_ID").orderBy("trips", "TAXI_ID").limit(k)


def trips_per_hour(trips: DataFrame, epoch: str = "TIMESTAMP") -> DataFrame:
    ts = F.timestamp_seconds(F.col(epoch).cast("bigint"))
    return count_by(trips.withColumn("hour", F.hour(ts)), "hour").orderBy("hour")


def trips_per_weekday(trips: DataFrame, epoch: str = "TIMESTAMP") -> DataFrame:
    """Monday to Sunday; a day without trips stays in the table with a null count."""
    ts = F.timestamp_seconds(F.col(epoch).cast("bigint"))
    counts = count_by(trips.withColumn("day_name", weekday_name(ts)), "day_name")
    days = fixed_rows(
        trips.sparkSession, ["day_number", "day_name"], [(i + 1, d) for i, d in enumerate(K.WEEKDAYS)])
    return days.join(counts, "day_name", "left").select("day_number", "day_name", "trips").orderBy("day_number")


def duration_histogram(df: DataFrame, column: str = "duration", bins: int = 50) -> DataFrame:
    """Equal-width bins over min..max, the last one closed; empty bins count 0."""
    spark = df.sparkSession
    stats = df.agg(
        F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    bounds = stats.select(F.struct("lo", "hi").alias("b")).scalar()
    width = (F.col("b.hi") - F.col("b.lo")) / bins
    step = F.floor((F.col(column) - F.col("b.lo")) / F.nullif(width, F.lit(0.0)))
    filled = (
        df.filter(F.col(column).isNotNull()).withColumn("b", bounds)
        .groupBy(F.coalesce(F.least(step, F.lit(bins - 1)), F.lit(0)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n")))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin")).withColumn("b", bounds)
    return (
        grid.join(filled, "bin", "left")
        .select(
            "bin",
            (F.col("b.lo") + F.col("bin") * width).alias("bin_start"),
            (F.col("b.lo") + (F.col("bin") + 1) * width).alias("bin_end"),
            F.coalesce("n", F.lit(0)).alias("trips"))
        .orderBy("bin"))


def sample_trips(trips: DataFrame, key: str = "TRIP_ID", n: int = K.MAX_TRIPS_PER_CYCLE, seed: int = 42) -> DataFrame:
    """A shuffled selection of n trips that is the same for the same seed."""
    return trips.orderBy(stable_order(F.col(key), seed), key).limit(n)


def first_rows(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The first n rows in key order."""
    return df.orderBy(*keys).limit(n)
