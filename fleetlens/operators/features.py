"""Lagged demand features and forecasting. Input is the slot series, which is small per zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions.timing import calendar, slot_index, slot_text

_LAGS = ("demand_lag_1d", "demand_lag_7d", "rolling_7d_mean")


def _with_calendar(series: DataFrame) -> DataFrame:
    return calendar(series.withColumn("timestamp", F.col("slot_30min").cast("timestamp")))


def _finish(series: DataFrame) -> DataFrame:
    return (
        _with_calendar(series).dropna(subset=list(_LAGS)).withColumnRenamed("demand", "target")
        .select("zone_id", "slot_30min", "target", "timestamp", "hour", "day_of_week", "is_weekend",
                "is_friday", "date", *_LAGS))


def features_rowlag(slots: DataFrame) -> DataFrame:
    """Features whose lags count the rows of the series, slots without demand being absent."""
    order = Window.partitionBy("zone_id").orderBy("slot")
    return _finish(slots.withColumns({
        "demand_lag_1d": F.lag("demand", K.SLOTS_PER_DAY).over(order),
        "demand_lag_7d": F.lag("demand", K.SLOTS_PER_WEEK).over(order),
        "rolling_7d_mean": F.avg("demand").over(order.rowsBetween(-K.SLOTS_PER_WEEK, -1)),
    }))


def fill_gaps(slots: DataFrame) -> DataFrame:
    """Every slot between the first and last one of a zone; missing ones have demand 0."""
    spans = slots.groupBy("zone_id").agg(F.min("slot").alias("lo"), F.max("slot").alias("hi"))
    grid = spans.select("zone_id", F.explode(F.sequence("lo", "hi")).alias("slot"))
    return (
        grid.join(slots.select("zone_id", "slot", "demand"), ["zone_id", "slot"], "left")
        .select("zone_id", "slot", F.coalesce("demand", F.lit(0)).alias("demand"))
        .withColumn("slot_30min", slot_text(F.col("slot"))))


def features_timelag(slots: DataFrame) -> DataFrame:
    """Features whose lags are exactly one and seven days, on the gap-filled series."""
    return features_rowlag(fill_gaps(slots))


def month_of(ts: str = "timestamp"):
    return F.date_format(F.col(ts), "yyyy-MM")


def split_by_month(features: DataFrame, n_train: int = K.TRAIN_MONTHS) -> DataFrame:
    """Add month and is_train: the first ``n_train`` distinct months are for training.

    The months are ranked as a table of their own (one row per month) and joined back.
    """
    dated = features.withColumn("month", month_of())
    months = dated.select("month").distinct().withColumn(
        "month_rank", F.dense_rank().over(Window.orderBy("month")))
    return dated.join(months, "month", "left").withColumn("is_train", F.col("month_rank") <= n_train)


def zone_metadata(features: DataFrame, zones: DataFrame) -> DataFrame:
    """Attach population and centroid of the zone."""
    extra = zones.groupBy("zone_id").agg(
        F.min_by("population", "seq").try_cast("double").alias("zone_population"),
        F.min_by("centroid_lat", "seq").alias("centroid_lat"),
        F.min_by("centroid_lon", "seq").alias("centroid_lon"))
    return features.join(extra, "zone_id", "left")


def rmse(df: DataFrame, prediction: str, label: str = "target") -> DataFrame:
    error = F.col(label).cast("double") - F.col(prediction)
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def naive_forecast(features: DataFrame) -> DataFrame:
    """Predict the demand of seven days before."""
    return features.withColumn("prediction_naive", F.col("demand_lag_7d").cast("double"))


def request_features(requests: DataFrame, slots: DataFrame) -> DataFrame:
    """Features for forecast requests (zone_id, datetime text) from the true demand history.

    The lags read the history by time, missing slots counting 0. The history must reach back a week
    before the request, else the row carries null lags.
    """
    stamped = requests.withColumn("timestamp", F.col("datetime").try_cast("timestamp")).withColumn(
        "slot", slot_index(F.unix_timestamp("timestamp")))
    asked = stamped.select("zone_id", "slot").distinct().withColumns({
        "demand": F.lit(None).cast("bigint"), "asked": F.lit(True)})
    known = slots.select("zone_id", "slot", "demand", F.lit(False).alias("asked"))
    first = slots.groupBy("zone_id").agg(F.min("slot").alias("first_slot"))
    order = Window.partitionBy("zone_id").orderBy("slot")

    def total(lo: int, hi: int):
        return F.coalesce(F.sum("demand").over(order.rangeBetween(lo, hi)), F.lit(0))

    lagged = (
        known.unionByName(asked)
        .withColumns({
            "demand_lag_1d": total(-K.SLOTS_PER_DAY, -K.SLOTS_PER_DAY),
            "demand_lag_7d": total(-K.SLOTS_PER_WEEK, -K.SLOTS_PER_WEEK),
            "rolling_7d_mean": total(-K.SLOTS_PER_WEEK, -1) / K.SLOTS_PER_WEEK,
        })
        .filter("asked").drop("asked", "demand")
        .join(first, "zone_id", "left"))
    reaches = F.col("slot") - K.SLOTS_PER_WEEK >= F.col("first_slot")
    lags = lagged.select(
        "zone_id", "slot", *[F.when(reaches, F.col(c)).alias(c) for c in _LAGS])
    return calendar(stamped.join(lags, ["zone_id", "slot"], "left"))
