"""Batch curation of raw trips."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens import constants as K
from fleetlens.functions import geo, trips as tf
from fleetlens.session import small_side


def usable_trips(raw: DataFrame, polyline: str = "POLYLINE") -> DataFrame:
    """Drop trips whose polyline text is null or no longer than 5 characters."""
    return raw.filter(F.col(polyline).isNotNull() & (F.length(polyline) > 5))


def one_row_per_trip(raw: DataFrame, key: str = "TRIP_ID", order=("TIMESTAMP", "POLYLINE")) -> DataFrame:
    """Keep the first row of each id in a fixed order, so that results repeat.

    ``row_number = 1`` lets Spark keep one row per id before the shuffle, so an id with very many
    copies does not fill one task.
    """
    # The first column is an epoch as text; as text 999999999 would come after 1000000000.
    ranked = Window.partitionBy(key).orderBy(F.col(order[0]).try_cast("bigint"), *order)
    return raw.withColumn("__n", F.row_number().over(ranked)).filter("__n = 1").drop("__n")


def valid_trajectories(trips: DataFrame, column: str = "polyline") -> DataFrame:
    """Trips with at least two points."""
    return trips.filter(F.size(column) >= 2)


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def cell_dimension(spark: SparkSession) -> DataFrame:
    """The 16 zones with the grid cell of their representative point."""
    zones = spark.range(1, K.N_ZONES + 1).select(F.col("id").cast("int").alias("zone_id"))
    z = F.col("zone_id")
    return zones.withColumn("cell_id", geo.grid_key(geo.zone_point_lat(z), geo.zone_point_lon(z)))


def curate_trips(
    raw: DataFrame,
    zone: Callable[[Column], Column] = tf.hash_zone,
    cells: DataFrame | None = None,
) -> DataFrame:
    """Filter, de-duplicate, and add duration, zone and cell.

    The filter runs before the de-duplication, so fewer rows are shuffled and an id with one bad and
    one good polyline keeps the good one.
    """
    cells = F.broadcast(cell_dimension(raw.sparkSession)) if cells is None else small_side(cells)
    clean = one_row_per_trip(usable_trips(raw)).withColumns({
        "trip_duration_sec": tf.duration_from_text(F.col("POLYLINE")),
        "zone_id": zone(F.col("TRIP_ID")),
    })
    return clean.join(cells, "zone_id", "left")


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass a stage, without a job of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def stage_counts(raw: DataFrame) -> DataFrame:
    """Rows before cleaning, with a polyline, with a usable one, and distinct usable ids; one pass."""
    usable = F.col("POLYLINE").isNotNull() & (F.length("POLYLINE") > 5)
    per_id = raw.groupBy("TRIP_ID").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("POLYLINE").alias("with_polyline"),
        F.count_if(usable).alias("usable"))
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum("with_polyline"), F.lit(0)).alias("with_polyline"),
        F.coalesce(F.sum("usable"), F.lit(0)).alias("usable_rows"),
        F.count_if(F.col("usable") > 0).alias("curated_rows"))


def trajectory_schema_check(df: DataFrame) -> DataFrame:
    """Check that the polyline column is there and holds points."""
    require_columns(df, ["trip_id", "polyline"])
    kind = df.schema["polyline"].dataType
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType)):
        raise ValueError(f"polyline must be an array of points, not {kind.simpleString()}")
    return df
