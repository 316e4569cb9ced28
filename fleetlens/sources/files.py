"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlens import schemas
from fleetlens.operators.curate import trajectory_schema_check, valid_trajectories
from fleetlens.operators.explore import first_rows


def read_trips_csv(spark: SparkSession, path: str, schema=schemas.RAW_TRIP) -> DataFrame:
    """Raw trip file with a header. All columns are text; quoted polylines may hold commas."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def write_trips_csv(trips: DataFrame, path: str) -> None:
    trips.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_parquet(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_trajectories(spark: SparkSession, path: str, schema=schemas.TRAJECTORY_TRIP) -> DataFrame:
    """Trips with at least two points, after a check of the polyline column."""
    return valid_trajectories(trajectory_schema_check(spark.read.schema(schema).parquet(path)))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, compression: str = "snappy") -> None:
    """Replace the table at ``path``."""
    writer = df.write.mode("overwrite").option("compression", compression)
    writer = writer.option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_sample(df: DataFrame, path: str, keys: list[str], n: int = 1000) -> None:
    """The first n rows in key order, so the sample is the same every time."""
    write_parquet(first_rows(df, keys, n), path)
