"""Keyed serving tables on Parquet: upsert, replace, look up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from fleetlens.session import materialize, small_side


def newest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the highest ``order`` columns of each key; the rest of the row settles ties.

    ``row_number = 1`` is applied before the shuffle too, so a hot key moves one row per task.
    """
    others = [c for c in df.columns if c not in keys and c not in order]
    ranked = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in [*order, *others]])
    return df.withColumn("__n", F.row_number().over(ranked)).filter("__n = 1").drop("__n")


def merge_by_key(
    updates: DataFrame, path: str, keys: list[str], order: list[str], partition_by: list[str],
) -> None:
    """Insert or replace rows by primary key, the newest row winning."""
    merge_table(updates, path, partition_by, lambda rows: newest_per_key(rows, keys, order))


def merge_table(
    updates: DataFrame, path: str, partition_by: list[str], reduce: Callable[[DataFrame], DataFrame],
) -> None:
    """Union the updates with the stored rows of the same partitions and store the reduced result.

    ``reduce`` brings the rows to one per key and must give the same result when applied again.
    Only the partitions named by the updates are read and replaced, each in one commit (dynamic partition
    overwrite). Merging the same updates twice leaves the same table, so retries are safe.
    ``partition_by`` must be a function of the key: part of it, or a bucket of it (see ``key_bucket``).
    """
    spark = updates.sparkSession
    fresh = materialize(reduce(updates), "updates")
    try:
        old = spark.read.schema(updates.schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        merged = fresh
    else:
        touched = fresh.select(*partition_by).distinct()
        affected = old.join(small_side(touched), partition_by, "left_semi")
        merged = reduce(affected.unionByName(fresh))
    (
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by).parquet(path))


def key_bucket(*keys: str, buckets: int = 64) -> Column:
    """Bucket number of a key, for tables whose key is too fine to partition by."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def replace_table(df: DataFrame, path: str) -> None:
    """Truncate and load."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_connector(df: DataFrame, fmt: str, mode: str = "append", **options: str) -> None:
    """Any external table reachable through an installed Spark connector."""
    df.write.format(fmt).mode(mode).options(**options).save()
