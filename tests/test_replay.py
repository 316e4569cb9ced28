"""A table that comes in one file is the work of many tasks once it is replayed."""

import pathlib

from pyspark.sql import functions as F

from conftest import rows
from fleetlens.operators import match
from fleetlens.streaming import io
from test_match import city, frames


def test_replayed_parts_are_dealt_out(spark, tmp_path):
    spark.range(4000).select("id", F.lit("x").alias("text")).coalesce(1).write.parquet(str(tmp_path / "table"))
    table = spark.read.parquet(str(tmp_path / "table"))
    io.replay(table, "id", 2, str(tmp_path / "in"),
              lambda arriving: io.to_files(arriving, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert len(list(pathlib.Path(tmp_path / "in").glob("*.parquet"))) == 2 * spark.sparkContext.defaultParallelism
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(table)


def test_no_side_of_a_match_goes_through_the_driver(spark):
    p, r = frames(spark, *city(3, 60, 20, 9))
    assert "Broadcast" not in _plan(match.match_nearest(r, p))
    assert "Broadcast" not in _plan(match._close_by(match._requests(r, 180), match._by_bucket(match.valid_periods(p), 180), lambda x: x, 0.01))


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
