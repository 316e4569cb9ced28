import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fleetlens.session import materialize, shared_dir, small_side
from fleetlens.sources import files, serving


def merge(df, path):
    serving.merge_by_key(df, path, ["k"], ["v"], ["p"])


def test_merge_inserts_replaces_and_repeats_safely(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda data: spark.createDataFrame(data, "k int, v int, x string, p int")
    merge(frame([(1, 1, "a", 0), (2, 1, "b", 0), (3, 1, "c", 1)]), path)
    stamp = {d: os.stat(f"{path}/p={d}").st_mtime_ns for d in (0, 1)}
    update = frame([(2, 2, "B", 0), (4, 2, "d", 0), (1, 0, "old", 0)])
    merge(update, path)
    first = rows(spark.read.parquet(path), "k", "v", "x", "p")
    merge(update, path)
    assert first == rows(spark.read.parquet(path), "k", "v", "x", "p")
    assert first == [(1, 1, "a", 0), (2, 2, "B", 0), (3, 1, "c", 1), (4, 2, "d", 0)]
    assert os.stat(f"{path}/p=1").st_mtime_ns == stamp[1], "an untouched partition must stay"


def test_newest_per_key_prunes_hot_keys_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 1).alias("k"), F.col("id").alias("v"))
    out = serving.newest_per_key(df, ["k"], ["v"])
    assert rows(out) == [(0, 999)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_replace_table(spark, tmp_path):
    path = str(tmp_path / "t")
    serving.replace_table(spark.range(5), path)
    serving.replace_table(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_sample_is_the_first_rows_by_key(spark, tmp_path):
    path = str(tmp_path / "s")
    files.write_sample(spark.range(100).orderBy(F.desc("id")), path, ["id"], 7)
    assert rows(spark.read.parquet(path)) == sorted([(i,) for i in range(7)], key=str)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    out = materialize(spark.range(3), "x")
    assert out.count() == 3 and any(f.startswith("file:" + shared_dir(spark)) or shared_dir(spark) in f for f in out.inputFiles())


def test_only_small_sides_are_broadcast(spark):
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(small_side(spark.range(10), 80)) and not hinted(small_side(spark.range(11), 80))


@pytest.mark.parametrize("missing", ["v"])
def test_merge_reports_other_errors(spark, tmp_path, missing):
    path = str(tmp_path / "t")
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "p=0").mkdir()
    (tmp_path / "t" / "p=0" / "x.parquet").write_text("broken")
    with pytest.raises(Exception):
        merge(spark.createDataFrame([(1, 1, "a", 0)], "k int, v int, x string, p int"), path)
