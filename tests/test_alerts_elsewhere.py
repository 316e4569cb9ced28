"""Alert queries in a session as Spark starts it: its own state store, workers without the package."""

import os
import pathlib
import subprocess
import sys

REPO = str(pathlib.Path(__file__).parents[1])
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
from fleetlens.plans import load_all
from fleetlens.plans.registry import QUERIES
load_all()
spark = SparkSession.builder.master("local[2]").config(map={
    "spark.sql.shuffle.partitions": "2", "spark.log.level": "ERROR", "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC", "spark.checkpoint.dir": sys.argv[2]}).getOrCreate()
stamp = lambda hours: f"2024-01-01 {hours:02d}:00:00"
events = [(1, 7, 0, "error"), (2, 7, 1, "error"), (3, 8, 1, "error"), (4, 8, 2, "view"), (5, 7, 9, "view"), (6, 9, 12, "error")]
spark.createDataFrame([(i, stamp(h), u, k, 1.0) for i, u, h, k in events], "event_id long, ts string, user_id long, event_type string, value double") \\
    .withColumn("ts", F.to_timestamp("ts")).write.parquet(sys.argv[3] + "/events.parquet")
lines = [(1, 4, "2024-01-01"), (1, 1, "2024-01-20"), (2, 4, "2024-01-01"), (2, 1, "2024-01-05"), (2, 3, "2024-01-06")]
spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_shipdate string").withColumn("l_shipdate", F.to_timestamp("l_shipdate")) \\
    .write.parquet(sys.argv[3] + "/lineitem.parquet")
print("dark", sorted(r.taxi_id for r in QUERIES["stream_blackout_alerts"](spark, sys.argv[3]).collect()))
print("stuck", sorted((r.trip_id, r.status) for r in QUERIES["stream_stuck_trips"](spark, sys.argv[3]).collect()))
"""


def test_alerts_in_a_plain_session(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    (tmp_path / "tables").mkdir()
    ran = subprocess.run([sys.executable, "-c", SCRIPT, REPO, str(tmp_path / "shared"), str(tmp_path / "tables")],
                         cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "dark ['7', '9']" in ran.stdout, ran.stderr[-3000:]
    assert "stuck [('1', 'accepted'), ('1', 'requested')]" in ran.stdout, (ran.stdout, ran.stderr[-3000:])
