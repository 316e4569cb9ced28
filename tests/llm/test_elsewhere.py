"""Workers need not have the package: a session started elsewhere runs the queries."""

import os
import pathlib
import subprocess
import sys

REPO = str(pathlib.Path(__file__).parents[2])
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from fleetlens.session import build_session
from fleetlens.llm import queries
spark = build_session("elsewhere", "local[2]", **{"spark.sql.shuffle.partitions": "2", "spark.log.level": "ERROR",
                                                  "spark.checkpoint.dir": sys.argv[2]})
for name in sorted(dir(queries)):
    if name[:2] == "op" and name[2].isdigit():
        assert getattr(queries, name)(spark, "/root/testdata/sf0.001").count() > 0, name
        print("done", name)
"""


def test_queries_run_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "-c", SCRIPT, REPO, str(tmp_path / "shared")], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert ran.stdout.count("done") == 13, ran.stderr[-3000:]
