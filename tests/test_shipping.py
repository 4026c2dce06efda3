"""Python workers must not need this package on their path."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
import __spark_entry__ as contract
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
for name in ("mvad_explain", "sustained_alerts_stream", "series_flags_auto_season"):
    assert contract.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("DONE")
"""


def test_workers_without_the_package(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=repo)], cwd=tmp_path, env=env,
        capture_output=True, text=True, timeout=300,
    )
    assert "DONE" in run.stdout, run.stderr[-3000:]


def test_held_tables_are_made_again_when_gone(spark):
    from sensorlens import session

    made = []

    def build():
        made.append(1)
        return spark.range(3)

    for _ in range(2):
        assert session.hold_once(spark, "test table", build).count() == 3
    assert len(made) == 1
    known = (spark.sparkContext.applicationId, "test table")
    session._once[known] = (session.scratch_dir(spark, "gone"), session._once[known][1])
    assert session.hold_once(spark, "test table", build).count() == 3
    assert len(made) == 2
