"""The replayed history: slices in order, and batches that follow time however many files there are."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from sensorlens.plans import replay
from sensorlens.plans.fixtures import Tables


@pytest.fixture(scope="module")
def written(spark, small):
    """Telemetry of 30 days in files of one line per reading, several for each slice."""
    t = Tables(spark, small)

    def to_messages(rows):
        return rows.repartition(7).select(F.unix_micros("timestamp").cast("string").alias("value"))

    return t, replay._write(t, "test-messages", t.telemetry, to_messages, None)


def test_batches_follow_the_time_covered(written):
    t, path = written
    names = sorted(glob.glob(f"{path.removeprefix('file:')}/part-*"), key=os.path.getmtime)
    size = replay.files_of(path, 2)
    assert len(names) == 35 and size == 14  # three batches, where two files a batch make eighteen
    first = min(int(line) for name in names for line in open(name))
    for n in range(3):
        lines = [int(line) for name in names[n * size : (n + 1) * size] for line in open(name)]
        assert max(lines) < first + (2 * n + 2) * 7 * 86_400_000_000
        assert min(lines) >= first + 2 * n * 7 * 86_400_000_000


def test_slices_hold_every_row_once(written):
    t, path = written
    got = sorted(int(r.value) for r in t.spark.read.text(path).collect())
    assert got == sorted(r[0] for r in t.telemetry.select(F.unix_micros("timestamp")).collect())


@pytest.mark.parametrize("ends, size", [([9, 18, 27, 35, 38], 17), ([1, 2, 3, 4, 5], 2), ([4], 4), ([3, 6], 6), ([2, 4, 4, 4, 9], 2), ([], 1)])
def test_files_of_a_batch(ends, size):
    replay._ends["x"] = ends
    assert replay.files_of("x", 2) == size


def test_nothing_to_replay(spark, frame):
    assert list(replay._slices(frame("timestamp timestamp, value double", []))) == []


def test_readings_are_dealt_out_before_they_are_gathered(spark, small):
    from sensorlens.sources.files import to_metric_envelopes

    rows = Tables(spark, small).events.selectExpr("asset", "ts AS timestamp", "event_type AS tag", "value")
    plan = to_metric_envelopes(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.rindex("ObjectHashAggregate(") < plan.index("Exchange")
