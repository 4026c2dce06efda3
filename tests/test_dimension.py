"""Streams that meet a dimension which changes while they run."""

import random

import pytest
from pyspark.sql import functions as F

from sensorlens.operators.assets import attributes_asof
from sensorlens.streaming import dimension

ROWS = "asset string, timestamp timestamp, severity double"
HISTORY = "AssetID string, valid_from timestamp, version bigint, place string"
CHANGES = "AssetID string, valid_from timestamp, place string"


def moment(minute):
    return f"2024-01-{1 + minute // 1440:02} {minute // 60 % 24:02}:{minute % 60:02}:00"


@pytest.mark.parametrize("chunk", ["1hour", "30days"])
def test_attributes_as_of_the_row(frame, chunk):
    rnd = random.Random(4)
    minutes = [0, 5, 59, 60, 61, 500, 1440, 4000]
    history = [(rnd.choice("ABC"), moment(rnd.choice(minutes)), rnd.randrange(3), rnd.choice(["x", "y", None])) for _ in range(30)]
    history += history[:5] + [(None, moment(0), 0, "n"), ("A", None, 9, "n")]
    rows = [(rnd.choice(["A", "B", "C", "D", None]), moment(rnd.choice(minutes)), float(k)) for k in range(60)]
    rows += rows[:4] + [("A", None, 0.5)]
    out = attributes_asof(frame(ROWS, rows), frame(HISTORY, history), chunk)
    got = sorted((r.asset or "", str(r.timestamp), r.severity, str(r.valid_from), r.place or "") for r in out.collect())

    def place(asset, at):
        known = [h for h in history if asset and at and h[0] == asset and h[1] and h[1] <= at]
        best = max(known, key=lambda h: (h[1], h[2], h[3] or ""), default=(None,) * 4)
        return str(best[1]), best[3] or ""

    assert got == sorted((a or "", str(at), s, *place(a, at)) for a, at, s in rows)


def test_attributes_of_nothing_and_clashing_names(frame):
    rows, history = frame(ROWS, [("A", moment(1), 1.0)]), frame(HISTORY, [])
    assert attributes_asof(rows, history).collect()[0].place is None
    assert attributes_asof(rows.limit(0), history).collect() == []
    with pytest.raises(ValueError, match="severity"):
        attributes_asof(rows, history.withColumn("severity", F.lit(1.0)))


def test_versions_are_kept_and_read_as_of(spark, frame, folder):
    path = f"{folder}/places"
    assert dimension.newest_version(spark, path) is None
    assert dimension.read_dimension(spark, path, CHANGES, None).count() == 0
    for version in (0, 1, 2):
        dimension.publish_dimension(frame(CHANGES, [("A", moment(version), f"p{version}")]), path, version)
    dimension.publish_dimension(frame(CHANGES, [("A", moment(0), "again")]), path, 1)
    # A version whose writer failed has no success mark.
    frame(CHANGES, [("A", moment(9), "half")]).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{path}/version=3")
    assert dimension.newest_version(spark, path) == 2
    read = dimension.read_dimension(spark, path, CHANGES, 1)
    assert sorted(r.place for r in read.collect()) == ["p0", "p1"]
    dimension.publish_dimension(frame(CHANGES, [("A", moment(3), "p3")]), path, 3)
    assert [r.place for r in dimension.read_dimension(spark, path, CHANGES, 3).filter("version = 3").collect()] == ["p3"]


def test_a_batch_that_runs_again_sees_its_first_dimension(spark, frame, folder):
    path, ledger = f"{folder}/places", f"{folder}/ledger"
    assert dimension.version_of_batch(spark, path, ledger, 0) is None
    dimension.publish_dimension(frame(CHANGES, [("A", moment(0), "p0")]), path, 0)
    assert dimension.version_of_batch(spark, path, ledger, 0) == 0
    dimension.publish_dimension(frame(CHANGES, [("A", moment(0), "p1")]), path, 1)
    assert dimension.version_of_batch(spark, path, ledger, 0) == 0
    assert dimension.version_of_batch(spark, path, ledger, 1) == 1


def test_stream_restarts_after_a_failure_between_batches(spark, frame, folder):
    """The second batch fails after a version was published; its second run uses the noted version."""
    source, places, out = f"{folder}/in", f"{folder}/places", f"{folder}/out"
    for k in range(3):
        frame(ROWS, [("A", moment(10 * k + 5), float(k)), ("B", moment(10 * k + 5), float(k))]).coalesce(1).write.mode("append").parquet(source)
    dimension.publish_dimension(frame(CHANGES, [("A", moment(0), "p0")]), places, 0)
    tries = []

    def before(session, batch_id):
        tries.append(batch_id)
        if batch_id == 1 and tries.count(1) == 1:
            assert dimension.version_of_batch(session, places, f"{folder}/checkpoint/dimension", 1) == 0
            dimension.publish_dimension(frame(CHANGES, [("A", moment(10), "p1")]), places, 1)
            raise RuntimeError("lost")

    def drained():
        stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(source)
        dimension.enrich_changing(stream, places, CHANGES, out, f"{folder}/checkpoint", before=before).awaitTermination()

    with pytest.raises(Exception, match="lost"):
        drained()
    drained()
    got = sorted((r.asset, r.severity, r.place) for r in spark.read.parquet(out).collect())
    assert tries == [0, 1, 1, 2]
    assert got == [("A", 0.0, "p0"), ("A", 1.0, "p0"), ("A", 2.0, "p1"), ("B", 0.0, None), ("B", 1.0, None), ("B", 2.0, None)]
