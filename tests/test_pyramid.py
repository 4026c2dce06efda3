"""The roll-up pyramid against raw readings: covers, late and repeated batches, pruned scans."""

import random
import re
from datetime import UTC, datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorlens.functions import timing
from sensorlens.operators import pyramid, series
from sensorlens.streaming.rollup import add_readings

BASE = datetime(2024, 1, 1, tzinfo=UTC)
MOMENTS = st.integers(0, 3 * timing.DAY).map(lambda us: BASE + timedelta(microseconds=us))


@settings(max_examples=300, deadline=None)
@given(st.none() | MOMENTS, st.none() | MOMENTS, st.integers(0, 3))
def test_covers_leave_no_gap_and_few_parts(start, end, levels):
    levels = pyramid.LEVELS[:levels]
    parts = pyramid.cover(start, end, levels)
    if start is not None and end is not None and start >= end:
        assert parts == []
        return
    assert parts[0][1] == start and parts[-1][2] == end
    assert all(a[2] == b[1] for a, b in zip(parts, parts[1:]))
    assert len(parts) <= 2 * len(levels) + 1
    for level, first, last in parts:
        assert first is None or last is None or first < last
        for at in (first, last):
            assert not level or at is None or (at - BASE) // timedelta(microseconds=1) % level == 0


def test_levels_of_steps():
    assert [pyramid.level_for(s) for s in ("1s", "15sec", "10s", "5min", "10min", "3hour", "6hour", "7days")] == [
        None, None, 10 * timing.SECOND, 10 * timing.SECOND,
        10 * timing.MINUTE, 10 * timing.MINUTE, 6 * timing.HOUR, 6 * timing.HOUR,
    ]
    assert pyramid.level_for("1hour", "count_distinct") is None and pyramid.level_for("Auto") is None


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """Readings in five batches, in no order of time; one batch is added twice."""
    draw = random.Random(8)
    rows = []
    for _ in range(4000):
        at = BASE.replace(tzinfo=None) + timedelta(microseconds=draw.randrange(4 * timing.DAY))
        rows.append((at, draw.choice("ABC"), draw.choice([None, round(draw.uniform(-9, 9), 2), 0.5])))
    rows += [(datetime(2024, 1, 2), "A", 1.0), (datetime(2024, 1, 2), "A", 1.0), (datetime(2024, 1, 2, 6), "D", None)]
    draw.shuffle(rows)
    folder = str(tmp_path_factory.mktemp("pyramid"))
    shape = "timestamp timestamp, tag string, value double"
    for batch in (0, 1, 2, 3, 3, 4):
        part = spark.createDataFrame(rows[batch::5], shape)
        if batch == 4:
            part = part.union(spark.createDataFrame([(None, "A", 5.0)], shape))
        add_readings(part, f"{folder}/raw", f"{folder}/levels", batch)
    return f"{folder}/levels", f"{folder}/raw", spark.createDataFrame(rows, shape)


def rows_of(df):
    return sorted((r.tag, r.timestamp, None if r.value is None else round(r.value, 8)) for r in df.collect())


@pytest.mark.parametrize("agg", ["avg", "sum", "count", "min", "max", "count_distinct"])
def test_answers_equal_raw_aggregates(spark, kept, agg):
    path, raw, readings = kept
    for step, start, end in [
        ("1hour", None, None), ("7days", None, "2024-01-03 13:05:07.25"), ("12hour", "2024-01-01 05:59:59.999999", "2024-01-04 18:00:00"),
        ("5min", "2024-01-02 00:00:00", "2024-01-02 00:00:00"), ("15sec", "2024-01-02 03:00:00", None),
    ]:
        got = pyramid.binned(spark, path, raw, agg, step, start, end)
        want = series.binned_aggregate(series.in_range(readings, start, end), agg, step)
        assert rows_of(got) == rows_of(want) != []
    with pytest.raises(ValueError):
        pyramid.binned(spark, path, raw, agg, "1hour", "2024-01-03", "2024-01-02")


def test_series_of_tags_and_compacted_copy(spark, kept, folder):
    path, raw, readings = kept
    want = series.make_series(readings.filter("tag in ('A', 'D')"), "avg", "30min", empty="linear")
    assert rows_of(pyramid.series(spark, path, raw, "avg", "30min", "linear", tags=["A", "D"])) == rows_of(want)
    pyramid.compacted(spark, path, f"{folder}/copy")
    assert rows_of(pyramid.binned(spark, f"{folder}/copy", raw, "sum", "1day")) == rows_of(pyramid.binned(spark, path, raw, "sum", "1day"))
    copy = spark.read.parquet(f"{folder}/copy")
    assert copy.count() == copy.select("level", "tag", "timestamp").distinct().count() < spark.read.parquet(path).count()
    more = spark.createDataFrame([(datetime(2024, 1, 2, 1), "E", 3.0)], "timestamp timestamp, tag string, value double")
    pyramid.add_batch(more, f"{folder}/copy", 9)
    assert rows_of(pyramid.binned(spark, f"{folder}/copy", raw, "sum", "1day", tags="E")) == [("E", datetime(2024, 1, 2), 3.0)]


def test_scans_are_pruned_to_the_level(spark, kept):
    path, raw, _ = kept
    plan = pyramid.binned(spark, path, raw, "avg", "1day")._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[(.*?)\], Push", plan)
    assert len(filters) == 1 and f"= {6 * timing.HOUR}" in filters[0]
    ranged = pyramid.binned(spark, path, raw, "avg", "1day", "2024-01-02 05:00:03", "2024-01-03 20:30:00")
    filters = re.findall(r"PartitionFilters: \[(.*?)\], Push", ranged._jdf.queryExecution().executedPlan().toString())
    assert len(filters) == 6 and all(re.search(r"date#\d+ >= ", f) and re.search(r"date#\d+ <= ", f) for f in filters)
    assert ranged.filter(F.col("tag") == "A").count() == 2


def test_no_readings(spark, folder):
    none = spark.createDataFrame([], "timestamp timestamp, tag string, value double")
    add_readings(none, f"{folder}/raw", f"{folder}/levels", 0)
    add_readings(spark.createDataFrame([(datetime(2024, 1, 1), "A", 1.0)], none.schema), f"{folder}/raw", f"{folder}/levels", 1)
    assert rows_of(pyramid.binned(spark, f"{folder}/levels", f"{folder}/raw", "sum", "1hour")) == [("A", datetime(2024, 1, 1), 1.0)]
