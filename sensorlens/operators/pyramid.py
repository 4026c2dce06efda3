"""A pyramid of roll-ups: mergeable states of readings at rising bin sizes, and answers from them.

A state is the number, sum, least and greatest of the readings of a tag in a bin. States merge, so a
bin may be stored in any number of pieces (one for each batch that brought readings of it, however
late), a coarser bin is the merge of finer ones, and what a chart asks for is answered from the
coarsest level that divides its step. Of a time range only the ends come from finer levels, and
what is left of them from raw readings, so an answer reads a few states for each bin it shows.

Levels lie in ``level=/date=/batch=`` folders; a batch that runs again replaces its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlens.functions import timing
from sensorlens.operators.ranges import Moment, check_order, for_tags
from sensorlens.operators.series import binned_aggregate, make_series
from sensorlens.sources.files import read_telemetry

# Bin sizes that are kept, in microseconds; each divides the next, and all divide a day.
LEVELS = (10 * timing.SECOND, 10 * timing.MINUTE, 6 * timing.HOUR)
STATES = (
    "tag string, timestamp timestamp, n bigint, total double, low double, high double, "
    "level bigint, date date, batch bigint"
)
_COLUMNS = ("tag", "timestamp", "n", "total", "low", "high")
_MICRO = timedelta(microseconds=1)
_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


def states(readings: DataFrame, step: str | int) -> DataFrame:
    """One state per tag and bin that has a reading. Null values make bins, but don't count."""
    value = F.col("value")
    return readings.groupBy("tag", timing.time_bin(F.col("timestamp"), step).alias("timestamp")).agg(
        F.count(value).alias("n"), F.sum(value).alias("total"),
        F.min(value).alias("low"), F.max(value).alias("high"),
    )


def merged(pieces: DataFrame, step: str | int) -> DataFrame:
    """States of finer bins, in any number of pieces, as states of the bins of ``step``."""
    return pieces.groupBy("tag", timing.time_bin(F.col("timestamp"), step).alias("timestamp")).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    )


def state_value(agg: str) -> Column:
    """The aggregate of a state, as :func:`~sensorlens.operators.series.binned_aggregate` gives it."""
    return {
        "avg": F.try_divide("total", "n"),
        "sum": F.col("total"),
        "count": F.col("n").cast("double"),
        "min": F.col("low"),
        "max": F.col("high"),
    }[agg]


def add_batch(readings: DataFrame, path: str, batch: int, files_per_date: int = 8) -> None:
    """Adds readings to every level, as pieces of this batch.

    The finest level is aggregated once and cached for the others. A date's tags are spread over
    ``files_per_date`` tasks and files of a level.
    """
    finest = states(readings, LEVELS[0]).persist()
    try:
        levels = [finest, *(merged(finest, level) for level in LEVELS[1:])]
        pieces = None
        for level, part in zip(LEVELS, levels):
            part = part.withColumn("level", F.lit(level))
            pieces = part if pieces is None else pieces.unionByName(part)
        _write(pieces.withColumn("batch", F.lit(batch).cast("bigint")), path, files_per_date)
    finally:
        finest.unpersist()


def _write(pieces: DataFrame, path: str, files_per_date: int) -> None:
    spread = F.pmod(F.xxhash64("tag"), F.lit(files_per_date))
    (
        pieces.withColumn("date", F.to_date("timestamp"))
        .withColumn("_spread", spread)
        .repartition("level", "date", "_spread")
        .sortWithinPartitions("level", "date", "tag", "timestamp")
        .select(*_COLUMNS, "level", "date", "batch")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("level", "date", "batch")
        .parquet(path)
    )


def compacted(spark: SparkSession, path: str, target: str, files_per_date: int = 8) -> None:
    """A copy of the pyramid in which every bin is one piece, of batch -1. Later batches may be
    added to the copy."""
    pieces = spark.read.schema(STATES).parquet(path)
    whole = pieces.groupBy("level", "tag", "timestamp").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    )
    _write(whole.withColumn("batch", F.lit(-1).cast("bigint")), target, files_per_date)


def level_for(step: str | int, agg: str = "avg") -> int | None:
    """The coarsest level whose bins make up those of ``step``; none if only raw readings do."""
    width = timing.duration(step)
    fitting = [level for level in LEVELS if width > 0 and width % level == 0]
    return max(fitting) if fitting and agg in ("avg", "sum", "count", "min", "max") else None


def _moment(at: Moment) -> datetime:
    at = datetime.fromisoformat(at) if isinstance(at, str) else at
    return at.replace(tzinfo=UTC) if at.tzinfo is None else at.astimezone(UTC)


def _floor(at: datetime, level: int) -> datetime:
    us = (at - _EPOCH) // _MICRO
    return _EPOCH + (us - us % level) * _MICRO


def cover(start: datetime | None, end: datetime | None, levels: Sequence[int]) -> list[tuple]:
    """Parts of the time from ``start`` up to, but without, ``end`` as (level, from, to): whole bins
    of the coarsest level, then of finer ones at both ends, and raw readings (level 0) of the rest.
    None stands for an open end."""
    if start is not None and end is not None and start >= end:
        return []
    if not levels:
        return [(0, start, end)]
    *finer, level = sorted(levels)
    first = start if start is None else _floor(start + (level - 1) * _MICRO, level)
    last = end if end is None else _floor(end, level)
    if first is not None and last is not None and first >= last:
        return cover(start, end, finer)
    before = [] if first is None else cover(start, first, finer)
    after = [] if last is None else cover(last, end, finer)
    return [*before, (level, first, last), *after]


def binned(
    spark: SparkSession, path: str, readings: str, agg: str, step: str | int,
    start: Moment | None = None, end: Moment | None = None,
    tags: str | Sequence[str] | DataFrame | None = None,
) -> DataFrame:
    """``tag, timestamp, value`` as :func:`~sensorlens.operators.series.binned_aggregate` gives
    them for the raw readings (a table in ``date=`` folders at ``readings``) from ``start`` to
    ``end``, both included. Distinct counts and steps that no level divides come from the raw
    readings. Each part opens its level's folders of its dates only."""
    if start is not None and end is not None:
        check_order(start, end)
    level = level_for(step, agg)
    if level is None:
        raw = read_telemetry(spark, readings, start, end).filter(F.col("timestamp").isNotNull())
        return binned_aggregate(for_tags(raw, tags), agg, step)
    begin = None if start is None else _moment(start)
    stop = None if end is None else _moment(end) + _MICRO
    pieces = None
    for size, first, last in cover(begin, stop, [x for x in LEVELS if x <= level]):
        if size == 0:
            raw = read_telemetry(spark, readings, first and first.replace(tzinfo=None), last and (last - _MICRO).replace(tzinfo=None))
            part = states(for_tags(raw, tags), LEVELS[0])
        else:
            part = for_tags(_level(spark, path, size, first, last), tags).select(*_COLUMNS)
        pieces = part if pieces is None else pieces.unionByName(part)
    return merged(pieces, step).select("tag", "timestamp", state_value(agg).alias("value"))


def _level(spark: SparkSession, path: str, level: int, first: datetime | None, last: datetime | None) -> DataFrame:
    table = spark.read.schema(STATES).parquet(path).filter(F.col("level") == level)
    if first is not None:
        at = timing.literal(first.replace(tzinfo=None))
        table = table.filter((F.col("date") >= at.cast("date")) & (F.col("timestamp") >= at))
    if last is not None:
        at = timing.literal(last.replace(tzinfo=None))
        table = table.filter((F.col("date") <= at.cast("date")) & (F.col("timestamp") < at))
    return table


def series(
    spark: SparkSession, path: str, readings: str, agg: str = "avg", step: str | int = "1hour",
    empty: str = "null", start: Moment | None = None, end: Moment | None = None,
    tags: str | Sequence[str] | DataFrame | None = None,
) -> DataFrame:
    """A regular grid of bins per tag, as :func:`~sensorlens.operators.series.make_series` makes it
    in its open form of the readings in the range."""
    found = binned(spark, path, readings, agg, step, start, end, tags)
    return make_series(found, "max", step, empty=empty)  # a bin has one value here
