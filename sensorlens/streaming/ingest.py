"""Event streams to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorlens.functions import timing
from sensorlens.functions.aggregates import numeric_agg
from sensorlens.operators.ranges import only_anomalies
from sensorlens.operators.reshape import expand_array, expand_metrics, project_anomaly_fields
from sensorlens.sources.streams import write_stream

# Fixed value: how late an event may be.
TOLERANCE = "2 minutes"


def anomaly_rows(stream: DataFrame) -> DataFrame:
    """Anomaly envelopes to one row per reported anomaly."""
    rows = project_anomaly_fields(expand_array(stream.select("anomalies"), "anomalies"))
    return only_anomalies(rows).select("asset", "timestamp", "severity", "is_anomaly")


def all_anomaly_rows(stream: DataFrame) -> DataFrame:
    """The same with every row and the explanation, for the anomaly table."""
    rows = project_anomaly_fields(expand_array(stream.select("anomalies"), "anomalies"))
    return rows.withColumn("is_anomaly", F.col("is_anomaly").cast("boolean"))


def split_bad_times(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a usable timestamp, and the others for a quarantine table."""
    usable = F.col("timestamp").isNotNull()
    return rows.filter(usable), rows.filter(~usable)


def with_tolerance(stream: DataFrame, delay: str = TOLERANCE) -> DataFrame:
    return stream.withWatermark("timestamp", delay)


def telemetry_ingest(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Metric envelopes to the long table, in ``date=`` folders. No shuffle: the files of a
    batch follow its input splits. Readings whose time does not parse are kept in the folder of
    the null date, where range reads do not see them."""
    dated = expand_metrics(stream).withColumn("date", F.to_date("timestamp"))
    return write_stream(dated, path, checkpoint, ("date",), available_now)


def vehicle_ingest(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Vehicle events to a table in ``date=`` folders; bad times as in :func:`telemetry_ingest`."""
    dated = stream.withColumn("date", F.to_date("timestamp"))
    return write_stream(dated, path, checkpoint, ("date",), available_now)


def live_trend(
    stream: DataFrame, step: str | int = "10s", agg: str = "avg", delay: str = TOLERANCE
) -> DataFrame:
    """Aggregate per tag and tumbling window, emitted once the watermark closes the window."""
    width = f"{timing.duration(step)} microseconds"
    window = F.window("timestamp", width, width, timing.window_offset(step))
    return (
        with_tolerance(stream, delay)
        .groupBy("tag", window.alias("_window"))
        .agg(numeric_agg(agg, F.col("value")).alias("value"))
        .select("tag", F.col("_window.start").alias("timestamp"), "value")
    )
