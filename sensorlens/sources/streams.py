"""Streaming readers and sinks.

Readers take a folder of JSON lines. A message bus gives the same rows: apply
``parse_messages`` to its ``value`` column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorlens.sources import schemas

# Files per micro-batch: keeps state updates and sorts of one batch bounded on a backlog.
MAX_FILES = 1000


def _json_stream(
    spark: SparkSession, path: str, schema: str, max_files: int
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .option("mode", "PERMISSIVE")
        .json(path)
    )


def read_telemetry_stream(
    spark: SparkSession, path: str, max_files: int = MAX_FILES
) -> DataFrame:
    return _json_stream(spark, path, schemas.METRIC_ENVELOPE, max_files)


def read_anomaly_stream(
    spark: SparkSession, path: str, max_files: int = MAX_FILES
) -> DataFrame:
    return _json_stream(spark, path, schemas.ANOMALY_ENVELOPE, max_files)


def read_vehicle_stream(
    spark: SparkSession, path: str, max_files: int = MAX_FILES
) -> DataFrame:
    """Vehicle events, with the ISO-8601 time parsed; a bad time gives null."""
    events = _json_stream(spark, path, schemas.VEHICLE_EVENTS, max_files)
    return events.withColumn("timestamp", F.try_to_timestamp("timestamp"))


def parse_messages(messages: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Messages with JSON text in ``column`` to the fields of ``schema``; batch or stream."""
    return messages.select(F.from_json(F.col(column).cast("string"), schema).alias("_m")).select(
        "_m.*"
    )


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: tuple[str, ...] = (),
    available_now: bool = True,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Appends to a parquet table; the sink's commit log makes each file count exactly once."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def fan_out(
    stream: DataFrame,
    raw_path: str,
    checkpoint: str,
    alert_fn: Callable[[DataFrame], DataFrame],
    alert_path: str,
    available_now: bool = True,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Writes each micro-batch to the raw table and its alerts to the alert table.

    Both folders are named by the batch and overwritten, so a batch that runs again after a
    failure replaces its own output instead of repeating it. ``alert_fn`` must be stateless.
    """

    def both(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            held.write.mode("overwrite").parquet(f"{raw_path}/batch={batch_id}")
            alert_fn(held).write.mode("overwrite").parquet(f"{alert_path}/batch={batch_id}")
        finally:
            held.unpersist()

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(both)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def write_alerts(df: DataFrame, path: str, checkpoint: str | None = None) -> StreamingQuery | None:
    """Appends alert rows; a stream needs a checkpoint folder and gives its query."""
    if not df.isStreaming:
        df.write.mode("append").parquet(path)
        return None
    if checkpoint is None:
        raise ValueError("a stream of alerts needs a checkpoint folder")
    return write_stream(df, path, checkpoint)
