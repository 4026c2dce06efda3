"""A stream of readings to the raw table and the roll-up pyramid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorlens.operators import pyramid
from sensorlens.operators.reshape import expand_metrics


def add_readings(readings: DataFrame, raw: str, path: str, batch: int) -> None:
    """Writes one batch of ``timestamp, tag, value`` to both tables; run again, it replaces what it
    wrote. Readings whose time doesn't parse stay in the raw table's folder of the null date."""
    held = readings.persist()
    try:
        (
            held.withColumn("date", F.to_date("timestamp"))
            .withColumn("batch", F.lit(batch).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date", "batch")
            .parquet(raw)
        )
        pyramid.add_batch(held.filter(F.col("timestamp").isNotNull()), path, batch)
    finally:
        held.unpersist()


def keep_pyramid(
    stream: DataFrame, raw: str, path: str, checkpoint: str,
    available_now: bool = True, interval: str = "10 seconds",
) -> StreamingQuery:
    """Metric envelopes to the raw table and to every level of the pyramid.

    No watermark and no state: a batch adds mergeable pieces, so readings may be late by any time.
    """

    def both(batch: DataFrame, batch_id: int) -> None:
        add_readings(batch, raw, path, batch_id)

    writer = expand_metrics(stream).writeStream.option("checkpointLocation", checkpoint).foreachBatch(both)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
