"""The given tables written out as message files, for the streaming queries.

History is written one time slice after the other. The file source takes files in the order they
were written, so no row is later than one slice; the streaming queries allow that delay. A closing
message far in the future moves the watermark past all real events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlens import session
from sensorlens.functions import timing
from sensorlens.operators.assets import asset_telemetry
from sensorlens.plans.fixtures import Tables
from sensorlens.sources import files

SLICE_DAYS = 7
DELAY = f"{SLICE_DAYS} days"
CLOSING = "ZZZ"
CLOSING_TIME = "2100-01-01T00:00:00"

_written: dict[tuple[str, str, str], str] = {}
_ends: dict[str, list[int]] = {}  # files up to the end of each slice


def _slices(df: DataFrame):
    """Time slices in order; their number grows with the time covered, not with the rows. One pass
    over the rows deals them out, so each slice reads its own only."""
    first = df.agg(F.min("timestamp")).first()[0]
    if first is None:
        return
    since = F.unix_micros("timestamp") - F.unix_micros(F.lit(first))
    number = F.floor(since / F.lit(SLICE_DAYS * timing.DAY))
    path = session.scratch_dir(df.sparkSession, "slices")
    dealt = df.filter(F.col("timestamp").isNotNull()).withColumn("_slice", number)
    dealt.write.partitionBy("_slice").parquet(path)
    held = df.sparkSession.read.schema(dealt.schema).parquet(path)
    for k in range(held.agg(F.max("_slice")).first()[0] + 1):
        yield held.filter(F.col("_slice") == k).drop("_slice")


def _files(spark: SparkSession, path: str) -> int:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/part-*")
    return len(place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place))


def files_of(path: str, slices: int) -> int:
    """Files per micro-batch with which batch N holds nothing beyond the first ``slices * (N + 1)``
    slices, however many files a slice has: batches follow the time covered, not the rows."""
    ends = _ends[path]
    full = [ends[slices * k - 1] // k for k in range(1, len(ends)) if slices * k < len(ends)]
    return max(1, min(full, default=sum(ends[-1:])))


def _write(t: Tables, kind: str, rows: DataFrame, to_messages, closing: str | None) -> str:
    key = (t.spark.sparkContext.applicationId, t.dir, kind)
    if key not in _written or not session.exists(t.spark, _written[key]):
        path = session.scratch_dir(t.spark, kind)
        _ends[path] = []
        for part in _slices(rows):
            to_messages(part).select("value").write.mode("append").text(path)
            _ends[path].append(_files(t.spark, path))
        if closing:
            last = t.spark.range(1).select(F.lit(closing).alias("value"))
            last.write.mode("append").text(path)
        _written[key] = path
    return _written[key]


def anomaly_messages(t: Tables) -> str:
    closing = (
        f'{{"anomalies":[{{"is_anomaly":1,"asset":"{CLOSING}","timestamp":"{CLOSING_TIME}",'
        '"score":0.0,"severity":0.0}]}'
    )
    return _write(t, "anomaly-messages", t.interpreted, files.to_anomaly_envelopes, closing)


def metric_messages(t: Tables) -> str:
    closing = (
        f'{{"metrics":[{{"name":"{CLOSING}","timestamp":"{CLOSING_TIME}",'
        '"dataType":"Double","value":0.0}]}'
    )
    rows = asset_telemetry(t.tags, t.telemetry)
    return _write(t, "metric-messages", rows, files.to_metric_envelopes, closing)


def vehicle_messages(t: Tables) -> str:
    def to_messages(rows: DataFrame) -> DataFrame:
        stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        event = F.struct(
            F.col("event_id").cast("string").alias("event_id"),
            "vehicle_id", stamp.alias("timestamp"), "lat", "lon",
        )
        return rows.select(F.to_json(event).alias("value"))

    return _write(t, "vehicle-messages", t.vehicles, to_messages, None)
