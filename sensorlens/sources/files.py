"""Batch readers, table append and envelopes."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from sensorlens.functions import timing
from sensorlens.operators.ordering import ordered_index
from sensorlens.operators.ranges import Moment, in_range
from sensorlens.sources import schemas

# Fixed value: anomalies per message.
ANOMALIES_PER_MESSAGE = 10
WIRE_TIME = "yyyy-MM-dd'T'HH:mm:ss"


def read_reference_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A dimension from CSV with a header; the schema is given, so the file is read once."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)


def read_telemetry(
    spark: SparkSession, path: str, start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    """Long-form readings from parquet. On a table written by :func:`append_telemetry` the bounds
    also select the ``date`` folders, so files outside the range are never listed as input."""
    table = spark.read.parquet(path)
    if "date" in table.columns:
        if start is not None:
            table = table.filter(F.col("date") >= timing.literal(start).cast("date"))
        if end is not None:
            table = table.filter(F.col("date") <= timing.literal(end).cast("date"))
    return in_range(table, start, end).select("timestamp", "tag", "value")


def append_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), batch: str | int | None = None
) -> None:
    """Adds rows to a parquet table, creating it if absent.

    With a ``batch`` the rows go into a folder of that name, which replaces what an earlier try of
    the batch left there, be it whole or in part: an append that is run again adds nothing twice.
    All appends to a table name their batch (and the table has a column ``batch``), or none does.
    """
    if batch is None:
        _write(df.write.mode("append"), path, partition_by)
    else:
        _write(df.write.mode("overwrite").option("partitionOverwriteMode", "static"), _batch(path, batch), partition_by)


def _write(writer: DataFrameWriter, path: str, partition_by: Sequence[str]) -> None:
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def _batch(path: str, batch: str | int) -> str:
    name = str(batch)
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", name):
        raise ValueError(f"not a batch name: {batch!r}")
    return f"{path}/batch={name}"


def append_telemetry(
    df: DataFrame, path: str, files_per_date: int = 32, batch: str | int | None = None
) -> None:
    """Appends readings as ``date=`` folders, sorted by tag and time inside the files; with a
    ``batch``, so that the append may be run again, as :func:`append_table` says.

    Rows are spread over (date, hash of tag and hour): a busy tag or day is shared by many
    tasks, and each folder gets at most ``files_per_date`` files per append.
    """
    spread = F.pmod(F.xxhash64("tag", F.date_trunc("hour", "timestamp")), F.lit(files_per_date))
    dated = df.withColumn("date", F.to_date("timestamp")).withColumn("_spread", spread)
    spread_out = (
        dated.repartition("date", "_spread")
        .sortWithinPartitions("date", "tag", "timestamp")
        .drop("_spread")
    )
    append_table(spread_out, path, ["date"], batch)


def read_routes(spark: SparkSession, path: str) -> DataFrame:
    """Route documents (a JSON array per file, or one document per line)."""
    return spark.read.schema(schemas.ROUTES).option("multiLine", True).json(path)


def route_point_counts(routes: DataFrame) -> DataFrame:
    return routes.select("route_id", F.size("points").alias("point_count"))


def to_metric_envelopes(
    telemetry: DataFrame, by: Sequence[str] = ("asset", "timestamp")
) -> DataFrame:
    """One metric message per asset and tick, as JSON in ``value``. A message holds one reading
    per sensor of the asset. Few readings share a message, so they are dealt out before they are
    gathered: lists made before the shuffle would shorten nothing."""
    metric = F.struct(
        F.col("tag").alias("name"),
        F.date_format("timestamp", WIRE_TIME).alias("timestamp"),
        F.lit("Double").alias("dataType"),
        F.col("value").alias("value"),
    )
    return (
        telemetry.repartition(*by)
        .groupBy(*by)
        .agg(F.array_sort(F.collect_list(metric)).alias("metrics"))
        .select(*by, F.to_json(F.struct("metrics")).alias("value"))
    )


def to_anomaly_envelopes(df: DataFrame, n: int = ANOMALIES_PER_MESSAGE) -> DataFrame:
    """Anomalies of one asset in messages of ``n``, in time order, as JSON in ``value``.

    Positions come from a chunked rank, so an asset with most of the anomalies is spread over
    tasks; a message itself never holds more than ``n`` rows.
    """
    if "interpretation" not in df.columns:
        df = df.withColumn("interpretation", F.lit(None).cast("string"))
    fields = F.struct(
        F.col("idx"),
        F.col("is_anomaly").cast("bigint").alias("is_anomaly"),
        "asset",
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        "score",
        "severity",
        "interpretation",
    )
    numbered = ordered_index(df, "asset", ["timestamp", "score"])
    return (
        numbered.groupBy("asset", F.floor(F.col("idx") / n).alias("message"))
        .agg(F.array_sort(F.collect_list(fields)).alias("anomalies"))
        .withColumn(
            "anomalies", F.transform("anomalies", lambda a: a.dropFields("idx"))
        )
        .select(
            "asset",
            "message",
            F.size("anomalies").alias("rows"),
            F.to_json(F.struct("anomalies")).alias("value"),
        )
    )
