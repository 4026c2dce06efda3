"""Nested data to rows, wide to long and back, paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlens.functions import timing
from sensorlens.functions.text import safe_cast
from sensorlens.sources.schemas import INTERPRETATION


def expand_array(df: DataFrame, column: str) -> DataFrame:
    """One row per array element as ``array_index`` and ``array_value``; rows whose array is
    missing or empty are dropped."""
    return df.select("*", F.posexplode(column).alias("array_index", "array_value"))


def project_anomaly_fields(expanded: DataFrame) -> DataFrame:
    """Fields of the anomalies that :func:`expand_array` put into ``array_value``."""
    value = F.col("array_value")
    return expanded.select(
        value["asset"].alias("asset"),
        safe_cast(value["timestamp"], "timestamp").alias("timestamp"),
        value["score"].alias("score"),
        value["severity"].alias("severity"),
        value["is_anomaly"].alias("is_anomaly"),
        value["interpretation"].alias("interpretation"),
    )


def expand_metrics(df: DataFrame) -> DataFrame:
    """Metric envelopes to ``timestamp, tag, value``; the reading keeps its own time."""
    return df.select(F.inline("metrics")).select(
        safe_cast(F.col("timestamp"), "timestamp").alias("timestamp"),
        F.col("name").alias("tag"),
        "value",
    )


def expand_interpretation(anomalies: DataFrame) -> DataFrame:
    """One row per (anomaly, tag) from the JSON text in ``interpretation``."""
    rest = [c for c in anomalies.columns if c != "interpretation"]
    return anomalies.withColumn("_parts", F.from_json("interpretation", INTERPRETATION)).select(
        *rest, F.inline("_parts")
    )


def expand_changes(explanations: DataFrame) -> DataFrame:
    """One row per partner tag: ``secondary_tag`` and ``correlation_change``."""
    rest = [c for c in explanations.columns if c not in ("correlation_changes", "is_anomaly")]
    changes = F.col("correlation_changes")
    pairs = F.arrays_zip(
        changes["changed_variables"].alias("secondary_tag"),
        changes["changed_values"].alias("correlation_change"),
    )
    return explanations.select(*rest, F.inline(pairs)).toDF(
        *rest, "secondary_tag", "correlation_change"
    )


def narrow(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every column as a row of text: ``Attribute`` and ``Value``."""
    cells = [F.col(c).cast("string").alias(c) for c in df.columns if c not in keep]
    names = [c for c in df.columns if c not in keep]
    return df.select(*keep, *cells).unpivot(list(keep), names, "Attribute", "Value")


def unpivot_frame(df: DataFrame, keys: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Wide frame to ``tag`` and ``value`` rows."""
    names = [c for c in df.columns if c not in keys]
    return df.unpivot(list(keys), names, "tag", "value")


def asset_frame(
    telemetry: DataFrame, features: Sequence[str], step: str | int, agg: str = "avg"
) -> DataFrame:
    """One column per feature, in the given order, one row per bin.

    The feature list is given, so no job runs to find the columns, and the filter on it is
    pushed to the scan.
    """
    return (
        telemetry.filter(F.col("tag").isin(*features))
        .groupBy(timing.time_bin(F.col("timestamp"), step).alias("timestamp"))
        .pivot("tag", list(features))
        .agg(F.expr(f"{agg}(value)"))
    )


def flatten_route(df: DataFrame, key: str = "route_id") -> DataFrame:
    """Routes, legs and points of a directions document to ordered points.

    ``routes`` is array<struct<legs: array<struct<points: array<struct<latitude, longitude>>>>>>.
    The points of one document are numbered in order.
    """
    points = F.flatten(
        F.flatten(
            F.transform("routes", lambda r: F.transform(r["legs"], lambda leg: leg["points"]))
        )
    )
    return df.select(key, F.posexplode(points).alias("idx", "point")).select(
        key, F.col("idx").cast("bigint").alias("idx"),
        F.col("point.latitude").alias("lat"), F.col("point.longitude").alias("lon"),
    )


def route_points(routes: DataFrame) -> DataFrame:
    """Points of a routes table as ``route_id, idx, lat, lon``."""
    return routes.select("route_id", F.posexplode("points").alias("idx", "point")).select(
        "route_id", F.col("idx").cast("bigint").alias("idx"),
        F.col("point")[0].alias("lat"), F.col("point")[1].alias("lon"),
    )


def densify_path(
    points: DataFrame, max_len: float = 0.0002, key: str = "route_id"
) -> DataFrame:
    """Splits each segment into equal pieces no longer than ``max_len`` degrees.

    A point meets its successor by an equi-join on (key, idx), so a long path is spread over all
    tasks instead of being sorted in one.
    """
    successor = points.select(
        key, (F.col("idx") - 1).alias("idx"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon")
    )
    length = F.hypot(F.col("_lat") - F.col("lat"), F.col("_lon") - F.col("lon"))
    pieces = F.greatest(F.lit(1), F.ceil(length / F.lit(max_len)))
    share = F.col("step") / F.col("_pieces")

    def between(name: str) -> Column:
        here = F.col(name)
        return F.when(F.col("step") == 0, here).otherwise(
            here + (F.col("_" + name) - here) * share
        )

    return (
        points.join(successor, [key, "idx"], "left")
        .withColumn("_pieces", F.coalesce(pieces, F.lit(1)).cast("bigint"))
        .withColumn("step", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_pieces") - 1)))
        .select(key, "idx", "step", between("lat").alias("lat"), between("lon").alias("lon"))
    )
