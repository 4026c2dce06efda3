"""Roll-ups of multi-sensor anomalies and of their explanations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.functions import timing
from sensorlens.operators.ranges import (
    Moment,
    for_asset,
    for_tags,
    in_range,
    only_anomalies,
    single_asset,
)
from sensorlens.operators.reshape import expand_changes


def anomaly_severity(
    anomalies: DataFrame,
    asset: str | None = None,
    start: Moment | None = None,
    end: Moment | None = None,
) -> DataFrame:
    """Severity over time of one asset (or, without one, of each)."""
    rows = for_asset(in_range(anomalies, start, end), asset)
    return rows.select(*([] if asset else ["asset"]), "timestamp", "severity")


def anomaly_details(
    anomalies: DataFrame,
    asset: str | None = None,
    start: Moment | None = None,
    end: Moment | None = None,
) -> DataFrame:
    rows = for_asset(in_range(anomalies, start, end), asset)
    return only_anomalies(rows).drop("is_anomaly")


def bookends(
    telemetry: DataFrame,
    start: Moment | None = None,
    end: Moment | None = None,
    tags: str | Sequence[str] | DataFrame | None = None,
) -> DataFrame:
    """First and last reading of the selection; one row, nulls if there is none."""
    return for_tags(in_range(telemetry, start, end), tags).agg(
        F.min("timestamp").alias("actual_start"), F.max("timestamp").alias("actual_end")
    )


def bookends_by_asset(
    telemetry: DataFrame,
    tags: DataFrame,
    start: Moment | None = None,
    end: Moment | None = None,
) -> DataFrame:
    """The same per asset. Tags are reduced to two timestamps before they meet the dimension."""
    per_tag = (
        in_range(telemetry, start, end)
        .groupBy("tag")
        .agg(F.min("timestamp").alias("actual_start"), F.max("timestamp").alias("actual_end"))
    )
    return (
        per_tag.join(tags.select("tag", "asset"), "tag")
        .groupBy("asset")
        .agg(
            F.min("actual_start").alias("actual_start"), F.max("actual_end").alias("actual_end")
        )
    )


def pad_bookends(anomalies: DataFrame, ends: DataFrame) -> DataFrame:
    """Adds two marker rows per bookend row, ``constant`` 0 and null measures, so that a chart
    spans the whole selection. ``ends`` has ``asset``, ``actual_start`` and ``actual_end``."""
    moments = F.explode(F.array("actual_start", "actual_end"))
    padding = ends.select("asset", moments.alias("timestamp"), F.lit(0).alias("constant")).filter(
        F.col("asset").isNotNull() & F.col("timestamp").isNotNull()
    )
    return anomalies.unionByName(padding, allowMissingColumns=True)


def _binned(padded: DataFrame, step: str | int) -> DataFrame:
    return padded.groupBy(
        timing.time_bin(F.col("timestamp"), step).alias("timestamp"), "asset"
    ).agg(
        F.max("score").alias("score"),
        F.max("severity").alias("severity"),
        F.count("*").alias("anomaly_count"),
        F.max("constant").alias("constant"),
    )


def _severe(
    anomalies: DataFrame, start: Moment | None, end: Moment | None, severity: float
) -> DataFrame:
    return only_anomalies(in_range(anomalies, start, end)).filter(F.col("severity") >= severity)


def anomalies_binned(
    anomalies: DataFrame,
    telemetry: DataFrame,
    tags: DataFrame,
    chosen: str | Sequence[str] | DataFrame | None,
    step: str | int,
    start: Moment | None = None,
    end: Moment | None = None,
    severity: float = 0.05,
) -> DataFrame:
    """Anomalies per bin of the asset that owns the chosen tags; empty for several assets.

    Counts include the two bookend rows.
    """
    owner = single_asset(tags, chosen).select("asset").scalar()
    ends = bookends(telemetry, start, end, chosen).withColumn("asset", owner)
    mine = _severe(anomalies, start, end, severity).filter(F.col("asset") == owner)
    return _binned(pad_bookends(mine, ends), step)


def anomalies_binned_by_asset(
    anomalies: DataFrame,
    telemetry: DataFrame,
    tags: DataFrame,
    step: str | int,
    start: Moment | None = None,
    end: Moment | None = None,
    asset: str | None = None,
    severity: float = 0.05,
) -> DataFrame:
    """The same for a given asset, or for every asset in one plan."""
    owned = for_asset(tags, asset)
    source = telemetry if asset is None else for_tags(telemetry, owned)
    ends = bookends_by_asset(source, owned, start, end)
    mine = for_asset(_severe(anomalies, start, end, severity), asset)
    return _binned(pad_bookends(mine, ends), step)


def tag_contributions(
    explanations: DataFrame,
    asset: str | None = None,
    start: Moment | None = None,
    end: Moment | None = None,
    severity: float = 0.05,
) -> DataFrame:
    """Contribution of each tag per minute, weighted by severity."""
    share = F.col("contribution_score")
    return (
        for_asset(_severe(explanations, start, end, severity), asset)
        .groupBy("tag", timing.time_bin(F.col("timestamp"), "1min").alias("timestamp"))
        .agg(
            F.count("*").alias("records"),
            (100 * F.sum(F.col("severity") * share)).alias("weighted_score"),
            F.avg(share).alias("average"),
            F.min(share).alias("minimum"),
            F.max(share).alias("maximum"),
        )
    )


def pair_contributions(
    explanations: DataFrame,
    asset: str | None = None,
    start: Moment | None = None,
    end: Moment | None = None,
    severity: float = 0.05,
) -> DataFrame:
    """Correlation change per pair of tags, weighted by severity and contribution."""
    change = F.col("correlation_change")
    weight = F.col("severity") * F.col("contribution_score") * change
    rows = for_asset(_severe(explanations, start, end, severity), asset)
    return (
        expand_changes(rows)
        .groupBy("tag", "secondary_tag")
        .agg(
            F.count("*").alias("records"),
            (1000 * F.sum(weight)).alias("weighted_score"),
            F.avg(change).alias("average"),
            F.min(change).alias("minimum"),
            F.max(change).alias("maximum"),
        )
    )


# The columns a report can rank tags by.
CONTRIBUTION_METRICS = ("weighted_score", "average")


def contribution_metric(pairs: DataFrame, metric: str = "weighted_score") -> DataFrame:
    """Chosen metric of :func:`pair_contributions`, summed per tag."""
    if metric not in CONTRIBUTION_METRICS:
        raise ValueError(f"metric {metric!r} is not one of {CONTRIBUTION_METRICS}")
    return pairs.groupBy("tag").agg(F.sum(metric).alias("contribution_metric"))
