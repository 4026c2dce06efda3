"""Alert rules on anomaly severity, for batch tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.operators.ordering import sustained_runs

# Rule names and the headline of a message.
THRESHOLD_RULE = "Alert - Severity above 0.2"
SUSTAINED_RULE = "Alert - Severity above 0.1 for 10 minutes"
HEADLINE = "The condition for 'severity alert' has been met"

ALERT_COLUMNS = ("rule", "asset", "timestamp", "severity", "headline")


def as_alerts(df: DataFrame, rule: str) -> DataFrame:
    return df.withColumn("rule", F.lit(rule)).withColumn("headline", F.lit(HEADLINE)).select(
        *ALERT_COLUMNS
    )


def threshold_alerts(df: DataFrame, threshold: float = 0.2) -> DataFrame:
    """An alert for every event whose severity is above the threshold; batch or stream."""
    return as_alerts(df.filter(F.col("severity") > threshold), THRESHOLD_RULE)


def sustained_alerts(
    df: DataFrame,
    threshold: float = 0.1,
    period: str | int = "10min",
    max_gap: str | int | None = None,
) -> DataFrame:
    """One alert per run in which the severity stayed at or above the threshold."""
    return as_alerts(sustained_runs(df, threshold, period, max_gap), SUSTAINED_RULE)


def dedup_anomalies(df: DataFrame) -> DataFrame:
    """One row per (asset, timestamp). A stream needs a watermark and drops repeats within it."""
    keys = ["asset", "timestamp"]
    if df.isStreaming:
        return df.dropDuplicatesWithinWatermark(keys)
    rest = [c for c in df.columns if c not in keys]
    kept = F.max(F.struct(*rest)).alias("_kept")
    return df.groupBy(*keys).agg(kept).select(*keys, "_kept.*").select(*df.columns)
