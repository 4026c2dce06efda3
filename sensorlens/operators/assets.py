"""Dimension lookups, map layers and pick lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlens.functions import text
from sensorlens.operators.ordering import time_chunk
from sensorlens.operators.ranges import Moment, for_asset, in_range, only_anomalies

_MODEL = "struct<effective_date: timestamp, model_uri: string, sliding_window: int>"
MAP_COLUMNS = ("AssetID", "AssetType", "Manufacturer", "Model", "Latitude", "Longitude")


def asset_telemetry(tags: DataFrame, telemetry: DataFrame, asset: str | None = None) -> DataFrame:
    """Readings of an asset's tags, with the asset. The dimension is small; Catalyst broadcasts
    it when its size allows and otherwise joins by shuffle."""
    owned = for_asset(tags, asset).select("tag", "asset")
    return telemetry.join(owned, "tag")


def enrich_assets(df: DataFrame, tags: DataFrame, assets: DataFrame) -> DataFrame:
    """Adds the asset of each tag and the attributes of that asset. Every tag has an asset, so
    the joins are inner; the two dimensions are joined to each other first."""
    owners = tags.select("tag", "asset").join(
        assets.withColumnRenamed("AssetID", "asset"), "asset"
    )
    return df.join(owners, "tag")


def enrich_stream(stream: DataFrame, assets: DataFrame) -> DataFrame:
    """Adds asset attributes to streamed anomalies; unknown assets keep their rows."""
    return stream.join(assets.withColumnRenamed("AssetID", "asset"), "asset", "left")


def _asof(rows: DataFrame, facts: DataFrame, since: str, fact: Column, chunk: str | int) -> DataFrame:
    """``rows`` as a struct ``_row``, with the last ``_fact`` of their ``asset`` that began at or before
    their ``timestamp``; null where there is none, or where asset or time is null.

    ``fact`` is a struct of ``facts`` whose first field is ``since``; of equal times the largest counts.
    Both tables become one in order of time, facts first: the last fact is carried over the rows behind
    it within a chunk of time, and from chunk to chunk over one summary for each.
    """
    fields = F.struct(*[F.col(c) for c in rows.columns])
    events = rows.select("asset", F.col("timestamp").alias("_at"), F.lit(1).alias("_side"), fields.alias("_row"))
    known = facts.filter(F.col("asset").isNotNull() & F.col(since).isNotNull()).select(
        "asset", F.col(since).alias("_at"), F.lit(0).alias("_side"), fact.alias("_fact")
    )
    both = events.unionByName(known, allowMissingColumns=True).withColumn("_chunk", time_chunk("_at", chunk))
    running = Window.partitionBy("asset", "_chunk").orderBy("_at", "_side", "_fact").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    earlier = Window.partitionBy("asset").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        both.groupBy("asset", "_chunk")
        .agg(F.max("_fact").alias("_newest"))
        .select("asset", "_chunk", F.last("_newest", ignorenulls=True).over(earlier).alias("_carried"))
    )
    here = F.last("_fact", ignorenulls=True).over(running)
    found = both.withColumn("_here", here).filter("_side = 1").join(carried, ["asset", "_chunk"], "left")
    return found.select("_row", F.when(F.col("_at").isNotNull(), F.coalesce("_here", "_carried")).alias("_fact"))


def model_asof(models: DataFrame, at: Moment | DataFrame, chunk: str | int = "1day") -> DataFrame:
    """The model in force: newest ``effective_date`` not after the moment, ties to the larger uri.

    ``at`` is a moment (one row per asset), or a table with ``asset`` and ``timestamp``, for which
    each of its rows gets the model of its asset at that time; nulls where there is none, or where
    asset or time is null.
    """
    newest = F.struct("effective_date", "model_uri", "sliding_window")
    if not isinstance(at, DataFrame):
        return (
            in_range(models, None, at, "effective_date")
            .groupBy("asset")
            .agg(F.max(newest).alias("_model"))
            .select("asset", "_model.model_uri", "_model.sliding_window", "_model.effective_date")
        )
    return _asof(at, models, "effective_date", newest.cast(_MODEL), chunk).select(
        "_row.*", "_fact.model_uri", "_fact.sliding_window", "_fact.effective_date"
    )


def attributes_asof(rows: DataFrame, history: DataFrame, chunk: str | int = "1day") -> DataFrame:
    """``rows`` (``asset``, ``timestamp``) with the attributes that their asset had at their time.

    ``history`` holds ``AssetID``, ``valid_from``, ``version`` and attributes, a row for each change;
    the newest ``valid_from`` not after the row counts, then the largest ``version``, then the largest
    attributes. Rows of unknown assets, of times before the first change, and without asset or time
    are kept with nulls. An attribute named like a column of ``rows`` raises ``ValueError``.
    """
    attributes = [c for c in history.columns if c not in ("AssetID", "valid_from", "version")]
    clashing = set(attributes + ["valid_from"]) & set(rows.columns)
    if clashing:
        raise ValueError(f"columns in both tables: {sorted(clashing)}")
    facts = history.withColumnRenamed("AssetID", "asset").join(
        rows.select("asset").distinct(), "asset", "left_semi"
    )
    fact = F.struct("valid_from", "version", *attributes)
    return _asof(rows, facts, "valid_from", fact, chunk).select(
        "_row.*", "_fact.valid_from", *[F.col("_fact")[c].alias(c) for c in attributes]
    )


def _troubled(
    anomalies: DataFrame, start: Moment | None, end: Moment | None, severity: float
) -> DataFrame:
    return only_anomalies(in_range(anomalies, start, end)).filter(F.col("severity") >= severity)


def assets_with_anomalies(
    anomalies: DataFrame,
    assets: DataFrame,
    start: Moment | None = None,
    end: Moment | None = None,
    severity: float = 0.05,
) -> DataFrame:
    """Map layer: assets with anomalies, how many, and the worst one."""
    counted = (
        _troubled(anomalies, start, end, severity)
        .groupBy(F.col("asset").alias("AssetID"))
        .agg(F.count("*").alias("anomaly_count"), F.max("severity").alias("max_severity"))
    )
    return assets.select(*MAP_COLUMNS).join(counted, "AssetID")


def unhealthy_assets(
    anomalies: DataFrame,
    assets: DataFrame,
    start: Moment | None = None,
    end: Moment | None = None,
    severity: float = 0.05,
) -> DataFrame:
    hit = _troubled(anomalies, start, end, severity).select(F.col("asset").alias("AssetID"))
    return assets.join(hit.distinct(), "AssetID", "left_semi")


def healthy_assets(
    anomalies: DataFrame,
    assets: DataFrame,
    start: Moment | None = None,
    end: Moment | None = None,
    severity: float = 0.05,
) -> DataFrame:
    hit = _troubled(anomalies, start, end, severity).select(F.col("asset").alias("AssetID"))
    return assets.join(hit.distinct(), "AssetID", "left_anti")


def latest_vehicle_positions(
    events: DataFrame, extra: Sequence[str] = ()
) -> DataFrame:
    """Newest position per vehicle; an aggregate, so a busy vehicle is reduced map-side."""
    newest = F.max_by(
        F.struct("lat", "lon", *extra), F.struct("timestamp", "event_id")
    ).alias("_at")
    return (
        events.groupBy("vehicle_id")
        .agg(newest)
        .select("vehicle_id", *[f"_at.{c}" for c in ("lat", "lon", *extra)])
    )


def asset_labels(assets: DataFrame, asset: str | None = None) -> DataFrame:
    rows = for_asset(assets, asset, "AssetID")
    return rows.select("AssetID", text.asset_label().alias("label"))


def asset_pick_list(assets: DataFrame) -> DataFrame:
    return assets.select("AssetID")


def tag_pick_list(tags: DataFrame, asset: str | None = None) -> DataFrame:
    rows = for_asset(tags, asset)
    return rows.select("tag", text.tag_label().alias("label")).orderBy("tag")
