"""Streaming jobs, run over the replayed history until it is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens import session
from sensorlens.functions.text import safe_cast
from sensorlens.operators import alerts
from sensorlens.operators.assets import enrich_stream
from sensorlens.operators.reshape import expand_interpretation, expand_metrics
from sensorlens.plans import replay
from sensorlens.plans.asset_queries import alert_sql, runs_sql
from sensorlens.plans.fixtures import START, Tables, sql
from sensorlens.plans.registry import query, rounded
from sensorlens.sources import streams
from sensorlens.streaming import ingest
from sensorlens.streaming.alerts import sustained_alerts_stream
from sensorlens.streaming.dimension import enrich_changing, publish_dimension

_ANOMALOUS = "SELECT * FROM anomalies WHERE is_anomaly"


def _paths(t: Tables, name: str) -> tuple[str, str]:
    base = session.scratch_dir(t.spark, name)
    return f"{base}/table", f"{base}/checkpoint"


def _drained(t: Tables, stream: DataFrame, name: str) -> DataFrame:
    path, checkpoint = _paths(t, name)
    streams.write_stream(stream, path, checkpoint).awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(path)


def _anomaly_stream(t: Tables) -> DataFrame:
    return streams.read_anomaly_stream(t.spark, replay.anomaly_messages(t))


@query(
    "anomaly_stream",
    sql("anomalies", f"SELECT asset, timestamp, severity, CAST(1 AS BIGINT) AS is_anomaly FROM ({_ANOMALOUS})"),
)
def _(t):
    out = _drained(t, ingest.anomaly_rows(_anomaly_stream(t)), "anomaly-stream")
    return out.filter(F.col("asset") != replay.CLOSING)


@query(
    "explanation_stream",
    sql(
        "explanations",
        "SELECT asset, timestamp, tag, severity, is_anomaly, contribution_score FROM explanations",
    ),
)
def _(t):
    rows = expand_interpretation(ingest.all_anomaly_rows(_anomaly_stream(t)))
    return _drained(t, rows, "explanation-stream").select(
        "asset", "timestamp", "tag", "severity", "is_anomaly", "contribution_score"
    )


@query(
    "telemetry_ingest",
    sql(
        "telemetry",
        "SELECT date_trunc('second', timestamp) AS timestamp, tag, value FROM telemetry",
    ),
)
def _(t):
    path, checkpoint = _paths(t, "telemetry-ingest")
    stream = streams.read_telemetry_stream(t.spark, replay.metric_messages(t))
    ingest.telemetry_ingest(stream, path, checkpoint).awaitTermination()
    stored = t.spark.read.parquet(path).select("timestamp", "tag", "value")
    return stored.filter(F.col("tag") != replay.CLOSING)


@query("vehicle_ingest", sql("vehicles", "SELECT * REPLACE (CAST(event_id AS VARCHAR) AS event_id) FROM vehicles"))
def _(t):
    path, checkpoint = _paths(t, "vehicle-ingest")
    stream = streams.read_vehicle_stream(t.spark, replay.vehicle_messages(t))
    ingest.vehicle_ingest(stream, path, checkpoint).awaitTermination()
    return t.spark.read.parquet(path).select("vehicle_id", "event_id", "timestamp", "lat", "lon")


@query(
    "live_trend",
    sql(
        "telemetry",
        "SELECT tag, time_bucket(INTERVAL 10 SECOND, timestamp) AS timestamp, "
        "round(avg(value), 6) AS value FROM telemetry GROUP BY ALL",
    ),
)
def _(t):
    stream = streams.read_telemetry_stream(t.spark, replay.metric_messages(t))
    trend = ingest.live_trend(expand_metrics(stream), "10s", delay=replay.DELAY)
    out = rounded(_drained(t, trend, "live-trend"), "value")
    return out.filter(F.col("tag") != replay.CLOSING)


@query(
    "dedup_stream",
    sql("anomalies", f"SELECT asset, timestamp, severity, CAST(1 AS BIGINT) AS is_anomaly FROM ({_ANOMALOUS})"),
)
def _(t):
    rows = ingest.anomaly_rows(_anomaly_stream(t))
    # Each message is delivered twice, as when a scoring run is repeated.
    twice = rows.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    out = alerts.dedup_anomalies(ingest.with_tolerance(twice, replay.DELAY))
    return _drained(t, out, "dedup-stream").filter(F.col("asset") != replay.CLOSING)


@query(
    "threshold_alerts_stream",
    sql(
        "anomalies",
        alert_sql(alerts.THRESHOLD_RULE, f"{_ANOMALOUS} AND severity > 0.2"),
    ),
)
def _(t):
    rows = alerts.threshold_alerts(ingest.anomaly_rows(_anomaly_stream(t)))
    path, checkpoint = _paths(t, "alerts")
    alerts_query = streams.write_alerts(rows, path, checkpoint)
    alerts_query.awaitTermination()
    return t.spark.read.schema(rows.schema).parquet(path)


@query(
    "sustained_alerts_stream",
    sql("anomalies", alert_sql(alerts.SUSTAINED_RULE, runs_sql(f"({_ANOMALOUS})"))),
)
def _(t):
    rows = ingest.anomaly_rows(_anomaly_stream(t))
    return _drained(t, sustained_alerts_stream(rows, delay=replay.DELAY), "sustained")


@query(
    "fan_out",
    sql(
        "anomalies",
        "SELECT 'raw' AS branch, asset, timestamp, severity FROM anomalies UNION ALL "
        f"SELECT 'alert', asset, timestamp, severity FROM ({_ANOMALOUS}) WHERE severity > 0.2",
    ),
)
def _(t):
    path, checkpoint = _paths(t, "fan-out")
    streams.fan_out(
        ingest.all_anomaly_rows(_anomaly_stream(t)),
        f"{path}/raw",
        checkpoint,
        lambda batch: alerts.threshold_alerts(batch.filter("is_anomaly")),
        f"{path}/alerts",
    ).awaitTermination()
    raw = t.spark.read.parquet(f"{path}/raw").withColumn("branch", F.lit("raw"))
    sent = t.spark.read.parquet(f"{path}/alerts").withColumn("branch", F.lit("alert"))
    columns = ["branch", "asset", "timestamp", "severity"]
    both = raw.select(*columns).unionByName(sent.select(*columns))
    return both.filter(F.col("asset") != replay.CLOSING)


@query(
    "enriched_stream",
    sql(
        "anomalies assets",
        "SELECT asset, timestamp, severity, AssetCode, Latitude FROM "
        f"({_ANOMALOUS}) LEFT JOIN assets ON AssetID = asset",
    ),
)
def _(t):
    rows = enrich_stream(ingest.anomaly_rows(_anomaly_stream(t)), t.assets)
    out = _drained(t, rows, "enriched").filter(F.col("asset") != replay.CLOSING)
    return out.select("asset", "timestamp", "severity", "AssetCode", "Latitude")


_MOVED = "AssetID string, valid_from timestamp, AssetCode string, Latitude double"


@query(
    "enriched_changes_stream",
    sql(
        "anomalies assets",
        f"""
        WITH weeks AS (SELECT unnest(range(0, 6)) AS week),
        history AS (
            SELECT AssetID, TIMESTAMP '{START}' + to_days(CAST(7 * week AS INTEGER)) AS valid_from,
                concat(AssetCode, '-', week) AS AssetCode, Latitude + 0.5 * week AS Latitude
            FROM assets, weeks WHERE week = 0 OR (CAST(substr(AssetID, 2) AS BIGINT) + week) % 2 = 0)
        SELECT a.asset, a.timestamp, a.severity, h.valid_from, h.AssetCode, h.Latitude
        FROM ({_ANOMALOUS}) a ASOF LEFT JOIN history h ON a.asset = h.AssetID AND a.timestamp >= h.valid_from
        """,
    ),
)
def _(t):
    path, checkpoint = _paths(t, "enriched-changes")
    number = F.substring("AssetID", 2, 20).cast("bigint")

    def move(week: int) -> None:
        """All assets in week 0, and half of them in each later week."""
        changed = t.assets.filter((F.lit(week) == 0) | ((number + week) % 2 == 0)).select(
            "AssetID",
            (F.lit(START).cast("timestamp") + F.make_dt_interval(F.lit(7 * week))).alias("valid_from"),
            F.concat("AssetCode", F.lit(f"-{week}")).alias("AssetCode"),
            (F.col("Latitude") + 0.5 * week).alias("Latitude"),
        )
        publish_dimension(changed, f"{path}/dimension", week)

    def before(spark, batch_id: int) -> None:
        # Batch N ends with week 2 N + 1 at the latest.
        for week in (2 * batch_id + 1, 2 * batch_id + 2):
            if week < 6:
                move(week)

    move(0)
    messages = replay.anomaly_messages(t)
    stream = streams.read_anomaly_stream(t.spark, messages, max_files=replay.files_of(messages, 2))
    enrich_changing(
        ingest.anomaly_rows(stream), f"{path}/dimension", _MOVED, f"{path}/rows", checkpoint, before=before
    ).awaitTermination()
    out = t.spark.read.parquet(f"{path}/rows").filter(F.col("asset") != replay.CLOSING)
    return out.select("asset", "timestamp", "severity", "valid_from", "AssetCode", "Latitude")


@query(
    "quarantined_rows",
    "SELECT event_id, props FROM events "
    "WHERE TRY_CAST(concat('2024-01-', substr(props, 7, 2)) AS TIMESTAMP) IS NULL",
)
def _(t):
    # Wire times made from free text, many of which are no day of January.
    wire = F.concat(F.lit("2024-01-"), F.substring("props", 7, 2))
    rows = t.events.select("event_id", "props", safe_cast(wire, "timestamp").alias("timestamp"))
    bad = ingest.split_bad_times(rows)[1]
    return bad.select("event_id", "props")
