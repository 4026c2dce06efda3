"""Files and tables: dimensions, telemetry, routes, message envelopes."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlens import session
from sensorlens.operators import reshape
from sensorlens.operators.assets import asset_telemetry
from sensorlens.plans.fixtures import sql
from sensorlens.plans.registry import query
from sensorlens.sources import files, schemas, streams


@query("reference_csv", sql("features", "SELECT * FROM features"))
def _(t):
    path = session.scratch_dir(t.spark, "features-csv")
    t.features.write.option("header", True).csv(path)
    return files.read_reference_csv(t.spark, path, schemas.FEATURES)


@query("telemetry_table", sql("telemetry", "SELECT timestamp, tag, value FROM telemetry"))
def _(t):
    path = session.scratch_dir(t.spark, "telemetry")
    late = F.col("timestamp") >= F.lit("2024-01-16").cast("timestamp")
    files.append_telemetry(t.telemetry.filter(~late), path)
    files.append_telemetry(t.telemetry.filter(late), path)
    return files.read_telemetry(t.spark, path)


@query("telemetry_table_retried", sql("telemetry", "SELECT timestamp, tag, value FROM telemetry"))
def _(t):
    path = session.scratch_dir(t.spark, "telemetry")
    late = F.col("timestamp") >= F.lit("2024-01-16").cast("timestamp")
    files.append_telemetry(t.telemetry.filter(~late), path, 4, batch="2024-01-a")
    # A first try that wrote a part, and the whole append twice.
    files.append_telemetry(t.telemetry.filter(late & (F.col("value") > 0)), path, 4, batch="2024-01-b")
    for _ in range(2):
        files.append_telemetry(t.telemetry.filter(late), path, 4, batch="2024-01-b")
    return files.read_telemetry(t.spark, path)


@query(
    "telemetry_table_range",
    sql(
        "telemetry",
        "SELECT timestamp, tag, value FROM telemetry "
        "WHERE timestamp BETWEEN '2024-01-03 06:00:00' AND '2024-01-28 18:00:00'",
    ),
)
def _(t):
    path = session.scratch_dir(t.spark, "telemetry")
    files.append_telemetry(t.telemetry, path)
    return files.read_telemetry(t.spark, path, "2024-01-03 06:00:00", "2024-01-28 18:00:00")


def _routes(t):
    """One route document per event, of three points, in files that hold an array of documents."""
    value = F.col("value")
    points = F.array(
        *[
            F.array(F.lit(30.0) + value * (k / 100.0), F.lit(-98.0) - value * (k / 100.0))
            for k in range(3)
        ]
    )
    documents = t.events.select(
        F.col("event_id").cast("string").alias("route_id"),
        points[0].alias("centroid_coordinates"),
        points.alias("points"),
        F.lit(3).alias("total_points"),
        F.lit(0).alias("current_point"),
    )
    path = session.scratch_dir(t.spark, "routes")
    part = F.floor(F.col("route_id").cast("bigint") / 1000)
    arrays = documents.groupBy(part.alias("part")).agg(F.to_json(F.collect_list(F.struct("*"))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return files.read_routes(t.spark, path)


@query(
    "route_point_counts",
    "SELECT CAST(event_id AS VARCHAR) AS route_id, 3 AS point_count FROM events",
)
def _(t):
    return files.route_point_counts(_routes(t))


@query(
    "route_points",
    "SELECT CAST(event_id AS VARCHAR) AS route_id, k AS idx, "
    "30.0::DOUBLE + value * (k / 100.0::DOUBLE) AS lat, "
    "-98.0::DOUBLE - value * (k / 100.0::DOUBLE) AS lon "
    "FROM events, (SELECT unnest(range(3)) AS k)",
)
def _(t):
    return reshape.route_points(_routes(t))


@query(
    "metric_envelope_expand",
    sql(
        "telemetry",
        "SELECT date_trunc('second', timestamp) AS timestamp, tag, value FROM telemetry",
    ),
)
def _(t):
    rows = asset_telemetry(t.tags, t.telemetry)
    messages = files.to_metric_envelopes(rows).select("value")
    return reshape.expand_metrics(streams.parse_messages(messages, schemas.METRIC_ENVELOPE))


@query(
    "anomaly_envelope_sizes",
    sql(
        "anomalies",
        """
        WITH n AS (SELECT asset, (row_number() OVER (PARTITION BY asset ORDER BY timestamp, score)
            - 1) // 10 AS message FROM anomalies)
        SELECT asset, message, CAST(count(*) AS INTEGER) AS rows FROM n GROUP BY ALL
        """,
    ),
)
def _(t):
    return files.to_anomaly_envelopes(t.anomalies).select("asset", "message", "rows")


@query(
    "anomaly_envelope_expand",
    sql(
        "anomalies",
        "SELECT asset, timestamp, score, severity, CAST(is_anomaly AS BIGINT) AS is_anomaly "
        "FROM anomalies",
    ),
)
def _(t):
    messages = files.to_anomaly_envelopes(t.anomalies).select("value")
    parsed = streams.parse_messages(messages, schemas.ANOMALY_ENVELOPE)
    rows = reshape.project_anomaly_fields(
        reshape.expand_array(parsed.select("anomalies"), "anomalies")
    )
    return rows.drop("interpretation")
