"""Anomaly roll-ups, dimensions, map layers, pick lists, reshaping and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlens.operators import alerts, anomalies, assets, ordering, ranges, reshape
from sensorlens.plans.fixtures import KINDS, sql
from sensorlens.plans.registry import query, rounded

_A00 = tuple(f"A00_{kind}" for kind in KINDS)


# -- anomalies ----------------------------------------------------------------------------------


@query("anomaly_severity", sql("anomalies", "SELECT asset, timestamp, severity FROM anomalies"))
def _(t):
    return anomalies.anomaly_severity(t.anomalies)


@query(
    "anomaly_severity_of_asset",
    sql(
        "anomalies",
        "SELECT timestamp, severity FROM anomalies WHERE asset = 'A01' "
        "AND timestamp BETWEEN '2024-01-02 00:00:00' AND '2024-01-29 12:00:00'",
    ),
)
def _(t):
    return anomalies.anomaly_severity(
        t.anomalies, "A01", "2024-01-02 00:00:00", "2024-01-29 12:00:00"
    )


@query(
    "anomaly_details",
    sql("anomalies", "SELECT asset, timestamp, score, severity FROM anomalies WHERE is_anomaly"),
)
def _(t):
    return anomalies.anomaly_details(t.anomalies)


@query(
    "bookends",
    sql(
        "telemetry",
        "SELECT min(timestamp) AS actual_start, max(timestamp) AS actual_end FROM telemetry",
    ),
)
def _(t):
    return anomalies.bookends(t.telemetry)


@query(
    "bookends_padded",
    sql(
        "telemetry tags anomalies",
        """
        WITH ends AS (
            SELECT asset, min(timestamp) AS s, max(timestamp) AS e
            FROM telemetry JOIN tags USING (tag) GROUP BY asset)
        SELECT asset, timestamp, score, severity, is_anomaly, CAST(NULL AS INTEGER) AS constant
        FROM anomalies
        UNION ALL SELECT asset, s, NULL, NULL, NULL, 0 FROM ends
        UNION ALL SELECT asset, e, NULL, NULL, NULL, 0 FROM ends
        """,
    ),
)
def _(t):
    ends = anomalies.bookends_by_asset(t.telemetry, t.tags)
    return anomalies.pad_bookends(t.anomalies, ends)


def _binned(where: str) -> str:
    return sql(
        "telemetry tags anomalies",
        f"""
        WITH ends AS (
            SELECT asset, min(timestamp) AS s, max(timestamp) AS e
            FROM telemetry JOIN tags USING (tag) {where} GROUP BY asset),
        rows AS (
            SELECT asset, timestamp, score, severity, CAST(NULL AS INTEGER) AS constant
            FROM anomalies JOIN (SELECT asset FROM ends) USING (asset)
            WHERE is_anomaly AND severity >= 0.05
            UNION ALL SELECT asset, s, NULL, NULL, 0 FROM ends
            UNION ALL SELECT asset, e, NULL, NULL, 0 FROM ends)
        SELECT asset, time_bucket(INTERVAL 6 HOUR, timestamp) AS timestamp, max(score) AS score,
            max(severity) AS severity, count(*) AS anomaly_count, max(constant) AS constant
        FROM rows GROUP BY ALL
        """,
    )


@query("anomalies_binned", _binned("WHERE asset = 'A00'"))
def _(t):
    return anomalies.anomalies_binned(t.anomalies, t.telemetry, t.tags, _A00, "6hour")


@query("anomalies_binned_by_asset", _binned(""))
def _(t):
    return anomalies.anomalies_binned_by_asset(t.anomalies, t.telemetry, t.tags, "6hour")


@query(
    "single_asset_check",
    sql(
        "tags",
        f"""
        SELECT count(DISTINCT asset) AS asset_count, count(DISTINCT asset) = 1 AS is_one_asset,
            CASE WHEN count(DISTINCT asset) = 1 THEN min(asset) END AS asset
        FROM tags WHERE tag IN {_A00}
        """,
    ),
)
def _(t):
    return ranges.single_asset(t.tags, _A00)


@query(
    "several_assets_check",
    sql(
        "tags",
        """
        SELECT count(DISTINCT asset) AS asset_count, count(DISTINCT asset) = 1 AS is_one_asset,
            CASE WHEN count(DISTINCT asset) = 1 THEN min(asset) END AS asset FROM tags
        """,
    ),
)
def _(t):
    return ranges.single_asset(t.tags, None)


@query("asset_count", sql("tags", "SELECT count(DISTINCT asset) AS asset_count FROM tags"))
def _(t):
    return ranges.asset_count(t.tags, None)


@query("any_asset", sql("tags", "SELECT min(asset) AS asset FROM tags"))
def _(t):
    return ranges.any_asset(t.tags, None)


@query(
    "tag_contributions",
    sql(
        "explanations",
        """
        SELECT tag, date_trunc('minute', timestamp) AS timestamp, count(*) AS records,
            round(100 * sum(severity * contribution_score), 6) AS weighted_score,
            round(avg(contribution_score), 6) AS average, min(contribution_score) AS minimum,
            max(contribution_score) AS maximum
        FROM explanations WHERE is_anomaly AND severity >= 0.05 GROUP BY ALL
        """,
    ),
)
def _(t):
    return rounded(anomalies.tag_contributions(t.explanations), "weighted_score", "average")


_PAIRS = """
    rows AS (
        SELECT tag, severity, contribution_score, unnest(changed_variables) AS secondary_tag,
            unnest(changed_values) AS change
        FROM explanations WHERE is_anomaly AND severity >= 0.05),
    pairs AS (
        SELECT tag, secondary_tag, count(*) AS records,
            1000 * sum(severity * contribution_score * change) AS weighted_score,
            avg(change) AS average, min(change) AS minimum, max(change) AS maximum
        FROM rows GROUP BY ALL)"""


@query(
    "pair_contributions",
    sql(
        "explanations",
        f"WITH {_PAIRS} SELECT * REPLACE (round(weighted_score, 6) AS weighted_score, "
        "round(average, 6) AS average) FROM pairs",
    ),
)
def _(t):
    return rounded(anomalies.pair_contributions(t.explanations), "weighted_score", "average")


def _metric(metric: str) -> None:
    @query(
        f"contribution_metric_{metric}",
        sql(
            "explanations",
            f"WITH {_PAIRS} SELECT tag, round(sum({metric}), 6) AS contribution_metric "
            "FROM pairs GROUP BY tag",
        ),
    )
    def _(t):
        pairs = anomalies.pair_contributions(t.explanations)
        return rounded(anomalies.contribution_metric(pairs, metric), "contribution_metric")


for _name in anomalies.CONTRIBUTION_METRICS:
    _metric(_name)


# -- dimensions and map layers ------------------------------------------------------------------


@query(
    "asset_label",
    sql(
        "assets",
        "SELECT AssetID, concat(AssetID, ': ', AssetCode, ' - ', AssetType, ' (', Manufacturer, "
        "' - ', Model, ')') AS label FROM assets",
    ),
)
def _(t):
    return assets.asset_labels(t.assets)


@query("asset_pick_list", sql("assets", "SELECT AssetID FROM assets"))
def _(t):
    return assets.asset_pick_list(t.assets)


@query(
    "tag_pick_list",
    sql("tags", "SELECT tag, concat(tag, ' (', metric, ')') AS label FROM tags ORDER BY tag"),
)
def _(t):
    return assets.tag_pick_list(t.tags)


@query(
    "asset_attributes",
    sql(
        "assets",
        """
        SELECT asset AS "AssetID", "Attribute", "Value" FROM (
            UNPIVOT (SELECT AssetID AS asset, AssetID, AssetCode, AssetType, Manufacturer, Model,
                CAST(Latitude AS VARCHAR) AS Latitude, CAST(Longitude AS VARCHAR) AS Longitude
                FROM assets)
            ON COLUMNS(* EXCLUDE (asset)) INTO NAME "Attribute" VALUE "Value")
        """,
    ),
)
def _(t):
    keyed = t.assets.withColumn("asset", F.col("AssetID"))
    return reshape.narrow(keyed, ["asset"]).withColumnRenamed("asset", "AssetID")


@query(
    "asset_telemetry",
    sql("telemetry tags", "SELECT telemetry.*, asset FROM telemetry JOIN tags USING (tag)"),
)
def _(t):
    return assets.asset_telemetry(t.tags, t.telemetry).select(
        "timestamp", "tag", "value", "asset"
    )


@query(
    "enrich_assets",
    sql(
        "telemetry tags assets",
        "SELECT tag, timestamp, value, asset, AssetCode, Latitude FROM telemetry "
        "JOIN tags USING (tag) JOIN assets ON AssetID = asset",
    ),
)
def _(t):
    return assets.enrich_assets(t.telemetry, t.tags, t.assets).select(
        "tag", "timestamp", "value", "asset", "AssetCode", "Latitude"
    )


@query(
    "model_asof",
    sql(
        "models",
        "SELECT asset, max_by(model_uri, effective_date) AS model_uri, "
        "max_by(sliding_window, effective_date) AS sliding_window, "
        "max(effective_date) AS effective_date FROM models "
        "WHERE effective_date <= '2024-01-20 00:00:00' GROUP BY asset",
    ),
)
def _(t):
    return assets.model_asof(t.models, "2024-01-20 00:00:00")


@query(
    "model_asof_rows",
    sql(
        "anomalies models",
        "SELECT a.asset, a.timestamp, m.model_uri, m.sliding_window, m.effective_date "
        "FROM anomalies a ASOF LEFT JOIN models m "
        "ON a.asset = m.asset AND a.timestamp >= m.effective_date",
    ),
)
def _(t):
    return assets.model_asof(t.models, t.anomalies.select("asset", "timestamp"))


_HIT = "(SELECT asset FROM anomalies WHERE is_anomaly AND severity >= 0.05)"


@query(
    "assets_with_anomalies",
    sql(
        "anomalies assets",
        "SELECT AssetID, AssetType, Manufacturer, Model, Latitude, Longitude, "
        "count(*) AS anomaly_count, max(severity) AS max_severity FROM assets "
        "JOIN anomalies ON AssetID = asset WHERE is_anomaly AND severity >= 0.05 GROUP BY ALL",
    ),
)
def _(t):
    return assets.assets_with_anomalies(t.anomalies, t.assets)


@query(
    "unhealthy_assets",
    sql("anomalies assets", f"SELECT * FROM assets WHERE AssetID IN {_HIT}"),
)
def _(t):
    return assets.unhealthy_assets(t.anomalies, t.assets)


@query(
    "healthy_assets",
    sql("anomalies assets", f"SELECT * FROM assets WHERE AssetID NOT IN {_HIT}"),
)
def _(t):
    return assets.healthy_assets(t.anomalies, t.assets)


@query(
    "latest_positions",
    sql(
        "vehicles",
        "SELECT vehicle_id, arg_max(lat, (timestamp, event_id)) AS lat, "
        "arg_max(lon, (timestamp, event_id)) AS lon FROM vehicles GROUP BY vehicle_id",
    ),
)
def _(t):
    return assets.latest_vehicle_positions(t.vehicles)


# -- reshaping ----------------------------------------------------------------------------------


@query(
    "asset_frame",
    sql(
        "telemetry",
        "SELECT time_bucket(INTERVAL 1 HOUR, timestamp) AS timestamp, "
        + ", ".join(f"round(avg(value) FILTER (tag = '{tag}'), 6) AS \"{tag}\"" for tag in _A00)
        + " FROM telemetry WHERE tag LIKE 'A00%' GROUP BY 1",
    ),
)
def _(t):
    return rounded(reshape.asset_frame(t.telemetry, _A00, "1hour"), *_A00)


@query(
    "unpivot_frame",
    sql(
        "telemetry",
        f"""
        WITH bins AS (
            SELECT tag, time_bucket(INTERVAL 1 HOUR, timestamp) AS timestamp, avg(value) AS v
            FROM telemetry WHERE tag LIKE 'A00%' GROUP BY ALL)
        SELECT b.timestamp, k.tag, round(v, 6) AS value
        FROM (SELECT DISTINCT timestamp FROM bins) b CROSS JOIN (SELECT unnest({list(_A00)}) AS tag) k
        LEFT JOIN bins ON bins.timestamp = b.timestamp AND bins.tag = k.tag
        """,
    ),
)
def _(t):
    frame = reshape.asset_frame(t.telemetry, _A00, "1hour")
    return rounded(reshape.unpivot_frame(frame), "value")


@query(
    "interpretation_expand",
    sql(
        "explanations",
        "SELECT asset, timestamp, tag, severity, contribution_score, "
        "unnest(changed_variables) AS secondary_tag, unnest(changed_values) AS correlation_change "
        "FROM explanations",
    ),
)
def _(t):
    rows = reshape.expand_interpretation(t.interpreted)
    return reshape.expand_changes(rows).select(
        "asset", "timestamp", "tag", "severity", "contribution_score", "secondary_tag",
        "correlation_change",
    )


@query(
    "changes_expand",
    sql(
        "explanations",
        "SELECT asset, timestamp, tag, unnest(changed_variables) AS secondary_tag, "
        "unnest(changed_values) AS correlation_change FROM explanations",
    ),
)
def _(t):
    return reshape.expand_changes(t.explanations).select(
        "asset", "timestamp", "tag", "secondary_tag", "correlation_change"
    )


@query(
    "array_expand",
    "SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS array_index, "
    "CAST(unnest(embedding) AS DOUBLE) AS array_value FROM embeddings",
)
def _(t):
    rows = reshape.expand_array(t.embeddings, "embedding")
    return rows.select("vec_id", "array_index", F.col("array_value").cast("double").alias("array_value"))


def directions(t):
    """One directions document per event: two routes, of two legs and of one."""

    def point(k: int):
        step = F.col("value") * (k / 100.0)
        return F.struct((F.lit(30.0) + step).alias("latitude"), (F.lit(-98.0) - step).alias("longitude"))

    def leg(*ks: int):
        return F.struct(F.array(*[point(k) for k in ks]).alias("points"))

    def route(*legs):
        return F.struct(F.array(*legs).alias("legs"))

    return t.events.select(
        F.col("event_id").alias("route_id"),
        F.array(route(leg(0, 1, 2), leg(3)), route(leg(4, 5))).alias("routes"),
    )


@query(
    "flatten_route",
    """
    SELECT event_id AS route_id, k AS idx, 30.0::DOUBLE + value * (k / 100.0::DOUBLE) AS lat,
        -98.0::DOUBLE - value * (k / 100.0::DOUBLE) AS lon
    FROM events, (SELECT unnest(range(6)) AS k)
    """,
)
def _(t):
    return reshape.flatten_route(directions(t))


@query(
    "vehicle_path",
    sql(
        "vehicles",
        "SELECT vehicle_id, event_id, row_number() OVER (PARTITION BY vehicle_id "
        "ORDER BY timestamp, event_id) - 1 AS idx FROM vehicles",
    ),
)
def _(t):
    path = ordering.ordered_index(t.vehicles, "vehicle_id", ["timestamp", "event_id"])
    return path.select("vehicle_id", "event_id", "idx")


@query(
    "densify_path",
    sql(
        "vehicles",
        """
        WITH p AS (
            SELECT *, row_number() OVER w - 1 AS idx, lead(lat) OVER w AS lat1,
                lead(lon) OVER w AS lon1
            FROM vehicles WINDOW w AS (PARTITION BY vehicle_id ORDER BY timestamp, event_id)),
        n AS (
            SELECT *, CAST(coalesce(greatest(1, ceil(sqrt((lat1 - lat) ** 2 + (lon1 - lon) ** 2)
                / 0.05)), 1) AS BIGINT) AS pieces FROM p),
        s AS (SELECT *, unnest(range(pieces)) AS step FROM n)
        SELECT vehicle_id, idx, step,
            CASE WHEN step = 0 THEN lat ELSE lat + (lat1 - lat) * (step / pieces) END AS lat,
            CASE WHEN step = 0 THEN lon ELSE lon + (lon1 - lon) * (step / pieces) END AS lon
        FROM s
        """,
    ),
)
def _(t):
    path = ordering.ordered_index(t.vehicles, "vehicle_id", ["timestamp", "event_id"])
    return reshape.densify_path(path, 0.05, "vehicle_id")


# -- alerts -------------------------------------------------------------------------------------


def alert_sql(rule: str, body: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, asset, timestamp, severity, "
        f"'{alerts.HEADLINE.replace(chr(39), chr(39) * 2)}' AS headline FROM ({body})"
    )


@query(
    "threshold_alerts",
    sql(
        "anomalies",
        alert_sql(alerts.THRESHOLD_RULE, "SELECT * FROM anomalies WHERE severity > 0.2"),
    ),
)
def _(t):
    return alerts.threshold_alerts(t.anomalies)


def runs_sql(source: str, gap: str | None = None) -> str:
    silence = (
        f"OR timestamp - lag(timestamp) OVER (PARTITION BY asset ORDER BY timestamp, severity) "
        f"> INTERVAL {gap}" if gap else ""
    )
    return f"""
        WITH b AS (
            SELECT *, CASE WHEN NOT severity >= 0.1 {silence} THEN 1 ELSE 0 END AS brk FROM {source}),
        r AS (
            SELECT *, sum(brk) OVER (PARTITION BY asset ORDER BY timestamp, severity
                ROWS UNBOUNDED PRECEDING) AS part FROM b),
        s AS (
            SELECT *, min(CASE WHEN severity >= 0.1 THEN timestamp END)
                OVER (PARTITION BY asset, part) AS run_start FROM r)
        SELECT asset, run_start, min(timestamp) AS timestamp, arg_min(severity, timestamp) AS severity
        FROM s WHERE severity >= 0.1 AND timestamp - run_start >= INTERVAL 10 MINUTE
        GROUP BY asset, run_start
        """


@query("sustained_runs", sql("anomalies", runs_sql("anomalies")))
def _(t):
    return ordering.sustained_runs(t.anomalies)


@query("sustained_runs_max_gap", sql("anomalies", runs_sql("anomalies", "40 MINUTE")))
def _(t):
    return ordering.sustained_runs(t.anomalies, max_gap="40min")


@query(
    "sustained_alerts",
    sql("anomalies", alert_sql(alerts.SUSTAINED_RULE, runs_sql("anomalies"))),
)
def _(t):
    return alerts.sustained_alerts(t.anomalies)


@query(
    "dedup_anomalies",
    sql(
        "anomalies",
        "SELECT DISTINCT * FROM (SELECT * FROM anomalies UNION ALL "
        "SELECT * FROM anomalies WHERE is_anomaly)",
    ),
)
def _(t):
    repeated = t.anomalies.unionByName(ranges.only_anomalies(t.anomalies))
    return alerts.dedup_anomalies(repeated)
