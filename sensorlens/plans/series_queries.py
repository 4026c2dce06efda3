"""Ranges, bins, series, flags, statistics and correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlens.functions import text, timing
from sensorlens.functions.text import safe_cast
from sensorlens.operators import ordering, ranges, series
from sensorlens.plans.fixtures import CUTOFF, END, START, sql
from sensorlens.plans.registry import query, rounded

_TAGS = ("A00_CLICK", "A00_VIEW", "A01_ERROR")
_TAGS_SQL = "('A00_CLICK', 'A00_VIEW', 'A01_ERROR')"


@query(
    "telemetry_trend",
    sql(
        "telemetry",
        "SELECT tag, time_bucket(INTERVAL 10 SECOND, timestamp) AS timestamp, "
        "round(avg(value), 8) AS value FROM telemetry GROUP BY ALL",
    ),
)
def _(t):
    return rounded(series.telemetry_trend(t.telemetry), "value", digits=8)


@query(
    "telemetry_trend_of_tags",
    sql(
        "telemetry",
        "SELECT tag, time_bucket(INTERVAL 10 SECOND, timestamp) AS timestamp, "
        "round(avg(value), 8) AS value FROM telemetry "
        "WHERE timestamp BETWEEN '2024-01-05 00:00:00' AND '2024-01-25 12:00:00' "
        f"AND tag IN {_TAGS_SQL} GROUP BY ALL",
    ),
)
def _(t):
    trend = series.telemetry_trend(
        t.telemetry, "2024-01-05 00:00:00", "2024-01-25 12:00:00", _TAGS
    )
    return rounded(trend, "value", digits=8)


@query(
    "time_range",
    sql(
        "telemetry",
        "SELECT * FROM telemetry WHERE timestamp BETWEEN '2024-01-10' AND '2024-01-20 06:00:00'",
    ),
)
def _(t):
    return ranges.in_range(t.telemetry, "2024-01-10", "2024-01-20 06:00:00")


@query(
    "tag_list",
    sql("telemetry", f"SELECT * FROM telemetry WHERE tag IN {_TAGS_SQL}"),
)
def _(t):
    return ranges.for_tags(t.telemetry, _TAGS)


@query(
    "tags_of_table",
    sql(
        "telemetry tags",
        "SELECT * FROM telemetry WHERE tag IN (SELECT tag FROM tags WHERE asset = 'A01')",
    ),
)
def _(t):
    return ranges.for_tags(t.telemetry, ranges.for_asset(t.tags, "A01"))


@query(
    "asset_filter", sql("anomalies", "SELECT * FROM anomalies WHERE asset = 'A02'")
)
def _(t):
    return ranges.for_asset(t.anomalies, "A02")


@query("only_anomalies", sql("anomalies", "SELECT * FROM anomalies WHERE is_anomaly"))
def _(t):
    return ranges.only_anomalies(t.anomalies)


@query(
    "severity_filter",
    sql(
        "explanations",
        "SELECT asset, timestamp, tag, severity, contribution_score FROM explanations "
        "WHERE severity >= 0.05 AND contribution_score >= 0.05",
    ),
)
def _(t):
    return ranges.by_severity(t.explanations).select(
        "asset", "timestamp", "tag", "severity", "contribution_score"
    )


@query(
    "last_period",
    sql(
        "telemetry",
        "SELECT tag, timestamp, value FROM (SELECT *, max(timestamp) OVER (PARTITION BY tag) AS n "
        "FROM telemetry) WHERE timestamp >= n - INTERVAL 7 DAY",
    ),
)
def _(t):
    return ranges.last_period(t.telemetry, "7days", by="tag").select("tag", "timestamp", "value")


@query(
    "last_period_overall",
    sql(
        "telemetry",
        "SELECT * FROM telemetry WHERE timestamp >= "
        "(SELECT max(timestamp) FROM telemetry) - INTERVAL 2 DAY",
    ),
)
def _(t):
    return ranges.last_period(t.telemetry, "2days")


@query(
    "last_period_anchored",
    sql(
        "telemetry",
        "SELECT * FROM telemetry WHERE timestamp BETWEEN TIMESTAMP '2024-01-21 06:00:00' "
        "- INTERVAL 12 HOUR AND TIMESTAMP '2024-01-21 06:00:00'",
    ),
)
def _(t):
    return ranges.last_period(t.telemetry, "12hours", anchor="2024-01-21 06:00:00")


_LADDER_SQL = ", ".join(
    f"({size}, '{label}')" for label, size in timing.BIN_LADDER.items()
)


def _bins_sql(label: str, wanted: int, max_bins: int) -> str:
    return sql(
        "telemetry",
        f"""
        WITH ladder(step_us, effective) AS (VALUES {_LADDER_SQL}),
        spans AS (
            SELECT tag, epoch_us(max(timestamp)) - epoch_us(min(timestamp)) AS span_us
            FROM telemetry GROUP BY tag),
        steps AS (
            SELECT tag, span_us, coalesce(min(step_us), {timing.BIN_LADDER["7days"]}) AS step_us
            FROM spans LEFT JOIN ladder
            ON step_us >= {wanted} AND ceil(span_us / step_us) <= {max_bins}
            GROUP BY tag, span_us)
        SELECT tag, span_us, '{label}' AS requested, step_us, effective,
            '{label}' <> effective AND '{label}' <> 'Auto' AS grain_warning
        FROM steps JOIN ladder USING (step_us)
        """,
    )


@query("adaptive_bin", _bins_sql("Auto", 0, 1000))
def _(t):
    return ranges.grain_warning(ranges.adaptive_bin(t.telemetry, "tag"))


@query("grain_warning", _bins_sql("30min", timing.duration("30min"), 500))
def _(t):
    return ranges.grain_warning(ranges.adaptive_bin(t.telemetry, "tag", "30min", 500))


@query(
    "duration_labels",
    """
    WITH labels AS (
        SELECT event_id, concat(CAST(event_id % 45 + 1 AS VARCHAR), CASE event_type
            WHEN 'click' THEN 'sec' WHEN 'view' THEN 'min' WHEN 'signup' THEN 'hours'
            WHEN 'purchase' THEN 'days' ELSE 'moons' END) AS label,
            event_type, event_id % 45 + 1 AS n FROM events)
    SELECT event_id, label, CASE event_type WHEN 'click' THEN n * 1000000
        WHEN 'view' THEN n * 60000000 WHEN 'signup' THEN n * 3600000000
        WHEN 'purchase' THEN n * 86400000000 END AS duration_us FROM labels
    """,
)
def _(t):
    kind = F.col("event_type")
    unit = (
        F.when(kind == "click", "sec").when(kind == "view", "min").when(kind == "signup", "hours")
        .when(kind == "purchase", "days").otherwise("moons")
    )
    label = F.concat((F.col("event_id") % 45 + 1).cast("string"), unit)
    return t.events.select("event_id", label.alias("label")).withColumn(
        "duration_us", timing.duration_us(F.col("label"))
    )


@query(
    "period_labels",
    sql(
        "telemetry tags",
        """
        SELECT asset, concat(strftime(date_trunc('second', min(timestamp)), '%Y-%m-%dT%H:%M:%S'),
            ' - ', strftime(date_trunc('second', max(timestamp)), '%Y-%m-%dT%H:%M:%S'))
            AS time_period
        FROM telemetry JOIN tags USING (tag) GROUP BY asset
        """,
    ),
)
def _(t):
    from sensorlens.operators.anomalies import bookends_by_asset

    ends = bookends_by_asset(t.telemetry, t.tags)
    return ranges.period_label(ends).select("asset", "time_period")


@query(
    "time_bins",
    sql(
        "telemetry",
        """
        SELECT tag, timestamp, time_bucket(INTERVAL 10 SECOND, timestamp) AS bin_10s,
            time_bucket(INTERVAL 15 MINUTE, timestamp) AS bin_15min,
            time_bucket(INTERVAL 6 HOUR, timestamp) AS bin_6hour,
            time_bucket(INTERVAL 1 DAY, timestamp) AS bin_1day,
            time_bucket(INTERVAL 7 DAY, timestamp) AS bin_7days FROM telemetry
        """,
    ),
)
def _(t):
    steps = {"bin_10s": "10s", "bin_15min": "15min", "bin_6hour": "6hour", "bin_1day": "1day",
             "bin_7days": "7days"}
    bins = [timing.time_bin(F.col("timestamp"), s).alias(c) for c, s in steps.items()]
    return t.telemetry.select("tag", "timestamp", *bins)


@query(
    "safe_casts",
    """
    SELECT event_id, TRY_CAST(substr(props, 7, 2) AS BIGINT) AS k,
        TRY_CAST(concat('2024-01-', substr(props, 7, 2)) AS TIMESTAMP) AS at FROM events
    """,
)
def _(t):
    piece = F.substring("props", 7, 2)
    day = F.concat(F.lit("2024-01-"), piece)
    return t.events.select(
        "event_id",
        safe_cast(piece, "bigint").alias("k"),
        safe_cast(day, "timestamp").alias("at"),
    )


@query(
    "tag_pair_filter",
    sql(
        "tags",
        "SELECT a.tag AS tag, b.tag AS tag1 FROM tags a JOIN tags b USING (asset) "
        "WHERE a.tag <= b.tag",
    ),
)
def _(t):
    one = t.tags.select("asset", "tag")
    two = t.tags.select("asset", F.col("tag").alias("tag1"))
    pairs = one.join(two, "asset").filter(text.pair_filter(F.col("tag"), F.col("tag1")))
    return pairs.select("tag", "tag1")


@query(
    "train_test_counts",
    sql(
        "telemetry",
        f"""
        SELECT tag, count(*) AS total_rows,
            count(*) FILTER (timestamp < '{CUTOFF}') AS train_rows,
            count(*) FILTER (timestamp >= '{CUTOFF}') AS test_rows
        FROM telemetry GROUP BY tag
        """,
    ),
)
def _(t):
    return ranges.split_counts(t.telemetry, CUTOFF, ["tag"])


@query(
    "train_rows", sql("telemetry", f"SELECT * FROM telemetry WHERE timestamp < '{CUTOFF}'")
)
def _(t):
    return ranges.train_test_split_by_time(t.telemetry, CUTOFF)[0]


@query(
    "test_rows", sql("telemetry", f"SELECT * FROM telemetry WHERE timestamp >= '{CUTOFF}'")
)
def _(t):
    return ranges.train_test_split_by_time(t.telemetry, CUTOFF)[1]


@query(
    "first_rows",
    sql(
        "vehicles",
        "SELECT event_id, vehicle_id, timestamp FROM vehicles ORDER BY timestamp, event_id "
        "LIMIT 35000",
    ),
)
def _(t):
    rows = t.vehicles.select("event_id", "vehicle_id", "timestamp")
    return ordering.first_rows(rows, 35_000, ["timestamp", "event_id"])


# -- series -------------------------------------------------------------------------------------


_IN_RANGE = f"WHERE timestamp BETWEEN '{START}' AND '{END}'"


def _grid(value: str, step: str = "1 HOUR", default: str = "NULL", where: str = "") -> str:
    """Views ``cells``, ``grid`` and ``g(tag, ts, v, idx)`` of an open series."""
    return f"""
        cells AS (
            SELECT tag, time_bucket(INTERVAL {step}, timestamp) AS ts,
                CAST({value} AS DOUBLE) AS v FROM telemetry {where} GROUP BY ALL),
        grid AS (
            SELECT tag, unnest(generate_series(min(ts), max(ts), INTERVAL {step})) AS ts
            FROM cells GROUP BY tag),
        g AS (
            SELECT tag, ts, coalesce(v, {default}) AS v,
                row_number() OVER (PARTITION BY tag ORDER BY ts) - 1 AS idx
            FROM grid LEFT JOIN cells USING (tag, ts))"""


_FILL = """
        n AS (
            SELECT *, last_value(v IGNORE NULLS) OVER b AS pv, first_value(v IGNORE NULLS) OVER a AS nv,
                last_value(CASE WHEN v IS NOT NULL THEN idx END IGNORE NULLS) OVER b AS pi,
                first_value(CASE WHEN v IS NOT NULL THEN idx END IGNORE NULLS) OVER a AS ni
            FROM g WINDOW
                b AS (PARTITION BY tag ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                a AS (PARTITION BY tag ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        f AS (
            SELECT tag, ts, idx, CASE WHEN v IS NOT NULL THEN v WHEN pv IS NULL THEN nv
                WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * (idx - pi) / (ni - pi) END AS v
            FROM n)"""

_AGG_SQL = {
    "avg": "avg(value)",
    "count": "count(value)",
    "count_distinct": "count(DISTINCT value)",
    "min": "min(value)",
    "max": "max(value)",
    "sum": "sum(value)",
}


def _series_of(agg: str) -> None:
    @query(
        f"series_{agg}",
        sql(
            "telemetry",
            f"WITH {_grid(_AGG_SQL[agg])} "
            "SELECT tag, ts AS timestamp, idx, round(v, 8) AS value FROM g",
        ),
    )
    def _(t):
        return rounded(series.make_series(t.telemetry, agg, "1hour"), "value", digits=8)


for _name in _AGG_SQL:
    _series_of(_name)


@query(
    "binned_sum",
    sql(
        "telemetry",
        "SELECT tag, time_bucket(INTERVAL 7 DAY, timestamp) AS timestamp, "
        "round(sum(value), 8) AS value FROM telemetry GROUP BY ALL",
    ),
)
def _(t):
    return rounded(series.binned_aggregate(t.telemetry, "sum", "7days"), "value", digits=8)


@query(
    "series_zero_filled",
    sql(
        "telemetry",
        f"WITH {_grid('avg(value)', default='0.0')}, k AS (SELECT tag, "
        "time_bucket(INTERVAL 1 HOUR, timestamp) AS ts, count(*) AS c FROM telemetry GROUP BY ALL) "
        "SELECT tag, ts AS timestamp, idx, round(v, 8) AS value, coalesce(c, 0) AS record_count "
        "FROM g LEFT JOIN k USING (tag, ts)",
    ),
)
def _(t):
    out = series.make_series(t.telemetry, "avg", "1hour", empty="zero", record_count=True)
    return rounded(out, "value", digits=8)


@query(
    "series_filled",
    sql(
        "telemetry",
        f"WITH {_grid('avg(value)')}, {_FILL} "
        "SELECT tag, ts AS timestamp, idx, round(v, 8) AS value FROM f",
    ),
)
def _(t):
    return rounded(series.make_series(t.telemetry, "avg", "1hour", empty="linear"), "value", digits=8)


_LAST_WEEK = "WHERE timestamp >= (SELECT max(timestamp) FROM telemetry) - INTERVAL 7 DAY"


@query(
    "series_of_last_period",
    sql(
        "telemetry",
        f"WITH {_grid('avg(value)', '15 MINUTE', where=_LAST_WEEK)}, {_FILL} "
        "SELECT tag, ts AS timestamp, idx, round(v, 8) AS value FROM f",
    ),
)
def _(t):
    # Seven days in at most 1000 bins make bins of 15 minutes.
    start, end = ranges.resolve_period("7days", df=t.telemetry)
    step = ranges.range_step(start, end)
    rows = ranges.in_range(t.telemetry, start, end)
    return rounded(series.make_series(rows, "avg", step, empty="linear"), "value", digits=8)


_CLOSED = f"""
        cells AS (
            SELECT tag, CAST(floor(epoch(timestamp - TIMESTAMP '{START}') / 3600) AS BIGINT) AS idx,
                avg(value) AS v FROM telemetry
            WHERE timestamp >= '{START}' AND timestamp < '{END}' GROUP BY ALL),
        g AS (
            SELECT tag, idx, TIMESTAMP '{START}' + to_hours(idx) AS ts, v
            FROM (SELECT tag, unnest(range(720)) AS idx FROM (SELECT DISTINCT tag FROM cells))
            LEFT JOIN cells USING (tag, idx))"""


@query(
    "series_shared_axis",
    sql(
        "telemetry",
        f"WITH {_CLOSED}, {_FILL} "
        "SELECT tag, ts AS timestamp, idx, round(v, 8) AS value FROM f",
    ),
)
def _(t):
    out = series.make_series(t.telemetry, "avg", "1hour", empty="linear", start=START, end=END)
    return rounded(out, "value", digits=8)


# The season of each tag, from the autocorrelation of its detrended bins at every lag to a third.
_SEASON = """
        x AS (SELECT tag, list(v - line ORDER BY idx) AS x, count(*) AS n FROM l GROUP BY tag),
        lags AS (
            SELECT tag, n, k, x[1:n - k] AS a, x[k + 1:n] AS b
            FROM (SELECT *, unnest(range(2, n // 3 + 2)) AS k FROM x WHERE n >= 9)),
        r AS (
            SELECT tag, n, k, coalesce(list_dot_product(a, b)
                / nullif(sqrt(list_dot_product(a, a) * list_dot_product(b, b)), 0), 0) AS r FROM lags),
        hills AS (
            SELECT *, lag(r) OVER w AS before, lead(r) OVER w AS after FROM r
            WINDOW w AS (PARTITION BY tag ORDER BY k)),
        tops AS (
            SELECT tag, k, r, max(r) OVER (PARTITION BY tag) AS best FROM hills
            WHERE k BETWEEN 3 AND n // 3 AND r >= before AND r >= after AND r >= 0.6),
        season AS (SELECT tag, min(k) AS period FROM tops WHERE r >= best - 0.05 GROUP BY tag),
        s AS (SELECT l.*, period FROM l LEFT JOIN season USING (tag)),"""


def _flags(period: int | str | None) -> str:
    """Views that end in ``d(tag, ts, idx, v, baseline, score, flag)``; "auto" looks for seasons."""
    auto = period == "auto"
    phase = "idx % coalesce(period, 1)" if auto else f"idx % {period}"
    season = f"avg(v - line) OVER (PARTITION BY tag, {phase})" if period else "CAST(0.0 AS DOUBLE)"
    if auto:
        season = f"CASE WHEN period IS NULL THEN 0 ELSE {season} END"
    lines = "s" if auto else "l"
    return f"""
        fit AS (
            SELECT tag, regr_slope(v, idx) AS s, avg(v) AS my, avg(idx) AS mx FROM f GROUP BY tag),
        l AS (
            SELECT f.*, my + CASE WHEN s IS NULL OR isnan(s) THEN 0 ELSE s END * (idx - mx) AS line
            FROM f JOIN fit USING (tag)),{_SEASON if auto else ""}
        p AS (SELECT *, line + {season} AS baseline FROM {lines}),
        q AS (
            SELECT tag, quantile_cont(v - baseline, 0.1) AS lo, quantile_cont(v - baseline, 0.9) AS hi
            FROM p GROUP BY tag),
        e AS (
            SELECT p.*, CASE WHEN hi - lo <= 0 THEN 0.0
                WHEN v - baseline > hi THEN (v - baseline - hi) / (hi - lo)
                WHEN v - baseline < lo THEN (v - baseline - lo) / (hi - lo) ELSE 0.0 END AS score
            FROM p JOIN q USING (tag)),
        d AS (
            SELECT *, CASE WHEN abs(score) > 1.5 THEN CAST(sign(score) AS INTEGER) ELSE 0 END AS flag
            FROM e)"""


_FLAG_COLUMNS = (
    "tag, ts AS timestamp, idx, round(v, 8) AS value, round(baseline, 6) AS baseline, "
    "round(score, 6) AS score, flag"
)


@query(
    "series_flags",
    sql(
        "telemetry",
        f"WITH {_grid('avg(value)', '3 HOUR')}, {_FILL}, {_flags(None)} "
        f"SELECT {_FLAG_COLUMNS} FROM d",
    ),
)
def _(t):
    filled = series.make_series(t.telemetry, "avg", "3hour", empty="linear")
    out = series.decompose_anomalies(filled, seasonality="none")
    return rounded(rounded(out, "value", digits=8), "baseline", "score")


@query(
    "series_flags_seasonal",
    sql(
        "telemetry",
        f"WITH {_grid('avg(value)')}, {_FILL}, {_flags(24)} SELECT {_FLAG_COLUMNS} FROM d",
    ),
)
def _(t):
    filled = series.make_series(t.telemetry, "avg", "1hour", empty="linear")
    out = series.decompose_anomalies(filled, seasonality=24)
    return rounded(rounded(out, "value", digits=8), "baseline", "score")


@query(
    "series_flags_auto_season",
    sql(
        "telemetry",
        f"WITH {_grid('avg(value)')}, {_FILL}, {_flags('auto')} SELECT {_FLAG_COLUMNS} FROM d",
    ),
)
def _(t):
    filled = series.make_series(t.telemetry, "avg", "1hour", empty="linear")
    return rounded(rounded(series.decompose_anomalies(filled), "value", digits=8), "baseline", "score")


def _waves(step: str, width: str, hours: int) -> None:
    """Seasons in the readings: each with a wave of so many hours on top."""
    turn = f"2 * pi() * (CAST(epoch(ts) AS BIGINT) % {3600 * hours}) / {3600 * hours}"

    @query(
        f"series_flags_wave_{hours}h",
        sql(
            "telemetry",
            f"WITH {_grid('avg(value)', width)}, {_FILL.replace('f AS (', 'f0 AS (')}, "
            f"f AS (SELECT * REPLACE (v + 300 * cos({turn} + 0.1) AS v) FROM f0), {_flags('auto')} "
            f"SELECT {_FLAG_COLUMNS}, coalesce(period, 0) AS period FROM d",
        ),
    )
    def _(t):
        filled = series.make_series(t.telemetry, "avg", step, empty="linear")
        at = F.pmod(F.unix_seconds("timestamp"), F.lit(3600 * hours)) / F.lit(3600 * hours)
        wave = filled.withColumn("value", F.col("value") + 300 * F.cos(at * 2 * F.pi() + 0.1))
        flags = series.decompose_anomalies(wave, with_period=True)
        return rounded(rounded(flags, "value", digits=8), "baseline", "score")


_waves("1hour", "1 HOUR", 24)
_waves("10min", "10 MINUTE", 75)  # 450 bins


def _points(seasonality: str):
    def build(t):
        return series.series_with_anomalies(
            t.telemetry, t.tags, t.explanations, START, END, seasonality=seasonality
        )

    return build


# Hourly bins are what 30 days and at most 1000 bins give.
def _points_sql(period: str | None) -> str:
    return f"""{_grid('avg(value)', where=_IN_RANGE)}, {_FILL}, {_flags(period)},
        mv AS (
            SELECT tag, time_bucket(INTERVAL 1 HOUR, timestamp) AS ts, max(severity) AS m
            FROM explanations {_IN_RANGE}
                AND is_anomaly AND severity >= 0.05 AND contribution_score >= 0.05 GROUP BY ALL),
        points AS (
            SELECT tag, ts AS timestamp, v AS value,
                CASE WHEN flag <> 0 OR coalesce(m, 0) <> 0 THEN v END AS anomaly,
                CASE WHEN flag <> 0 THEN v END AS individual_anomaly,
                CASE WHEN coalesce(m, 0) <> 0 THEN m END AS mvad_anomaly,
                concat(CASE WHEN flag <> 0 THEN ' ● Individual' ELSE '' END,
                    CASE WHEN coalesce(m, 0) > 0 THEN ' ● Multivariate' ELSE '' END)
                    AS anomaly_indicator,
                metric, component,
                CASE WHEN flag <> 0 THEN 'FireBrick' WHEN coalesce(m, 0) > 0 THEN 'Orange'
                    ELSE '' END AS marker_color
            FROM d LEFT JOIN mv USING (tag, ts) LEFT JOIN tags USING (tag))"""


_POINTS_SQL = _points_sql(None)
_ROUNDED_POINTS = (
    "SELECT * REPLACE (round(value, 8) AS value, round(anomaly, 8) AS anomaly, "
    "round(individual_anomaly, 8) AS individual_anomaly, round(mvad_anomaly, 8) AS mvad_anomaly) FROM points"
)


@query(
    "series_with_anomalies",
    sql("telemetry tags explanations", f"WITH {_POINTS_SQL} {_ROUNDED_POINTS}"),
)
def _(t):
    return rounded(
        _points("none")(t), "value", "anomaly", "individual_anomaly", "mvad_anomaly", digits=8
    )


@query(
    "series_with_anomalies_auto_season",
    sql("telemetry tags explanations", f"WITH {_points_sql('auto')} {_ROUNDED_POINTS}"),
)
def _(t):
    return rounded(
        _points("auto")(t), "value", "anomaly", "individual_anomaly", "mvad_anomaly", digits=8
    )


def _rollup(split_by: str, legend_by: str) -> None:
    dims = [
        f"{c} AS {a}" for c, a in ((split_by, "split_by"), (legend_by, "legend_by")) if c != "none"
    ]

    @query(
        f"series_rollup_{split_by}_{legend_by}",
        sql(
            "telemetry tags explanations",
            f"WITH {_POINTS_SQL} SELECT timestamp, {', '.join(dims)}, "
            "round(sum(value), 8) AS value, min(marker_color) AS marker_color "
            "FROM points GROUP BY ALL",
        ),
    )
    def _(t):
        return rounded(series.series_rollup(_points("none")(t), split_by, legend_by), "value", digits=8)


for _split, _legend in series.CHART_LAYOUTS:
    _rollup(_split, _legend)


_MV_SQL = (
    "mv AS (SELECT tag, time_bucket(INTERVAL 1 HOUR, timestamp) AS ts, max(severity) AS m "
    "FROM explanations WHERE is_anomaly AND severity >= 0.05 AND contribution_score >= 0.05 "
    "GROUP BY ALL)"
)


@query(
    "series_with_mv_anomalies",
    sql(
        "telemetry explanations",
        f"WITH {_grid('max(value)')}, {_MV_SQL} SELECT tag, ts AS timestamp, v AS value, "
        "m AS mvad_anomaly FROM g LEFT JOIN mv USING (tag, ts)",
    ),
)
def _(t):
    points = series.make_series(t.telemetry, "max", "1hour").drop("idx")
    return series.attach_mv_anomalies(points, series.mv_severity_by_bin(t.explanations, "1hour"))


@query(
    "series_with_tag_columns",
    sql(
        "telemetry tags",
        f"WITH {_grid('min(value)')} SELECT tag, ts AS timestamp, v AS value, metric, component "
        "FROM g LEFT JOIN tags USING (tag)",
    ),
)
def _(t):
    points = series.make_series(t.telemetry, "min", "1hour").drop("idx")
    return series.attach_tag_columns(points, t.tags)


@query(
    "point_markers",
    sql(
        "telemetry",
        """
        WITH p AS (
            SELECT tag, timestamp, value - 20 AS value, CAST(sign(value - 20) AS INTEGER) AS flag,
                CASE WHEN value > 40 THEN value / 100 END AS mv FROM telemetry)
        SELECT tag, timestamp,
            concat(CASE WHEN flag <> 0 THEN ' ● Individual' ELSE '' END,
                CASE WHEN mv > 0 THEN ' ● Multivariate' ELSE '' END) AS anomaly_indicator,
            CASE WHEN flag <> 0 THEN 'FireBrick' WHEN mv > 0 THEN 'Orange' ELSE '' END AS color,
            CASE WHEN flag <> 0 AND value > 0 THEN 'FireBrick' WHEN mv > 0 THEN 'Orange' ELSE '' END
                AS strict_color
        FROM p
        """,
    ),
)
def _(t):
    value = F.col("value") - 20
    flag = F.signum(value).cast("int")
    mv = F.when(F.col("value") > 40, F.col("value") / 100)
    return t.telemetry.select(
        "tag",
        "timestamp",
        text.anomaly_indicator(flag, mv).alias("anomaly_indicator"),
        text.marker_color(flag, mv).alias("color"),
        text.marker_color(flag, mv, value, strict_reference=True).alias("strict_color"),
    )


@query(
    "mv_severity_by_bin",
    sql(
        "explanations",
        "SELECT tag, time_bucket(INTERVAL 6 HOUR, timestamp) AS timestamp, "
        "max(severity) AS mvad_anomaly FROM explanations "
        "WHERE is_anomaly AND severity >= 0.05 AND contribution_score >= 0.05 GROUP BY ALL",
    ),
)
def _(t):
    return series.mv_severity_by_bin(t.explanations, "6hour")


@query(
    "series_round_trip",
    sql(
        "telemetry",
        f"WITH {_grid('avg(value)')} SELECT tag, ts AS timestamp, round(v, 8) AS value FROM g",
    ),
)
def _(t):
    # Arrays hold bins, so their length is bounded by the range and not by the readings.
    packed = series.rows_to_series(series.make_series(t.telemetry, "avg", "1hour"))
    return rounded(series.series_to_rows(packed), "value", digits=8)


def _stats_sql(views: str, source: str) -> str:
    return sql(
        "telemetry",
        f"""
        WITH {views}
        SELECT tag, round(min(v), 6) AS series_stats_value_min,
            arg_min(idx, (v, idx)) AS series_stats_value_min_idx,
            round(max(v), 6) AS series_stats_value_max,
            arg_min(idx, (-v, idx)) AS series_stats_value_max_idx,
            round(avg(v), 6) AS series_stats_value_avg,
            round(stddev_samp(v), 6) AS series_stats_value_stdev,
            round(var_samp(v), 6) AS series_stats_value_variance
        FROM {source} GROUP BY tag
        """,
    )


_STATS = ["series_stats_value_" + c for c in ("min", "max", "avg", "stdev", "variance")]


@query("series_stats", _stats_sql(_grid("avg(value)", default="0.0"), "g"))
def _(t):
    return rounded(series.series_stats(t.telemetry), *_STATS)


@query("series_stats_linear", _stats_sql(f"{_grid('avg(value)')}, {_FILL}", "f"))
def _(t):
    return rounded(series.series_stats(t.telemetry, empty="linear"), *_STATS)


@query(
    "correlation_matrix",
    sql(
        "telemetry",
        f"""
        WITH {_CLOSED}, {_FILL},
        c AS (
            SELECT a.tag AS tag, b.tag AS tag1, corr(a.v, b.v) AS r FROM f a JOIN f b USING (idx)
            WHERE a.tag <= b.tag GROUP BY ALL)
        SELECT tag, tag1, round(CASE WHEN isnan(r) THEN NULL ELSE r END, 6)
            AS correlation_coefficient FROM c
        """,
    ),
)
def _(t):
    out = series.correlation_matrix(t.telemetry, START, END, "1hour")
    return rounded(out, "correlation_coefficient")
