"""Charts answered from the roll-up pyramid that a stream of readings keeps."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlens import session
from sensorlens.operators import pyramid
from sensorlens.plans import replay
from sensorlens.plans.fixtures import sql
from sensorlens.plans.registry import query, rounded
from sensorlens.plans.series_queries import _AGG_SQL, _grid
from sensorlens.sources import streams
from sensorlens.streaming.rollup import keep_pyramid

_START, _END = "2024-01-03 06:12:07", "2024-01-28 18:47:52.5"
_kept: dict[tuple[str, str], str] = {}


def _pyramid(t) -> tuple:
    """Session, pyramid and raw table, kept by the replayed stream once per session."""
    key = (t.spark.sparkContext.applicationId, t.dir)
    if key not in _kept or not session.exists(t.spark, _kept[key]):
        path = session.scratch_dir(t.spark, "pyramid")
        stream = streams.read_telemetry_stream(t.spark, replay.metric_messages(t), max_files=40)
        keep_pyramid(stream, f"{path}/raw", f"{path}/levels", f"{path}/checkpoint").awaitTermination()
        _kept[key] = path
    return t.spark, f"{_kept[key]}/levels", f"{_kept[key]}/raw"


def _real(df):
    return df.filter(F.col("tag") != replay.CLOSING)


def _series_of(agg: str) -> None:
    @query(
        f"pyramid_{agg}",
        sql(
            "telemetry",
            f"WITH {_grid(_AGG_SQL[agg])} SELECT tag, ts AS timestamp, idx, round(v, 8) AS value FROM g",
        ),
    )
    def _(t):
        return rounded(_real(pyramid.series(*_pyramid(t), agg, "1hour")), "value", digits=8)


for _name in ("avg", "count", "min", "max", "sum"):
    _series_of(_name)


def _range_sql(agg: str, width: str, where: str = "") -> str:
    return sql(
        "telemetry",
        f"SELECT tag, time_bucket(INTERVAL {width}, timestamp) AS timestamp, round({agg}, 8) AS value FROM "
        "(SELECT date_trunc('second', timestamp) AS timestamp, tag, value FROM telemetry) "
        f"WHERE timestamp BETWEEN '{_START}' AND '{_END}' {where} GROUP BY ALL",
    )


@query("pyramid_range_avg", _range_sql("avg(value)", "12 HOUR"))
def _(t):
    found = pyramid.binned(*_pyramid(t), "avg", "12hour", _START, _END)
    return rounded(_real(found), "value", digits=8)


@query("pyramid_range_sum", _range_sql("sum(value)", "7 DAY"))
def _(t):
    found = pyramid.binned(*_pyramid(t), "sum", "7days", _START, _END)
    return rounded(_real(found), "value", digits=8)


@query("pyramid_range_minutes", _range_sql("max(value)", "5 MINUTE", "AND tag IN ('A00_CLICK', 'A01_ERROR')"))
def _(t):
    return pyramid.binned(*_pyramid(t), "max", "5min", _START, _END, ["A00_CLICK", "A01_ERROR"])


@query("pyramid_of_raw", _range_sql("CAST(count(DISTINCT value) AS DOUBLE)", "15 SECOND"))
def _(t):
    return _real(pyramid.binned(*_pyramid(t), "count_distinct", "15sec", _START, _END))
