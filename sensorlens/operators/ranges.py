"""Row selection by time and tag, and the choice of the bin size."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.functions import timing
from sensorlens.session import hold

Moment = datetime | str


def _moment(value: Moment) -> datetime:
    return datetime.fromisoformat(value) if isinstance(value, str) else value


def check_order(start: Moment | None, end: Moment | None) -> None:
    if start is not None and end is not None and _moment(start) > _moment(end):
        raise ValueError(f"range starts ({start}) after it ends ({end})")


def in_range(
    df: DataFrame, start: Moment | None = None, end: Moment | None = None, column: str = "timestamp"
) -> DataFrame:
    """Rows with ``start <= column <= end``; a missing bound is open."""
    check_order(start, end)
    if start is not None:
        df = df.filter(F.col(column) >= timing.literal(start))
    if end is not None:
        df = df.filter(F.col(column) <= timing.literal(end))
    return df


def for_tags(
    df: DataFrame, tags: str | Sequence[str] | DataFrame | None, column: str = "tag"
) -> DataFrame:
    """Rows of one tag, of a list of tags, or of the tags in a table with a ``tag`` column."""
    if tags is None:
        return df
    if isinstance(tags, DataFrame):
        wanted = tags.select(F.col("tag").alias(column))
        return df.join(wanted, column, "left_semi")
    if isinstance(tags, str):
        tags = [tags]
    return df.filter(F.col(column).isin(*tags))


def for_asset(df: DataFrame, asset: str | None, column: str = "asset") -> DataFrame:
    return df if asset is None else df.filter(F.col(column) == asset)


def only_anomalies(df: DataFrame) -> DataFrame:
    """Rows flagged as anomalies; the flag may be boolean or 0/1."""
    return df.filter(F.col("is_anomaly").cast("boolean"))


def by_severity(
    df: DataFrame, severity: float = 0.05, contribution: float | None = 0.05
) -> DataFrame:
    df = df.filter(F.col("severity") >= severity)
    if contribution is not None:
        df = df.filter(F.col("contribution_score") >= contribution)
    return df


def last_period(
    df: DataFrame,
    period: str,
    start: Moment | None = None,
    end: Moment | None = None,
    anchor: Moment | None = None,
    by: str | None = None,
) -> DataFrame:
    """Rows of the custom range, or of the look-back period that ends at ``anchor``.

    Without an anchor the period ends at the newest timestamp of the data, overall or per ``by``.
    The overall anchor is a scalar subquery and the given one a literal; both filter the scan.
    The anchors per key are held as a small table, so that Catalyst knows their size and does not
    shuffle the rows to meet them.
    """
    if period == timing.CUSTOM_PERIOD:
        if start is None or end is None:
            raise ValueError("a custom period needs start and end")
        return in_range(df, start, end)
    length = F.make_dt_interval(secs=F.lit(timing.duration(period) // timing.SECOND))
    ts = F.col("timestamp")
    if anchor is not None or by is None:
        newest = (
            timing.literal(anchor)
            if anchor is not None
            else df.agg(F.max("timestamp")).scalar()
        )
        return df.filter((ts >= newest - length) & (ts <= newest))
    newest = hold(df.groupBy(by).agg(F.max("timestamp").alias("_newest")), "newest")
    recent = F.col("timestamp") >= F.col("_newest") - length
    return df.join(newest, by).filter(recent).drop("_newest")


def resolve_period(
    period: str,
    start: Moment | None = None,
    end: Moment | None = None,
    anchor: Moment | None = None,
    df: DataFrame | None = None,
) -> tuple[datetime, datetime]:
    """Bounds of the custom range, or of the look-back period that ends at ``anchor``.

    Without an anchor the period ends at the newest timestamp of ``df``. Known bounds let the
    bin size be chosen before the plan is built, and let the range filter reach the scan.
    """
    if period == timing.CUSTOM_PERIOD:
        if start is None or end is None:
            raise ValueError("a custom period needs start and end")
        check_order(start, end)
        return _moment(start), _moment(end)
    if anchor is None:
        if df is None:
            raise ValueError("a period without an anchor needs the data")
        anchor = df.agg(F.max("timestamp")).first()[0]
        if anchor is None:
            raise ValueError("no data to anchor the period at")
    last = _moment(anchor)
    return last - timedelta(microseconds=timing.duration(period)), last


def adaptive_bin(
    df: DataFrame,
    by: str,
    label: str = timing.AUTO_LABEL,
    max_bins: int = timing.DEFAULT_MAX_BINS,
) -> DataFrame:
    """Bin size per key from the time its rows span."""
    wanted = timing.duration(label)
    span = F.unix_micros(F.max("timestamp")) - F.unix_micros(F.min("timestamp"))
    return (
        df.groupBy(by)
        .agg(span.alias("span_us"))
        .withColumn("requested", F.lit(label))
        .withColumn("step_us", timing.choose_step_column("span_us", wanted, max_bins))
        .withColumn("effective", timing.step_label("step_us"))
    )


def range_step(
    start: Moment, end: Moment, label: str = timing.AUTO_LABEL,
    max_bins: int = timing.DEFAULT_MAX_BINS,
) -> int:
    """Bin size for a given range: a plain number, known before the plan is built."""
    check_order(start, end)
    span = (_moment(end) - _moment(start)) // timedelta(microseconds=1)
    return timing.choose_step(span, label, max_bins)


def effective_bin(
    start: Moment, end: Moment, label: str = timing.AUTO_LABEL,
    max_bins: int = timing.DEFAULT_MAX_BINS,
) -> str:
    """Label of the bin size that a range gets; it may differ from the requested one."""
    step = range_step(start, end, label, max_bins)
    return next(name for name, size in timing.BIN_LADDER.items() if size == step)


def grain_warning(steps: DataFrame) -> DataFrame:
    """Marks keys whose effective bin size differs from a requested one other than Auto."""
    asked = F.lower(F.col("requested"))
    differs = asked != F.lower(F.col("effective"))
    return steps.withColumn(
        "grain_warning", differs & (asked != F.lit(timing.AUTO_LABEL.lower()))
    )


def period_label(df: DataFrame, start: str = "actual_start", end: str = "actual_end") -> DataFrame:
    return df.withColumn("time_period", timing.period_label(F.col(start), F.col(end)))


def single_asset(tags: DataFrame, chosen: str | Sequence[str] | DataFrame | None) -> DataFrame:
    """One row: how many assets own the chosen tags, and the asset if there is just one."""
    count = F.count_distinct("asset")
    return (
        for_tags(tags, chosen)
        .agg(count.alias("asset_count"), F.min("asset").alias("_first"))
        .select(
            "asset_count",
            (F.col("asset_count") == 1).alias("is_one_asset"),
            F.when(F.col("asset_count") == 1, F.col("_first")).alias("asset"),
        )
    )


def asset_count(tags: DataFrame, chosen: str | Sequence[str] | DataFrame | None) -> DataFrame:
    return for_tags(tags, chosen).agg(F.count_distinct("asset").alias("asset_count"))


def any_asset(tags: DataFrame, chosen: str | Sequence[str] | DataFrame | None) -> DataFrame:
    """One asset of the chosen tags; the smallest, so that the answer is stable."""
    return for_tags(tags, chosen).agg(F.min("asset").alias("asset"))


def train_test_split_by_time(
    df: DataFrame, cutoff: Moment, column: str = "timestamp"
) -> tuple[DataFrame, DataFrame]:
    """Rows strictly before the cutoff, and the others."""
    before = F.col(column) < timing.literal(cutoff)
    return df.filter(before), df.filter(~before)


def split_counts(
    df: DataFrame, cutoff: Moment, by: Sequence[str] = (), column: str = "timestamp"
) -> DataFrame:
    """Total, training and test row counts in one aggregate."""
    before = F.col(column) < timing.literal(cutoff)
    return df.groupBy(*by).agg(
        F.count("*").alias("total_rows"),
        F.count_if(before).alias("train_rows"),
        F.count_if(~before).alias("test_rows"),
    )
