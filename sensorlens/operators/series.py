"""Regular time series: binning, gap filling, per-point anomaly flags and statistics.

Rows are aggregated to bins first, with map-side partial aggregation. Every window after that
sees bins, not raw rows, and a report's bin limit bounds the bins of one key. Series of one key
are already clustered by the first of these windows, so filling, trend, fences and statistics
add no further shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from sensorlens.functions import text, timing
from sensorlens.functions.aggregates import numeric_agg
from sensorlens.operators.ordering import explode_span
from sensorlens.operators.ranges import Moment, check_order, for_tags, in_range, range_step
from sensorlens.session import hold

EMPTY_BINS = ("null", "zero", "linear")
TAG = ("tag",)


def telemetry_trend(
    df: DataFrame,
    start: Moment | None = None,
    end: Moment | None = None,
    tags: str | Sequence[str] | DataFrame | None = None,
    step: str | int = "10s",
) -> DataFrame:
    """Average reading per tag and bin."""
    return binned_aggregate(for_tags(in_range(df, start, end), tags), "avg", step)


def binned_aggregate(
    df: DataFrame, agg: str, step: str | int, by: Sequence[str] = TAG, value: str = "value"
) -> DataFrame:
    return df.groupBy(*by, timing.time_bin(F.col("timestamp"), step).alias("timestamp")).agg(
        numeric_agg(agg, F.col(value)).alias("value")
    )


def make_series(
    df: DataFrame,
    agg: str = "avg",
    step: str | int = "1hour",
    by: Sequence[str] = TAG,
    empty: str = "null",
    start: Moment | None = None,
    end: Moment | None = None,
    record_count: bool = False,
) -> DataFrame:
    """A regular grid of bins per key: ``by``, ``timestamp``, ``idx``, ``value``.

    Open form: bins are multiples of ``step`` from the key's first to its last bin. Closed form
    (``start`` and ``end`` given): all keys share the bins start, start + step, ... before
    ``end``. Empty bins get null, zero, or the linear interpolation of their neighbours.

    Each non-empty bin generates the empty bins that follow it, so no grid is joined.
    """
    if empty not in EMPTY_BINS:
        raise ValueError(f"empty must be one of {EMPTY_BINS}")
    width = timing.duration(step)
    if width <= 0:
        raise ValueError("the bin size must be positive")
    closed = start is not None and end is not None
    value = numeric_agg(agg, F.col("value")).alias("value")
    counted = F.count("*").alias("record_count")
    keys = list(by)
    ordered = Window.partitionBy(*keys).orderBy("_slot")
    following = F.lead("_slot").over(ordered)
    if closed:
        check_order(start, end)
        origin = F.unix_micros(timing.literal(start))
        inside = in_range(df, start).filter(F.col("timestamp") < timing.literal(end))
        us = F.unix_micros("timestamp")
        cells = inside.groupBy(
            *keys, F.floor((us - origin) / F.lit(width)).cast("bigint").alias("_slot")
        ).agg(value, counted)
        total = F.ceil((F.unix_micros(timing.literal(end)) - origin) / F.lit(width))
        low = F.when(F.lag("_slot").over(ordered).isNull(), F.lit(0).cast("bigint")).otherwise(
            F.col("_slot")
        )
        high = F.coalesce(following - 1, total - 1)
    else:
        base_us = F.unix_micros(timing.time_bin(F.col("timestamp"), width))
        # Whole steps since the bin origin; exact, as bins are multiples of the step.
        cells = df.groupBy(*keys, base_us.alias("_us")).agg(value, counted)
        first = F.min("_us").over(Window.partitionBy(*keys))
        cells = cells.withColumn("_origin", first).withColumn(
            "_slot", ((F.col("_us") - F.col("_origin")) / F.lit(width)).cast("bigint")
        )
        origin = F.col("_origin")
        low = F.col("_slot")
        high = F.coalesce(following - 1, F.col("_slot"))
    grid = explode_span(cells.withColumn("_hi", high), low, F.col("_hi"), "idx")
    here = F.col("idx") == F.col("_slot")
    default = F.lit(0.0) if empty == "zero" else F.lit(None).cast("double")
    columns = [
        *keys,
        F.timestamp_micros(origin + F.col("idx") * F.lit(width)).alias("timestamp"),
        "idx",
        F.when(here, F.coalesce("value", default)).otherwise(default).alias("value"),
    ]
    if record_count:
        columns.append(F.when(here, F.col("record_count")).otherwise(F.lit(0)).alias("record_count"))
    series = grid.select(*columns)
    return fill_linear(series, keys) if empty == "linear" else series


def fill_linear(series: DataFrame, by: Sequence[str] = TAG) -> DataFrame:
    """Null values become the line between the nearest readings; the edges stay flat.

    Both neighbours come from running frames (the second one over the reversed order), so the
    cost is linear in the length of the series.
    """
    known = F.when(F.col("value").isNotNull(), F.struct("idx", "value"))
    running = (Window.unboundedPreceding, Window.currentRow)
    back = Window.partitionBy(*by).orderBy("idx").rowsBetween(*running)
    ahead = Window.partitionBy(*by).orderBy(F.col("idx").desc()).rowsBetween(*running)
    before, after = F.col("_before"), F.col("_after")
    share = (F.col("idx") - before["idx"]) / (after["idx"] - before["idx"])
    between = before["value"] + (after["value"] - before["value"]) * share
    return (
        series.withColumn("_known", known)
        .withColumn("_before", F.last("_known", ignorenulls=True).over(back))
        .withColumn("_after", F.last("_known", ignorenulls=True).over(ahead))
        .withColumn(
            "value",
            F.when(F.col("value").isNotNull(), F.col("value"))
            .when(before.isNull(), after["value"])
            .when(after.isNull(), before["value"])
            .otherwise(between),
        )
        .drop("_known", "_before", "_after")
    )


# Autocorrelation from which on a series has a season, and how far below the best the shortest may lie.
_SEASONAL = 0.6
_NEAR_BEST = 0.05


def autocorrelation(x: np.ndarray, lags: int) -> np.ndarray:
    """Correlation about zero of a series with itself, ``lags`` places on, for each lag up to it.

    All products come from one Fourier transform. Its error is relative to the whole series, so
    where the overlapping parts are next to nothing beside it, they are multiplied out.
    """
    n = len(x)
    largest = np.abs(x).max(initial=0.0)
    if not largest > 0:
        return np.zeros(lags + 1)
    x = x / largest
    size = 1 << int(n + lags).bit_length()
    spectrum = np.fft.rfft(x, size)
    products = np.fft.irfft(spectrum * spectrum.conj(), size)[: lags + 1]
    squares, lag = x * x, np.arange(lags + 1)
    scale = np.sqrt(np.cumsum(squares)[n - lag - 1] * np.cumsum(squares[::-1])[n - lag - 1])
    for k in np.flatnonzero((scale > 0) & (scale < 1e-6 * scale[0])).tolist():
        products[k] = np.dot(x[: n - k], x[k:])
    return np.divide(products, scale, out=np.zeros(lags + 1), where=scale > 0)


def season_of(x: np.ndarray) -> int:
    """Season length of a detrended series, from 3 to a third of its length: the shortest lag on top
    of a hill of the autocorrelation whose height is near the best; 0 if there is none."""
    last = len(x) // 3
    if last < 3:
        return 0
    r = autocorrelation(x, last + 1)
    lags = np.arange(3, last + 1)
    top = (r[lags] >= r[lags - 1]) & (r[lags] >= r[lags + 1]) & (r[lags] >= _SEASONAL)
    lags = lags[top]
    if not len(lags):
        return 0
    # Multiples of the season score alike.
    return int(lags[r[lags] >= r[lags].max() - _NEAR_BEST][0])


@F.pandas_udf(IntegerType())
def _period(detrended: pd.Series) -> pd.Series:
    return detrended.map(lambda values: season_of(np.asarray(values, dtype=float)))


def decompose_anomalies(
    series: DataFrame,
    threshold: float = 1.5,
    seasonality: str | int = "auto",
    trend: str = "linefit",
    by: Sequence[str] = TAG,
    with_period: bool = False,
) -> DataFrame:
    """Adds ``baseline``, ``score`` and ``flag`` (-1, 0 or +1) to a filled series, and if asked
    ``period``, the season in bins (0 without one).

    The baseline is the least-squares line, plus the mean of each phase when the series has a
    season ("auto" looks for one, "none" assumes none, a number is the season in bins). The
    score is the distance of the residual beyond the 10 % or 90 % quantile, in widths of that
    quantile range; a point is flagged when the score exceeds ``threshold``.
    """
    if trend not in ("linefit", "none"):
        raise ValueError("trend is 'linefit' or 'none'")
    key = Window.partitionBy(*by)
    idx, value = F.col("idx"), F.col("value")
    level = F.avg("value").over(key)
    if trend == "linefit":
        slope = F.coalesce(F.regr_slope(value, idx).over(key), F.lit(0.0))
        middle = F.avg(F.when(value.isNotNull(), idx)).over(key)
        line = F.col("_level") + F.col("_slope") * (idx - F.col("_middle"))
        df = series.withColumns({"_level": level, "_slope": slope, "_middle": middle})
    else:
        line = F.col("_level")
        df = series.withColumns({"_level": level})
    df = df.withColumn("_line", line)

    if seasonality == "none":
        df = df.withColumn("baseline", F.col("_line")).withColumn("_period", F.lit(0))
    else:
        if seasonality == "auto":
            df = _with_period(df, by)
        else:
            df = df.withColumn("_period", F.lit(int(seasonality)))
        phase = F.when(F.col("_period") > 0, F.pmod(idx, F.col("_period")))
        same_phase = Window.partitionBy(*by, "_phase")
        season = F.when(F.col("_phase").isNull(), F.lit(0.0)).otherwise(
            F.avg(F.col("value") - F.col("_line")).over(same_phase)
        )
        df = df.withColumn("_phase", phase).withColumn("baseline", F.col("_line") + season)

    residual = value - F.col("baseline")
    df = df.withColumn("_residual", residual).withColumn(
        "_fence", F.percentile("_residual", F.array(F.lit(0.1), F.lit(0.9))).over(key)
    )
    low, high = F.col("_fence")[0], F.col("_fence")[1]
    width = high - low
    r = F.col("_residual")
    score = (
        F.when(width <= 0, F.lit(0.0))
        .when(r > high, F.try_divide(r - high, width))
        .when(r < low, F.try_divide(r - low, width))
        .otherwise(F.lit(0.0))
    )
    return (
        df.withColumn("score", score)
        .withColumn(
            "flag",
            F.when(F.abs("score") > threshold, F.signum("score").cast("int")).otherwise(F.lit(0)),
        )
        .select(
            *series.columns, "baseline", "score", "flag",
            *([F.col("_period").cast("bigint").alias("period")] if with_period else []),
        )
    )


def _with_period(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """One array per series through an Arrow batch function, then back to rows."""
    row = F.struct("idx", *[c for c in df.columns if c not in (*by, "idx")])
    packed = df.groupBy(*by).agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    detrended = F.transform(
        "_rows", lambda p: F.coalesce(p["value"] - p["_line"], F.lit(0.0))
    )
    return (
        packed.withColumn("_period", _period(detrended))
        .select(*by, "_period", F.inline("_rows"))
        .select(*df.columns, "_period")
    )


def rows_to_series(
    rows: DataFrame, by: Sequence[str] = TAG, columns: Sequence[str] = ("timestamp", "value")
) -> DataFrame:
    """One row per key with parallel arrays in time order."""
    point = F.struct(*columns)
    packed = rows.groupBy(*by).agg(F.array_sort(F.collect_list(point)).alias("_points"))
    return packed.select(*by, *[F.col("_points")[c].alias(c) for c in columns])


def series_to_rows(
    series: DataFrame, by: Sequence[str] = TAG, columns: Sequence[str] = ("timestamp", "value")
) -> DataFrame:
    """Parallel arrays back to one row per point."""
    return series.select(*by, F.inline(F.arrays_zip(*columns)))


def series_stats(
    df: DataFrame,
    agg: str = "avg",
    step: str | int = "1hour",
    by: Sequence[str] = TAG,
    empty: str = "zero",
) -> DataFrame:
    """Statistics of each series; positions are 0-based and the first one wins a tie."""
    series = make_series(df, agg, step, by, empty)
    value = F.col("value")
    name = "series_stats_value_{}".format
    return series.groupBy(*by).agg(
        F.min(value).alias(name("min")),
        F.min_by("idx", F.struct("value", "idx")).alias(name("min_idx")),
        F.max(value).alias(name("max")),
        F.max_by("idx", F.struct(value, -F.col("idx"))).alias(name("max_idx")),
        F.avg(value).alias(name("avg")),
        F.stddev_samp(value).alias(name("stdev")),
        F.var_samp(value).alias(name("variance")),
    )


# Tags of a block, at most, and bytes of their series.
_BLOCK_TAGS = 256
_BLOCK_BYTES = 32 << 20


def block_count(tags: int, bins: int) -> int:
    """Blocks for so many series of so many bins: two of them fit a task, whatever the number."""
    return max(1, -(-tags // max(1, min(_BLOCK_TAGS, _BLOCK_BYTES // (8 * max(bins, 1))))))


def correlation_matrix(
    df: DataFrame,
    start: Moment,
    end: Moment,
    step: str | int,
    tags: str | Sequence[str] | DataFrame | None = None,
    agg: str = "avg",
    blocks: int | None = None,
) -> DataFrame:
    """Pearson correlation of every pair of tags ``tag <= tag1`` on a shared, filled axis; null for
    a constant series.

    Each series becomes one standardised array, held as a table. Their number sets the number of
    blocks they are hashed into (if it isn't given), and each two blocks are one dense product.
    """
    series = make_series(for_tags(df, tags), agg, step, TAG, "linear", start, end)
    key = Window.partitionBy("tag")
    standard = F.try_divide(
        F.col("value") - F.avg("value").over(key), F.stddev_pop("value").over(key)
    )
    vectors = (
        series.withColumn("_z", F.coalesce(standard, F.lit(float("nan"))))
        .groupBy("tag")
        .agg(F.array_sort(F.collect_list(F.struct("idx", "_z"))).alias("_points"))
        .select("tag", F.col("_points._z").alias("_z"))
    )
    vectors = hold(vectors, "series-vectors")
    if blocks is None:
        bins = vectors.agg(F.count("*"), F.max(F.size("_z"))).first()
        blocks = block_count(bins[0], bins[1] or 1)
    return tag_pairs(vectors, blocks).select(
        "tag", "tag1", F.nanvl("product", F.lit(None).cast("double")).alias("correlation_coefficient")
    )


def _products(table: pa.Table) -> pa.Table:
    """Mean products of all pairs across two blocks, or within one."""
    names = table.column("tag").to_numpy(zero_copy_only=False)
    z = table.column("_z").combine_chunks()
    z = z.flatten().to_numpy(zero_copy_only=False).reshape(len(names), -1)
    mine = table.column("_mine").to_numpy(zero_copy_only=False)
    one = np.flatnonzero(mine)
    two = one if table.column("_row")[0] == table.column("_column")[0] else np.flatnonzero(~mine)
    product = z[one] @ z[two].T / z.shape[1]
    a, b = np.repeat(names[one], len(two)), np.tile(names[two], len(one))
    if two is one:
        keep = a <= b
        a, b, product = a[keep], b[keep], product.ravel()[keep]
    turned = a > b
    columns = [np.where(turned, b, a), np.where(turned, a, b), product.ravel()]
    return pa.table(
        [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.float64())],
        names=["tag", "tag1", "product"],
    )


def tag_pairs(vectors: DataFrame, blocks: int) -> DataFrame:
    """``tag``, ``tag1``, ``product``: all pairs ``tag <= tag1`` of rows with ``tag`` and ``_z``
    (arrays of one length), with the mean of the products of their elements.

    A row goes once to each pair of blocks that its own is in, so a pair of tags meets once.
    """
    block = F.pmod(F.xxhash64("tag"), F.lit(blocks).cast("bigint"))
    dealt = vectors.select("tag", "_z", block.alias("_block")).withColumn(
        "_other", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)"))
    )
    dealt = dealt.select(
        "tag", "_z",
        F.least("_block", "_other").alias("_row"), F.greatest("_block", "_other").alias("_column"),
        (F.col("_block") <= F.col("_other")).alias("_mine"),
    )
    return dealt.groupBy("_row", "_column").applyInArrow(_products, "tag string, tag1 string, product double")


def mv_severity_by_bin(
    explanations: DataFrame,
    step: str | int,
    start: Moment | None = None,
    end: Moment | None = None,
    severity: float = 0.05,
    contribution: float = 0.05,
) -> DataFrame:
    """Greatest severity per tag and bin among the anomalies that matter to the tag."""
    return (
        in_range(explanations, start, end)
        .filter(
            F.col("is_anomaly")
            & (F.col("severity") >= severity)
            & (F.col("contribution_score") >= contribution)
        )
        .groupBy("tag", timing.time_bin(F.col("timestamp"), step).alias("timestamp"))
        .agg(F.max("severity").alias("mvad_anomaly"))
    )


def attach_mv_anomalies(series: DataFrame, mv: DataFrame) -> DataFrame:
    return series.join(mv, ["tag", "timestamp"], "left")


def attach_tag_columns(series: DataFrame, tags: DataFrame) -> DataFrame:
    """Metric and component of each tag; a tag the dimension lacks keeps its rows."""
    return series.join(tags.select("tag", "metric", "component"), "tag", "left")


def series_with_anomalies(
    telemetry: DataFrame,
    tags_dim: DataFrame,
    explanations: DataFrame,
    start: Moment,
    end: Moment,
    tags: str | Sequence[str] | DataFrame | None = None,
    agg: str = "avg",
    bin_label: str = timing.AUTO_LABEL,
    max_bins: int = timing.DEFAULT_MAX_BINS,
    severity: float = 0.05,
    contribution: float = 0.05,
    seasonality: str | int = "auto",
    threshold: float = 1.5,
    strict_reference: bool = False,
) -> DataFrame:
    """Gap-filled series of the chosen tags with single- and multi-sensor anomalies."""
    step = range_step(start, end, bin_label, max_bins)
    mv = mv_severity_by_bin(
        for_tags(explanations, tags), step, start, end, severity, contribution
    )
    series = make_series(
        for_tags(in_range(telemetry, start, end), tags), agg, step, empty="linear"
    )
    flagged = decompose_anomalies(series, threshold, seasonality)
    flag, mv_severity, value = F.col("flag"), F.col("mvad_anomaly"), F.col("value")
    points = attach_mv_anomalies(flagged.select("tag", "timestamp", "value", "flag"), mv)
    individual = flag != 0
    multi = F.coalesce(mv_severity != 0, F.lit(False))
    return attach_tag_columns(points, tags_dim).select(
        "tag",
        "timestamp",
        "value",
        F.when(individual | multi, value).alias("anomaly"),
        F.when(individual, value).alias("individual_anomaly"),
        F.when(multi, mv_severity).alias("mvad_anomaly"),
        text.anomaly_indicator(flag, mv_severity).alias("anomaly_indicator"),
        "metric",
        "component",
        text.marker_color(flag, mv_severity, value, strict_reference).alias("marker_color"),
    )


# The chart layouts a report can choose, as (split by, colour by).
CHART_LAYOUTS = (("metric", "component"), ("component", "metric"), ("none", "tag"), ("tag", "none"))
ROLLUP_COLUMNS = ("tag", "component", "metric", "none")


def series_rollup(points: DataFrame, split_by: str = "tag", legend_by: str = "none") -> DataFrame:
    """Chart totals per bin: values are summed and the smallest marker colour is kept."""
    for name in (split_by, legend_by):
        if name not in ROLLUP_COLUMNS:
            raise ValueError(f"{name!r} is not one of {ROLLUP_COLUMNS}")
    dims: list[Column] = []
    if split_by != "none":
        dims.append(F.col(split_by).alias("split_by"))
    if legend_by != "none":
        dims.append(F.col(legend_by).alias("legend_by"))
    return points.groupBy("timestamp", *dims).agg(
        F.sum("value").alias("value"), F.min("marker_color").alias("marker_color")
    )
