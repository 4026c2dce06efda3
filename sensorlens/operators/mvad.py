"""Multi-sensor anomaly detection per asset: Hotelling's T-squared with its decomposition.

Sensor readings of an asset are averaged to bins and standardised; one bin is one vector z in
feature order. With R the correlation matrix of the training bins and P = inverse(R + ridge I),

    T2 = z' P z / d        contribution of sensor i = max(z_i (P z)_i, 0) / sum

A bin is an anomaly when T2 exceeds the 99th percentile of the training bins, and its severity is
1 - threshold / T2. "diagonal" mode uses P = I. A missing reading counts as z = 0. All assets are
fitted and scored in one plan; only d x d matrices are ever gathered per asset.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from sensorlens.functions import timing
from sensorlens.functions.aggregates import AGGREGATIONS
from sensorlens.operators.assets import model_asof
from sensorlens.operators.ranges import Moment, in_range, split_counts
from sensorlens.session import hold
from sensorlens.sources.files import append_table

RIDGE = 1e-3
QUANTILE = 0.99
# Rank accuracy of the threshold: exact up to this many training bins per asset, and within
# 1/QUANTILE_ACCURACY of the rank beyond, from a mergeable sketch of bounded size.
QUANTILE_ACCURACY = 100_000
# Fixed value: bins in the trailing window of the detector.
SLIDING_WINDOW = 280
# Features that one row of the widening aggregate holds; keeps it inside generated code.
_SLAB = 32
# Partial matrices held by one task before they are handed on.
_HELD_CELLS = 4_000_000


def feature_lists(features: DataFrame) -> DataFrame:
    """One row per asset: its tags in feature order."""
    cell = F.struct("ordinal", "tag")
    return features.groupBy("asset").agg(F.array_sort(F.collect_list(cell))["tag"].alias("tags"))


def asset_frames(
    telemetry: DataFrame, features: DataFrame, step: str | int, agg: str = "avg"
) -> DataFrame:
    """``asset, timestamp, values``: one row per asset and bin, readings in feature order.

    A reading goes straight into the slot of its feature, so binning and widening are one hash
    aggregation with map-side partials and one shuffle. Features beyond ``_SLAB`` go into
    further rows of slots that are put side by side afterwards.
    """
    places = feature_lists(features).select(
        "asset", F.posexplode("tags").alias("_place", "tag")
    )
    width = (places.agg(F.max("_place")).first()[0] or 0) + 1
    if agg not in AGGREGATIONS:
        raise ValueError(f"aggregation {agg!r} is not one of {sorted(AGGREGATIONS)}")
    call = "count(DISTINCT {})" if agg == "count_distinct" else agg + "({})"
    slots = [
        F.expr(f"double({call.format(f'CASE WHEN _slot = {i} THEN value END')}) AS _v{i}")
        for i in range(min(width, _SLAB))
    ]
    rows = telemetry.join(places, "tag").select(
        "asset",
        timing.time_bin(F.col("timestamp"), step).alias("timestamp"),
        "value",
        F.floor(F.col("_place") / _SLAB).cast("int").alias("_slab"),
        F.pmod("_place", F.lit(_SLAB)).alias("_slot"),
    )
    together = F.array(*[f"_v{i}" for i in range(len(slots))])
    if width <= _SLAB:
        frames = rows.groupBy("asset", "timestamp").agg(*slots)
        frames = frames.select("asset", "timestamp", together.alias("values"))
    else:
        parts = rows.groupBy("asset", "timestamp", "_slab").agg(*slots)
        parts = parts.select("asset", "timestamp", "_slab", together.alias("_values"))
        nothing = F.array_repeat(F.lit(None).cast("double"), _SLAB)
        slabs = [
            F.coalesce(
                F.first(F.when(F.col("_slab") == k, F.col("_values")), ignorenulls=True), nothing
            )
            for k in range(-(-width // _SLAB))
        ]
        frames = parts.groupBy("asset", "timestamp").agg(
            F.slice(F.concat(*slabs), 1, width).alias("values")
        )
    return frames.filter(F.exists("values", lambda v: v.isNotNull()))


def _moments(frames: DataFrame) -> DataFrame:
    """Mean and deviation per asset and place, over the bins that have a reading."""
    cells = frames.select("asset", F.posexplode("values").alias("_place", "_value"))
    return cells.groupBy("asset", "_place").agg(
        F.avg("_value").alias("mean"),
        F.stddev_samp("_value").alias("sd"),
        F.count("_value").alias("bins"),
    )


def mvad_moments(frames: DataFrame, features: DataFrame) -> DataFrame:
    """``asset, tag, mean, sd, bins`` of each feature."""
    return (
        _moments(frames)
        .join(feature_lists(features), "asset")
        .filter(F.col("_place") < F.size("tags"))
        .select("asset", F.col("tags")[F.col("_place")].alias("tag"), "mean", "sd", "bins")
    )


def scales(frames: DataFrame, features: DataFrame) -> DataFrame:
    """One row per asset: tags, means and deviations as arrays in feature order."""
    cell = F.struct("_place", "mean", "sd")
    return (
        _moments(frames)
        .groupBy("asset")
        .agg(F.array_sort(F.collect_list(cell)).alias("_cells"))
        .join(feature_lists(features), "asset")
        .withColumn("_cells", F.slice("_cells", F.lit(1), F.size("tags")))
        .select(
            "asset", "tags", F.col("_cells.mean").alias("means"), F.col("_cells.sd").alias("sds")
        )
    )


def vectors(frames: DataFrame, scale: DataFrame) -> DataFrame:
    """``asset, timestamp, z, missing``: one standardised vector per asset and bin."""
    value = F.col("values")

    def standard(f: Column, at: Column) -> Column:
        return F.coalesce(F.try_divide(value[at] - f["means"], f["sds"]), F.lit(0.0))

    own = F.slice("values", F.lit(1), F.size("tags"))
    return frames.join(scale.select("asset", "tags", "means", "sds"), "asset").select(
        "asset",
        "timestamp",
        F.transform(F.arrays_zip("means", "sds"), standard).alias("z"),
        F.size(F.filter(own, lambda v: v.isNull())).alias("missing"),
    )


def _partial_products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of z z' per asset over the rows of one task."""
    sums: dict[str, np.ndarray] = {}

    def handed_on() -> pa.RecordBatch:
        cells = pa.array([m.ravel() for m in sums.values()], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), cells], ["asset", "products"]
        )

    held = 0
    for batch in batches:
        assets = batch.column("asset").dictionary_encode()
        codes = assets.indices.to_numpy()
        z = batch.column("z")
        for code, asset in enumerate(assets.dictionary.to_pylist()):
            mine = z.filter(pa.array(codes == code))
            matrix = mine.flatten().to_numpy().reshape(len(mine), -1)
            product = matrix.T @ matrix
            if asset in sums:
                sums[asset] += product
            else:
                sums[asset] = product
                held += product.size
        if held > _HELD_CELLS:
            yield handed_on()
            sums.clear()
            held = 0
    if sums:
        yield handed_on()


def correlations(vecs: DataFrame) -> DataFrame:
    """One row per asset with its correlation matrix as a flat, row-major array.

    Each task adds up the products of its own rows, so what is shuffled is one small matrix per
    task and asset, however many bins an asset has.
    """
    partial = vecs.select("asset", "z").mapInArrow(
        _partial_products, "asset string, products array<double>"
    )
    gathered = (
        partial.select("asset", F.posexplode("products").alias("_at", "_product"))
        .groupBy("asset", "_at")
        .agg(F.sum("_product").alias("_product"))
        .groupBy("asset")
        .agg(F.array_sort(F.collect_list(F.struct("_at", "_product"))).alias("_cells"))
        .select("asset", F.col("_cells._product").alias("_products"))
        .withColumn("_d", F.sqrt(F.size("_products")).cast("int"))
    )
    products, d = F.col("_products"), F.col("_d")

    def scaled(product: Column, at: Column) -> Column:
        row, column = F.floor(at / d).cast("int"), F.pmod(at, d)
        size = F.sqrt(products[row * (d + 1)] * products[column * (d + 1)])
        same = F.when(row == column, F.lit(1.0)).otherwise(F.lit(0.0))
        return F.when(row == column, same).otherwise(
            F.coalesce(F.try_divide(product, size), same)
        )

    return gathered.select("asset", F.transform("_products", scaled).alias("correlation"))


def correlation_rows(matrix: DataFrame, keys: Sequence[str] = ("asset",)) -> DataFrame:
    """Flat matrices with their ``tags`` to rows ``tag <= tag1``, ``correlation``."""
    d = F.size("tags")
    cells = matrix.select(*keys, "tags", F.posexplode("correlation").alias("_at", "correlation"))
    return (
        cells.withColumn("tag", F.col("tags")[F.floor(F.col("_at") / d).cast("int")])
        .withColumn("tag1", F.col("tags")[F.pmod(F.col("_at"), d)])
        .filter(F.col("tag") <= F.col("tag1"))
        .select(*keys, "tag", "tag1", "correlation")
    )


@F.pandas_udf(ArrayType(ArrayType(DoubleType())))
def _precision(correlation: pd.Series) -> pd.Series:
    def invert(flat) -> list:
        r = np.asarray(flat, dtype=float)
        d = int(round(np.sqrt(r.size)))
        return np.linalg.inv(r.reshape(d, d) + RIDGE * np.eye(d)).tolist()

    return correlation.map(invert)


def _with_score(vecs: DataFrame, model: DataFrame, diagonal: bool) -> DataFrame:
    z = F.col("z")

    def dot(row: Column) -> Column:
        return F.aggregate(
            F.zip_with(row, z, lambda p, x: p * x), F.lit(0.0), lambda s, x: s + x
        )

    if diagonal:
        parts = F.transform(z, lambda x: x * x)
    else:
        parts = F.zip_with(z, F.transform("precision", dot), lambda x, y: x * y)
    total = F.aggregate("_parts", F.lit(0.0), lambda s, x: s + x)
    return (
        vecs.join(model, "asset")
        .withColumn("_parts", parts)
        .withColumn("score", total / F.size("z"))
    )


def mvad_fit(
    frames: DataFrame,
    features: DataFrame,
    cutoff: Moment,
    window: int = SLIDING_WINDOW,
    mode: str = "full",
) -> DataFrame:
    """Model table, one row per asset, from the frame rows strictly before ``cutoff``.

    The frames of :func:`asset_frames` are read for moments, correlations and threshold, and
    usually once more for scoring: pass a held table, and the telemetry is scanned once. The
    small tables per asset are held here, so that Catalyst knows their size when it joins them.
    """
    if mode not in ("full", "diagonal"):
        raise ValueError("mode is 'full' or 'diagonal'")
    diagonal = mode == "diagonal"
    past = frames.filter(F.col("timestamp") < timing.literal(cutoff))
    model = hold(scales(past, features), "mvad-scales")
    vecs = vectors(past, model)
    if not diagonal:
        matrices = correlations(vecs).withColumn("precision", _precision("correlation"))
        model = hold(model.join(matrices, "asset"), "mvad-matrices")
    needed = ["asset"] if diagonal else ["asset", "precision"]
    limits = (
        _with_score(vecs, model.select(*needed), diagonal)
        .groupBy("asset")
        .agg(
            F.percentile_approx("score", QUANTILE, QUANTILE_ACCURACY).alias("threshold"),
            F.count("*").alias("train_bins"),
        )
    )
    fitted = model.join(limits, "asset").withColumn("sliding_window", F.lit(window))
    return hold(fitted, "mvad-model")


def _judged(vecs: DataFrame, model: DataFrame) -> DataFrame:
    diagonal = "precision" not in model.columns
    needed = ["asset", "tags", "threshold", *([] if diagonal else ["precision", "correlation"])]
    hit = F.col("score") > F.col("threshold")
    return (
        _with_score(vecs, model.select(*needed), diagonal)
        .withColumn("is_anomaly", hit)
        .withColumn(
            "severity",
            F.when(hit, 1 - F.col("threshold") / F.col("score")).otherwise(F.lit(0.0)),
        )
    )


def mvad_score(vecs: DataFrame, model: DataFrame) -> DataFrame:
    """``asset, timestamp, score, severity, is_anomaly, missing`` for every bin."""
    return _judged(vecs, model).select(
        "asset", "timestamp", "score", "severity", "is_anomaly", "missing"
    )


def mvad_contributions(vecs: DataFrame, model: DataFrame) -> DataFrame:
    """Share of each sensor in each anomaly; shares are in [0, 1] and sum to 1."""
    return _shares(_judged(vecs, model).filter("is_anomaly")).drop("_at")


def _shares(judged: DataFrame) -> DataFrame:
    share = F.transform("_parts", lambda p: F.greatest(p, F.lit(0.0)))
    return (
        judged.withColumn("_share", share)
        .withColumn("_all", F.aggregate("_share", F.lit(0.0), lambda s, x: s + x))
        .select(
            "asset", "timestamp", "score", "severity", "is_anomaly",
            F.posexplode(F.arrays_zip("tags", "_share")).alias("_at", "_one"), "_all",
        )
        .select(
            "asset", "timestamp", "score", "severity", "is_anomaly",
            F.col("_one.tags").alias("tag"),
            F.try_divide("_one._share", "_all").alias("contribution_score"),
            F.col("_at").alias("_at"),
        )
    )


# Share of a block's squares below which a difference of running sums is no longer trusted.
_CANCELLED = 1e-7


def trailing_correlations(z: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[np.ndarray]:
    """Correlation matrices of the rows ``first`` up to, but without, ``last`` of each window; NaN
    where a column is constant in it.

    Rows are multiplied once, between the windows' ends, and running sums taken there, so a window
    costs one difference however long it is. Columns are centred on the whole block first. Where a
    window's squares are next to nothing beside the running sums, its own rows are multiplied.
    """
    z = z - z.mean(axis=0)
    edges = np.unique(np.concatenate((first, last)))
    d = z.shape[1]
    sums, products = np.zeros((len(edges), d)), np.zeros((len(edges), d, d))
    for k in range(1, len(edges)):
        part = z[edges[k - 1] : edges[k]]
        sums[k] = sums[k - 1] + part.sum(axis=0)
        products[k] = products[k - 1] + part.T @ part
    total = np.diagonal(products[-1]) if len(edges) else np.zeros(d)
    for a, b in zip(first.tolist(), last.tolist()):
        i, j = np.searchsorted(edges, (a, b))
        moved = sums[j] - sums[i]
        product = products[j] - products[i] - np.outer(moved, moved) / (b - a)
        if (np.diagonal(product) <= _CANCELLED * total).any():
            part = z[a:b] - z[a:b].mean(axis=0)
            constant = (z[a:b] == z[a]).all(axis=0)
            part[:, constant] = 0.0
            product = part.T @ part
        size = np.sqrt(np.diagonal(product))
        scale = np.outer(size, size)
        yield np.divide(product, scale, out=np.full_like(product, np.nan), where=scale > 0)


def window_correlations(
    targets: DataFrame, vecs: DataFrame, step: str | int, window: int = SLIDING_WINDOW
) -> DataFrame:
    """Correlation matrix of the ``window`` bins that end at each target (asset, timestamp).

    Bins are cut into blocks of a fixed number of steps, each with the window - 1 bins before
    it, and only blocks that hold a target are shuffled. A group is one (asset, block), so its
    size is bounded whatever the history of an asset. The matrix comes back as a flat array.
    """
    width = timing.duration(step)
    block = max(4096, 4 * window)
    number = F.floor(F.unix_micros("timestamp") / F.lit(width))
    marked = targets.select("asset", "timestamp").withColumn("_target", F.lit(True))
    wanted = marked.select("asset", F.floor(number / block).alias("_block")).distinct()
    own = F.floor(F.col("_number") / block)
    halo = F.floor((F.col("_number") + (window - 1)) / block)
    rows = (
        vecs.select("asset", "timestamp", "z")
        .withColumn("_number", number)
        .withColumn("_block", F.explode(F.array_distinct(F.array(own, halo))))
        .join(wanted, ["asset", "_block"], "left_semi")
        .join(marked, ["asset", "timestamp"], "left")
        .select(
            "asset", "_block", "timestamp", "_number", "z",
            (F.coalesce("_target", F.lit(False)) & (own == F.col("_block"))).alias("_target"),
        )
    )

    def trailing(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_number")
        at = frame["_number"].to_numpy()
        z = np.stack(frame["z"].to_list())
        places = np.flatnonzero(frame["_target"].to_numpy())
        first = np.searchsorted(at, at[places] - window + 1)
        out = [
            [None if np.isnan(v) else v for v in r.ravel().tolist()]
            for r in trailing_correlations(z, first, places + 1)
        ]
        hit = frame.iloc[places]
        return pd.DataFrame(
            {"asset": hit["asset"], "timestamp": hit["timestamp"], "window_correlation": out}
        )

    return rows.groupBy("asset", "_block").applyInPandas(
        trailing, "asset string, timestamp timestamp, window_correlation array<double>"
    )


def mvad_explain(
    vecs: DataFrame, model: DataFrame, step: str | int, window: int = SLIDING_WINDOW
) -> DataFrame:
    """Explanations: contributions plus, per sensor, how far its correlation with every other
    sensor moved from the trained one over the trailing window, largest move first.

    ``vecs`` is read twice; hold it as a table when it is costly to compute.
    """
    judged = _judged(vecs, model).filter("is_anomaly")
    judged = hold(
        judged.select(
            "asset", "timestamp", "score", "severity", "is_anomaly", "tags", "_parts"
        ),
        "mvad-anomalies",
    )
    shares = _shares(judged)
    targets = judged.select("asset", "timestamp")
    moved = window_correlations(targets, vecs, step, window).join(
        model.select("asset", "tags", "correlation"), "asset"
    )
    d, at = F.size("tags"), F.col("_at")

    def partner(tag: Column, column: Column) -> Column:
        cell = at * d + column
        change = F.abs(F.col("window_correlation")[cell] - F.col("correlation")[cell])
        return F.struct((-change).alias("order"), tag.alias("tag"), change.alias("change"))

    others = F.filter(
        F.transform("tags", partner),
        lambda p: p["change"].isNotNull() & (p["tag"] != F.col("tag")),
    )
    ranked = F.array_sort(others)
    return (
        shares.join(moved, ["asset", "timestamp"])
        .withColumn("_ranked", ranked)
        .select(
            "asset", "timestamp", "score", "severity", "is_anomaly", "tag", "contribution_score",
            F.struct(
                F.col("_ranked.tag").alias("changed_variables"),
                F.col("_ranked.change").alias("changed_values"),
            ).alias("correlation_changes"),
        )
    )


def register_model(df: DataFrame, path: str, batch: str | int | None = None) -> None:
    """Appends ``asset, model_uri, sliding_window, effective_date`` rows to the model table; a
    training that names its ``batch`` may be registered again."""
    append_table(df.select("asset", "model_uri", "sliding_window", "effective_date"), path, batch=batch)


def pick_model(models: DataFrame, at: Moment) -> DataFrame:
    return model_asof(models, at)


def new_anomalies(scored: DataFrame, stored: DataFrame) -> DataFrame:
    """Scored rows newer than the newest stored row of their asset."""
    newest = hold(
        stored.groupBy("asset").agg(F.max("timestamp").alias("_newest")), "newest-anomalies"
    )
    fresh = F.col("_newest").isNull() | (F.col("timestamp") > F.col("_newest"))
    return scored.join(newest, "asset", "left").filter(fresh).drop("_newest")


def mvad_new_anomalies(
    telemetry: DataFrame,
    features: DataFrame,
    model: DataFrame,
    stored: DataFrame,
    step: str | int,
    window: int = SLIDING_WINDOW,
) -> DataFrame:
    """Scores of the bins that are newer than the stored ones, in the shape that is sent on:
    ``is_anomaly, asset, timestamp, score, severity, interpretation``.

    ``interpretation`` is the explanation as JSON text, null for a bin that is no anomaly. The
    newest stored time bounds the scan; the trailing window before it is read as well.
    """
    newest = stored.groupBy("asset").agg(F.max("timestamp").alias("_newest"))
    newest = hold(feature_lists(features).select("asset").join(newest, "asset", "left"), "newest")
    # An asset without stored rows is scored from its beginning.
    first = newest.agg(
        F.when(F.count("_newest") == F.count("*"), F.min("_newest")).alias("first")
    ).first()["first"]
    if first is not None:
        lookback = F.make_dt_interval(secs=F.lit(window * timing.duration(step) / timing.SECOND))
        telemetry = telemetry.filter(F.col("timestamp") >= F.lit(first) - lookback)
    vecs = hold(vectors(asset_frames(telemetry, features, step), model), "mvad-vectors")
    known = newest.filter(F.col("_newest").isNotNull()).withColumnRenamed("_newest", "timestamp")
    fresh = new_anomalies(mvad_score(vecs, model), known)
    part = F.struct("tag", "contribution_score", "correlation_changes")
    told = (
        mvad_explain(vecs, model, step, window)
        .groupBy("asset", "timestamp")
        .agg(F.to_json(F.array_sort(F.collect_list(part))).alias("interpretation"))
    )
    return fresh.join(told, ["asset", "timestamp"], "left").select(
        F.col("is_anomaly").cast("bigint").alias("is_anomaly"),
        "asset", "timestamp", "score", "severity", "interpretation",
    )


def fit_report(
    telemetry: DataFrame,
    features: DataFrame,
    cutoff: Moment,
    window: int = SLIDING_WINDOW,
    start: Moment | None = None,
    end: Moment | None = None,
) -> DataFrame:
    """Samples, features, cutoff and window per asset. Rows are counted per tag first."""
    counts = split_counts(in_range(telemetry, start, end), cutoff, ["tag"])
    return (
        features.select("asset", "tag")
        .join(counts, "tag", "left")
        .groupBy("asset")
        .agg(
            F.coalesce(F.sum("total_rows"), F.lit(0)).alias("total_rows"),
            F.coalesce(F.sum("train_rows"), F.lit(0)).alias("train_rows"),
            F.coalesce(F.sum("test_rows"), F.lit(0)).alias("test_rows"),
            F.count("*").alias("features"),
        )
        .withColumn("cutoff", timing.literal(cutoff))
        .withColumn("sliding_window", F.lit(window))
    )
