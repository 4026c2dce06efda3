"""Fit state of the multi-sensor detector per asset and day, so that a fit reads no history.

For each day and pair of an asset's sensors a row holds, over the bins that have both readings,
their number, the sums of their deviations from the day's means, and the sum of the products of
those deviations. States of any days merge into the moments and correlations of all their bins:
deviations are moved from the days' means to the common mean before they are added, so nothing
large is subtracted from anything large. Sensors may come and go between days.

The threshold's quantile comes from counts of scores in buckets whose bounds grow by a fixed factor.
A day's scores are taken when the day is stored, by the model of all days up to the last one stored
with it, and are not taken again; so storing a day reads that day's readings and the states only.

Both tables have ``day=`` folders that are replaced when a day is stored again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorlens.functions import timing
from sensorlens.operators.mvad import (
    QUANTILE,
    SLIDING_WINDOW,
    _HELD_CELLS,
    _precision,
    _with_score,
    asset_frames,
    feature_lists,
    vectors,
)
from sensorlens.operators.ranges import Moment
from sensorlens.session import hold
from sensorlens.sources.files import read_telemetry

# Upper bound of a bucket of scores over its lower bound: the threshold is at most this much too high.
BUCKET_FACTOR = 1.001
# Scores up to this one share a bucket.
LEAST_SCORE = 1e-9

PAIRS = (
    "asset string, tag string, tag1 string, n bigint, centre double, centre1 double, "
    "total double, total1 double, product double, day date"
)
SCORES = "asset string, bucket bigint, n bigint, day date"


def _day() -> Column:
    return F.to_date("timestamp").alias("day")


def _partial_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per asset and day the sums over the rows of one task, as flat d x d matrices."""
    sums: dict[tuple, np.ndarray] = {}
    names = ["asset", "day", "n", "total", "total1", "product"]

    def handed_on() -> pa.RecordBatch:
        keys = list(zip(*sums))
        cells = [pa.array([m[k].ravel() for m in sums.values()], pa.list_(pa.float64())) for k in range(4)]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[0], pa.string()), pa.array(keys[1], pa.date32()), *cells], names
        )

    held = 0
    for batch in batches:
        places: dict[tuple, list[int]] = {}
        for at, key in enumerate(zip(batch.column("asset").to_pylist(), batch.column("day").to_pylist())):
            places.setdefault(key, []).append(at)
        off = batch.column("off")
        for key, rows in places.items():
            mine = off.take(pa.array(rows))
            x = mine.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
            there = ~np.isnan(x)
            x = np.where(there, x, 0.0)
            there = there.astype(float)
            total = x.T @ there
            matrices = np.stack([there.T @ there, total, total.T, x.T @ x])
            if key in sums:
                sums[key] += matrices
            else:
                sums[key] = matrices
                held += matrices.size
        if held > _HELD_CELLS:
            yield handed_on()
            sums.clear()
            held = 0
    if sums:
        yield handed_on()


def day_pairs(frames: DataFrame, features: DataFrame) -> DataFrame:
    """The states (columns of :data:`PAIRS`) of every day that the frames cover.

    Frames are read twice: pass a held table. A pair of sensors without a common bin has no row.
    Tasks add up matrices of their rows and these are added map-side first, so what an asset's day
    shuffles is a few numbers for each pair and task.
    """
    lists = feature_lists(features)
    own = frames.join(lists, "asset").select(
        "asset", _day(), F.slice("values", F.lit(1), F.size("tags")).alias("values")
    )
    cells = own.select("asset", "day", F.posexplode("values").alias("_place", "_value"))
    mean = F.array_sort(F.collect_list(F.struct("_place", "_mean")))["_mean"].alias("centres")
    centres = (
        cells.groupBy("asset", "day", "_place")
        .agg(F.coalesce(F.avg("_value"), F.lit(0.0)).alias("_mean"))
        .groupBy("asset", "day")
        .agg(mean)
    )
    centres = hold(centres, "day-centres")
    off = F.zip_with("values", "centres", lambda v, c: F.coalesce(v - c, F.lit(float("nan"))))
    partial = own.join(centres, ["asset", "day"]).select("asset", "day", off.alias("off")).mapInArrow(
        _partial_pairs,
        "asset string, day date, n array<double>, total array<double>, total1 array<double>, product array<double>",
    )
    sums = [F.sum(f"_cell.{c}").alias(c) for c in ("n", "total", "total1", "product")]
    cell = F.posexplode(F.arrays_zip("n", "total", "total1", "product")).alias("_at", "_cell")
    summed = partial.select("asset", "day", cell).groupBy("asset", "day", "_at").agg(*sums)
    d = F.size("tags")
    row, column = F.floor(F.col("_at") / d).cast("int"), F.pmod(F.col("_at"), d)
    return (
        summed.join(centres, ["asset", "day"])
        .join(lists, "asset")
        .select(
            "asset", F.col("tags")[row].alias("tag"), F.col("tags")[column].alias("tag1"),
            F.col("n").cast("bigint").alias("n"),
            F.col("centres")[row].alias("centre"), F.col("centres")[column].alias("centre1"),
            "total", "total1", "product", "day",
        )
        .filter((F.col("tag") <= F.col("tag1")) & (F.col("n") > 0))
    )


def merged_pairs(pairs: DataFrame) -> DataFrame:
    """States of any days as one: ``asset, tag, tag1, n, mean, mean1, product``, products of
    deviations from the means of all days' bins."""
    own = pairs.filter("tag = tag1").groupBy("asset", "tag").agg(
        (F.sum(F.col("n") * F.col("centre") + F.col("total")) / F.sum("n")).alias("mean")
    )
    own = hold(own, "fit-means")
    other = own.select("asset", F.col("tag").alias("tag1"), F.col("mean").alias("mean1"))
    shift, shift1 = F.col("centre") - F.col("mean"), F.col("centre1") - F.col("mean1")
    moved = (
        F.col("product") + shift * F.col("total1") + shift1 * F.col("total") + F.col("n") * shift * shift1
    )
    return (
        pairs.join(own, ["asset", "tag"])
        .join(other, ["asset", "tag1"])
        .groupBy("asset", "tag", "tag1")
        .agg(
            F.sum("n").alias("n"), F.first("mean").alias("mean"), F.first("mean1").alias("mean1"),
            F.sum(moved).alias("product"),
        )
    )


def merged_moments(merged: DataFrame) -> DataFrame:
    """``asset, tag, mean, sd, bins`` of each sensor."""
    return merged.filter("tag = tag1").select(
        "asset", "tag", "mean",
        F.sqrt(F.try_divide("product", F.col("n") - 1)).alias("sd"), F.col("n").alias("bins"),
    )


def merged_correlations(merged: DataFrame) -> DataFrame:
    """``asset, tag, tag1, correlation`` for tag <= tag1, as the detector sees them: a bin without
    one of the readings adds nothing to the product, but the other's to its deviation. A constant
    sensor correlates with none but itself."""
    own = hold(merged.filter("tag = tag1").select("asset", "tag", F.col("product").alias("square")), "fit-squares")
    other = own.select("asset", F.col("tag").alias("tag1"), F.col("square").alias("square1"))
    same = F.when(F.col("tag") == F.col("tag1"), F.lit(1.0)).otherwise(F.lit(0.0))
    ratio = F.coalesce(F.try_divide("product", F.sqrt(F.col("square") * F.col("square1"))), same)
    return merged.join(own, ["asset", "tag"]).join(other, ["asset", "tag1"]).select(
        "asset", "tag", "tag1", F.when(F.col("tag") == F.col("tag1"), same).otherwise(ratio).alias("correlation")
    )


def _model(merged: DataFrame, features: DataFrame, mode: str) -> DataFrame:
    """``asset, tags, means, sds`` and, in full mode, ``correlation`` and ``precision``."""
    lists = feature_lists(features)
    places = lists.select("asset", "tags", F.posexplode("tags").alias("_place", "tag"))
    cell = F.struct("_place", "mean", "sd")
    model = (
        places.join(merged_moments(merged), ["asset", "tag"], "left")
        .groupBy("asset", "tags")
        .agg(F.array_sort(F.collect_list(cell)).alias("_cells"))
        .select("asset", "tags", F.col("_cells.mean").alias("means"), F.col("_cells.sd").alias("sds"))
        .filter(F.exists("means", lambda m: m.isNotNull()))
    )
    if mode == "diagonal":
        return hold(model, "fit-model")
    known = merged_correlations(merged)
    turned = known.filter("tag < tag1").select(
        "asset", F.col("tag1").alias("tag"), F.col("tag").alias("tag1"), "correlation"
    )
    grid = places.select("asset", "tag", "_place", F.posexplode("tags").alias("_place1", "tag1"))
    same = F.when(F.col("_place") == F.col("_place1"), F.lit(1.0)).otherwise(F.lit(0.0))
    value = F.coalesce("correlation", same).alias("value")
    matrices = (
        grid.join(known.unionByName(turned), ["asset", "tag", "tag1"], "left")
        .groupBy("asset")
        .agg(F.array_sort(F.collect_list(F.struct("_place", "_place1", value)))["value"].alias("correlation"))
    )
    matrices = matrices.withColumn("precision", _precision("correlation"))
    return hold(model.join(matrices, "asset"), "fit-model")


def _write(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )


def _stored(spark: SparkSession, path: str, schema: str, before: Moment | None) -> DataFrame:
    table = spark.read.schema(schema).parquet(path)
    return table if before is None else table.filter(F.col("day") < timing.literal(before).cast("date"))


def store_days(frames: DataFrame, features: DataFrame, path: str, mode: str = "full") -> None:
    """Stores the states and the score counts of every day that the frames cover, whole days only.

    A day that is stored already is replaced. Frames without rows store nothing. Days must be
    stored in time order, for scores are by the model of all days up to the last one given.
    """
    if mode not in ("full", "diagonal"):
        raise ValueError("mode is 'full' or 'diagonal'")
    spark = frames.sparkSession
    last = frames.agg(F.max("timestamp")).first()[0]
    if last is None:
        return
    _write(day_pairs(frames, features), f"{path}/pairs")
    known = _stored(spark, f"{path}/pairs", PAIRS, None).filter(F.col("day") <= F.lit(last.date()))
    model = _model(merged_pairs(known), features, mode)
    needed = ["asset"] if mode == "diagonal" else ["asset", "precision"]
    scored = _with_score(vectors(frames, model), model.select(*needed), mode == "diagonal")
    bucket = F.floor(F.ln(F.greatest("score", F.lit(LEAST_SCORE))) / F.lit(float(np.log(BUCKET_FACTOR))))
    counts = scored.groupBy("asset", bucket.alias("bucket"), _day()).agg(F.count("*").alias("n"))
    _write(counts.select("asset", "bucket", "n", "day"), f"{path}/scores")


def store_range(
    spark: SparkSession, telemetry: str, features: DataFrame, path: str,
    first: Moment, last: Moment, step: str | int, mode: str = "full",
) -> None:
    """:func:`store_days` for the days from ``first`` to ``last`` of a table of readings in
    ``date=`` folders. No other day's readings are opened."""
    days = [str(day)[:10] for day in (first, last)]
    readings = read_telemetry(spark, telemetry, f"{days[0]} 00:00:00", f"{days[1]} 23:59:59.999999")
    frames = asset_frames(readings, features, step)
    store_days(hold(frames, "frames"), features, path, mode)


def limits(scores: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``asset, threshold, train_bins`` from counts by bucket: the upper bound of the bucket that
    holds the quantile, so at least that share of the scores is not above it."""
    summed = scores.groupBy("asset", "bucket").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy("asset")
    upto = F.sum("n").over(whole.orderBy("bucket"))
    ranked = summed.withColumn("_upto", upto).withColumn("_all", F.sum("n").over(whole))
    reached = ranked.filter(F.col("_upto") >= F.ceil(F.col("_all") * F.lit(quantile)))
    return reached.groupBy("asset").agg(
        F.pow(F.lit(BUCKET_FACTOR), F.min("bucket") + 1).alias("threshold"),
        F.first("_all").alias("train_bins"),
    )


def fit_stored(
    spark: SparkSession, features: DataFrame, path: str, before: Moment | None = None,
    window: int = SLIDING_WINDOW, mode: str = "full",
) -> DataFrame:
    """The model table of :func:`~sensorlens.operators.mvad.mvad_fit` from stored days, those
    before the day of ``before`` or all; it serves scoring and explanation alike."""
    model = _model(merged_pairs(_stored(spark, f"{path}/pairs", PAIRS, before)), features, mode)
    found = limits(_stored(spark, f"{path}/scores", SCORES, before))
    return hold(model.join(found, "asset").withColumn("sliding_window", F.lit(window)), "fit-model")
