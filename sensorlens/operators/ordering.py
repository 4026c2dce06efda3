"""Order-dependent helpers that never put all rows of one key into one task.

A key may own a third of all rows, so a window over the key alone would sort them in a single
task. These helpers window over (key, time chunk), summarise each chunk, run the window that
crosses chunks over those summaries only, and join the carried value back. The results are the
same as those of the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlens.functions import timing


def time_chunk(column: str, chunk: str | int) -> Column:
    """Number of the chunk; never null, so that joins on it add no filter of their own."""
    number = F.floor(F.unix_micros(F.col(column)) / F.lit(timing.duration(chunk)))
    return F.coalesce(number, F.lit(0).cast("bigint"))


def ordered_index(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    chunk: str | int = "1day",
    out: str = "idx",
) -> DataFrame:
    """0-based position of each row within its key. ``order[0]`` is a timestamp."""
    chunked = df.withColumn("_chunk", time_chunk(order[0], chunk))
    inside = Window.partitionBy(key, "_chunk").orderBy(*order)
    across = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        chunked.groupBy(key, "_chunk")
        .agg(F.count("*").alias("_size"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(across), F.lit(0)))
        .drop("_size")
    )
    return (
        chunked.join(sizes, [key, "_chunk"])
        .withColumn(out, F.row_number().over(inside) - 1 + F.col("_before"))
        .drop("_chunk", "_before")
    )


def explode_span(df: DataFrame, low: Column, high: Column, out: str, piece: int = 4096) -> DataFrame:
    """One row per whole number in ``low..high``, generated in bounded pieces so that a long
    gap never becomes one huge array. A span with ``high < low`` gives no rows."""
    start = F.col("_piece")
    return (
        df.withColumn("_low", low)
        .withColumn("_high", high)
        .filter(F.col("_low") <= F.col("_high"))
        .withColumn("_piece", F.explode(F.sequence("_low", "_high", F.lit(piece).cast("bigint"))))
        .withColumn(
            out, F.explode(F.sequence(start, F.least(start + F.lit(piece - 1), F.col("_high"))))
        )
        .drop("_low", "_high", "_piece")
    )


def sustained_runs(
    df: DataFrame,
    threshold: float = 0.1,
    period: str | int = "10min",
    max_gap: str | int | None = None,
    key: str = "asset",
    chunk: str | int = "1day",
) -> DataFrame:
    """Runs in which ``severity >= threshold`` held for at least ``period``.

    A run starts at the first qualifying event after a break and breaks at an event below the
    threshold (or, with ``max_gap``, after a longer silence). Each run that lasts long enough
    gives one row: its start, and the first event at least ``period`` after that start.
    """
    low = ~F.coalesce(F.col("severity") >= threshold, F.lit(False))
    us = F.unix_micros("timestamp")
    # The rows are read by two branches, the chunk summaries and the final pick. Both see the same
    # filters and columns, so their sort by (key, chunk) comes from one shuffle.
    chunked = (
        df.select(key, "timestamp", "severity")
        .filter(F.col(key).isNotNull() & F.col("timestamp").isNotNull())
        .withColumn("_chunk", time_chunk("timestamp", chunk))
    )
    inside = Window.partitionBy(key, "_chunk").orderBy("timestamp", "severity")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    silence = F.lit(False)
    if max_gap is not None:
        gap = us - F.unix_micros(F.lag("timestamp").over(inside))
        silence = F.coalesce(gap > timing.duration(max_gap), F.lit(False))
    marked = (
        chunked.withColumn("_low", low)
        .withColumn("_break", F.col("_low") | silence)
        .withColumn("_part", F.sum(F.col("_break").cast("int")).over(running))
    )
    # A part is the break (part 0: the chunk's begin) and the qualifying events after it.
    part = Window.partitionBy(key, "_chunk", "_part")
    good_ts = F.when(~F.col("_low"), F.col("timestamp"))
    marked = marked.withColumn("_part_start", F.min(good_ts).over(part))

    # Per chunk: does it break anywhere, and where does the run open at its end start?
    ends = (
        marked.groupBy(key, "_chunk", "_part")
        .agg(
            F.first("_part_start").alias("_part_start"),
            F.min("timestamp").alias("_first"),
            F.max("timestamp").alias("_last"),
        )
        .groupBy(key, "_chunk")
        .agg(
            (F.max("_part") > 0).alias("_broken"),
            F.max_by("_part_start", "_part").alias("_tail"),
            F.min("_first").alias("_first"),
            F.max("_last").alias("_last"),
        )
    )
    by_chunk = Window.partitionBy(key).orderBy("_chunk")
    entry_gap = F.lit(False)
    if max_gap is not None:
        gap = F.unix_micros("_first") - F.unix_micros(F.lag("_last").over(by_chunk))
        entry_gap = F.coalesce(gap > timing.duration(max_gap), F.lit(False))
    carried = (
        ends.withColumn("_entry_gap", entry_gap)
        .withColumn(
            "_span", F.sum((F.col("_broken") | F.col("_entry_gap")).cast("int")).over(by_chunk)
        )
        .withColumn(
            "_open",
            F.min("_tail").over(
                Window.partitionBy(key, "_span")
                .orderBy("_chunk")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
        .withColumn("_open", F.lag("_open").over(by_chunk))
        .select(key, "_chunk", F.when(~F.col("_entry_gap"), F.col("_open")).alias("_carry"))
    )
    start = F.when(
        F.col("_part") == 0, F.coalesce(F.col("_carry"), F.col("_part_start"))
    ).otherwise(F.col("_part_start"))
    event = F.struct("timestamp", "severity")
    return (
        marked.filter(~F.col("_low"))
        .join(carried, [key, "_chunk"])
        .withColumn("run_start", start)
        .filter(us - F.unix_micros("run_start") >= timing.duration(period))
        .groupBy(key, "run_start")
        .agg(F.min(event).alias("_hit"))
        .select(
            key,
            "run_start",
            F.col("_hit.timestamp").alias("timestamp"),
            F.col("_hit.severity").alias("severity"),
        )
    )


def first_rows(df: DataFrame, n: int = 35_000, order: Sequence[str] = ("timestamp",)) -> DataFrame:
    """The first ``n`` rows; name a unique column last in ``order`` to make ties stable."""
    return df.orderBy(*order).limit(n)
