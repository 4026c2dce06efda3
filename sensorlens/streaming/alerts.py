"""The sustained-severity rule as a stateful stream operator."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sensorlens.functions import timing
from sensorlens.operators.alerts import SUSTAINED_RULE, as_alerts
from sensorlens.streaming.ingest import TOLERANCE, with_tolerance

_OUTPUT = "asset string, run_start timestamp, timestamp timestamp, severity double"
_RUN = "run_start long, last long, fired boolean, done long"
_WAITING = "us array<long>, severity array<double>"
# Fixed value: lists per asset that waiting events are dealt to; the delay covers half of them.
_LISTS = 16
# Fixed value: the store that keeps map entries and timers apart, so each is written for itself.
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EMPTY = pd.DataFrame({"run_start": [], "us": [], "severity": []})


def advance_run(
    us: np.ndarray,
    severity: np.ndarray,
    threshold: float,
    period: int,
    max_gap: int | None,
    run_start: int | None,
    last: int | None,
    fired: bool,
) -> tuple[pd.DataFrame, int | None, int | None, bool]:
    """Feeds events in time order to the rule. Gives the alerts (``run_start``, ``us``,
    ``severity``) and the run that is open after the last event."""
    if not len(us):
        return _EMPTY, run_start, last, fired
    good = severity >= threshold
    breaks = ~good
    if max_gap is not None:
        before = np.concatenate([[us[0] if last is None else last], us[:-1]])
        breaks = breaks | (us - before > max_gap)
    part = np.cumsum(breaks)
    events = pd.DataFrame({"part": part[good], "us": us[good], "severity": severity[good]})
    events["run_start"] = events.groupby("part")["us"].transform("min")
    if run_start is not None:
        events.loc[events["part"] == 0, "run_start"] = run_start
    hits = events[events["us"] - events["run_start"] >= period].drop_duplicates("part")
    if fired:
        hits = hits[hits["part"] != 0]
    final = part[-1]
    open_run = events[events["part"] == final]
    start = int(open_run["run_start"].iloc[0]) if len(open_run) else None
    has_fired = bool((hits["part"] == final).any()) or (fired and final == 0)
    return hits, start, int(us[-1]), has_fired


class SustainedRuns(StatefulProcessor):
    """The rule for one asset: the open run, and events that wait in lists by chunks of time.

    A batch appends its own events to the lists of their chunks, a row for each ``bucket`` of time,
    and sets a timer just after the first of them in a chunk. When the watermark passes it, no event
    before the watermark can come any more: the chunk's events up to there go to the rule in time
    order, and the next one left sets a timer again. A list is emptied when its chunk is done, so
    calls to the state follow the chunks and batches, not the events. Timers of an asset fire in
    order of time. Chunks that are ``_LISTS`` apart share a list.
    """

    def __init__(self, threshold: float, period: int, max_gap: int | None, bucket_ms: int, chunk_ms: int):
        self.rule = threshold, period, max_gap
        self.bucket_us = 1000 * bucket_ms
        self.chunk_ms = chunk_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", _RUN)
        self.waiting = [handle.getListState(f"waiting{k}", _WAITING) for k in range(_LISTS)]

    def _pieces(self, us: np.ndarray, severity: np.ndarray) -> list[tuple[list[int], list[float]]]:
        """Events in time order as one row per bucket."""
        cuts = np.flatnonzero(np.diff(us // self.bucket_us)) + 1
        ends = [0, *cuts.tolist(), len(us)]
        times, levels = us.tolist(), severity.tolist()
        return [(times[a:b], levels[a:b]) for a, b in zip(ends, ends[1:])]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            us, severity = frame["us"].to_numpy("int64"), frame["severity"].to_numpy(float)
            order = np.argsort(us)
            us, severity = us[order], severity[order]
            chunks = us // (1000 * self.chunk_ms)
            for chunk in np.unique(chunks).tolist():
                a, b = np.searchsorted(chunks, (chunk, chunk + 1)).tolist()
                self.waiting[chunk % _LISTS].appendList(self._pieces(us[a:b], severity[a:b]))
                self.handle.registerTimer(int(us[a]) // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        chunk = (expiredTimerInfo.getExpiryTimeInMs() - 1) // self.chunk_ms
        end = (chunk + 1) * self.chunk_ms
        until = min(timerValues.getCurrentWatermarkInMs(), end)
        *before, done = self.run.get() if self.run.exists() else (None, None, False, None)
        if done is not None and done >= until:
            return  # an earlier timer of the chunk saw to it
        times, levels = [], []
        waiting = self.waiting[chunk % _LISTS]
        for some_times, some_levels in waiting.get():
            times += some_times
            levels += some_levels
        us, severity = np.asarray(times, "int64"), np.asarray(levels, float)
        order = np.lexsort((severity, us))
        us, severity = us[order], severity[order]
        first = 0 if done is None else np.searchsorted(us, 1000 * done)
        due, rest = np.searchsorted(us, (1000 * until, 1000 * end)).tolist()
        hits, run_start, last, fired = advance_run(us[first:due], severity[first:due], *self.rule, *before)
        if due < rest:
            self.handle.registerTimer(int(us[due]) // 1000 + 1)
        elif rest < len(us):
            waiting.put(self._pieces(us[rest:], severity[rest:]))
        elif len(us):
            waiting.clear()
        if run_start is not None or due < rest:
            self.run.update((run_start, last, fired, until))
        elif self.run.exists():
            self.run.clear()
        if len(hits):
            yield pd.DataFrame(
                {
                    "asset": key[0],
                    "run_start": pd.to_datetime(hits["run_start"], unit="us").to_numpy(),
                    "timestamp": pd.to_datetime(hits["us"], unit="us").to_numpy(),
                    "severity": hits["severity"].to_numpy(),
                }
            )

    def close(self) -> None:
        pass


def sustained_alerts_stream(
    stream: DataFrame,
    threshold: float = 0.1,
    period: str | int = "10min",
    max_gap: str | int | None = None,
    delay: str = TOLERANCE,
    bucket: str | int = "10s",
) -> DataFrame:
    """One alert per run that stays at or above the threshold for ``period``.

    Events wait until the watermark passes them, so they are judged in time order. A batch writes a
    row for each ``bucket`` of time of its own events and no others. The session keeps the state of
    streams started from now on in RocksDB, which this needs.
    """
    width = timing.duration(bucket)
    if width < 1000 or width % 1000:
        raise ValueError("a bucket is a whole number of milliseconds")
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    gap = None if max_gap is None else timing.duration(max_gap)
    # Null severities break a run, as they do in the batch form.
    events = with_tolerance(stream, delay).select(
        "asset",
        "timestamp",
        F.unix_micros("timestamp").alias("us"),
        F.coalesce("severity", F.lit(float("-inf"))).alias("severity"),
    )
    wait = f"SELECT unix_micros(timestamp_seconds(0) + CAST('{delay}' AS INTERVAL))"
    chunk = width * max(1, -(-2 * stream.sparkSession.sql(wait).first()[0] // (_LISTS * width)))
    rule = SustainedRuns(threshold, timing.duration(period), gap, width // 1000, chunk // 1000)
    runs = events.groupBy("asset").transformWithStateInPandas(rule, _OUTPUT, "append", "eventTime")
    return as_alerts(runs, SUSTAINED_RULE)
