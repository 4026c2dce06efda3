"""Chunked helpers against plain single-window and brute-force versions."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from sensorlens.operators import alerts, ordering, reshape
from sensorlens.streaming.alerts import advance_run

SEV = "asset string, timestamp timestamp, severity double"
START = datetime(2024, 1, 1)


def brute_runs(events, threshold=0.1, period=600, max_gap=None):
    """``events`` are (second, severity) in any order; gives (run start, fired at)."""
    out, start, last, fired = [], None, None, False
    for at, severity in sorted(events, key=lambda e: (e[0], -1 if e[1] is None else e[1])):
        good = severity is not None and severity >= threshold
        if max_gap is not None and last is not None and at - last > max_gap:
            start, fired = None, False
        last = at
        if not good:
            start, fired = None, False
            continue
        if start is None:
            start = at
        if not fired and at - start >= period:
            out.append((start, at))
            fired = True
    return out


def seconds(moment):
    return int((moment - START).total_seconds())


@pytest.mark.parametrize("max_gap", [None, 240])
@pytest.mark.parametrize("seed", range(3))
def test_runs_across_chunks(frame, seed, max_gap):
    rng = np.random.default_rng(seed)
    events = {}
    for asset, low in (("hot", 0.05), ("cold", 0.3), ("never", 1.0), ("always", 0.0)):
        at = np.cumsum(rng.integers(1, 300, 300))
        events[asset] = [
            (int(t), None if rng.random() < 0.01 * (low > 0) else (0.0 if rng.random() < low else 0.4))
            for t in at
        ]
    rows = [(a, str(START + timedelta(seconds=t)), s) for a, es in events.items() for t, s in es]
    gap = None if max_gap is None else f"{max_gap}s"
    out = ordering.sustained_runs(frame(SEV, rows), max_gap=gap, chunk="1hour").collect()
    got = sorted((r.asset, seconds(r.run_start), seconds(r.timestamp)) for r in out)
    want = sorted((a, s, t) for a, es in events.items() for s, t in brute_runs(es, max_gap=max_gap))
    assert got == want and want


def test_run_broken_at_minute_nine_and_ties(frame):
    rows = [("a", f"2024-01-01 00:{m:02}:00", 0.2) for m in range(9)]
    rows += [("a", "2024-01-01 00:09:00", 0.05)]
    rows += [("a", f"2024-01-01 00:{m:02}:00", 0.1) for m in range(10, 21)]
    rows += [("a", "2024-01-01 00:15:00", 0.3)]
    out = alerts.sustained_alerts(frame(SEV, rows)).collect()
    assert [(r.timestamp, r.severity) for r in out] == [(datetime(2024, 1, 1, 0, 20), 0.1)]
    assert out[0].headline == alerts.HEADLINE


@settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(
    st.lists(st.tuples(st.integers(0, 4000), st.sampled_from([0.0, 0.09, 0.1, 0.5])), max_size=60),
    st.lists(st.integers(0, 4000), max_size=4),
    st.sampled_from([None, 200, 700]),
)
def test_stream_rule_in_any_batching_equals_brute_force(events, cuts, max_gap):
    events = sorted(events)
    cuts = [-1, *sorted(cuts), 10_000]
    state = (None, None, False)
    got = []
    for low, high in zip(cuts, cuts[1:]):
        part = [e for e in events if low < e[0] <= high]
        us = np.array([e[0] for e in part], dtype="int64")
        severity = np.array([e[1] for e in part], dtype=float)
        hits, *state = advance_run(us, severity, 0.1, 600, max_gap, *state)
        got += [(int(s), int(t)) for s, t in zip(hits["run_start"], hits["us"])]
    assert got == brute_runs(events, max_gap=max_gap)


def test_index_equals_plain_row_number(frame):
    rng = np.random.default_rng(4)
    rows = [("hot" if rng.random() < 0.7 else f"k{rng.integers(5)}",
             str(START + timedelta(seconds=int(rng.integers(0, 200_000)))), float(i)) for i in range(800)]
    df = frame("asset string, timestamp timestamp, severity double", rows)
    plain = Window.partitionBy("asset").orderBy("timestamp", "severity")
    want = df.withColumn("idx", F.row_number().over(plain) - 1)
    got = ordering.ordered_index(df, "asset", ["timestamp", "severity"], chunk="1hour")
    key = lambda d: sorted((r.asset, r.severity, r.idx) for r in d.collect())
    assert key(got) == key(want)


def test_densified_pieces_are_short_and_keep_the_points(frame):
    rows = [("r", 0, 0.0, 0.0), ("r", 1, 0.0, 0.001), ("r", 2, 0.0003, 0.001), ("s", 0, 5.0, 5.0)]
    points = frame("route_id string, idx bigint, lat double, lon double", rows)
    out = sorted(tuple(r) for r in reshape.densify_path(points).collect())
    r = [(lat, lon) for key, _, _, lat, lon in out if key == "r"]
    steps = [np.hypot(b[0] - a[0], b[1] - a[1]) for a, b in zip(r, r[1:])]
    assert max(steps) <= 0.0002 + 1e-12
    assert len(r) == 5 + 2 + 1 and (0.0, 0.001) in r and r[-1] == (0.0003, 0.001)
    assert [o for o in out if o[0] == "s"] == [("s", 0, 0, 5.0, 5.0)]


def test_dedup_keeps_one_row(frame):
    rows = [("a", "2024-01-01 00:00:00", 0.1), ("a", "2024-01-01 00:00:00", 0.3), ("b", "2024-01-01 00:00:00", 0.2)]
    got = alerts.dedup_anomalies(frame(SEV, rows))
    assert sorted((r.asset, r.severity) for r in got.collect()) == [("a", 0.3), ("b", 0.2)]
