"""The stateful rule's calls to its state, and its answers, on a state held in memory."""

from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest

from sensorlens.streaming.alerts import SustainedRuns, advance_run

MINUTE = 60_000_000
RULE = (0.1, 10 * MINUTE, None)


class Held:
    """A value, list or map state that counts its calls."""

    def __init__(self, calls, default):
        self.calls, self.value, self.default = calls, default, default

    def __getattr__(self, name):
        def call(*given):
            self.calls.append(name)
            if name == "appendList":
                self.value = [*self.value, *given[0]]
            elif name in ("update", "put"):
                self.value = given[0]
            elif name == "clear":
                self.value = self.default
            elif name == "exists":
                return self.value != self.default
            elif name == "get":
                return iter(self.value) if self.default == [] else self.value
            else:
                raise AttributeError(name)

        return call


class Handle:
    def __init__(self):
        self.calls, self.timers, self.lists = [], set(), []

    def getValueState(self, name, schema):
        return Held(self.calls, None)

    def getListState(self, name, schema):
        self.lists.append(Held(self.calls, []))
        return self.lists[-1]

    def registerTimer(self, at):
        self.calls.append("registerTimer")
        self.timers.add(at)


def run(batches, chunk_ms, delay_us, max_gap=None):
    """Alerts of batches of (us, severity), then of the end of time; the calls, and what is left."""
    rule, handle, alerts, kept = SustainedRuns(*RULE[:2], max_gap, 10_000, chunk_ms), Handle(), [], []
    rule.init(handle)
    late = mark = -1
    for us, severity in [*batches, (np.empty(0, "int64"), np.empty(0))]:
        fresh = us > 1000 * late
        if fresh.any():
            kept.append((us[fresh], severity[fresh]))
            halves = np.array_split(np.flatnonzero(fresh), 2)
            frames = [pd.DataFrame({"us": us[h], "severity": severity[h]}) for h in halves if len(h)]
            list(rule.handleInputRows(("A",), iter(frames), None))
        clock = SimpleNamespace(getCurrentWatermarkInMs=lambda: mark)
        for at in sorted(t for t in handle.timers if t <= mark):
            found = rule.handleExpiredTimer(("A",), clock, SimpleNamespace(getExpiryTimeInMs=lambda at=at: at))
            for frame in found:
                alerts += [(t.value // 1000, s) for t, s in zip(frame["timestamp"], frame["severity"])]
            handle.timers.discard(at)
        late = mark
        mark = max(mark, int(us.max() - delay_us) // 1000) if len(us) else 10**10
        if not len(us):
            for at in sorted(handle.timers):
                found = rule.handleExpiredTimer(("A",), SimpleNamespace(getCurrentWatermarkInMs=lambda: 10**10), SimpleNamespace(getExpiryTimeInMs=lambda at=at: at))
                for frame in found:
                    alerts += [(t.value // 1000, s) for t, s in zip(frame["timestamp"], frame["severity"])]
    return alerts, kept, handle


@pytest.mark.parametrize("seed", range(12))
def test_alerts_equal_the_rule_over_all_events(seed):
    rng = np.random.default_rng(seed)
    delay = int(rng.integers(1, 90)) * MINUTE
    chunk_ms = int(rng.choice([10_000, 60_000, 600_000, delay // 8000 // 10_000 * 10_000 + 10_000]))
    at = np.cumsum(rng.integers(1, 40, 1500)) * 1_000_000
    severity = rng.choice([0.05, 0.3, 0.5], 1500, p=[0.01, 0.49, 0.5])
    order = np.argsort(at + rng.integers(0, 2 * delay, 1500), kind="stable")  # some are too late
    cuts = np.sort(rng.integers(0, 1500, 20))
    batches = [(at[o], severity[o]) for o in np.split(order, cuts) if len(o)]
    max_gap = None if seed % 2 else 240_000_000
    got, kept, handle = run(batches, chunk_ms, delay, max_gap)
    us, level = np.concatenate([k[0] for k in kept]), np.concatenate([k[1] for k in kept])
    o = np.lexsort((level, us))
    want = advance_run(us[o], level[o], *RULE[:2], max_gap, None, None, False)[0]
    assert got == list(zip(want["us"].tolist(), want["severity"].tolist())) != []
    assert all(held.value == [] for held in handle.lists)


def test_calls_follow_chunks_and_not_events():
    """5,000 buckets in one batch, with a delay of a day."""
    us = np.arange(5000, dtype="int64") * 15_000_000
    got, _, handle = run([(us, np.full(5000, 0.5))], 3 * 3_600_000, 24 * 60 * MINUTE)
    assert got == [(10 * MINUTE, 0.5)]
    assert len(handle.calls) < 100
