"""Streams over hand-written files, several micro-batches each."""

import json
import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sensorlens.operators import alerts
from sensorlens.operators.reshape import expand_metrics
from sensorlens.sources import streams
from sensorlens.streaming import ingest
from sensorlens.streaming.alerts import sustained_alerts_stream


def write(folder, number, events):
    """One file with one envelope per (asset, time, severity); later numbers are newer files."""
    os.makedirs(f"{folder}/in", exist_ok=True)
    path = f"{folder}/in/{number:03}.json"
    with open(path, "w") as out:
        for e in events:
            if isinstance(e, str):
                out.write(e + "\n")
                continue
            asset, at, severity = e
            row = {"is_anomaly": 1, "asset": asset, "timestamp": f"2024-01-01T{at}", "score": 1.0, "severity": severity}
            out.write(json.dumps({"anomalies": [row]}) + "\n")
    os.utime(path, (time.time() - 1000 + number, time.time() - 1000 + number))


CLOSING = '{"anomalies":[{"is_anomaly":1,"asset":"ZZZ","timestamp":"2100-01-01T00:00:00","score":0.0,"severity":0.0}]}'


def source(spark, folder, max_files=1):
    return ingest.anomaly_rows(streams.read_anomaly_stream(spark, f"{folder}/in", max_files))


def drain(spark, stream, folder):
    streams.write_stream(stream, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def minutes(*pairs, asset="A"):
    return [(asset, f"00:{m:02}:00", s) for m, s in pairs]


def test_run_over_two_files_fires_once(spark, folder):
    write(folder, 1, minutes(*[(m, 0.2) for m in range(6)]))
    write(folder, 2, minutes(*[(m, 0.2) for m in range(6, 15)]))
    write(folder, 3, [CLOSING])
    out = drain(spark, sustained_alerts_stream(source(spark, folder)), folder)
    assert [(r.asset, r.timestamp) for r in out.collect()] == [("A", datetime(2024, 1, 1, 0, 10))]


def test_break_one_minute_out_of_order_restarts_the_run(spark, folder):
    write(folder, 1, minutes(*[(m, 0.2) for m in range(9) if m != 7]))
    write(folder, 2, minutes((9, 0.2), (7, 0.01), (10, 0.2)))
    write(folder, 3, minutes(*[(m, 0.2) for m in range(11, 20)]) + minutes(*[(m, 0.9) for m in range(20)], asset="B"))
    write(folder, 4, [CLOSING])
    out = drain(spark, sustained_alerts_stream(source(spark, folder)), folder)
    got = sorted((r.asset, r.timestamp.minute) for r in out.collect())
    assert ("A", 18) in got and ("A", 10) not in got


def test_far_too_late_rows_are_dropped(spark, folder):
    write(folder, 1, minutes((30, 0.2)))
    write(folder, 2, minutes((31, 0.2)))
    write(folder, 3, minutes((1, 0.01), *[(m, 0.2) for m in range(32, 45)]))
    write(folder, 4, [CLOSING])
    out = drain(spark, sustained_alerts_stream(source(spark, folder)), folder)
    assert [r.timestamp.minute for r in out.collect()] == [40]


@pytest.mark.parametrize("max_files", [1, 2, 10])
def test_stream_equals_batch_however_files_are_cut(spark, folder, max_files):
    import numpy as np

    rng = np.random.default_rng(11)
    at = np.cumsum(rng.integers(5, 120, 200))
    rows = [
        ("AB"[int(rng.integers(2))], time.strftime("%H:%M:%S", time.gmtime(int(t))), float(rng.choice([0.05, 0.3, 0.3, 0.3, 0.5, 0.9, 0.4])))
        for t in at
    ]
    for i in range(5):
        write(folder, i, rows[i * 40 : (i + 1) * 40])
    write(folder, 9, [CLOSING])
    out = drain(spark, sustained_alerts_stream(source(spark, folder, max_files)), folder)
    batch = ingest.anomaly_rows(spark.read.schema(streams.schemas.ANOMALY_ENVELOPE).json(f"{folder}/in"))
    want = alerts.sustained_alerts(batch.filter("asset <> 'ZZZ'"))
    key = lambda df: sorted((r.asset, r.timestamp, r.severity) for r in df.collect())
    assert key(out) == key(want) != []


def test_broken_envelopes_do_not_stop_the_stream(spark, folder):
    write(folder, 1, ['{"anomalies":[]}', '{"x":1}', "not json",
                      '{"anomalies":[{"is_anomaly":1,"asset":"A","timestamp":"soon","severity":0.9}]}'])
    write(folder, 2, minutes((1, 0.5), (1, 0.5)))
    good, bad = ingest.split_bad_times(source(spark, folder))
    out = drain(spark, alerts.dedup_anomalies(ingest.with_tolerance(good)), folder)
    assert [(r.asset, r.severity) for r in out.collect()] == [("A", 0.5)]
    streams.write_stream(bad, f"{folder}/bad", f"{folder}/bad-checkpoint").awaitTermination()
    assert spark.read.parquet(f"{folder}/bad").count() == 1


def test_restart_continues_from_the_checkpoint(spark, folder):
    write(folder, 1, minutes(*[(m, 0.2) for m in range(6)]))
    drain(spark, sustained_alerts_stream(source(spark, folder)), folder)
    write(folder, 2, minutes(*[(m, 0.2) for m in range(6, 15)]))
    write(folder, 3, [CLOSING])
    out = drain(spark, sustained_alerts_stream(source(spark, folder)), folder)
    assert [r.timestamp.minute for r in out.collect()] == [10]


def test_a_batch_writes_the_state_of_its_own_events(spark, folder):
    """However many events wait, a batch of two writes two buckets."""
    write(folder, 1, [("A", f"{h:02}:{m:02}:{s:02}", 0.2) for h in range(2) for m in range(60) for s in (0, 15, 30, 45)])
    write(folder, 2, [("A", "02:00:00", 0.2), ("A", "00:30:05", 0.01)])
    write(folder, 3, [("B", "02:00:20", 0.2)])
    stream = sustained_alerts_stream(source(spark, folder), delay="5 hours")
    run = streams.write_stream(stream, f"{folder}/out", f"{folder}/checkpoint")
    run.awaitTermination()
    states = [p["stateOperators"][0] for p in run.recentProgress if p["numInputRows"] > 0]
    updated = [state["numRowsUpdated"] for state in states]
    assert len(updated) == 3 and updated[0] >= 480 and max(updated[1:]) <= 12
    # The rest is done after a restart, when time has passed.
    write(folder, 4, [CLOSING])
    out = drain(spark, sustained_alerts_stream(source(spark, folder), delay="5 hours"), folder)
    assert [(r.asset, r.timestamp.strftime("%H:%M:%S")) for r in out.orderBy("timestamp").collect()] == [
        ("A", "00:10:00"), ("A", "00:40:15"),
    ]


def test_fan_out_repeats_nothing(spark, folder):
    write(folder, 1, minutes((1, 0.5), (2, 0.1)))
    write(folder, 2, minutes((3, 0.3)))
    for _ in range(2):
        streams.fan_out(
            source(spark, folder), f"{folder}/raw", f"{folder}/checkpoint", alerts.threshold_alerts, f"{folder}/alerts"
        ).awaitTermination()
    assert spark.read.parquet(f"{folder}/raw").count() == 3
    assert spark.read.parquet(f"{folder}/alerts").count() == 2


def test_live_trend_equals_batch_bins(spark, folder):
    os.makedirs(f"{folder}/in")
    for n in range(3):
        with open(f"{folder}/in/{n}.json", "w") as out:
            for s in range(0, 60, 4):
                metric = {"name": "t", "timestamp": f"2024-01-01T00:0{n}:{s:02}", "dataType": "Double", "value": float(s)}
                out.write(json.dumps({"metrics": [metric]}) + "\n")
        os.utime(f"{folder}/in/{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    stream = expand_metrics(streams.read_telemetry_stream(spark, f"{folder}/in", 1))
    rows = drain(spark, ingest.live_trend(stream), folder).orderBy("timestamp").collect()
    # The newest event is 00:02:56, so windows that end by 00:00:56 are closed.
    assert [r.timestamp.second for r in rows] == [0, 10, 20, 30, 40]
    assert rows[0].value == pytest.approx((0 + 4 + 8) / 3)


@pytest.mark.parametrize("step", ["10s", "15min", "7days"])
def test_windows_agree_with_bins(spark, step):
    from sensorlens.functions import timing

    width = f"{timing.duration(step)} microseconds"
    df = spark.sql("select explode(sequence(timestamp'2023-12-25 00:00:07', timestamp'2024-01-20 00:00:00', interval 7 hours)) t")
    window = F.window("t", width, width, timing.window_offset(step)).start
    assert df.filter(window != timing.time_bin(F.col("t"), step)).count() == 0


def test_ingest_keeps_readings_with_a_bad_time_apart(spark, folder):
    from sensorlens.sources import files

    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/1.json", "w") as out:
        for at in ("2024-01-01T00:00:05", "yesterday"):
            out.write(json.dumps({"metrics": [{"name": "t", "timestamp": at, "dataType": "Double", "value": 1.5}]}) + "\n")
    stream = streams.read_telemetry_stream(spark, f"{folder}/in")
    ingest.telemetry_ingest(stream, f"{folder}/t", f"{folder}/c").awaitTermination()
    assert spark.read.parquet(f"{folder}/t").count() == 2
    good = files.read_telemetry(spark, f"{folder}/t", "2023-01-01").collect()
    assert [(r.timestamp, r.tag, r.value) for r in good] == [(datetime(2024, 1, 1, 0, 0, 5), "t", 1.5)]
