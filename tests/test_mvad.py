from datetime import datetime, timedelta

import numpy as np
import pytest

from sensorlens import session
from sensorlens.operators import mvad

START = datetime(2024, 1, 1)
D, N, TRAIN = 4, 120, 90


@pytest.fixture(scope="module")
def data(spark, frame):
    rng = np.random.default_rng(7)
    out, rows, features = {}, [], []
    for asset in ("A", "B"):
        mix = rng.normal(size=(D, D))
        x = rng.normal(size=(N, D)) @ mix + 5
        x[100] += 25
        out[asset] = x
        for i in range(D):
            features.append((f"{asset}_{i}", i + 1, asset))
            rows += [(str(START + timedelta(minutes=t)), f"{asset}_{i}", float(x[t, i])) for t in range(N)]
    features.append(("B_gone", D + 1, "B"))
    return (
        out,
        frame("timestamp timestamp, tag string, value double", rows),
        spark.createDataFrame(features, "tag string, ordinal int, asset string"),
    )


def expected(x, extra):
    train = x[:TRAIN]
    z = (x - train.mean(0)) / train.std(0, ddof=1)
    z = np.hstack([z, np.zeros((len(z), extra))])
    zt = z[:TRAIN]
    s = zt.T @ zt
    scale = np.sqrt(np.outer(np.diag(s), np.diag(s)))
    r = np.divide(s, scale, out=np.eye(len(s)), where=scale > 0)
    p = np.linalg.inv(r + mvad.RIDGE * np.eye(len(r)))
    parts = z * (z @ p)
    t2 = parts.sum(1) / z.shape[1]
    q = np.sort(t2[:TRAIN])[int(np.ceil(0.99 * TRAIN)) - 1]
    return z, r, parts, t2, q


@pytest.fixture(scope="module")
def fitted(data):
    _, telemetry, features = data
    frames = session.hold(mvad.asset_frames(telemetry, features, "1min"), "frames")
    model = mvad.mvad_fit(frames, features, START + timedelta(minutes=TRAIN), window=20)
    return mvad.vectors(frames, model), model


def test_scores_against_numpy(data, fitted):
    scored = mvad.mvad_score(*fitted).orderBy("asset", "timestamp").collect()
    for asset, extra in (("A", 0), ("B", 1)):
        _, _, _, t2, q = expected(data[0][asset], extra)
        mine = [r for r in scored if r.asset == asset]
        assert np.allclose([r.score for r in mine], t2, rtol=1e-9)
        assert [r.is_anomaly for r in mine] == (t2 > q).tolist()
        assert np.allclose([r.severity for r in mine], np.where(t2 > q, 1 - q / t2, 0), rtol=1e-9)
        assert {r.missing for r in mine} == {extra}
        assert mine[100].is_anomaly


def test_explanations_against_numpy(data, fitted):
    rows = mvad.mvad_explain(*fitted, "1min", window=20).collect()
    assert {r.asset for r in rows} == {"A", "B"}
    for asset, extra in (("A", 0), ("B", 1)):
        z, r, parts, t2, q = expected(data[0][asset], extra)
        names = [f"{asset}_{i}" for i in range(D)] + ["B_gone"] * extra
        for t in np.flatnonzero(t2 > q):
            at = START + timedelta(minutes=int(t))
            mine = {x.tag: x for x in rows if x.asset == asset and x.timestamp == at}
            assert sorted(mine) == sorted(names)
            share = np.maximum(parts[t], 0)
            share = share / share.sum()
            window = z[max(0, t - 19) : t + 1]
            with np.errstate(invalid="ignore", divide="ignore"):
                moved = np.abs(np.corrcoef(window.T) - r)
            for i, name in enumerate(names):
                assert mine[name].contribution_score == pytest.approx(share[i], abs=1e-9)
                changes = mine[name].correlation_changes
                want = {n: moved[i, j] for j, n in enumerate(names) if j != i and not np.isnan(moved[i, j])}
                assert dict(zip(changes.changed_variables, changes.changed_values)) == pytest.approx(want, abs=1e-9)
                assert changes.changed_values == sorted(changes.changed_values, reverse=True)


def test_shares_sum_to_one(fitted):
    rows = mvad.mvad_contributions(*fitted).groupBy("asset", "timestamp").sum("contribution_score").collect()
    assert rows and all(abs(r[2] - 1) < 1e-9 for r in rows)


def test_constant_sensor_has_no_say(frame, spark):
    rows = [(str(START + timedelta(minutes=t)), tag, v) for t in range(10) for tag, v in (("A_0", 1.0), ("A_1", t % 3 + 0.0))]
    telemetry = frame("timestamp timestamp, tag string, value double", rows)
    features = spark.createDataFrame([("A_0", 1, "A"), ("A_1", 2, "A")], "tag string, ordinal int, asset string")
    frames = mvad.asset_frames(telemetry, features, "1min")
    model = mvad.mvad_fit(frames, features, "2024-02-01")
    assert model.first().correlation == [1.0, 0.0, 0.0, 1.0]
    vecs = mvad.vectors(frames, model)
    assert all(r.z[0] == 0.0 for r in vecs.collect())


def test_partial_products_hand_on_before_they_grow(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(mvad, "_HELD_CELLS", 4)
    z = np.arange(24.0).reshape(12, 2)
    keys = ["a", "b", "a"] * 4
    batches = [
        pa.RecordBatch.from_arrays([pa.array(keys[i : i + 4]), pa.array(z[i : i + 4].tolist())], ["asset", "z"])
        for i in (0, 4, 8)
    ]
    out = list(mvad._partial_products(iter(batches)))
    assert len(out) > 1
    for key in "ab":
        total = sum(np.array(p) for b in out for k, p in zip(*map(pa.Array.to_pylist, b.columns)) if k == key)
        mine = z[[k == key for k in keys]]
        assert np.allclose(total, (mine.T @ mine).ravel())


def test_window_matrices_across_blocks(frame, spark, monkeypatch):
    # Bins more than a block apart, with gaps: only bins inside the window count.
    rng = np.random.default_rng(5)
    minutes = sorted(rng.choice(9000, 400, replace=False).tolist())
    z = rng.normal(size=(400, 3))
    rows = [("A", str(START + timedelta(minutes=m)), v.tolist()) for m, v in zip(minutes, z)]
    vecs = frame("asset string, timestamp timestamp, z array<double>", rows)
    got = {r.timestamp: r.window_correlation for r in mvad.window_correlations(vecs, vecs, "1min", 300).collect()}
    assert len(got) == 400
    for i, m in enumerate(minutes):
        part = z[[m - 300 < k <= m for k in minutes]]
        have = np.array([np.nan if v is None else v for v in got[START + timedelta(minutes=m)]]).reshape(3, 3)
        if len(part) > 2:
            assert np.allclose(have, np.corrcoef(part.T), atol=1e-9)


def test_new_anomalies(frame):
    ddl = "asset string, timestamp timestamp, severity double"
    scored = frame(ddl, [("A", f"2024-01-01 00:0{i}:00", 0.1) for i in range(5)] + [("B", "2024-01-01 00:00:00", 0.1)])
    stored = frame(ddl, [("A", "2024-01-01 00:02:00", 0.1)])
    got = sorted((r.asset, r.timestamp.minute) for r in mvad.new_anomalies(scored, stored).collect())
    assert got == [("A", 3), ("A", 4), ("B", 0)]


def test_new_anomalies_are_the_fresh_part_of_a_full_scoring(data, fitted, frame):
    import json

    _, telemetry, features = data
    vecs, model = fitted
    stored = frame("asset string, timestamp timestamp, severity double",
                   [("A", str(START + timedelta(minutes=95)), 0.1), ("B", str(START + timedelta(minutes=98)), 0.1)])
    got = {(r.asset, r.timestamp): r for r in
           mvad.mvad_new_anomalies(telemetry, features, model, stored, "1min", window=20).collect()}
    want = {(r.asset, r.timestamp): r for r in mvad.mvad_score(vecs, model).collect()
            if r.timestamp > START + timedelta(minutes=95 if r.asset == "A" else 98)}
    told = {(r.asset, r.timestamp, r.tag): r for r in mvad.mvad_explain(vecs, model, "1min", 20).collect()}
    assert got.keys() == want.keys() and len(got) == 24 + 21
    for key, row in got.items():
        assert row.score == pytest.approx(want[key].score) and bool(row.is_anomaly) == want[key].is_anomaly
        parts = json.loads(row.interpretation) if row.interpretation else []
        assert bool(parts) == want[key].is_anomaly
        for part in parts:
            full = told[(*key, part["tag"])]
            assert part["contribution_score"] == pytest.approx(full.contribution_score)
            assert part["correlation_changes"]["changed_values"] == pytest.approx(full.correlation_changes.changed_values)


def test_wide_assets_use_several_slabs(frame, spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(str(START + timedelta(minutes=t)), f"W_{i:02}", float(v))
            for t in range(6) for i, v in enumerate(rng.normal(size=11)) if (t, i) != (2, 5)]
    rows += [(str(START), "N_00", 1.5)]
    telemetry = frame("timestamp timestamp, tag string, value double", rows)
    features = spark.createDataFrame(
        [(f"W_{i:02}", i, "W") for i in range(11)] + [("N_00", 0, "N")], "tag string, ordinal int, asset string")
    whole = sorted(map(str, mvad.asset_frames(telemetry, features, "1min").collect()))
    monkeypatch.setattr(mvad, "_SLAB", 4)
    assert sorted(map(str, mvad.asset_frames(telemetry, features, "1min").collect())) == whole
    frames = mvad.asset_frames(telemetry, features, "1min")
    model = mvad.mvad_fit(frames, features, "2024-02-01", mode="diagonal")
    got = {(r.asset, r.timestamp.minute): (len(r.z), r.missing) for r in mvad.vectors(frames, model).collect()}
    assert got == {("N", 0): (1, 0), **{("W", t): (11, int(t == 2)) for t in range(6)}}


def test_running_sums_equal_products_of_each_window():
    rng = np.random.default_rng(9)
    z = rng.normal(size=(500, 6)) + 40.0
    z[:, 1] = z[:, 0] * 2 + rng.normal(size=500) * 0.01
    z[100:260, 2] = 3.25  # constant in some windows
    z[:, 3] = -1.0
    z[300:, 4] *= 1e6  # little varies before, beside what comes
    last = np.sort(rng.choice(np.arange(1, 501), 120, replace=False))
    for window in (1, 2, 48, 280):
        first = np.maximum(last - window, 0)
        for a, b, got in zip(first, last, mvad.trailing_correlations(z, first, last)):
            part = z[a:b] - z[a:b].mean(axis=0)
            still = (z[a:b] == z[a]).all(axis=0)
            part[:, still] = 0
            size = np.sqrt((part * part).sum(axis=0))
            with np.errstate(invalid="ignore"):
                want = part.T @ part / np.outer(size, size)
            assert np.isnan(got[:, still]).all() and np.isnan(got[still]).all()
            live = ~still
            np.testing.assert_allclose(got[np.ix_(live, live)], want[np.ix_(live, live)], atol=1e-7)
    assert list(mvad.trailing_correlations(z, last[:0], last[:0])) == []


def test_new_anomalies_keep_the_sign_of_zero_shares(spark):
    """Lists are compared by their text, where -0.0 is not 0.0."""
    import glob
    import os

    import duckdb

    import __spark_entry__ as contract

    tables, name = "/root/testdata/sf0.01", "mvad_new_anomalies"
    db = duckdb.connect()
    for path in glob.glob(f"{tables}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    found = db.execute(f"SELECT asset, timestamp, contributions FROM ({contract.oracle_sql()[name]}) WHERE is_anomaly = 1")
    want = {(asset, at): repr(shares) for asset, at, shares in found.fetchall()}
    got = contract.queries()[name](spark, tables).filter("is_anomaly = 1").collect()
    assert {(r.asset, r.timestamp): repr(r.contributions) for r in got} == want
    assert any("-0.0" in shares for shares in want.values())
