"""Stored fit state: merged days against a fit of all readings, and what storing a day reads."""

import re
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlens.operators import fitdays, mvad
from sensorlens.session import hold
from sensorlens.sources import files

FEATURES = [(f"A_{k}", k, "A") for k in range(4)] + [(f"B_{k}", k, "B") for k in range(2)]


def made_up(offset=0.0, days=4, per_day=96, seed=1):
    """Readings of two assets: correlated, with gaps, a sensor that comes on the second day, a
    constant one, and a level far from zero that drifts from day to day."""
    draw = np.random.default_rng(seed)
    rows = []
    for step in range(days * per_day):
        at = datetime(2024, 1, 1) + timedelta(minutes=15 * step)
        common = draw.normal()
        for tag, k, asset in FEATURES:
            value = offset + 3 * (step // per_day) + common * (k + 1) + draw.normal()
            if tag == "B_1":
                value = 7.0
            if draw.random() < 0.15 or (tag == "A_3" and step < per_day):
                continue
            rows.append((at, tag, float(value)))
    return rows


@pytest.fixture
def features(spark):
    return spark.createDataFrame(FEATURES, "tag string, ordinal int, asset string")


def readings(spark, rows):
    return spark.createDataFrame(rows, "timestamp timestamp, tag string, value double")


def frames_of(spark, rows, features):
    return hold(mvad.asset_frames(readings(spark, rows), features, "15min"), "frames")


@pytest.mark.parametrize("offset", [0.0, 1e9])
def test_merged_days_are_the_moments_of_all(spark, folder, features, offset):
    rows = made_up(offset)
    frames = frames_of(spark, rows, features)
    for day in (1, 2, 3, 4):
        mine = frames.filter(F.to_date("timestamp") == F.lit(date(2024, 1, day)))
        fitdays.store_days(hold(mine, "day"), features, folder)
    merged = hold(fitdays.merged_pairs(spark.read.schema(fitdays.PAIRS).parquet(f"{folder}/pairs")), "merged")
    got = {(r.asset, r.tag): r for r in fitdays.merged_moments(merged).collect()}
    series = {}
    for at, tag, value in rows:
        series.setdefault(tag, {})[at] = value
    for tag, k, asset in FEATURES:
        values = np.array(list(series[tag].values()))
        row = got[asset, tag]
        assert row.bins == len(values)
        assert row.mean == pytest.approx(values.mean(), rel=1e-14, abs=1e-12)
        assert row.sd == pytest.approx((values - offset).std(ddof=1), rel=1e-6)
    links = {(r.tag, r.tag1): r.correlation for r in fitdays.merged_correlations(merged).collect()}
    assert len(links) == 10 + 3
    for (a, b), value in links.items():
        x, y = ({t: v - offset for t, v in series[s].items()} for s in (a, b))
        mx, my = np.mean(list(x.values())), np.mean(list(y.values()))
        size = np.sqrt(sum((v - mx) ** 2 for v in x.values()) * sum((v - my) ** 2 for v in y.values()))
        both = sum((x[t] - mx) * (y[t] - my) for t in x.keys() & y.keys())
        want = 1.0 if a == b else both / size if size > 1e-6 else 0.0
        assert value == pytest.approx(want, abs=1e-6)


def test_one_run_fits_as_from_scratch(spark, folder, features):
    frames = frames_of(spark, made_up(), features)
    fitdays.store_days(frames, features, folder)
    got = {r.asset: r for r in fitdays.fit_stored(spark, features, folder).collect()}
    want = {r.asset: r for r in mvad.mvad_fit(frames, features, "2024-02-01").collect()}
    assert set(got) == set(want) == {"A", "B"}
    for asset, row in want.items():
        mine = got[asset]
        assert (mine.tags, mine.train_bins, mine.sliding_window) == (row.tags, row.train_bins, 280)
        for name in ("means", "sds", "correlation"):
            assert mine[name] == pytest.approx(row[name], abs=1e-9)
        assert np.ravel(mine.precision) == pytest.approx(np.ravel(row.precision), abs=1e-6)
        assert row.threshold * 0.999 <= mine.threshold <= row.threshold * fitdays.BUCKET_FACTOR**2
    vecs = mvad.vectors(frames, fitdays.fit_stored(spark, features, folder))
    assert mvad.mvad_score(vecs, fitdays.fit_stored(spark, features, folder)).count() == frames.count()


def test_storing_a_day_again_changes_nothing(spark, folder, features):
    frames = frames_of(spark, made_up(), features)
    first = hold(frames.filter("timestamp < '2024-01-04'"), "part")
    last = hold(frames.filter("timestamp >= '2024-01-04'"), "part")
    for part in (first, last):
        fitdays.store_days(part, features, folder, "diagonal")
    once = sorted(map(str, fitdays.fit_stored(spark, features, folder, mode="diagonal").collect()))
    fitdays.store_days(last, features, folder, "diagonal")
    fitdays.store_days(last.limit(0), features, folder, "diagonal")
    assert sorted(map(str, fitdays.fit_stored(spark, features, folder, mode="diagonal").collect())) == once
    before = fitdays.fit_stored(spark, features, folder, "2024-01-02", mode="diagonal").filter("asset = 'A'").first()
    assert before.train_bins <= 96 and before.means[3] is None  # its fourth sensor came later


def test_a_new_day_reads_that_day_only(spark, folder, features, monkeypatch):
    files.append_telemetry(readings(spark, made_up()), f"{folder}/telemetry", 2)
    opened = []
    real = fitdays.asset_frames

    def watched(telemetry, *rest):
        opened.append(telemetry._jdf.queryExecution().executedPlan().toString())
        return real(telemetry, *rest)

    monkeypatch.setattr(fitdays, "asset_frames", watched)
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        opened.clear()
        fitdays.store_range(spark, f"{folder}/telemetry", features, f"{folder}/days", day, day, "15min")
        assert len(opened) == 1
        folders = re.search(r"PartitionFilters: \[(.*?)\], Push", opened[0]).group(1)
        assert re.search(rf"date#\d+ >= {day}", folders) and re.search(rf"date#\d+ <= {day}", folders)
    stored = spark.read.parquet(f"{folder}/days/scores")
    assert {str(r.day) for r in stored.select("day").distinct().collect()} == {"2024-01-01", "2024-01-02", "2024-01-03"}
