from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlens.functions import timing
from sensorlens.functions.aggregates import agg_by_name
from sensorlens.operators import ranges, series

TEL = "timestamp timestamp, tag string, value double"


def values(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# -- labels, bins, ranges -----------------------------------------------------------------------


@pytest.mark.parametrize("label", [*timing.BIN_LADDER, *[p for p in timing.PERIODS if p != "*custom*"]])
def test_labels_parse_alike(spark, label):
    column = spark.range(1).select(timing.duration_us(F.lit(label)).alias("us")).first().us
    assert column == timing.duration(label) > 0


def test_label_forms(spark):
    assert timing.duration("a - 6hour") == 6 * timing.HOUR
    assert timing.duration("l -2days") == 2 * timing.DAY
    assert timing.duration("10s") == 10 * timing.SECOND
    assert timing.duration("auto") == 0
    with pytest.raises(ValueError):
        timing.duration("6 moons")
    row = spark.range(1).select(
        timing.duration_us(F.lit("a - 6hour")).alias("a"),
        timing.duration_us(F.lit("6 moons")).alias("b"),
        timing.duration_us(F.lit("Auto")).alias("c"),
    ).first()
    assert (row.a, row.b, row.c) == (6 * timing.HOUR, None, 0)


def test_seven_day_bins_start_on_monday_across_years(spark):
    row = spark.sql("select timestamp'2024-01-03 10:00:00' a, timestamp'1969-12-31 23:59:59' b")
    a, b = row.select(timing.time_bin(F.col("a"), "7days"), timing.time_bin(F.col("b"), "7days")).first()
    assert (a, b) == (datetime(2024, 1, 1), datetime(1969, 12, 29))


@pytest.mark.parametrize("max_bins", timing.MAX_BINS_OPTIONS)
@pytest.mark.parametrize("label", ["Auto", "10sec", "1hour"])
def test_steps_respect_the_limit(max_bins, label):
    for hours in (1, 24, 24 * 30):
        step = timing.choose_step(hours * timing.HOUR, label, max_bins)
        assert step >= timing.duration(label)
        assert -(-hours * timing.HOUR // step) <= max_bins


def test_step_larger_than_range_and_fallback():
    assert timing.choose_step(timing.HOUR, "1day") == timing.DAY
    assert timing.choose_step(10_000 * timing.DAY, "Auto", 100) == 7 * timing.DAY


def test_reversed_range_is_refused(frame):
    df = frame(TEL, [("2024-01-01 00:00:00", "a", 1.0)])
    with pytest.raises(ValueError):
        ranges.in_range(df, "2024-02-01", "2024-01-01")
    with pytest.raises(ValueError):
        ranges.last_period(df, "*custom*")
    with pytest.raises(ValueError):
        agg_by_name("median", F.col("value"))


def test_periods_resolve(frame):
    df = frame(TEL, [("2024-01-01 00:00:00", "a", 1.0), ("2024-01-05 06:00:00", "b", 1.0)])
    assert ranges.resolve_period("2days", df=df) == (datetime(2024, 1, 3, 6), datetime(2024, 1, 5, 6))
    assert ranges.resolve_period("6hours", anchor="2024-01-01") == (datetime(2023, 12, 31, 18), datetime(2024, 1, 1))
    assert ranges.resolve_period("*custom*", "2024-01-01", "2024-01-02") == (datetime(2024, 1, 1), datetime(2024, 1, 2))
    for bad in ({}, {"df": df.filter("tag = 'none'")}):
        with pytest.raises(ValueError):
            ranges.resolve_period("1day", **bad)
    with pytest.raises(ValueError):
        ranges.resolve_period("*custom*", "2024-01-02", "2024-01-01")
    assert ranges.effective_bin("2024-01-01", "2024-01-31") == "1hour"
    assert ranges.effective_bin("2024-01-01", "2024-01-02", "1sec", 100) == "15min"


def test_last_period_per_key(frame):
    df = frame(TEL, [("2024-01-01 00:00:00", "a", 1.0), ("2024-01-02 00:00:00", "a", 2.0), ("2023-01-01 00:00:00", "b", 3.0)])
    got = ranges.last_period(df, "1hour", by="tag").collect()
    assert sorted((r.tag, r.value) for r in got) == [("a", 2.0), ("b", 3.0)]
    assert [r.value for r in ranges.last_period(df, "1day").orderBy("value").collect()] == [1.0, 2.0]


def test_range_ends_are_inclusive(frame):
    df = frame(TEL, [(f"2024-01-01 0{h}:00:00", "a", 1.0) for h in range(4)])
    assert ranges.in_range(df, "2024-01-01 01:00:00", "2024-01-01 02:00:00").count() == 2


# -- grids and filling --------------------------------------------------------------------------


def test_empty_input_gives_an_empty_series(frame):
    df = frame(TEL, [("2024-01-01 00:00:00", "a", 1.0)]).filter("tag = 'none'")
    for empty in series.EMPTY_BINS:
        assert series.make_series(df, "avg", "1hour", empty=empty).count() == 0
    assert series.series_stats(df).count() == 0


def test_open_grid_and_defaults(frame):
    df = frame(
        TEL,
        [("2024-01-01 00:10:00", "a", 2.0), ("2024-01-01 00:50:00", "a", 4.0),
         ("2024-01-01 03:00:00", "a", 9.0), ("2024-01-01 05:30:00", "b", 1.0)],
    )
    got = values(series.make_series(df, "avg", "1hour").select("tag", "idx", "value"), "tag", "idx")
    assert got == [("a", 0, 3.0), ("a", 1, None), ("a", 2, None), ("a", 3, 9.0), ("b", 0, 1.0)]
    zero = series.make_series(df, "avg", "1hour", empty="zero").filter("tag='a'")
    assert [r.value for r in zero.orderBy("idx").collect()] == [3.0, 0.0, 0.0, 9.0]
    line = series.make_series(df, "avg", "1hour", empty="linear").filter("tag='a'")
    assert [r.value for r in line.orderBy("idx").collect()] == [3.0, 5.0, 7.0, 9.0]


def test_long_gap_is_generated_in_pieces(frame):
    df = frame(TEL, [("2024-01-01 00:00:00", "a", 0.0), ("2024-01-02 00:00:00", "a", 86400.0)])
    out = series.make_series(df, "avg", "1sec", empty="linear")
    row = out.agg(F.count("*"), F.count_distinct("idx"), F.max(F.abs(F.col("value") - F.col("idx")))).first()
    assert row[0] == row[1] == 86401
    assert row[2] < 1e-6


def test_closed_grid_edges_are_flat_and_end_is_exclusive(frame):
    df = frame(TEL, [("2024-01-01 01:30:00", "a", 1.0), ("2024-01-01 03:30:00", "a", 3.0),
                     ("2024-01-01 05:30:00", "a", 99.0)])
    out = series.make_series(df, "avg", "1hour", empty="linear",
                             start="2024-01-01 00:30:00", end="2024-01-01 05:30:00")
    got = values(out.select("timestamp", "value"), "timestamp")
    assert [v for _, v in got] == [1.0, 1.0, 2.0, 3.0, 3.0]
    assert got[0][0] == datetime(2024, 1, 1, 0, 30)


def test_all_null_series_stays_null_and_constant_is_unflagged(frame):
    rows = [(f"2024-01-01 0{h}:00:00", "null", None) for h in (0, 2)]
    rows += [(f"2024-01-01 0{h}:00:00", "flat", 5.0) for h in (0, 3)]
    filled = series.make_series(frame(TEL, rows), "avg", "1hour", empty="linear")
    flags = series.decompose_anomalies(filled, seasonality="none")
    got = {(r.tag, r.idx): (r.value, r.flag) for r in flags.collect()}
    assert got == {
        ("null", 0): (None, 0), ("null", 1): (None, 0), ("null", 2): (None, 0),
        ("flat", 0): (5.0, 0), ("flat", 1): (5.0, 0), ("flat", 2): (5.0, 0), ("flat", 3): (5.0, 0),
    }


def test_null_cells_inside_a_series_are_interpolated(frame):
    rows = [("2024-01-01 00:00:00", "a", 1.0), ("2024-01-01 01:00:00", "a", None),
            ("2024-01-01 02:00:00", "a", 3.0)]
    out = series.make_series(frame(TEL, rows), "avg", "1hour", empty="linear")
    assert [r.value for r in out.orderBy("idx").collect()] == [1.0, 2.0, 3.0]


def test_one_bin_series(frame):
    df = frame(TEL, [("2024-01-01 00:00:00", "a", 5.0)])
    flags = series.decompose_anomalies(series.make_series(df, empty="linear"), seasonality="none")
    assert [(r.value, r.baseline, r.flag) for r in flags.collect()] == [(5.0, 5.0, 0)]
    stats = series.series_stats(df).first()
    assert stats.series_stats_value_variance is None and stats.series_stats_value_max_idx == 0


def test_stats_take_the_first_position(frame):
    rows = [(f"2024-01-01 0{h}:00:00", "a", v) for h, v in enumerate([2.0, 7.0, 1.0, 7.0, 1.0])]
    got = series.series_stats(frame(TEL, rows)).first()
    assert (got.series_stats_value_min_idx, got.series_stats_value_max_idx) == (2, 1)


# -- flags --------------------------------------------------------------------------------------


def brute_flags(v, threshold=1.5, period=0):
    v = np.asarray(v, dtype=float)
    x = np.arange(len(v))
    slope, intercept = np.polyfit(x, v, 1)
    line = slope * x + intercept
    base = line.copy()
    if period:
        for phase in range(period):
            base[phase::period] += (v - line)[phase::period].mean()
    r = v - base
    low, high = np.quantile(r, [0.1, 0.9])
    score = np.where(r > high, (r - high) / (high - low), np.where(r < low, (r - low) / (high - low), 0))
    return np.where(np.abs(score) > threshold, np.sign(score), 0).astype(int).tolist()


def test_spikes_are_flagged_on_both_sides(frame):
    rng = np.random.default_rng(1)
    v = (0.05 * np.arange(120) + rng.normal(0, 1, 120)).round(3)
    v[40], v[90] = v[40] + 30, v[90] - 30
    start = datetime(2024, 1, 1)
    rows = [(str(start + timedelta(hours=i)), "a", float(x)) for i, x in enumerate(v)]
    filled = series.make_series(frame(TEL, rows), empty="linear")
    got = [r.flag for r in series.decompose_anomalies(filled, seasonality="none").orderBy("idx").collect()]
    assert got == brute_flags(v)
    assert got[40] == 1 and got[90] == -1


def test_auto_season_finds_the_period(frame):
    n, period = 480, 24
    rng = np.random.default_rng(2)
    wave = 10 * np.sin(2 * np.pi * np.arange(n) / period) + rng.normal(0, 0.5, n)
    wave[100] += 8.0
    noise = rng.normal(0, 1, n)
    start = datetime(2024, 1, 1)
    rows = [(str(start + timedelta(hours=i)), tag, float(x))
            for tag, xs in (("wave", wave), ("noise", noise)) for i, x in enumerate(xs)]
    filled = series.make_series(frame(TEL, rows), empty="linear")
    auto = series.decompose_anomalies(filled).orderBy("tag", "idx").collect()
    assert [r.flag for r in auto if r.tag == "wave"] == brute_flags(wave, period=period)
    assert [r.flag for r in auto if r.tag == "noise"] == brute_flags(noise)
    assert [r for r in auto if r.tag == "wave"][100].flag == 1


def by_lags(x, lags):
    """Autocorrelation lag by lag."""
    out = np.zeros(lags + 1)
    for k in range(lags + 1):
        a, b = x[: len(x) - k], x[k:]
        scale = np.sqrt(np.dot(a, a) * np.dot(b, b))
        out[k] = np.dot(a, b) / scale if scale > 0 else 0.0
    return out


def test_autocorrelation_of_all_lags_matches_products():
    rng = np.random.default_rng(5)
    spike = np.zeros(300)
    spike[295], spike[:100] = 1e9, rng.normal(size=100)
    for x in (rng.normal(size=1000), rng.normal(size=9), np.zeros(30), spike, 1e200 * rng.normal(size=50)):
        last = len(x) // 3
        if np.abs(x).max() > 1e100:
            assert series.autocorrelation(x, last) == pytest.approx(by_lags(x / 1e200, last), abs=1e-9)
        else:
            assert series.autocorrelation(x, last) == pytest.approx(by_lags(x, last), abs=1e-9)


@pytest.mark.parametrize("period", [3, 7, 24, 450, 499])
def test_seasons_up_to_a_third_of_the_series(period):
    rng = np.random.default_rng(6)
    at = np.arange(1500)
    assert series.season_of(10 * np.sin(2 * np.pi * at / period) + rng.normal(0, 0.05, 1500)) in (period - 1, period, period + 1)
    assert series.season_of(rng.normal(size=1500)) == 0
    assert series.season_of(at[:8] % 3.0) == 0


# -- correlation and the flagship ---------------------------------------------------------------


def test_blocks_stay_small_however_many_tags():
    assert [series.block_count(n, 720) for n in (0, 1, 256, 257, 10_000)] == [1, 1, 1, 2, 40]
    assert series.block_count(100, 1_000_000) == 25  # long series share a block with fewer
    assert series.block_count(3, 1 << 30) == 3


@pytest.mark.parametrize("blocks", [None, 1, 2, 7])
def test_blocks_hold_every_pair_once(spark, monkeypatch, blocks):
    monkeypatch.setattr(series, "_BLOCK_TAGS", 5)
    rng = np.random.default_rng(4)
    rows = [(f"t{k:02}", rng.normal(size=12).tolist()) for k in range(23)]
    vectors = spark.createDataFrame(rows, "tag string, _z array<double>")
    got = series.tag_pairs(vectors, blocks or series.block_count(23, 12)).collect()
    assert len(got) == 23 * 24 // 2 and all(r.tag <= r.tag1 for r in got)
    known = dict(rows)
    for r in got:
        assert r["product"] == pytest.approx(np.dot(known[r.tag], known[r.tag1]) / 12)
    assert series.tag_pairs(vectors.limit(0), 3).count() == 0


def test_correlation_against_numpy(frame):
    rng = np.random.default_rng(3)
    start = datetime(2024, 1, 1)
    data = {f"t{i:02}": rng.normal(size=30) for i in range(11)}
    data["flat"] = np.ones(30)
    rows = [(str(start + timedelta(hours=h)), tag, float(x)) for tag, xs in data.items() for h, x in enumerate(xs)]
    out = series.correlation_matrix(frame(TEL, rows), start, start + timedelta(hours=30), "1hour", blocks=3)
    got = {(r.tag, r.tag1): r.correlation_coefficient for r in out.collect()}
    assert len(got) == 12 * 13 // 2
    for (a, b), r in got.items():
        if "flat" in (a, b):
            assert r is None
        else:
            assert r == pytest.approx(np.corrcoef(data[a], data[b])[0, 1], abs=1e-12)


def test_flagship_on_negative_readings_and_unknown_tags(frame):
    start = datetime(2024, 1, 1)
    v = [-1.0, -1.1, -0.9, -1.05, -0.95] * 12
    v[30] = -40.0
    rows = [(str(start + timedelta(hours=i)), "x", x) for i, x in enumerate(v)]
    tags = frame("tag string, metric string, component string, asset string", [("y", "m", "c", "A")])
    expl = frame(
        "asset string, timestamp timestamp, tag string, severity double, is_anomaly boolean, contribution_score double",
        [("A", "2024-01-01 05:20:00", "x", 0.5, True, 0.3), ("A", "2024-01-01 06:20:00", "x", 0.5, True, 0.01),
         ("A", "2024-01-01 07:20:00", "x", 0.5, False, 0.3)],
    )

    def run(strict):
        out = series.series_with_anomalies(
            frame(TEL, rows), tags, expl, start, start + timedelta(hours=60),
            bin_label="1hour", seasonality="none", strict_reference=strict,
        )
        return {r.timestamp.hour + 24 * (r.timestamp.day - 1): r for r in out.collect()}

    got = run(False)
    assert len(got) == 60
    assert got[30].individual_anomaly == -40.0 and got[30].marker_color == "FireBrick"
    assert got[30].anomaly_indicator == " ● Individual" and got[30].metric is None
    assert got[5].mvad_anomaly == 0.5 and got[5].marker_color == "Orange"
    assert got[5].anomaly == got[5].value and got[5].anomaly_indicator == " ● Multivariate"
    assert got[6].anomaly is None and got[7].marker_color == ""
    assert run(True)[30].marker_color == ""
