import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sensorlens.functions import text
from sensorlens.operators import anomalies, assets, ranges, reshape
from sensorlens.sources import files, schemas, streams

TEL = "timestamp timestamp, tag string, value double"
TAGS = "tag string, metric string, component string, asset string"
ANOM = "asset string, timestamp timestamp, score double, severity double, is_anomaly boolean"


@pytest.fixture
def tables(frame):
    telemetry = frame(TEL, [("2024-01-01 00:05:00", "a1", 1.0), ("2024-01-01 09:00:00", "a2", 2.0),
                            ("2024-01-01 03:00:00", "b1", 3.0)])
    tags = frame(TAGS, [("a1", "m", "c", "A"), ("a2", "m", "c", "A"), ("b1", "m", "c", "B")])
    found = frame(ANOM, [("A", "2024-01-01 00:40:00", 2.0, 0.5, True), ("A", "2024-01-01 00:50:00", 3.0, 0.2, True),
                         ("A", "2024-01-01 02:00:00", 9.0, 0.01, True), ("B", "2024-01-01 02:00:00", 1.0, 0.9, True),
                         ("A", "2024-01-01 04:00:00", 1.0, 0.9, False)])
    return telemetry, tags, found


def test_binned_anomalies_count_the_bookends(tables):
    telemetry, tags, found = tables
    out = anomalies.anomalies_binned(found, telemetry, tags, ["a1", "a2"], "1hour")
    got = sorted((r.timestamp.hour, r.asset, r.score, r.severity, r.anomaly_count, r.constant) for r in out.collect())
    assert got == [(0, "A", 3.0, 0.5, 3, 0), (9, "A", None, None, 1, 0)]


def test_binned_anomalies_of_several_assets_are_empty(tables):
    telemetry, tags, found = tables
    assert anomalies.anomalies_binned(found, telemetry, tags, ["a1", "b1"], "1hour").count() == 0
    assert anomalies.anomalies_binned(found, telemetry, tags, ["none"], "1hour").count() == 0


def test_binned_by_asset_alone_equals_its_part_of_all(tables):
    telemetry, tags, found = tables
    every = anomalies.anomalies_binned_by_asset(found, telemetry, tags, "1hour")
    one = anomalies.anomalies_binned_by_asset(found, telemetry, tags, "1hour", asset="A")
    assert sorted(map(str, every.filter("asset = 'A'").collect())) == sorted(map(str, one.collect()))


def test_empty_range_gives_one_row_of_nulls(tables):
    row = anomalies.bookends(tables[0], "2030-01-01", "2030-02-01").first()
    assert tuple(row) == (None, None)


def test_bad_metric_name(tables):
    with pytest.raises(ValueError):
        anomalies.contribution_metric(tables[2], "median")


def test_labels_tolerate_missing_parts(frame):
    df = frame("AssetID string, AssetCode string, AssetType string, Manufacturer string, Model string",
               [("A", None, "Pump", "Maker", None)])
    assert df.select(text.asset_label().alias("l")).first().l == "A:  - Pump (Maker - )"


def test_model_ties_go_to_the_larger_uri(frame):
    models = frame(schemas.MODELS, [("A", "m1", 280, "2024-01-01 00:00:00"), ("A", "m2", 280, "2024-01-01 00:00:00"),
                                    ("A", "m0", 280, "2024-03-01 00:00:00")])
    assert assets.model_asof(models, "2024-02-01").first().model_uri == "m2"
    at = frame("asset string, timestamp timestamp", [("A", "2023-01-01 00:00:00"), ("A", "2024-01-01 00:00:00"),
                                                     ("A", "2024-05-01 00:00:00"), ("B", "2024-05-01 00:00:00")])
    got = [r.model_uri for r in assets.model_asof(models, at).orderBy("asset", "timestamp").collect()]
    assert got == [None, "m2", "m0", None]


def test_expand_drops_missing_and_empty_arrays_and_bad_times(spark):
    lines = [
        '{"anomalies":[{"is_anomaly":1,"asset":"A","timestamp":"2024-01-01T00:00:00","score":1.0,"severity":0.5}]}',
        '{"anomalies":[]}',
        '{"other":1}',
        '{"anomalies":[{"is_anomaly":0,"asset":"B","timestamp":"not a time","score":1.0,"severity":0.5}]}',
    ]
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    parsed = streams.parse_messages(raw, schemas.ANOMALY_ENVELOPE)
    rows = reshape.project_anomaly_fields(reshape.expand_array(parsed.select("anomalies"), "anomalies"))
    got = sorted((r.asset, r.timestamp) for r in rows.collect())
    assert got == [("A", datetime(2024, 1, 1)), ("B", None)]


def test_envelopes_hold_ten(frame):
    rows = [("A", f"2024-01-01 00:00:{i:02}", 1.0, 0.5, True) for i in range(25)]
    out = files.to_anomaly_envelopes(frame(ANOM, rows)).orderBy("message").collect()
    assert [r.rows for r in out] == [10, 10, 5]
    first = json.loads(out[0].value)["anomalies"]
    assert [a["timestamp"][17:19] for a in first] == [f"{i:02}" for i in range(10)]
    assert first[0]["is_anomaly"] == 1


def test_csv_with_byte_order_mark(spark, folder):
    with open(f"{folder}/features.csv", "wb") as out:
        out.write(b"\xef\xbb\xbf\"tag\",\"ordinal\",\"asset\"\n\"A_1\",\"1\",\"A\"\n")
    df = files.read_reference_csv(spark, f"{folder}/features.csv", schemas.FEATURES)
    assert [tuple(r) for r in df.collect()] == [("A_1", 1, "A")]


def test_routes_file(spark, folder):
    with open(f"{folder}/routes.json", "w") as out:
        json.dump([{"route_id": "75201", "centroid_coordinates": [32.0, -96.0], "points": [[1.0, 2.0], [3.0, 4.0]],
                    "total_points": 2, "current_point": 0}], out)
    routes = files.read_routes(spark, folder)
    assert files.route_point_counts(routes).first().point_count == 2
    assert [tuple(r) for r in reshape.route_points(routes).orderBy("idx").collect()] == [
        ("75201", 0, 1.0, 2.0), ("75201", 1, 3.0, 4.0)]


def test_healthy_and_unhealthy_split_all_assets(frame, tables):
    dim = frame("AssetID string, AssetType string, Manufacturer string, Model string, Latitude double, Longitude double",
                [(a, "t", "m", "x", 1.0, 2.0) for a in "ABC"])
    bad = {r.AssetID for r in assets.unhealthy_assets(tables[2], dim).collect()}
    good = {r.AssetID for r in assets.healthy_assets(tables[2], dim).collect()}
    assert (bad, good) == ({"A", "B"}, {"C"})


def test_narrow_keeps_nulls_as_rows(frame):
    df = frame("a string, b int", [("x", None)])
    assert sorted((r.Attribute, r.Value) for r in reshape.narrow(df).collect()) == [("a", "x"), ("b", None)]


def test_anomaly_flag_may_be_zero_or_one(frame):
    df = frame("asset string, is_anomaly bigint", [("a", 1), ("b", 0), ("c", None)])
    assert [r.asset for r in ranges.only_anomalies(df).collect()] == ["a"]


def test_pivot_then_unpivot(frame):
    df = frame(TEL, [("2024-01-01 00:00:00", "x", 1.0), ("2024-01-01 00:10:00", "x", 3.0), ("2024-01-01 01:00:00", "y", 5.0)])
    wide = reshape.asset_frame(df, ["y", "x"], "1hour")
    assert wide.columns == ["timestamp", "y", "x"]
    long = reshape.unpivot_frame(wide).filter(F.col("value").isNotNull())
    assert sorted((r.tag, r.value) for r in long.collect()) == [("x", 2.0), ("y", 5.0)]


@pytest.mark.parametrize("chunk", ["10min", "1day", "7days"])
def test_models_in_force_match_looking_each_up(spark, chunk):
    import random
    from datetime import datetime, timedelta

    draw = random.Random(3)
    moments = [datetime(2024, 1, 1) + timedelta(minutes=20 * draw.randrange(400)) for _ in range(60)]
    models = [(draw.choice("ABB"), f"m{k % 7}", 280 + k % 3, draw.choice(moments)) for k in range(80)]
    models += [(None, "none", 1, moments[0]), ("A", "undated", 1, None), models[0], models[1]]
    events = [(draw.choice(["A", "B", "C", None]), draw.choice([*moments, None]), k) for k in range(300)]
    events += [("A", datetime(2023, 1, 1), 300), ("A", datetime(2025, 1, 1), 301), events[5]]
    table = spark.createDataFrame(models, "asset string, model_uri string, sliding_window int, effective_date timestamp")
    at = spark.createDataFrame(events, "asset string, timestamp timestamp, _chunk int")
    found = assets.model_asof(table, at, chunk)
    assert found.columns == ["asset", "timestamp", "_chunk", "model_uri", "sliding_window", "effective_date"]
    want = []
    for asset, t, k in events:
        mine = [(d, u, w) for a, u, w, d in models if a == asset is not None and t is not None and d is not None and d <= t]
        d, u, w = max(mine, default=(None, None, None))
        want.append((asset, t, k, u, w, d))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    assert "collect" not in found._jdf.queryExecution().executedPlan().toString()
    assert assets.model_asof(table.limit(0), at, chunk).filter("model_uri is not null").isEmpty()
