"""What the plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from sensorlens.operators import series
from sensorlens.plans.fixtures import END, START, Tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_range_and_tags_reach_the_scan(spark, folder):
    rows = "select timestamp'2024-01-01' + make_interval(0,0,0,0,0,id) timestamp, 'a' tag, 1.0D value, 1 other from range(10)"
    spark.sql(rows).write.mode("overwrite").parquet(f"{folder}/t")
    df = series.telemetry_trend(spark.read.parquet(f"{folder}/t"), START, END, ["a", "b"])
    text = plan(df)
    pushed = re.search(r"PushedFilters: (.*?), ReadSchema", text).group(1)
    assert "timestamp" in pushed and "tag" in pushed
    assert "other" not in re.search(r"ReadSchema: (\S+)", text).group(1)


@pytest.mark.parametrize(
    "name",
    ["correlation_matrix", "series_with_anomalies", "sustained_runs", "anomalies_binned", "adaptive_bin",
     "densify_path", "last_period_overall", "mvad_score_diag"],
)
def test_no_cross_products_and_no_row_functions(spark, small, name):
    text = plan(contract.queries()[name](spark, small))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert word not in text


def test_series_shuffles_once_after_binning(spark, small):
    t = Tables(spark, small)
    filled = series.make_series(t.telemetry, "avg", "1hour", empty="linear")
    flags = series.decompose_anomalies(filled, seasonality=24)
    # One exchange for the partial aggregates of the bins, one to gather a series.
    assert plan(flags).count("Exchange") == 2


def test_scans_read_only_what_they_use(spark, small):
    t = Tables(spark, small)
    schema = re.search(r"ReadSchema: (\S+)", plan(t.telemetry.agg(F.sum("value")))).group(1)
    assert schema == "struct<value:double>"


def test_stored_telemetry_is_pruned_by_folder_and_row_group(spark, small, folder):
    from sensorlens.sources import files

    t = Tables(spark, small)
    files.append_telemetry(t.telemetry, f"{folder}/t")
    df = files.read_telemetry(spark, f"{folder}/t", "2024-01-03 06:00:00", "2024-01-04 18:00:00")
    text = plan(df)
    assert re.search(r"PartitionFilters: \[.*date.*2024-01-03", text)
    assert "timestamp" in re.search(r"PushedFilters: (.*?), ReadSchema", text).group(1)
    dates = {f.split("date=")[1].split("/")[0] for f in df.inputFiles()}
    assert {"2024-01-03", "2024-01-04"} <= dates
    want = t.telemetry.filter("timestamp between '2024-01-03 06:00:00' and '2024-01-04 18:00:00'")
    assert df.count() == want.count() > 0


def test_two_appends_keep_every_row(spark, frame, folder):
    from sensorlens.sources import files

    rows = [(f"2024-01-0{d} {h:02}:00:00", "hot", 1.0) for d in (1, 2) for h in range(24)]
    df = frame("timestamp timestamp, tag string, value double", rows)
    files.append_telemetry(df, f"{folder}/t")
    files.append_telemetry(df, f"{folder}/t")
    assert files.read_telemetry(spark, f"{folder}/t").count() == 2 * len(rows)
    assert files.read_telemetry(spark, f"{folder}/t", "2024-01-02").count() == 48
