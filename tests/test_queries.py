"""Every registered query against its SQL on the small tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from check import table

QUERIES = contract.queries()
SQLS = contract.oracle_sql()


@pytest.fixture(scope="module")
def db(small):
    import glob
    import os

    base = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        view = os.path.basename(path).removesuffix(".parquet")
        base.execute(f"CREATE VIEW {view} AS SELECT * FROM '{path}'")
    return base


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, small, db):
    df = QUERIES[name](spark, small)
    rows = df.collect()
    if name not in SQLS:
        assert rows
        return
    result = db.execute(SQLS[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert table(df.columns, rows) == table(columns, result.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "tag", "timestamp", "value", "anomaly", "individual_anomaly", "mvad_anomaly",
        "anomaly_indicator", "metric", "component", "marker_color",
    ]
    assert df.count() > 0
