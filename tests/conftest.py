import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sensorlens import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    built = (
        SparkSession.builder.master("local[8]")
        .appName("sensorlens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .getOrCreate()
    )
    built.sparkContext.setLogLevel("ERROR")
    return session.prepare(built)


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def frame(spark):
    """Rows with text timestamps to a DataFrame: ``frame("a string, timestamp timestamp", rows)``."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    def build(ddl, rows):
        target = T.StructType.fromDDL(ddl)
        text = T.StructType(
            [
                T.StructField(
                    f.name, T.StringType() if f.dataType == T.TimestampType() else f.dataType
                )
                for f in target
            ]
        )
        raw = spark.createDataFrame(rows, text)
        return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target])

    return build
