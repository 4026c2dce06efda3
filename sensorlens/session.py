"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Settings the plans rely on. Broadcast joins are left to Catalyst and AQE, which check the
# size of the side first; hot join keys are split by the AQE skew rule.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the cluster's shared checkpoint folder.

    The folder is the one named by ``spark.checkpoint.dir``. Only a session without that
    setting (a local test session) gets a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="sensorlens-")
    return f"{root.rstrip('/')}/sensorlens/{purpose}-{uuid.uuid4().hex}"


def hold(df: DataFrame, purpose: str) -> DataFrame:
    """Writes a result that several later steps read, and reads it back.

    The table lies in the shared folder, so it outlives lost executors, the steps behind it are
    not computed again, and Catalyst knows its size when it picks a join.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_once: dict[tuple[str, str], tuple[str, StructType]] = {}


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def hold_once(spark: SparkSession, key: str, build: Callable[[], DataFrame]) -> DataFrame:
    """:func:`hold`, but one table per application and key, as long as it is still there."""
    known = (spark.sparkContext.applicationId, key)
    if known not in _once or not exists(spark, _once[known][0]):
        df = build()
        path = scratch_dir(spark, "once")
        df.write.parquet(path)
        _once[known] = (path, df.schema)
    path, schema = _once[known]
    return spark.read.schema(schema).parquet(path)
