"""Streams that meet a dimension which changes while they run.

The dimension is a folder of versions: each holds the rows that changed (``AssetID``, ``valid_from``
and attributes), so publishing costs what changed. A micro-batch takes the newest version that is
complete when it first runs and notes its number, so a batch that runs again after a failure sees the
same dimension and gives the same rows, whatever was published in between.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sensorlens.operators.assets import attributes_asof


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str, key: str) -> list[int]:
    """Numbers of the folders ``key=number`` below a path."""
    store, place = _folder(spark, path)
    if not store.exists(place):
        return []
    names = (status.getPath().getName() for status in store.listStatus(place))
    return [int(name.removeprefix(f"{key}=")) for name in names if name.startswith(f"{key}=")]


def _complete(spark: SparkSession, path: str, version: int) -> bool:
    store, place = _folder(spark, f"{path}/version={version}/_SUCCESS")
    return store.exists(place)


def publish_dimension(changes: DataFrame, path: str, version: int) -> None:
    """Adds a version of changed rows: ``AssetID``, ``valid_from`` and attributes.

    A version that is complete is never touched again, so a job that publishes may be run again; what
    a failed try left is overwritten. Versions count up; completeness is told by Spark's success mark.
    """
    if not _complete(changes.sparkSession, path, version):
        changes.write.mode("overwrite").parquet(f"{path}/version={version}")


def newest_version(spark: SparkSession, path: str) -> int | None:
    """The largest version that is complete; null if there is none yet."""
    known = sorted(_names(spark, path, "version"), reverse=True)
    return next((v for v in known if _complete(spark, path, v)), None)


def read_dimension(spark: SparkSession, path: str, schema: str, version: int | None) -> DataFrame:
    """All changes up to a version (none: no rows), with a column ``version``; attributes that a version
    lacks are null. Later versions' folders are pruned."""
    known = StructType.fromDDL(f"{schema}, version bigint")
    if version is None:
        return spark.createDataFrame([], known)
    return spark.read.schema(known).parquet(path).filter(F.col("version") <= version)


def version_of_batch(spark: SparkSession, path: str, ledger: str, batch_id: int) -> int | None:
    """The version that a batch uses: the one noted at its first try, or else the newest, which is noted.

    A batch before the first version notes none, so it may meet a version when it runs again.
    """
    noted = _names(spark, f"{ledger}/batch={batch_id}", "version")
    if noted:
        return min(noted)
    newest = newest_version(spark, path)
    if newest is not None:
        store, place = _folder(spark, f"{ledger}/batch={batch_id}/version={newest}")
        store.mkdirs(place)
    return newest


def enrich_changing(
    stream: DataFrame,
    dimension: str,
    schema: str,
    path: str,
    checkpoint: str,
    chunk: str | int = "1day",
    before: Callable[[SparkSession, int], None] | None = None,
    available_now: bool = True,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Writes the streamed rows with the attributes that their asset had at their time.

    ``dimension`` is a folder of :func:`publish_dimension`, ``schema`` its columns. A batch reads the
    changes of its own assets only, and writes ``batch=N`` below ``path``, overwriting what an earlier
    try left. A change counts for the batches that begin after it was published: rows written before
    are not written again. ``before`` is called with each batch's number first. Rows are those of
    :func:`sensorlens.operators.assets.attributes_asof`, unknown assets with nulls included.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if before:
            before(spark, batch_id)
        version = version_of_batch(spark, dimension, f"{checkpoint}/dimension", batch_id)
        history = read_dimension(spark, dimension, schema, version)
        held = batch.persist()
        try:
            out = attributes_asof(held, history, chunk)
            out.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            held.unpersist()

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
