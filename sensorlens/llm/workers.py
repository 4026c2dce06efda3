"""Helpers of functions that run in Python workers, on Arrow batches."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sensorlens.session import scratch_dir

# Rows turned into Python objects at once, and bytes of results sent back at once.
ROWS_AT_ONCE = 256
BYTES_AT_ONCE = 4 << 20
# Shared values that a worker keeps unpacked; a task uses one.
SHARED_KEPT = 1


def memo(key, build: Callable, alone: bool = False):
    """``build()``, once per worker process and key.

    Functions travel by value, so their module globals are new in every task; a module of this
    name in ``sys.modules`` lives as long as the process. A step that comes behind others in the
    same workers builds its first value ``alone``: what they kept is dropped before.
    """
    module = sys.modules.setdefault("sensorlens_worker_memo", types.ModuleType("memo"))
    store = module.__dict__.setdefault("kept", {})
    if key not in store:
        if alone:
            store.clear()
        store[key] = build()
    return store[key]


class Shared:
    """A value of bounded size that the driver made, broadcast once and unpacked once per worker.

    It travels with its classes, as workers need not have this package.
    """

    def __init__(self, spark: SparkSession, value):
        self.key = uuid.uuid4().hex
        self.packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        kept = memo("shared", dict)
        if self.key not in kept:
            while len(kept) >= SHARED_KEPT:
                kept.pop(next(iter(kept)))
            kept[self.key] = cloudpickle.loads(self.packed.value)
        return kept[self.key]


def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of the batches as tuples; few at a time, as a batch may hold very long texts."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(start, ROWS_AT_ONCE)
            yield from zip(*(column.to_pylist() for column in part.columns))


def packed(records: Iterable[tuple], schema: pa.Schema, most: int = 4096) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of bounded size."""
    held, weight = [], 0

    def batch():
        return pa.RecordBatch.from_arrays(
            [pa.array(column, type=field.type) for column, field in zip(zip(*held), schema)],
            schema=schema,
        )

    for record in records:
        held.append(record)
        weight += sum(len(cell) for cell in record if isinstance(cell, (bytes, str)))
        if len(held) >= most or weight >= BYTES_AT_ONCE:
            yield batch()
            held, weight = [], 0
    if held:
        yield batch()


def every_column(df: DataFrame) -> list[Column]:
    """All columns in order, whatever their names hold."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]


def hold(df: DataFrame, purpose: str, codec: str = "zstd") -> DataFrame:
    """Writes a result to the cluster's shared folder and reads it back, so that lost executors
    cost one task and not the steps behind it."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(StructType(df.schema.fields)).parquet(path)
