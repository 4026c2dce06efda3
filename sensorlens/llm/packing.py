"""Concatenate and cut: global token offsets by two passes of prefix sums, then fixed windows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.llm.tokens import text_encoder
from sensorlens.llm.workers import hold, packed, rows

WINDOW = 1024
ID_BYTES = 4
# Tasks of the first pass at most; bounds the table of partition totals.
MOST_PARTS = 65_536

ENCODED = "part int, at long, doc_id long, doc_tokens long, ids binary"
_ENCODED = pa.schema(
    [("part", pa.int32()), ("at", pa.int64()), ("doc_id", pa.int64()), ("doc_tokens", pa.int64()),
     ("ids", pa.binary())]
)


def encode(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """First pass: each document's ids (little-endian, 32 bits) with ``end_id`` behind them, its
    task and the ids before it in that task. The table is written once, so later passes see the
    same tasks whichever executors are lost."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part = text_encoder(tokenizer, keeps_space=True), TaskContext.get().partitionId()
        end = end_id.to_bytes(ID_BYTES, "little")

        def records():
            at = 0
            for doc_id, text in rows(batches):
                ids = ids_of(text) + end
                count = len(ids) // ID_BYTES
                yield part, at, doc_id, count, ids
                at += count

        yield from packed(records(), _ENCODED)

    table = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return hold(table.coalesce(MOST_PARTS).mapInArrow(run, ENCODED), "packing")


def offsets(encoded: DataFrame) -> DataFrame:
    """Second prefix sum: the ids before each task. One row per task of the first pass, of which
    there are at most ``MOST_PARTS``, so the driver may add them up."""
    totals = encoded.groupBy("part").agg(F.sum("doc_tokens").alias("n")).orderBy("part").collect()
    before = [0, *accumulate(row.n for row in totals)]
    table = [(row.part, base) for row, base in zip(totals, before)]
    return encoded.sparkSession.createDataFrame(table, "part int, base long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, window: int = WINDOW) -> DataFrame:
    """Cuts the concatenation of all documents' ids into sequences of ``window`` tokens.

    Returns one row per piece, its boundary record: ``doc_id``, ``start`` (ids of its document
    before it), ``length``, ``ids`` (little-endian, 32 bits), ``doc_tokens``, ``sequence_id`` and
    ``offset`` (place in the sequence). Every sequence is full but the last one, so at most
    ``window - 1`` tokens of the whole result are padding.

    Documents follow each other in reading order. A null or empty text is its end id alone; a
    null ``doc_id`` is kept as it is; repeated rows are documents of their own; a text longer than
    a window has several pieces; an empty table gives no rows.
    """
    encoded = encode(docs, tokenizer, end_id)
    first = F.col("base") + F.col("at")
    placed = encoded.join(F.broadcast(offsets(encoded)), "part").select(
        "doc_id", "doc_tokens", "ids", first.alias("first"),
        F.explode(
            F.sequence(
                F.floor(first / window), F.floor((first + F.col("doc_tokens") - 1) / window)
            )
        ).alias("sequence_id"),
    )
    begin = F.greatest(F.col("first"), F.col("sequence_id") * window)
    end = F.least(F.col("first") + F.col("doc_tokens"), (F.col("sequence_id") + 1) * window)
    pieces = placed.withColumn("start", begin - F.col("first")).withColumn("length", end - begin)
    return pieces.select(
        "doc_id", "start", "length",
        F.expr(f"substring(ids, int(start * {ID_BYTES} + 1), int(length * {ID_BYTES}))").alias("ids"),
        "doc_tokens", "sequence_id",
        (F.col("first") + F.col("start") - F.col("sequence_id") * window).alias("offset"),
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """Pieces put together: ``sequence_id``, ``ids``, and ``bounds``, the (offset, doc_id, start)
    of each piece, for attention masks. A sequence holds at most a window of tokens."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "ids")))
    return pieces.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.expr("aggregate(parts, X'', (ids, p) -> ids || p.ids)").alias("ids"),
        F.expr("transform(parts, p -> struct(p.offset, p.doc_id, p.start))").alias("bounds"),
    )
