"""Token-id files: one compressed file of wavelet matrices per shard, in ascending doc_id order."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlens.llm.tokens import texts_encoder
from sensorlens.llm.wavelet import Wavelet, build
from sensorlens.llm.workers import packed, rows

# Tokens after which a matrix is closed; it ends with a whole document.
SHARD_TOKENS = 1 << 20
# Characters of texts that are encoded together; a longer text is encoded alone.
CHARS_AT_ONCE = 1 << 20

SHARD = (
    "part int, seq int, first long, n long, doc_ids array<long>, counts array<long>, "
    "planes binary, ranks binary, zeros array<int>"
)
_SHARD = pa.schema(
    [("part", pa.int32()), ("seq", pa.int32()), ("first", pa.int64()), ("n", pa.int64()),
     ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("planes", pa.binary()),
     ("ranks", pa.binary()), ("zeros", pa.list_(pa.int32()))]
)


def bits_of(tokenizer: str, end_id: int) -> int:
    """Bits that the ids of a tokenizer and ``end_id`` need."""
    from tokenizers import Tokenizer

    return max(end_id, *Tokenizer.from_file(tokenizer).get_vocab().values()).bit_length()


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, width: int | None = None) -> None:
    """Writes the ids of all documents, ``end_id`` behind each, in ascending ``doc_id`` order.

    Documents are dealt by ranges of ``doc_id`` before they are encoded; each task writes one
    Parquet file (Zstandard), whose rows hold a wavelet matrix of ``width`` bit planes (as many as
    the tokenizer's largest id or ``end_id`` needs, if not given; an id that needs more fails) over some
    ``SHARD_TOKENS`` ids, the ids and token counts of its documents, and its place in the file.
    Null texts are empty, a null ``doc_id`` comes first, rows of one ``doc_id`` follow by text.
    """
    if width is None:
        width = bits_of(tokenizer, end_id)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = texts_encoder(tokenizer), TaskContext.get().partitionId()
        end = end_id.to_bytes(4, "little")

        def shards():
            seq = first = n = 0
            doc_ids, counts, pieces = [], [], []

            def shard():
                planes, ranks, zeros = build(np.frombuffer(b"".join(pieces), "<u4"), width)
                return part, seq, first, n, doc_ids, counts, planes, ranks, zeros

            for doc_id, ids in encoded(batches, encode):
                ids += end
                doc_ids.append(doc_id)
                counts.append(len(ids) // 4)
                pieces.append(ids)
                n += counts[-1]
                if n >= SHARD_TOKENS:
                    yield shard()
                    seq, first, n = seq + 1, first + n, 0
                    doc_ids, counts, pieces = [], [], []
            if pieces:
                yield shard()

        yield from packed(shards(), _SHARD, most=1)

    def encoded(batches, encode) -> Iterator[tuple[int, bytes]]:
        held, chars = [], 0
        for doc_id, text in rows(batches):
            if held and chars + len(text or "") > CHARS_AT_ONCE:
                yield from zip((d for d, _ in held), encode([t for _, t in held]))
                held, chars = [], 0
            held.append((doc_id, text))
            chars += len(text or "")
        if held:
            yield from zip((d for d, _ in held), encode([t for _, t in held]))

    table = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    table = table.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    table.mapInArrow(run, SHARD).write.option("compression", "zstd").parquet(path)


def shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``base``, the ids of all shards before them.

    Tokens per file are added up in the driver (one row per file: as many as the shuffle that
    wrote them had partitions); shards know their place in their file.
    """
    stored = spark.read.schema(SHARD).parquet(path)
    totals = stored.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    before = [0, *accumulate(row.n for row in totals)]
    bases = spark.createDataFrame(
        [(row.part, base) for row, base in zip(totals, before)], "part int, file_base long"
    )
    return stored.join(F.broadcast(bases), "part").withColumn("base", F.expr("file_base + first"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the files: ``doc_id``, ``start``, ``n_tokens``, ``ids`` (little-endian, 32 bits)."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def documents():
            for base, n, doc_ids, counts, planes, ranks, zeros in _each(batches):
                tokens, at = Wavelet(n, planes, ranks, zeros).tokens().astype("<u4"), 0
                for doc_id, count in zip(doc_ids, counts):
                    yield doc_id, base + at, count, tokens[at : at + count].tobytes()
                    at += count

        yield from packed(documents(), schema)

    table = shards(spark, path).select("base", "n", "doc_ids", "counts", "planes", "ranks", "zeros")
    return table.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Every place of a token: ``doc_id``, ``place`` (among all ids) and ``in_doc``, found with
    rank and select in the compressed planes."""
    schema = pa.schema([("doc_id", pa.int64()), ("place", pa.int64()), ("in_doc", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def places():
            for base, n, doc_ids, counts, planes, ranks, zeros in _each(batches):
                ends = np.cumsum(counts)
                for at in Wavelet(n, planes, ranks, zeros).occurrences(token):
                    k = int(np.searchsorted(ends, at, side="right"))
                    yield doc_ids[k], base + at, at - int(ends[k] - counts[k])

        yield from packed(places(), schema)

    table = shards(spark, path).select("base", "n", "doc_ids", "counts", "planes", "ranks", "zeros")
    return table.mapInArrow(run, "doc_id long, place long, in_doc long")


def count(spark: SparkSession, path: str, token: int) -> int:
    """How often a token occurs, from ranks alone."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(
            Wavelet(n, planes, ranks, zeros).count(token)
            for n, planes, ranks, zeros in _each(batches)
        )
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64())], ["total"])

    table = spark.read.schema(SHARD).parquet(path).select("n", "planes", "ranks", "zeros")
    return table.mapInArrow(run, "total long").agg(F.sum("total")).first()[0] or 0


def _each(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Shards one by one; each is a few megabytes."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield from rows([batch.slice(k, 1)])
