"""Exact dedup with a split of heavy hitters.

Misra-Gries summaries of each task, added up, name the digests that may be frequent. Those are
counted exactly (their counts combine map-side) and the frequent ones' verified winners are
broadcast, so rows of a large group of copies never meet in one task. All other digests, none of
them frequent, go through an ordinary shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlens.llm.workers import every_column, hold, packed

# A digest is frequent if it stands in at least one in FREQUENT rows. With four times as many
# counters a task's summary misses at most a quarter of that share, so at most FREQUENT / 0.75
# digests pass as candidates, whatever the input.
FREQUENT = 256
COUNTERS = 4 * FREQUENT
_CHUNK = 1 << 16

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: str = "text") -> Column:
    """SHA-256 of a text after lower-casing A-Z only; null counts as empty."""
    folded = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER)
    return F.unhex(F.sha2(folded.cast("binary"), 256))


def summary(chunks: Iterable[list[bytes]], counters: int = COUNTERS) -> dict[bytes, int]:
    """Misra-Gries: counts, for ``counters`` values at most, that are too low by at most
    ``n / (counters + 1)``. It takes the values chunk by chunk, the counts of each put in first."""
    counts: Counter[bytes] = Counter()
    for chunk in chunks:
        counts.update(chunk)
        if len(counts) > counters:
            # As many rounds of "take one from each of counters + 1 values" as this chunk allows.
            spare = sorted(counts.values(), reverse=True)[counters]
            counts = Counter({value: n - spare for value, n in counts.items() if n > spare})
    return counts


def candidates(digests: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """Digests that may stand in at least one in ``frequent`` rows, and surely all that do."""
    counters = 4 * frequent
    schema = pa.schema([("digest", pa.binary()), ("n", pa.int64()), ("seen", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0

        def chunks():
            nonlocal seen
            for batch in batches:
                for start in range(0, batch.num_rows, _CHUNK):
                    part = batch.column(0).slice(start, _CHUNK).to_pylist()
                    seen += len(part)
                    yield part

        def records():
            yield from ((value, n, 0) for value, n in summary(chunks(), counters).items())
            yield None, 0, seen

        yield from packed(records(), schema)

    summaries = hold(digests.select("digest").mapInArrow(run, "digest binary, n long, seen long"), "heavy")
    rows = summaries.agg(F.sum("seen")).first()[0] or 0
    least = 0.75 * rows / frequent
    return (
        summaries.filter("digest is not null").groupBy("digest").agg(F.sum("n").alias("n"))
        .filter((F.col("n") >= least) & (F.col("n") > 1)).select("digest")
    )


def verdicts(docs: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """One row per document: ``doc_id``, ``digest``, ``keep_id``, ``group_size``, ``kept``.

    Of equal texts the row with the largest ``doc_id`` stays. Null texts equal empty ones. Rows
    with a null ``doc_id`` stay only if their text has no other ``doc_id``; rows that repeat a
    ``doc_id`` and its text have the same verdict and count each in ``group_size``.
    """
    digests = hold(docs.select(F.col("doc_id").cast("long"), digest().alias("digest")), "digests")
    # At most frequent / 0.75 digests, see above.
    heavy = F.broadcast(candidates(digests, frequent))
    winners = digests.join(heavy, "digest").groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    winners = hold(winners, "heavy")
    split = digests.join(F.broadcast(winners), "digest", "left")
    of_text = Window.partitionBy("digest")
    rest = digests.join(F.broadcast(winners), "digest", "left_anti").select(
        "doc_id", "digest", F.max("doc_id").over(of_text).alias("keep_id"),
        F.count("*").over(of_text).alias("group_size"),
    )
    every = split.filter("group_size is not null").select(rest.columns).union(rest)
    return every.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def drop_copies(docs: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """The rows that stay, in all their columns; of rows that repeat a ``doc_id`` and its text, one.

    Null and empty texts are copies of each other; a row with a null ``doc_id`` stays only if no row with
    one has its text; an empty table gives no rows.
    """
    kept = hold(verdicts(docs, frequent).filter("kept").groupBy("doc_id", "digest").count(), "kept")
    kept = kept.select(F.col("doc_id").alias("k"), F.col("digest").alias("d"), F.col("count").alias("n"))
    # The row as one struct, so that none of its columns can clash with these.
    places = docs.select(F.struct(*every_column(docs)).alias("row"), F.col("doc_id").cast("long").alias("id"), digest().alias("digest"))
    stay = places.join(kept, F.col("id").eqNullSafe(F.col("k")) & (F.col("digest") == F.col("d")))
    if kept.filter("n > 1").isEmpty():
        return stay.select("row.*")
    repeated = stay.filter("n > 1").dropDuplicates(["k", "d"])
    return stay.filter("n = 1").select("row.*").union(repeated.select("row.*"))
