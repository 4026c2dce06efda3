"""Approximate nearest neighbours with randomly rotated one-bit codes and error bounds.

Each vector is taken relative to the nearest of some centres, normalised, padded, rotated at
random and reduced to signs. From the packed signs and a few scalars of a code the inner product
with a rotated query is estimated, with a bound on its error. The best by estimate are measured on original vectors,
and with them every candidate whose distance may, by its bound, be as small.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlens.llm.workers import Shared, hold

# Vectors that centres are fitted on, the number of centres, and bits of a code per dimension.
SAMPLE = 8192
CENTRES = 64
BITS_PER_DIMENSION = 4
# Standard deviations of the estimate that the bounds allow for.
BOUND = 3.0
# Codes and queries that meet in one step.
CODES = 8192
QUERIES = 256
QUERIES_AT_ONCE = 32

_BLOCK = pa.schema(
    [("block", pa.int64()), ("ids", pa.binary()), ("code", pa.binary()), ("scalars", pa.binary()),
     ("centre", pa.binary()), ("vectors", pa.binary())]
)
_FOUND = pa.schema([("query_id", pa.int64()), ("rep", pa.int64()), ("distance", pa.float64())])
# Distances that differ by less may be equal: numpy adds in another order than the score does.
_ROUNDING = 1e-9


@dataclass
class Rotation:
    """The random rotation, the centres, and the centres rotated."""

    matrix: np.ndarray
    centres: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, centres: int, bits: int, seed: int = 5) -> Rotation:
        draw = np.random.default_rng(seed)
        matrix = np.linalg.qr(draw.normal(size=(bits, bits)))[0][: sample.shape[1]]
        means = sample[draw.permutation(len(sample))[: min(centres, len(sample))]].astype(np.float64)
        for _ in range(10):
            near = nearest_centre(sample, means)
            totals = np.zeros_like(means)
            np.add.at(totals, near, sample)
            sizes = np.bincount(near, minlength=len(means))[:, None]
            means = np.where(sizes > 0, totals / np.maximum(sizes, 1), means)
        return cls(matrix, means)

    @property
    def bits(self) -> int:
        return self.matrix.shape[1]

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Packed signs; per vector its distance to its centre, the inner product of code and
        vector, and that of code and rotated centre; and the centre."""
        near = nearest_centre(vectors, self.centres)
        rest = vectors - self.centres[near]
        norm = np.linalg.norm(rest, axis=1)
        rotated = rest @ self.matrix
        signs = rotated >= 0
        code = np.where(signs, 1.0, -1.0) / np.sqrt(self.bits)
        along = np.divide((code * rotated).sum(axis=1), norm, out=np.ones(len(norm)), where=norm > 0)
        shift = (code * (self.centres @ self.matrix)[near]).sum(axis=1)
        return np.packbits(signs, axis=1), np.column_stack((norm, along, shift)), near

    def estimate(self, queries: np.ndarray, code: np.ndarray, scalars: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of queries (rows) to codes (columns), and how far off they may be."""
        norm, along, shift = scalars.T
        signs = np.unpackbits(code, axis=1, count=self.bits).astype(np.float32) * 2 - 1
        inner = (queries @ self.matrix).astype(np.float32) @ signs.T / np.sqrt(self.bits)
        away = np.linalg.norm(queries[:, None, :] - self.centres[None], axis=2)[:, near]
        inner = (inner - shift) / along  # the inner product of query and unit vector, both from the centre
        slack = BOUND * np.sqrt(np.maximum(0.0, 1 - along**2) / along**2 / (self.bits - 1)) * away
        squares = norm**2 + away**2
        return squares - 2 * norm * inner, 2 * norm * slack + 1e-5 * squares


def nearest_centre(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin(np.square(centres).sum(axis=1) - 2 * vectors @ centres.T, axis=1)


def usable(embeddings: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``vec_id`` and ``vector`` (doubles) of the rows that take part."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    table = embeddings.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    return table.filter(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def search(embeddings: DataFrame, is_query: Column, k: int = 10, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """The ``k`` nearest rows to each query, other than itself, by Euclidean distance.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``, the distance in double
    precision on original vectors; ties go to the smaller ``vec_id``. Vectors that are null, zero,
    empty, or hold null or non-finite components take no part, nor do rows without a ``vec_id``
    or whose dimension differs from most rows' (the vectors compared must agree in it). Equal
    vectors are one candidate with its ``k + 1`` smallest ids, as no others can be among the
    nearest. ``is_query`` is a condition on ``vec_id``. An empty table gives no rows.
    """
    spark = embeddings.sparkSession
    rows_ = usable(embeddings, vector, key)
    size = rows_.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows_ = rows_.filter(F.size("vector") == size.n)
    by_vector = Window.partitionBy("vector").orderBy("vec_id")
    few = rows_.dropDuplicates(["vec_id", "vector"]).withColumn("turn", F.row_number().over(by_vector))
    few = few.filter(F.col("turn") <= k + 1).groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
    distinct = hold(few.select(F.col("members")[0].alias("rep"), "members", "vector"), "vectors")

    sample = distinct.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("vector").collect()
    rotation = Rotation.fit(np.array([row.vector for row in sample]), CENTRES, BITS_PER_DIMENSION * size.n)
    shared = Shared(spark, rotation)  # CENTRES and the rotation: fixed by the dimension

    def encode(table: pa.Table) -> pa.Table:
        vectors = _matrix(table.column("vector").combine_chunks())
        code, scalars, near = shared.value.encode(vectors)
        ids = table.column("rep").to_numpy()
        cells = [ids.astype("<i8"), code, scalars.astype("<f8"), near.astype("<i4"), vectors.astype("<f8")]
        return pa.table(
            [table.column("block").slice(0, 1), *(pa.array([cell.tobytes()], pa.binary()) for cell in cells)],
            schema=_BLOCK,
        )

    n = distinct.count()
    blocks = max(1, -(-n // CODES))
    codes = distinct.select(F.pmod(F.xxhash64("rep"), F.lit(blocks)).alias("block"), "rep", "vector")
    shape = "block long, ids binary, code binary, scalars binary, centre binary, vectors binary"
    codes = hold(codes.groupBy("block").applyInArrow(encode, shape), "codes")

    # Queries and codes meet block by block: each pair of blocks is one group.
    queries = hold(rows_.filter(is_query).dropDuplicates(["vec_id"]).select(F.col("vec_id").alias("query_id"), "vector"), "queries")
    parts = max(1, -(-queries.count() // QUERIES))
    dealt = queries.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)))

    def pack(table: pa.Table) -> pa.Table:
        vectors = _matrix(table.column("vector").combine_chunks())
        return pa.table(
            {"part": table.column("part").slice(0, 1),
             "query_ids": pa.array([table.column("query_id").to_numpy().astype("<i8").tobytes()], pa.binary()),
             "vectors": pa.array([vectors.astype("<f8").tobytes()], pa.binary())}
        )

    asked = dealt.groupBy("part").applyInArrow(pack, "part long, query_ids binary, vectors binary")
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))
    codes = codes.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<long>")))

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        return _nearest(left, right, shared.value, k)

    pairs = asked.groupBy("block", "part").cogroup(codes.groupBy("block", "part"))
    found = pairs.applyInArrow(nearest, "query_id long, rep long, distance double")
    # One more than k, as one may be the query itself.
    by_distance = Window.partitionBy("query_id").orderBy("distance")
    every = by_distance.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = found.withColumn("limit", F.nth_value("distance", k + 1).over(every))
    found = found.filter(f"limit is null or distance <= limit * (1 + {_ROUNDING})").select("query_id", "rep")
    found = found.join(distinct, "rep").join(queries.withColumnRenamed("vector", "asked"), "query_id")
    square = F.expr("aggregate(zip_with(asked, vector, (a, b) -> (a - b) * (a - b)), 0d, (s, x) -> s + x)")
    scored = found.select("query_id", F.sqrt(square).alias("score"), F.explode("members").alias("vec_id"))
    by_score = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = scored.filter("vec_id != query_id").withColumn("rank", F.row_number().over(by_score))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _nearest(asked: pa.Table, codes: pa.Table, rotation: Rotation, k: int) -> pa.Table:
    """The ``k + 1`` nearest codes of a block to each query of a block, and any as near as the last."""
    if not asked.num_rows or not codes.num_rows:
        return _FOUND.empty_table()
    width = len(rotation.matrix)
    query_ids = np.frombuffer(asked.column("query_ids")[0].as_py(), "<i8")
    queries = np.frombuffer(asked.column("vectors")[0].as_py(), "<f8").reshape(-1, width)
    ids = np.frombuffer(codes.column("ids")[0].as_py(), "<i8")
    code = np.frombuffer(codes.column("code")[0].as_py(), np.uint8).reshape(len(ids), -1)
    scalars = np.frombuffer(codes.column("scalars")[0].as_py(), "<f8").reshape(len(ids), -1)
    near = np.frombuffer(codes.column("centre")[0].as_py(), "<i4")
    vectors = np.frombuffer(codes.column("vectors")[0].as_py(), "<f8").reshape(-1, width)
    k, parts = min(k, len(ids) - 1), []
    for at in range(0, len(query_ids), QUERIES_AT_ONCE):
        middle, slack = rotation.estimate(queries[at : at + QUERIES_AT_ONCE], code, scalars, near)
        best = np.argpartition(middle, k, axis=1)[:, : k + 1]
        for q in range(len(middle)):
            query = queries[at + q]
            limit = np.square(vectors[best[q]] - query).sum(axis=1).max() * (1 + _ROUNDING)
            maybe = np.flatnonzero(middle[q] - slack[q] <= limit)
            exact = np.square(vectors[maybe] - query).sum(axis=1)
            keep = exact <= np.partition(exact, k)[k] * (1 + _ROUNDING) if len(exact) > k else exact >= 0
            n = int(keep.sum())
            parts.append((np.full(n, query_ids[at + q]), ids[maybe[keep]], np.sqrt(exact[keep])))
    return pa.table([pa.array(np.concatenate(column)) for column in zip(*parts)], schema=_FOUND)
