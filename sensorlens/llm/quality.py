"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Each token has a sparse random index vector; a token's word vector adds up the index vectors of
its neighbours over all documents. A document is pooled to the mean and spread of its word
vectors, and a small numpy network with temperature-calibrated probabilities scores it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlens.llm.workers import ROWS_AT_ONCE, Shared, every_column, memo, packed, rows

# Tokens are hashed into this many word vectors of this many dimensions; an index vector has
# NONZERO entries of +1 or -1; neighbours stand at most WINDOW tokens away.
BUCKETS = 1 << 14
DIMENSIONS = 64
NONZERO = 4
WINDOW = 2
# Labelled documents that the network is fitted on; a part of them sets the temperature.
SAMPLE = 8192
CALIBRATE_EVERY = 5
HIDDEN = 32
STEPS = 600
# Rows of the table of word vectors that are added up together, and tasks whose sums meet at once.
BLOCK = 256
FAN_IN = 512
TOKENS_AT_ONCE = 1 << 16
MEMO_PIECES = 400_000

_WORD = re.compile(r"\w+")
_ROW = re.compile(r"(.)\1+")


def _index() -> tuple[np.ndarray, np.ndarray]:
    """Where each bucket's index vector has its entries, and their signs; from fixed random numbers."""
    draw = np.random.default_rng(7)
    places = np.argsort(draw.random((BUCKETS, DIMENSIONS)), axis=1)[:, :NONZERO]
    return places.astype(np.int64), draw.choice([-1.0, 1.0], (BUCKETS, NONZERO))


def _bucket(token: str) -> int:
    return crc32(token.encode("utf-8", "surrogatepass")) % BUCKETS


class Tokens(dict):
    """Buckets of a piece's word and of its form (the piece with letters and digits blanked), as
    one number: ``word * BUCKETS + form``."""

    def __missing__(self, piece: str) -> int:
        letters = piece if piece[-1].isalnum() else piece[:-1]
        if letters.isalpha() and letters.islower() and not _WORD.match(piece[len(letters) :]):
            # Most new pieces: small letters and at most one sign behind.
            word, shape = letters.lower(), ("x+" if len(letters) > 1 else "x") + piece[len(letters) :]
        else:
            word, shape = "".join(_WORD.findall(piece)).lower(), form(piece)
        buckets = _bucket(word) * BUCKETS + _bucket("shape " + shape)
        if len(self) < MEMO_PIECES and len(piece) <= 64:
            self[piece] = buckets
        return buckets


def form(piece: str) -> str:
    """A piece with letters and digits blanked, and rows of the same sign put together."""
    blank = ("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in piece)
    return _ROW.sub(r"\1+", "".join(blank))


_AGAIN = _bucket("same word again")


def buckets_of(text: str | None) -> np.ndarray:
    """The tokens of a text, in order: each word, its form, and a mark if it repeats the one before."""
    known = memo("quality tokens", Tokens)
    pieces = (text or "").split()
    if not pieces:
        return np.zeros(0, np.int64)
    words, forms = np.divmod(np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces)), BUCKETS)
    again = np.concatenate(([False], words[1:] == words[:-1]))
    table = np.column_stack((words, forms, np.where(again, _AGAIN, -1))).ravel()
    return table[table >= 0]


def context_vectors(docs: DataFrame) -> np.ndarray:
    """The sum, over all documents, of the index vectors around each bucket: a table whose size is
    fixed by ``BUCKETS`` and ``DIMENSIONS``. Tasks add up their own documents first; their sums,
    whole numbers, are added up in two levels, ``FAN_IN`` tasks at a time, so that the group of a
    block stays small with any number of tasks."""
    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("sums", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = memo("quality index", _index, alone=True)
        sums = np.zeros(BUCKETS * DIMENSIONS)

        def add(tokens: np.ndarray) -> None:
            for gap in range(1, WINDOW + 1):
                left, right = tokens[:-gap], tokens[gap:]
                keep = (left >= 0) & (right >= 0)
                left, right = left[keep], right[keep]
                for word, near in ((left, right), (right, left)):
                    cells = (word * DIMENSIONS)[:, None] + places[near]
                    sums[:] += np.bincount(cells.ravel(), signs[near].ravel(), len(sums))

        held, size, gap = [], 0, np.full(WINDOW, -1)
        for (text,) in rows(batches):
            tokens = buckets_of(text)
            held += [tokens, gap]  # documents are no neighbours of each other
            size += len(tokens)
            if size >= 8 * TOKENS_AT_ONCE:
                add(np.concatenate(held))
                held, size = [], 0
        if held:
            add(np.concatenate(held))
        table, part = sums.astype("<i8").reshape(-1, BLOCK * DIMENSIONS), TaskContext.get().partitionId()
        yield from packed(((part // FAN_IN, k, block.tobytes()) for k, block in enumerate(table) if block.any()), schema)

    def total(table: pa.Table) -> pa.Table:
        sums = np.zeros(BLOCK * DIMENSIONS, "<i8")
        for part in table.column("sums"):
            sums += np.frombuffer(part.as_buffer(), "<i8")
        return pa.table([*(table.column(name).slice(0, 1) for name in ("part", "block")), pa.array([sums.tobytes()])], schema=schema)

    shape = "part int, block int, sums binary"
    blocks = docs.select(F.col("text").cast("string")).mapInArrow(run, shape)
    blocks = blocks.groupBy("part", "block").applyInArrow(total, shape)
    blocks = blocks.groupBy("block").applyInArrow(total, shape)
    vectors = np.zeros((BUCKETS // BLOCK, BLOCK * DIMENSIONS), np.float32)
    for row in blocks.toLocalIterator():
        vectors[row.block] = np.frombuffer(row.sums, "<i8")
    return vectors.reshape(BUCKETS, DIMENSIONS)


def word_vectors(contexts: np.ndarray) -> np.ndarray:
    """Unit context vectors plus unit index vectors, so that words used alike stay apart."""
    places, signs = _index()
    own = np.zeros((BUCKETS, DIMENSIONS))
    np.put_along_axis(own, places, signs, axis=1)
    norms = np.linalg.norm(contexts, axis=1, keepdims=True)
    unit = np.divide(contexts, norms, out=np.zeros_like(contexts, dtype=np.float64), where=norms > 0)
    return (unit + own / np.sqrt(NONZERO)).astype(np.float32)


def pooled(text: str | None, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of a text's word vectors, and its length; zeros for an empty text."""
    tokens = buckets_of(text)
    different, times = np.unique(tokens, return_counts=True)
    part, times = vectors[different].astype(np.float64), times.astype(np.float64)
    total, squares = times @ part, times @ np.square(part)
    n = max(1, len(tokens))
    spread = np.sqrt(np.maximum(0.0, squares / n - np.square(total / n)))
    return np.concatenate((total / n, spread, [np.log1p(len(tokens)) / 10]))


@dataclass
class Network:
    """Input scaling, two layers, and the temperature of the last one."""

    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(0.0, ((x - self.centre) / self.scale) @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def fit(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on the logistic loss, and a temperature from every ``CALIBRATE_EVERY``-th row."""
    check = np.arange(len(y)) % CALIBRATE_EVERY == 0
    if len(set(y[~check].tolist())) < 2:
        check = np.zeros(len(y), bool)
    train, target = x[~check], y[~check]
    draw = np.random.default_rng(11)
    scale = train.std(axis=0) + 1e-3
    net = Network(
        train.mean(axis=0), scale, draw.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN), draw.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), 0.0,
    )
    z = (train - net.centre) / net.scale
    params = [net.first, net.first_bias, net.second, np.zeros(1)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, STEPS + 1):
        raw = z @ params[0] + params[1]
        hidden = np.maximum(0.0, raw)
        p = 1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3][0], -60, 60)))
        error = (p - target) / len(target)
        back = np.outer(error, params[2]) * (raw > 0)
        slopes = [z.T @ back + 1e-4 * params[0], back.sum(axis=0), hidden.T @ error + 1e-4 * params[2], np.array([error.sum()])]
        for param, slope, (m, v) in zip(params, slopes, moments):
            m += 0.1 * (slope - m)
            v += 0.001 * (np.square(slope) - v)
            param -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.first, net.first_bias, net.second, net.second_bias = *params[:3], float(params[3][0])
    if check.any():
        logits, truth = net.logits(x[check]), y[check]

        def loss(temperature: float) -> float:
            return float(np.mean(np.logaddexp(0, logits / temperature) - truth * logits / temperature))

        net.temperature = min((2.0 ** (k / 4) for k in range(-4, 17)), key=loss)
    return net


@dataclass
class Model:
    """Word vectors and network; without usable labels only the share of label 1."""

    vectors: np.ndarray
    network: Network | None
    share: float


def _features(docs: DataFrame, model: Model) -> DataFrame:
    shared = Shared(docs.sparkSession, model)
    rest = [c for c in docs.columns if c != "text"]
    kinds = dict(docs.dtypes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                x = [pooled(t, shared.value.vectors).tolist() for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.list_(pa.float64())), *part.columns[1:]], ["x", *rest]
                )

    shape = ", ".join(["x array<double>", *(f"`{c}` {kinds[c]}" for c in rest)])
    return docs.select(F.col("text").cast("string"), *rest).mapInArrow(run, shape)


def learn(docs: DataFrame, labels: DataFrame, where: Column | None = None, sample: int = SAMPLE) -> Model:
    """Word vectors from all texts of ``docs``, and a network from at most ``sample`` labelled
    documents, those with the least hash of ``doc_id``. ``labels`` has ``doc_id`` and ``quality``
    (0 or 1; other values and nulls teach nothing; of several labels the largest counts); ``where``
    limits the labels that may be learnt from. With labels of one kind only, every score is
    their share; without any it is one half."""
    usable = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
    usable = usable.filter("doc_id is not null and quality in (0, 1)")
    usable = usable if where is None else usable.filter(where)
    usable = usable.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    usable = usable.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()
    model = Model(word_vectors(context_vectors(docs)), None, 0.5)
    if not chosen:
        return model
    table = docs.sparkSession.createDataFrame(chosen, "doc_id long, quality int")  # bounded by sample
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(table), "doc_id")
    found = _features(texts.select("text", "doc_id", "quality"), model).collect()
    found.sort(key=lambda row: (crc32(str(row.doc_id).encode()), row.doc_id, row.x))
    y = np.array([row.quality for row in found], np.float64)
    model.share = float(y.mean())
    if 0 < model.share < 1:
        model.network = fit(np.array([row.x for row in found]), y)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score``, the probability (0 to 1) that a text's label is 1.

    Whole texts are scored; a null text counts as empty, and an empty one is scored like any other.
    A null ``doc_id`` stays null, repeated rows are scored each, an empty table gives no rows.
    """
    if model.network is None:
        return docs.select(F.col("doc_id").cast("long"), F.lit(model.share).alias("score"))
    shared = Shared(docs.sparkSession, model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = shared.value

        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                x = np.array([pooled(text, trained.vectors) for text in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(trained.network.probability(x))], schema=schema)

    table = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return table.mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """The rows that score at least ``least``, in all their columns. Rows that share a ``doc_id``
    stay if one of them does; rows with a null ``doc_id`` stay, as no verdict can be tied to them."""
    best = score(docs, model).filter("doc_id is not null").groupBy("doc_id")
    gone = best.agg(F.max("score").alias("best")).filter(F.col("best") < least)
    return docs.join(gone, "doc_id", "left_anti").select(*every_column(docs))
