"""Language ID with interpolated Kneser-Ney character models, one per language.

A word is a sequence of characters between a begin and an end mark. N-grams are counted over all
labelled texts, by words first and then by n-gram, so what is shuffled grows with the vocabulary.
A model holds, per order, the sorted 64-bit hashes of its n-grams with their interpolated log
probabilities, and the sorted hashes of its contexts with the log weight of the lower order, so it
grows with the distinct n-grams of its language. The language with the lowest
cross-entropy per symbol wins; a text whose cross-entropy is far from any of its language's own is
rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlens.llm.workers import Shared, every_column, packed, rows

ORDER = 5
# One of so many labelled documents calibrates, by its hash. The models learn from all others.
CALIBRATE_EVERY = 8
# Rank error of a language's rejection quantile: one in so many of its calibrating documents.
QUANTILE_ACCURACY = 100_000
SHARPNESSES = [2.0**k for k in range(0, 7)]
# Words that a task counts before it passes them on, and that are taken apart at once.
WORDS_HELD = 1 << 18
WORDS_AT_ONCE = 1 << 15
# A mean over n symbols may be off by some multiple of 1 / sqrt(n): short texts get that tolerance.
SHORT = 4.0
MEMO_WORDS = 300_000
TEXT_AT_ONCE = 4 << 20

WORD = re.compile(r"[^\W\d_]+")
_BEGIN, _END = 1, 2
_STEP = 0x9E3779B97F4A7C15


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    return WORD.findall(text.lower()) if text else []


def has_letter(words: Iterable[str]) -> bool:
    return any(any(map(str.isalpha, word)) for word in words)


class Symbols:
    """Words laid out as symbols, and the hash (64 bits) of the n-gram that ends at each."""

    def __init__(self, words: list[str]):
        self.lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
        text = "".join(f"\x01{word}\x02" for word in words)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        self.ends = np.cumsum(self.lengths)
        starts = self.ends - self.lengths
        self.word = np.repeat(np.arange(len(words)), self.lengths)
        # How many symbols of its word stand before a symbol.
        self.depth = np.arange(len(codes)) - np.repeat(starts, self.lengths)
        mixed = (codes + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0x94D049BB133111EB)
        whole, power = np.zeros(len(codes), np.uint64), 1
        self.hashes = {0: whole}
        for n in range(1, ORDER + 1):
            back = np.zeros(len(codes), np.uint64)
            back[n - 1 :] = mixed[: len(codes) - n + 1]
            whole = whole + back * np.uint64(power)
            self.hashes[n] = whole
            power = power * _STEP % (1 << 64)

    def grams(self, n: int) -> np.ndarray:
        """Places where an n-gram ends that predicts a symbol: whole within its word, no begin mark."""
        return np.flatnonzero((self.depth >= n - 1) & (self.depth > 0))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def gram_counts(counts: dict[str, int]) -> pa.Table:
    """The n-grams of counted words: ``n``, ``key``, the keys of the n-gram without its first
    (``suffix``) and without its last symbol (``context``), whether a symbol stands before it in
    its word (``inner``), and how often it occurs (``seen``). Of n-grams that share a key, counts are
    added up and the least keys of their parts stand."""
    words = sorted(counts)
    symbols = Symbols(words)
    weight = np.array([counts[w] for w in words], np.int64)[symbols.word]
    parts = []
    for n in range(1, ORDER + 1):
        at = symbols.grams(n)
        keys, group = np.unique(symbols.hashes[n][at], return_inverse=True)
        suffix, context = np.full((2, len(keys)), np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(suffix, group, symbols.hashes[n - 1][at])
        if n > 1:
            np.minimum.at(context, group, symbols.hashes[n - 1][at - 1])
        else:
            context[:] = 0
        inner, seen = np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        np.logical_or.at(inner, group, symbols.depth[at] >= n)
        np.add.at(seen, group, weight[at])
        cells = np.full(len(keys), n), keys, suffix, context, inner, seen
        parts.append(pa.table([pa.array(cell.astype(kind)) for cell, kind in zip(cells, _KINDS)], _GRAM))
    return pa.concat_tables(parts)


_GRAM = ["n", "key", "suffix", "context", "inner", "seen"]
_KINDS = [np.int32, np.int64, np.int64, np.int64, np.bool_, np.int64]


class KneserNey:
    """One language's model, of counted words or of a table as :func:`gram_counts` makes it.
    ``alphabet`` is the number of symbols that a model may meet."""

    def __init__(self, counts: dict[str, int] | pa.Table, alphabet: int):
        table = counts if isinstance(counts, pa.Table) else gram_counts(counts)
        order, *cells = (table.column(name).to_numpy() for name in _GRAM)
        self.grams: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.contexts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        distinct = {}
        for n in range(1, ORDER + 1):
            part = [cell[order == n] for cell in cells]
            sort = np.argsort(part[0].astype(np.uint64), kind="stable")  # stored as signed numbers
            distinct[n] = [cell[sort].astype(kind) for cell, kind in zip(part, (np.uint64,) * 3 + (bool, float))]
        lower = np.full(0, 0.0)
        for n in range(1, ORDER + 1):
            keys, suffix, context, inner, count = distinct[n]
            if n < ORDER:
                # The count of a lower order is the number of distinct symbols before the n-gram;
                # at the begin of a word there are none, and the plain count stands.
                at, _ = _find(keys, distinct[n + 1][1])
                before = np.bincount(at, minlength=len(keys))
                count = np.where(inner, np.maximum(1, before), count)
            once, twice = (count == 1).sum(), (count == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            heads, group = np.unique(context, return_inverse=True)
            total = np.bincount(group, count, len(heads))
            kinds = np.bincount(group, minlength=len(heads))
            weight_of_lower = discount * kinds / total
            if n == 1:
                below = np.full(len(keys), 1.0 / alphabet)
            else:
                at, _ = _find(self.grams[n - 1][0], suffix)
                below = lower[at]
            lower = (count - discount) / total[group] + weight_of_lower[group] * below
            self.grams[n] = keys, np.log(lower).astype(np.float32)
            self.contexts[n] = heads, np.log(weight_of_lower).astype(np.float32)
        self.unseen = float(-np.log(alphabet))

    def score(self, symbols: Symbols) -> np.ndarray:
        """The log probability of each word."""
        total = np.zeros(len(symbols.depth))
        open_ = symbols.depth > 0
        for n in range(ORDER, 0, -1):
            at = np.flatnonzero(open_ & (symbols.depth >= n - 1))
            keys, values = self.grams[n]
            place, found = _find(keys, symbols.hashes[n][at])
            total[at[found]] += values[place[found]]
            open_[at[found]] = False
            rest = at[~found]
            heads, weights = self.contexts[n]
            context = symbols.hashes[n - 1][rest - 1] if n > 1 else np.zeros(len(rest), np.uint64)
            place, found = _find(heads, context)
            total[rest[found]] += weights[place[found]]
        total[open_] += self.unseen
        return np.bincount(symbols.word, total, len(symbols.ends))


@dataclass
class Model:
    languages: list[str]
    models: list[KneserNey]
    sharpness: float
    limits: np.ndarray

    def score(self, words: list[str]) -> np.ndarray:
        """Log probability of each word under each language."""
        symbols = Symbols(words)
        return np.stack([m.score(symbols) for m in self.models], axis=1)


class Scorer:
    """A model and what it said of the words met so far, a bounded number."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.ids: dict[str, int] = {}
        self.logs = np.zeros((0, len(self.model.models)))
        self.sizes = np.zeros(0, np.int64)

    def entropies(self, texts: list[list[str]]) -> list[tuple[list[float] | None, int]]:
        """Cross-entropy per symbol under each language, None for a text without letters; symbols."""
        met = {word for words in texts for word in words}
        new = list(met - self.ids.keys())
        if len(self.ids) + len(new) > MEMO_WORDS:
            self._forget()
            new = list(met)
        if new:
            self.ids.update(zip(new, range(len(self.ids), len(self.ids) + len(new))))
            self.logs = np.concatenate((self.logs, self.model.score(new)))
            self.sizes = np.concatenate((self.sizes, [len(word) + 1 for word in new]))
        out = []
        for words in texts:
            at = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
            symbols = int(self.sizes[at].sum())
            out.append(((-self.logs[at].sum(axis=0) / symbols).tolist() if has_letter(words) else None, symbols))
        return out


def _word_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``word`` and ``seen``, over all documents; tasks count their own first."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("seen", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        def records():
            counts, held = {}, 0
            for text, lang in rows(batches):
                found = counts.setdefault(lang, Counter())
                held -= len(found)
                found.update(words_of(text))
                held += len(found)
                if held >= WORDS_HELD:
                    yield from ((lang, word, n) for lang, found in counts.items() for word, n in found.items())
                    counts, held = {}, 0
            yield from ((lang, word, n) for lang, found in counts.items() for word, n in found.items())

        yield from packed(records(), schema)

    found = docs.select(F.col("text").cast("string"), "lang").mapInArrow(run, "lang string, word string, seen long")
    return found.groupBy("lang", "word").agg(F.sum("seen").alias("seen"))


def _gram_counts(words: DataFrame) -> DataFrame:
    """``lang`` and the columns of :func:`gram_counts`, over all words that hold a letter."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tables():
            counts: dict[str, dict[str, int]] = {}
            held = 0
            for lang, word, seen in rows(batches):
                if has_letter((word,)):
                    counts.setdefault(lang, {})[word] = seen
                    held += 1
                if held >= WORDS_AT_ONCE:
                    yield from counts.items()
                    counts, held = {}, 0
            yield from counts.items()

        for lang, found in tables():
            grams = gram_counts(found)
            yield from grams.add_column(0, "lang", pa.array([lang] * len(grams), pa.string())).to_batches()

    shape = "lang string, n int, key long, suffix long, context long, inner boolean, seen long"
    return words.select("lang", "word", "seen").mapInArrow(run, shape).groupBy("lang", "n", "key").agg(
        F.min("suffix").alias("suffix"), F.min("context").alias("context"), F.max("inner").alias("inner"),
        F.sum("seen").alias("seen"),
    )


def calibrates() -> Column:
    """Whether a document is held out from learning, by its ``doc_id``."""
    return F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(CALIBRATE_EVERY)) == 0


def learn(docs: DataFrame, where: Column | None = None) -> Model | None:
    """Fits a model per value of ``lang`` on all its documents but those held out, which calibrate
    it; ``where`` limits the rows that may be learnt from. A language of fewer than
    ``CALIBRATE_EVERY`` rows, or with all of them held out, learns from all and has none to
    calibrate. Rows with a null text, ``lang`` or ``doc_id`` teach nothing. Without rows to learn
    from there is no model. The driver gets every distinct n-gram of a language once."""
    usable = docs if where is None else docs.filter(where)
    usable = usable.filter("lang is not null and doc_id is not null and text is not null")
    usable = usable.select("doc_id", "lang", "text", calibrates().alias("held"))
    sizes = usable.groupBy("lang").agg(F.count("*").alias("n"), F.count_if("held").alias("held"))
    small = [r.lang for r in sizes.collect() if r.n < CALIBRATE_EVERY or r.n == r.held]
    held = F.col("held") & ~F.col("lang").isin(small)
    grams = _gram_counts(_word_counts(usable.filter(~held))).toArrow()
    languages = sorted(grams.column("lang").unique().to_pylist())
    if not languages:
        return None
    alphabet = len(grams.filter(pc.equal(grams["n"], 1)).column("key").unique()) + 1
    models = [KneserNey(grams.filter(pc.equal(grams["lang"], lang)), alphabet) for lang in languages]
    model = Model(languages, models, 1.0, np.zeros(0))
    _calibrate(model, usable.filter(held), alphabet)
    return model


def _calibrate(model: Model, held: DataFrame, alphabet: int) -> None:
    """How sharply entropies tell languages apart, and the entropy beyond which a text is rejected:
    half way from what nearly all of a language's held-out texts stay below to evenly drawn symbols."""
    names = F.array(*map(F.lit, model.languages))
    scored = entropies(held.select("doc_id", "text", "lang"), model).filter("entropies is not null")
    scored = scored.withColumns({"h": F.array_min("entropies"), "place": F.array_position(names, F.col("lang")).cast("int")})
    scored = scored.filter("place > 0").withColumn("own", F.expr("entropies[place - 1]"))
    losses = [
        F.sum(F.expr(f"{s!r}D * (own - h) + ln(aggregate(entropies, 0d, (a, e) -> a + exp({s!r}D * (h - e))))"))
        for s in SHARPNESSES
    ]
    seen = scored.groupBy("lang").agg(
        F.percentile_approx("own", 0.999, QUANTILE_ACCURACY).alias("most"), F.array(*losses).alias("losses")
    ).collect()
    uniform, most = float(np.log(alphabet)), {row.lang: row.most for row in seen}
    model.limits = np.array([(most.get(lang, uniform) + uniform) / 2 for lang in model.languages])
    if seen:
        total = np.sum([row.losses for row in sorted(seen, key=lambda row: row.lang)], axis=0)
        model.sharpness = SHARPNESSES[int(np.argmin(total))]


def entropies(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, the ``text``'s cross-entropy per symbol under each language (null without
    letters), its ``symbols``, and the further columns of ``docs``."""
    shared = Shared(docs.sparkSession, Scorer(model))
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    kinds = dict(docs.dtypes)
    shape = ", ".join(["doc_id long", "entropies array<double>", "symbols long", *(f"`{c}` {kinds[c]}" for c in rest)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value
        for batch in batches:
            for begin, end in _spans(batch.column(1)):
                part = batch.slice(begin, end - begin)
                found = scorer.entropies([words_of(t) for t in part.column(1).to_pylist()])
                cells = [pa.array([e for e, _ in found], pa.list_(pa.float64())), pa.array([n for _, n in found], pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *cells, *part.columns[2:]], ["doc_id", "entropies", "symbols", *rest]
                )

    table = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *rest)
    return table.mapInArrow(run, shape)


def _spans(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Stretches of rows with some TEXT_AT_ONCE bytes of text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    cuts = np.flatnonzero(np.diff(sizes // TEXT_AT_ONCE)) + 1
    bounds = [0, *cuts.tolist(), len(texts)]
    yield from ((a, b) for a, b in zip(bounds, bounds[1:]) if a < b)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (0 to 1), ``cross_entropy`` and ``rejected``.

    Whole texts are scored. A null text or one without a letter is ``und``, score 0, rejected, as
    is every text if there is no model. Ties go to the language that sorts first. A null
    ``doc_id`` stays null, repeated rows are scored each, an empty table gives no rows.
    """
    if model is None:
        return docs.select(
            F.col("doc_id").cast("long"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
            F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"),
        )
    names = F.array(*map(F.lit, model.languages))
    limits = F.array(*(F.lit(float(x)) for x in model.limits))
    scored = entropies(docs.select("doc_id", "text"), model).withColumn("h", F.array_min("entropies"))
    scored = scored.withColumn("best", F.array_position("entropies", F.col("h")).cast("int") - 1)
    share = F.expr(f"1 / aggregate(entropies, 0d, (s, e) -> s + exp({model.sharpness!r}D * (h - e)))")
    return scored.select(
        "doc_id",
        F.coalesce(F.get(names, F.col("best")), F.lit("und")).alias("lang_pred"),
        F.coalesce(share, F.lit(0.0)).alias("score"),
        F.col("h").alias("cross_entropy"),
        F.coalesce(
            F.col("h") > F.get(limits, F.col("best")) + SHORT / F.sqrt("symbols"), F.lit(True)
        ).alias("rejected"),
    )


def keep_known(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows whose text is not rejected, in all their columns.

    Rows that share a ``doc_id`` stay if one of them does. Rows with a null ``doc_id`` stay, as no
    verdict can be tied to them.
    """
    verdicts = identify(docs, model).filter("doc_id is not null").groupBy("doc_id")
    gone = verdicts.agg(F.expr("bool_and(rejected)").alias("gone")).filter("gone")
    return docs.join(gone, "doc_id", "left_anti").select(*every_column(docs))
