"""Periodic runs of words in texts, proposed by dictionaries of basic factors.

A dictionary names every factor (stretch of words) of a power-of-two length, equal factors alike;
the names of one length, two by two, give those of the next. Equal factors that follow each other
within twice their length propose their distance as a period. Where such distances stay the same
over consecutive places, the occurrences form an arithmetic progression, and the stretch from its
first to the end of its last has that period. It is extended both ways while words a period apart
are identical, and runs proposed more than once are kept once.

A run of period ``q`` is at least four periods long, so its factors of a length from ``q`` to
``2q - 1`` recur first after exactly ``q`` words, all through the run: the length in that range
proposes each run, whole and by its smallest period.

Texts are worked on one by one in the tasks that read them; nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.llm.workers import packed, rows

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FIELDS = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.binary())]
_SHAPE = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"


@dataclass(frozen=True)
class Rule:
    """A run has at least ``words`` words and ``periods`` periods (4 or more: fewer don't suffice
    for the proposals to be whole)."""

    words: int = 6
    periods: int = 4

    def __post_init__(self):
        if self.periods < 4:
            raise ValueError("runs of fewer than 4 periods are not found")


def word_numbers(words: list[bytes]) -> np.ndarray:
    """A number for each word, the same for identical ones."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(word, len(known)) for word in words), np.int64, len(words))


def recurring(names: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of factors at rising places: places and new names of those that occur twice or more, and the
    distance of each to its next occurrence (0 for the last)."""
    order = np.argsort(names, kind="stable")
    ordered = names[order]
    same = ordered[1:] == ordered[:-1]
    again = np.zeros(len(order), bool)
    again[1:] = same
    again[:-1] |= same
    step = np.zeros(len(order), np.int64)
    step[:-1][same] = (places[order[1:]] - places[order[:-1]])[same]
    name = np.zeros(len(order), np.int64)
    name[1:] = np.cumsum(~same)
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    keep = again[back]
    return places[keep], name[back][keep], step[back][keep]


def runs_of(numbers: np.ndarray, rule: Rule = Rule()) -> list[tuple[int, int, int]]:
    """Start, length and period of every run in a sequence of numbers, by start, then period."""
    n = len(numbers)
    found: set[tuple[int, int, int]] = set()
    size, places, names = 1, np.arange(n), numbers
    while (size // 2 + 1) * rule.periods <= n:
        places, names, step = recurring(names, places)
        if not len(places):  # no factor of this length recurs, hence no longer one
            break
        near = (step > size // 2) & (step <= 2 * size)
        if near.any():
            # Consecutive places of one distance: the progressions of the factors that start there.
            first = near.copy()
            first[1:] &= ~((places[1:] == places[:-1] + 1) & (step[1:] == step[:-1]))
            last = near.copy()
            last[:-1] &= ~((places[1:] == places[:-1] + 1) & (step[1:] == step[:-1]))
            starts, periods = places[first], step[first]
            ends = places[last] + size + periods
            some = ends - starts >= np.maximum(rule.words, rule.periods * periods)
            for start, end, period in zip(starts[some].tolist(), ends[some].tolist(), periods[some].tolist()):
                while start > 0 and numbers[start - 1] == numbers[start - 1 + period]:
                    start -= 1
                while end < n and numbers[end] == numbers[end - period]:
                    end += 1
                found.add((start, end - start, period))
        # Factors of twice the length are pairs of recurring ones, a length apart.
        where = np.searchsorted(places, places + size)
        paired = where < len(places)
        paired[paired] = places[where[paired]] == places[paired] + size
        left, right = names[paired], names[where[paired]]
        places, names = places[paired], left * (int(names.max()) + 1) + right
        size *= 2
    return sorted(smallest(found), key=lambda run: (run[0], run[2]))


def smallest(found: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of runs over the same words the one with the smallest period."""
    least: dict[tuple[int, int], int] = {}
    for start, length, period in found:
        least[start, length] = min(period, least.get((start, length), period))
    return [(start, length, period) for (start, length), period in least.items()]


def kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay when each run is cut to its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a periodic ending in one document of ten, chosen and shaped by its number.

    A null number plants nothing.
    """
    code = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if code is None or code % 10 or not words:
        return words
    n, rest = len(words), code // 10
    begin = rest % n
    period = 1 + (n - begin) // (3 + rest % 8)
    cycle = words[begin : begin + period]
    turns = (n - begin) // len(cycle) + 1
    return words[:begin] + (cycle * turns)[: n - begin]


def collapse(docs: DataFrame, rule: Rule = Rule(), change: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (start and length in words, and period, by start, then
    period) and ``collapsed``: the words that stay when every run is cut to its first period,
    joined by a space.

    Words are what stands between ASCII white space, as it is written; ``change`` may replace those
    of a document before. A null or empty text, or one without words, has no runs and an empty
    ``collapsed``. Rows are worked on each for itself: null and repeated ids, ties and further
    columns of any name change nothing; an empty table gives no rows.
    """
    schema = pa.schema(_FIELDS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for doc_id, text in rows(batches):
                words = (text or b"").split()
                if change:
                    words = change(doc_id, words)
                runs = runs_of(word_numbers(words), rule)
                stay = compress(words, kept(len(words), runs).tolist()) if runs else words
                listed = [dict(zip(("start", "length", "period"), one)) for one in runs]
                yield doc_id, len(words), listed, b" ".join(stay)

        yield from packed(found(), schema)

    table = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
    return table.mapInArrow(run, _SHAPE).withColumn("collapsed", F.col("collapsed").cast("string"))


def digests(collapsed: DataFrame) -> DataFrame:
    """What :func:`collapse` found, one row per document: its strongest run (greatest exact length
    over period; ties: smallest start, then period; nulls without a run), 1000 times its length
    over its period, rounded down, and SHA-256 digests of all runs and of the collapsed text."""
    stronger = "(a, r) -> if(a is null or r.length * a.period > a.length * r.period, r, a)"
    none = "cast(null as struct<start: long, length: long, period: long>)"
    return collapsed.withColumn("best", F.expr(f"aggregate(runs, {none}, {stronger})")).selectExpr(
        "doc_id", "n_words", "cast(size(runs) as long) as n_runs", "best.start", "best.length", "best.period",
        "1000 * best.length div best.period as exponent_milli",
        "sha2(array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), ''), 256) as runs_sha256",
        "sha2(collapsed, 256) as collapsed_sha256",
    )
