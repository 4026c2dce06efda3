"""Spelling variants: words one edit apart, by composing the vocabulary's acceptor with itself.

The words of all texts are counted first. Two words of lengths ``L`` and ``L`` or ``L + 1`` that are
one edit apart agree in all but one of a few blocks of places of the shorter one, so each word is
sent, for each block, to the key made of what stands outside. A group of keys holds a minimised
acceptor of its words' blocks, with an initial state for each key; equal endings share states. From
an initial state the acceptor is composed with a transducer that replaces or inserts one code point
(deleting is inserting, read backwards) and with the acceptor again. Accepted pairs are enumerated,
each state's or pair of states' once.

A key of very many words is dealt to parts, and each two parts meet in a group of their own.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.llm.workers import hold, packed, rows

# Distinct words counted in a task before their counts are sent on.
COUNTED = 200_000
# Code points of a block, at most, and words of two such blocks stand for themselves in groups;
# longer ones by a digest.
BLOCK = 32
# Rows of a group of keys, about, and of a key that is not dealt to parts, at most.
GROUP = 40_000
PART = 20_000

_COUNT = pa.schema([("word", pa.string()), ("n", pa.int64())])
_PLACED = pa.schema(
    [("key", pa.binary()), ("longer", pa.bool_()), ("block", pa.string()), ("ref", pa.string()), ("n", pa.int64())]
)
_PAIR = pa.schema([("ref", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


@dataclass(frozen=True)
class Rule:
    """Words are runs of ``letters`` (a regular expression's class) of at least ``length`` code
    points that occur at least ``count`` times; a variant's form is at least ``times`` as frequent.
    Of every ``slips``-th run of a document, by checksum, one code point is deleted (0: of none)."""

    letters: str = "A-Za-zÀ-ÿ"
    length: int = 6
    count: int = 5
    times: int = 5
    slips: int = 0


def slipped(run: str, base: int, slips: int) -> str:
    """The run, or what a slip of the pen leaves of it; ``base`` is the checksum of what precedes."""
    code = zlib.crc32(run.encode(), base)
    if code % slips:
        return run
    at = code % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, rule: Rule) -> DataFrame:
    """``word`` and ``n``, its number of occurrences in all texts, of every word that is long and
    frequent enough. A-Z are lower-cased. Null texts have none; a null id is empty in checksums."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(f"[{rule.letters}]{{{rule.length},}}").findall
        total: dict[str, int] = {}

        def counts():
            for doc_id, text in rows(batches):
                found = Counter(find(text.lower().decode()))  # lower() of bytes: A-Z only
                base = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in found.items():
                    if rule.slips:
                        word = slipped(word, base, rule.slips)
                    if len(word) >= rule.length:
                        total[word] = total.get(word, 0) + n
                if len(total) >= COUNTED:
                    yield from total.items()
                    total.clear()
            yield from total.items()

        yield from packed(counts(), _COUNT)

    table = docs.filter("text is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
    counted = table.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= rule.count)


def blocks_of(length: int) -> list[tuple[int, int]]:
    """The blocks of places of words of a length: two halves, or more in very long ones."""
    count = max(2, -(-length // BLOCK))
    edges = [length * k // count for k in range(count + 1)]
    return list(zip(edges, edges[1:]))


def reference(word: str) -> str:
    """What stands for a word in groups: itself, or a digest that no word equals."""
    if len(word) <= 2 * BLOCK:
        return word
    return "#" + hashlib.blake2b(word.encode(), digest_size=16).hexdigest()


def placements(word: str, least: int) -> Iterator[tuple[bytes, bool, str]]:
    """The keys of a word, whether it is there as the longer of two, and its block."""
    for longer in (False, True):
        length = len(word) - longer
        if length < least:
            continue
        for at, (start, end) in enumerate(blocks_of(length)):
            before, after = word[:start], word[end + longer :]
            key = hashlib.blake2b(f"{length},{at},{before},{after}".encode(), digest_size=16).digest()
            yield key, longer, word[start : end + longer]


class Acceptor:
    """Minimal acyclic automata that share their states; a state is a number."""

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.out: list[tuple[tuple[str, int], ...]] = []
        self.ends: list[bool] = []
        self.all_of: dict[int, list[str]] = {}
        self.common: dict[tuple[int, int], list[str]] = {}
        self.replaced: dict[tuple[int, int], list[tuple[str, str]]] = {}
        self.inserted: dict[tuple[int, int], list[tuple[str, str]]] = {}

    def state(self, ends: bool, out: tuple[tuple[str, int], ...]) -> int:
        found = self.known.setdefault((ends, out), len(self.out))
        if found == len(self.out):
            self.out.append(out)
            self.ends.append(ends)
        return found

    def accept(self, words: list[str], depth: int = 0) -> int:
        """The initial state of an automaton of these words, which are sorted and different."""
        if len(words) == 1:
            state = self.state(True, ())
            for letter in reversed(words[0][depth:]):
                state = self.state(False, ((letter, state),))
            return state
        ends = len(words[0]) == depth
        out, start = [], int(ends)
        for place in range(start, len(words)):
            if place + 1 == len(words) or words[place + 1][depth] != words[place][depth]:
                out.append((words[place][depth], self.accept(words[start : place + 1], depth + 1)))
                start = place + 1
        return self.state(ends, tuple(out))

    def language(self, p: int) -> list[str]:
        found = self.all_of.get(p)
        if found is None:
            found = [""] if self.ends[p] else []
            for letter, q in self.out[p]:
                found += [letter + rest for rest in self.language(q)]
            self.all_of[p] = found
        return found

    def meet(self, p: int, q: int) -> list[str]:
        """What both states accept."""
        if p == q:
            return self.language(p)
        key = (p, q) if p < q else (q, p)
        found = self.common.get(key)
        if found is None:
            found = [""] if self.ends[p] and self.ends[q] else []
            if self.out[p] and self.out[q]:
                other = dict(self.out[q])
                for letter, r in self.out[p]:
                    if letter in other:
                        found += [letter + rest for rest in self.meet(r, other[letter])]
            self.common[key] = found
        return found

    def replacing(self, p: int, q: int) -> list[tuple[str, str]]:
        """What ``p`` accepts and, one code point replaced, ``q``; of one state each pair once."""
        found = self.replaced.get((p, q))
        if found is None:
            found = []
            for a, r in self.out[p]:
                for b, s in self.out[q]:
                    if a == b:
                        found += [(a + u, b + v) for u, v in self.replacing(r, s)]
                    elif p != q or a < b:
                        found += [(a + rest, b + rest) for rest in self.meet(r, s)]
            self.replaced[p, q] = found
        return found

    def inserting(self, p: int, q: int) -> list[tuple[str, str]]:
        """What ``p`` accepts and, one code point inserted, ``q``. Inserted into a row of the same
        code point, it comes last, so each pair is found once."""
        found = self.inserted.get((p, q))
        if found is None:
            found = []
            other = dict(self.out[p])
            for b, s in self.out[q]:
                found += [(rest, b + rest) for rest in self.meet(p, s) if not rest.startswith(b)]
                if b in other:
                    found += [(b + u, b + v) for u, v in self.inserting(other[b], s)]
            self.inserted[p, q] = found
        return found


def near_pairs(placed: Iterable[tuple[bytes, bool, str, str, int, int]], one: int, two: int) -> Iterator[tuple[str, str, int]]:
    """Pairs of references of words one edit apart, both ways, with the second one's count.

    ``placed`` are key, longer, block, reference, count and part; part ``one`` meets part ``two``.
    """
    keys = defaultdict(list)
    for key, *rest in placed:
        keys[key].append(rest)
    acceptor = Acceptor()
    for members in keys.values():
        if len(members) < 2:
            continue
        named = [({}, {}), ({}, {})]  # by part, then shorter and longer: block to reference, count
        for longer, block, ref, n, part in members:
            named[part != one][longer][block] = ref, n
        if one == two:
            named[1] = named[0]
        state = [[acceptor.accept(sorted(side)) if side else None for side in part] for part in named]
        ways = [(0, False, 1, False), (0, False, 1, True)] + [(1, False, 0, True)] * (one != two)
        for i, a, j, b in ways:
            p, q = state[i][a], state[j][b]
            if p is None or q is None:
                continue
            for u, v in acceptor.inserting(p, q) if b else acceptor.replacing(p, q):
                (left, n), (right, m) = named[i][a][u], named[j][b][v]
                yield left, right, m
                yield right, left, n


def neighbours(words: DataFrame, least: int) -> DataFrame:
    """``ref``, ``near``, ``near_n``: each ordered pair of words (``word``, ``n``; at least ``least``
    code points) that differ by exactly one inserted, deleted or replaced code point, by their
    :func:`reference`, once or more."""

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for word, n in rows(batches):
                ref = reference(word)
                for key, longer, block in placements(word, least):
                    yield key, longer, block, ref, n

        yield from packed(found(), _PLACED)

    def compose(table: pa.Table) -> pa.Table:
        columns = [table.column(name).to_pylist() for name in ("key", "longer", "block", "ref", "n", "part")]
        one, two = table.column("one")[0].as_py(), table.column("two")[0].as_py()
        batches = list(packed(near_pairs(zip(*columns), one, two), _PAIR, most=65_536))
        return pa.Table.from_batches(batches, schema=_PAIR)

    placed = words.select("word", "n").mapInArrow(place, "key binary, longer boolean, block string, ref string, n long")
    counts = hold(placed.groupBy("key").count().filter("count > 1"), "spelling-keys")
    groups = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0] // GROUP + 1
    counts = counts.withColumn("parts", F.ceil(F.col("count") / PART))
    # A dealt key has a group for each two of its parts; other keys share groups.
    dealt = placed.join(counts, "key").withColumn("part", F.pmod(F.xxhash64("ref"), F.col("parts")))
    meets = "transform(sequence(0L, parts - 1), k -> struct(least(k, part) as one, greatest(k, part) as two))"
    number = F.when(F.col("parts") > 1, F.xxhash64("key")).otherwise(F.pmod(F.xxhash64("key"), F.lit(groups)))
    dealt = dealt.withColumn("several", F.col("parts") > 1).withColumn("number", number)
    dealt = dealt.withColumn("meet", F.explode(F.expr(meets)))
    dealt = dealt.select("several", "number", "meet.one", "meet.two", "key", "longer", "block", "ref", "n", "part")
    return dealt.groupBy("several", "number", "one", "two").applyInArrow(compose, "ref string, near string, near_n long")


def variants(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row per word of the vocabulary of all texts (see :class:`Rule`): ``word``, ``form`` (its
    most frequent near word, ties to the smallest in code-point order, if frequent enough; else
    null), ``root`` (where following forms ends; the word itself without one), ``n``, ``n_near``
    (number of near words) and ``form_n``.

    Near words differ by exactly one inserted, deleted or replaced code point. Null and empty texts
    have no words; repeated rows and ties count each; an empty table gives no rows; further columns
    are not read.
    """
    words = hold(vocabulary(docs, rule), "vocabulary")
    long = F.length("word") > 2 * BLOCK
    digest = F.udf(reference, "string").asNondeterministic()
    named = hold(words.filter(long).select(digest("word").alias("ref"), F.col("word").alias("name")), "vocabulary")
    pairs = neighbours(words, rule.length).distinct()
    pairs = pairs.join(named.withColumnRenamed("ref", "near"), "near", "left")
    pairs = pairs.withColumn("near_word", F.coalesce("name", "near")).drop("name")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near_word").alias("form"))).alias("best")
    best = pairs.groupBy("ref").agg(F.count("*").alias("n_near"), best)
    best = best.join(named, "ref", "left").select(
        F.coalesce("name", "ref").alias("word"), "n_near", "best.form", (-F.col("best.less")).alias("form_n")
    )
    found = words.join(best, "word", "left")
    enough = F.col("form_n") >= rule.times * F.col("n")
    found = hold(
        found.select(
            "word", F.when(enough, F.col("form")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("form_n")).alias("form_n"),
        ),
        "spellings",
    )
    return found.join(roots(found), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def roots(found: DataFrame) -> DataFrame:
    """``word`` and ``root`` of each word with a ``form``. Every step doubles how far forms are
    followed; as counts grow at every form, there are no circles."""
    ahead = hold(found.filter("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = ahead.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        if ahead.join(onward, "root", "left_semi").isEmpty():
            return ahead
        ahead = ahead.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"))
        ahead = hold(ahead, "spelling-roots")
