"""Exact Jaccard join of n-gram sets through prefix trees, with components of the links.

Sets come together first. Two sets that are similar enough differ in at most ``d`` n-grams, a number
that their sizes bound. If hashes are cut into ``d + 1 + e`` ranges, the sets agree wholly on more
than ``e`` of them, hence on one that isn't empty, if no more than ``e`` are. Each set sends a sum of
its hashes for every range, and sets that agree on a sum are put into one class. Classes only
propose; most texts have none.

Within a class (or two parts of a large one) n-grams are put into one order, rarest first, and the
ordered sets into a tree in which equal beginnings are one path. A set goes down the tree with its
overlap so far, shared by all sets below; a subtree is left where what remains, of the set or of
those below, can't make the overlap that the similarity asks for, or where all below is linked to
the set already. At a leaf the overlap is exact.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlens.llm.simhash import contract
from sensorlens.llm.workers import hold, packed, rows

SEED = 11
# Set contents that a task remembers, so as to send their sums once.
REMEMBERED = 100_000
# Bytes of n-gram hashes, about, of the classes in a group, and of a part of a large class.
GROUP_BYTES = 16 << 20

_SET = pa.schema(
    [("doc_id", pa.int64()), ("content", pa.binary()), ("n", pa.int64()), ("node", pa.int64()), ("marks", pa.list_(pa.int64()))]
)
_GRAMS = pa.schema([("content", pa.binary()), ("grams", pa.binary())])
_EDGE = pa.schema([("a", pa.binary()), ("b", pa.binary())])
_GOLDEN = 0x9E3779B97F4A7C15
_LEAST = -(1 << 63)


def _bounds() -> list[int]:
    found = [1]
    while found[-1] < 1 << 40:
        found.append(max(found[-1] + 1, found[-1] * 6 // 5))
    return found


# The smallest set of each size class; the largest is a fifth larger, about.
BOUNDS = _bounds()


@dataclass(frozen=True)
class Rule:
    """Sets of stretches of ``words`` words; linked if ``of * intersection >= share * union``."""

    words: int
    share: int
    of: int = 100

    def differing(self, n: int) -> int:
        """How many elements two linked sets of at most ``n`` differ in, at most."""
        return 2 * n * (self.of - self.share) // (self.of + self.share)

    def partners(self, n: int) -> tuple[int, int]:
        """The sizes of the smallest and the largest set that one of ``n`` may be linked with."""
        return -(-self.share * n // self.of), n * self.of // self.share

    def linked(self, both, sizes):
        """Whether sets of these sizes together, with these intersections, are linked."""
        return (self.of + self.share) * both >= self.share * sizes


def mixed(values: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        values = (values ^ (values >> np.uint64(shift))) * np.uint64(factor)
    return values ^ (values >> np.uint64(31))


def gram_hashes(text: bytes, words: int) -> np.ndarray:
    """64-bit hashes of the different n-grams of a text, in order; of fewer words, of all of them as
    one; of none, nothing. Words stand between ASCII white space, A-Z lower-cased."""
    from xxhash import xxh64_intdigest

    parts = text.lower().split()  # bytes: A-Z only, and ASCII white space only
    known: dict[bytes, int] = {}
    for part in parts:
        if part not in known:
            known[part] = xxh64_intdigest(part, SEED)
    hashes = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
    length = min(words, len(parts))
    if not length:
        return hashes
    grams = np.full(len(parts) - length + 1, length, np.uint64)
    for k in range(length):
        grams = mixed(grams + np.uint64(_GOLDEN) + hashes[k : len(hashes) - length + k + 1])
    return np.unique(grams)


@cache
def ranges_of(size_class: int, rule: Rule) -> tuple[np.ndarray, int]:
    """Where the ranges of hashes begin for links whose larger set is of this class, and how many
    may be empty in a set that needs no sums of empty ones. That number is chosen so that sets
    with more empty ranges are as rare as can be."""
    differ = rule.differing(BOUNDS[size_class + 1] - 1)
    smallest = rule.partners(BOUNDS[size_class])[0]
    best = None
    for empty in range(33 if differ else 1):
        count = differ + 1 + empty
        mean = count * (1 - 1 / count) ** smallest
        chance, more = 1.0, math.exp(-mean)
        for k in range(empty + 1):
            chance -= more
            more *= mean / (k + 1)
        if best is None or chance < best[0]:
            best = chance, count, empty
        if chance < 1e-6:
            break
    _, count, empty = best
    return np.array([(k << 64) // count for k in range(count)], np.uint64), empty


def marks_of(grams: np.ndarray, rule: Rule) -> np.ndarray:
    """The sums of a set's hashes by range, mixed with their range and size class."""
    found = []
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(grams)))
    largest = rule.partners(len(grams))[1]
    for size_class in range(bisect_right(BOUNDS, len(grams)) - 1, bisect_right(BOUNDS, largest)):
        begins, empty = ranges_of(size_class, rule)
        edges = np.append(np.searchsorted(grams, begins), len(grams))
        tags = np.arange(len(begins), dtype=np.uint64) + np.uint64((size_class << 44) + 1)
        marks = mixed(sums[edges[1:]] - sums[edges[:-1]] + mixed(tags * np.uint64(_GOLDEN)))
        filled = edges[1:] > edges[:-1]
        few = np.count_nonzero(~filled) <= empty
        found.append(marks[filled] if few else marks)
    return np.concatenate(found).view(np.int64)


def digest_of(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def sets_of(docs: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id``, the digest ``content`` of the set, its size ``n``, and for proposals a number
    ``node`` of the content with its ``marks`` (none where the task has sent them already)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            sent = set()
            for doc_id, text in rows(batches):
                grams = gram_hashes(text or b"", rule.words)
                content = digest_of(grams)
                marks = []
                if len(grams) and content not in sent:
                    marks = marks_of(grams, rule)
                    if len(sent) < REMEMBERED:
                        sent.add(content)
                yield doc_id, content, len(grams), int.from_bytes(content[:8], "big", signed=True), marks

        yield from packed(found(), _SET, most=1024)

    table = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
    return table.mapInArrow(run, "doc_id long, content binary, n long, node long, marks array<long>")


def classes_of(sets: DataFrame) -> DataFrame:
    """``node`` and ``label`` of the contents that share a mark with another, directly or not."""
    marks = sets.select(F.explode("marks").alias("mark"), "node")
    shared = marks.groupBy("mark").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    shared = hold(shared.filter("least < most").select("mark", "least"), "ngram-marks")
    edges = marks.join(shared, "mark").select(F.col("node").alias("a"), F.col("least").alias("b"))
    hung = contract(edges)
    return hung.union(hung.select("label", "label").distinct())


def grams_of(docs: DataFrame, rule: Rule) -> DataFrame:
    """``content`` and ``grams``: the hashes of each document's n-grams, in order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for (text,) in rows(batches):
                grams = gram_hashes(text or b"", rule.words)
                yield digest_of(grams), grams.astype("<u8").tobytes()

        yield from packed(found(), _GRAMS)

    table = docs.select(F.col("text").cast("string").cast("binary"))
    return table.mapInArrow(run, "content binary, grams binary")


class Forest:
    """Prefix trees of ordered sets, one for each label.

    ``flat`` holds the elements of set ``k`` at ``start[k]`` to ``start[k + 1]``, in order; ``sizes``
    count also elements that stand in one set only and are not in ``flat``.
    """

    def __init__(self, flat: np.ndarray, start: np.ndarray, labels: np.ndarray, sizes: np.ndarray, rule: Rule):
        self.flat, self.rule = flat, rule
        kept = np.diff(start)
        written = flat.astype(">u4").tobytes()
        cells = [written[4 * a : 4 * b] for a, b in zip(start[:-1].tolist(), start[1:].tolist())]
        listed = labels.tolist()
        order = sorted(range(len(cells)), key=lambda k: (listed[k], cells[k]))
        depth, parent, low, high, stack = [], [], [], [], []
        self.root: dict[int, int] = {}

        def node(deep: int, above: int, begin: int) -> int:
            depth.append(deep)
            parent.append(above)
            low.append(begin)
            high.append(len(order))
            return len(depth) - 1

        before = None
        for place, k in enumerate(order):
            if before is None or listed[before] != listed[k]:
                for old in stack:
                    high[old] = place
                stack = [node(0, -1, place)]
                self.root[listed[k]] = stack[0]
            else:
                a, b = start[before], start[k]
                length = min(kept[before], kept[k])
                differ = flat[a : a + length] != flat[b : b + length]
                common = int(differ.argmax()) if differ.any() else int(length)
                while depth[stack[-1]] > common:
                    last = stack.pop()
                    high[last] = place
                    if depth[stack[-1]] < common:
                        middle = node(common, stack[-1], low[last])
                        parent[last] = middle
                        stack.append(middle)
            stack.append(node(int(kept[k]) + 1, stack[-1], place))  # as if it ended in a sign of its own
            before = k
        self.order = np.array(order)
        self.low, self.high = np.array(low), np.array(high)
        parent, depth = np.array(parent), np.array(depth)
        first = self.order[self.low]
        self.leaf = depth > kept[first]
        self.deep = np.where(self.leaf, kept[first], depth)
        self.begin = start[first] + np.where(parent < 0, 0, self.deep[parent])
        self.end = start[first] + self.deep
        # The smallest set below, and the least that any set below lacks.
        spans = np.ravel(np.column_stack((self.low, self.high)))
        lacks = rule.share * sizes - (rule.of + rule.share) * kept
        self.smallest = np.minimum.reduceat(np.append(sizes[self.order], 0), spans)[::2]
        self.lacking = np.minimum.reduceat(np.append(lacks[self.order], 0), spans)[::2]
        self.below = np.argsort(parent, kind="stable")[np.count_nonzero(parent < 0) :]
        counts = np.bincount(parent[parent >= 0], minlength=len(parent))
        self.children = counts
        self.first_child = np.cumsum(counts) - counts

    def search(self, ones: np.ndarray, marked: np.ndarray, keys: np.ndarray, width: int, start: np.ndarray,
               labels: np.ndarray, sizes: np.ndarray, team: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a set of ``ones`` (of different labels) and a linked one of another team.

        ``marked`` tells which elements are in the sets sought; ``keys`` are set and element as one
        rising number, ``last`` is where a row of one team in the tree's order ends."""
        rule, total = self.rule, self.rule.of + self.rule.share
        one = np.arange(len(ones))
        nodes = np.array([self.root[label] for label in labels[ones].tolist()])
        both = np.zeros(len(ones), np.int64)
        found = []
        while len(nodes):
            many = self.children[nodes]
            one, both = np.repeat(one, many), np.repeat(both, many)
            offset = np.arange(len(one)) - np.repeat(np.cumsum(many) - many, many)
            nodes = self.below[np.repeat(self.first_child[nodes], many) + offset]
            low = self.low[nodes]
            mine = ones[one]
            go = ~((team[self.order[low]] == team[mine]) & (last[low] >= self.high[nodes]))
            one, both, nodes, mine = one[go], both[go], nodes[go], mine[go]
            long = self.end[nodes] - self.begin[nodes]
            places = np.repeat(self.begin[nodes] - np.cumsum(long) + long, long) + np.arange(long.sum())
            hits = np.concatenate(([0], np.cumsum(marked[self.flat[places]])))
            ends = np.cumsum(long)
            both = both + hits[ends] - hits[ends - long]
            # What may still be shared: the set's later elements, or those of the sets below.
            deep = self.deep[nodes]
            at = np.where(deep > 0, self.flat[self.end[nodes] - 1], -1)
            rest = start[mine + 1] - np.searchsorted(keys, mine * width + at, "right")
            go = (total * (both + rest) >= rule.share * (sizes[mine] + self.smallest[nodes])) & (
                total * (both - deep) - rule.share * sizes[mine] >= self.lacking[nodes]
            )
            one, both, nodes, mine = one[go], both[go], nodes[go], mine[go]
            leaf = self.leaf[nodes]
            theirs = self.order[self.low[nodes[leaf]]]
            linked = rule.linked(both[leaf], sizes[mine[leaf]] + sizes[theirs])
            found.append((mine[leaf][linked], theirs[linked]))
            one, both, nodes = one[~leaf], both[~leaf], nodes[~leaf]
        return tuple(np.concatenate(side) for side in zip(*found))


def linked_sets(sets: list[np.ndarray], labels: np.ndarray, asks: np.ndarray, rule: Rule) -> np.ndarray:
    """For each set the least set of its team: what the links of the sets that ``ask`` with others
    of their label join."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    # Of different labels n-grams count as different.
    flat = flat ^ mixed(labels.astype(np.uint64) + np.uint64(1))[owner]
    grams, ids, counts = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(grams), np.int64)
    rank[np.lexsort((grams, counts))] = np.arange(len(grams))
    some = counts[ids] > 1
    width = len(grams) + 1
    keys = np.sort(owner[some] * width + rank[ids[some]])
    del flat, grams, ids, owner
    start = np.searchsorted(keys, np.arange(len(sets) + 1) * width)
    flat = keys % width
    tree = Forest(flat, start, labels, sizes, rule)
    team = np.arange(len(sets))
    marked = np.zeros(width, bool)
    asking: dict[int, list[int]] = {}
    enough = rule.of * np.diff(start) >= rule.share * sizes  # else too much of it stands nowhere else
    for k in np.flatnonzero(asks & enough).tolist():
        asking.setdefault(int(labels[k]), []).append(k)
    turn = 0
    while asking:
        ordered = team[tree.order]
        edges = np.append(np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, len(ordered))
        last = np.repeat(edges, np.diff(edges, prepend=0))
        asking = {
            label: some for label, some in asking.items()
            if turn < len(some) and last[tree.low[tree.root[label]]] < tree.high[tree.root[label]]
        }
        if not asking:
            break
        ones = np.array([some[turn] for some in asking.values()])
        places = np.concatenate([flat[start[k] : start[k + 1]] for k in ones.tolist()])
        marked[places] = True
        mine, theirs = tree.search(ones, marked, keys, width, start, labels, sizes, team, last)
        marked[places] = False
        if len(mine):
            to = np.arange(len(team))
            to[team[theirs]] = team[mine]
            team = to[team]
        turn += 1
    return team


def links(members: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """Edges ``a``, ``b`` between keys of ``members`` (``key``, ``content``, ``n``, ``label``,
    ``least``) whose components are those of all linked pairs of a label."""
    weight = members.groupBy("label").agg(F.sum(8 * F.col("n") + 64).alias("weight"))
    weight = hold(weight, "ngram-classes")
    total = weight.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    groups = total // GROUP_BYTES + 1
    large = weight.select("label", F.ceil(F.col("weight") / GROUP_BYTES).alias("parts")).filter("parts > 1")
    dealt = members.join(hold(large, "ngram-classes"), "label", "left")
    dealt = dealt.withColumn("several", F.col("parts").isNotNull()).withColumn("parts", F.coalesce("parts", F.lit(1)))
    number = F.when(F.col("several"), F.col("label")).otherwise(F.pmod(F.xxhash64("label"), F.lit(groups)))
    part = F.pmod(F.xxhash64("content"), F.col("parts"))
    dealt = dealt.select("content", "key", "label", "several", number.alias("number"), "parts", part.alias("part"))

    chosen = members.select("least").distinct()
    wanted = docs.join(chosen, docs["doc_id"].eqNullSafe(chosen["least"]), "left_semi")
    dealt = grams_of(wanted, rule).join(dealt, "content")
    meets = "transform(sequence(0L, parts - 1), k -> struct(least(k, part) as one, greatest(k, part) as two))"
    dealt = dealt.withColumn("meet", F.explode(F.expr(meets))).select(
        "several", "number", "meet.one", "meet.two", "part", "label", "key", "grams"
    )

    def join(table: pa.Table) -> pa.Table:
        names = table.column("key")
        asks = table.column("part").to_numpy() == table.column("one")[0].as_py()
        labels = np.unique(table.column("label").to_numpy(), return_inverse=True)[1]
        sets = [np.frombuffer(cell.as_buffer(), "<u8") for cell in table.column("grams")]
        team = linked_sets(sets, labels, asks, rule)
        joined = np.flatnonzero(team != np.arange(len(team)))
        columns = [names.take(pa.array(side)).cast(pa.binary()).combine_chunks() for side in (joined, team[joined])]
        return pa.table(columns, schema=_EDGE)

    return dealt.groupBy("several", "number", "one", "two").applyInArrow(join, "a binary, b binary")


def ordered_key(number: Column, content: Column) -> Column:
    """A content's key, such that keys stand in the order of numbers, nulls last."""
    digits = F.lpad(F.hex(number.bitwiseXOR(F.lit(_LEAST))), 16, "0")
    return F.concat(F.unhex(F.when(number.isNull(), "01" + "0" * 16).otherwise(F.concat(F.lit("00"), digits))), content)


def number_of(key: Column) -> Column:
    digits = F.conv(F.hex(F.substring(key, 2, 8)), 16, -10).cast("long")
    return F.when(F.substring(key, 1, 1) == F.lit(b"\0"), digits.bitwiseXOR(F.lit(_LEAST)))


def near_sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id``, ``n_shingles`` (the size of its set) and ``component_id``: the smallest
    ``doc_id`` that can be reached over links, itself included.

    Links hold between sets of whole texts (hashes of 64 bits stand for n-grams). A text without
    words, empty or null, has an empty set and no link, not even with another such text. Texts of
    one set are one node of any number of rows. Rows with a null ``doc_id`` take part; a component
    of only such rows has a null id. Repeated rows are listed each; an empty table gives no rows;
    other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sets = hold(sets_of(docs, rule), "ngram-sets")
    nodes = sets.filter("n > 0").groupBy("content", "n", "node").agg(F.min("doc_id").alias("least"))
    nodes = hold(nodes.withColumn("key", ordered_key(F.col("least"), F.col("content"))), "ngram-nodes")
    members = hold(nodes.join(classes_of(sets), "node").drop("node"), "ngram-classes")
    joined = contract(links(members, docs, rule))
    found = nodes.join(joined.withColumnRenamed("node", "key"), "key", "left").select(
        "content", number_of(F.coalesce("label", "key")).alias("component_id"), F.lit(True).alias("known")
    )
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("doc_id"))
    return sets.join(found, "content", "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
