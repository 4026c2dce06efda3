"""SimHash near-duplicates: fingerprints of word shingles, linked exactly through vantage-point trees.

A fingerprint is one or more 64-bit numbers. Two are linked if their first numbers differ in few
bits and all their numbers in few bits together; a rule may also ask that their texts have about
as many different shingles. The trees split by the distance of the first number to a vantage
point, or by the number of shingles (their logarithm's distance to a text of one shingle is a
vantage too), whichever fewer fingerprints cross. The upper levels, grown from a bounded sample,
cut space into shards. A fingerprint lives in one shard and also visits those whose boundary lies
within the linking distance (triangle bound); of two shards that could visit each other, one does.
Each shard finds its links with a tree of its own and returns them as a forest, so a group of
copies of any size gives as many edges as members. Forests are joined by label contraction.

A rule that asks for alike texts is about sets: each different shingle counts once, and components
of fingerprints only propose. Their texts are compared by exact Jaccard similarity, in blocks of
bounded size, and only what meets it is united.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.llm.workers import every_column, hold, packed, rows

SEED = 42
# Fingerprints that the upper tree is grown from; that live in a shard, about; and that visit a
# shard in one group, about.
SAMPLE = 4096
SHARD = 16_384
VISITORS = 1 << 18
# Fingerprints compared with all that may be near them at the bottom of a shard's tree.
LEAF = 512
# Shingle hashes whose bits are counted in one step; their counts fit 16 bits.
HASHES_AT_ONCE = 1 << 14
# Bytes of shingle hashes, about, in a block of texts that are compared with those of another.
BLOCK_BYTES = 16 << 20


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; fingerprints of ``numbers`` 64-bit numbers, linked if the first
    differ in at most ``first`` bits and all in at most ``distance``. With ``alike`` above 0 the
    fingerprints are of different shingles, and the smaller text must have at least that share of
    the larger one's, as any two texts of that Jaccard similarity do; their number then stands
    behind the fingerprint's. Texts so linked are united where their Jaccard similarity is at
    least ``alike``."""

    words: int
    numbers: int
    first: int
    distance: int
    alike: float = 0.0

    @property
    def size(self) -> int:
        return 8 * self.numbers


# Texts that share a Jaccard similarity of 0.8 in shingles have a cosine near 0.89, and differ in
# 15 % of the bits on average. 512 bits set them apart from texts below it with a standard error
# of 1.6 %; 64 bits would need a tolerance at which unlike texts meet.
SIMILAR = Rule(words=5, numbers=8, first=22, distance=87, alike=0.8)

_SHARD_ROW = pa.schema(
    [("shard", pa.int32()), ("part", pa.int32()), ("home", pa.bool_()), ("prints", pa.binary())]
)
_EDGE = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def numbers_of(hashes: np.ndarray, numbers: int) -> np.ndarray:
    """More 64-bit hashes of each shingle, by mixing its first one: an array of rows of numbers."""
    out = np.empty((len(hashes), numbers), np.uint64)
    out[:, 0] = hashes
    for k in range(1, numbers):
        mixed = hashes + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
        out[:, k] = mixed ^ (mixed >> np.uint64(31))
    return out


def shingle_hashes(text: bytes, rule: Rule) -> np.ndarray:
    """The hash of each shingle; if the rule compares texts, of each different one, in order."""
    from xxhash import xxh64_intdigest

    parts = text.lower().split()  # bytes: A-Z only, and ASCII white space only
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    last = ends[min(rule.words, len(parts)) - 1 :].tolist()
    hashes = np.fromiter((xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, last)), np.uint64, len(last))
    return np.unique(hashes) if rule.alike else hashes


def fingerprint(hashes: np.ndarray, rule: Rule) -> bytes:
    """The fingerprint, number by number in big-endian order: a bit is set if it is set in over
    half of the shingles' hashes. If the rule compares them, the number of different shingles
    follows (0 for a text without words)."""
    ones = np.zeros(64 * rule.numbers, np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        cells = numbers_of(hashes[at : at + HASHES_AT_ONCE], rule.numbers).astype(">u8").view(np.uint8)
        ones += np.unpackbits(cells, axis=1).sum(axis=0, dtype=np.uint16)
    found = np.packbits(2 * ones > len(hashes)).tobytes()
    return found + len(hashes).to_bytes(8, "big") if rule.alike else found


def fingerprints(docs: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id`` and ``print``; if the rule compares texts, also ``shingles``, the hashes of the
    different ones in order, and their digest ``content``. A text without words, empty or null, has
    a fingerprint of zeros; one with fewer words than a shingle is one shingle."""
    fields = [("doc_id", pa.int64()), ("print", pa.binary())]
    if rule.alike:
        fields += [("content", pa.binary()), ("shingles", pa.binary())]
    schema = pa.schema(fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b

        def prints():
            for doc_id, text in rows(batches):
                hashes = shingle_hashes(text or b"", rule)
                if rule.alike:
                    cell = hashes.astype("<u8").tobytes()
                    yield doc_id, fingerprint(hashes, rule), blake2b(cell, digest_size=16).digest(), cell
                else:
                    yield doc_id, fingerprint(hashes, rule)

        yield from packed(prints(), schema)

    table = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
    more = ", content binary, shingles binary" if rule.alike else ""
    return table.mapInArrow(run, "doc_id long, print binary" + more)


def unpacked(prints: Iterable[bytes], rule: Rule) -> np.ndarray:
    """Fingerprints put together as bytes to an array with a row of numbers each."""
    return np.frombuffer(b"".join(prints), ">u8").astype(np.uint64).reshape(-1, rule.numbers + (rule.alike > 0))


def packed_prints(prints: np.ndarray) -> bytes:
    return prints.astype(">u8").tobytes()


def far(point: np.uint64, others: np.ndarray) -> np.ndarray:
    return np.bitwise_count(others ^ point)


@dataclass(frozen=True)
class Split:
    """A boundary: fingerprints whose first number is at most ``radius`` bits from ``point`` are
    inside or, without a point, those with at most ``radius`` different shingles."""

    point: np.uint64 | None
    radius: int

    def sides(self, first: np.ndarray, sizes: np.ndarray, rule: Rule) -> tuple[np.ndarray, ...]:
        """Who is inside, who may be linked to one inside, and who to one outside."""
        if self.point is None:
            return sizes <= self.radius, sizes * rule.alike <= self.radius, sizes >= rule.alike * self.radius
        away = far(self.point, first).astype(np.int64) - self.radius
        return away <= 0, away <= rule.first, away > -rule.first


def best_split(first: np.ndarray, sizes: np.ndarray, rule: Rule) -> Split | None:
    """The median boundary, by a vantage point or by shingles, that fewer of these cross; none if
    they can't be told apart."""
    point = first[len(first) // 2]
    values = [(point, far(point, first))]
    if rule.alike:
        values.append((None, sizes))
    best = None
    for vantage, distances in values:
        radius = int(np.median(distances))
        if (distances <= radius).all():
            radius -= 1
        split = Split(vantage, radius)
        inside, near, beyond = split.sides(first, sizes, rule)
        crossing = np.count_nonzero(near & beyond)
        if inside.any() and not inside.all() and (best is None or crossing < best[0]):
            best = crossing, split
    return best and best[1]


def first_and_sizes(prints: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints' first numbers and, if the rule compares them, their numbers of shingles."""
    sizes = prints[:, rule.numbers] if rule.alike else np.zeros(len(prints))
    return np.ascontiguousarray(prints[:, 0]), sizes.astype(np.int64)


class UpperTree:
    """Boundaries of the upper levels, by breadth; leaf ``k`` is shard ``k``."""

    def __init__(self, sample: np.ndarray, depth: int, rule: Rule):
        self.shard_count, self.rule, self.splits = 1 << depth, rule, []
        first, sizes = first_and_sizes(sample, rule)
        parts = {0: np.arange(len(sample))}
        for node in range(self.shard_count - 1):
            part = parts.pop(node)
            split = (len(part) and best_split(first[part], sizes[part], rule)) or Split(np.uint64(0), 32)
            inside = split.sides(first[part], sizes[part], rule)[0]
            self.splits.append(split)
            parts[2 * node + 1], parts[2 * node + 2] = part[inside], part[~inside]

    def shards(self, prints: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each shard the places of fingerprints that live there, and of those that visit it.

        Shards stand in a ring; one is visited only from the half of the ring behind it, as two
        fingerprints that may be linked would otherwise visit each other.
        """
        first, sizes = first_and_sizes(prints, self.rule)
        lives = np.zeros(len(prints), np.int64)
        found = []
        stack = [(0, np.arange(len(prints)), np.ones(len(prints), bool))]
        while stack:
            node, part, home = stack.pop()
            if not len(part):
                continue
            if node >= len(self.splits):
                shard = node - len(self.splits)
                lives[part[home]] = shard
                found.append((shard, part[home], part[~home]))
                continue
            inside, near, beyond = self.splits[node].sides(first[part], sizes[part], self.rule)
            stack.append((2 * node + 1, part[near], (home & inside)[near]))
            stack.append((2 * node + 2, part[beyond], (home & ~inside)[beyond]))
        for shard, home, visitors in found:
            ahead = (lives[visitors] - shard) % self.shard_count
            opposite = (2 * ahead == self.shard_count) & (lives[visitors] > shard)
            yield shard, home, visitors[(2 * ahead < self.shard_count) | opposite]


def forest(home: np.ndarray, visitors: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """A forest that links what the pairs of (living, any) fingerprints that meet the rule link:
    each fingerprint with links, and its root."""
    everyone = np.concatenate((home, visitors))
    first, sizes = first_and_sizes(everyone, rule)
    root = np.arange(len(everyone))

    def unite(members: np.ndarray) -> None:
        roots = root[members]
        while True:  # follow to the roots
            up = root[roots]
            if (up == roots).all():
                break
            roots = up
        root[roots] = root[members] = roots.min()

    stack = [(np.arange(len(home)), np.arange(len(everyone)))]
    while stack:
        lives, near = stack.pop()
        split = best_split(first[lives], sizes[lives], rule) if len(lives) > LEAF else None
        if split:
            inside = split.sides(first[lives], sizes[lives], rule)[0]
            _, within, beyond = split.sides(first[near], sizes[near], rule)
            stack.append((lives[inside], near[within]))
            stack.append((lives[~inside], near[beyond]))
            continue
        if rule.alike:  # those of about the same size stand together
            near = near[np.argsort(sizes[near], kind="stable")]
            low = np.searchsorted(sizes[near], rule.alike * sizes[lives], "left")
            high = np.searchsorted(rule.alike * sizes[near], sizes[lives], "right")
        else:
            low, high = np.zeros(len(lives), np.int64), np.full(len(lives), len(near))
        prints = first[near]
        for one, start, stop in zip(lives.tolist(), low.tolist(), high.tolist()):
            hits = near[start:stop][far(first[one], prints[start:stop]) <= rule.first]
            if rule.numbers > 1 and len(hits) > 1:
                differ = everyone[hits, : rule.numbers] ^ everyone[one, : rule.numbers]
                bits = np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
                hits = hits[bits <= rule.distance]
            if len(hits) > 1:
                unite(hits)
    while True:
        up = root[root]
        if (up == root).all():
            break
        root = up
    linked = np.flatnonzero(root != np.arange(len(root)))
    return everyone[linked], everyone[root[linked]]


def links(prints: DataFrame, rule: Rule) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints (column ``print``) whose components are
    those of all pairs that meet the rule. Fingerprints travel in packed blocks; a shard with many
    visitors is several groups, each with all that live there and a part of the visitors."""
    n = prints.count()
    spread = max(n / SHARD, min(prints.sparkSession.sparkContext.defaultParallelism, n / LEAF))
    depth = max(0, int(np.ceil(np.log2(max(1, spread)))))
    parts = max(1, int(np.ceil(n / VISITORS)))
    sample = [bytes(row[0]) for row in prints.orderBy(F.xxhash64("print"), "print").limit(SAMPLE).collect()]
    tree = UpperTree(unpacked(sample, rule), depth, rule)

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks():
            for batch in batches:
                values = unpacked(batch.column(0).to_pylist(), rule)
                for shard, home, visitors in tree.shards(values):
                    for part in range(parts):
                        if len(home):
                            yield shard, part, True, packed_prints(values[home])
                        some = visitors[values[visitors, 0] % np.uint64(parts) == part]
                        if len(some):
                            yield shard, part, False, packed_prints(values[some])

        yield from packed(blocks(), _SHARD_ROW)

    def join(table: pa.Table) -> pa.Table:
        sides = {True: [], False: []}
        for home, block in zip(table.column("home").to_pylist(), table.column("prints").to_pylist()):
            sides[home].append(block)
        a, b = forest(unpacked(sides[True], rule), unpacked(sides[False], rule), rule)
        columns = [[row.tobytes() for row in side.astype(">u8")] for side in (a, b)]
        return pa.table([pa.array(column, pa.binary()) for column in columns], schema=_EDGE)

    shape = "shard int, part int, home boolean, prints binary"
    routed = prints.select("print").mapInArrow(route, shape)
    return routed.groupBy("shard", "part").applyInArrow(join, "a binary, b binary")


def contract(edges: DataFrame) -> DataFrame:
    """Components of a graph: ``node`` and ``label``, the same for all nodes of a component.

    Large-star and small-star steps: each node's larger neighbours, then its smaller ones, are
    hung onto its least neighbour, until every component is a star.
    """
    pairs = edges.filter("a != b").selectExpr("greatest(a, b) as u", "least(a, b) as v").distinct()
    pairs = hold(pairs, "links")
    while not _stars(pairs):
        both = pairs.union(pairs.selectExpr("v as u", "u as v"))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").selectExpr("v as u", "m as v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = "inline(array(struct(u, m as v), struct(v as u, m as v)))"
        small = large.join(least, "u").selectExpr(hung).filter("u != v").distinct()
        pairs = hold(small, "links")
    return pairs.selectExpr("u as node", "v as label")


def _stars(pairs: DataFrame) -> bool:
    """Whether no node hangs onto two others, and none that is hung onto hangs itself."""
    roots = pairs.selectExpr("v as u").distinct()
    twice = pairs.groupBy("u").count().filter("count > 1").select("u")
    return pairs.join(roots, "u", "left_semi").select("u").union(twice).isEmpty()


def alike_forest(sets: list[np.ndarray], blocks: np.ndarray, alike: float) -> tuple[np.ndarray, np.ndarray]:
    """A forest that links what the pairs of a Jaccard similarity of at least ``alike`` link: each
    set with links, and its root. Of two blocks only pairs across them are compared."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    order = np.argsort(sizes, kind="stable")
    sizes, blocks = sizes[order], blocks[order]
    ids = np.unique(np.concatenate([sets[k] for k in order.tolist()]), return_inverse=True)[1]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    across = len(np.unique(blocks)) > 1
    root = np.arange(len(sets))
    mark = np.zeros(int(ids.max()) + 1 if len(ids) else 1, bool)
    lowest = np.searchsorted(sizes, alike * sizes - 1e-6, "left")
    for one in range(len(sets)):
        others = np.arange(lowest[one], one)
        others = others[root[others] != root[one]]
        if across:
            others = others[blocks[others] != blocks[one]]
        others = others[sizes[others] > 0]
        if not len(others) or not sizes[one]:
            continue
        mine = ids[starts[one] : ends[one]]
        mark[mine] = True
        counted = np.concatenate(([0], np.cumsum(mark[ids[starts[others[0]] : ends[others[-1]]]])))
        begin = starts[others[0]]
        both = counted[ends[others] - begin] - counted[starts[others] - begin]
        mark[mine] = False
        hits = others[both >= alike * (sizes[others] + sizes[one] - both) - 1e-6]
        if len(hits):
            joined = np.unique(root[np.append(hits, one)])
            root[np.isin(root, joined)] = joined[0]
    linked = np.flatnonzero(root != np.arange(len(root)))
    return order[linked], order[root[linked]]


def confirmed(texts: DataFrame, groups: DataFrame, rule: Rule) -> DataFrame:
    """Edges ``a``, ``b`` between contents of one ``label`` (``groups``: ``content``, ``label``)
    whose components are those of all pairs there of a Jaccard similarity of ``rule.alike``.

    A label's texts are dealt to blocks of some ``BLOCK_BYTES`` of hashes, and each pair of blocks
    meets in one group, so a large label's blocks travel as often as it has blocks.
    """
    texts = texts.join(groups, "content").groupBy("content").agg(
        F.first("label").alias("label"), F.first("shingles").alias("shingles")
    )
    texts = hold(texts, "shingles")
    weight = texts.groupBy("label").agg(F.sum(F.length("shingles") + 64).alias("weight"))
    weight = hold(weight.select("label", F.ceil(F.col("weight") / BLOCK_BYTES).alias("blocks")), "shingles")
    dealt = texts.join(weight, "label").withColumn("block", F.pmod(F.xxhash64("content"), F.col("blocks")))
    meets = F.explode(F.expr("transform(sequence(0L, blocks - 1), k -> struct(least(k, block) as i, greatest(k, block) as j))"))
    dealt = dealt.withColumn("meets", meets).select("label", "meets.i", "meets.j", "block", "content", "shingles")

    def join(table: pa.Table) -> pa.Table:
        blocks = table.column("block").to_numpy()
        if table.column("i")[0] != table.column("j")[0] and len(np.unique(blocks)) < 2:
            return pa.table([pa.array([], pa.binary())] * 2, schema=_EDGE)
        sets = [np.frombuffer(cell.as_buffer() or b"", "<u8") for cell in table.column("shingles")]
        names = table.column("content")
        a, b = alike_forest(sets, blocks, rule.alike)
        return pa.table([names.take(pa.array(side)).cast(pa.binary()).combine_chunks() for side in (a, b)], schema=_EDGE)

    return dealt.groupBy("label", "i", "j").applyInArrow(join, "a binary, b binary")


def near_copies(docs: DataFrame, rule: Rule = SIMILAR) -> DataFrame:
    """``doc_id``, ``fingerprint`` (hex digits) and ``component_id``: the smallest ``doc_id`` that
    can be reached over fingerprints that meet the rule and, if it compares texts, over texts among
    them of a Jaccard similarity of ``rule.alike``.

    Documents of one fingerprint (if the rule compares texts, of one set of shingles) are one node.
    Texts without words share fingerprint zero and are linked like any other. Rows with a null
    ``doc_id`` take part (a component of only such rows has a null id); repeated rows are listed
    each; an empty table gives no rows.
    """
    prints = hold(fingerprints(docs, rule), "prints")
    key = "content" if rule.alike else "print"
    nodes = prints.groupBy(*dict.fromkeys((key, "print"))).agg(F.min("doc_id").alias("least"))
    nodes = hold(nodes, "prints")
    label = contract(links(nodes.select("print").distinct() if rule.alike else nodes, rule))
    label = label.withColumnRenamed("node", "print")
    classes = nodes.join(label, "print", "left").withColumn("label", F.coalesce("label", "print"))
    if rule.alike:
        classes = hold(classes, "labels")
        several = classes.groupBy("label").count().filter("count > 1").select("label")
        groups = hold(classes.join(several, "label").select("content", "label"), "labels")
        label = contract(confirmed(prints.select("content", "shingles"), groups, rule)).withColumnRenamed("node", "content")
        classes = nodes.join(label, "content", "left").withColumn("label", F.coalesce("label", "content"))
    least = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = classes.join(least, "label").select(key, "component_id")
    return prints.drop("shingles").join(classes, key).select(
        "doc_id", F.lower(F.hex(F.substring("print", 1, rule.size))).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, rule: Rule = SIMILAR) -> DataFrame:
    """The rows of one document of each group, the one whose ``doc_id`` is the component's.

    Rows without a ``doc_id`` can't be told apart and stay. Rows that share a ``doc_id`` stay or go
    together; they stay if one of them stays.
    """
    copies = near_copies(docs, rule).groupBy("doc_id")
    gone = copies.agg(F.expr("bool_and(doc_id != component_id)").alias("gone")).filter("gone")
    return docs.join(gone, "doc_id", "left_anti").select(*every_column(docs))
