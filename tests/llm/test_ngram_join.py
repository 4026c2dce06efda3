"""The Jaccard join of n-gram sets against comparing every two sets."""

import random

import numpy as np

from pyspark.sql import functions as F

from sensorlens.llm import ngram_join, queries
from sensorlens.llm.ngram_join import Rule
from tests.llm.test_operators import ODD, docs, empty, odd, texts  # noqa: F401

RULE = Rule(words=3, share=90)


def grams(text, words=3):
    parts = (text or "").encode().lower().split()
    if len(parts) < words:
        return frozenset([tuple(parts)]) if parts else frozenset()
    return frozenset(zip(*(parts[k:] for k in range(words))))


def teams_by_comparing(sets, rule):
    """The least position that can be reached from each set over links."""
    root = list(range(len(sets)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    order = sorted((k for k in range(len(sets)) if sets[k]), key=lambda k: len(sets[k]))
    for at, k in enumerate(order):
        for other in order[at + 1 :]:
            if rule.of * len(sets[k]) < rule.share * len(sets[other]):
                break
            both = len(sets[k] & sets[other])
            if rule.of * both >= rule.share * (len(sets[k]) + len(sets[other]) - both):
                a, b = sorted((top(k), top(other)))
                root[b] = a
    return [top(k) for k in range(len(sets))]


def components_by_comparing(items, rule):
    items = sorted(items, key=lambda item: (item[0] is None, item[0] or 0))
    teams = teams_by_comparing([grams(text, rule.words) for _, text in items], rule)
    return sorted(((d, len(grams(t, rule.words)), items[team][0]) for (d, t), team in zip(items, teams)), key=str)


def varied(draw, base, edits):
    words = list(base)
    for _ in range(edits):
        at = draw.randrange(len(words) + 1)
        kind = draw.randrange(3)
        if kind == 0:
            words.insert(at, f"new{draw.random()}")
        elif words and kind == 1:
            words.pop(min(at, len(words) - 1))
        elif words:
            words[min(at, len(words) - 1)] = draw.choice(["alpha", "beta", f"w{draw.random()}"])
    return words


def planted(seed, families=25):
    """Texts of many lengths with near copies around the limit, chains of them, and shared parts."""
    draw = random.Random(seed)
    shared = [f"common{k}" for k in range(60)]
    items = []
    for _ in range(families):
        base = [f"w{draw.randrange(500)}" for _ in range(draw.choice([1, 2, 3, 5, 8, 12, 30, 31, 60, 150, 400]))]
        if draw.random() < 0.4:
            base += shared
        for _ in range(draw.randint(1, 7)):
            edits = draw.choice([0, 0, 1, 1, 2, len(base) // 60, len(base) // 30])
            base = varied(draw, base, edits) if draw.random() < 0.5 else base
            items.append((len(items), " ".join(varied(draw, base, edits))))
    return items


def test_sets_that_differ_as_much_as_they_may_share_a_mark():
    draw = np.random.default_rng(4)
    for rule in (RULE, Rule(5, 80)):
        for n in [*range(1, 60), 100, 333, 1000, 5000]:
            for _ in range(3):
                mine = np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64))
                more = 0  # elements replaced, so that the sets are just linked
                while rule.linked(n - more - 1, 2 * n):
                    more += 1
                other = np.unique(np.append(mine[more:], draw.integers(0, 1 << 63, more, dtype=np.uint64)))
                fewer = mine[: max(rule.partners(n)[0], 1)]
                marks = set(ngram_join.marks_of(mine, rule).tolist())
                for partner in (other, fewer):
                    both = len(np.intersect1d(mine, partner))
                    if rule.linked(both, len(mine) + len(partner)):
                        assert marks & set(ngram_join.marks_of(partner, rule).tolist())


def test_tree_search_matches_comparing():
    for seed in range(12):
        draw = random.Random(seed)
        items = planted(seed, 12)
        sets = [grams(text) for _, text in items if grams(text)]
        rule = (RULE, Rule(3, 80), Rule(3, 60))[seed % 3]
        labels = np.array([draw.randrange(1 + seed % 4) for _ in sets])
        hashed = [np.unique(np.array([hash(g) for g in s], np.int64).view(np.uint64)) for s in sets]
        team = ngram_join.linked_sets(hashed, labels, np.ones(len(sets), bool), rule)
        by_label = {}
        for lab in set(labels.tolist()):
            places = np.flatnonzero(labels == lab).tolist()
            for k, t in zip(places, teams_by_comparing([sets[p] for p in places], rule)):
                by_label[k] = places[t]
        same = {}
        for k in range(len(sets)):
            assert same.setdefault(int(team[k]), by_label[k]) == by_label[k]
        assert len(same) == len(set(by_label.values()))


def test_planted_copies(spark, monkeypatch):
    items = planted(1, 60)
    items += [(len(items) + k, items[3][1]) for k in range(300)]  # one text makes up half of the rows
    random.Random(2).shuffle(items)
    table = spark.createDataFrame(items, "doc_id long, text string")
    for rule in (RULE, Rule(5, 80)):
        want = components_by_comparing(items, rule)
        assert len({row[2] for row in want}) < len({text for _, text in items})
        for group in (16 << 20, 4000):  # also with classes dealt to parts
            monkeypatch.setattr(ngram_join, "GROUP_BYTES", group)
            got = sorted(map(tuple, ngram_join.near_sets(table, rule).collect()), key=str)
            assert got == want


def test_query_matches_brute_force(spark, small, texts):  # noqa: F811
    got = sorted(map(tuple, queries.QUERIES["op11_prefix_trees"](spark, small).collect()), key=str)
    assert got == components_by_comparing(list(texts.items()), RULE)


def test_hard_rows(odd, empty):  # noqa: F811
    got = sorted(map(tuple, ngram_join.near_sets(odd, RULE).collect()), key=str)
    assert got == components_by_comparing([row[:2] for row in ODD], RULE)
    assert ngram_join.near_sets(empty, RULE).count() == 0
    negative = odd.filter("doc_id > 4").withColumn("doc_id", F.col("doc_id") - 6)
    assert {(r.doc_id, r.component_id) for r in ngram_join.near_sets(negative, RULE).collect()} == {(-1, -1), (0, -1), (1, 1), (2, 2)}
