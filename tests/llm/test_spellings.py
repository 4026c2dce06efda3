"""Spelling variants against comparing every two words, place by place."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from sensorlens.llm import queries, spellings
from tests.llm.test_operators import docs, empty, folded, odd, texts  # noqa: F401


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def words_by_reading(items, slips=199, least=6, count=5):
    total = Counter()
    for doc_id, text in items:
        for run in re.findall("[A-Za-zÀ-ÿ]+", folded(text)):
            code = zlib.crc32(f"{doc_id}:{run}".encode())
            if slips and code % slips == 0:
                run = run[: code % len(run)] + run[code % len(run) + 1 :]
            if len(run) >= least:
                total[run] += 1
    return {word: n for word, n in total.items() if n >= count}


def variants_by_comparing(counts, times=5):
    words = sorted(counts)
    near = {word: [] for word in words}
    by_length = {}
    for word in words:
        by_length.setdefault(len(word), []).append(word)
    for length, some in by_length.items():
        for k, a in enumerate(some):
            for b in some[k + 1 :] + by_length.get(length + 1, []):
                if one_edit(a, b):
                    near[a].append(b)
                    near[b].append(a)
    form = {}
    for word in words:
        best = min(near[word], key=lambda w: (-counts[w], w), default=None)
        form[word] = best if best is not None and counts[best] >= times * counts[word] else None
    rows = []
    for word in words:
        root = word
        while form[root] is not None:
            root = form[root]
        rows.append((word, form[word], root, counts[word], len(near[word]), counts.get(form[word])))
    return rows


def test_query_matches_brute_force(spark, small, texts):  # noqa: F811
    got = sorted(map(tuple, queries.QUERIES["op12_spelling_variants"](spark, small).collect()))
    want = variants_by_comparing(words_by_reading(texts.items()))
    assert len(want) > 500 and sum(r[1] is not None for r in want) > 0
    assert got == want


def made_up(seed):
    """Words of few letters, many of them near, some very long, with counts of many sizes."""
    draw = random.Random(seed)
    words = {"".join(draw.choices("abÿ", k=draw.randint(6, 8))) for _ in range(300)}
    for long in ("x" * 70, "".join(draw.choices("abcé", k=131)), "z" * 64, "".join(draw.choices("ab", k=3000))):
        for _ in range(6):
            at = draw.randrange(len(long))
            words |= {long, long[:at] + "q" + long[at:], long[:at] + long[at + 1 :], long[:at] + "r" + long[at + 1 :]}
    return {word: draw.choice([5, 6, 25, 26, 125, 700, 5000]) for word in words}


def test_near_words_of_any_length(spark, monkeypatch):
    counts = made_up(2)
    want = {(a, b) for a in counts for b in counts if one_edit(a, b)}
    named = {spellings.reference(word): word for word in counts}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    for group, part in ((40_000, 20_000), (50, 7)):  # also with keys dealt to parts
        monkeypatch.setattr(spellings, "GROUP", group)
        monkeypatch.setattr(spellings, "PART", part)
        got = spellings.neighbours(words, 6).collect()
        assert {(named[r.ref], named[r.near]) for r in got} == want
        assert all(r.near_n == counts[named[r.near]] for r in got)


def test_variants_of_made_up_words(spark):
    counts = {word: min(n, 130) for word, n in made_up(3).items()}
    rows = [(k, word) for word, n in counts.items() for k in range(n)]
    table = spark.createDataFrame([(1, " ".join(word for _, word in rows))], "doc_id long, text string")
    got = sorted(map(tuple, spellings.variants(table).collect()))
    assert got == variants_by_comparing(counts)
    assert any(r[2] != r[1] for r in got if r[1])  # forms of forms


def test_hard_rows(odd, empty):  # noqa: F811
    many = odd.withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.lit(" Resumé resumés résumé resumé! 9naïveté9")))
    counts = words_by_reading([(r.doc_id, r.text) for r in many.collect()], slips=0)
    assert sorted(map(tuple, spellings.variants(many).collect())) == variants_by_comparing(counts)
    assert spellings.variants(empty).count() == 0 and spellings.variants(odd.filter("text is null")).count() == 0
