"""Periodic runs against every period tried on every text."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from sensorlens.llm import periods, queries
from tests.llm.test_operators import LONG, ODD, docs, empty, odd, texts  # noqa: F401


def runs_by_trying(words, least=6, turns=4):
    """Every maximal stretch of each period, without those that a smaller period explains."""
    found = {}
    for q in range(1, len(words) // turns + 1):
        same = [a == b for a, b in zip(words, words[q:])] + [False]
        start = None
        for place, equal in enumerate(same):
            if equal and start is None:
                start = place
            elif not equal and start is not None:
                length = place - start + q
                if length >= max(least, turns * q):
                    found.setdefault((start, length), q)
                start = None
    return sorted((s, n, q) for (s, n), q in found.items())


def digest_by_trying(doc_id, text):
    words = (text or "").encode().split()
    code = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if code is not None and code % 10 == 0 and words:
        g, n = code // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted(runs_by_trying(words), key=lambda r: (r[0], r[2]))
    cut = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    rest = b" ".join(w for i, w in enumerate(words) if i not in cut)
    return (
        doc_id, len(words), len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(rest).hexdigest(),
    )


def test_runs_of_random_sequences():
    draw = random.Random(5)
    seen = 0
    for _ in range(3000):
        n, letters = draw.randint(0, 60), draw.choice([1, 2, 2, 3, 5])
        words = [draw.randrange(letters) for _ in range(n)]
        if n and draw.random() < 0.5:
            a, p = draw.randrange(n), draw.randint(1, 12)
            words = [words[i] if i < a else words[min(n - 1, a + (i - a) % p)] for i in range(n)]
        want = runs_by_trying(words)
        seen += len(want)
        assert periods.runs_of(np.array(words, np.int64)) == sorted(want, key=lambda r: (r[0], r[2]))
    assert seen > 1000
    with pytest.raises(ValueError):
        periods.Rule(periods=3)


def test_query_matches_brute_force(spark, small, texts):  # noqa: F811
    got = {r.doc_id: tuple(r) for r in queries.QUERIES["op13_periodic_runs"](spark, small).collect()}
    short = {k: t for k, t in texts.items() if len((t or "").split()) <= 3000}
    assert len(got) == len(texts) and len(short) > 150
    assert sum(got[k][2] for k in short) > 5
    for k, t in short.items():
        assert got[k] == digest_by_trying(k, t)


def test_hard_rows(odd, empty, spark):  # noqa: F811
    found = periods.collapse(odd)
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = {r.doc_id: r for r in found.filter("doc_id is not null").collect()}
    assert found.count() == len(ODD) and found.filter("runs is null or collapsed is null").isEmpty()
    assert [tuple(r) for r in got[4].runs] == [(0, len(LONG.split()), 2)] and got[4].collapsed == "word another"
    assert got[1].n_words == 0 and got[1].collapsed == "" and got[5].collapsed == "Same TEXT here"
    digests = {r.doc_id: tuple(r) for r in periods.digests(periods.collapse(odd, change=periods.planted)).collect()}
    for doc_id, text, *_ in ODD:
        if doc_id not in (None, 4):
            assert digests[doc_id] == digest_by_trying(doc_id, text)
    assert periods.digests(periods.collapse(empty)).count() == 0
