"""The training-data operators against brute force, round trips and hard cases."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sensorlens.llm import (
    ann, bpe, chat, exact_dedup, langid, licences, packing, quality, queries, simhash, token_files, tokens, wavelet,
)
from sensorlens.session import scratch_dir

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word another " * 30_000
# Nulls, empty, tiny and very long texts, ties, repeated rows.
ODD = [
    (1, None, None, None, None), (2, "", "en", "s", 0), (3, "a", "en", "s", 1), (4, LONG, "en", "s", 1),
    (5, "Same TEXT here", "en", "s", 1), (6, "same text here", None, "s", 1), (6, "same text here", None, "s", 1),
    (None, "no id at all", "en", "s", 1), (None, None, None, None, None), (7, "42 !!", "de", "s", 1),
    (8, "中文 ñandú \x1c\x85 <|endoftext|> 'll", "zz", "s", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    """With further columns, named like the ones operators use inside."""
    table = spark.createDataFrame(ODD, DOCS)
    names = ("digest", "print", "count", "n", "k", "d", "row", "id", "part", "ids", "turn", "gone", "best", "x")
    return table.withColumns({name: F.lit(name) for name in names})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {row.doc_id: row.text for row in docs.collect()}


def folded(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# 1. Nearest neighbours


def test_nearest_neighbours_match_brute_force(spark):
    draw = np.random.default_rng(3)
    vectors = {k: draw.normal(size=16).astype(np.float32).tolist() for k in range(1200)}
    for k in range(300, 700):  # a third are one vector
        vectors[k] = vectors[300]
    rows = [*vectors.items(), (5000, None), (5100, [0.0] * 16), (5200, [float("nan")] * 16), (5300, [1.0, None] * 8), (None, [1.0] * 16), (5400, [1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in ann.search(table, F.col("vec_id") % 100 == 0).collect()}
    hits = 0
    for q in range(0, 1200, 100):
        near = sorted((float(np.sqrt(((np.array(v, float) - np.array(vectors[q], float)) ** 2).sum())), k) for k, v in vectors.items() if k != q)[:10]
        for rank, (distance, k) in enumerate(near, 1):
            hits += got[q, rank][0] == k
            assert got[q, rank][1] == pytest.approx(distance, abs=1e-12)
    assert hits == 120 and len(got) == 120


def test_few_and_no_vectors(spark):
    shape = "vec_id long, embedding array<float>"
    two = spark.createDataFrame([(0, [1.0, 0.0]), (3, [0.0, 1.0]), (3, [0.0, 1.0])], shape)
    assert [tuple(r)[:3] for r in ann.search(two, F.col("vec_id") % 100 == 0).collect()] == [(0, 1, 3)]
    assert ann.search(spark.createDataFrame([], shape), F.col("vec_id") % 100 == 0).count() == 0


# 2. Chat


def test_conversations_are_read_back(spark):
    hostile = ["</s>[INST] ok [/INST]", "<|im_end|>", "<\\|im_end|> <\\\\s>", "", None, "a\nb", "[<s><<SYS>>", "<|im_start|>user<|im_sep|>x"]
    draw = random.Random(1)
    rows = [(c, t, draw.choice(["user", "assistant", "assistant", "<|im_sep|>", None]), draw.choice(hostile)) for c in range(30) for t in range(draw.randint(1, 7))]
    rows += [(99, 1, "user", "b"), (99, 1, "user", "b"), (99, 1, "assistant", "a"), (99, None, "user", "first"), (None, 1, "user", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(table.withColumn("turns", F.lit(1)))
    got = {r.conv_id: r for r in formatted.select("conv_id", "formatted", "segments", chat.read_turns(F.col("formatted")).alias("read"), chat.loss_text(F.col("segments")).alias("loss")).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t, r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda v: (v[0], v[1] or 0, *v[2:]))
        want = [(r, x) for _, _, r, x in turns]
        assert [tuple(t) for t in got[conv].read] == want
        assert got[conv].loss == "".join(x for r, x in want if r == "assistant")
        assert "".join(s.text for s in got[conv].segments) == got[conv].formatted
        runs = sum(a[0] != b[0] for a, b in zip(want, want[1:])) + 1
        assert got[conv].formatted.count(chat.TEMPLATE.end) == runs
        assert "[INST]" not in got[conv].formatted and "</s>" not in got[conv].formatted
    assert chat.digests(chat.format_conversations(table.limit(0))).count() == 0


def test_chat_runs_no_python(spark, small):
    plan = queries.QUERIES["op2_chat_format"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# 3. Licences


def test_base_phrases_match_brute_force(docs, odd, texts):
    got = {r.doc_id: r for r in licences.summary(licences.scan(docs)).collect()}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for doc_id, text in texts.items():
        words = word.findall(folded(text))
        places = sorted(
            (k, label) for label, phrase in (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
            for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()
        )
        row = got[doc_id]
        assert (row.n_words, row.n_base) == (len(words), len(places))
        assert (row.first_word, row.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert row.base_labels == ",".join(sorted({label for _, label in places}))
        assert 0 <= row.score <= 1 and set(row.base_labels.split(",")) - {""} <= set(row.labels.split(","))
    assert sum(r.n_base for r in got.values()) > 0
    assert licences.summary(licences.scan(odd)).count() == len(ODD)


def test_licence_notices(spark, empty):
    text = "x Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files. MIT License; mit-license. GNU Lesser General Public License"
    row = licences.summary(licences.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    assert (row.n_base, row.base_labels, row.labels, row.score) == (3, "gpl,mit", "gpl,lgpl,mit", 1.0)
    assert licences.scan(empty).count() == 0


# 4. Exact copies


@pytest.mark.parametrize("frequent", [2, 256])
def test_copies_match_brute_force(spark, frequent):
    rows = [(k, "Hot" if k % 3 == 0 else f"text {k // 4}") for k in range(400)] + [(None, "hot"), (None, None), (3, "HOT"), (3, "HOT")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(folded(text), []).append(doc_id)
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.verdicts(table, frequent).collect()), key=str)
    want = []
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep) for i in ids]
    assert got == sorted(want, key=str)
    assert exact_dedup.drop_copies(table, frequent).count() == len(groups)


def test_copies_of_odd_rows(odd, empty):
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(kept.select("doc_id").collect(), key=str) == sorted([(2,), (3,), (4,), (6,), (None,), (7,), (8,)], key=str)
    assert exact_dedup.verdicts(empty).count() == exact_dedup.drop_copies(empty).count() == 0


def test_summaries_keep_frequent_values():
    draw = random.Random(2)
    values = [draw.choice("abc") if draw.random() < 0.5 else str(draw.random()) for _ in range(5000)]
    found = exact_dedup.summary([values[k : k + 100] for k in range(0, 5000, 100)], 20)
    assert len(found) <= 20 and all(values.count(v) - 5000 / 21 <= found.get(v, 0) <= values.count(v) for v in "abc")


# 5. Language


def test_languages_of_held_out_documents(spark, small):
    lang = dict(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang").collect())
    rows = [r for r in queries.QUERIES["op5_language_id"](spark, small).collect() if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in rows) >= 0.97 * len(rows)


def test_language_of_odd_texts(docs, odd, empty):
    model = langid.learn(docs)
    got = {r.doc_id: r for r in langid.identify(odd, model).collect()}
    assert {k for k in got if got[k].lang_pred == "und"} >= {1, 2, 7} and got[3].lang_pred != "und"
    assert all(0 <= r.score <= 1 for r in got.values()) and got[1].rejected and got[2].rejected and not got[3].rejected
    assert langid.learn(empty) is None and langid.identify(empty, model).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, None).collect()} == {"und"}
    assert langid.keep_known(docs, model).count() == docs.count()
    kept = langid.keep_known(odd, model)
    assert kept.columns == odd.columns and {1, 2, 7}.isdisjoint(r.doc_id for r in kept.collect())


def test_probabilities_add_up():
    """Over all that may follow a start, the model's probabilities sum to one."""
    words = {"abba": 3, "ab": 2, "cab": 1, "bac": 1}
    model = langid.KneserNey(words, alphabet=4)  # a, b, c and the end

    def next_log(start, symbol):
        symbols = langid.Symbols([start + symbol if symbol else start, start + "a"])
        symbols.depth = symbols.depth.copy()
        total, at = 0.0, len(start) + 1
        for n in range(langid.ORDER, 0, -1):
            if symbols.depth[at] < n - 1:
                continue
            keys, values = model.grams[n]
            place, found = langid._find(keys, symbols.hashes[n][at : at + 1])
            if found[0]:
                return total + values[place[0]]
            heads, weights = model.contexts[n]
            place, found = langid._find(heads, symbols.hashes[n - 1][at - 1 : at] if n > 1 else np.zeros(1, np.uint64))
            total += weights[place[0]] if found[0] else 0.0
        return total + model.unseen

    for start in ("", "a", "ab", "abb", "ca", "bb", "cc"):
        assert sum(np.exp(next_log(start, s)) for s in ("a", "b", "c", "")) == pytest.approx(1, abs=1e-5)
    # The score of a word is the sum over its symbols and its end.
    whole = sum(next_log("cab"[:k], "cab"[k : k + 1]) for k in range(4))
    assert model.score(langid.Symbols(["cab"]))[0] == pytest.approx(whole, abs=1e-5)


def test_all_texts_are_counted(spark, docs, monkeypatch):
    """N-grams over all documents of a language, in parts, are those of its words counted at once."""
    monkeypatch.setattr(langid, "WORDS_HELD", 50)
    monkeypatch.setattr(langid, "WORDS_AT_ONCE", 70)
    got = langid._gram_counts(langid._word_counts(docs.filter("lang is not null"))).collect()
    found = {}
    for row in got:
        found.setdefault(row.lang, set()).add(tuple(row)[1:])
    words = {}
    for row in docs.filter("lang is not null").collect():
        words.setdefault(row.lang, []).extend(langid.words_of(row.text))
    assert found.keys() == words.keys()
    for lang, every in words.items():
        counts = {word: n for word, n in Counter(every).items() if langid.has_letter([word])}
        want = langid.gram_counts(counts).to_pydict()
        rows = {(n, key): (inner, seen) for n, key, inner, seen in zip(*(want[c] for c in ("n", "key", "inner", "seen")))}
        assert {(n, key): (inner, seen) for n, key, _, _, inner, seen in found[lang]} == rows


def test_many_ngrams_keep_their_own_counts():
    """A model of more n-grams than short keys tell apart scores as one with exact string keys."""
    draw = random.Random(8)
    letters = "".join(map(chr, range(0x4E00, 0x4E00 + 300)))
    counts = Counter("".join(draw.choice(letters) for _ in range(6)) for _ in range(60_000))
    model = langid.KneserNey(counts, alphabet=301)
    seen, before, inner = {}, {}, set()
    for word, k in counts.items():
        marked = f"\x01{word}\x02"
        for n in range(1, langid.ORDER + 1):
            for at in range(max(0, 2 - n), len(marked) - n + 1):
                gram = marked[at : at + n]
                seen[gram] = seen.get(gram, 0) + k
                if at:
                    before.setdefault(gram, set()).add(marked[at - 1])
                    inner.add(gram)
    assert [len(model.grams[n][0]) for n in range(1, 6)] == [sum(len(g) == n for g in seen) for n in range(1, 6)]
    logs, heads = {"": 1 / 301}, {}
    for n in range(1, langid.ORDER + 1):
        count = {g: len(before[g]) if n < langid.ORDER and g in inner else c for g, c in seen.items() if len(g) == n}
        once, twice = (sum(c == k for c in count.values()) for k in (1, 2))
        discount = once / (once + 2 * twice) if once and twice else 0.5
        total, kinds = Counter(), Counter()
        for g, c in count.items():
            total[g[:-1]] += c
            kinds[g[:-1]] += 1
        heads |= {g: discount * kinds[g] / total[g] for g in total}
        logs |= {g: (c - discount) / total[g[:-1]] + heads[g[:-1]] * logs[g[1:]] for g, c in count.items()}

    def score(word):
        marked, found = f"\x01{word}\x02", 0.0
        for at in range(1, len(marked)):
            for n in range(min(langid.ORDER, at + 1), -1, -1):
                gram = marked[at - n + 1 : at + 1] if n else ""
                if gram in logs:
                    found += np.log(logs[gram])
                    break
                found += np.log(heads.get(gram[:-1], 1.0))
        return found

    words = [*list(counts)[:200], *("".join(draw.choice(letters) for _ in range(6)) for _ in range(200))]
    assert model.score(langid.Symbols(words)) == pytest.approx([score(w) for w in words], abs=1e-4)


def test_all_held_out_texts_calibrate(spark):
    draw = random.Random(9)
    vocabulary = {"aa": ["".join(draw.choice("abcdefg") for _ in range(4)) for _ in range(80)], "zz": ["".join(draw.choice("tuvwxyz") for _ in range(4)) for _ in range(80)]}
    rows = [(k, " ".join(draw.choices(vocabulary[lang], k=12)), lang) for k in range(2500) for lang in [("aa", "zz")[k % 2]]]
    table = spark.createDataFrame([*rows, (9000, "lonely words", "one")], "doc_id long, text string, lang string")
    model = langid.learn(table)
    assert model.languages == ["aa", "one", "zz"]
    uniform = -model.models[0].unseen
    held = langid.entropies(table.filter(langid.calibrates()).filter("lang != 'one'"), model).select("doc_id", "entropies").collect()
    for k, parity in ((0, 0), (2, 1)):
        own = sorted(r.entropies[k] for r in held if r.doc_id % 2 == parity)
        assert len(own) > 100
        assert model.limits[k] == pytest.approx((own[int(np.ceil(0.999 * len(own))) - 1] + uniform) / 2)
    assert model.limits[1] == pytest.approx(uniform)


# 6. Token files


def library(name):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_token_files_round_trip(spark, which, request, monkeypatch):
    table = request.getfixturevalue(which)
    monkeypatch.setattr(token_files, "SHARD_TOKENS", 5000)
    path = scratch_dir(spark, "test")
    token_files.write(table, path, queries.WORD_BPE, 2)
    encode, at = library("word_bpe_49k.json"), 0
    rows = sorted(((r.doc_id is not None, r.doc_id, r.text is not None, r.text) for r in table.collect()), key=lambda r: (r[0], r[1] or 0, r[2], r[3] or ""))
    got = sorted(token_files.read(spark, path).collect(), key=lambda r: r.start)
    every = []
    for (_, doc_id, _, text), row in zip(rows, got, strict=True):
        ids = encode(text) + [2]
        assert (row.doc_id, row.start, row.n_tokens) == (doc_id, at, len(ids))
        assert np.frombuffer(row.ids, "<u4").tolist() == ids
        at, every = at + len(ids), every + ids
    token = every[len(every) // 2]
    assert token_files.count(spark, path, token) == every.count(token)
    assert sorted(r.place for r in token_files.occurrences(spark, path, token).collect()) == [k for k, t in enumerate(every) if t == token]


def test_words_encoded_together(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_PIECES", 40)
    monkeypatch.setattr(tokens, "WORDS_AT_ONCE", 7)
    tokenizer = tokens._tokenizer(queries.WORD_BPE)
    words, rnd = tokens.Words(tokenizer), random.Random(5)
    signs = "abABIΣσİ'́\x01\x1c\x85 \n<|>é中5,.!힣\U0001f600"
    texts = [None, "", "\x01", "a \x01 b", "\x01\x01 x", "long" * 500 + " Y", "</w> <|endoftext|>", "It's É é"]
    texts += ["".join(rnd.choices(signs, k=rnd.randint(0, 40))) for _ in range(400)]
    want = [np.asarray(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    for at in range(0, len(texts), 50):
        assert words.texts(texts[at : at + 50]) == want[at : at + 50]
    assert words.texts([]) == []


def test_token_files_of_no_documents(spark, empty):
    path = scratch_dir(spark, "test")
    token_files.write(empty, path, queries.WORD_BPE, 2)
    assert token_files.read(spark, path).count() == token_files.count(spark, path, 2) == 0


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 3000])
def test_wavelet(n):
    tokens = np.random.default_rng(n).integers(0, 60, n).astype(np.uint32)
    matrix = wavelet.Wavelet(n, *wavelet.build(tokens, 6))
    assert matrix.tokens().tolist() == tokens.tolist()
    assert all(matrix.access(k) == tokens[k] for k in range(0, n, 41))
    for token in (0, 7, 59, 63, 200):
        assert matrix.occurrences(token) == np.flatnonzero(tokens == token).tolist()
        assert matrix.count(token) == (tokens == token).sum()


def test_ids_of_more_than_16_bits(spark):
    path = scratch_dir(spark, "test")
    token_files.write(spark.createDataFrame([(1, "a word")], "doc_id long, text string"), path, queries.WORD_BPE, 70_000)
    assert np.frombuffer(token_files.read(spark, path).first().ids, "<u4")[-1] == 70_000
    assert token_files.bits_of(queries.WORD_BPE, 2) == 16
    with pytest.raises(ValueError):
        wavelet.build(np.array([1, 1 << 16], np.uint32), 16)


# 7. Quality


def test_quality_of_held_out_documents(spark, small):
    larger = small.replace("sf0.001", "sf0.01")  # the smallest tables have too few labels
    label = dict(spark.read.parquet(f"{larger}/labels.parquet").select("doc_id", "quality").collect())
    got = queries.QUERIES["op7_quality"](spark, larger).collect()
    held = [r for r in got if r.held_out and r.doc_id in label]
    assert held and sum(r.predicted == label[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_quality_of_odd_texts(spark, odd, empty):
    shape = "doc_id long, quality int"
    labels = spark.createDataFrame([(3, 1), (4, 0), (5, 1), (6, None), (None, 1), (8, 0), (8, 0), (2, 7)], shape)
    model = quality.learn(odd, labels)
    assert all(0 <= r.score <= 1 for r in quality.score(odd, model).collect())
    assert quality.score(empty, model).count() == 0
    assert quality.keep_good(odd, model).columns == odd.columns
    none = quality.learn(odd, spark.createDataFrame([], shape))
    assert {r.score for r in quality.score(odd, none).collect()} == {0.5}
    assert quality.score(empty, quality.learn(empty, labels)).count() == 0


def test_contexts_add_up_over_all_documents(docs, monkeypatch):
    """However many tasks there are, the table is that of all neighbours of all documents."""
    monkeypatch.setattr(quality, "FAN_IN", 2)
    got = quality.context_vectors(docs.repartition(7))
    places, signs = quality._index()
    want = np.zeros_like(got)
    for row in docs.collect():
        tokens = quality.buckets_of(row.text)
        for gap in range(1, quality.WINDOW + 1):
            for word, near in ((tokens[:-gap], tokens[gap:]), (tokens[gap:], tokens[:-gap])):
                np.add.at(want, (word[:, None], places[near]), signs[near])
    assert (got == want).all() and want.any()


# 8. Packing


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_packing_round_trip(which, request):
    table = request.getfixturevalue(which)
    pieces = packing.pack(table, queries.BYTE_BPE)
    encode = library("byte_bpe_50k.json")
    rows = sorted(pieces.collect(), key=lambda r: (r.sequence_id, r.offset))
    found, at, held = [], 0, b""
    for row in rows:
        assert row.sequence_id * 1024 + row.offset == at and row.offset + row.length <= 1024
        assert row.length * 4 == len(row.ids) and row.start * 4 == len(held)
        at, held = at + row.length, held + row.ids
        if len(held) == row.doc_tokens * 4:
            found.append((row.doc_id, held))
            held = b""
    want = [(r.doc_id, np.array([*encode(r.text), 0], "<u4").tobytes()) for r in table.collect()]
    assert not held and sorted(found, key=str) == sorted(want, key=str)
    whole = {r.sequence_id: len(r.ids) // 4 for r in packing.sequences(pieces).collect()}
    assert sorted(whole) == list(range(len(whole))) and set(list(whole[k] for k in sorted(whole))[:-1]) <= {1024}


def test_packing_nothing(empty):
    assert packing.pack(empty, queries.BYTE_BPE).count() == 0


# 9. Byte-level BPE


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(queries.MULTI_RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=queries.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_bpe_matches_the_library(which, request, reference):
    table = request.getfixturevalue(which)
    got = bpe.decode(bpe.encode(table, queries.MULTI_RANKS, queries.PATTERN), queries.MULTI_RANKS)
    found = sorted(((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in got.collect()), key=str)
    want = []
    for row in table.select("doc_id", "text").collect():
        ids = reference.encode_ordinary(row.text or "")
        want.append((row.doc_id, len(ids), np.array(ids, "<u4").tobytes(), (row.text or "").encode()))
    assert found == sorted(want, key=str)


def test_merges_of_random_words(reference):
    draw = random.Random(5)
    corpus = bpe.Corpus(queries.MULTI_RANKS, queries.PATTERN)
    words = ["".join(draw.choice("aaabthe ionsé1!\n") for _ in range(draw.randint(0, 30))) for _ in range(3000)] + ["a" * 4000, "ab" * 999]
    assert [np.frombuffer(i, "<u4").tolist() for i in corpus.encode(words)] == [reference.encode_ordinary(w) for w in words]


def test_a_lower_rank_made_by_a_merge_goes_first():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 300, b"ab": 301, b"abd": 302, b"cab": 299}
    words = [b"abcab", b"ababc", b"cabab", b"abcabcabd", b"cabcab"]

    def plain(word):
        parts = [word[k : k + 1] for k in range(len(word))]
        while word not in ranks:
            best = min(((ranks.get(a + b, 999), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))), default=(999, 0))
            if best[0] == 999:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return [ranks[p] for p in parts] if word not in ranks else [ranks[word]]

    want = [plain(w) for w in words]
    assert bpe.replay(words, ranks) == want
    assert [np.frombuffer(i, "<u4").tolist() for i in bpe.replay_all(words, bpe.Merges(ranks))] == want


def test_bpe_nothing(empty):
    assert bpe.encode(empty, queries.MULTI_RANKS, queries.PATTERN).count() == 0


# 10. SimHash


def components(prints, linked):
    ids = sorted(prints, key=lambda i: (i is None, i or 0))
    root = list(range(len(ids)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(ids)):
        for b in range(a):
            if linked(prints[ids[a]], prints[ids[b]]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: ids[find(k)] for k, i in enumerate(ids)}


def test_near_copies_match_brute_force(spark, texts):
    from xxhash import xxh64_intdigest

    rows = dict(texts) | {10_000: None, 10_001: " \t", 10_002: "one two", 10_003: "ONE two", 10_004: LONG}
    base = texts[7].split()
    for k in range(40):  # a group of near copies
        rows[20_000 + k] = " ".join([*base[:k], "x", *base[k + 1 :]])
    prints = {}
    for doc_id, text in rows.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", folded(text))
        shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
        hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[doc_id] = sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))
    roots = components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    table = spark.createDataFrame([*rows.items()], "doc_id long, text string")
    got = simhash.near_copies(table, simhash.Rule(4, 1, 4, 4)).collect()
    assert {tuple(r) for r in got} == {(i, f"{prints[i]:016x}", roots[i]) for i in rows}


@pytest.mark.parametrize("rule", [simhash.Rule(4, 1, 4, 4), simhash.Rule(5, 8, 22, 87), simhash.SIMILAR])
def test_links_across_shards(spark, rule, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 100)
    monkeypatch.setattr(simhash, "VISITORS", 300)
    monkeypatch.setattr(simhash, "LEAF", 16)
    draw = np.random.default_rng(4)
    base = draw.integers(0, 256, (150, rule.size), dtype=np.uint8)
    table = [base]
    for _ in range(4):  # chains of copies of copies
        flip = np.zeros_like(base)
        for row in flip:
            for bit in draw.integers(0, 8 * rule.size, rule.distance - 1 if rule.numbers == 1 else 60):
                row[bit // 8] ^= 1 << bit % 8
        table.append(table[-1] ^ flip)
    prints = {k: row.tobytes() for k, row in enumerate(np.unique(np.concatenate(table), axis=0))}
    if rule.alike:  # none, few and many shingles, in groups that chains can cross or not
        prints = {k: v + int(draw.choice([0, 1, 100, 124, 125, 126, 156, 9000])).to_bytes(8, "big") for k, v in prints.items()}

    def linked(a, b):
        a, b = ([*np.frombuffer(v, ">u8").tolist()] for v in (a, b))
        bits = [(x ^ y).bit_count() for x, y in zip(a[: rule.numbers], b[: rule.numbers])]
        alike = not rule.alike or min(a[-1], b[-1]) >= rule.alike * max(a[-1], b[-1])
        return bits[0] <= rule.first and sum(bits) <= rule.distance and alike

    roots = components(prints, linked)
    frame = spark.createDataFrame([(v,) for v in prints.values()], "print binary")
    label = {bytes(r.node): bytes(r.label) for r in simhash.contract(simhash.links(frame, rule)).collect()}
    groups = {}
    for k, v in prints.items():
        groups.setdefault(label.get(v, v), set()).add(k)
    want = {}
    for k, root in roots.items():
        want.setdefault(root, set()).add(k)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_near_copies_of_odd_rows(odd, empty):
    got = {(r.doc_id, r.component_id) for r in simhash.near_copies(odd).collect()}
    assert {(1, 1), (2, 1), (6, 5), (5, 5), (None, 1)} <= got
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and {2, 6}.isdisjoint(r.doc_id for r in kept.collect())
    assert simhash.near_copies(empty).count() == simhash.keep_one(empty).count() == 0


def test_repeated_lines_do_not_decide(spark):
    """Different texts that share a line many times stay apart; one text with its line repeated is linked."""
    draw = random.Random(6)
    words = lambda n: " ".join(f"w{draw.randrange(10**9)}" for _ in range(n))
    line, body = words(20), words(300)
    rows = [(1, " ".join([line] * 30 + [words(200)])), (2, " ".join([line] * 30 + [words(200)]))]
    rows += [(3, " ".join([body] + [line] * 2)), (4, " ".join([body] + [line] * 30))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash.near_copies(table).collect()} == {1: 1, 2: 2, 3: 3, 4: 3}


@pytest.mark.parametrize("block", [1 << 24, 4000])
def test_near_copies_are_confirmed(spark, block, monkeypatch):
    """What fingerprints propose is united by exact Jaccard similarity, over any number of blocks."""
    monkeypatch.setattr(simhash, "BLOCK_BYTES", block)
    draw = random.Random(7)
    rows = {}
    for group in range(3):
        base = [f"w{draw.randrange(10**9)}" for _ in range(200)]
        for k in range(25):
            text = list(base)
            for at in draw.sample(range(200), draw.randint(1, 9)):
                text[at] = f"x{draw.randrange(10**9)}"
            rows[100 * group + k] = " ".join(text)
    rule = simhash.Rule(5, 8, 64, 512, 0.8)  # proposes all that are about as long
    sets = {k: set(zip(*(text.split()[n:] for n in range(5)))) for k, text in rows.items()}
    roots = components(sets, lambda a, b: len(a & b) >= 0.8 * len(a | b))
    got = simhash.near_copies(spark.createDataFrame([*rows.items()], "doc_id long, text string"), rule)
    assert {r.doc_id: r.component_id for r in got.collect()} == roots and 3 < len(set(roots.values())) < len(rows)
