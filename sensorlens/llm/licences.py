"""Licence scans with a positional index of rare tokens.

Templates (phrases and notices) are indexed by word: word -> (template, position). For each file
and template the template's highest-IDF words that stand in the file are looked up; each place of
such a word proposes where the template would begin, and places agree if they propose the same
beginning. A proposal counts once the template's mandatory key phrases stand there word for word.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.llm.workers import packed, rows

# Lower-cases A-Z, keeps 0-9, a-z and everything outside ASCII, and blanks the rest.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
# Words looked up per file and template.
ANCHORS = 6


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


@dataclass(frozen=True)
class Template:
    """A text that stands for a licence. ``keys`` are the phrases without which it doesn't count;
    ``agree`` anchors must propose the same beginning."""

    label: str
    text: str
    keys: tuple[str, ...]
    agree: int = 1
    base: bool = False


def phrase(label: str, text: str) -> Template:
    return Template(label, text, (text,), base=True)


BASE = (
    phrase("mit", "mit license"),
    phrase("apache", "apache license"),
    phrase("gpl", "general public license"),
)

# Opening words of public licences and their usual notices. Fixed values.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("free of charge", "associated documentation files"), 2),
    Template("mit", "released under the mit license", ("mit license",), 2),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",), 2),
    Template("gpl-2.0", "gnu general public license version 2", ("general public license version 2",), 2),
    Template("gpl-3.0", "gnu general public license version 3", ("general public license version 3",), 2),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",), 2),
    Template("agpl", "gnu affero general public license", ("affero general public license",), 2),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("source and binary forms", "without modification"), 2),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("distribute this software for any purpose", "without fee"), 2),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",), 2),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software",), 2),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",), 2),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",), 2),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",), 2),
)


class Index:
    """Postings of all templates, and their words' inverse document frequencies."""

    def __init__(self, templates: tuple[Template, ...], idf: dict[bytes, float]):
        self.templates = templates
        self.words = [words_of(t.text.encode()) for t in templates]
        self.keys = [[words_of(key.encode()) for key in t.keys] for t in templates]
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for t, words in enumerate(self.words):
            for at, word in enumerate(words):
                self.postings.setdefault(word, []).append((t, at))
        # A template's words from the rarest on. A base phrase stands only where its rarest word
        # does, so one anchor finds every place of it.
        self.ranked = [
            sorted(set(words), key=lambda w: (-idf.get(w, math.inf), w)) for words in self.words
        ]
        # Where in a template each key phrase begins.
        self.at = [
            [next(k for k in range(len(words)) if words[k : k + len(key)] == key) for key in keys]
            for words, keys in zip(self.words, self.keys)
        ]

    def matches(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, where it begins, share of its words that stand in place) of each match."""
        if self.postings.keys().isdisjoint(words):
            return []
        places: dict[bytes, list[int]] = {}
        for at, word in enumerate(words):
            if word in self.postings:
                places.setdefault(word, []).append(at)
        found = []
        for t, template in enumerate(self.templates):
            present = [w for w in self.ranked[t] if w in places]
            if template.base:
                present = present if len(present) == len(self.ranked[t]) else []
            anchors = present[: 1 if template.base else ANCHORS]
            votes = Counter(
                place - at
                for word in anchors
                for at in (at for u, at in self.postings[word] if u == t)
                for place in places[word]
            )
            for begin, agreed in votes.items():
                if agreed >= min(template.agree, len(self.ranked[t])) and self._keys_stand(t, begin, words):
                    here = sum(
                        0 <= begin + k < len(words) and words[begin + k] == word
                        for k, word in enumerate(self.words[t])
                    )
                    found.append((t, begin, here / len(self.words[t])))
        return sorted(found)

    def _keys_stand(self, t: int, begin: int, words: list[bytes]) -> bool:
        return all(
            begin + at >= 0 and words[begin + at : begin + at + len(key)] == key
            for key, at in zip(self.keys[t], self.at[t])
        )


def frequencies(docs: DataFrame, templates: tuple[Template, ...]) -> dict[bytes, float]:
    """Inverse document frequencies, over all documents, of the words that templates hold. What
    comes back has a row for each such word at most."""
    wanted = frozenset(w for t in templates for w in words_of(t.text.encode()))
    schema = pa.schema([("word", pa.binary()), ("files", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, seen = Counter(), 0
        for (text,) in rows(batches):
            seen += 1
            files.update(wanted.intersection(words_of(text or b"")))
        yield from packed([*files.items(), (None, seen)], schema)

    texts = docs.select(F.col("text").cast("string").cast("binary"))
    found = texts.mapInArrow(run, "word binary, files long").groupBy("word").agg(F.sum("files").alias("n"))
    counts = {None if row.word is None else bytes(row.word): row.n for row in found.collect()}
    total = counts.pop(None, 0)
    return {word: math.log((1 + total) / (1 + n)) for word, n in counts.items()}


def scan(docs: DataFrame, templates: tuple[Template, ...] = BASE + NOTICES) -> DataFrame:
    """Licences named or quoted in every whole text.

    Returns ``doc_id``, ``n_words`` and ``matches``, an array of (label, base, begin, words, share)
    for every place of every template: first word (from 0), words, and the share of the template's
    words that stand in place. A null text is empty; texts without words have no matches; a null
    ``doc_id`` stays null; repeated rows are scanned each; an empty table gives no rows. Places
    where several templates match are all listed, by template and place.
    """
    index = Index(templates, frequencies(docs, templates))
    match = pa.struct(
        [("label", pa.string()), ("base", pa.bool_()), ("begin", pa.int64()), ("words", pa.int32()),
         ("share", pa.float64())]
    )
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("matches", pa.list_(match))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def scanned():
            for doc_id, text in rows(batches):
                words = words_of(text or b"")
                matches = [
                    {"label": templates[t].label, "base": templates[t].base, "begin": begin,
                     "words": len(index.words[t]), "share": share}
                    for t, begin, share in index.matches(words)
                ]
                yield doc_id, len(words), matches

        yield from packed(scanned(), schema)

    table = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
    shape = "array<struct<label: string, base: boolean, begin: long, words: int, share: double>>"
    return table.mapInArrow(run, f"doc_id long, n_words long, matches {shape}")


def summary(scanned: DataFrame) -> DataFrame:
    """One row per file: counts and span of the base phrases, labels, and the best share."""

    def labels(of: str) -> str:
        return f"array_join(array_sort(array_distinct(transform({of}, m -> m.label))), ',')"

    base = "filter(matches, m -> m.base)"
    return scanned.selectExpr(
        "doc_id",
        "n_words",
        f"cast(size({base}) as long) as n_base",
        f"array_min(transform({base}, m -> m.begin)) as first_word",
        f"array_max(transform({base}, m -> m.begin)) as last_word",
        f"{labels(base)} as base_labels",
        f"{labels('matches')} as labels",
        "coalesce(array_max(transform(matches, m -> m.share)), 0d) as score",
    )
