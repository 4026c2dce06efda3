"""Ids of whole texts by the tokenizers library, with a memo of pieces.

A text is cut where the tokenizers' own rules always cut (before a single space, around runs of
white space, and between a leading run of Latin letters and ASCII punctuation), so the ids of the
pieces, put together, are the ids of the text. Frequent pieces are encoded once per worker.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Sequence
from string import ascii_lowercase, ascii_uppercase

import numpy as np

from sensorlens.llm.workers import memo

# White space as Unicode defines it; Python's own class holds four control characters more.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
_ENDS = f"(?=[!-/:-@\\[-`{{-~{WHITE}]|\\Z)"

# Pieces that keep their leading space and white space, and pieces for rules that drop it.
SPACED = re.compile(f" ?{_LETTERS}{_ENDS}| ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
BARE = re.compile(f"{_LETTERS}{_ENDS}|[^{WHITE}]+")

# Pieces kept per worker, about 200 bytes each. Frequent ones come early, so a full memo stays.
MEMO_PIECES = 500_000

# Words encoded in one call, and what stands between them: no letter, digit or white space, so between
# spaces a word of its own.
WORDS_AT_ONCE = 1000
MARK = "\x01"


class Pieces(dict):
    """Ids of pieces as little-endian unsigned 32-bit bytes, made on first use."""

    def __init__(self, encode: Callable[[str], list[int]]):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = np.asarray(self.encode(piece), dtype="<u4").tobytes()
        if len(self) < MEMO_PIECES and len(piece) <= 64:
            self[piece] = ids
        return ids


class Words:
    """Ids of words as little-endian unsigned 32-bit bytes, for a tokenizer that drops white space.

    New words are put together with marks between them and encoded in one call, which takes a third
    less time than a call for each. The mark's id tells where a word's ids end; where it doesn't
    occur exactly once between two words, they are encoded one by one.
    """

    def __init__(self, tokenizer):
        self.tokenizer, self.known = tokenizer, {}
        # Whether A-Z are lower-cased before words are looked for: then words differ less.
        rules = tokenizer.normalizer
        self.lowers = rules is not None and rules.normalize_str(ascii_uppercase) == ascii_lowercase
        mark = self.ids(f" {MARK} ")
        self.mark = int(mark[0]) if len(mark) == 1 else None

    def lowered(self, text: str) -> str:
        return text.encode().lower().decode() if self.lowers else text

    def ids(self, text: str) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.asarray(found, dtype="<u4")

    def encode(self, words: list[str]) -> list[bytes]:
        if self.mark is not None and len(words) > 1:
            ids = self.ids(f" {MARK} ".join(words))
            marks = (np.flatnonzero(ids == self.mark) * 4).tolist()
            if len(marks) == len(words) - 1:
                raw = ids.tobytes()
                return [raw[a:b] for a, b in zip([0, *(at + 4 for at in marks)], [*marks, len(raw)])]
        return [self.ids(word).tobytes() for word in words]

    def texts(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text; a null text is empty."""
        known, rest = self.known, {}
        cut = [BARE.findall(self.lowered(text or "")) for text in texts]
        new = list(set().union(*cut).difference(known))
        for at in range(0, len(new), WORDS_AT_ONCE):
            some = new[at : at + WORDS_AT_ONCE]
            for word, ids in zip(some, self.encode(some)):
                keep = len(known) < MEMO_PIECES and len(word) <= 64
                (known if keep else rest)[word] = ids
        if rest:
            return [b"".join(rest[w] if w in rest else known[w] for w in words) for words in cut]
        return [b"".join(map(known.__getitem__, words)) for words in cut]


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def texts_encoder(path: str) -> Callable[[Sequence[str | None]], list[bytes]]:
    """A function from some texts to the ids of each as bytes, for a tokenizer that drops white
    space; call it in a worker. Special tokens' strings in a text are ordinary text."""
    return memo(("words", path), lambda: Words(_tokenizer(path)), alone=True).texts


def text_encoder(path: str, keeps_space: bool) -> Callable[[str | None], bytes]:
    """A function from a text to its ids as bytes; call it in a worker.

    Special tokens' strings in a text are ordinary text. A null text is empty.
    """

    def build() -> Pieces:
        tokenizer = _tokenizer(path)
        return Pieces(lambda piece: tokenizer.encode(piece, add_special_tokens=False).ids)

    known = memo(("pieces", path), build, alone=True)
    cut = SPACED if keeps_space else BARE

    def encode(text: str | None) -> bytes:
        return b"".join(map(known.__getitem__, cut.findall(text or "")))

    return encode
