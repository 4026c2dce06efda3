"""Byte-level BPE from a rank file, by replaying merges over the words of a corpus part.

The distinct words of many texts are laid out as one row of symbols. An inverted index holds, for
each pair of neighbours that can merge, the places where it stands; merges are applied in rank
order, each to all its places at once, and only the neighbours it touched change the index.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.llm.tokens import SPACED, WHITE
from sensorlens.llm.workers import memo, packed, rows

# Characters of text whose new pieces are encoded together.
TEXT_AT_ONCE = 4 << 20
MEMO_PIECES = 250_000
_GONE, _EDGE, _NONE = b"", -1, 1 << 40


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its id in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def replay(words: list[bytes], ranks: dict[bytes, int]) -> list[list[int]]:
    """The ids of each word: its bytes, merged as long as two neighbours make a known token, the
    lowest rank first and the leftmost of equal ranks first. A word that is a token has one id."""
    symbols: list[bytes] = []
    after: list[int] = []
    before: list[int] = []
    starts = []
    for word in words:
        at = len(symbols)
        starts.append(at)
        if word in ranks:
            symbols.append(word)
            after.append(_EDGE)
            before.append(_EDGE)
            continue
        n = len(word)
        symbols.extend(word[k : k + 1] for k in range(n))
        after.extend(range(at + 1, at + n + 1))
        before.extend(range(at - 1, at + n - 1))
        if n:
            before[at] = after[-1] = _EDGE
    index: dict[int, list[int]] = {}
    for at, right in enumerate(after):
        if right != _EDGE:
            rank = ranks.get(symbols[at] + symbols[right])
            if rank is not None:
                index.setdefault(rank, []).append(at)
    queue = list(index)
    heapify(queue)
    while queue:
        rank = heappop(queue)
        places = index.pop(rank)
        places.sort()
        for k, at in enumerate(places):
            right = after[at]
            if right == _EDGE or not symbols[at] or ranks.get(symbols[at] + symbols[right]) != rank:
                continue  # one of the two has merged meanwhile
            symbols[at] += symbols[right]
            symbols[right] = _GONE
            beyond = after[right]
            after[at], after[right] = beyond, _EDGE
            if beyond != _EDGE:
                before[beyond] = at
            lower = False
            for left, next_ in ((before[at], at), (at, beyond)):
                if left == _EDGE or next_ == _EDGE:
                    continue
                new = ranks.get(symbols[left] + symbols[next_])
                if new is None:
                    continue
                if new in index:
                    index[new].append(left)
                else:
                    index[new] = [left]
                    heappush(queue, new)
                lower |= new < rank
            if lower and k + 1 < len(places):  # the new pair goes before what is left of this one
                if rank not in index:
                    index[rank] = []
                    heappush(queue, rank)
                index[rank].extend(places[k + 1 :])
                break
    ends = [*starts[1:], len(symbols)]
    return [
        [ranks[s] for s in symbols[start:end] if s] for start, end in zip(starts, ends)
    ]


class Merges:
    """The ranks as arrays: single bytes, and every pair of tokens that makes a third one."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [
            (ranks[token[:k]] << 32 | ranks[token[k:]], rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        ]
        table = np.array(pairs, np.int64)
        self.keys, self.made = table[np.argsort(table[:, 0])].T.copy()

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of neighbours, ``_NONE`` where they don't merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.made[at], _NONE)


def replay_all(words: list[bytes], merges: Merges) -> list[bytes]:
    """:func:`replay` over many words at once, each merge applied to all its places in one step.

    Returns ids as little-endian unsigned 32-bit bytes. The few words in which a merge makes a
    pair of a lower rank than its own go through :func:`replay`, as order within them matters.
    """
    if not words:
        return []
    ranks = merges.ranks
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths)
    n = int(ends[-1])  # also the place beyond every word's edges
    whole = np.fromiter((word in ranks for word in words), bool, len(words))
    symbol = np.append(merges.single[np.frombuffer(b"".join(words), np.uint8)], -1)
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    after[ends - 1] = n
    before[ends - lengths] = before[n] = after[n] = n
    word_of = np.repeat(np.arange(len(words)), lengths)
    rank_at = merges.of(symbol, symbol[after])
    rank_at[:n][whole[word_of]] = _NONE
    marked = np.zeros(n + 1, bool)
    odd: set[int] = set()
    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def add(places: np.ndarray, new: np.ndarray) -> None:
        order = np.argsort(new, kind="stable")
        places, new = places[order], new[order]
        cuts = np.flatnonzero(np.diff(new)) + 1
        for rank, part in zip(new[np.append(0, cuts)].tolist(), np.split(places, cuts)):
            if rank not in index:
                index[rank] = []
                heappush(queue, rank)
            index[rank].append(part)

    known = np.flatnonzero(rank_at != _NONE)
    if len(known):
        add(known, rank_at[known])
    while queue:
        rank = heappop(queue)
        parts = index.pop(rank)
        places = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
        places = places[rank_at[places] == rank]
        if not len(places):
            continue
        marked[places] = True
        if marked[before[places]].any():  # overlapping, as in "aaa": the left one merges
            taken: set[int] = set()
            for at, left in zip(places.tolist(), before[places].tolist()):
                if left not in taken:
                    taken.add(at)
            marked[places] = False
            places = np.array(sorted(taken))
        else:
            marked[places] = False
        right = after[places]
        beyond = after[right]
        symbol[places], symbol[right] = rank, -1
        after[places], before[beyond] = beyond, places
        before[n] = n
        rank_at[right] = _NONE
        touched = np.concatenate((before[places], places))
        touched = touched[touched < n]
        new = merges.of(symbol[touched], symbol[after[touched]])
        rank_at[touched] = new
        if (new < rank).any():
            for word in np.unique(word_of[touched[new < rank]]).tolist():
                odd.add(word)
                rank_at[ends[word] - lengths[word] : ends[word]] = _NONE
            new = rank_at[touched]
        some = new != _NONE
        if some.any():
            add(touched[some], new[some])
    alive = symbol[:n] >= 0
    ids = symbol[:n][alive].astype("<u4").tobytes()
    stops = (np.cumsum(alive)[ends - 1] * 4).tolist()
    found = [ids[start:stop] for start, stop in zip([0, *stops], stops)]
    for k in np.flatnonzero(whole).tolist():
        found[k] = ranks[words[k]].to_bytes(4, "little")
    for k in odd:
        found[k] = np.asarray(replay([words[k]], ranks)[0], "<u4").tobytes()
    return found


class Corpus:
    """Encodes texts part by part; pieces met before are remembered (a bounded number)."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex

        self.merges = Merges(read_ranks(ranks_path))
        self.words = regex.compile(pattern.replace("[^\\s", f"[^{WHITE}").replace("\\s", f"[{WHITE}]").replace("\\S", f"[^{WHITE}]"))
        self.ids: dict[str, bytes] = {}

    def learn(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """Replays the merges over the words of pieces not met before. Frequent pieces come early,
        so once the memo is full it stays as it is, and the ids of further ones are only returned."""
        cut = {
            piece: [word.encode("utf-8", "surrogatepass") for word in self.words.findall(piece)]
            for piece in pieces if piece not in self.ids
        }
        words = list({word for parts in cut.values() for word in parts})
        ids = dict(zip(words, replay_all(words, self.merges)))
        new = {piece: b"".join(ids[word] for word in parts) for piece, parts in cut.items()}
        room = max(0, MEMO_PIECES - len(self.ids))
        self.ids.update(islice(new.items(), room))
        return new

    def encode(self, texts: list[str]) -> list[bytes]:
        numbers: dict[str, int] = {}
        cut = [
            np.array([numbers.setdefault(p, len(numbers)) for p in SPACED.findall(text)], np.uint32)
            for text in texts
        ]
        new = self.learn(numbers.keys())
        ids = [self.ids[p] if p in self.ids else new[p] for p in numbers]
        return [b"".join(map(ids.__getitem__, places.tolist())) for places in cut]


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (little-endian, 32 bits) of every whole text.

    Each match of ``pattern`` is encoded on its own, without special tokens. A null or empty text
    has no ids; a null ``doc_id`` stays null; repeated rows are encoded each; an empty table gives
    no rows; texts of any length are taken whole.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus = memo(("bpe", ranks_path, pattern), lambda: Corpus(ranks_path, pattern))

        def records():
            for part in _parts(rows(batches)):
                for (doc_id, _), ids in zip(part, corpus.encode([text or "" for _, text in part])):
                    yield doc_id, len(ids) // 4, ids

        yield from packed(records(), schema)

    table = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return table.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def _parts(records: Iterable[tuple]) -> Iterator[list[tuple]]:
    held, size = [], 0
    for record in records:
        held.append(record)
        size += len(record[1] or "")
        if size >= TEXT_AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


def decode(encoded: DataFrame, ranks_path: str, column: str = "ids") -> DataFrame:
    """Adds ``decoded``, the bytes that the ids stand for; null ids give null, unknown ids fail."""
    names = encoded.columns
    place = names.index(column)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def build():
            return {rank: token for token, rank in read_ranks(ranks_path).items()}

        tokens = memo(("bpe tokens", ranks_path), build)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                decoded = [
                    None if ids is None
                    else b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))
                    for ids in part.column(place).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(decoded, pa.binary())], [*names, "decoded"]
                )

    return encoded.mapInArrow(run, ", ".join([*(f"`{n}` {t}" for n, t in encoded.dtypes), "decoded binary"]))
