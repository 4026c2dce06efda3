"""A wavelet matrix over numpy: succinct bit planes of a sequence, with rank and select.

Plane ``b`` holds the ``b``-th highest bit of every token, in the order that earlier planes left;
after each plane, tokens with a 0 go before tokens with a 1, both in their old order.
"""

from __future__ import annotations

import numpy as np

# Bits between two stored ranks of a plane.
STRIDE = 512


def build(tokens: np.ndarray, width: int) -> tuple[bytes, bytes, list[int]]:
    """Planes (each ``ceil(n / 8)`` bytes), ranks at every ``STRIDE`` bits, zeros per plane.
    A token of more than ``width`` bits fails."""
    if len(tokens) and int(tokens.max()) >> width:
        raise ValueError(f"token {int(tokens.max())} needs more than {width} bits")
    planes, ranks, zeros = [], [], []
    tokens = tokens.astype(np.uint16 if width <= 16 else np.uint32)
    n, strides = len(tokens), -(-len(tokens) // STRIDE)
    for shift in range(width - 1, -1, -1):
        bits = (tokens & tokens.dtype.type(1 << shift)) != 0
        plane = np.packbits(bits, bitorder="little")
        planes.append(plane.tobytes())
        whole = np.zeros(strides * STRIDE // 8, np.uint8)
        whole[: len(plane)] = plane
        per_stride = np.bitwise_count(whole.view(np.uint64)).reshape(strides, STRIDE // 64).sum(axis=1, dtype=np.int64)
        ranks.append(np.concatenate(([0], np.cumsum(per_stride))).astype("<u4").tobytes())
        tokens = np.concatenate((tokens[~bits], tokens[bits]))
        zeros.append(n - int(per_stride.sum()))
    return b"".join(planes), b"".join(ranks), zeros


class Wavelet:
    """Reads what :func:`build` wrote."""

    def __init__(self, n: int, planes: bytes, ranks: bytes, zeros: list[int]):
        self.n, self.zeros, self.width = n, zeros, len(zeros)
        size = (n + 7) // 8
        self.planes = np.frombuffer(planes, np.uint8).reshape(self.width, size)
        self.ranks = np.frombuffer(ranks, "<u4").reshape(self.width, -1)

    def bits(self, plane: int) -> np.ndarray:
        return np.unpackbits(self.planes[plane], count=self.n, bitorder="little").astype(bool)

    def rank(self, plane: int, at: int) -> int:
        """Ones of a plane before a place."""
        block = at // STRIDE
        part = np.unpackbits(self.planes[plane, block * STRIDE // 8 : (at + 7) // 8], bitorder="little")
        return int(self.ranks[plane, block]) + int(part[: at - block * STRIDE].sum())

    def select(self, plane: int, bit: int, k: int) -> int:
        """The place of the ``k``-th (from 0) one or zero of a plane."""
        marks = self.ranks[plane].astype(np.int64)
        if not bit:
            marks = np.minimum(np.arange(len(marks)) * STRIDE, self.n) - marks
        block = int(np.searchsorted(marks, k, side="right")) - 1
        begin = block * STRIDE
        part = np.unpackbits(self.planes[plane, begin // 8 : (begin + STRIDE) // 8], bitorder="little")
        part = part[: self.n - begin]
        return begin + int(np.flatnonzero(part == bit)[k - int(marks[block])])

    def access(self, at: int) -> int:
        """The token at a place."""
        token = 0
        for plane in range(self.width):
            ones = self.rank(plane, at)
            bit = self.rank(plane, at + 1) - ones
            token = token << 1 | bit
            at = self.zeros[plane] + ones if bit else at - ones
        return token

    def _range(self, token: int) -> tuple[int, int]:
        """Where the token's occurrences lie after the last plane."""
        low, high = 0, self.n
        if token >> self.width:
            return 0, 0
        for plane in range(self.width):
            ones_low, ones_high = self.rank(plane, low), self.rank(plane, high)
            if token >> (self.width - 1 - plane) & 1:
                low, high = self.zeros[plane] + ones_low, self.zeros[plane] + ones_high
            else:
                low, high = low - ones_low, high - ones_high
        return low, high

    def count(self, token: int) -> int:
        low, high = self._range(token)
        return high - low

    def occurrences(self, token: int) -> list[int]:
        """All places of a token, in order."""
        low, high = self._range(token)
        places = []
        for at in range(low, high):
            for plane in range(self.width - 1, -1, -1):
                bit = token >> (self.width - 1 - plane) & 1
                at = self.select(plane, bit, at - self.zeros[plane] if bit else at)
            places.append(at)
        return sorted(places)

    def tokens(self) -> np.ndarray:
        """All tokens in order: the planes undone from the last to the first."""
        out = np.zeros(self.n, np.uint16 if self.width <= 16 else np.uint32)
        for plane in range(self.width - 1, -1, -1):
            bits = self.bits(plane)
            before = np.empty_like(out)
            before[~bits] = out[: self.zeros[plane]]
            before[bits] = out[self.zeros[plane] :] | out.dtype.type(1 << (self.width - 1 - plane))
            out = before
        return out.astype(np.uint32)
