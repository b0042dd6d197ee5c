"""Hashes of word runs in numpy: one pass of prefix sums, then any run in constant time.

A text is held in canonical form: its words joined by single spaces. Equal word sequences are equal
byte strings there, and only then (words hold no space).
"""

from __future__ import annotations

import numpy as np

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: odd multipliers of the two independent families
_ODD = (0x2545F4914F6CDD1D, 0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Family:
    """Polynomial hashes modulo 2^64 over bytes that are first replaced by random words."""

    def __init__(self, which: int):
        self.odd, self.inverse = _ODD[which], pow(_ODD[which], -1, 1 << 64)
        self.code = mix(np.arange(256, dtype=np.uint64) + np.uint64(1 + 1000 * which))
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            with np.errstate(over="ignore"):
                for name, base in (("up", self.odd), ("down", self.inverse)):
                    steps = np.full(size, base, dtype=np.uint64)
                    steps[0] = 1
                    setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums of a byte array, one longer than it."""
        self._powers(len(data) + 1)
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(self.code[data] * self.up[: len(data)], dtype=np.uint64, out=out[1:])
        return out

    def runs(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of data[start:end]."""
        with np.errstate(over="ignore"):
            return mix((prefix[end] - prefix[start]) * self.down[start] + (end - start).astype(np.uint64))


_FAMILIES: dict[int, Family] = {}


def family(which: int) -> Family:
    """The family, with its powers kept for the life of the worker."""
    if which not in _FAMILIES:
        _FAMILIES[which] = Family(which)
    return _FAMILIES[which]


class Words:
    """Canonical bytes of some texts and where their words lie."""

    def __init__(self, texts: list[list[bytes]]):
        canonical = [b" ".join(words) for words in texts]
        self.counts = np.array([len(words) for words in texts], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.data = np.frombuffer(b" ".join(c for c in canonical if c), dtype=np.uint8)
        space = np.flatnonzero(self.data == 32)
        if len(self.data):
            self.start = np.concatenate([[0], space + 1])
            self.end = np.concatenate([space, [len(self.data)]])
        else:
            self.start = self.end = np.zeros(0, dtype=np.int64)
        self.text_of = np.repeat(np.arange(len(texts)), self.counts)

    def __len__(self) -> int:
        return len(self.start)

    def run_starts(self, n: int) -> np.ndarray:
        """Positions where n words of one text begin."""
        at = np.arange(max(0, len(self) - n + 1))
        return at[at + n <= self.first[self.text_of[at] + 1]] if len(at) else at

    def hashes(self, n: int, at: np.ndarray, which: int, prefix: np.ndarray | None = None) -> np.ndarray:
        """Hashes of the n words from each given position."""
        f = family(which)
        if prefix is None:
            prefix = f.prefix(self.data)
        return f.runs(prefix, self.start[at], self.end[at + n - 1])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of that many values, from block-wise running minima."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    pad = -len(values) % width
    blocks = np.concatenate([values, np.full(pad, values.max(), dtype=values.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def sliding_max(values: np.ndarray, width: int) -> np.ndarray:
    return ~sliding_min(~values, width)
