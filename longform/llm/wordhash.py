"""Words of many texts at once, as arrays: where they stand, and a 64-bit hash of each.

Texts are joined into one buffer. The hash of a word is the difference of a running sum
of ``value[byte] * base ** position`` (mod 2**64) divided by the power at its start, then
mixed with its length; so it costs a few passes over the bytes and no Python object per word.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
#: Texts are handled in groups of about so many bytes (one longer text makes a group of its own).
GROUP_BYTES = 1_000_000


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """The 64-bit finaliser of splitmix, with a seed."""
    x = x + U((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_VALUES = mix(np.arange(256, dtype=U), 7)
_LOWERED = _VALUES.copy()
_LOWERED[65:91] = _VALUES[97:123]
_SPACE = np.zeros(256, np.int8)
_SPACE[[0x20, *range(0x09, 0x0E)]] = 1


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse up to n."""
    out = []
    for base in (BASE, pow(BASE, -1, 2**64)):
        step = np.full(n + 1, base, U)
        step[0] = 1
        out.append(np.multiply.accumulate(step))
    return out[0], out[1]


@dataclass(frozen=True)
class Words:
    """``data``: all bytes; word i is data[starts[i]:ends[i]] and belongs to the text t with first[t] <= i < first[t + 1]."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]]


def split_words(texts: list[bytes], lower: bool = False) -> Words:
    """Words of UTF-8 texts between ASCII white space; ``lower`` hashes A-Z as a-z."""
    data = b"\n".join(texts) + b"\n"
    raw = np.frombuffer(data, np.uint8)
    edges = np.flatnonzero(np.diff(_SPACE[raw], prepend=np.int8(1)))
    starts, ends = edges[0::2], edges[1::2]
    power, inverse = _powers(max(1 << (len(raw) - 1).bit_length(), 1 << 20))
    total = np.zeros(len(raw) + 1, U)
    np.cumsum((_LOWERED if lower else _VALUES)[raw] * power[: len(raw)], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U))
    begin = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begin[1:])
    return Words(data, starts, ends, np.searchsorted(starts, begin), hashes)


def groups(texts: list[bytes]):
    """Slices of a list of texts, each of about ``GROUP_BYTES``."""
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text) + 1
        if held >= GROUP_BYTES:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def utf8(text) -> bytes:
    """A text's bytes; null is empty."""
    return text.encode("utf-8", "replace") if isinstance(text, str) else b""


class WordTable:
    """Values (arrays of numbers) by word, learned as words come up.

    ``learn`` is called with words not yet in the table and returns the values (a sequence) of each. The
    table is bounded by ``most`` words: beyond it starts anew. Looking a word up costs a
    binary search over hashes.
    """

    def __init__(self, learn, dtype, most: int):
        self._learn, self._dtype, self._most = learn, dtype, most
        self.clear()

    def clear(self) -> None:
        self._hashes, self._at, self._size, self._values = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self._dtype)

    def _missing(self, words: Words):
        seen, where = np.unique(words.hashes, return_index=True)
        if not len(self._hashes):
            return seen, where
        new = self._hashes[np.minimum(np.searchsorted(self._hashes, seen), len(self._hashes) - 1)] != seen
        return seen[new], where[new]

    def _add(self, words: Words) -> None:
        seen, where = self._missing(words)
        if len(self._hashes) + len(seen) > self._most and len(self._hashes):
            self.clear()
            seen, where = self._missing(words)
        if not len(seen):
            return
        each = self._learn([words.word(i) for i in where])
        size = np.fromiter(map(len, each), np.int64, len(each))
        at = len(self._values) + np.cumsum(size) - size
        fresh = np.fromiter((x for values in each for x in values), self._dtype, int(size.sum()))
        self._values = np.concatenate([self._values, fresh])
        hashes = np.concatenate([self._hashes, seen])
        order = np.argsort(hashes, kind="stable")
        self._hashes = hashes[order]
        self._at = np.concatenate([self._at, at])[order]
        self._size = np.concatenate([self._size, size])[order]

    def look_up(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """All values of the words one after another, and how many belong to each text."""
        self._add(words)
        if not len(words.hashes):
            return np.zeros(0, self._dtype), np.zeros(len(words.first) - 1, np.int64)
        slot = np.searchsorted(self._hashes, words.hashes)
        size, at = self._size[slot], self._at[slot]
        upto = np.cumsum(size)
        values = self._values[np.arange(int(upto[-1])) + np.repeat(at - (upto - size), size)]
        ends = np.concatenate([[0], upto])[words.first]
        return values, np.diff(ends)
