"""Words of many texts at once, as numpy arrays over their code points.

A batch of texts becomes one array of code points; words are runs of word
characters in it, and the hash of any run of positions is a difference of prefix
sums, so no Python loop runs over words or characters.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

import numpy as np

_ODD = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

OTHER, LOWER, UPPER, DIGIT = 0, 1, 2, 3


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For the code points below 2^16: kind, and lower case where that is one code point."""
    kinds, lower = np.zeros(1 << 16, np.uint8), np.arange(1 << 16, dtype=np.uint32)
    for i in range(1 << 16):
        c = chr(i)
        if c.isdigit():
            kinds[i] = DIGIT
        elif c.isalnum() or c == "_":
            low = c.lower()
            kinds[i] = UPPER if low != c else LOWER
            if len(low) == 1:
                lower[i] = ord(low)
    return kinds, lower


_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers, modulo 2^64, of an odd number and of its inverse."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        _powers = tuple(
            np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, base, np.uint64)])
            for base in (_ODD, pow(_ODD, -1, 1 << 64))
        )
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Prefix:
    """Hashes of runs of a sequence of integers; equal runs have equal hashes."""

    def __init__(self, values: np.ndarray):
        forward, self.back = powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * forward[:-1], out=self.sums[1:])

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])


class Words:
    """Words of a list of texts.

    ``points``: code points, each text followed by a 0; ``lower`` and ``kinds`` go
    with it. ``first[k]`` to ``last[k]`` is word k; ``text[k]`` its text, and
    ``bounds[t]`` to ``bounds[t + 1]`` the words of text t. Word characters are
    letters, digits and underscores, and points or commas between two digits.
    """

    def __init__(self, texts: Sequence[str], numbers: bool = True):
        joined = "\0".join(texts) + "\0" if texts else ""
        self.points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds, lower = _tables()
        near = np.minimum(self.points, 0xFFFF)
        far = self.points > 0xFFFF
        self.kinds = np.where(far, LOWER, kinds[near]) if far.any() else kinds[near]
        self.lower = np.where(far, self.points, lower[near]) if far.any() else lower[near]
        # texts may themselves hold a 0, so their places come from their lengths
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.starts = np.r_[0, np.cumsum(lengths)]
        word = self.kinds > 0
        if numbers and len(word) > 2:
            digit = self.kinds == DIGIT
            inside = (self.points[1:-1] == ord(".")) | (self.points[1:-1] == ord(","))
            word[1:-1] |= inside & digit[:-2] & digit[2:]
        edges = np.flatnonzero(np.diff(np.r_[False, word, False].view(np.int8)))
        self.first, self.last = edges[::2], edges[1::2]
        self.bounds = np.searchsorted(self.first, self.starts)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.bounds))

    def __len__(self) -> int:
        return len(self.first)

    def hashes(self) -> np.ndarray:
        """Hash of each word in lower case."""
        return Prefix(self.lower).runs(self.first, self.last)

    def holds(self, flags: np.ndarray) -> np.ndarray:
        """How many flagged code points each word has."""
        sums = np.r_[0, np.cumsum(flags, dtype=np.int64)]
        return sums[self.last] - sums[self.first]


def word_hash(word: str) -> int:
    """Hash of one word, as ``Words.hashes`` has it."""
    words = Words([word])
    if len(words) != 1:
        raise ValueError(f"not a word: {word!r}")
    return int(words.hashes()[0])
