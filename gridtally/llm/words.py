"""Words of many texts at once, as numpy arrays.

Used inside Arrow batches. A word is a run of Unicode letters and digits of the
lower-cased text. No Python object is made per word: words are 64-bit digests
with their places.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np

#: Characters worked on together; a longer text is worked on alone.
SLICE = 1_000_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)
_PERIOD = 4096


class Words(NamedTuple):
    """Words of a list of texts: digest and place of each, and each text's first word."""

    digest: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    codes: np.ndarray

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


@cache
def kinds() -> np.ndarray:
    """For each code point: 2 a letter, 1 another character of words, 0 none."""
    table = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        char = chr(point)
        if char.isalnum():
            table[point] = 2 if char.isalpha() else 1
    return table


@cache
def _powers() -> np.ndarray:
    out = np.full(_PERIOD, 0xD6E8FEB86659FD93, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(32))
    x *= _ODD
    x ^= x >> np.uint64(29)
    x *= _ODD2
    x ^= x >> np.uint64(32)
    return x


def slices(texts: list[str]) -> Iterator[slice]:
    """Neighbouring texts of about SLICE characters together."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > SLICE:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield slice(begin, len(texts))


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, a line feed after each, and where each text starts."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(lengths + 1, out=starts[1:])
    joined = "\n".join([*texts, ""])
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4"), starts


def words(texts: list[str]) -> Words:
    codes, starts = code_points([text.lower() for text in texts])
    inside = kinds()[codes] > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    start, end = edges[0::2], edges[1::2]
    first = np.searchsorted(start, starts)
    if not len(start):
        return Words(np.zeros(0, np.uint64), start, end, first, codes)
    length = end - start
    begin = np.zeros(len(length), np.int64)
    np.cumsum(length[:-1], out=begin[1:])
    place = np.arange(int(length.sum())) - np.repeat(begin, length)
    chars = codes[inside].astype(np.uint64) * _ODD
    chars ^= chars >> np.uint64(29)
    chars *= _powers()[place % _PERIOD]
    digest = mixed(np.add.reduceat(chars, begin) + length.astype(np.uint64))
    return Words(digest, start, end, first, codes)
