"""Words, word hashes and shingles of whole Arrow text columns, as numpy arrays.

A word is a run of bytes other than 20 and 09-0D (hex), as in ``[^\\x20\\x09-\\x0D]+``.
Those bytes never occur inside a longer UTF-8 sequence, so texts are read as bytes. Texts
are taken in slices of about a megabyte, so memory does not depend on the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_BLANK = np.zeros(256, dtype=bool)
_BLANK[list(BLANKS)] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all bits."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_powers: dict[str, np.ndarray] = {}


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        have = np.full(max(n, 2 * SLICE), base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if len(have) <= 4 * SLICE:
            _powers[kind] = have
    return have


class Words(NamedTuple):
    """Words of several texts; those of text ``i`` are ``first[i]:first[i + 1]``."""

    data: np.ndarray  # bytes of all texts
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    offsets: np.ndarray  # where each text starts in ``data``

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    body = texts.buffers()[2]
    if body is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(data: np.ndarray, offsets: np.ndarray) -> Words:
    n = len(data)
    solid = ~_BLANK[data]
    border = np.zeros(n + 1, dtype=bool)
    border[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | border[1:n]
    stops = solid.copy()
    stops[:-1] &= ~solid[1:] | border[1:n]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets), offsets)


def split_lines(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Lines without the blanks around them, in place of words; blank lines are none."""
    solid = np.flatnonzero(~_BLANK[data])
    border = np.zeros(len(data) + 1, np.int64)
    border[np.flatnonzero(data == 0x0A) + 1] = 1
    border[offsets] = 1
    line = np.cumsum(border)[solid]
    heads = np.flatnonzero(np.r_[True, line[1:] != line[:-1]]) if len(solid) else np.zeros(0, np.int64)
    starts, ends = solid[heads], solid[np.r_[heads[1:], len(solid)] - 1] + 1 if len(solid) else solid
    return Words(data, starts, ends, np.searchsorted(starts, offsets), offsets)


def slices(texts: pa.Array, most: int = SLICE, by: Callable = split) -> Iterator[tuple[int, int, Words]]:
    """``(from, to, words)`` for ranges of rows of about ``most`` bytes; a row stays whole."""
    data, offsets = flat(texts)
    lo, n = 0, len(texts)
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        own = offsets[lo : hi + 1]
        yield lo, hi, by(data[own[0] : own[-1]], own - own[0])
        lo = hi


def word_hashes(words: Words, lower: bool = False) -> np.ndarray:
    """64 bits for each word, equal for equal words; ``lower`` takes A-Z as a-z."""
    table, out = _LOWER if lower else _BYTE, np.empty(len(words.starts), np.uint64)
    lo = 0
    while lo < len(out):
        at = words.starts[lo]
        hi = max(int(np.searchsorted(words.starts, at + SLICE)), lo + 1)
        end = words.ends[hi - 1]
        sums = np.zeros(end - at + 1, np.uint64)
        np.multiply(table[words.data[at:end]], _power("up", _BASE, end - at)[: end - at], out=sums[1:])
        np.cumsum(sums, out=sums)
        s, e = words.starts[lo:hi] - at, words.ends[lo:hi] - at
        out[lo:hi] = (sums[e] - sums[s]) * _power("down", _INVERSE, end - at)[s]
        lo = hi
    return mix(out)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of the ``n`` words from each position on, as far as there are ``n``."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(size, n, np.uint64)
    for k in range(n):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[k : k + size]
        out ^= out >> np.uint64(32)
    return mix(out)


def shingles(hashes: np.ndarray, first: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """Distinct shingles of ``n`` words of each text, sorted; a shorter text is one shingle."""
    every = grams(hashes, n)
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
        if hi - lo >= n:
            yield np.unique(every[lo : hi - n + 1])
        elif hi > lo:
            yield grams(hashes[lo:hi], hi - lo)
        else:
            yield every[:0]
