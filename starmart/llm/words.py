"""Words of whole text columns, found and hashed over byte arrays instead of one word at a time.

A word is a run of bytes other than blank and \\t \\n \\v \\f \\r; A-Z count as a-z. Its 64-bit hash
is a polynomial over random values of its bytes, mixed with its length.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

from starmart.llm.tables import bytes_and_offsets

CHUNK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_MARK, _PLAIN = np.zeros(256, bool), np.zeros(256, bool)
_MARK[[0x2C, 0x2E]] = True
_PLAIN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finalizer of splitmix64)."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    table = mix((np.arange(1, 257, dtype=np.uint64)) * np.uint64(_BASE))
    lower = np.arange(256)
    lower[65:91] += 32
    return table[lower]


@lru_cache(maxsize=4)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(length, _BASE, np.uint64)
    down = np.full(length, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def find_words(texts: pa.Array, split_marks: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of every word, text by text, and the number of words of each text.

    Places count from the first byte of the first text. With ``split_marks`` a comma or full stop
    that ends a word, after a letter or digit of ASCII, is a word of its own.
    """
    data, offsets = bytes_and_offsets(texts)
    hashes, starts_of, ends_of = [], [], []
    counts = np.zeros(len(offsets) - 1, np.int64)
    first, end = 0, len(data)
    while first < end:
        last = _cut(data, offsets, min(first + CHUNK_BYTES, end))
        part = data[first:last]
        blank = _BLANK[part]
        starts = ~blank
        starts[1:] &= blank[:-1]
        ends = ~blank
        ends[:-1] &= blank[1:]
        # Texts touch in the buffer: a new text also ends a word.
        inner = offsets[np.searchsorted(offsets, first, "right") : np.searchsorted(offsets, last)] - first
        starts[inner] = ~blank[inner]
        ends[inner - 1] = ~blank[inner - 1]
        if split_marks:
            apart = np.flatnonzero(ends & ~starts & _MARK[part])
            apart = apart[_PLAIN[part[apart - 1]]]
            starts[apart] = ends[apart - 1] = True
        s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        up, down = _powers(2 * CHUNK_BYTES if len(part) <= 2 * CHUNK_BYTES else 1 << len(part).bit_length())
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_byte_values()[part] * up[: len(part)], out=sums[1:])
        hashes.append(mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)))
        starts_of.append(s + first)
        ends_of.append(e + first)
        counts += np.bincount(np.searchsorted(offsets, s + first, "right") - 1, minlength=len(counts))
        first = last
    if not hashes:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none, none, counts
    return np.concatenate(hashes), np.concatenate(starts_of), np.concatenate(ends_of), counts


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, text by text, and the number of words of each text."""
    hashes, _, _, counts = find_words(texts)
    return hashes, counts


def _cut(data: np.ndarray, offsets: np.ndarray, at: int) -> int:
    """The first place from ``at`` on that is inside no word."""
    if at >= len(data):
        return len(data)
    border = int(offsets[np.searchsorted(offsets, at)])
    while at < border:
        blank = np.flatnonzero(_BLANK[data[at : min(at + 4096, border)]])
        if len(blank):
            return at + int(blank[0])
        at = min(at + 4096, border)
    return border
