"""Token ids of whole texts with a public tokenizer, each distinct word encoded once for a worker.

The tokenizer of ``word_bpe_49k.json`` drops white space and never joins what stands on its two
sides: white space is no part of its pre-tokens, and neither its normal form (NFC, lower case, one
character at a time) nor its special tokens reach across it. So the ids of a text are the ids of
its blank-separated words one after the other. The same holds for a comma or full stop after a
letter or digit at the end of a word: it begins a pre-token. A test holds this against whole texts.

Words are looked up by the 64-bit hash of their lower-case bytes. Words of more than 64 bytes, and
those with ``<|`` in them, which may be special tokens in one case only, are encoded each time.
"""

from __future__ import annotations

import ctypes
import ctypes.util
import os
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa

from starmart.llm.tables import bytes_and_offsets
from starmart.llm.words import find_words

END_ID = 1

_CACHE_WORDS = 2_000_000
_CACHED_BYTES = 64


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Known:
    """Ids of words by hash: arrays sorted by hash, the recent ones apart until they are many."""

    def __init__(self) -> None:
        self.pool = np.empty(0, np.uint32)
        self._parts = [self._empty(), self._empty()]

    @staticmethod
    def _empty() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int32)

    def __len__(self) -> int:
        return sum(len(part[0]) for part in self._parts)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start in the pool (-1 for unknown) and number of ids of each word."""
        start, size = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int32)
        for keys, starts, sizes in self._parts:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                hit = keys[at] == hashes
                start[hit], size[hit] = starts[at[hit]], sizes[at[hit]]
        return start, size

    def add(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Take words that are not known; ``hashes`` ascend."""
        starts = len(self.pool) + np.cumsum(sizes) - sizes
        self.pool = np.concatenate((self.pool, ids))
        self._parts[1] = self._merged(self._parts[1], (hashes, starts, sizes.astype(np.int32)))
        if len(self._parts[1][0]) > len(self._parts[0][0]) // 4:
            self._parts = [self._merged(*self._parts), self._empty()]

    @staticmethod
    def _merged(a: tuple, b: tuple) -> tuple:
        order = np.argsort(np.concatenate((a[0], b[0])), kind="stable")
        return tuple(np.concatenate(pair)[order] for pair in zip(a, b))


class WordEncoder:
    """Ids of texts; once the cache is full, other words are encoded batch by batch."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._known = _Known()

    def _encode_words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all the words one after the other, and how many each word has.

        Words are encoded 4096 at a time as one text, joined by blanks: no pre-token holds white
        space, so each word gets the ids it gets alone, and the offset of an id tells its word.
        """
        raw = memoryview(data)
        words = [str(raw[s:e], "utf-8", "replace") for s, e in zip(starts.tolist(), ends.tolist())]
        ids, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for at in range(0, len(words), 4096):
            some = words[at : at + 4096]
            lengths = np.fromiter(map(len, some), np.int64, len(some)) + 1
            begins = np.cumsum(lengths) - lengths
            encoded = self._tokenizer.encode(" ".join(some), add_special_tokens=False)
            firsts = np.fromiter((offset[0] for offset in encoded.offsets), np.int64, len(encoded.offsets))
            ids.append(np.array(encoded.ids, np.uint32))
            sizes.append(np.bincount(np.searchsorted(begins, firsts, "right") - 1, minlength=len(some)))
        return np.concatenate(ids), np.concatenate(sizes).astype(np.int64)

    def encode(self, texts: pa.Array, end: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text by text with ``end`` after each, and where each text ends; null is empty."""
        data, _ = bytes_and_offsets(texts)
        hashes, starts, ends, counts = find_words(texts, split_marks=True)
        direct = ends - starts > _CACHED_BYTES
        marks = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C)) if len(data) else data
        if len(marks):
            direct[np.searchsorted(starts, marks, "right") - 1] = True

        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        cached = np.zeros(len(distinct), bool)
        cached[which[~direct]] = True
        first[which[~direct][::-1]] = np.flatnonzero(~direct)[::-1]
        place, size = self._known.find(distinct)
        new = np.flatnonzero(cached & (place < 0))
        alone = np.flatnonzero(direct)
        fresh, sizes = self._encode_words(
            data,
            np.concatenate((starts[first[new]], starts[alone])),
            np.concatenate((ends[first[new]], ends[alone])),
        )

        # One pool for this call: the end id, what was known, what is new.
        base = 1 + len(self._known.pool)
        fresh_at = base + np.cumsum(sizes) - sizes
        pool = np.concatenate((np.array([end], np.uint32), self._known.pool, fresh))
        place += 1
        place[new], size[new] = fresh_at[: len(new)], sizes[: len(new)]
        word_at, word_size = place[which], size[which].astype(np.int64)
        word_at[alone], word_size[alone] = fresh_at[len(new) :], sizes[len(new) :]
        if len(self._known) + len(new) <= _CACHE_WORDS:
            self._known.add(distinct[new], fresh[: sizes[: len(new)].sum()], sizes[: len(new)])

        last_word = np.cumsum(counts)
        word_at = np.insert(word_at, last_word, 0)
        word_size = np.insert(word_size, last_word, 1)
        stops = np.cumsum(word_size)
        index = np.repeat(word_at - (stops - word_size), word_size) + np.arange(stops[-1] if len(stops) else 0)
        found = pool[index], stops[last_word + np.arange(len(counts))]
        del pool, index, word_at, word_size, hashes, starts, ends, which
        release_memory()
        return found


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL(ctypes.util.find_library("c") or "libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return None


def release_memory() -> None:
    """Give the memory that the arrays of a call have freed back to the system.

    The C library keeps freed blocks below its mmap threshold in the heap, and the many arrays of a
    call leave it in pieces: a worker grew by about 150 MB more than its cache over a third of
    check_l. Where ``malloc_trim`` exists (glibc), that is returned after each call.
    """
    trim = _trim()
    if trim is not None:
        trim(0)


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker; it stays from task to task."""
    return WordEncoder(path)
