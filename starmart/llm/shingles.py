"""Sets of word shingles as sorted arrays of 64-bit hashes, for whole batches of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from starmart.llm.words import hashed_words, mix

WORDS = 5

_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)


def shingle_sets(texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """For each text the ascending hashes of its distinct shingles of ``words`` words.

    A text with fewer words has the whole sequence as its one shingle; one without words has none.
    """
    hashes, counts = hashed_words(texts)
    joined = np.zeros(len(hashes), np.uint64)
    for k in range(words):
        # The hash of a shingle depends on the order of its words.
        ahead = np.zeros(len(hashes), np.uint64)
        ahead[: max(0, len(hashes) - k)] = hashes[k:]
        joined = mix(joined * np.uint64(_FACTORS[k % 4]) + ahead + np.uint64(k))
    first = 0
    for count in counts.tolist():
        if count >= words:
            found = np.sort(joined[first : first + count - words + 1])
            new = np.ones(len(found), bool)
            np.not_equal(found[1:], found[:-1], out=new[1:])
            yield found[new]
        elif count:
            short = np.full(1, count, np.uint64)
            for one in hashes[first : first + count]:
                short = mix(short * np.uint64(_FACTORS[0]) + one)
            yield short
        else:
            yield np.empty(0, np.uint64)
        first += count


def fingerprint(found: np.ndarray) -> int:
    """64 bits that tell sets apart; the same for equal sets."""
    if not len(found):
        return 0
    folded = mix(np.array([mix(found).sum(dtype=np.uint64), len(found)], np.uint64))
    return int(mix(folded[:1] * np.uint64(_FACTORS[1]) + folded[1:]).view(np.int64)[0])


