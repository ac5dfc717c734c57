"""Token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton of the pieces gives, at every end, all pieces that end there. Dynamic
programming over the ends carries the best score and the number of tokens of the best segmentation,
never the segmentation itself. Ties are those of the exact algorithm, which extends segmentations
from left to right and replaces a candidate only by a strictly better one: of equal scores the
piece that starts first wins. A character that is no piece costs ten less than the lowest score and
counts one token for each UTF-8 byte (byte fallback).

No piece has the space mark after another character, so a text is cut before every run of marks and
the parts are independent; scores are whole numbers and add exactly in doubles. Each distinct part
is counted once for a worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from starmart.llm.tables import batches_of, name

MARK = "▁"
UNKNOWN_PENALTY = 10.0

_PART = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_CACHED_LENGTH = 64
_CACHE_PARTS = 300_000
_BATCH_BYTES = 4 << 20


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_vocabulary(path: str) -> dict[str, float]:
    """Pieces and scores of a sentencepiece file; control, unknown and byte pieces are left out."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    left_out = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    return {
        model.id_to_piece(i): float(model.get_score(i))
        for i in range(model.vocab_size())
        if not any(test(i) for test in left_out)
    }


class UnigramCounter:
    def __init__(self, vocabulary: dict[str, float]):
        if any(MARK in piece.lstrip(MARK) for piece in vocabulary):
            raise ValueError("a piece holds the space mark after another character")
        if any(score != int(score) for score in vocabulary.values()):
            raise ValueError("scores must be whole numbers, so that they add exactly")
        self._automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.items():
            self._automaton.add_word(piece, (len(piece), score))
        if vocabulary:
            self._automaton.make_automaton()
        self._any = bool(vocabulary)
        self._unknown = min(vocabulary.values(), default=0.0) - UNKNOWN_PENALTY
        self._known: dict[str, int] = {}

    def count_part(self, part: str) -> int:
        """Tokens of the best segmentation of a text without a place to cut."""
        size = len(part)
        best, count = [0.0] * (size + 1), [0] * (size + 1)
        unknown = self._unknown

        def settle(end: int, found: list[tuple[int, float]]) -> None:
            # Longest first: the piece that starts first is kept on a tie.
            top = tokens = None
            alone = False
            for length, score in found:
                start = end - length
                reached = best[start] + score
                if top is None or reached > top:
                    top, tokens = reached, count[start] + 1
                alone = alone or length == 1
            if not alone:
                reached = best[end - 1] + unknown
                if top is None or reached > top:
                    top, tokens = reached, count[end - 1] + len(part[end - 1].encode("utf-8", "replace"))
            best[end], count[end] = top, tokens

        ending: list[tuple[int, float]] = []
        at = 0
        for last, piece in self._automaton.iter(part) if self._any else ():
            end = last + 1
            if end != at:
                if at:
                    settle(at, ending)
                for between in range(at + 1, end):
                    settle(between, [])
                at, ending = end, []
            ending.append(piece)
        if at:
            settle(at, ending)
        for between in range(at + 1, size + 1):
            settle(between, [])
        return count[size]

    def count(self, text: str | None) -> int:
        """Tokens of a text: a space mark stands before it and for each space; none if it is empty."""
        if not text:
            return 0
        known, total = self._known, 0
        for part in _PART.findall(MARK + text.replace(" ", MARK)):
            found = known.get(part)
            if found is None:
                found = self.count_part(part)
                if len(part) <= _CACHED_LENGTH and len(known) < _CACHE_PARTS:
                    known[part] = found
            total += found
        return total

    def count_all(self, texts: Iterable[str | None]) -> list[int]:
        return [self.count(text) for text in texts]


@lru_cache(maxsize=2)
def counter(path: str) -> UnigramCounter:
    """One counter for each Python worker; it stays from task to task."""
    return UnigramCounter(read_vocabulary(path))


def count_tokens(
    docs: DataFrame,
    text: str = "text",
    n_tokens: str = "n_tokens",
    columns: list[str] | None = None,
    vocabulary: str | None = None,
) -> DataFrame:
    """``columns`` of ``docs`` (all by default) and the number of tokens of each whole text.

    A null or empty text has none. A column that is already called ``n_tokens`` is replaced.
    """
    kept = [c for c in (columns or docs.columns) if c != n_tokens]
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, text, _BATCH_BYTES):
                found = np.array(counter(path).count_all(part[text].to_pylist()), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(part[c] for c in kept), pa.array(found)], names=[*kept, n_tokens]
                )

    read = docs.select(*[name(c) for c in dict.fromkeys([*kept, text])])
    schema = StructType([docs.schema[c] for c in kept] + [StructField(n_tokens, LongType())])
    return read.mapInArrow(run, schema)
