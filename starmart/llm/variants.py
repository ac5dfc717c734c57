"""Spelling variants by reduced-alphabet generation.

Every letter is hashed to one of a few symbols, so a word becomes a reduced word of the same length.
Words that differ by one inserted, deleted or replaced letter have reduced words that differ by one
such edit or not at all. So for each word the one-edit neighbourhood of its reduced word is generated
and joined with the reduced words of the vocabulary; the letters that an edit could bring in are six
symbols and not a whole alphabet. What the join brings together is verified on the original words.

Each edit is generated from one of its two sides: a replacement from the side with the smaller
symbol, an insertion as a deletion from the longer word. Together these are the full neighbourhoods,
and every candidate comes once.

A reduced word is known by a 64-bit polynomial hash, from which the hash of each edit follows in
constant time. Before strings are compared, the parities of the letters of both words must differ in
two bits at most, as they do after one edit.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.tables import batches_of, materialize, name
from starmart.llm.words import mix

#: Symbols of the reduced alphabet.
SYMBOLS = 6
MIN_LENGTH = 7
MIN_COUNT = 2
#: How many times as frequent a word's form must be.
RATIO = 10
#: A run whose checksum this divides loses a letter.
DELETE_EVERY = 31

#: Fixed value: the letters of words, after A-Z have become a-z.
LETTERS = re.compile("[a-zÀ-ÿ]+")

_BASE = 0x9E3779B97F4A7C15
_LENGTH = 0xD6E8FEB86659FD93
_SLICE_BYTES = 2 << 20
_HELD_WORDS = 300_000
#: Letters whose edits are made at once.
_BLOCK = 1 << 18


def _word_counts(part: pa.RecordBatch, found: Counter) -> None:
    texts = pc.ascii_lower(pc.fill_null(part.column("text"), "")).to_pylist()
    for doc_id, text in zip(part.column("id").to_pylist(), texts):
        if len(text) < 1 << 20:
            runs = Counter(LETTERS.findall(text))
        else:
            runs = Counter(match.group() for match in LETTERS.finditer(text))
        start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
        for run, n in runs.items():
            checksum = zlib.crc32(run.encode(), start)
            if not checksum % DELETE_EVERY:
                at = checksum % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += n


def word_counts(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT
) -> DataFrame:
    """(word, n): the words of all texts, after the deletions, with their number of occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for part in batches_of(batch, "text", _SLICE_BYTES):
                _word_counts(part, found)
                if len(found) > _HELD_WORDS:
                    yield _counts(found)
                    found = Counter()
        yield _counts(found)

    def _counts(found: Counter) -> pa.RecordBatch:
        words = [word for word in found if len(word) >= min_length]
        return pa.record_batch({"word": pa.array(words, pa.string()), "n": pa.array([found[w] for w in words], pa.int64())})

    texts = df.select(name(id_column).cast("string").alias("id"), name(text).alias("text"))
    partial = texts.mapInArrow(count, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _symbols(codes: np.ndarray) -> np.ndarray:
    return mix((codes.astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE)) % np.uint64(SYMBOLS)


def _powers(base: int, first: int, size: int) -> np.ndarray:
    """base^first, base^(first + 1) and so on, modulo 2^64."""
    found = np.full(size, base, np.uint64)
    found[:1] = pow(base, first, 1 << 64)
    return np.multiply.accumulate(found)


def _key(total: np.ndarray, length: np.ndarray) -> np.ndarray:
    return mix(total + length.astype(np.uint64) * np.uint64(_LENGTH)).view(np.int64)


def _blocks(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The words in groups: number of the first one, letters of the group, and its words' ends."""
    first, held, ends = 0, [], []
    size = 0
    for number, word in enumerate(words):
        held.append(np.frombuffer(word.encode("utf-32-le"), np.uint32))
        size += len(word)
        ends.append(size)
        if size >= _BLOCK or number == len(words) - 1:
            yield first, np.concatenate(held), np.array(ends)
            first, held, ends, size = number + 1, [], [], 0


def _sums(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each letter its symbol, its place, its power and the hash of what precedes it; hashes of words."""
    starts = np.concatenate([[0], ends[:-1]])
    size = ends - starts
    place = np.arange(len(codes)) - np.repeat(starts, size)
    symbol = _symbols(codes)
    power = _powers(_BASE, 0, int(size.max(initial=1)))[place]
    run = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((symbol + np.uint64(1)) * power, out=run[1:])
    before = run[:-1] - np.repeat(run[starts], size)
    return symbol, size, power, before, run[ends] - run[starts]


def reduced_keys(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The key of each word's reduced word, and the parities of its letters as 32 bits."""
    keys, parities = [np.empty(0, np.int64)], [np.empty(0, np.int32)]
    for _, codes, ends in _blocks(words):
        _, size, _, _, total = _sums(codes, ends)
        keys.append(_key(total, size))
        bit = np.uint32(1) << (mix(codes.astype(np.uint64) * np.uint64(_LENGTH)) % np.uint64(32)).astype(np.uint32)
        parities.append(np.bitwise_xor.reduceat(bit, np.concatenate([[0], ends[:-1]])).view(np.int32))
    return np.concatenate(keys), np.concatenate(parities)


def neighbourhoods(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Number of a word and key of one of its reduced edits, for all edits; last: whether it is itself."""
    for first, codes, ends in _blocks(words):
        symbol, size, power, before, total = _sums(codes, ends)
        yield np.arange(first, first + len(size)), _key(total, size), True
        whole, word = np.repeat(total, size), np.repeat(np.arange(len(size)), size)
        # Of a run of equal symbols any deletion gives the same word: the first one is made.
        distinct = np.ones(len(codes), bool)
        distinct[1:] = symbol[1:] != symbol[:-1]
        distinct[ends[:-1]] = True
        inverse = np.uint64(pow(_BASE, -1, 1 << 64))
        own = (symbol + np.uint64(1)) * power
        shorter = before + (whole - before - own) * inverse
        yield word[distinct] + first, _key(shorter[distinct], size[word[distinct]] - 1), False
        for other in range(1, SYMBOLS):
            lower = symbol < other
            changed = whole[lower] + (np.uint64(other) - symbol[lower]) * power[lower]
            yield word[lower] + first, _key(changed, size[word[lower]]), False


def _vocabulary(words: DataFrame) -> DataFrame:
    """(id, word, n, key, parity) as a scratch table."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, "word", _SLICE_BYTES):
                keys, parities = reduced_keys(part.column("word").to_pylist())
                yield pa.record_batch(
                    [*part.columns, pa.array(keys), pa.array(parities)], names=["word", "n", "key", "parity"]
                )

    found = words.mapInArrow(reduce, "word string, n long, key long, parity int")
    return materialize(found.withColumn("id", F.monotonically_increasing_id()), "vocabulary")


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(a, b, word_a, n_a, word_b, n_b): each two words that differ by exactly one edit, once."""

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, "word", _SLICE_BYTES):
                ids, parities = part.column("id"), part.column("parity")
                for which, keys, same in neighbourhoods(part.column("word").to_pylist()):
                    own = pa.array(which)
                    yield pa.record_batch(
                        {
                            "key": pa.array(keys),
                            "a": ids.take(own),
                            "p": parities.take(own),
                            "same": pa.array(np.full(len(keys), same)),
                        }
                    )

    edits = vocabulary.select("id", "word", "parity").mapInArrow(generate, "key long, a long, p int, same boolean")
    reduced = vocabulary.select("key", F.col("id").alias("b"), F.col("parity").alias("q"))
    candidates = edits.join(reduced, "key").filter(
        (F.bit_count(F.col("p").bitwiseXOR(F.col("q"))) <= 2) & (~F.col("same") | (F.col("a") < F.col("b")))
    )
    words = [
        vocabulary.select(F.col("id").alias(end), F.col("word").alias(f"word_{end}"), F.col("n").alias(f"n_{end}"))
        for end in ("a", "b")
    ]
    both = candidates.select("a", "b").join(words[0], "a").join(words[1], "b")
    return both.filter(F.levenshtein("word_a", "word_b", 1) == 1)


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: forms are followed in steps that double."""
    roots = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        # A form has at least RATIO times the count of its word, so chains are short.
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = roots.join(ahead, "root", "left")
        if not longer.filter("next IS NOT NULL").take(1):
            return roots
        roots = materialize(longer.select("word", F.coalesce("next", "root").alias("root")), "roots")


def group_variants(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
) -> DataFrame:
    """The words of a text column with the more frequent spellings they are variants of.

    One row per word of at least ``min_length`` letters and ``min_count`` occurrences: ``word``,
    ``n`` (occurrences), ``n_near`` (words one edit away), ``form`` (the most frequent of these, of ties
    the smallest, if it is at least ``ratio`` times as frequent, else NULL), ``form_n`` (its n) and
    ``root`` (the last of the forms of forms, the word itself if it has none).

    Null and empty texts have no words. Every row is a document of its own, repeated ones too; a null
    id counts as empty text in the checksum. A table without words gives an empty result. Words and
    texts may be of any length; a text is held by one task. Other columns are not looked at.
    """
    vocabulary = _vocabulary(word_counts(df, id_column, text, min_length, min_count))
    pairs = materialize(near_words(vocabulary), "near-words")
    ends = pairs.select(F.col("a").alias("id"), F.col("word_b").alias("near"), F.col("n_b").alias("near_n")).unionAll(
        pairs.select(F.col("b").alias("id"), F.col("word_a").alias("near"), F.col("n_a").alias("near_n"))
    )
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = ends.groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), best)
    is_form = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    words = vocabulary.join(near, "id", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, -F.col("best.less")).alias("form_n"),
    )
    words = materialize(words, "variants")
    roots = _roots(words.filter("form IS NOT NULL"))
    return words.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
