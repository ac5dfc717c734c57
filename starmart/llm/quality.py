"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

score = sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pairwise part is computed in
time linear in the features by ``1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``.

Features of a text: its distinct words in 2^14 hashed buckets (square roots of counts, scaled to
length 1 together) and ``STATISTICS`` (shape of words, lines and characters; the length of the text
is the metadata). Nothing else is an input. A null or empty text has no words and the statistics of
an empty text; it gets a score like any other.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from starmart.llm.tables import batches_of, bytes_and_offsets, name
from starmart.llm.words import hashed_words

BUCKETS = 1 << 14
FACTORS = 8
#: At most so many labelled rows are learned from, those with the smallest hashes of their id.
TRAIN_ROWS = 6000
THRESHOLD = 0.7

STATISTICS = (
    "log_bytes",
    "log_words",
    "letters",
    "capitals",
    "digits",
    "punctuation",
    "symbols",
    "bars",
    "blanks",
    "bytes_per_word",
    "distinct_words",
    "repeated_next",
    "most_frequent_word",
    "words_per_line",
    "sentence_ends",
    "doubled_punctuation",
)
FEATURES = BUCKETS + len(STATISTICS)
_BATCH_BYTES = 4 << 20


def _class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


_LETTER = _class((65, 90), (97, 122), (128, 255))
_CAPITAL = _class((65, 90))
_DIGIT = _class((48, 57))
_ENDING = _class((33, 33), (46, 46), (63, 63))
_PUNCTUATION = _class((33, 34), (39, 41), (44, 46), (58, 59), (63, 63))
_SYMBOL = _class((35, 38), (42, 43), (47, 47), (60, 62), (64, 64), (91, 96), (123, 126))
_BAR = _class((124, 124))
_BLANK = _class((9, 13), (32, 32))
_LINE = _class((10, 10))


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices and values of the features of all texts, and the end of each text in them."""
    n = len(texts)
    data, offsets = bytes_and_offsets(texts)
    hashes, words = hashed_words(texts)
    doc = np.repeat(np.arange(n), words)

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)

    size = np.diff(offsets).astype(float)
    some, some_words = np.maximum(size, 1), np.maximum(words, 1)
    mark = _PUNCTUATION[data] | _SYMBOL[data]
    doubled = np.zeros(len(data), bool)
    doubled[1:] = mark[1:] & mark[:-1]
    # Words of one text in the order of their hashes: distinct ones, and the longest run.
    order = np.lexsort((hashes, doc))
    ranked, ranked_doc = hashes[order], doc[order]
    new = np.ones(len(ranked), bool)
    new[1:] = (ranked[1:] != ranked[:-1]) | (ranked_doc[1:] != ranked_doc[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(ranked)))
    owner = ranked_doc[first]
    most = np.zeros(n)
    np.maximum.at(most, owner, counts)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    statistics = np.stack(
        [
            np.log1p(size) / 6 - 1,
            np.log1p(words) / 5 - 1,
            per_text(_LETTER[data]) / some * 2 - 1.5,
            np.minimum(per_text(_CAPITAL[data]) / some * 4, 2),
            np.minimum(per_text(_DIGIT[data]) / some * 8, 2),
            np.minimum(per_text(_PUNCTUATION[data]) / some * 8, 2),
            np.minimum(per_text(_SYMBOL[data]) / some * 16, 2),
            np.minimum(per_text(_BAR[data]) / some * 16, 2),
            per_text(_BLANK[data]) / some * 4 - 0.7,
            np.minimum(size / some_words / 6, 4) - 1,
            np.bincount(owner, minlength=n) / some_words * 2 - 1,
            np.bincount(doc[same], minlength=n) / some_words * 3,
            most / some_words * 3,
            np.log1p(words / (per_text(_LINE[data]) + 1)) / 3 - 1,
            np.minimum(per_text(_ENDING[data]) / some_words * 4, 3),
            np.minimum(per_text(doubled) / some * 16, 2),
        ],
        axis=1,
    ).astype(np.float32)

    bucket = (ranked[first] % np.uint64(BUCKETS)).astype(np.int64)
    keys, where = np.unique(owner * BUCKETS + bucket, return_inverse=True)
    weight = np.sqrt(np.bincount(where, weights=counts, minlength=len(keys)))
    key_doc = keys // BUCKETS
    length = np.sqrt(np.bincount(key_doc, weights=weight**2, minlength=n))
    weight = weight / length[key_doc]
    per = np.bincount(key_doc, minlength=n) + len(STATISTICS)
    ends = np.cumsum(per)
    indices = np.empty(ends[-1] if n else 0, np.int32)
    values = np.empty(len(indices), np.float32)
    place = np.arange(len(keys)) + key_doc * len(STATISTICS)
    indices[place], values[place] = keys % BUCKETS, weight
    tail = (ends[:, None] - len(STATISTICS) + np.arange(len(STATISTICS))).ravel()
    indices[tail] = np.tile(np.arange(BUCKETS, FEATURES, dtype=np.int32), n)
    values[tail] = statistics.ravel()
    return indices, values, ends


@dataclass(frozen=True)
class FactorisationMachine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    @property
    def learned(self) -> bool:
        """Whether any example has changed it: factors start at random, weights at 0."""
        return bool(self.weights.any())

    def logits(self, indices: np.ndarray, values: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """By the sum-of-squares identity: one pass over the features of each text."""
        if not len(ends):
            return np.empty(0)
        starts = np.concatenate(([0], ends[:-1]))
        scaled = self.factors[indices] * values[:, None]
        sums = np.add.reduceat(scaled, starts)
        squares = np.add.reduceat(scaled * scaled, starts)
        linear = np.add.reduceat(self.weights[indices] * values, starts)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1)

    def scores(self, texts: pa.Array) -> np.ndarray:
        logits = self.logits(*features(texts)).astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(logits, -40, 40)))


def train(
    indices: list[np.ndarray],
    values: list[np.ndarray],
    labels: np.ndarray,
    epochs: int = 12,
    batch: int = 64,
    rate: float = 0.02,
    decay: float = 1e-5,
    seed: int = 7,
) -> FactorisationMachine:
    """Logistic loss by Adam over small batches. Without both labels the score is the share of ones."""
    share = float(np.clip(labels.mean(), 0.01, 0.99)) if len(labels) else 0.5
    random = np.random.default_rng(seed)
    table = np.zeros((FEATURES, FACTORS + 1))
    bias = np.log(share / (1 - share))
    if 0.01 < share < 0.99:
        table[:, 1:] = random.normal(0, 0.05, (FEATURES, FACTORS))
        first, second = np.zeros_like(table), np.zeros_like(table)
        step = 0
        for epoch in range(epochs):
            order = random.permutation(len(labels))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                flat = np.concatenate([indices[r] for r in rows])
                x = np.concatenate([values[r] for r in rows]).astype(np.float64)
                sizes = np.array([len(indices[r]) for r in rows])
                starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
                scaled = table[flat, 1:] * x[:, None]
                sums = np.add.reduceat(scaled, starts)
                squares = np.add.reduceat(scaled * scaled, starts)
                linear = np.add.reduceat(table[flat, 0] * x, starts)
                logits = bias + linear + 0.5 * (sums**2 - squares).sum(axis=1)
                error = 1 / (1 + np.exp(-np.clip(logits, -40, 40))) - labels[rows]
                each = np.repeat(error / len(rows), sizes) * x
                used, where = np.unique(flat, return_inverse=True)
                gradient = np.zeros((len(used), FACTORS + 1))
                pair = each[:, None] * (np.repeat(sums, sizes, axis=0) - scaled)
                for f in range(FACTORS):
                    gradient[:, f + 1] = np.bincount(where, pair[:, f], len(used))
                gradient[:, 0] = np.bincount(where, each, len(used))
                gradient += decay * table[used]
                step += 1
                first[used] = 0.9 * first[used] + 0.1 * gradient
                second[used] = 0.99 * second[used] + 0.01 * gradient**2
                pace = rate / (1 + epoch / 4)
                rise = np.sqrt(second[used] / (1 - 0.99**step)) + 1e-8
                table[used] -= pace * first[used] / (1 - 0.9**step) / rise
                bias -= pace * error.mean()
    return FactorisationMachine(
        float(bias), table[:, 0].astype(np.float32), table[:, 1:].astype(np.float32)
    )


def held_out(id_column: Column) -> Column:
    """True for the quarter of ids that is never learned from; a null id is not held out."""
    text = id_column.cast("string")
    return F.coalesce(F.pmod(F.crc32(F.encode(text, "utf-8")), F.lit(4)) == 2, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows: int = TRAIN_ROWS,
) -> FactorisationMachine:
    """Learn from at most ``rows`` labelled documents that are not held out.

    Rows without id or label are no examples. Several labels of an id count as their smallest. Of the
    rows that repeat an id one is the example, that of the least hash of its text, then of the least
    text, so no id brings more than one however often it occurs.
    """
    chosen = (
        labels.select(name(id_column).alias("id"), name(label).cast("double").alias("label"))
        .filter("id IS NOT NULL AND label IN (0, 1)")
        .filter(~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(rows)
    )
    examples = (
        docs.select(name(id_column).alias("id"), name(text).alias("text"))
        .join(F.broadcast(chosen), "id")
        .groupBy("id")
        .agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("least"), F.first("label").alias("label"))
        .select("id", F.col("least.text").alias("text"), "label")
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, "text", _BATCH_BYTES):
                indices, values, ends = features(part["text"])
                starts = np.concatenate(([0], ends[:-1])).astype(int)
                yield pa.RecordBatch.from_pydict(
                    {
                        "label": part["label"],
                        "indices": pa.array([indices[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                        "values": pa.array([values[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    }
                )

    found = examples.mapInArrow(extract, "label double, indices binary, values binary").collect()
    # A fixed order, whatever task answered first.
    found.sort(key=lambda row: (bytes(row["indices"]), bytes(row["values"]), row["label"]))
    return train(
        [np.frombuffer(row["indices"], np.int32) for row in found],
        [np.frombuffer(row["values"], np.float32) for row in found],
        np.array([row["label"] for row in found]),
    )


def score_quality(
    docs: DataFrame,
    model: FactorisationMachine,
    text: str = "text",
    score: str = "score",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """``columns`` of ``docs`` (all by default) and the score of each whole text, row by row.

    No row moves between tasks. A column that is already called ``score`` is replaced.
    """
    kept = [c for c in (docs.columns if columns is None else columns) if c != score]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, text, _BATCH_BYTES):
                found = pa.array(shared.value.scores(part[text]), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [*(part[c] for c in kept), found], names=[*kept, score]
                )

    read = docs.select(*[name(c) for c in dict.fromkeys([*kept, text])])
    schema = StructType([docs.schema[c] for c in kept] + [StructField(score, DoubleType())])
    return read.mapInArrow(run, schema)
