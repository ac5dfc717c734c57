"""Best-fit packing of token sequences.

Best-fit decreasing over all pieces of the corpus: longest first, each into the open bin with the
least room that still holds it. Pieces of one length are alike to the rule and so are bins with the
same room, so the plan needs nothing but the number of pieces of each length: at most ``capacity``
counts, whatever the size of the corpus. A segment tree over the remaining capacities finds the
tightest open bin in time logarithmic in the capacity, for a run of equal bins at once.

A run is emptied at most log2(capacity) times (each time at least half of its room goes) and a
length makes at most four new ones, which bounds the plan too. Where a piece goes follows from its
number among the pieces of its length, which Spark finds without gathering a length in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from starmart.llm.ordinals import with_ordinals
from starmart.llm.tables import batches_of, materialize, name
from starmart.llm.tokens import END_ID, default_tokenizer, encoder

CAPACITY = 4096
_BATCH_BYTES = 4 << 20


class OpenBins:
    """Runs of bins with equal room, and a segment tree that tells which rooms are open."""

    def __init__(self, capacity: int):
        self._leaves = 1 << capacity.bit_length()
        self._open = np.zeros(2 * self._leaves, bool)
        self._runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, first: int, count: int) -> None:
        if count:
            self._runs[room].append((first, count))
            self._mark(room)

    def _mark(self, room: int) -> None:
        node = self._leaves + room
        self._open[node] = bool(self._runs[room])
        while node > 1:
            node //= 2
            self._open[node] = self._open[2 * node] or self._open[2 * node + 1]

    def take_tightest(self, length: int) -> tuple[int, int, int] | None:
        """Remove and return a run (room, first bin, bins) of the least room >= ``length``."""
        node = self._leaves + length
        if not self._open[node]:
            while node > 1 and (node & 1 or not self._open[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self._leaves:
                node = 2 * node if self._open[2 * node] else 2 * node + 1
        room = node - self._leaves
        first, count = self._runs[room].pop()
        self._mark(room)
        return room, first, count


@dataclass(frozen=True)
class Plan:
    """Pieces ``first`` and following of a length go ``each`` to a bin from ``bin`` on, at ``offset``."""

    length: np.ndarray
    first: np.ndarray
    bin: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    bins: int

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of the pieces with these numbers among those of their length."""
        row = np.empty(len(length), np.int64)
        starts = np.searchsorted(self.length, -length, "left")
        ends = np.searchsorted(self.length, -length, "right")
        for key in np.unique(length):
            mine = length == key
            a, b = starts[mine][0], ends[mine][0]
            row[mine] = a + np.searchsorted(self.first[a:b], number[mine], "right") - 1
        along = number - self.first[row]
        return self.bin[row] + along // self.each[row], self.offset[row] + along % self.each[row] * length


def plan_best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing for ``counts[length]`` pieces of each length from 1 to ``capacity``."""
    open_bins, bins, rows = OpenBins(capacity), 0, []
    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is not in 1..{capacity}")
        done, left = 0, counts[length]
        while left:
            run = open_bins.take_tightest(length)
            if run is None:
                # A new bin is opened only when none fits; all that are opened for this length are alike.
                count = -(-left // (capacity // length))
                run = (capacity, bins, count)
                bins += count
            room, first, count = run
            each = room // length
            # Of bins with the same room, one is filled as far as it goes before the next is begun.
            full = min(count, left // each)
            rest = left - full * each if full < count else 0
            rows.append((-length, done, first, each, capacity - room))
            open_bins.add(room - each * length, first, full)
            if rest:
                open_bins.add(room - rest * length, first + full, 1)
            untouched = first + full + (rest > 0)
            open_bins.add(room, untouched, first + count - untouched)
            done += full * each + rest
            left -= full * each + rest
    table = np.array(rows, np.int64).reshape(-1, 5)
    return Plan(*(table[:, i].copy() for i in range(5)), bins)


def token_pieces(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    keep_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every piece, with ``ids`` on demand.

    A document is its ids and then the end id 1; a null or empty text is the end id alone. Only a
    document of more than ``capacity`` ids is cut, into pieces of ``capacity`` and a rest.
    """
    path = tokenizer or default_tokenizer()
    fields = [
        StructField("piece", IntegerType()),
        StructField("start", LongType()),
        StructField("length", LongType()),
        StructField("ids_crc32", LongType()),
    ] + [StructField("ids", BinaryType())] * keep_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, "text", _BATCH_BYTES):
                ids, stops = encoder(path).encode(part["text"], END_ID)
                whole = np.diff(stops, prepend=0)
                row = np.repeat(np.arange(len(whole)), -(-whole // capacity))
                piece = np.arange(len(row)) - np.searchsorted(row, row)
                start = piece * capacity
                length = np.minimum(whole[row] - start, capacity)
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                places = 4 * (stops[row] - whole[row] + start)
                spans = [raw[a : a + 4 * n] for a, n in zip(places.tolist(), length.tolist())]
                columns = {
                    "id": part["id"].take(pa.array(row)),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(span) for span in spans], pa.int64()),
                }
                if keep_ids:
                    columns["ids"] = pa.array([bytes(span) for span in spans], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    chosen = docs.select(name(id_column).alias("id"), name(text).alias("text"))
    schema = StructType([StructField("id", docs.schema[id_column].dataType), *fields])
    return chosen.mapInArrow(cut, schema).withColumnRenamed("id", id_column)


def pack_best_fit(
    pieces: DataFrame, keys: list[str], length: str = "length", capacity: int = CAPACITY
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: best-fit decreasing over all of them.

    ``keys`` identify a piece; they only deal equal lengths over tasks. Every length must be from 1
    to ``capacity``. Columns that are already called like the new ones are replaced.
    """
    pieces = pieces.drop("sequence_id", "offset")
    found = pieces.groupBy(name(length).cast("long").alias("length")).count().collect()
    plan = plan_best_fit({row["length"]: row["count"] for row in found}, capacity)
    shared = pieces.sparkSession.sparkContext.broadcast(plan)
    numbered = with_ordinals(pieces, length, [name(k) for k in keys], "__number")
    kept = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, offsets = shared.value.place(
                np.asarray(batch[length], np.int64), np.asarray(batch["__number"], np.int64)
            )
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in kept), pa.array(bins), pa.array(offsets)],
                names=[*kept, "sequence_id", "offset"],
            )

    schema = StructType(
        [pieces.schema[c] for c in kept]
        + [StructField("sequence_id", LongType()), StructField("offset", LongType())]
    )
    return numbered.mapInArrow(place, schema)


def pack_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents and their places; texts are encoded once and kept in a scratch table."""
    pieces = materialize(token_pieces(docs, id_column, text, capacity, tokenizer, keep_ids), "pieces")
    return pack_best_fit(pieces, [id_column, "piece", "ids_crc32"], capacity=capacity)
