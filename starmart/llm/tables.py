"""Columns, scratch tables and sizes that several operators need."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.sources.scratch import materialize

__all__ = ["batches_of", "materialize", "name", "pieces_of", "shuffle_partitions", "text_bytes"]


def name(column: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + column.replace("`", "``") + "`")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(df: DataFrame, text: str) -> int:
    """UTF-8 bytes of a text column, summed on the executors."""
    row = df.agg(F.sum(F.octet_length(name(text)).cast("long")).alias("n")).first()
    return int(row["n"] or 0) if row else 0


def pieces_of(total: int, target: int, at_least: int = 1) -> int:
    """How many parts of about ``target`` each ``total`` is cut into."""
    return max(at_least, -(-total // target))


def batches_of(batch: pa.RecordBatch, text: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``max_bytes`` together, one long text at least."""
    if not batch.num_rows:
        return
    column = batch.column(batch.schema.get_field_index(text))
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + max_bytes, "right")))
        yield batch.slice(first, last - first)
        first = last


def bytes_and_offsets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array without a copy, and the offsets of its rows; null is empty."""
    texts = pc.fill_null(texts, "")
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = texts.buffers()
    where = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[where[0] : where[-1]], where - where[0]


def id_columns(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    return [name(column) for column in columns]
