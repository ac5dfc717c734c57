"""Line dedup with levelled sorted runs of line hashes.

The key of a line is the line without blanks at both ends, A-Z in lower case; it is known by 128 bits
of its BLAKE2b digest. A run is a table of (hash, number of documents) for the keys of one batch of
documents, hashed into buckets and sorted by hash in each. A batch adds a run to level 0. When a level
holds ``fanout`` runs they are merged into one of the next level, so a key is rewritten once a level
and there are only a few runs at any time. All runs have the same buckets: merging runs and summing
over them moves nothing between tasks.

A batch is matched with the runs by hash, and lines that have come in too many documents go. Only
hashes move for that; texts move once, to the keys that they lose. A key or a text that many rows
share is dealt over several tasks.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from starmart.llm.tables import batches_of, materialize, name, shuffle_partitions
from starmart.operators.joins import skew_join
from starmart.sources import files
from starmart.sources.scratch import scratch_path

#: Documents that make a line go.
MIN_DOCUMENTS = 10
#: Runs of a level that are merged into one of the next level.
FANOUT = 4
#: Batches that a whole table is fed in.
BATCHES = 8

_SLICE_BYTES = 4 << 20
_TEXT, _LOST = ["__f", "__e"], "__lost"


def split_lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """All lines of the texts, the place of each text's first one (and the end), and the lines' keys."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    firsts = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists), np.int64))])
    lines = lists.flatten()
    return lines, firsts, pc.ascii_trim_whitespace(pc.ascii_lower(lines))


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def line_keys(df: DataFrame, text: str = "text") -> DataFrame:
    """(__f, __e, h, g): for each row the hash of each of its distinct keys but the empty one.

    ``__f`` and ``__e`` are 128 bits of the text.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, "text", _SLICE_BYTES):
                _, firsts, found = split_lines(part.column("text"))
                found = pc.cast(found, pa.large_binary()).to_pylist()
                digests, counts = bytearray(), np.zeros(part.num_rows, np.int64)
                for row, (first, end) in enumerate(zip(firsts[:-1], firsts[1:])):
                    distinct = set(found[first:end])
                    distinct.discard(b"")
                    counts[row] = len(distinct)
                    for key in distinct:
                        digests += _digest(key)
                pair = np.frombuffer(bytes(digests), np.int64).reshape(-1, 2)
                own = pa.array(np.repeat(np.arange(part.num_rows), counts))
                yield pa.record_batch(
                    [*(part.column(c).take(own) for c in _TEXT), pa.array(pair[:, 0]), pa.array(pair[:, 1])],
                    names=[*_TEXT, "h", "g"],
                )

    texts = _with_text_key(df.select(name(text).alias("text")), "text")
    return texts.mapInArrow(keys, "__f long, __e long, h long, g long")


def _with_text_key(df: DataFrame, text: str) -> DataFrame:
    return df.withColumns({"__f": F.xxhash64(name(text)), "__e": F.xxhash64(F.lit(1), name(text))})


class LineRuns:
    """The levelled runs below a folder: one table, each run a partition of it, all in the same buckets.

    A scan of some runs reads a bucket of all of them in one task, so merging and summing them needs no
    exchange. ``runs.json`` lists the runs that count and is replaced as a whole after each change, so a
    job that is lost leaves them as they were. A session that opens the folder again goes on where the
    last one ended.
    """

    def __init__(self, spark: SparkSession, path: str, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.path, self.fanout = spark, path.rstrip("/"), fanout
        self._list = f"{self.path}/runs.json"
        if files.exists(spark, self._list):
            state = json.loads(files.read_text(spark, self._list))
            self.buckets, self.last, self.runs = state["buckets"], state["last"], state["runs"]
        else:
            self.buckets, self.last, self.runs = buckets or shuffle_partitions(spark), None, []
        self._table = f"line_runs_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self._table} (h BIGINT, g BIGINT, n BIGINT, run STRING) USING parquet PARTITIONED BY (run) "
            f"CLUSTERED BY (h) SORTED BY (h, g) INTO {self.buckets} BUCKETS LOCATION '{self.path}/runs'"
        )
        for _, run in self.runs:
            spark.sql(f"ALTER TABLE {self._table} ADD PARTITION (run = '{run}')")

    def close(self) -> None:
        """Forget the table in this session; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table}")

    def _commit(self, runs: list, last: int | None) -> None:
        files.write_text(self.spark, self._list, json.dumps({"buckets": self.buckets, "last": last, "runs": runs}))
        self.runs, self.last = runs, last

    def _write(self, counts: DataFrame) -> str:
        run = uuid.uuid4().hex
        writer = counts.select("h", "g", "n", F.lit(run).alias("run")).write.mode("append").format("parquet")
        writer.partitionBy("run").bucketBy(self.buckets, "h").sortBy("h", "g").saveAsTable(self._table)
        return run

    def _merged(self, runs: list[str]) -> DataFrame:
        rows = self.spark.table(self._table).filter(F.col("run").isin(*runs))
        return rows.groupBy("h", "g").agg(F.sum("n").alias("n"))

    def add(self, keys: DataFrame, number: int | None = None) -> None:
        """Add a batch of keys, one row for each document that has one.

        With a ``number`` that is not above the last one given, the batch is in already and nothing
        happens: a stream may send its last batch again.
        """
        if number is not None and self.last is not None and number <= self.last:
            return
        counts = keys.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n"))
        run = self._write(counts.repartition(self.buckets, "h"))
        self._commit([*self.runs, [0, run]], self.last if number is None else number)
        self.compact()

    def compact(self) -> None:
        """Merge each level that is full into the next one, the lowest level first."""
        level = 0
        while True:
            full = [run for at, run in self.runs if at == level]
            if len(full) >= self.fanout:
                merged = self._write(self._merged(full))
                self._commit([[level + 1, merged], *([at, run] for at, run in self.runs if run not in full)], self.last)
                for run in full:
                    self.spark.sql(f"ALTER TABLE {self._table} DROP IF EXISTS PARTITION (run = '{run}')")
                    files.remove(self.spark, f"{self.path}/runs/run={run}")
            elif level >= max((at for at, _ in self.runs), default=0):
                return
            level += 1

    def counts(self) -> DataFrame:
        """(h, g, n): how many documents each key has come in."""
        if not self.runs:
            return self.spark.createDataFrame([], "h long, g long, n long")
        return self._merged([run for _, run in self.runs])

    def frequent(self, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
        """(h, g) of the keys of at least ``min_documents`` documents."""
        return self.counts().filter(F.col("n") >= min_documents).select("h", "g")


def without_lines(df: DataFrame, keys: DataFrame, frequent: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without the lines whose keys are listed; ``keys`` are those of ``line_keys(df)``.

    ``text`` holds the other lines joined by line feeds; ``n_lines`` and ``n_dropped`` count lines
    before and how many went, in place of columns of these names.
    """
    lost = skew_join(keys, frequent, ["h", "g"], "left_semi")
    lost = lost.groupBy(*_TEXT).agg(F.collect_set(F.struct("h", "g")).alias(_LOST))
    lost = lost.select(*_TEXT, F.col(f"{_LOST}.h").alias("__h"), F.col(f"{_LOST}.g").alias("__g"))
    rest = df.drop("n_lines", "n_dropped")
    columns = rest.columns
    joined = skew_join(_with_text_key(rest, text), materialize(lost, "lost-lines"), _TEXT, "left")
    fields = [StructField(f.name, StringType()) if f.name == text else f for f in rest.schema.fields]
    schema = StructType([*fields, StructField("n_lines", LongType()), StructField("n_dropped", LongType())])

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, text, _SLICE_BYTES):
                kept, n_lines, n_dropped = _kept(part.column(text), part.column("__h"), part.column("__g"))
                columns_of = [kept if c == text else part.column(c) for c in columns]
                yield pa.record_batch(
                    [*columns_of, pa.array(n_lines), pa.array(n_dropped)], names=[*columns, "n_lines", "n_dropped"]
                )

    return joined.select(*[name(c) for c in columns], "__h", "__g").mapInArrow(drop, schema)


def _kept(texts: pa.Array, h: pa.Array, g: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Each text without the lines whose hashes are listed beside it, its lines and those dropped."""
    n_lines = np.asarray(pc.add(pc.count_substring(pc.fill_null(texts, ""), "\n"), 1), np.int64)
    n_dropped = np.zeros(len(texts), np.int64)
    touched = np.flatnonzero(np.asarray(pc.fill_null(pc.list_value_length(h), 0)) > 0)
    if not len(touched):
        return pc.fill_null(texts, ""), n_lines, n_dropped
    where = pa.array(touched)
    lines, firsts, keys = split_lines(texts.take(where))
    keys = pc.cast(keys, pa.large_binary()).to_pylist()
    lines = lines.to_pylist()
    all_texts = pc.fill_null(texts, "").to_pylist()
    for row, ours, theirs, first, end in zip(
        touched.tolist(), h.take(where).to_pylist(), g.take(where).to_pylist(), firsts[:-1], firsts[1:]
    ):
        listed = {np.array(pair, np.int64).tobytes() for pair in zip(ours, theirs)}
        kept = [lines[i] for i in range(first, end) if not keys[i] or _digest(keys[i]) not in listed]
        n_dropped[row] = end - first - len(kept)
        all_texts[row] = "\n".join(kept)
    return pa.array(all_texts, texts.type), n_lines, n_dropped


def drop_batch_lines(
    runs: LineRuns, docs: DataFrame, number: int | None = None, text: str = "text", min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """Add a new batch to the runs and drop its lines that have come in too many documents so far.

    Documents of the batch itself count; earlier batches are not looked at again. For a stream, call
    it in ``foreachBatch`` with the number of the batch.
    """
    keys = materialize(line_keys(docs, text), "line-keys")
    runs.add(keys.select("h", "g"), number)
    return without_lines(docs, keys, materialize(runs.frequent(min_documents), "frequent-lines"), text)


def drop_common_lines(
    df: DataFrame,
    text: str = "text",
    min_documents: int = MIN_DOCUMENTS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
    path: str | None = None,
) -> DataFrame:
    """All lines whose key comes in at least ``min_documents`` rows go, in every row.

    The table is fed to the runs in ``batches`` parts of about equal size, then all of it is matched
    with all runs. ``path`` keeps the runs, by default they are scratch tables.

    Result: ``df`` with the lines that stay as ``text``, and ``n_lines`` and ``n_dropped`` in place of
    columns of these names. Every row is a document of its own, repeated rows and ids and null ids
    too. A null text counts as an empty one, with one empty line, and comes back empty. Empty keys
    (lines of blanks) never go. A key counts once for a document, however often it comes there. An
    empty table gives an empty table. A very long text is held by one task, with its lines and keys.
    """
    spark = df.sparkSession
    keys = line_keys(df, text).withColumn("batch", F.pmod(F.col("__e"), F.lit(batches)).cast("int"))
    keys.write.partitionBy("batch").parquet(where := scratch_path(spark, "line-keys"))
    keys = spark.read.schema("__f long, __e long, h long, g long, batch int").parquet(where)
    runs = LineRuns(spark, path or scratch_path(spark, "line-runs"), fanout)
    for number in range(batches):
        runs.add(keys.filter(F.col("batch") == number).select("h", "g"))
    frequent = materialize(runs.frequent(min_documents), "frequent-lines")
    runs.close()
    return without_lines(df, keys.drop("batch"), frequent, text)
