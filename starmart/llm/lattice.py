"""Near copies among embeddings by lattice hashing.

A table projects a unit vector on ``BLOCKS`` random spaces of eight dimensions and decodes each
projection to the nearest point of the lattice E8; the points together are the vector's cell. Each
vector is filed under its own cell and under ``PROBES`` neighbouring ones, reached by one step along
the lattice vectors of least length that lie closest to where it is in its cell. Vectors that share
a cell, one of them at least as its own, are compared by cosine in double precision.

Equal vectors are compared once and stand for all their rows. A crowded cell is cut into parts, and
pairs of parts are compared in tasks of their own, so that no task holds more than two parts. A pair
that meets in several tables is reported by the first one in which both have the same own cell.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.components import connected_components
from starmart.llm.tables import materialize
from starmart.llm.vectors import all_vectors, matrix
from starmart.llm.words import mix

COSINE = 0.9
TABLES = 12
BLOCKS = 2
SCALE = 1.5
PROBES = 4
PART_ROWS = 2048
SEED = 11


@lru_cache(maxsize=1)
def shortest_vectors() -> np.ndarray:
    """The 240 vectors of length sqrt(2) of E8."""
    rows = []
    for i, j in combinations(range(8), 2):
        for a, b in product((-1.0, 1.0), repeat=2):
            row = [0.0] * 8
            row[i], row[j] = a, b
            rows.append(row)
    rows += [list(s) for s in product((-0.5, 0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(rows)


def _nearest_even(points: np.ndarray) -> np.ndarray:
    """The nearest point of D8: whole numbers with an even sum."""
    rounded = np.rint(points)
    off = points - rounded
    odd = np.flatnonzero(rounded.sum(axis=1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(axis=1)
    rounded[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return rounded


def decode_e8(points: np.ndarray) -> np.ndarray:
    """The nearest point of E8, the union of D8 and D8 moved by one half in every coordinate."""
    whole, half = _nearest_even(points), _nearest_even(points - 0.5) + 0.5
    nearer = ((points - whole) ** 2).sum(axis=1) <= ((points - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


@lru_cache(maxsize=8)
def _projections(dim: int, tables: int, blocks: int, scale: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng([seed, dim])
    matrices = random.normal(0, scale / np.sqrt(8), (tables, dim, 8 * blocks))
    return matrices, random.uniform(0, 2, (tables, 8 * blocks))


def _keys(table: int, points: np.ndarray) -> np.ndarray:
    """A 64-bit key for each row of lattice points (doubled, so that they are whole)."""
    key = np.full(len(points), table + 1, np.uint64)
    for column in (points * 2).astype(np.int64).astype(np.uint64).T:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def cells(
    units: np.ndarray,
    tables: int = TABLES,
    blocks: int = BLOCKS,
    scale: float = SCALE,
    probes: int = PROBES,
    seed: int = SEED,
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the own cells (rows x tables) and of the probed ones (rows x tables x probes)."""
    matrices, moves = _projections(units.shape[1], tables, blocks, scale, seed)
    own = np.empty((len(units), tables), np.int64)
    probed = np.empty((len(units), tables, probes), np.int64)
    steps = shortest_vectors()
    for table in range(tables):
        points = units @ matrices[table] + moves[table]
        decoded = np.concatenate(
            [decode_e8(points[:, 8 * b : 8 * b + 8]) for b in range(blocks)], axis=1
        )
        own[:, table] = _keys(table, decoded)
        off = points - decoded
        # Of one step in one block, those that bring the cell's centre closest.
        gains = np.concatenate([off[:, 8 * b : 8 * b + 8] @ steps.T for b in range(blocks)], axis=1)
        best = np.argsort(-gains, axis=1, kind="stable")[:, :probes]
        for probe in range(probes):
            moved = decoded.reshape(len(units), blocks, 8).copy()
            block, step = np.divmod(best[:, probe], len(steps))
            moved[np.arange(len(units)), block] += steps[step]
            probed[:, table, probe] = _keys(table, moved.reshape(len(units), -1))
    return own, probed


def numbered_copies(
    df: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    cosine: float = COSINE,
    tables: int = TABLES,
    blocks: int = BLOCKS,
    scale: float = SCALE,
    probes: int = PROBES,
    part_rows: int = PART_ROWS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """Classes and links of the vectors of a table.

    The first table has a row for each row of ``df``: (id, class_id), where equal vectors, and only
    they, share a class number, whatever their ids: rows that repeat an id with other vectors are apart. A
    null class means a vector that is null, zero, or holds null or non-finite components, or a null
    id: it links with nothing. The second has the links (a, b),
    a < b, between classes, each once: cosine of at least ``cosine``. Vectors of different lengths
    are not compared.
    """
    usable = F.col("sound") & F.exists("v", lambda x: x != 0)
    rows = all_vectors(df, id_column, vector).withColumn("sound", F.coalesce(usable, F.lit(False)))
    # A class has a number of its own, fixed once the table is written.
    numbered = rows.filter("sound").select("v").distinct().withColumn("rep", F.monotonically_increasing_id())
    classes = materialize(numbered.select(F.size("v").alias("dim"), "rep", "v"), "classes")
    entry = "dim int, key long, rep long, own boolean, cells array<bigint>, v array<double>"

    def file_under(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch["dim"])
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                for at in range(0, len(rows), 1024):
                    some = pa.array(rows[at : at + 1024])
                    vectors = matrix(batch["v"].take(some), int(dim))
                    units = vectors / np.abs(vectors).max(axis=1, keepdims=True)
                    units /= np.linalg.norm(units, axis=1, keepdims=True)
                    own, probed = cells(units, tables, blocks, scale, probes, seed)
                    keys = np.concatenate((own[:, :, None], probed), axis=2).reshape(len(units), -1)
                    # A vector is filed once under a key.
                    row, slot = np.divmod(np.arange(keys.size), keys.shape[1])
                    flat = pa.list_(pa.int64()), pa.list_(pa.float64())
                    take = pa.array(row)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "dim": pa.array(np.full(len(row), dim, np.int32)),
                            "key": pa.array(keys.ravel()),
                            "rep": batch["rep"].take(some).take(take),
                            "own": pa.array(slot % (1 + probes) == 0),
                            "cells": pa.array(own.tolist(), flat[0]).take(take),
                            "v": pa.array(units.tolist(), flat[1]).take(take),
                        }
                    )

    filed = classes.mapInArrow(file_under, entry)
    crowd = (
        filed.groupBy(F.col("key").alias("k"))
        .agg(F.count_if("own").alias("own_rows"), F.count(F.lit(1)).alias("rows"))
        .filter("own_rows > 0 AND rows > 1")
        .select("k", F.ceil(F.col("rows") / part_rows).cast("int").alias("parts"))
    )
    dealt = (
        filed.join(crowd, F.col("key") == F.col("k"))
        .withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
        .withColumn("low", F.least("part", "other"))
        .withColumn("high", F.greatest("part", "other"))
    )

    def compare(members: pa.Table) -> pa.Table:
        dim, low, high = (members[c][0].as_py() for c in ("dim", "low", "high"))
        rep, own, part = (np.asarray(members[c]) for c in ("rep", "own", "part"))
        units = matrix(members["v"], dim)
        own_cells = matrix(members["cells"], tables)
        found: list[np.ndarray] = []
        left = np.flatnonzero(own & (part == low)) if low != high else np.flatnonzero(own)
        right = np.arange(len(rep))
        for rows, others in ((left, right),) if low == high else (
            (left, np.flatnonzero(part == high)),
            (np.flatnonzero(own & (part == high)), np.flatnonzero(part == low)),
        ):
            for at in range(0, len(rows), 512):
                some = rows[at : at + 512]
                a, b = np.nonzero(units[some] @ units[others].T >= cosine)
                a, b = some[a], others[b]
                # Of two that have the pair as own cells, the smaller one reports it.
                keep = (rep[a] != rep[b]) & (~own[b] | (rep[a] < rep[b]))
                a, b = a[keep], b[keep]
                same = own_cells[a] == own_cells[b]
                first = np.where(same.any(axis=1), same.argmax(axis=1), tables)
                here = (own_cells[a] == key_of(members)).argmax(axis=1)
                keep = np.where(own[b], first == here, first == tables)
                a, b = rep[a[keep]], rep[b[keep]]
                found.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
        pairs = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)
        return pa.table({"a": pa.array(pairs[0]), "b": pa.array(pairs[1])})

    def key_of(members: pa.Table) -> int:
        return members["key"][0].as_py()

    met = dealt.groupBy("dim", "key", "low", "high").applyInArrow(compare, "a long, b long")
    links = materialize(met.distinct(), "vector-links")

    known = classes.select(F.col("v").alias("w"), F.col("rep").alias("class_id"))
    rows = rows.join(known, F.col("sound") & (F.col("v") == F.col("w")), "left")
    return materialize(rows.select("id", "class_id"), "vector-rows"), links


def near_copies(
    df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", **settings
) -> tuple[DataFrame, DataFrame]:
    """The tables of ``numbered_copies`` with each class named by the smallest of its ids.

    Where rows repeat an id with different vectors, classes can share a name; their numbers tell them
    apart.
    """
    rows, links = numbered_copies(df, id_column, vector, **settings)
    names = rows.filter("class_id IS NOT NULL").groupBy("class_id").agg(F.min("id").alias("name"))
    ends = [names.select(F.col("class_id").alias(f"c{n}"), F.col("name").alias(f"n{n}")) for n in "ab"]
    named = links.join(ends[0], F.col("a") == F.col("ca")).join(ends[1], F.col("b") == F.col("cb"))
    links = named.select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b"))
    return rows.join(names, "class_id", "left").select("id", F.col("name").alias("class_id")), links


def near_copy_report(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", **settings) -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    ``n_links`` counts the other rows linked directly, equal vectors among them; ``component_id`` is
    the smallest id reachable by links; ``kept`` tells whether it is the row's own. A row that links
    with nothing has no links and is its own component. Rows that repeat an id are rows of their own:
    with equal vectors they link, with others they need not be in one component.
    """
    rows, links = numbered_copies(df, id_column, vector, **settings)
    sizes = rows.filter("class_id IS NOT NULL").groupBy("class_id").agg(
        F.count(F.lit(1)).alias("size"), F.min("id").alias("least")
    )
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = (
        both.join(sizes, F.col("b") == F.col("class_id")).groupBy("a").agg(F.sum("size").alias("others"))
    )
    of_class = (
        sizes.join(linked, F.col("class_id") == F.col("a"), "left")
        .join(connected_components(links), F.col("class_id") == F.col("node"), "left")
        .select(
            F.col("class_id").alias("c"),
            (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            "component",
            "least",
        )
    )
    # Components are named by the smallest id of their rows; a class without links has only its own.
    names = of_class.filter("component IS NOT NULL").groupBy(F.col("component").alias("m")).agg(
        F.min("least").alias("name")
    )
    of_class = of_class.join(names, F.col("component") == F.col("m"), "left").select(
        "c", "n_links", F.coalesce("name", "least").alias("component_id")
    )
    return rows.join(of_class, F.col("class_id") == F.col("c"), "left").select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component_id"), F.col("c").isNull()).alias("kept"),
    )
