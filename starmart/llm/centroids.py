"""Centroid clustering by progressive Walsh-Hadamard search.

Components become whole numbers, and vectors and centroids are transformed with the 64 x 64 matrix H
of signs whose rows are the Walsh functions. H'H is 64 times the identity, so the squared distance of
two transforms is exactly 64 times that of the vectors: all of it is whole-number arithmetic.

The coefficients are ordered by their number of sign changes, coarse ones first. A search adds up
squared differences over growing runs of them; what is added up so far is a lower bound of 64 times
the distance. After each run the centroid with the least bound is finished over all coefficients,
and every centroid whose bound is strictly above the best finished one is eliminated. What remains
in the end is finished over all 64, and of the least distances the smallest number wins. Bounds are
strict, so ties are never lost.

Rows stay where they are. A round broadcasts the centroids (a bounded table), and each task sends one
row of sums for each cluster and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.tables import materialize
from starmart.llm.vectors import all_vectors, matrix

DIMENSIONS = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
SEED = "2"

#: Coefficients known after each step of the search.
_STEPS = (8, 16, 32, DIMENSIONS)
#: Rows searched at once: bounds the memory of a step.
_SLICE = 4096
#: 64-bit sums of squares are exact up to components of this size: 64 * 64 * (2 * 2^24)^2 = 2^62.
_NARROW = 1 << 24
_LARGEST = (1 << 63) - 1


@lru_cache(maxsize=1)
def walsh() -> np.ndarray:
    """The transform: rows of signs, ordered by their number of sign changes."""
    h = np.ones((1, 1), np.int64)
    while len(h) < DIMENSIONS:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((np.diff(h, axis=1) != 0).sum(axis=1), kind="stable")]


def transformed(values: np.ndarray) -> np.ndarray:
    """The transforms of rows of whole numbers, 64-bit or Python ones."""
    return values @ walsh().T.astype(values.dtype)


def nearest(values: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of the nearest centroid of each row, and the squared distance to it.

    Both hold whole numbers: below 2^24 as int64, or any as objects.
    """
    rows, coded = transformed(values), transformed(centroids)
    everyone = np.arange(len(rows))
    bound = np.zeros((len(rows), len(coded)), rows.dtype)
    alive = np.ones(bound.shape, bool)
    far, done = None, 0
    for until in _STEPS:
        at, to = np.nonzero(alive)
        part = rows[at, done:until] - coded[to, done:until]
        bound[at, to] += (part * part).sum(axis=1)
        done = until
        # Eliminated ones rank behind every survivor.
        ranked = np.where(alive, bound, bound.max(initial=0) + 1)
        leader = np.argmin(ranked, axis=1)
        rest = rows[:, until:] - coded[leader, until:]
        whole = bound[everyone, leader] + (rest * rest).sum(axis=1)
        far = whole if far is None else np.minimum(far, whole)
        alive &= bound <= far[:, None]
    # Survivors are whole now; the first of the least ones has the smallest number.
    return leader, whole // DIMENSIONS


def whole_numbers(rows: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of each component: int64, or Python numbers where one is 2^24 or more."""
    scaled = np.floor(rows * scale)
    if np.abs(scaled).max(initial=0) < _NARROW:
        return scaled.astype(np.int64)
    # A double from 2^53 on is whole, and its product need not fit a double.
    exact = [[int(s) if abs(x) < 1 << 53 else int(x) * scale for x, s in zip(*pair)] for pair in zip(rows, scaled)]
    return np.array(exact, object).reshape(rows.shape)


def _slices(
    batch: pa.RecordBatch, centroids: np.ndarray, scale: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Places of rows of a batch, their whole numbers, their clusters and distances."""
    rows = matrix(batch.column("v"), DIMENSIONS)
    for first in range(0, len(rows), _SLICE):
        piece = slice(first, first + _SLICE)
        part = rows[piece]
        fits = np.abs(part).max(axis=1) * scale < _NARROW - 1
        for some in (fits, ~fits):
            if not some.any():
                continue
            values, coded = whole_numbers(part[some], scale), centroids
            if object in (values.dtype, coded.dtype):
                values, coded = values.astype(object), coded.astype(object)
            yield np.flatnonzero(some) + first, values, *nearest(values, coded)


def _limbs(total: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Sums in parts of 32 bits, the last one signed, so that parts can be added as longs."""
    number = 0
    while np.abs(total).max(initial=0) >> 31:
        yield number, total & 0xFFFFFFFF
        total, number = total >> 32, number + 1
    yield number, total


def cluster_sums(vectors: DataFrame, centroids: np.ndarray, scale: int = SCALE) -> dict[int, tuple[int, list[int]]]:
    """Rows and exact component sums of each cluster that has rows: a bounded result."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centroids), np.int64)
        total = np.zeros((len(centroids), DIMENSIONS), object)
        for batch in batches:
            for _, values, cluster, _ in _slices(batch, centroids, scale):
                count += np.bincount(cluster, minlength=len(count))
                for one in np.unique(cluster):
                    total[one] += values[cluster == one].sum(axis=0)
        for one in np.flatnonzero(count):
            yield _sum_rows(one, -1, 0, np.array([count[one]]))
            for limb, part in _limbs(total[one]):
                yield _sum_rows(one, limb, np.arange(DIMENSIONS), part)

    partial = vectors.mapInArrow(sums, "cluster int, limb int, component int, n long")
    counts: dict[int, int] = {}
    totals: dict[int, list[int]] = {}
    for row in partial.groupBy("cluster", "limb", "component").agg(F.sum("n").alias("n")).collect():
        if row["limb"] < 0:
            counts[row["cluster"]] = row["n"]
        else:
            own = totals.setdefault(row["cluster"], [0] * DIMENSIONS)
            own[row["component"]] += row["n"] << (32 * row["limb"])
    return {cluster: (counts[cluster], totals[cluster]) for cluster in counts}


def _sum_rows(cluster: int, limb: int, component, values: np.ndarray) -> pa.RecordBatch:
    size = len(values)
    return pa.record_batch(
        {
            "cluster": pa.array(np.full(size, cluster, np.int32)),
            "limb": pa.array(np.full(size, limb, np.int32)),
            "component": pa.array(np.broadcast_to(np.asarray(component, np.int32), size)),
            "n": pa.array(values.astype(np.int64)),
        }
    )


def first_centroids(vectors: DataFrame, count: int, seed: str, scale: int = SCALE) -> np.ndarray:
    """The vectors whose ids hash least, in the order of their hashes, then of ids and components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("key"), "id", "v").orderBy("key", "id", "v").limit(count).collect()
    return _packed([whole_numbers(np.array([row["v"]]), scale)[0].tolist() for row in rows])


def _packed(rows: Sequence[Sequence[int]]) -> np.ndarray:
    """Rows of whole numbers in the narrowest form that is exact."""
    narrow = all(abs(value) < _NARROW for row in rows for value in row)
    return np.array(rows, np.int64 if narrow else object).reshape(len(rows), DIMENSIONS)


def fit_centroids(
    vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED, scale: int = SCALE
) -> np.ndarray:
    """Centroids after ``rounds`` rounds over all rows of (id, v); an empty cluster keeps its own."""
    centroids = first_centroids(vectors, count, seed, scale)
    if not len(centroids):
        return centroids
    for _ in range(rounds):
        rows = centroids.tolist()
        for cluster, (n, total) in cluster_sums(vectors, centroids, scale).items():
            rows[cluster] = [value // n for value in total]
        if rows == centroids.tolist():
            break  # Every later round would do the same.
        centroids = _packed(rows)
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray, scale: int = SCALE) -> DataFrame:
    """(id, cluster, distance) of all rows; a distance beyond 64 bits is NULL."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            for at, _, cluster, distance in _slices(batch, centroids, scale):
                yield pa.record_batch(
                    {
                        "id": ids.take(pa.array(at)),
                        "cluster": pa.array(cluster.astype(np.int32)),
                        "distance": pa.array([d if d <= _LARGEST else None for d in distance.tolist()], pa.int64()),
                    }
                )

    return vectors.mapInArrow(found, "id long, cluster int, distance long")


def cluster_vectors(
    df: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    count: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: str = SEED,
    scale: int = SCALE,
) -> DataFrame:
    """Cluster all vectors of 64 finite components: one row per vector.

    Columns: ``id``, ``cluster``, ``distance`` (squared, to the final centroid), ``cluster_inertia``
    and ``inertia`` (sums of distances over the cluster and over all rows) and ``centroid_sha256``
    (of the final centroid's components joined by commas).

    Other vectors (null, of another length, with null, NaN or infinite components) take no part. Each
    row is a vector of its own, so repeated rows weigh as often as they come. A null id counts as
    empty text where ids are hashed. Fewer rows than ``count`` give as many centroids as rows, an
    empty table an empty result. Distances and sums beyond 64 bits are NULL, the search is exact all
    the same. Other columns are not looked at.
    """
    found = all_vectors(df, id_column, vector).filter(F.col("finite") & (F.size("v") == DIMENSIONS))
    vectors = materialize(found.select("id", "v"), "vectors")
    centroids = fit_centroids(vectors, count, rounds, seed, scale)
    assigned = materialize(assign(vectors, centroids, scale), "assigned")

    def inertia(name: str):
        whole = F.sum(F.col("distance").cast("decimal(38,0)")).try_cast("long")
        return F.when(F.count("distance") == F.count(F.lit(1)), whole).alias(name)

    of_cluster = assigned.groupBy("cluster").agg(inertia("cluster_inertia"))
    texts = [",".join(str(value) for value in row) for row in centroids.tolist()]
    named = df.sparkSession.createDataFrame(
        [(n, hashlib.sha256(text.encode()).hexdigest()) for n, text in enumerate(texts)],
        "cluster int, centroid_sha256 string",
    )
    return (
        assigned.join(F.broadcast(of_cluster), "cluster")
        .join(F.broadcast(named), "cluster")
        .withColumn("inertia", assigned.agg(inertia("inertia")).scalar())
        .select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    )
