"""Exact top-k search by inner product with a table of pivot distances.

Vectors are compared as whole numbers, floor(1024 x) for each component x. Distances of every
vector to many pivots are computed once. By the triangle inequality the distance of a query to a
vector is at least the greatest difference of their distances to a pivot, so

    <q, v> = (|q|^2 + |v|^2 - d(q, v)^2) / 2 <= (|q|^2 + |v|^2 - bound^2) / 2.

Candidates are evaluated in the order of this upper bound, and a query stops when the next bound is
below its k-th score: what is left cannot be among the k best. The origin is the first pivot.

Pivots come from a bounded sample, which also gives each query a k-th score to start from. Both
only decide how much is evaluated, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.llm.tables import pieces_of
from starmart.llm.vectors import matrix, sound_vectors

SCALE = 1024
TOP = 10
PIVOTS = 32
SAMPLE_ROWS = 2048
BLOCK_ROWS = 4096
QUERY_ROWS = 16_384

_AT_ONCE = 64
_STEP = 64


def choose_pivots(sample: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """The origin, then the vector of the sample that is farthest from those chosen, again and again."""
    chosen = [np.zeros(sample.shape[1])]
    nearest = np.full(len(sample), np.inf)
    for _ in range(min(count, len(sample))):
        nearest = np.minimum(nearest, ((sample - chosen[-1]) ** 2).sum(axis=1))
        if nearest.max() <= 0:
            break
        chosen.append(sample[nearest.argmax()])
    return np.array(chosen)


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(
        np.stack([((vectors - pivot) ** 2).sum(axis=1) for pivot in pivots]) if len(vectors) else
        np.zeros((len(pivots), 0))
    )


def _products(vectors: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of whole numbers; in doubles only where every sum stays below 2^53."""
    return (vectors @ query).astype(np.int64) if exact else vectors.astype(np.int64) @ query.astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def search_block(
    query_ids: np.ndarray,
    queries: np.ndarray,
    ids: np.ndarray,
    vectors: np.ndarray,
    seed_ids: np.ndarray,
    seeds: np.ndarray,
    pivots: np.ndarray,
    k: int = TOP,
) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(query, ids, scores, evaluated) of the vectors of a block that may be among the k best of all."""
    most = max((float(np.abs(part).max(initial=0)) for part in (queries, vectors, seeds)), default=0.0)
    exact = most * most * queries.shape[1] < 2**52
    table, norms = _distances(vectors, pivots), (vectors**2).sum(axis=1)
    # Rounding of square roots and squares stays far below this.
    slack = 1.0 + most * most * queries.shape[1] * 1e-9
    for at in range(0, len(queries), _AT_ONCE):
        some = queries[at : at + _AT_ONCE]
        own = _distances(some, pivots)
        bound = np.zeros((len(some), len(vectors)))
        for query_part, row in zip(own, table):
            np.maximum(bound, np.abs(query_part[:, None] - row), out=bound)
        upper = ((some**2).sum(axis=1)[:, None] + norms - bound**2) / 2 + slack
        for query, query_id, limit in zip(some, query_ids[at : at + _AT_ONCE], upper):
            start = _products(seeds, query, exact)[seed_ids != query_id]
            least = np.partition(start, len(start) - k)[len(start) - k] if len(start) >= k else None
            open_rows = ids != query_id
            if least is not None:
                open_rows &= limit >= least
            rows = np.flatnonzero(open_rows)
            rows = rows[np.argsort(-limit[rows], kind="stable")]
            found_ids, found = np.empty(0, np.int64), np.empty(0, np.int64)
            done = 0
            while done < len(rows):
                if least is not None and limit[rows[done]] < least:
                    break
                now = rows[done : done + _STEP]
                done += len(now)
                found = np.concatenate((found, _products(vectors[now], query, exact)))
                found_ids = np.concatenate((found_ids, ids[now]))
                keep = _best(found, found_ids, k)
                found, found_ids = found[keep], found_ids[keep]
                if len(found) == k and (least is None or found[-1] > least):
                    least = found[-1]
            if least is not None:
                keep = found >= least
                found, found_ids = found[keep], found_ids[keep]
            yield int(query_id), found_ids, found, done


def top_k(
    df: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector: str = "embedding",
    k: int = TOP,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, id, score, evaluated): the ``k`` highest scores of each query.

    ``is_query`` tells the query rows by their id, the column ``id``. All rows are candidates but
    those with the query's own id. Ties go to the smaller id. Query rows that repeat an id and its
    whole numbers are one query, with one ranking; each other vector of the id has a ranking of its
    own under that id. A candidate row that is repeated takes a rank for each. Rows without an id, and vectors that
    are null or hold null or non-finite components, take no part; vectors of different lengths are
    not compared. ``evaluated`` counts the vectors of the row's block whose score was computed for
    the query. Each task compares one block of at most about ``block_rows`` vectors with one of
    ``query_rows`` queries. Scores must fit in 64 bits.
    """
    whole = F.transform("v", lambda x: F.floor(x * SCALE).cast("double"))
    rows = sound_vectors(df, id_column, vector).withColumn("v", whole)
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).first()
    blocks = pieces_of(counts["n"], block_rows, 1)
    groups = pieces_of(counts["q"], query_rows, 1)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("id", "dim", "v").collect()
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for dim in {row["dim"] for row in sample}:
        own = [row for row in sample if row["dim"] == dim]
        values = np.array([row["v"] for row in own], float).reshape(len(own), dim)
        seeds[dim] = (np.array([row["id"] for row in own]), values, choose_pivots(values))
    shared = df.sparkSession.sparkContext.broadcast(seeds)

    every_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")
    group = F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("group")
    data = rows.select("dim", "id", "v", block, every_group)
    # Under other names: a cogroup of two tables from one source mixes up columns that they share.
    asked = rows.filter(is_query).select("dim", "id", "v").distinct().select(
        F.col("dim").alias("q_dim"),
        every_block.alias("q_block"),
        group.alias("q_group"),
        F.col("id").alias("q_id"),
        F.xxhash64("v").alias("q_key"),
        F.col("v").alias("q_v"),
    )

    def search(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "key": [], "id": [], "score": [], "evaluated": []}
        if len(queries) and len(vectors):
            dim = queries["q_dim"][0].as_py()
            nothing = (np.empty(0, np.int64), np.zeros((0, dim)), np.zeros((1, dim)))
            found = search_block(
                np.asarray(queries["q_id"]),
                matrix(queries["q_v"], dim),
                np.asarray(vectors["id"]),
                matrix(vectors["v"], dim),
                *shared.value.get(dim, nothing),
                k,
            )
            # One result for each query, in their order.
            for key, (query_id, ids, scores, evaluated) in zip(queries["q_key"].to_pylist(), found):
                out["query_id"] += [query_id] * len(ids)
                out["key"] += [key] * len(ids)
                out["id"] += ids.tolist()
                out["score"] += scores.tolist()
                out["evaluated"] += [evaluated] * len(ids)
        return pa.table({name: pa.array(values, pa.int64()) for name, values in out.items()})

    schema = "query_id long, key long, id long, score long, evaluated long"
    asked = asked.groupBy("q_dim", "q_block", "q_group")
    found = data.groupBy("dim", "block", "group").cogroup(asked).applyInArrow(search, schema)
    best = W.partitionBy("query_id", "key").orderBy(F.col("score").desc(), "id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score", "evaluated")
    )
