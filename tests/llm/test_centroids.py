"""Centroid clustering against a plain version and its SQL."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from starmart.llm import centroids, queries

SF = "/root/testdata/sf0.01"


def whole(x):
    return 256 * int(x) if abs(x) >= 2**53 else math.floor(256 * x)


def plain(rows, count=40, rounds=5):
    """Rows (id, cluster, distance, cluster inertia, inertia, hash) of (id, vector) pairs."""
    kept = [
        (i, v) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    text = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    order = sorted(kept, key=lambda r: (text(r[0]), -1 if r[0] is None else r[0], r[1]))
    kept = [(i, [whole(x) for x in v]) for i, v in kept]
    middle = [[whole(x) for x in v] for _, v in order[:count]]

    def far(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(middle))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(far(v)[1], []).append(v)
        for k, group in groups.items():
            middle[k] = [sum(column) // len(group) for column in zip(*group)]
    found = [(i, *far(v)) for i, v in kept]
    every = sum(d for _, d, _ in found)
    of = {k: sum(d for _, d, c in found if c == k) for _, _, k in found}
    named = {k: hashlib.sha256(",".join(map(str, middle[k])).encode()).hexdigest() for k in of}
    small = lambda n: n if n < 2**63 else None
    lost = any(d >= 2**63 for _, d, _ in found)
    return sorted(
        (
            (i, k, small(d), None if any(e >= 2**63 for _, e, c in found if c == k) else small(of[k]), None if lost else small(every), named[k])
            for i, d, k in found
        ),
        key=repr,
    )


def result(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, id int, v string")
    return sorted((tuple(r) for r in centroids.cluster_vectors(df, **options).collect()), key=repr)


def some_rows(seed, count=300, step=1 / 256):
    chance = random.Random(seed)
    centres = [[chance.gauss(0, 1) for _ in range(64)] for _ in range(12)]
    rows = []
    for i in range(count):
        centre = chance.choice(centres)
        rows.append((i, [round((c + chance.gauss(0, 0.3)) / step) * step for c in centre]))
    return rows


@pytest.mark.parametrize("seed, step", [(1, 1 / 256), (2, 1 / 4), (3, 1.0)])
def test_clusters_equal_plain(spark, seed, step):
    """Coarse steps make many equal distances."""
    rows = some_rows(seed, step=step)
    assert result(spark, rows) == plain(rows)


def test_transform_keeps_distances():
    h = centroids.walsh()
    assert (h @ h.T == 64 * np.eye(64, dtype=int)).all()
    assert ((np.diff(h, axis=1) != 0).sum(axis=1) == np.arange(64)).all()


@pytest.mark.parametrize("kind", [np.int64, object])
def test_search_is_exact_and_prefers_small_numbers(kind):
    random_ = np.random.default_rng(4)
    for spread in (1, 3, 200):
        rows = random_.integers(-spread, spread + 1, (400, 64))
        middle = random_.integers(-spread, spread + 1, (40, 64))
        middle[7] = middle[3]
        rows[:40] = middle
        far = ((rows[:, None] - middle[None]) ** 2).sum(axis=2)
        cluster, distance = centroids.nearest(rows.astype(kind), middle.astype(kind))
        assert (cluster == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()


def test_numbers_of_any_size(spark):
    """Components at the limit of 64-bit sums, far beyond it, and beyond doubles once multiplied."""
    rows = some_rows(6, 60)
    rows += [(100 + k, [sign * x] * 63 + [0.5]) for k, x in enumerate([65535.9, 65536.0, 1e9, 1e30, 1e307]) for sign in (1, -1)]
    found = result(spark, rows, count=8)
    assert found == plain(rows, 8)
    assert any(r[2] is None for r in found) or all(r[2] == 0 for r in found if r[0] >= 104)


def test_odd_vectors(spark):
    rows = some_rows(8, 50)
    rows += [(1, rows[1][1]), (1, rows[2][1]), (None, rows[3][1]), (70, None), (71, []), (72, [1.0] * 63)]
    rows += [(73, [1.0] * 63 + [None]), (74, [float("nan")] + [0.0] * 63), (75, [float("inf")] + [0.0] * 63), (76, [0.0] * 64)]
    assert result(spark, rows) == plain(rows)
    assert result(spark, rows[:5]) == plain(rows[:5])
    assert result(spark, [(1, None)]) == []
    assert result(spark, rows, rounds=0) == plain(rows, rounds=0)


def test_query_equals_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = sorted(duck.execute(queries.ORACLES["op13_centroid_clusters"]).fetchall())
    found = queries.op13_centroid_clusters(spark, SF)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(tuple(r) for r in found.collect()) == want and len(want) == 500
