"""Clustering against a plain re-computation in whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest
from kerbside.llm import clustering

SCHEMA = "vec_id long, embedding array<float>, cluster string, v int, label int"


def plain(rows, k=8, rounds=10, dimensions=64):
    kept = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in e])
        for i, e in rows
        if e is not None and len(e) == dimensions and all(x is not None and math.isfinite(x) for x in e)
    ]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest()))
    centroids = [list(x) for _, x in first[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        where = [nearest(x)[1] for _, x in kept]
        for j in range(len(centroids)):
            own = [x for (_, x), w in zip(kept, where) if w == j]
            if own:
                centroids[j] = [sum(c) // len(own) for c in zip(*own)]
    return [(i, nearest(x)[1], nearest(x)[0]) for i, x in kept], centroids


def vectors(n, seed, spread=0.3, size=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(11, 64)) * size
    return [(i, [float(y) for y in centres[rng.integers(11)] + rng.normal(size=64) * spread]) for i in range(n)]


def found(spark, rows):
    df = spark.createDataFrame([(i, e, "x", 1, 2) for i, e in rows], SCHEMA).repartition(3)
    return clustering.cluster_vectors(df)


@pytest.mark.parametrize("size", [1.0, 5000.0])
def test_equals_plain_recomputation(spark, size):
    rows = vectors(300, 5, 0.6 * size, size)
    rows += [rows[3], rows[3], (900, rows[7][1]), (901, [0.5] * 64)]
    got = found(spark, rows)
    expected, centroids = plain(rows)
    assert got.centroids.tolist() == centroids
    assert sorted(map(tuple, clustering.distances(got).collect())) == sorted(expected)
    # The bounds settle most vectors without a scan.
    assert got.scanned[0] == len(rows) and sum(got.scanned[1:]) < 0.7 * len(rows) * len(got.scanned[1:])


def test_nulls_lengths_and_few_vectors(spark):
    e = [0.25] * 64
    rows = [(1, None), (2, []), (3, e[1:]), (4, [*e, 1.0]), (5, [None, *e[1:]]), (6, [float("nan"), *e[1:]]),
            (7, [float("inf"), *e[1:]]), (8, e), (9, [-x for x in e]), (None, [0.125] * 64)]
    got = found(spark, rows)
    assert len(got.centroids) == 3
    assert sorted(r.vec_id or 0 for r in clustering.distances(got).collect()) == [0, 8, 9]
    assert found(spark, rows[:5]).vectors.count() == 0
    assert found(spark, [(1, e)] * 5).centroids.tolist()[0] == [256] * 64
    with pytest.raises(Exception, match="passes"):
        found(spark, [(1, [1e9] * 64)])


def test_bounds_hold_and_are_tighter_than_the_drift():
    rng = np.random.default_rng(3)
    tighter = 0
    for _ in range(200):
        old = rng.normal(size=(5, 6)) * 100
        new = old + rng.normal(size=old.shape) * rng.choice([1, 10, 100])
        radius = rng.uniform(0, 150, 5)
        loose = clustering.loosening(old, new, radius)
        drift = np.linalg.norm(new - old, axis=1)
        for i in range(5):
            way = rng.normal(size=(300, 6))
            x = old[i] + way / np.linalg.norm(way, axis=1)[:, None] * radius[i] * rng.uniform(0, 1, (300, 1)) ** 0.2
            nearer = np.linalg.norm(x[:, None] - old, axis=2) - np.linalg.norm(x[:, None] - new, axis=2)
            assert (np.delete(nearer, i, axis=1) <= loose[i] + 1e-6).all()
            most = np.delete(drift, i).max()
            assert loose[i] <= most * (1 + 1e-6) + 1e-6
            tighter += loose[i] < 0.9 * most
    assert tighter > 200


def test_packing_round_trip():
    rng = random.Random(1)
    rows = np.array([[rng.randint(-(2**w), 2**w) for _ in range(64)] for w in (3, 14, 26, 5)])
    column = clustering.packed(rows)
    assert (clustering.unpacked(column, 64) == rows).all()
    assert (clustering.unpacked(clustering.packed(rows[:2]), 64) == rows[:2]).all()
