"""Clustering over a pivot table against plain integer arithmetic."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k, rounds, size):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(64 * float(np.float32(x))) for x in v]))
    if not kept:
        return []
    def rank(row):
        return (row[0] is None, hashlib.sha256(f"1:{row[0]}".encode()).hexdigest() if row[0] is not None else "", row[1])
    points = [v for _, v in sorted(kept, key=rank)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        points = [[sum(x) // len(groups[c]) for x in zip(*groups[c])] if c in groups else p for c, p in enumerate(points)]
    placed = [(i, nearest(v)) for i, v in kept]
    whole = sum(d for _, (d, _) in placed)
    by = {c: sum(d for _, (d, x) in placed if x == c) for c in range(len(points))}
    names = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return [(i, c, d, by[c], whole, names[c]) for i, (d, c) in placed]


def vectors(seed, n, size, groups, spread):
    rng = random.Random(seed)
    centres = [[rng.uniform(-2, 2) for _ in range(size)] for _ in range(groups)]
    return [(i, [c + rng.gauss(0, spread) for c in rng.choice(centres)]) for i in range(n)]


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).withColumn("cluster", F.lit("x")).withColumn("total", F.lit(1))
    return centroids.clusters(df, **how)


def shown(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("seed,n,size,groups,spread,k,rounds", [(1, 600, 8, 5, 0.3, 7, 3), (2, 200, 4, 1, 0.01, 16, 2), (3, 90, 8, 9, 1.0, 4, 0)])
def test_against_plain(spark, seed, n, size, groups, spread, k, rounds):
    rows = vectors(seed, n, size, groups, spread)
    got = run(spark, rows, k=k, rounds=rounds, dimensions=size).drop("n_exact").collect()
    assert shown(tuple(r) for r in got) == shown(plain(rows, k, rounds, size))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [-3.0, 2.5]), (None, [0.0, 0.0]), (2, None), (3, []), (4, [1.0]),
            (5, [1.0, None]), (6, [nan, 1.0]), (7, [1.0, -inf]), (8, [9.0, 9.0]), (9, [1.0, 2.0, 3.0]), (10, [-0.01, 0.01])]
    for k in (1, 3, 40):
        got = run(spark, rows, k=k, rounds=2, dimensions=2).drop("n_exact").collect()
        assert shown(tuple(r) for r in got) == shown(plain(rows, k, 2, 2))


def test_nothing_usable(spark):
    assert run(spark, []).count() == 0
    assert run(spark, [(1, [1.0]), (2, None)]).count() == 0


def test_too_large(spark):
    with pytest.raises(Exception, match="beyond"):
        run(spark, [(1, [1e30, 0.0])], dimensions=2).collect()


def test_bounds_spare_distances(spark):
    """Of well parted groups few centroids are left to measure."""
    rows = vectors(5, 2000, 16, 12, 0.05)
    got = run(spark, rows, k=16, rounds=3, dimensions=16)
    assert got.agg(F.avg("n_exact")).first()[0] < 6


def test_ties_and_extremes():
    """Equal distances give the smaller number; large components stay exact."""
    big = centroids.LARGEST
    points = np.array([[big, 0], [-big, 0], [big, 0], [0, big - 1]])
    table = centroids.roots(points, points[:1])
    cluster, d, _ = centroids.nearest(points, table, points, table)
    assert cluster.tolist() == [0, 1, 0, 3] and d.tolist() == [0, 0, 0, 0]
    middle = np.array([[0, 0], [1, -big]])
    cluster, d, _ = centroids.nearest(middle, centroids.roots(middle, points[:1]), points, table)
    assert cluster.tolist() == [3, 0] and d.tolist() == [(big - 1) ** 2, (big - 1) ** 2 + big**2]
