"""Lookup-table clustering against brute force in plain Python, with nulls, ties, repeats and empty tables."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidewheel.llm import centroids

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, rounds, dim):
    kept = [(i, [max(-(1 << 27), min(1 << 27, math.floor(256 * float(x)))) for x in np.array(v, np.float32).tolist()]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cs = [v for _, v in named[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    best = lambda v: min((far(v, c), n) for n, c in enumerate(cs))
    for _ in range(rounds if cs else 0):
        own = [best(v)[1] for _, v in kept]
        for n in range(len(cs)):
            if members := [v for (_, v), o in zip(kept, own, strict=True) if o == n]:
                cs[n] = [sum(col) // len(members) for col in zip(*members, strict=True)]
    return Counter((i, best(v)[1], best(v)[0]) for i, v in kept) if cs else Counter(), cs


def same(spark, rows, k, rounds, dim):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"v": F.lit("x"), "cluster": F.lit(3), "distance": F.lit(None).cast("double"), "c": F.lit(1)})
    found, final = centroids.clustered(df.repartition(3), k, rounds, dim)
    want, cs = brute(rows, k, rounds, dim)
    assert Counter((r.vec_id, r.cluster, r.distance) for r in found.collect()) == want
    assert final.tolist() == cs
    return found


def test_clusters(spark):
    r = random.Random(5)
    near = [(i, [r.gauss(i % 4, 0.2) for _ in range(6)]) for i in range(200)]
    found = same(spark, near, 7, 4, 6)
    assert sum(centroids.inertia(found).values()) == sum(x.distance for x in found.collect())


def test_ties_repeats_and_odd_rows(spark):
    """Equal vectors and ids, few vectors, an empty cluster, values of any size, rows that take no part."""
    inf, nan = float("inf"), float("nan")
    odd = [(1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 0.0]), (6, [-inf, 0.0]), (7, [0.5]), (8, [1.0, 2.0, 3.0]), (None, [0.25, -0.25]), (9, [1e30, -1e30]), (9, [0.0, 0.0]), (10, [0.0, 0.0]), (10, [0.0, 0.0]), (11, [-0.001, 1 / 256]), (12, [1.0, 0.0]), (13, [-1.0, 0.0])]
    for k in (1, 3, 40):
        same(spark, odd, k, 3, 2)
    same(spark, odd[:8], 4, 2, 2)
    same(spark, [], 4, 2, 2)
    same(spark, [(None, [1.0, 2.0])], 4, 2, 2)


def test_tables():
    """A distance is the sum of looked-up squares, for integers of any range; the smaller of equal centroids wins."""
    r = np.random.default_rng(3)
    x, c = r.integers(-300, 300, (500, 5)), r.integers(-(1 << 27), 1 << 27, (9, 5))
    assert (centroids.squared_distances(x, c) == ((x[:, None, :] - c[None]) ** 2).sum(2)).all()
    number, far = centroids.nearest(x, np.concatenate([x[:3], x[:3]]))
    assert number.max() < 3 and far[0] == 0


def test_inertia_beyond_a_long(spark):
    found = spark.createDataFrame([(1, 0, 1 << 62), (2, 0, 1 << 62), (3, 1, 5)], "vec_id long, cluster int, distance long")
    assert centroids.inertia(found) == {0: None, 1: 5}
