"""Sums within radii and nearest points on the nested grid, against all distances in plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidewheel.functions import nested_grid


def distance(p, q):
    a, b = math.radians(p[0]), math.radians(q[0])
    h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(q[1] - p[1]) / 2) ** 2
    return 12_742_000 * math.atan2(math.sqrt(h), math.sqrt(max(0.0, 1 - h)))


def world(seed):
    """A hot spot, one point many times, a loose cloud, places near the date line and the poles."""
    r = random.Random(seed)
    near = lambda lat, lon, d, n: [(max(-90.0, min(89.99, lat + r.gauss(0, d))), lon + r.gauss(0, d)) for _ in range(n)]
    points = near(1, 10, 0.002, 250) + [(1.001, 10.001)] * 60 + near(1, 10, 0.05, 150) + near(60, 179.99, 0.02, 40) + near(-89.9, 5, 0.05, 40) + [(None, 1.0), (91.0, 1.0)]
    places = near(1, 10, 0.02, 20) + near(60, -179.99, 0.02, 5) + near(-89.95, 100, 0.03, 5) + [(1.001, 10.001), (40.0, 40.0), (None, None)]
    return points, places


@pytest.mark.parametrize("few", [0, 300, 10**9])
def test_sums(spark, monkeypatch, few):
    monkeypatch.setattr(nested_grid, "DIRECT", few)
    points, places = world(few % 5)
    r = random.Random(1)
    rows = [(*p, r.choice([None, r.randrange(100)]), r.choice("ab")) for p in points]
    left = spark.createDataFrame([(i, *p) for i, p in enumerate(places)], "i int, lat double, lon double")
    right = spark.createDataFrame(rows, "y double, x double, v int, c string")
    radii = (300, 1500, 5000)
    out = nested_grid.sums_within(left, "i", ("lat", "lon"), right, ("y", "x"), radii, {"v": F.col("v"), "a": F.when(F.col("c") == "a", 1)})
    got = {x.i: x for x in out.collect()}
    fine = [x for x in rows if x[0] is not None and x[0] < 90]
    want = {}
    for i, p in enumerate(places):
        if p[0] is not None:
            d = [(distance(p, x[:2]), x) for x in fine]
            if min(k for k, _ in d) <= 5000:
                want[i] = {f"{n}_{m}m": sum((x[2] or 0) if n == "v" else x[3] == "a" for k, x in d if k <= m) for n in "va" for m in radii}
    assert got.keys() == want.keys() and all(got[i][c] == v for i, w in want.items() for c, v in w.items())
    assert nested_grid.sums_within(left, "i", ("lat", "lon"), right.limit(0), ("y", "x"), radii, {"v": F.col("v")}).count() == 0


@pytest.mark.parametrize("few", [0, 10**9])
def test_nearest(spark, monkeypatch, few):
    monkeypatch.setattr(nested_grid, "DIRECT", few)
    points, places = world(few % 7)
    r = random.Random(2)
    rows = [(k, *p, r.choice("ab")) for k, p in enumerate(points)]
    left = spark.createDataFrame([(i, *p) for i, p in enumerate(places)], "i int, lat double, lon double")
    right = spark.createDataFrame(rows, "k int, y double, x double, c string")
    got = {(x.i, x.c): (x.distance, x.k) for x in nested_grid.nearest_within(left, "i", ("lat", "lon"), right, ("y", "x"), 4000, ["c"], ["k"]).collect()}
    want = {}
    for i, p in enumerate(places):
        for c in "ab":
            near = [(distance(p, x[1:3]), x[0]) for x in rows if x[3] == c and x[1] is not None and x[1] < 90 and p[0] is not None]
            if near and min(near)[0] <= 4000:
                want[i, c] = min(near)
    assert got.keys() == want.keys() and all(abs(got[k][0] - v[0]) < 1e-4 for k, v in want.items())
    assert all(got[k][1] == v[1] or abs(distance(places[k[0]], rows[got[k][1]][1:3]) - v[0]) < 1e-4 for k, v in want.items())


def test_nearest_other(spark):
    """The place itself does not count, also where it stands alone in its cell, stands twice, or shares its spot."""
    points = [(0, 1.0, 1.0), (1, 1.0, 1.02), (1, 1.0, 1.02), (2, 1.03, 1.0), (3, 1.03, 1.0), (4, 5.0, 5.0), (5, 1.0, 1.0201)]
    df = spark.createDataFrame(points, "i int, lat double, lon double")
    other = df.select(F.col("i").alias("o"), F.col("lat").alias("y"), F.col("lon").alias("x"))
    got = {x.i: x.distance for x in nested_grid.nearest_within(df.distinct(), "i", ("lat", "lon"), other, ("y", "x"), 5000, [], [], other="o").collect()}
    want = {i: min(distance((a, b), (c, d)) for j, c, d in points if j != i) for i, a, b in points if i != 4}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-6 for i in want)
