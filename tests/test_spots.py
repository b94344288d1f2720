"""Many rows on few spots: spots are compared, rows share what is found."""

import pytest
from pyspark.sql import functions as F

from tests.test_nested_grid import distance
from tidewheel.functions import geo, nested_grid
from tidewheel.operators import mobility

SPOTS = [(1.0, 10.0), (1.001, 10.001), (1.02, 10.0)]
HOMES = [(i, *SPOTS[i % 3]) for i in range(90)]
POIS = [(i, *SPOTS[i % 2]) for i in range(80)]


@pytest.fixture
def tables(spark):
    return spark.createDataFrame(HOMES, "i int, lat double, lon double"), spark.createDataFrame(POIS, "k int, y double, x double")


@pytest.fixture
def compared(monkeypatch):
    """Rows given to the comparison of spots."""
    seen, real = [], geo.near_spots

    def near_spots(left, right, *args):
        seen.append((left.count(), right.count()))
        return real(left, right, *args)

    for module in (geo, nested_grid, mobility):
        monkeypatch.setattr(module, "near_spots", near_spots)
    return seen


def test_pairs(tables, compared):
    got = sorted((r.i, r.k, r.distance) for r in geo.near_pairs(*tables, ("lat", "lon"), ("y", "x"), 1000, digits=3).collect())
    want = [(i, k, round(distance(p, q), 3)) for i, *p in HOMES for k, *q in POIS if distance(p, q) <= 1000]
    assert [g[:2] for g in got] == [w[:2] for w in want] and all(abs(a[2] - b[2]) < 0.0011 for a, b in zip(got, want, strict=True))
    assert compared == [(3, 2)]


def test_nearest_cluster(tables, compared):
    homes, pois = tables
    found = pois.select(F.col("y").alias("lat"), F.col("x").alias("lon"), (F.col("k") % 4 != 1).cast("int").alias("is_cluster"))
    got = {r.msisdn: r for r in mobility.nearest_cluster(homes.withColumnRenamed("i", "msisdn"), found, 5000).collect()}
    for i, *p in HOMES:
        d = [distance(p, q) for k, *q in POIS if k % 4 != 1]
        assert abs(got[i].min_distance - min(d)) < 1e-6 and abs(got[i].avg_distance - sum(d) / len(d)) < 1e-6
    assert compared == [(3, 2)]


def test_grid(tables, compared):
    homes, pois = tables
    near = {r.i: (r.distance, r.k) for r in nested_grid.nearest_within(homes, "i", ("lat", "lon"), pois, ("y", "x"), 5000, [], ["k"]).collect()}
    sums = {r.i: r.some_1000m for r in nested_grid.sums_within(homes, "i", ("lat", "lon"), pois, ("y", "x"), (1000, 5000), {"some": F.lit(1)}).collect()}
    for i, *p in HOMES:
        assert near[i][1] == min((round(distance(p, q), 6), k) for k, *q in POIS)[1]
        assert sums[i] == sum(distance(p, q) <= 1000 for _, *q in POIS)
    assert compared and all(left == 3 for left, _ in compared)


def test_other_on_one_spot(spark, compared):
    """A place whose own point is the nearest takes the nearest of another, also where places share a spot or a row is doubled."""
    rows = [(0, 1.0, 10.0), (0, 1.0, 10.0), (1, 1.0, 10.0), (2, 1.0, 10.0), (3, 1.01, 10.0), (4, 1.01, 10.0001), (5, 9.0, 10.0)]
    other = spark.createDataFrame([(*r, r[0]) for r in rows] + [(None, 1.01, 10.0, 9)], "o int, y double, x double, k int")
    places = spark.createDataFrame(sorted(set(rows)), "i int, lat double, lon double")
    got = {r.i: (r.distance, r.k) for r in nested_grid.nearest_within(places, "i", ("lat", "lon"), other, ("y", "x"), 5000, [], ["k"], other="o").collect()}
    want = {i: min((distance(p, q), k) for k, *q in rows if k != i) for i, *p in rows if i != 5}
    assert got.keys() == want.keys() and all(abs(got[i][0] - want[i][0]) < 1e-6 and got[i][1] == want[i][1] for i in want)
    assert compared and all(left == 4 for left, _ in compared)


@pytest.fixture
def short_lists(spark, monkeypatch):
    """Lists of few rows, and as many tasks as there are partitions."""
    monkeypatch.setattr(geo, "RIGHT_ROWS", 64, raising=False)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", before)


def test_pairs_of_one_spot_are_dealt_to_all_tasks(spark, short_lists):
    """Rows of one spot and its neighbour, nulls, doubled rows and a row off the map: the pairs are whole and no task makes most of them."""
    left = spark.range(600).selectExpr("if(id % 10 = 0, null, id) i", "1.0 lat", "10.0 lon").union(spark.createDataFrame([(7, 1.0, 10.0), (8, None, 10.0), (9, 5.0, 10.0)], "i long, lat double, lon double"))
    right = spark.range(3000).selectExpr("id k", "cast(id as string) name", "1.0 y", "10.0 + id % 2 * 0.001 x").union(spark.createDataFrame([(4, "4", 1.0, 10.0), (5, None, float("nan"), 10.0)], "k long, name string, y double, x double"))
    got = geo.near_pairs(left, right, ("lat", "lon"), ("y", "x"), 1000, digits=3)
    assert got.columns == ["i", "lat", "lon", "k", "name", "y", "x", "distance"]
    by = got.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.sum(F.coalesce("i", F.lit(0)) * 7 + F.col("k")).alias("s"), F.sum(F.col("distance") * 1000).cast("long").alias("d")).collect()
    ids, keys = [i if i % 10 else 0 for i in range(600)] + [7], [*range(3000), 4]
    assert sum(r.n for r in by) == 601 * 3001
    assert sum(r.s for r in by) == sum(ids) * 7 * 3001 + sum(keys) * 601
    assert sum(r.d for r in by) == round(1000 * round(distance((1.0, 10.0), (1.0, 10.001)), 3)) * 601 * 1500
    assert got.filter("i is null").count() == 60 * 3001 and got.filter("cast(k as string) <> name").isEmpty()
    assert len(by) == 4 and max(r.n for r in by) < 0.45 * 601 * 3001
