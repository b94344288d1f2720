"""Similar rows on bitmaps (D31, D32) against lists in plain Python and against the form with counts of leaf classes."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from tidewheel.operators import segments, similar


def test_equals_counts_of_classes(spark):
    r = random.Random(6)
    rows = [(str(i), [float(r.randrange(4)) for _ in range(3)], float(r.randrange(50))) for i in range(80)]
    df = spark.createDataFrame(rows, "msisdn string, leaves array<double>, amount double")
    counts = segments.below_top(segments.similar_counts(df, df, "msisdn", "amount"), "amount")
    want = {x.msisdn: x for x in segments.performance_of_classes(counts, df, "msisdn", "amount").collect()}
    got = {x.msisdn: x for x in similar.performance(df, df, "msisdn", "amount").collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[i][c], want[i][c]) for i in want for c in ("percentile", "p90", "p95", "p100"))


def test_many_buckets(spark):
    """More training rows than a bitmap holds; rows that are not in the training, values that it lacks, classes without similar rows."""
    r = np.random.default_rng(5)
    n = 70_000
    train = [(k, [int(a), 10 + int(b)], int(v)) for k, a, b, v in zip(range(n), r.integers(0, 3, n), r.integers(0, 3, n), r.integers(0, 4_000, n), strict=True)]
    rows = [(k, [k % 4, 10 + k % 5], int(v)) for k, v in enumerate(r.integers(-5, 8_000, 40))] + [(90, [7, 8], 5)]
    schema = "k long, leaves array<int>, v long"
    got = {x.k: x for x in similar.performance(spark.createDataFrame(train, schema), spark.createDataFrame(rows, schema), "k", "v").collect()}
    leaves, values = np.array([x[1] for x in train]), np.array([x[2] for x in train])
    assert 90 not in got
    for k, own_leaves, own in rows[:-1]:
        near = np.sort(values[(leaves == np.array(own_leaves)).any(1)])
        if not len(near):
            assert k not in got
            continue
        kept = near[near <= np.quantile(near, 0.95)]
        assert math.isclose(got[k].percentile, 100 * (kept < own).sum() / (len(kept) + 1))
        every = np.sort(np.append(kept, own))
        for c, s in (("p90", 0.9), ("p95", 0.95), ("p100", 1.0)):
            assert got[k][c] == every[max(1, math.ceil(len(every) * s)) - 1], (k, c)


def test_no_pairs_of_classes(spark):
    df = spark.createDataFrame([(1, [1, 2], 5), (2, [1, 3], None), (3, [4, 2], 7)], "k long, leaves array<int>, v long")
    out = similar.performance(df, df, "k", "v")
    assert {x.k for x in out.collect()} == {1, 3}
    assert similar.performance(df.limit(0), df, "k", "v").count() == 0 and similar.performance(df, df.limit(0), "k", "v").count() == 0


def test_places_of_ranks_and_counts(spark):
    """Every rank's place and every place's count, in a class of two bitmaps with one of them empty."""
    places = [1, 2, 8, 9, 16, 17, 32_768, 65_537, 65_544, 98_304]
    train = spark.range(1, 98_305).select(F.col("id").alias("k"), F.array(F.when(F.col("id").isin(places), 1).otherwise(0)).alias("leaves"), F.col("id").alias("v"))
    rows = spark.createDataFrame([(1, [1])], "k long, leaves array<int>")
    bitmaps, _ = similar.similar_bitmaps(train, rows, "k", "v")
    ranks = rows.select("leaves").withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(len(places)))))
    assert {x.r: x.place for x in similar.places_of_ranks(ranks, bitmaps, "r").collect()} == dict(enumerate(places))
    asked = [0, 1, 2, 7, 8, 9, 10, 16, 32_767, 32_768, 32_769, 65_536, 65_537, 65_543, 65_544, 98_303, 98_304]
    at = rows.select("leaves").withColumn("p", F.explode(F.array(*map(F.lit, asked))))
    assert {x.p: x.n for x in similar.ones_upto(at, bitmaps, "p", "n").collect()} == {p: sum(q <= p for q in places) for p in asked}
