"""Places and totals over ranges, stratified repeats, curves, ROC and tables at rest, against plain Python."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewheel.functions import quantiles, ranks
from tidewheel.operators import campaign, evaluation, master, quality
from tidewheel.sources import ledger


def test_row_numbers(spark):
    """One group of most rows, ties settled by the last column, nulls as a group; several ranges."""
    r = random.Random(3)
    rows = [(i, "big" if i % 10 else r.choice(["s", None]), r.choice([None, 1.0, 2.0, 3.0])) for i in range(3000)]
    df = spark.createDataFrame(rows, "i int, g string, x double").repartition(5)
    got = ranks.row_numbers(df, ["g"], [F.col("x").desc(), F.col("i").asc()], "n")
    assert got.columns == ["i", "g", "x", "n"]
    groups = defaultdict(list)
    for i, g, x in rows:
        groups[g].append((math.inf if x is None else -x, i))
    want = {i: k for g in groups.values() for k, (_, i) in enumerate(sorted(g), 1)}
    assert {x.i: x.n for x in got.collect()} == want
    assert ranks.row_numbers(df.limit(0), ["g"], [F.col("i").asc()], "n").count() == 0
    assert {x.i: x.n for x in ranks.row_numbers(df, [], [F.col("i").desc()], "n").collect()} == {i: 3000 - i for i in range(3000)}


def test_running_totals(spark):
    r = random.Random(4)
    rows = [(i, r.choice("aab"), r.randrange(10**12), None if i % 7 == 0 else 1) for i in range(2000)]
    df = spark.createDataFrame(rows, "i int, g string, v long, w int").repartition(6)
    got = {x.i: (x.upto_v, x.upto_w) for x in ranks.running_totals(df, ["g"], [F.col("i").asc()], ["v", "w"]).collect()}
    sums, want = defaultdict(lambda: [0, 0]), {}
    for i, g, v, w in rows:
        sums[g][0] += v
        sums[g][1] += w or 0
        want[i] = tuple(sums[g])
    assert got == want


def test_stratified_repeats_are_exact(spark):
    """In every repeat and stratum exactly the share of rows, those of the smallest hashes; a null stratum is one."""
    r = random.Random(5)
    rows = [(i, r.choice([0, 0, 0, 1, None]), r.choice("xy")) for i in range(2500)] + [(9000, 2, "x")]
    df = spark.createDataFrame(rows, "k int, a int, b string")
    for share in (0.0, 0.37, 1.0):
        got = evaluation.stratified_repeats(df, "k", ["a", "b"], share, 3).collect()
        assert Counter((x.k, x.repeat) for x in got) == Counter((i, n) for i, *_ in rows for n in range(3))
        train = {(x.k, x.repeat) for x in got if x.train}
        for n in range(3):
            strata = defaultdict(list)
            for i, a, b in rows:
                strata[a, b].append((hashlib.md5(f"{i}#{n}".encode()).hexdigest(), i))
            want = {i for s in strata.values() for _, i in sorted(s)[: math.floor(len(s) * share + 0.5)]}
            assert {i for i, m in train if m == n} == want


def test_roc_and_auc(spark):
    """Ties, null scores and labels, a group of one kind, a group of equal scores."""
    r = random.Random(6)
    rows = [("a", float(r.randrange(30)), r.randrange(2)) for _ in range(900)] + [("one", float(i), 1) for i in range(5)] + [("same", 1.0, i % 2) for i in range(6)] + [("a", None, 1), ("a", 3.0, None), (None, 1.0, 1), (None, 0.0, 0)]
    points = evaluation.roc_points(spark.createDataFrame(rows, "g string, score double, label int").repartition(4), ["g"])
    auc = {x.g: x.auc for x in evaluation.roc_areas(points, ["g"]).collect()}
    for g in ("a", "same", None):
        pos, neg = ([s for h, s, y in rows if h == g and s is not None and y == k] for k in (1, 0))
        assert math.isclose(auc[g], sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg)))
    assert auc["one"] is None
    for x in points.filter("g = 'a'").collect():
        for rate, k in ((x.tpr, 1), (x.fpr, 0)):
            of = [s for h, s, y in rows if h == "a" and s is not None and y == k]
            assert math.isclose(rate, sum(s >= x.score for s in of) / len(of))


def test_curves_of_groups(spark):
    """Each group's curve is that of its own rows; areas by trapezoids."""
    r = random.Random(7)
    rows = [(g, r.random() * (g + 1), r.randrange(2), r.randrange(2)) for g in (0, 1) for _ in range(400)]
    curves = evaluation.uplift_curves(spark.createDataFrame(rows, "g int, score double, treatment int, outcome int"), ["g"], 4)
    got = {(x.g, x.quantile): x for x in curves.collect()}
    for g in (0, 1):
        own = [x for x in rows if x[0] == g]
        edges = np.quantile([x[1] for x in own], [0.75, 0.5, 0.25])
        for q in range(1, 5):
            top = [x for x in own if 1 + sum(x[1] < e for e in edges) <= q]
            t, c = ([y for *_, w, y in top if w == k] for k in (1, 0))
            assert got[g, q].n == len(top) and math.isclose(got[g, q].uplift, sum(t) / len(t) - sum(c) / len(c), abs_tol=1e-12)
    areas = {x.g: x.auuc for x in evaluation.uplift_areas(curves, ["g"]).collect()}
    n, gain = ([0, *(getattr(got[0, q], a) for q in range(1, 5))] for a in ("n", "gain"))
    assert math.isclose(areas[0], sum((gain[i] + gain[i + 1]) / 2 * (n[i + 1] - n[i]) for i in range(4)) / n[-1])


def test_features_by_median_importance(spark):
    rows = [(r, f, v) for r in range(3) for f, v in (("a", 0.1), ("b", [0.9, 0.0, 0.0][r]), ("c", 0.2), ("d", 0.1))]
    summary = evaluation.importance_summary(spark.createDataFrame(rows, "repeat int, feature string, importance double"))
    assert evaluation.most_important(summary, 3) == ["c", "a", "d"]


@pytest.mark.parametrize("distinct", [10**9, 20])
def test_percentiles_of_many_values(spark, monkeypatch, distinct):
    """The built-in and the bracketed way give the same, for percentiles in any order and null groups."""
    monkeypatch.setattr(quantiles, "DISTINCT", distinct)
    monkeypatch.setattr(quantiles, "ACCURACY", 60)
    r = np.random.default_rng(9)
    groups = {"a": r.normal(size=2000), None: r.integers(0, 500, 900).astype(float), "few": np.array([1.0, 5.0, 5.0])}
    df = spark.createDataFrame([(g, float(x)) for g, v in groups.items() for x in v], "g string, x double").repartition(4)
    ps = (0.9, 0.0, 0.5, 0.25, 1.0, 0.501)
    got = {x.g: x.q for x in quantiles.exact_percentiles(df, ["g"], "x", ps).collect()}
    assert got.keys() == groups.keys() and all(np.allclose(got[g], np.quantile(v, ps), atol=1e-12) for g, v in groups.items())


def test_pace_by_criteria(spark):
    """The greatest criteria go first, whatever the rank of an id; a channel's limit fills its slots."""
    r = random.Random(1)
    rows = [(f"m{i}", f"c{i % 3}", "P" if i % 4 else "Q", *(float(r.randrange(3)) for _ in range(5))) for i in range(500)]
    df = spark.createDataFrame(rows, "msisdn string, campaign string, push_channel string, " + ", ".join(f"{c} double" for c in campaign.CRITERIA))
    limits = spark.createDataFrame([("P", 40), ("Q", 7)], "push_channel string, hourly int")
    got = {x.msisdn: (x.rank_by_channel, x.slot) for x in campaign.pace(df, limits).collect()}
    for channel, hourly in (("P", 40), ("Q", 7)):
        order = sorted((x for x in rows if x[2] == channel), key=lambda x: (*(-v for v in x[3:]), x[0], x[1]))
        assert all(got[x[0]] == (k, math.ceil(k / hourly)) for k, x in enumerate(order, 1))


def now():
    return F.lit("2024-05-01 00:00:00").cast("timestamp")


def table(spark, path):
    return sorted((x.family, x.campaign, x.channel, x.status) for x in ledger.read(spark, path).collect())


def test_upload_rewrites_touched_parts_only(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = lambda *r: spark.createDataFrame(r, "family string, campaign string, channel string")
    ledger.upload(spark, path, rows(("f", "a", "1"), ("f", "b", "1"), ("g", "c", "1"), (None, "n", "1")), ["family", "campaign"], "family", "one", now())
    before = {str(p) for p in tmp_path.rglob("ledger_part=p-g/*.parquet")}
    assert ledger.upload(spark, path, rows(("f", "a", "2"), ("f", "a", "3"), ("f", "a", "3"), (None, "n", "2")), ["family", "campaign"], "family", "two", now()) == 2
    want = [("f", "a", "1", "inactive"), ("f", "a", "2", "active"), ("f", "a", "3", "active"), ("f", "b", "1", "active"), ("g", "c", "1", "active")]
    key = lambda x: tuple(map(str, x))
    read = lambda v=None: sorted(((x.family, x.campaign, x.channel, x.status) for x in ledger.read(spark, path, v).collect()), key=key)
    assert read() == sorted([*want, (None, "n", "1", "inactive"), (None, "n", "2", "active")], key=key)
    assert {str(p) for p in tmp_path.rglob("ledger_part=p-g/*.parquet")} == before
    assert len(read(1)) == 4 and all(x[3] == "active" for x in read(1))
    # The same run again, and a run without rows, change nothing.
    assert ledger.upload(spark, path, rows(("f", "a", "9")), ["family", "campaign"], "family", "two", now()) == 2
    before_rerun = read()
    ledger.upload(spark, path, rows(("f", "a", "9")).limit(0), ["family", "campaign"], "family", "three", now())
    assert read() == before_rerun
    assert {x.deactivated_at is None for x in ledger.read(spark, path).filter("status = 'active'").collect()} == {True}


def test_failed_run_leaves_the_table(spark, tmp_path, monkeypatch):
    """A run that breaks after its rows are written is invisible; repeated, it takes effect once."""
    path = f"file://{tmp_path}/t"
    first = spark.createDataFrame([(1, "p", 1.0), (2, "q", 2.0)], "k int, part string, v double")
    second = spark.createDataFrame([(1, "p", float("nan")), (3, "q", 3.0)], "k int, part string, v double")
    ledger.upsert(spark, path, first, ["k", "part"], "part", "one")
    state = lambda: sorted((x.k, x.part, x.v) for x in ledger.read(spark, path).collect())
    with monkeypatch.context() as m:
        m.setattr(ledger, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            ledger.upsert(spark, path, second, ["k", "part"], "part", "two")
    assert state() == [(1, "p", 1.0), (2, "q", 2.0)] and ledger.newest(spark, path) == 1
    for _ in range(2):
        assert ledger.upsert(spark, path, second, ["k", "part"], "part", "two") == 2
    assert state() == [(1, "p", None), (2, "q", 2.0), (3, "q", 3.0)]


def test_profiles_merge_over_days(spark):
    """Days merged are the whole table: exact measures, and about as many different values; nothing is expanded by columns."""
    r = random.Random(3)
    rows = [(f"d{r.randrange(9)}", r.choice([None, r.randrange(10**6)]), r.choice(["x", "y ", " ", None])) for _ in range(4000)]
    df = spark.createDataFrame(rows, "day string, a int, b string").repartition(4)
    whole = {x.column: x for x in quality.table_profile(df.drop("day")).collect()}
    days = quality.day_profiles(df, "day")
    merged = {x.column: x for x in quality.merged_profiles(days).collect()}
    for c in "ab":
        assert all(getattr(merged[c], m) == getattr(whole[c], m) for m in ("n", "missing", "sum", "max", "min"))
        assert abs(merged[c].about - whole[c].distinct) <= 0.05 * whole[c].distinct
    assert merged["b"].about == 3 and math.isclose(merged["a"].mean, whole["a"].mean)
    some = {x.column: x for x in quality.merged_profiles(days.filter("day in ('d1', 'd2')")).collect()}
    assert some["a"].n == sum(d in ("d1", "d2") for d, *_ in rows)
    by = quality.merged_profiles(days, ["day"])
    assert {(x.day, x.n) for x in by.filter("column = 'a'").collect()} == set(Counter(d for d, *_ in rows).items())
    assert "Expand" not in quality.table_profile(df)._jdf.queryExecution().toString()


def test_bucketed_master_needs_no_exchange(spark):
    base = spark.range(1000).selectExpr("id as k", "id % 7 as w")
    features = [base.selectExpr("k", "w", f"k * {n} as fea_{n}").filter(f"k % {n + 2} = 0") for n in range(3)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = master.build_bucketed_master(base, features, ["k", "w"], 4)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 3 and "Exchange" not in plan
        assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, master.build_master(base, features, ["k", "w"]).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
