"""Hand-computed rows: Mondays, frames, nulls, ties and empty inputs."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.functions import frames, geo, quantiles, relational, timekeys
from tidewheel.functions.expr import ratio
from tidewheel.operators import aggregation, campaign, features, quality, scaffold, segments
from tidewheel.sources import io

D = dt.date


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=lambda r: [str(x) for x in r])


def test_week_starts(spark):
    df = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 7),), (D(2024, 1, 8),), (None,)], "d date")
    got = df.select("d", timekeys.next_week_start("d").alias("n"), timekeys.prev_week_start("d").alias("p")).collect()
    assert [(r.n, r.p) for r in got] == [(D(2024, 1, 8), D(2024, 1, 1)), (D(2024, 1, 8), D(2024, 1, 1)), (D(2024, 1, 15), D(2024, 1, 8)), (None, None)]


def test_periods():
    assert [timekeys.period_days(p) for p in ("1w", "3w", "1m", "3m", "6m", "2cm")] == [7, 21, 28, 91, 182, 60]
    assert timekeys.period_days("2m", month_mapped=True) == 2 and timekeys.strip_prefix("fea_x_03m") == "3m"
    for bad in ("9w", "x"):
        with pytest.raises(ValueError):
            timekeys.period_days(bad)
    assert timekeys.run_window("1m", today=D(2024, 1, 10)) == (D(2023, 12, 18), D(2024, 1, 8))
    with pytest.raises(ValueError):
        timekeys.run_window("1m", last="2024-01-09")
    assert timekeys.last_month(D(2024, 3, 3)) == D(2024, 2, 1)


WEEKS = [D(2024, 1, 1) + dt.timedelta(7 * k) for k in range(12)]


def series(spark, values, key="a"):
    return spark.createDataFrame([(key, w, v) for w, v in zip(WEEKS, values, strict=False)], "msisdn string, weekstart date, v long")


def test_frames(spark):
    df = series(spark, range(1, 13))
    got = df.select("v", F.sum("v").over(frames.rolling(28)).alias("r"), F.sum("v").over(frames.rolling_fixed(56, 28)).alias("f"), F.sum("v").over(frames.rolling(-1)).alias("a")).orderBy("v").collect()
    assert [r.r for r in got][:5] == [1, 3, 6, 10, 14]
    assert got[11].f == 5 + 6 + 7 + 8 and got[3].f is None and got[11].a == 78


def test_weeks_since_last_activity(spark):
    df = series(spark, [0, 5, 0, None, 0, 1])
    got = df.select("weekstart", frames.weeks_since_last_activity("v", 3).alias("w")).orderBy("weekstart").collect()
    assert [r.w for r in got] == [99999, 0, 1, 2, 3, 0]


def test_streaks_and_inactivity(spark):
    df = series(spark, [1, 0, 0, 1, 0, 0, 0]).union(series(spark, [0, 0], "b"))
    assert {r.msisdn for r in frames.streak_filter(df, "msisdn", "weekstart", "v", 3).collect()} == {"b"}
    assert rows(frames.inactivity_periods(df, "v"), "msisdn", "weeks") == [("a", 2), ("a", 3), ("b", 2)]


def test_dominant_category_counts_absent_ones(spark):
    data = [("a", WEEKS[0], "x", 10, 1), ("a", WEEKS[1], "y", 4, 1), ("a", WEEKS[2], "z", 4, 1)]
    df = spark.createDataFrame(data, "msisdn string, weekstart date, c string, v long, n long")
    got = rows(frames.dominant_category(df, "c", "v", "n", 14), "weekstart", "dominant")
    assert got == [(WEEKS[0], "x"), (WEEKS[1], "x"), (WEEKS[2], "y")]


def test_ratio_is_a_share(spark):
    got = spark.createDataFrame([(1, 3), (0, 0), (None, 1)], "a int, b int").select(ratio("a", "b").alias("r")).collect()
    assert [r.r for r in got] == [0.25, None, None]


def test_geohash_known_values(spark):
    df = spark.createDataFrame([(57.64911, 10.40744), (-6.2, 106.8), (0.0, 0.0), (90.0, 0.0), (None, 1.0)], "lat double, lon double")
    assert [r.g for r in df.select(geo.geohash("lat", "lon").alias("g")).collect()] == ["u4pru", "qqguw", "s0000", None, None]


def test_cells_wrap_and_end(spark):
    df = spark.createDataFrame([(1, 0, 0)], "id int, cell_x int, cell_y int")
    got = {(r.cell_x, r.cell_y) for r in geo.expand_cells(df, own=False).collect()}
    assert got == {(8191, 0), (1, 0), (8191, 1), (0, 1), (1, 1)}


def test_modes_break_ties_by_value(spark):
    df = spark.createDataFrame([("a", "y", 2), ("a", "x", 2), ("a", None, 9), ("b", None, 1)], "k string, c string, n long")
    assert rows(relational.mode_with_count(df, ["k"], "c", "n"), "k", "c_mode", "c_mode_count") == [("a", "x", 2)]
    arrays = spark.createDataFrame([("a", ["p", "q"]), ("a", ["q"]), ("b", [])], "k string, v array<string>")
    assert rows(relational.mode_of_array(arrays, "v", ["k"]), "k", "v_mode") == [("a", "q"), ("b", None)]


def test_feature_mapping_errors(spark):
    df = spark.range(1).withColumn("b", F.lit(1))
    with pytest.raises(ValueError):
        relational.apply_feature_mapping(df, {"missing": "x"})
    with pytest.raises(ValueError):
        relational.apply_feature_mapping(df, {"id": "b"})


def test_decode_hex_sender(spark):
    df = spark.createDataFrame([("4?4B",), ("4F4B7",), ("628123",), ("shop",), (None,)], "s string")
    assert [r.x for r in df.select(aggregation.decode_hex_sender("s").alias("x")).collect()] == ["OK", "OK", "628123", "shop", None]


def test_scaffold_uses_its_key(spark):
    df = spark.createDataFrame([("o", WEEKS[0]), ("o", WEEKS[3]), ("p", WEEKS[1]), ("q", None)], "outlet string, weekstart date")
    assert rows(scaffold.weekly_scaffold("outlet")(df, df), "outlet", "weekstart") == [("o", w) for w in WEEKS[:4]] + [("p", WEEKS[1])]
    assert scaffold.weekly_scaffold("outlet")(df.limit(0)).count() == 0


def test_repayments_as_of(spark):
    taken = spark.createDataFrame([("a", D(2024, 1, 1), 1), ("a", D(2024, 1, 3), 2), ("a", D(2024, 2, 1), 3)], "msisdn string, event_date date, trx_id long")
    repaid = spark.createDataFrame([("a", D(2024, 1, 5), 10), ("a", D(2024, 1, 9), 11), ("a", D(2024, 2, 2), 12), ("b", D(2024, 1, 1), 13)], "msisdn string, event_date date, trx_id long")
    got = rows(features.repayments(taken, repaid), "trx_id", "loan_date", "days_to_repay")
    assert got == [(10, D(2024, 1, 1), 4), (11, D(2024, 1, 3), 6), (12, D(2024, 2, 1), 1), (13, None, None)]
    assert rows(features.unpaid_loans(taken, repaid), "trx_id", "without_repayment") == [(1, 0), (2, 1), (3, 0)]


def test_fixed_periods(spark):
    df = series(spark, [1, 1, 3, 3, 0, 0])
    got = features.fixed_period_compare(df, "v", {"pre": (str(WEEKS[0]), str(WEEKS[1])), "post": (str(WEEKS[2]), str(WEEKS[3]))}).orderBy("weekstart").collect()
    assert [r.fea_v_ratio_pre_post for r in got] == [None, None, 0.4, 0.25, 0.25, 0.25]


def test_phones(spark):
    df = spark.createDataFrame([("+62811",), ("0062811",), ("0811",), ("811",), ("62811",), (" 99 ",)], "p string")
    assert [r.x for r in df.select(campaign.normalise_phone("p").alias("x")).collect()] == ["62811"] * 5 + ["99"]


def test_pacing_fills_slots(spark):
    df = spark.createDataFrame([(f"m{i}", f"c{i % 3}", "sms", 1) for i in range(10)], "msisdn string, campaign string, push_channel string, rank int")
    limits = spark.createDataFrame([("sms", 4)], "push_channel string, hourly int")
    assert sorted(r.slot for r in campaign.pace(df, limits).collect()) == [1] * 4 + [2] * 4 + [3] * 2


def test_survival(spark):
    df = spark.createDataFrame([("g", 1, 1), ("g", 2, 0), ("g", 3, 1), ("g", 3, 1)], "g string, day int, event int")
    assert [round(r.survival, 6) for r in segments.survival_curve(df, "g").orderBy("day").collect()] == [0.75, 0.75, 0.0]


def test_rfm_bounds(spark):
    df = spark.createDataFrame([(10000,), (10001,), (None,)], "v int")
    assert [r.s for r in df.select(segments.band_score("v", (10000, 16040)).alias("s")).collect()] == [1, 2, 1]


def test_quality_of_arrays_and_nulls(spark):
    df = spark.createDataFrame([(WEEKS[0], 1, ["a"]), (WEEKS[0], None, ["a", "b"]), (WEEKS[0], -3, None)], "weekstart date, x int, l array<string>")
    got = {r["column"]: r for r in quality.accuracy_completeness(df, ["x", "l"]).collect()}
    assert round(got["x"].null_percent, 3) == 33.333 and round(got["x"].negative_percent, 3) == 33.333 and got["l"].max == 2


def test_upsert_and_checks(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k long, v double")
    b = spark.createDataFrame([(2, float("nan")), (2, 5.0), (3, 3.0)], "k long, v double")
    assert rows(io.keyed_upsert(a, b, ["k"]), "k", "v") == [(1, 1.0), (2, 5.0), (2, None), (3, 3.0)]
    with pytest.raises(ValueError):
        io.keyed_upsert(a, b, ["missing"])
    assert io.schema_check(a, T.StructType([T.StructField("k", T.IntegerType()), T.StructField("z", T.LongType())])) == ["k is bigint", "z is missing"]
    assert io.schema_check(a.limit(0), a.schema) == ["no rows"]


def test_versions_and_windows(spark, tmp_path):
    df = spark.range(3)
    for k, day in enumerate((D(2024, 1, 1), D(2024, 1, 2))):
        io.versioned_write(df.withColumn("v", F.lit(k)), str(tmp_path / "t"), day)
    assert {r.v for r in io.read_version(spark, str(tmp_path / "t")).collect()} == {1}
    assert {r.v for r in io.read_version(spark, str(tmp_path / "t"), version="2024-01-01").collect()} == {0}
    with pytest.raises(ValueError):
        io.read_version(spark, str(tmp_path / "t"), skip=2)
    with pytest.raises(ValueError):
        io.dated_window_read(spark, "x", "d", "", "%Y", D(2024, 1, 1))


def test_external_table(spark, tmp_path):
    spark.range(4).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(str(tmp_path / "t"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("p", T.LongType())])
    spark.sql("DROP TABLE IF EXISTS ext_t")
    io.register_external_table(spark, "ext_t", str(tmp_path / "t"), schema, ["p"])
    assert spark.table("ext_t").count() == 4


@pytest.mark.parametrize("accuracy", [10_000, 30])
def test_exact_percentiles(spark, monkeypatch, accuracy):
    """Against numpy: small groups whole, large ones by brackets, with ties, nulls and a group without values."""
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    monkeypatch.setattr(quantiles, "DISTINCT", accuracy)
    r = np.random.default_rng(5)
    groups = {"a": r.normal(size=700), "b": r.integers(0, 4, 500).astype(float), "c": np.array([3.5]), "d": np.array([1.0, 2.0]), "e": np.repeat(7.0, 90)}
    rows = [(g, float(x)) for g, v in groups.items() for x in v] + [("a", None), ("f", None)]
    ps = (0.0, 0.05, 0.25, 0.5, 0.9, 1.0)
    df = spark.createDataFrame(rows, "g string, x double")
    got = {x.g: x.q for x in quantiles.exact_percentiles(df, ["g"], "x", ps).collect()}
    assert set(got) == set(groups)
    assert all(np.allclose(got[g], np.quantile(v, ps), atol=1e-12) for g, v in groups.items())
    assert np.allclose(quantiles.percentiles_of(df, "x", (0.3, 0.7)), np.quantile(np.concatenate(list(groups.values())), (0.3, 0.7)))
    assert all(math.isnan(x) for x in quantiles.percentiles_of(df.limit(0), "x", (0.5,)))


def test_percent_rank(spark):
    r = random.Random(2)
    rows = [(k, r.choice("ab"), r.choice([None, *range(9)])) for k in range(300)] + [(900, "c", 1), (901, None, 2), (902, None, 2)]
    df = spark.createDataFrame(rows, "k int, g string, x int")
    want = {x.k: x.p for x in df.withColumn("p", F.percent_rank().over(Window.partitionBy("g").orderBy("x"))).collect()}
    got = {x.k: x.p for x in quantiles.percent_rank(df, "g", "x", "p").collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], abs_tol=1e-12) for k in want)


@pytest.mark.parametrize("metres", [300, 5_000, 60_000, 3_000_000])
def test_near_pairs_at_any_latitude(spark, metres):
    r = random.Random(8)
    spread = metres / 111_000 * 2
    points = [(65.0, 10.011), (65.0, 10.115), (89.9999, 3.0), (89.9, -170.0), (-90.0, 0.0), (0.0, 179.999), (0.0, -179.999), (None, 1.0), (95.0, 1.0)]
    for lat, lon in ((0, 0), (65, 10), (-83, 179.9), (89.5, 40)):
        points += [(max(-90.0, min(89.999, lat + r.uniform(-spread, spread))), (lon + r.uniform(-5, 5) * spread + 180) % 360 - 180) for _ in range(25)]
    left = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, lat double, lon double")
    right = left.selectExpr("i as j", "lat as lat2", "lon as lon2")
    got = geo.near_pairs(left, right, ("lat", "lon"), ("lat2", "lon2"), metres)
    pairs = [(x.i, x.j) for x in got.collect()]

    def distance(p, q):
        a, b = math.radians(p[0]), math.radians(q[0])
        h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(q[1] - p[1]) / 2) ** 2
        return 12_742_000 * math.atan2(math.sqrt(h), math.sqrt(max(0.0, 1 - h)))

    fine = [i for i, p in enumerate(points) if p[0] is not None and p[0] < 90]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {(i, j) for i in fine for j in fine if distance(points[i], points[j]) <= metres}


def test_app_rules_are_equi_joins(spark):
    content = spark.createDataFrame([("p", "x", "1"), ("q", "x", "2"), ("r", None, "1"), ("s", "y", None)], "accessed_app string, tier string, level string")
    rules = spark.createDataFrame([("A", "p", None, None), ("B", None, "x", None), ("C", None, "x", "1"), ("D", None, None, "1"), ("E", "s", "x", None), ("F", None, None, None)], "segment string, accessed_app string, tier string, level string")
    out = aggregation.app_mapping(content, rules.filter("segment <> 'F'"), ["tier", "level"])
    assert {tuple(x) for x in out.collect()} == {("p", "a"), ("p", "b"), ("q", "b"), ("p", "c"), ("p", "d"), ("r", "d")}
    assert "NestedLoop" not in out._jdf.queryExecution().toString()
    assert {x.accessed_app for x in aggregation.app_mapping(content, rules.filter("segment = 'F'"), ["tier", "level"]).collect()} == set("pqrs")
    assert aggregation.app_mapping(content, rules.limit(0), ["tier", "level"]).isEmpty()


def test_similar_rows_and_percentiles(spark):
    """D31 and D32 against their definition."""
    r = random.Random(6)
    rows = [(str(i), [float(r.randrange(4)) for _ in range(3)], float(r.randrange(50))) for i in range(60)]
    df = spark.createDataFrame(rows, "msisdn string, leaves array<double>, amount double")
    similar = segments.similar_rows(df, df.select("msisdn", "leaves"), "msisdn", "amount")
    got = {x.msisdn: x["values"] for x in similar.collect()}
    want = {}
    for i, leaves, _ in rows:
        near = [v for _, other, v in rows if any(a == b for a, b in zip(leaves, other))]
        want[i] = sorted(v for v in near if v <= np.quantile(near, 0.95))
    assert got == want
    pct = {x.msisdn: x for x in segments.performance_percentile(similar, df, "msisdn", "amount").collect()}
    for i, _, own in rows:
        every = sorted([*want[i], own])
        assert math.isclose(pct[i].percentile, 100 * sum(v < own for v in every) / len(every)) and pct[i].p100 == every[-1] and pct[i].p90 == every[math.ceil(len(every) * 0.9) - 1]
    counts = segments.below_top(segments.similar_counts(df, df, "msisdn", "amount"), "amount")
    by_class = {x.msisdn: x for x in segments.performance_of_classes(counts, df, "msisdn", "amount").collect()}
    assert by_class.keys() == pct.keys()
    for i, x in pct.items():
        assert all(math.isclose(by_class[i][c], x[c]) for c in ("percentile", "p90", "p95", "p100")), (x, by_class[i])


def test_distinct_over_window(spark):
    """The sweep against sets of every frame: gaps, repeats, null elements and arrays, several rows a day, two columns, three frames."""
    r = random.Random(11)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    some = lambda: r.choice([None, [], [r.choice(["a", "b", None, "c"]) for _ in range(r.randrange(5))]])
    rows = [(i, r.choice(["x", "y", None]), day(r.randrange(80)), some(), [r.randrange(6)]) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, k string, weekstart date, s array<string>, n array<int>").repartition(4)
    counts = {"s1": ("s", 1), "s14": ("s", 14), "n14": ("n", 14), "n400": ("n", 400)}
    out = frames.distinct_over_window(df, counts, ["k"])
    assert out.columns == [*df.columns, *counts]
    found = {x.i: x for x in out.collect()}
    for i, k, at, *_ in rows:
        for name, (c, days) in counts.items():
            every = {e for _, k2, u, s, n in rows if k2 == k and 0 <= (at - u).days < days for e in ((s or []) if c == "s" else n)}
            assert found[i][name] == len(every), (i, name)
    assert frames.distinct_over_window(df.limit(0), counts, ["k"]).count() == 0
    one = frames.distinct_over_window(df, counts, ["k"])._jdf.queryExecution().toString()
    assert "collect_list" not in one


def test_percentiles_over_window(spark):
    """Exact percentiles of every frame against numpy: gaps, nulls, repeated weeks, null keys."""
    r = random.Random(12)
    rows = [(i, r.choice(["x", "y", None]), dt.date(2024, 1, 1) + dt.timedelta(7 * r.randrange(30)), r.choice([None, r.random(), float(r.randrange(4))]), r.randrange(9)) for i in range(250)]
    df = spark.createDataFrame(rows, "i int, k string, weekstart date, a double, b int").repartition(3)
    wanted = {"a28": ("a", 28, 0.5), "a7": ("a", 7, 0.5), "b91": ("b", 91, 0.25), "b28": ("b", 28, 0.9)}
    out = frames.percentiles_over_window(df, wanted, ["k"])
    assert out.columns == [*df.columns, *wanted]
    found = {x.i: x for x in out.collect()}
    for i, k, at, *_ in rows:
        for name, (c, days, p) in wanted.items():
            every = [v for _, k2, u, a, b in rows if k2 == k and 0 <= (at - u).days < days and (v := a if c == "a" else b) is not None]
            assert (found[i][name] is None) if not every else math.isclose(found[i][name], np.quantile(every, p), abs_tol=1e-12)
