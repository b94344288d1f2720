"""Work that grows with the rows: no scaffold is joined, no element is copied for each frame, no window ranks modes."""

import os
from collections import Counter

from pyspark.sql import functions as F

from tidewheel.functions.frames import distinct_over_window, percentiles_over_window
from tidewheel.operators import features, mobility, periods, scaffold, segments
from tidewheel.plans import segment_plans

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_dense_weekly(spark):
    """The same as the scaffold joined: gaps, weeks between the scaffold's, doubled rows, null weeks and ids."""
    days = [("a", "2024-01-01", 1), ("a", "2024-01-22", None), ("a", "2024-01-22", 3), ("a", "2024-02-05", 4), ("b", "2024-01-01", 5), ("b", "2024-01-10", 6), ("b", "2024-01-11", 7), ("b", "2024-01-31", 8),
            ("c", "2024-01-08", 9), ("d", None, 1), (None, "2024-01-01", 2), (None, "2024-01-01", 3), (None, "2024-01-15", 4)]
    df = spark.createDataFrame(days, "msisdn string, weekstart string, v int").withColumn("weekstart", F.to_date("weekstart"))
    grid, keys = scaffold.weekly_scaffold()(df), ["msisdn", "weekstart"]
    for zero, join in ((False, scaffold.fill_time_series), (True, scaffold.fill_with_zero)):
        got = scaffold.dense_weekly(df, zero=zero)
        assert Counter(got.collect()) == Counter(join(grid, df, keys).select(*got.columns).collect())
    assert "Join" not in plan(scaffold.dense_weekly(df))


def test_sweep_counts_occurrences_once(spark):
    df = spark.createDataFrame([("a", 1, ["x", "y"]), ("a", 8, ["x", None]), ("a", 15, None), ("a", 29, ["y", "x"]), (None, 3, ["z"])], "msisdn string, d int, c array<string>").withColumn("weekstart", F.date_from_unix_date("d"))
    out = distinct_over_window(df, {"n7": ("c", 7), "n14": ("c", 14), "n28": ("c", 28)})
    assert {(r.msisdn, r.d): (r.n7, r.n14, r.n28) for r in out.collect()} == {("a", 1): (2, 2, 2), ("a", 8): (2, 3, 3), ("a", 15): (0, 2, 3), ("a", 29): (2, 2, 3), (None, 3): (1, 1, 1)}
    text = plan(out)
    assert text.count("Generate") == 2 and text.rindex("Aggregate") > text.index("Generate")  # elements are counted below the moves


def test_device_modes(spark):
    rows = [("a", "2024-01-01", 7, "p"), ("a", "2024-01-01", 5, "p"), ("a", "2024-01-08", 7, None), ("a", "2024-01-15", None, None), ("b", "2024-01-08", 7, "q"), ("b", "2024-02-12", 1, "p")]
    df = spark.createDataFrame(rows, "msisdn string, w string, tac long, maker string").select("msisdn", F.to_date("w").alias("weekstart"), "tac", "maker")
    out = features.device_modes(df)
    got = {(r.msisdn, str(r.weekstart)): (r.fea_device_tac_mode_01w, r.fea_device_tac_mode_04w, r.fea_device_maker_mode_01w, r.fea_device_maker_mode_04w, r.fea_device_same_tac_ids, r.fea_device_same_maker_ids) for r in out.collect()}
    assert got == {("a", "2024-01-01"): (5, 5, "p", "p", 1, 1), ("a", "2024-01-08"): (7, 7, None, "p", 2, None), ("a", "2024-01-15"): (None, 7, None, "p", None, None), ("b", "2024-01-08"): (7, 7, "q", "q", 2, 1), ("b", "2024-02-12"): (1, 1, "p", "p", 1, 1)}
    assert "Window" not in plan(out)


def test_stay_frequency(spark):
    rows = [("a", "2000-01-01", "y", 2), ("a", "2000-01-01", "x", 2), ("a", "2000-01-02", "z", 3), ("a", "2000-01-02", "y", None), ("b", "2000-01-01", "q", None), ("b", "2000-01-01", "p", None)]
    df = spark.createDataFrame(rows, "msisdn string, m string, cell string, visits long").select("msisdn", F.to_date("m").alias("month_mapped_dt"), "cell", "visits")
    out = mobility.stay_frequency(df, "cell", (1, 3))
    got = {(r.msisdn, str(r.month_mapped_dt)): (r.top_cell_01m, r.top_cell_03m, r.top_visits_01m, r.top_visits_03m) for r in out.collect()}
    assert got == {("a", "2000-01-01"): ("x", "x", 2, 2), ("a", "2000-01-02"): ("z", "z", 3, 3), ("b", "2000-01-01"): ("p", "p", None, None)}


def test_closing_measures_sort_once(spark):
    """All periods are frames over one sort of the series; a measure sees its period's rows only."""
    days = [("a", "2024-01-01", 1), ("a", "2024-01-08", None), ("a", "2024-01-15", 4), ("a", "2024-01-29", 6), ("b", "2024-01-22", 5), (None, "2024-01-08", 2)]
    df = spark.createDataFrame(days, "msisdn string, w string, v long").select("msisdn", F.to_date("w").alias("weekstart"), "v")
    spans = {"p": ("2024-01-08", "2024-01-15"), "q": ("2024-01-15", "2024-01-22")}
    out = periods.closing_measures(df, {"sum": periods.over(F.sum, "v", 28), "idle": periods.idle("v")}, spans)
    got = {(r.msisdn, str(r.weekstart)): (r.sum_p, r.idle_p, r.sum_q, r.idle_q) for r in out.collect()}
    assert got == {("a", "2024-01-01"): (None, None, None, None), ("a", "2024-01-08"): (None, 1, None, None), ("a", "2024-01-15"): (4, 1, 4, 0), ("a", "2024-01-29"): (4, 1, 4, 0), ("b", "2024-01-22"): (None, None, 5, 0), (None, "2024-01-08"): (2, 0, None, None)}
    physical = out._jdf.queryExecution().executedPlan().toString()
    assert physical.split("== Initial Plan ==")[-1].count("Sort [") == 1


def test_model_rows_are_at_rest(spark):
    """Fits and profiles read their rows many times, so neither the rows nor the clusters are made again for each."""
    w = segment_plans.wide(spark, SF)
    assert not any(x in plan(w) for x in ("Aggregate", "Join"))
    names = [r.segment for r in w.select("segment").distinct().collect()]
    clustered = segments.kmeans_by_segment(w, segment_plans.COLUMNS, names, 2)
    assert not any(x in plan(clustered) for x in ("Union", "UDF"))
    assert Counter(r.msisdn for r in clustered.collect()) == Counter(r.msisdn for r in w.collect())


def test_dominant_categories_deal_rows_once(spark):
    """no join of weeks and categories; gaps, ties, null categories, weeks and ids."""
    rows = [("a", "2024-01-01", "x", 5), ("a", "2024-01-01", "y", 3), ("a", "2024-01-08", "y", 2), ("a", "2024-02-12", None, 9), ("b", "2024-01-01", "z", None), (None, "2024-01-01", "x", 1), ("a", None, "w", 50)]
    df = spark.createDataFrame(rows, "msisdn string, w string, method string, amount long").select("msisdn", F.to_date("w").alias("weekstart"), "method", "amount")
    out = features.app_revenue(df, ("1w", "1m"))
    assert "Join" not in plan(out)
    got = {(r.msisdn, str(r.weekstart)): (r.fea_app_rev_sum_01w, r.fea_app_rev_sum_01m, r.fea_app_rev_trx_01m, r.fea_app_rev_dominant_method_01w, r.fea_app_rev_dominant_method_01m) for r in out.collect()}
    assert got == {("a", "2024-01-01"): (8, 8, 2, "x", "x"), ("a", "2024-01-08"): (2, 10, 3, "y", "y"), ("a", "2024-02-12"): (9, 9, 1, None, None), ("b", "2024-01-01"): (None, None, 1, "z", "z"), (None, "2024-01-01"): (1, 1, 1, None, None), ("a", "None"): (50, 50, 1, None, None)}


def test_percentiles_skip_empty_steps(spark):
    """Values are handed to the steps that have rows, not to all steps of the frame."""
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 84, 3.0), ("a", 91, None), ("b", 7, 2.0)], "msisdn string, d int, v double").withColumn("weekstart", F.date_from_unix_date("d"))
    out = percentiles_over_window(df, {"m": ("v", 91, 0.5)})
    assert {(r.msisdn, r.d): r.m for r in out.collect()} == {("a", 0): 1.0, ("a", 84): 2.0, ("a", 91): 3.0, ("b", 7): 2.0}
    assert "explode(_ahead" in plan(out)  # not a fixed list of steps
