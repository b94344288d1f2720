"""Time keys (T), frames (W), feature expressions (E), utilities (R) and the series they work on."""

from __future__ import annotations


from pyspark.sql import functions as F

from tidewheel.functions import frames as W
from tidewheel.functions import relational as R
from tidewheel.functions import timekeys as T
from tidewheel.functions.expr import FeatureSet, avg_over, diff, division, division_of_sums, first_over, max_over, median_over, min_over, monthly_avg_over, period_features, ratio, row_sum, stddev_over, sum_over, sum_over_months
from tidewheel.plans.registry import query
from tidewheel.sources.derived import ctes, profiles, revenue, usage

WEEKLY_SQL = ctes("revenue") + """, weekly AS (
  SELECT msisdn, weekstart, CAST(sum(amount) AS BIGINT) AS amt, count(*) AS trx, CAST(coalesce(sum(amount) FILTER (status = 'F'), 0) AS BIGINT) AS loan FROM revenue GROUP BY ALL)"""


def weekly(spark, d):
    """The weekly series of an id's orders."""
    r = revenue(spark, d)
    return r.groupBy("msisdn", "weekstart").agg(F.sum("amount").alias("amt"), F.count("*").alias("trx"), F.coalesce(F.sum(F.when(F.col("status") == "F", F.col("amount"))), F.lit(0)).alias("loan"))


def over(days: int, order: str = "weekstart", keys: str = "msisdn") -> str:
    """The frame of rolling(days) in DuckDB."""
    return f"(PARTITION BY {keys} ORDER BY {order} RANGE BETWEEN INTERVAL {days - 1} DAYS PRECEDING AND CURRENT ROW)"


def fixed(start: int, end: int, keys: str = "msisdn") -> str:
    less = lambda n: n - 1 if n else 0
    return f"(PARTITION BY {keys} ORDER BY weekstart RANGE BETWEEN INTERVAL {less(start)} DAYS PRECEDING AND INTERVAL {less(end)} DAYS PRECEDING)"


PERIODS = (("2w", 14), ("1m", 28), ("2m", 56), ("3m", 91))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) + CAST(8 - isodow(o_orderdate) AS INTEGER) AS weekstart, CAST(o_orderdate AS DATE) - CAST(isodow(o_orderdate) - 1 AS INTEGER) AS monday FROM orders")
def t1_t2_week_starts(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    return o.select("o_orderkey", T.next_week_start("o_orderdate").alias("weekstart"), T.prev_week_start("o_orderdate").alias("monday"))


@query(WEEKLY_SQL + " SELECT msisdn, weekstart, amt FROM weekly WHERE weekstart BETWEEN DATE '1998-01-19' AND DATE '1998-04-13'")
def t3_t4_run_window(spark, d):
    first, last = T.run_window(T.strip_prefix("fea_amt_03m"), last="1998-04-13")
    return weekly(spark, d).filter(F.col("weekstart").between(F.lit(first), F.lit(last))).select("msisdn", "weekstart", "amt")


@query(ctes("revenue") + ", b AS (SELECT min(event_date) AS lo, max(event_date) AS hi FROM revenue) SELECT CAST(date AS DATE) AS date, CAST(date AS DATE) + CAST(8 - isodow(date) AS INTEGER) AS weekstart FROM b, unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY)) AS t(date)")
def t5_date_spine(spark, d):
    lo, hi = revenue(spark, d).agg(F.min("event_date"), F.max("event_date")).first()
    return T.date_spine(spark, lo, hi)


@query(WEEKLY_SQL + " SELECT DISTINCT weekstart, CAST(date_trunc('month', weekstart) - CASE WHEN day(weekstart) < 10 THEN INTERVAL 2 MONTHS ELSE INTERVAL 1 MONTH END AS DATE) AS month FROM weekly")
def t6_sla_month(spark, d):
    return weekly(spark, d).select("weekstart", T.sla_month("weekstart", 10).alias("month")).distinct()


@query(WEEKLY_SQL + " SELECT msisdn, weekstart, " + ", ".join(f"CAST(sum(amt) OVER {over(n)} AS BIGINT) AS amt_{n}" for _, n in PERIODS) + ", CAST(sum(amt) OVER (PARTITION BY msisdn ORDER BY weekstart) AS BIGINT) AS amt_all FROM weekly")
def w1_rolling(spark, d):
    return weekly(spark, d).select("msisdn", "weekstart", *(F.sum("amt").over(W.rolling(n)).alias(f"amt_{n}") for _, n in PERIODS), F.sum("amt").over(W.rolling(-1)).alias("amt_all"))


@query(WEEKLY_SQL + f" SELECT msisdn, weekstart, CAST(sum(amt) OVER {fixed(56, 28)} AS BIGINT) AS amt_56_28, CAST(sum(amt) OVER {fixed(28, 0)} AS BIGINT) AS amt_28_0 FROM weekly")
def w2_rolling_fixed(spark, d):
    return weekly(spark, d).select("msisdn", "weekstart", F.sum("amt").over(W.rolling_fixed(56, 28)).alias("amt_56_28"), F.sum("amt").over(W.rolling_fixed(28, 0)).alias("amt_28_0"))


@query(ctes("revenue") + " SELECT msisdn, weekstart, event_date, trx_id FROM (SELECT *, row_number() OVER (PARTITION BY msisdn, weekstart ORDER BY event_date DESC, trx_id DESC) AS n FROM revenue) WHERE n = 1")
def w3_last_row_per_week(spark, d):
    return W.last_row_per(revenue(spark, d), ["msisdn", "weekstart"], ["event_date", "trx_id"]).select("msisdn", "weekstart", "event_date", "trx_id")


@query(WEEKLY_SQL + """ SELECT msisdn, weekstart, CAST(sum(amt) OVER (PARTITION BY msisdn ORDER BY weekstart ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS BIGINT) AS last_4,
  CAST(sum(amt) OVER (PARTITION BY msisdn ORDER BY weekstart DESC ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS BIGINT) AS next_2 FROM weekly""")
def w4_w5_rows_frames(spark, d):
    return weekly(spark, d).select("msisdn", "weekstart", F.sum("amt").over(W.weeks_frame(4)).alias("last_4"), F.sum("amt").over(W.rows_frame(-2, -1, ascending=False)).alias("next_2"))


@query(WEEKLY_SQL + f" SELECT msisdn, weekstart, coalesce(list_sort(list(trx) OVER {fixed(28, 0)}), []) AS trx_0_to_28, coalesce(list_sort(list(trx) OVER {fixed(56, 28)}), []) AS trx_28_to_56 FROM weekly")
def w6_collect_windows(spark, d):
    return W.collect_windows(weekly(spark, d).select("msisdn", "weekstart", "trx"), ["trx"], [(28, 0), (56, 28)]).drop("trx")


@query(WEEKLY_SQL + " SELECT msisdn, weekstart, CAST(sum(amt) OVER (PARTITION BY msisdn ORDER BY weekstart RANGE BETWEEN INTERVAL 7 DAYS FOLLOWING AND INTERVAL 84 DAYS FOLLOWING) AS BIGINT) AS after, CAST(sum(amt) OVER (PARTITION BY msisdn ORDER BY weekstart RANGE BETWEEN INTERVAL 77 DAYS PRECEDING AND CURRENT ROW) AS BIGINT) AS before FROM weekly")
def w7_offset_window(spark, d):
    return weekly(spark, d).select("msisdn", "weekstart", F.sum("amt").over(W.offset_window(7, 84)).alias("after"), F.sum("amt").over(W.offset_window(-77, 0)).alias("before"))


@query(WEEKLY_SQL + """, a AS (SELECT *, last_value(CASE WHEN loan > 0 THEN weekstart END IGNORE NULLS) OVER (PARTITION BY msisdn ORDER BY weekstart ROWS BETWEEN 11 PRECEDING AND 1 PRECEDING) AS past FROM weekly)
SELECT msisdn, weekstart, CAST(CASE WHEN loan > 0 THEN 0 ELSE coalesce((weekstart - past) // 7, 99999) END AS BIGINT) AS weeks FROM a""")
def w8_weeks_since_last_activity(spark, d):
    return weekly(spark, d).select("msisdn", "weekstart", W.weeks_since_last_activity("loan", 11).alias("weeks"))


PARTIES_SQL = ctes("usage") + ", p AS (SELECT msisdn, weekstart, list(party) AS parties FROM usage GROUP BY ALL)"


def parties(spark, d):
    return usage(spark, d).groupBy("msisdn", "weekstart").agg(F.collect_list("party").alias("parties"))


@query(PARTIES_SQL + f" SELECT msisdn, weekstart, CAST(len(list_distinct(parties)) AS INTEGER) AS n_7, CAST(len(list_distinct(flatten(list(parties) OVER {over(21)}))) AS INTEGER) AS n_21 FROM p")
def w9_distinct_over_window(spark, d):
    return W.distinct_over_window(parties(spark, d), {"n_7": ("parties", 7), "n_21": ("parties", 21)}).drop("parties")


@query(ctes("usage") + " SELECT msisdn, strftime(event_date, '%Y-%m') AS month, count(DISTINCT party) AS unique_parties FROM usage GROUP BY ALL")
def w10_unique_list_per_month(spark, d):
    u = usage(spark, d).groupBy("msisdn", F.date_format("event_date", "yyyy-MM").alias("month"), "event_date").agg(F.collect_list("party").alias("parties"))
    return W.unique_list_per(u, "parties", ["msisdn", "month"])


@query(ctes("revenue") + f""", t AS (SELECT msisdn, weekstart, channel, sum(amount) AS v, count(*) AS n FROM revenue GROUP BY ALL),
g AS (SELECT w.msisdn, w.weekstart, c.channel, t.v, t.n FROM (SELECT DISTINCT msisdn, weekstart FROM revenue) w JOIN (SELECT DISTINCT msisdn, channel FROM revenue) c USING (msisdn) LEFT JOIN t ON t.msisdn = w.msisdn AND t.weekstart = w.weekstart AND t.channel = c.channel),
s AS (SELECT msisdn, weekstart, channel, sum(v) OVER {over(91, keys='msisdn, channel')} AS v, sum(n) OVER {over(91, keys='msisdn, channel')} AS n FROM g),
r AS (SELECT *, row_number() OVER (PARTITION BY msisdn, weekstart ORDER BY v DESC, n DESC, channel) AS r FROM s WHERE n IS NOT NULL)
SELECT msisdn, weekstart, channel AS dominant FROM r WHERE r = 1""")
def w11_dominant_category(spark, d):
    return W.dominant_category(revenue(spark, d).withColumn("one", F.lit(1).cast("long")), "channel", "amount", "one", 91)


RUNS_SQL = WEEKLY_SQL + """, z AS (SELECT *, loan = 0 AS zero, row_number() OVER (PARTITION BY msisdn ORDER BY weekstart) - row_number() OVER (PARTITION BY msisdn, loan = 0 ORDER BY weekstart) AS island FROM weekly),
runs AS (SELECT *, CASE WHEN zero THEN row_number() OVER (PARTITION BY msisdn, zero, island ORDER BY weekstart) ELSE 0 END AS run FROM z)"""


@query(RUNS_SQL + " SELECT msisdn, weekstart, loan FROM runs WHERE msisdn NOT IN (SELECT msisdn FROM runs WHERE run >= 4)")
def w12_streak_filter(spark, d):
    return W.streak_filter(weekly(spark, d), "msisdn", "weekstart", "loan", 4).select("msisdn", "weekstart", "loan")


INACTIVE_SQL = RUNS_SQL + ", periods AS (SELECT msisdn, island, min(weekstart) AS first_week, count(*) AS weeks FROM runs WHERE zero GROUP BY ALL)"


@query(INACTIVE_SQL + " SELECT msisdn, first_week, weeks FROM periods")
def w13_inactivity_periods(spark, d):
    return W.inactivity_periods(weekly(spark, d), "loan").select("msisdn", "first_week", "weeks")


@query(INACTIVE_SQL + ", c AS (SELECT weeks, count(*) AS cases FROM periods GROUP BY 1) SELECT weeks, cases, CAST(sum(cases) OVER (ORDER BY weeks ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS at_least FROM c")
def w13_cases_by_length(spark, d):
    return W.cases_by_length(W.inactivity_periods(weekly(spark, d), "loan"))


_ALL = (("01w", 7), ("01m", 28), ("03m", 91))


def _expressions_sql() -> str:
    cols = []
    for name, n in _ALL:
        w = over(n)
        cols += [("amt + loan" if n == 7 else f"CAST(sum(amt + loan) OVER {w} AS BIGINT)") + f" AS sum_amt_{name}"]
        cols += [("amt::DOUBLE" if n == 7 else f"avg(amt) OVER {w}") + f" AS avg_amt_{name}"]
        cols += [("amt" if n == 7 else f"{f}(amt) OVER {w}") + f" AS {k}_amt_{name}" for k, f in (("min", "min"), ("max", "max"), ("first", "first_value"))]
        cols += [("amt" if n == 7 else f"quantile_cont(amt, 0.5) OVER {w}") + f" AS median_amt_{name}"]
        cols += [f"stddev(amt) OVER {w} AS stddev_amt_{name}", f"(sum(amt) OVER {w})::DOUBLE / {max(n // 28, 1)} AS monthly_amt_{name}", f"(sum(loan) OVER {w})::DOUBLE / nullif((sum(trx) OVER {w})::DOUBLE, 0) AS per_trx_{name}"]
    return ", ".join(cols)


@query(WEEKLY_SQL + " SELECT msisdn, weekstart, " + _expressions_sql() + " FROM weekly")
def e1_e9_period_features(spark, d):
    periods = ("1w", "1m", "3m")
    fs = FeatureSet()
    fs.add("sum_amt_{period}", sum_over(["amt", "loan"]), *periods)
    week = lambda e: lambda name, days: e(name, days).cast("double")
    fs.add("avg_amt_{period}", week(avg_over("amt")), *periods)
    fs.add("min_amt_{period}", min_over("amt"), *periods).add("max_amt_{period}", max_over("amt"), *periods).add("first_amt_{period}", first_over("amt"), *periods)
    fs.add("median_amt_{period}", median_over("amt"), *periods).add("stddev_amt_{period}", stddev_over("amt"), *periods)
    fs.add("monthly_amt_{period}", monthly_avg_over("amt"), *periods).add("per_trx_{period}", division_of_sums("loan", "trx"), *periods)
    return period_features(weekly(spark, d), fs, ["msisdn", "weekstart"])


@query(ctes("revenue") + """, m AS (SELECT msisdn, CAST(date_diff('month', DATE '1995-01-01', event_date) AS INTEGER) + DATE '2000-01-01' AS month_mapped_dt, CAST(sum(amount) AS BIGINT) AS amt FROM revenue GROUP BY ALL)
SELECT msisdn, month_mapped_dt, amt AS amt_01m, CAST(sum(amt) OVER (PARTITION BY msisdn ORDER BY month_mapped_dt RANGE BETWEEN INTERVAL 2 DAYS PRECEDING AND CURRENT ROW) AS BIGINT) AS amt_03m FROM m""")
def e3_sum_over_months(spark, d):
    mapped = F.expr("date_add(date'2000-01-01', cast(months_between(trunc(event_date, 'month'), date'1995-01-01') as int))")
    m = revenue(spark, d).groupBy("msisdn", mapped.alias("month_mapped_dt")).agg(F.sum("amount").alias("amt"))
    e = sum_over_months("amt")
    return m.select("msisdn", "month_mapped_dt", *(e(p, T.period_days(p, month_mapped=True)).alias(f"amt_0{p}") for p in ("1m", "3m")))


@query(WEEKLY_SQL + " SELECT msisdn, weekstart, amt - loan AS diff, loan::DOUBLE / nullif(amt, 0) AS division, loan::DOUBLE / nullif(loan + amt, 0) AS ratio, amt + loan + trx AS total FROM weekly")
def e8_row_expressions(spark, d):
    return weekly(spark, d).select("msisdn", "weekstart", diff("amt", "loan").alias("diff"), division("loan", "amt").alias("division"), ratio("loan", "amt").alias("ratio"), row_sum(["amt", "loan", "trx"]).alias("total"))


@query(WEEKLY_SQL + " SELECT msisdn, weekstart, variable, value FROM (UNPIVOT weekly ON amt, trx, loan INTO NAME variable VALUE value)")
def r1_melt(spark, d):
    return R.melt(weekly(spark, d), ["msisdn", "weekstart"], ["amt", "trx", "loan"])


@query("SELECT CAST(s_suppkey AS BIGINT) AS key, s_name AS name, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer")
def r2_r3_unions(spark, d):
    s = spark.read.parquet(f"{d}/supplier.parquet").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    c = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return R.union_by_name([s, R.union_all(c, c)], missing=True)


_EVENTS = ("click", "error", "purchase", "signup", "view")


@query(ctes("usage") + " SELECT msisdn, " + ", ".join(f"n_{k}" for k in _EVENTS) + " FROM " + " FULL JOIN ".join(f"(SELECT msisdn, count(*) AS n_{k} FROM usage WHERE kind = '{k}' GROUP BY 1) {k}" + (" USING (msisdn)" if i else "") for i, k in enumerate(_EVENTS)))
def r4_full_join_all(spark, d):
    u = usage(spark, d)
    return R.full_join_all([u.filter(F.col("kind") == k).groupBy("msisdn").agg(F.count("*").alias(f"n_{k}")) for k in _EVENTS], ["msisdn"])


@query(WEEKLY_SQL + " SELECT msisdn, weekstart, amt AS fea_amount, trx AS fea_trx FROM weekly")
def r5_r9_column_names(spark, d):
    w = R.prefix_features(weekly(spark, d))
    mapped = R.apply_feature_mapping(w, {"fea_amt": "fea_amount"})
    return R.required_columns(mapped, ["fea_amount", "fea_trx", "fea_missing"], ["msisdn", "weekstart"])


@query("SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN NULL ELSE vec_id::DOUBLE END AS x FROM embeddings")
def r7_nan_to_null(spark, d):
    e = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", F.when(F.pmod("vec_id", F.lit(5)) == 0, F.lit(float("nan"))).otherwise(F.col("vec_id").cast("double")).alias("x"))
    return R.nan_to_null(e)


@query(ctes("revenue") + """, s AS (SELECT msisdn, channel, CAST(sum(amount) AS BIGINT) AS n FROM revenue GROUP BY ALL)
SELECT msisdn, channel AS channel_mode, n AS channel_mode_count FROM (SELECT *, row_number() OVER (PARTITION BY msisdn ORDER BY n DESC, channel) AS r FROM s) WHERE r = 1""")
def r10_mode_with_count(spark, d):
    return R.mode_with_count(revenue(spark, d), ["msisdn"], "channel", "amount")


@query(ctes("usage") + """, s AS (SELECT msisdn, weekstart, party, count(*) AS n FROM usage GROUP BY ALL)
SELECT msisdn, weekstart, party AS parties_mode FROM (SELECT *, row_number() OVER (PARTITION BY msisdn, weekstart ORDER BY n DESC, party) AS r FROM s) WHERE r = 1""")
def r11_mode_of_array(spark, d):
    return R.mode_of_array(parties(spark, d), "parties", ["msisdn", "weekstart"])


@query(WEEKLY_SQL + " SELECT * FROM weekly WHERE weekstart BETWEEN DATE '1997-01-06' AND DATE '1998-01-05' AND msisdn IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')")
def r12_allow_list(spark, d):
    return R.allow_list_between(weekly(spark, d), profiles(spark, d).filter("segment = 'BUILDING'"), "1997-01-06", "1998-01-05")


@query(ctes("revenue") + " SELECT msisdn, weekstart, trx_id FROM (SELECT *, row_number() OVER (PARTITION BY msisdn, weekstart ORDER BY event_date, trx_id) AS n FROM revenue WHERE channel IN ('1-URGENT', '2-HIGH') AND status <> 'P') WHERE n = 1")
def r13_r14_filter_dedupe(spark, d):
    r = revenue(spark, d).filter(F.col("channel").isin("1-URGENT", "2-HIGH")).filter("status <> 'P'")
    return R.dedupe(r, ["msisdn", "weekstart"], ["event_date", "trx_id"]).select("msisdn", "weekstart", "trx_id")


@query(ctes("revenue") + " SELECT msisdn, trx_id, amount FROM revenue")
def r15_select_by_rule(spark, d):
    r = revenue(spark, d)
    return R.select_by_rule(r, required=("msisdn",), excluded=("status",), prefixes=("week", "event_"), suffixes=("nel",), kinds=("numeric",))


UNIT = "CAST('0x' || substr(md5({k} || '#{s}'), 1, 8) AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE"


@query(ctes("profiles") + f" SELECT msisdn, segment FROM profiles WHERE {UNIT.format(k='msisdn', s=3)} < 0.25")
def r16_sample_ids(spark, d):
    return R.sample_ids(profiles(spark, d), "msisdn", 0.25, 3).select("msisdn", "segment")


FEATURES = R.sampled_names(["segment", "area", "region", "balance"], 2, 4)


@query(ctes("profiles") + f" SELECT msisdn, {', '.join(FEATURES)} FROM profiles ORDER BY {UNIT.format(k='msisdn', s=4)}, msisdn LIMIT 100")
def r16_sample_rows_and_features(spark, d):
    return R.sample_rows_and_features(profiles(spark, d), "msisdn", 100, 2, 4)


@query(ctes("profiles") + f", n AS (SELECT segment, count(*) AS n FROM profiles GROUP BY 1) SELECT msisdn, segment FROM profiles JOIN n USING (segment) WHERE {UNIT.format(k='msisdn', s=0)} * n < 20")
def r17_stratified_downsample(spark, d):
    return R.stratified_downsample(profiles(spark, d), ["segment"], "msisdn", 20).select("msisdn", "segment")


@query(ctes("profiles") + f""", n AS (SELECT segment, count(*) FILTER (balance < 500000) AS c, count(*) FILTER (balance >= 500000) AS t FROM profiles GROUP BY 1),
f AS (SELECT segment, least(1.0::DOUBLE, 40.0::DOUBLE / (c + t)) AS f, c, t FROM n)
SELECT msisdn, segment, balance < 500000 AS is_control FROM profiles JOIN f USING (segment) WHERE {UNIT.format(k='msisdn', s=0)} < CASE WHEN balance < 500000 THEN least(f, f * t * (0.25::DOUBLE / 0.75::DOUBLE) / c) ELSE f END""")
def r17_control_share(spark, d):
    p = profiles(spark, d).withColumn("is_control", F.col("balance") < 500_000)
    return R.downsample_with_control(p, ["segment"], "msisdn", F.col("is_control"), 40, 0.25).select("msisdn", "segment", "is_control")


@query(ctes("profiles") + f" SELECT msisdn, ['a', 'b', 'c'][CAST(floor({UNIT.format(k='msisdn', s=1)} * 3) AS INTEGER) + 1] AS value, CAST(floor({UNIT.format(k='msisdn', s=2)} * 5) AS INTEGER) AS batch FROM profiles")
def r18_r19_random_value_and_batch(spark, d):
    return profiles(spark, d).select("msisdn", R.random_value("msisdn", ["a", "b", "c"], 1).alias("value"), R.random_batch("msisdn", 5, 2).alias("batch"))


@query("SELECT l_orderkey, l_linenumber, l_partkey || '-' || l_suppkey || '|' || l_linenumber AS cell, CAST(l_partkey AS VARCHAR) AS area FROM lineitem")
def r20_normalise_cell_id(spark, d):
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    raw = li.select("l_orderkey", "l_linenumber", F.concat(F.lit('"'), F.concat_ws("-", "l_partkey", "l_suppkey"), F.lit("|"), "l_linenumber", F.lit('|"x')).alias("raw"))
    return raw.withColumn("cell", R.normalise_cell_id("raw")).withColumn("area", R.cell_area("cell")).drop("raw")


@query(WEEKLY_SQL + " SELECT msisdn, weekstart, amt, trx FROM weekly")
def r21_feature_subset(spark, d):
    w = weekly(spark, d)
    importance = w.agg(*(F.avg(c).alias(c) for c in ("amt", "trx"))).unpivot([], ["amt", "trx"], "feature", "importance")
    return R.feature_subset(w, importance, ["msisdn", "weekstart"])
