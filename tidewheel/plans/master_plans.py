"""Master tables (M), data quality (Q) and campaigns (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewheel.operators import campaign as C
from tidewheel.operators import master as M
from tidewheel.operators import quality as Q
from tidewheel.plans.place_plans import KIND_NAMES, PACK_SQL, packed
from tidewheel.plans.registry import query
from tidewheel.plans.time_plans import UNIT, WEEKLY_SQL, weekly
from tidewheel.functions.relational import hash_unit
from tidewheel.sources import io as S
from tidewheel.sources import ledger
from tidewheel.sources.derived import ctes, outlets, products, profiles, revenue, usage


@query(PACK_SQL + " SELECT substr(msisdn, 1, 5) || md5(msisdn || 'salt') AS msisdn, unnest(use_case) AS use_case FROM packed")
def m1_master_dimension(spark, d):
    return M.master_dimension(packed(spark, d), "salt")


MASTER_SQL = WEEKLY_SQL + """, trx AS (SELECT msisdn, weekstart, trx AS fea_trx FROM weekly WHERE trx > 1), loan AS (SELECT msisdn, weekstart, loan AS fea_loan FROM weekly WHERE loan > 0)"""


def master(spark, d):
    w = weekly(spark, d)
    trx = w.filter("trx > 1").select("msisdn", "weekstart", F.col("trx").alias("fea_trx"))
    loan = w.filter("loan > 0").select("msisdn", "weekstart", F.col("loan").alias("fea_loan"))
    return M.build_master(w.select("msisdn", "weekstart"), [trx, loan], ["msisdn", "weekstart"])


@query(MASTER_SQL + " SELECT msisdn, weekstart, fea_trx, fea_loan FROM weekly LEFT JOIN trx USING (msisdn, weekstart) LEFT JOIN loan USING (msisdn, weekstart)")
def m2_build_master(spark, d):
    return master(spark, d)


@query(MASTER_SQL + " SELECT msisdn, weekstart, fea_trx, fea_loan FROM weekly LEFT JOIN trx USING (msisdn, weekstart) LEFT JOIN loan USING (msisdn, weekstart)")
def m2_bucketed_master(spark, d):
    w = weekly(spark, d)
    trx = w.filter("trx > 1").select("msisdn", "weekstart", F.col("trx").alias("fea_trx"))
    loan = w.filter("loan > 0").select("msisdn", "weekstart", F.col("loan").alias("fea_loan"))
    return M.build_bucketed_master(w.select("msisdn", "weekstart"), [trx, loan], ["msisdn", "weekstart"], 8)


@query("SELECT * FROM (VALUES ('fea_trx', 'a', true), ('fea_loan', 'a', true), ('fea_x', 'b', (SELECT count(*) FROM orders WHERE o_totalprice < 0) > 0)) t(feature, \"table\", has_data)")
def m3_feature_metadata(spark, d):
    empty = revenue(spark, d).filter("amount < 0").withColumn("fea_x", F.lit(1))
    return M.feature_metadata({"a": master(spark, d), "b": empty})


@query(ctes("outlets") + " SELECT outlet_id, district, n_name AS area, r_name AS region FROM outlets LEFT JOIN nation ON n_nationkey = district LEFT JOIN region ON r_regionkey = n_regionkey")
def m4_outlet_master(spark, d):
    n = spark.read.parquet(f"{d}/nation.parquet").select(F.col("n_nationkey").alias("district"), F.col("n_name").alias("area"), F.col("n_regionkey").alias("region_id"))
    r = spark.read.parquet(f"{d}/region.parquet").select(F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region"))
    return M.outlet_master(outlets(spark, d).select("outlet_id", "district"), [n, r], ["district", "region_id"]).drop("region_id")


@query(WEEKLY_SQL + " SELECT msisdn, max(weekstart) AS weekstart, arg_max(amt, weekstart) AS amt FROM weekly GROUP BY 1")
def m4_latest_only(spark, d):
    return M.latest_only(weekly(spark, d).select("msisdn", "weekstart", "amt"))


@query(ctes("products") + """, r AS (SELECT outlet_id, event_date, sum(amount) AS t FROM products GROUP BY ALL),
c AS (SELECT outlet_id FROM products GROUP BY 1 HAVING min(event_date) < DATE '1995-03-01'),
m AS (SELECT outlet_id, CAST(date_trunc('month', event_date) AS DATE) AS month, CAST(sum(t) AS BIGINT) AS target, sum(t)::DOUBLE / nullif(count(*) FILTER (t > 0), 0) AS target_mean, CAST(max(t) AS BIGINT) AS target_max, CAST(arg_max(t, event_date) AS BIGINT) AS target_last FROM r WHERE outlet_id IN (SELECT outlet_id FROM c) GROUP BY ALL)
SELECT m.*, l.target AS target_lag_1m FROM m LEFT JOIN m l ON l.outlet_id = m.outlet_id AND l.month = CAST(m.month - INTERVAL 1 MONTH AS DATE)""")
def m5_outlet_monthly(spark, d):
    p = products(spark, d)
    daily = p.groupBy("outlet_id", "event_date").agg(*(F.sum(F.when(F.col("product") == n.upper(), F.col("amount"))).alias(n) for n in KIND_NAMES))
    created = p.groupBy("outlet_id").agg(F.min("event_date").alias("created_at"))
    return M.outlet_monthly(daily, list(KIND_NAMES), created, "1995-03-01")


@query(ctes("products") + """, r AS (
  SELECT outlet_id, CAST(date_trunc('month', event_date) AS DATE) AS month, event_date, coalesce(sum(amount) FILTER (product = 'PROMO'), 0) AS promo,
         sum(quantity) AS quantity FROM products GROUP BY ALL),
m AS (
  SELECT outlet_id, month, count(*) AS active_days, CAST(sum(promo) AS BIGINT) AS promo_sum, avg(promo) AS promo_mean, CAST(sum(quantity) AS BIGINT) AS quantity_sum,
         avg(quantity) AS quantity_mean FROM r WHERE promo <> 0 GROUP BY ALL)
SELECT m.*, """ + ", ".join(f"l{k}.{c} AS {c}_lag_{k}m" for k in (1, 2, 3) for c in ("promo_sum", "promo_mean", "quantity_sum", "quantity_mean")) + " FROM m "
    + " ".join(f"LEFT JOIN m l{k} ON l{k}.outlet_id = m.outlet_id AND l{k}.month = CAST(m.month - INTERVAL {k} MONTH AS DATE)" for k in (1, 2, 3)))
def m5_outlet_monthly_numbers(spark, d):
    daily = products(spark, d).groupBy("outlet_id", "event_date").agg(F.sum(F.when(F.col("product") == "PROMO", F.col("amount"))).alias("promo"), F.sum("quantity").alias("quantity"))
    return M.outlet_monthly_numbers(daily, ["promo", "quantity"], "promo", (1, 2, 3))


@query(ctes("outlets") + " SELECT outlet_id, CASE WHEN balance < 1000 THEN 'poor' ELSE 'far' END AS reason FROM outlets WHERE balance < 1000 OR lat > -5.85")
def m6_removal_report(spark, d):
    o = outlets(spark, d)
    rich = o.filter("balance >= 1000")
    return M.removal_report(o, {"poor": rich, "far": rich.filter("lat <= -5.85")})


@query(ctes("revenue", "usage") + """, s AS (SELECT msisdn, event_date, amount, CASE WHEN status = 'F' THEN amount ELSE 0 END AS digital FROM revenue UNION ALL SELECT msisdn, event_date, amount, 0 FROM usage)
SELECT msisdn, event_date - CAST(isodow(event_date) - 1 AS INTEGER) AS monday, CAST(sum(amount) AS BIGINT) AS revenue, CAST(sum(digital) AS BIGINT) AS digital FROM s GROUP BY ALL""")
def m7_revenue_by_monday(spark, d):
    a = revenue(spark, d).withColumn("digital", F.when(F.col("status") == "F", F.col("amount")).otherwise(0))
    return M.revenue_by_monday([a, usage(spark, d).withColumn("digital", F.lit(0).cast("long"))])


@query(WEEKLY_SQL + """ SELECT msisdn, weekstart, CASE WHEN count(*) OVER w = 3 THEN min(loan) OVER w ELSE 1 END AS target FROM weekly WINDOW w AS (PARTITION BY msisdn ORDER BY weekstart ROWS BETWEEN 2 FOLLOWING AND 4 FOLLOWING)""")
def m8_churn_target(spark, d):
    return M.churn_target(weekly(spark, d), "loan", 2, 3).select("msisdn", "weekstart", "target")


CAMPAIGN_SQL = WEEKLY_SQL + """, slice AS (SELECT w.*, CASE WHEN CAST(msisdn AS BIGINT) % 2 = 0 THEN 1 ELSE 0 END AS is_treatment, weekstart >= DATE '1998-01-05' AS after FROM weekly w WHERE weekstart BETWEEN DATE '1998-01-05' - 364 AND DATE '1998-01-05' + 364)"""


def campaign_slice(spark, d):
    treated = profiles(spark, d).filter(F.col("msisdn").cast("long") % 2 == 0)
    return M.training_slice(weekly(spark, d), "1998-01-05", 364, 364, treated)


@query(CAMPAIGN_SQL + " SELECT msisdn, avg(amt) FILTER (after) - avg(amt) FILTER (NOT after) AS target FROM slice GROUP BY 1 HAVING avg(amt) FILTER (after) - avg(amt) FILTER (NOT after) IS NOT NULL")
def m9_in_life_target(spark, d):
    return M.in_life_target(campaign_slice(spark, d), "amt")


@query(CAMPAIGN_SQL + " SELECT msisdn, max(loan) AS target FROM slice WHERE after AND msisdn NOT IN (SELECT msisdn FROM slice WHERE NOT after AND loan > 0) GROUP BY 1")
def m9_adoption_target(spark, d):
    return M.adoption_target(campaign_slice(spark, d), "loan")


@query(CAMPAIGN_SQL + " SELECT msisdn, weekstart, is_treatment, after FROM slice")
def m10_training_slice(spark, d):
    return campaign_slice(spark, d).select("msisdn", "weekstart", "is_treatment", "after")


@query(ctes("products") + """, c AS (SELECT maker AS campaign, product AS type, event_date AS date, trx_id AS wording FROM products)
SELECT campaign, type, date, wording FROM (SELECT *, row_number() OVER (PARTITION BY campaign ORDER BY CASE type WHEN 'PROMO' THEN 1 WHEN 'ECONOMY' THEN 2 ELSE 3 END, date DESC, wording) AS n FROM c) WHERE n = 1""")
def m11_campaign_wordings(spark, d):
    p = products(spark, d).select(F.col("maker").alias("campaign"), F.col("product").alias("type"), F.col("event_date").alias("date"), F.col("trx_id").alias("wording"))
    return M.campaign_wordings(p, ["PROMO", "ECONOMY"])


@query(ctes("revenue") + " SELECT trx_id, event_date FROM revenue WHERE isodow(event_date) = 1")
def m12_monday_snapshots(spark, d):
    return M.monday_snapshots(revenue(spark, d)).select("trx_id", "event_date")


def _month_mode(c: str) -> str:
    return f"m_{c} AS (SELECT * FROM (SELECT outlet_id, month, {c} AS {c}_mode, row_number() OVER (PARTITION BY outlet_id, month ORDER BY count(*) DESC, {c}) AS r FROM r GROUP BY outlet_id, month, {c}) WHERE r = 1)"


@query(ctes("products") + f""", r AS (SELECT *, CAST(date_trunc('month', event_date) AS DATE) AS month FROM products), {_month_mode("product")}, {_month_mode("maker")},
t AS (SELECT outlet_id, month, sum(amount)::DOUBLE / nullif(sum(quantity)::DOUBLE, 0) AS unit_price FROM r GROUP BY ALL) SELECT t.*, product_mode, maker_mode FROM t LEFT JOIN m_product USING (outlet_id, month) LEFT JOIN m_maker USING (outlet_id, month)""")
def m5_outlet_monthly_modes(spark, d):
    return M.outlet_monthly_modes(products(spark, d), ["product", "maker"], {"unit_price": ("amount", "quantity")})


@query(ctes("revenue") + """, c AS (SELECT DISTINCT CASE WHEN trx_id % 2 = 0 THEN upper(channel) ELSE lower(channel) END AS campaign FROM revenue),
one AS (SELECT min(campaign) AS campaign FROM c GROUP BY lower(campaign)),
t AS (SELECT lower(channel) AS name, min(event_date) AS first_date, max(event_date) AS last_date, count(DISTINCT msisdn) FILTER (status = 'O') AS ids_O, count(DISTINCT msisdn) FILTER (status = 'F') AS ids_F FROM revenue GROUP BY 1)
SELECT campaign, first_date, last_date, ids_O, ids_F FROM one LEFT JOIN t ON name = lower(campaign)""")
def m11_campaign_tracking(spark, d):
    r = revenue(spark, d)
    c = r.select(F.when(F.pmod("trx_id", F.lit(2)) == 0, F.upper("channel")).otherwise(F.lower("channel")).alias("campaign")).distinct()
    return M.campaign_tracking(c, r.select(F.col("channel").alias("campaign"), "msisdn", F.col("status").alias("stage"), "event_date"), ["O", "F"])


@query(ctes("revenue", "usage", "profiles") + """, u AS (SELECT msisdn, event_date, sum(amount) AS used, NULL AS paid FROM usage GROUP BY ALL UNION ALL SELECT msisdn, event_date, NULL, sum(amount) FROM revenue GROUP BY ALL),
s AS (SELECT * FROM u WHERE isodow(event_date) = 1)
SELECT r.trx_id, r.msisdn, r.event_date, CAST(used AS BIGINT) AS used, CAST(paid AS BIGINT) AS paid, segment FROM revenue r LEFT JOIN s ON s.msisdn = r.msisdn AND s.event_date = r.event_date - CAST(isodow(r.event_date) - 1 AS INTEGER) LEFT JOIN profiles p ON p.msisdn = r.msisdn""")
def m12_campaign_master(spark, d):
    used, paid = (t.groupBy("msisdn", "event_date").agg(F.sum("amount").alias(n)) for t, n in ((usage(spark, d), "used"), (revenue(spark, d), "paid")))
    return M.campaign_master(revenue(spark, d).select("trx_id", "msisdn", "event_date"), [used, paid], profiles(spark, d).select("msisdn", "segment"))


GAPS_SQL = WEEKLY_SQL + ", g AS (SELECT msisdn, date_trunc('month', weekstart)::DATE AS weekstart, CASE WHEN loan = 0 THEN NULL ELSE loan - 20000000 END AS loan, trx - 1 AS trx FROM weekly)"


def gaps(spark, d):
    """The weekly series by month, with nulls, zeros and negative values."""
    w = weekly(spark, d)
    return w.select("msisdn", F.trunc("weekstart", "month").alias("weekstart"), F.when(F.col("loan") != 0, F.col("loan") - 20000000).alias("loan"), (F.col("trx") - 1).alias("trx"))


def _metric_sql(c: str) -> str:
    return f"SELECT weekstart, '{c}' AS \"column\", max({c})::DOUBLE AS max, min({c})::DOUBLE AS min, round(avg({c}), 4) AS mean, avg(({c} IS NULL)::INTEGER) * 100 AS null_percent, avg(coalesce({c} < 0, false)::INTEGER) * 100 AS negative_percent, " + ", ".join(f"quantile_cont({c}, {p})::DOUBLE AS percentile_{str(p)[2:]}" for p in (0.25, 0.5, 0.75)) + " FROM {t} GROUP BY 1"


METRICS_SQL = GAPS_SQL + ", metrics AS (" + " UNION ALL ".join(_metric_sql(c).format(t="g") for c in ("loan", "trx")) + ")"


@query(METRICS_SQL + " SELECT * FROM metrics")
def q1_accuracy_completeness(spark, d):
    return Q.accuracy_completeness(gaps(spark, d), ["loan", "trx"])


@query(GAPS_SQL + """, l AS (SELECT weekstart, 'loan' AS "column", loan AS v FROM g UNION ALL SELECT weekstart, 'trx', trx FROM g), q AS (SELECT weekstart, "column", quantile_cont(v, 0.25)::DOUBLE AS q1, quantile_cont(v, 0.75)::DOUBLE AS q3 FROM l GROUP BY ALL)
SELECT weekstart, "column", count(*) FILTER (v < q1 - 1.5 * (q3 - q1)) AS below, count(*) FILTER (v > q3 + 1.5 * (q3 - q1)) AS above FROM l JOIN q USING (weekstart, "column") GROUP BY ALL""")
def q2_tukey_outliers(spark, d):
    return Q.tukey_outliers(gaps(spark, d), ["loan", "trx"])


@query(WEEKLY_SQL + """ SELECT weekstart, 'loan' AS "column", avg((CASE WHEN CAST(msisdn AS BIGINT) % 10 = 0 THEN false ELSE true END)::INTEGER) * 100 AS same_percent FROM weekly GROUP BY 1 UNION ALL SELECT weekstart, 'trx', 100.0 FROM weekly GROUP BY 1""")
def q3_consistency(spark, d):
    w = weekly(spark, d)
    new = w.withColumn("loan", F.when(F.col("msisdn").cast("long") % 10 == 0, F.col("loan") + 1).otherwise(F.col("loan")))
    return Q.consistency(w, new, ["msisdn", "weekstart"], ["loan", "trx"])


@query(WEEKLY_SQL + " SELECT CAST(date_trunc('month', weekstart) AS DATE) AS month, count(DISTINCT msisdn) AS ids FROM weekly GROUP BY 1")
def q4_monthly_unique_ids(spark, d):
    return Q.monthly_unique_ids(weekly(spark, d))


@query(GAPS_SQL + """, w AS (SELECT weekstart, max(loan)::DOUBLE AS a, avg(trx) AS b FROM g GROUP BY 1) SELECT weekstart, 'loan' AS "column", 'max' AS metric, a AS value FROM w UNION ALL SELECT weekstart, 'trx', 'mean', b FROM w""")
def q5_melt_metrics(spark, d):
    wide = gaps(spark, d).groupBy("weekstart").agg(F.max("loan").cast("double").alias("loan__max"), F.avg("trx").alias("trx__mean"))
    return Q.melt_metrics(wide, ["weekstart"])


@query(GAPS_SQL + f", s AS (SELECT * FROM g WHERE {UNIT.format(k='msisdn', s=0)} < 0.5), metrics AS (" + " UNION ALL ".join(_metric_sql(c).format(t="s") for c in ("loan", "trx")) + ") SELECT *, 'weekly' AS \"table\", 'r1' AS run FROM metrics")
def q6_sampled_metrics(spark, d):
    ids = profiles(spark, d).filter(hash_unit("msisdn") < 0.5)
    return Q.sampled_metrics(gaps(spark, d), ids, ["loan", "trx"], "weekly", "r1")


SCORE_SQL = WEEKLY_SQL + """, v AS (SELECT 'weekly' AS "table", 'amt' AS "column", 'max' AS metric, weekstart AS run_date, max(amt)::DOUBLE AS value FROM weekly GROUP BY 4 UNION ALL SELECT 'weekly', 'trx', 'mean', weekstart, round(avg(trx), 4) FROM weekly GROUP BY 4),
q AS (SELECT *, quantile_cont(value, 0.25) OVER w AS q1, quantile_cont(value, 0.75) OVER w AS q3 FROM v WINDOW w AS (PARTITION BY "column", metric ORDER BY run_date RANGE BETWEEN INTERVAL 433 DAYS PRECEDING AND CURRENT ROW)),
scores AS (SELECT "table", "column", metric, run_date, value, CASE WHEN value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN 100 ELSE 0 END AS score FROM q)"""


def scores(spark, d):
    per = weekly(spark, d).groupBy(F.col("weekstart").alias("run_date")).agg(F.max("amt").cast("double").alias("amt__max"), F.round(F.avg("trx"), 4).alias("trx__mean"))
    return Q.threshold_score(Q.melt_metrics(per, ["run_date"]).withColumn("table", F.lit("weekly")), 434, step=7)


@query(SCORE_SQL + " SELECT * FROM scores")
def q7_threshold_score(spark, d):
    return scores(spark, d)


@query(SCORE_SQL + " SELECT CASE WHEN \"column\" = 'amt' THEN 'revenue' ELSE 'other' END AS domain, CASE metric WHEN 'max' THEN 'accuracy' ELSE 'validity' END AS dimension, avg(score) AS score, count(*) AS n FROM scores GROUP BY ALL")
def q8_domain_scores(spark, d):
    return Q.domain_scores(scores(spark, d), {"amt": "revenue"}, {"max": "accuracy", "mean": "validity"})


@query(SCORE_SQL + """, n AS (SELECT max(run_date) AS run_date FROM scores)
SELECT 'aggregation' AS layer, CASE WHEN "column" = 'amt' THEN 'revenue' ELSE 'other' END AS domain, CASE metric WHEN 'max' THEN 'accuracy' ELSE 'validity' END AS dimension, avg(score) AS score, count(*) AS n
FROM scores JOIN n USING (run_date) GROUP BY ALL""")
def q8_layer_scores(spark, d):
    return Q.layer_scores(scores(spark, d), {"weekly": "aggregation"}, {"amt": "revenue"}, {"max": "accuracy", "mean": "validity"})


@query(ctes("usage") + """, a AS (SELECT kind AS "table", list(DISTINCT event_date - CAST(day(event_date) % 7 = 0 AND kind <> 'view' AS INTEGER)) AS have FROM usage GROUP BY 1), m AS (SELECT "table", list_sort(list_filter(list_transform(range(0, 40), lambda i: DATE '2024-01-01' + CAST(i AS INTEGER)), lambda x: NOT list_contains(have, x))) AS missing FROM a)
SELECT "table", missing, CAST(len(missing) AS INTEGER) AS n_missing, 100.0::DOUBLE * (40 - len(missing)) / 40 AS score FROM m""")
def q9_availability(spark, d):
    # What comes on every seventh day is said to have come the day before, but for one table.
    u = usage(spark, d).select(F.col("kind").alias("table"), F.expr("date_sub(event_date, cast(day(event_date) % 7 = 0 and kind <> 'view' as int))").alias("event_date"))
    return Q.availability(u, "2024-01-01", "2024-02-09")


@query(ctes("usage") + """, t AS (SELECT 'usage' AS "table", event_date, max(event_date::TIMESTAMP + to_hours(CAST(event_id % 300 AS INTEGER))) AS delivered FROM usage GROUP BY ALL), l AS (SELECT *, greatest((epoch(delivered) - epoch((event_date + 2)::TIMESTAMP)) / 3600, 0.0::DOUBLE) AS delay_hours FROM t)
SELECT "table", event_date, delay_hours, greatest(0.0::DOUBLE, 100 * (168 - delay_hours) / 168) AS score FROM l""")
def q10_timeliness(spark, d):
    u = usage(spark, d).select(F.lit("usage").alias("table"), "event_date", F.expr("timestampadd(HOUR, cast(event_id % 300 as int), cast(event_date as timestamp))").alias("delivered"))
    return Q.timeliness(u, 2).drop("delivered")


@query("""SELECT count(*) AS n, 'c_custkey' AS "column", count(DISTINCT c_custkey) AS "distinct", sum(c_custkey)::DOUBLE AS sum, avg(c_custkey) AS mean, max(c_custkey)::DOUBLE AS max, min(c_custkey)::DOUBLE AS min, count(*) FILTER (c_custkey IS NULL) AS missing, 0.0::DOUBLE AS missing_percent FROM customer
UNION ALL SELECT count(*), 'c_mktsegment', count(DISTINCT c_mktsegment), NULL, NULL, NULL, NULL, count(*) FILTER (c_mktsegment IS NULL OR trim(c_mktsegment) = ''), 0.0 FROM customer""")
def q11_table_profile(spark, d):
    return Q.table_profile(spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", "c_mktsegment"))


@query(ctes("revenue") + "".join(f""", p{i} AS (
  SELECT '{c}' AS "column", count(*) AS n, count(*) FILTER ({c} IS NULL) AS missing, {f"sum({c})::DOUBLE" if c == "amount" else "NULL::DOUBLE"} AS sum, {f"avg({c})" if c == "amount" else "NULL::DOUBLE"} AS mean,
         {f"max({c})::DOUBLE" if c == "amount" else "NULL::DOUBLE"} AS max, {f"min({c})::DOUBLE" if c == "amount" else "NULL::DOUBLE"} AS min, CASE WHEN count(DISTINCT {c}) <= 50 THEN count(DISTINCT {c}) END AS few FROM revenue)"""
    for i, c in enumerate(("amount", "channel", "status"))) + " SELECT * FROM p0 UNION ALL SELECT * FROM p1 UNION ALL SELECT * FROM p2")
def q11_merged_profile(spark, d):
    """Profiles of days, stored in two runs and merged over all days."""
    path = S.scratch(spark)
    r = revenue(spark, d).select(F.date_format("event_date", "yyyy-MM").alias("day"), "amount", "channel", "status")
    for run, days in (("first", "day < '1995-01'"), ("second", "day >= '1995-01'")):
        ledger.upsert(spark, path, Q.day_profiles(r.filter(days), "day"), ["day", "column"], "day", run)
    out = Q.merged_profiles(ledger.read(spark, path))
    return out.withColumn("few", F.when(F.col("about") <= 50, F.col("about"))).drop("about")


SHARES_SQL = GAPS_SQL + ", shares AS (" + " UNION ALL ".join(f"SELECT weekstart, '{c}' AS \"column\", avg(({c} IS NULL)::INTEGER) AS null_share, avg(coalesce({c} = 0, false)::INTEGER) AS zero_share, avg(coalesce({c} = -1, false)::INTEGER) AS minus_one_share FROM g GROUP BY 1" for c in ("loan", "trx")) + ")"


@query(SHARES_SQL + " SELECT * FROM shares")
def q12_special_shares(spark, d):
    return Q.special_shares(gaps(spark, d), ["loan", "trx"])


@query(SHARES_SQL + " SELECT \"column\", avg(null_share) AS mean FROM shares GROUP BY 1 HAVING avg(null_share) > 0.3")
def q12_columns_above(spark, d):
    return Q.columns_above(Q.special_shares(gaps(spark, d), ["loan", "trx"]), "null_share", 0.3)


@query(SHARES_SQL + " SELECT \"column\", quantile_cont(zero_share, 0.5)::DOUBLE AS median FROM shares GROUP BY 1 HAVING quantile_cont(zero_share, 0.5) < 0.5")
def q12_columns_below(spark, d):
    return Q.columns_below(Q.special_shares(gaps(spark, d), ["loan", "trx"]), "zero_share", 0.5)


@query("SELECT count(*) FILTER (toxic NOT IN (0, 1) OR toxic IS NULL) = 0 AS flags_known, count(*) = count(DISTINCT doc_id) AS ids_unique, count(*) BETWEEN 10 AND 100000 AS rows_in_range FROM labels")
def q13_dataset_checks(spark, d):
    return Q.dataset_checks(spark.read.parquet(f"{d}/labels.parquet"), "doc_id", "toxic", [0, 1], (10, 100000))


@query(ctes("revenue") + " SELECT channel, count(*) AS n, count(DISTINCT msisdn) AS ids, min(amount) AS min, avg(amount) AS avg, stddev(amount) AS stddev, max(amount) AS max FROM revenue GROUP BY 1")
def q14_score_consistency(spark, d):
    return Q.score_consistency(revenue(spark, d).withColumn("score", F.col("amount")), "channel")


LIST_SQL = ctes("products") + """, c AS (SELECT msisdn, maker AS campaign, product AS push_channel, sum(quantity) AS a, max(validity) AS b FROM products GROUP BY ALL)"""


def campaign_list(spark, d):
    g = products(spark, d).groupBy("msisdn", F.col("maker").alias("campaign"), F.col("product").alias("push_channel")).agg(F.sum("quantity").alias("a"), F.max("validity").alias("b"))
    number = F.concat(F.when(F.col("b") % 5 == 0, "+62").when(F.col("b") % 5 == 1, "0062").when(F.col("b") % 5 == 2, "0").when(F.col("b") % 5 == 3, "").otherwise("9"), F.lit("8"), F.lpad("msisdn", F.when(F.col("b") % 7 == 0, 6).otherwise(10), F.lit("1")))
    texts = {"criteria_1": F.col("a").cast("string"), "criteria_2": F.when(F.col("b") % 3 == 0, " ").otherwise(F.col("b").cast("string")), "criteria_3": F.when(F.col("b") % 11 == 0, "-1").otherwise("x"), "criteria_4": F.lit(None).cast("string"), "criteria_5": F.lit("1")}
    return g.withColumns({"msisdn": number, **texts})


PHONE_SQL = LIST_SQL + """, n AS (SELECT *, CASE b % 5 WHEN 0 THEN '62' WHEN 1 THEN '62' WHEN 2 THEN '62' WHEN 3 THEN '' ELSE '9' END AS p, '8' || lpad(msisdn, CASE WHEN b % 7 = 0 THEN 6 ELSE 10 END, '1') AS r FROM c),
list AS (SELECT CASE WHEN p = '' AND length(r) <= 12 THEN '62' || r ELSE p || r END AS msisdn, campaign, push_channel, a::DOUBLE AS criteria_1, CASE WHEN b % 3 = 0 THEN 0 ELSE b END::DOUBLE AS criteria_2, CASE WHEN b % 11 = 0 THEN -1 ELSE 0 END::DOUBLE AS criteria_3 FROM n),
ok AS (SELECT * FROM list WHERE criteria_3 >= 0 AND regexp_full_match(msisdn, '62[0-9]{9,11}') AND push_channel IN ('PROMO', 'ECONOMY', 'SMALL')),
ranked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY msisdn, push_channel ORDER BY criteria_1 DESC, criteria_2 DESC, criteria_3 DESC, campaign) AS rank FROM ok) WHERE rank <= 3)"""


def flagged(spark, d):
    rows = campaign_list(spark, d).withColumn("msisdn", C.normalise_phone("msisdn"))
    return C.criteria_flags(rows, ["PROMO", "ECONOMY", "SMALL"])


def ranked(spark, d):
    return C.rank(C.validate(flagged(spark, d))[0], 3)


@query(PHONE_SQL + " SELECT msisdn, campaign, push_channel, criteria_1, criteria_2, criteria_3, CASE WHEN criteria_3 >= 0 THEN 'Yes' ELSE 'No' END AS valid_criteria, CASE WHEN regexp_full_match(msisdn, '62[0-9]{9,11}') THEN 'Yes' ELSE 'No' END AS valid_msisdn, CASE WHEN push_channel IN ('PROMO', 'ECONOMY', 'SMALL') THEN 'Yes' ELSE 'No' END AS valid_channel FROM list")
def c1_c2_criteria_flags(spark, d):
    return flagged(spark, d).drop("a", "b", "criteria_4", "criteria_5")


@query(PHONE_SQL + " SELECT count(*) AS total, count(*) FILTER (criteria_3 < 0) AS invalid_criteria, count(*) FILTER (NOT regexp_full_match(msisdn, '62[0-9]{9,11}')) AS invalid_msisdn, count(*) FILTER (push_channel NOT IN ('PROMO', 'ECONOMY', 'SMALL')) AS invalid_channel FROM list")
def c3_validation_counts(spark, d):
    return C.validate(flagged(spark, d))[1]


@query(PHONE_SQL + " SELECT msisdn, campaign, push_channel, criteria_1, CAST(rank AS INTEGER) AS rank FROM ranked")
def c4_rank(spark, d):
    return ranked(spark, d).select("msisdn", "campaign", "push_channel", "criteria_1", "rank")


@query(PHONE_SQL + " SELECT msisdn, campaign, 'src' AS origin, '20240115-' || msisdn || '-' || campaign AS transaction_id FROM ranked")
def c5_c6_event_rows(spark, d):
    r = ranked(spark, d)
    channels = C.combine([r.filter(f"push_channel = '{c}'") for c in ("PROMO", "ECONOMY", "SMALL")])
    return C.event_rows(channels, "2024-01-15", {"origin": "src"}).select("msisdn", "campaign", "origin", "transaction_id")


PACE_SQL = PHONE_SQL + """, u AS (
  SELECT DISTINCT msisdn, campaign, push_channel, criteria_1, criteria_2, criteria_3 FROM ranked),
p AS (
  SELECT *, row_number() OVER (PARTITION BY push_channel ORDER BY criteria_1 DESC, criteria_2 DESC, criteria_3 DESC, msisdn, campaign) AS k FROM u),
paced AS (
  SELECT msisdn, campaign, push_channel, k AS rank_by_channel, CAST(ceil(k / (CASE push_channel WHEN 'PROMO' THEN 100.0 ELSE 250.0 END)) AS BIGINT) AS slot FROM p)"""


def paced(spark, d):
    r = S.at_rest(ranked(spark, d).select("msisdn", "campaign", "push_channel", *C.CRITERIA).distinct())
    limits = r.select("push_channel").distinct().withColumn("hourly", F.when(F.col("push_channel") == "PROMO", 100).otherwise(250))
    return C.pace(r, limits)


@query(PACE_SQL + " SELECT * FROM paced")
def c7_pace(spark, d):
    return paced(spark, d).drop(*C.CRITERIA)


@query(PACE_SQL + " SELECT slot, push_channel, count(*) AS n FROM paced GROUP BY ALL")
def c7_slot_sizes(spark, d):
    return C.slot_sizes(paced(spark, d))


@query("SELECT p_brand AS brand, CASE WHEN min(p_size) > 1 THEN 'ranking' ELSE 'channels' END AS missing_in FROM part GROUP BY 1 HAVING min(p_size) > 1 OR max(p_size) < 49")
def c8_missing_configuration(spark, d):
    p = spark.read.parquet(f"{d}/part.parquet").withColumnRenamed("p_brand", "brand").groupBy("brand").agg(F.min("p_size").alias("lo"), F.max("p_size").alias("hi"))
    return C.missing_configuration(p.filter("lo <= 1"), p.filter("lo > 1 or hi >= 49"), ["brand"])


@query("SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL HAVING count(*) > 1")
def c8_duplicate_configuration(spark, d):
    return C.duplicate_configuration(spark.read.parquet(f"{d}/part.parquet"), ["p_brand", "p_type"])


@query("SELECT p_brand, p_type, count(*) AS n FROM part WHERE p_size < 25 GROUP BY ALL HAVING count(*) > 1")
def c8_several_rows_of_system(spark, d):
    config = spark.read.parquet(f"{d}/part.parquet").withColumn("system", F.when(F.col("p_size") < 25, "cms").otherwise("other"))
    return C.several_rows_of_system(config, ["p_brand", "p_type"], "system", "cms")


@query(ctes("products") + """, s AS (SELECT msisdn, maker AS campaign, sum(amount) AS score FROM products GROUP BY ALL)
SELECT msisdn, campaign, score::BIGINT AS criteria_2, CASE WHEN campaign LIKE '%1' THEN 'fam_' || campaign WHEN campaign LIKE '%2' THEN 'c|' || campaign ELSE campaign END AS keyword, CASE WHEN campaign LIKE '%3' THEN 7 ELSE 0 END AS criteria_1 FROM s""")
def c9_build_input(spark, d):
    s = products(spark, d).groupBy("msisdn", F.col("maker").alias("campaign")).agg(F.sum("amount").alias("score"))
    c = s.select("campaign").distinct()
    config = c.select("campaign", F.lit("fam").alias("family"), F.when(F.col("campaign").endswith("1"), "A").when(F.col("campaign").endswith("2"), "B").alias("system"), F.lit("PROMO").alias("push_channel"), F.lit("c").alias("code"))
    priority = c.filter(F.col("campaign").endswith("3")).withColumn("priority", F.lit(7))
    return C.build_input(s, config, priority).select("msisdn", "campaign", "criteria_2", "keyword", "criteria_1")


@query("""WITH a AS (SELECT p_partkey, p_size FROM part WHERE p_partkey % 4 <> 0), w AS (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_size + 1 ELSE p_size END AS p_size FROM part WHERE p_partkey % 3 <> 0),
b AS (SELECT p_partkey, a.p_size AS o, w.p_size AS n FROM a FULL JOIN w USING (p_partkey) WHERE a.p_size IS DISTINCT FROM w.p_size)
SELECT p_partkey, 'deactivate' AS action FROM b WHERE o IS NOT NULL UNION ALL SELECT p_partkey, 'insert' FROM b WHERE n IS NOT NULL""")
def c10_ranking_changes(spark, d):
    p = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", "p_size")
    wanted = p.filter("p_partkey % 3 <> 0").withColumn("p_size", F.when(F.col("p_partkey") % 5 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")))
    return C.ranking_changes(p.filter("p_partkey % 4 <> 0"), wanted, "p_partkey", ["p_size"])


@query("SELECT p_partkey, 'p_size' AS criterion, p_size::DOUBLE AS value FROM part UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part")
def c10_melt_criteria(spark, d):
    p = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return C.melt_criteria(p, "p_partkey", ["p_size", "p_retailprice"])


@query("""WITH up AS (
  SELECT p_brand AS family, CAST(p_partkey AS VARCHAR) AS campaign, p_type AS push_channel, TIMESTAMP '2024-01-01 00:00:00' AS made, 1 AS run FROM part
  UNION ALL SELECT p_brand, CAST(p_partkey AS VARCHAR), 'SMS', TIMESTAMP '2024-02-01 00:00:00', 2 FROM part WHERE p_partkey % 3 = 0 AND p_size < 25
  UNION ALL SELECT p_brand, CAST(p_partkey AS VARCHAR), 'MAIL', TIMESTAMP '2024-02-01 00:00:00', 2 FROM part WHERE p_partkey % 6 = 0 AND p_size < 25
  UNION ALL SELECT p_brand, 'extra-' || min(p_partkey), 'SMS', TIMESTAMP '2024-03-01 00:00:00', 3 FROM part GROUP BY p_brand),
runs AS (SELECT DISTINCT family, campaign, run, made FROM up)
SELECT up.family, up.campaign, up.push_channel, CASE WHEN min(later.made) IS NULL THEN 'active' ELSE 'inactive' END AS status, up.made AS created_at, min(later.made) AS deactivated_at
FROM up LEFT JOIN runs later ON later.family = up.family AND later.campaign = up.campaign AND later.run > up.run GROUP BY up.family, up.campaign, up.push_channel, up.made""")
def c10_uploads_applied(spark, d):
    """Three uploads change a table at rest, one of them twice; the table is read back with its history."""
    path = S.scratch(spark)
    p = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_brand").alias("family"), F.col("p_partkey").cast("string").alias("campaign"), F.col("p_type").alias("push_channel"), "p_partkey", "p_size")
    rows = lambda df, channel: df.select("family", "campaign", channel.alias("push_channel"))
    small = p.filter("p_partkey % 3 = 0 and p_size < 25")
    second = rows(small, F.lit("SMS")).unionByName(rows(small.filter("p_partkey % 6 = 0"), F.lit("MAIL")))
    extra = p.groupBy("family").agg(F.concat(F.lit("extra-"), F.min("p_partkey").cast("string")).alias("campaign")).withColumn("push_channel", F.lit("SMS"))
    for run, up in ((1, rows(p, F.col("push_channel"))), (2, second), (2, second), (3, extra)):
        ledger.upload(spark, path, up, ["family", "campaign"], "family", f"run-{run}", F.lit(f"2024-0{run}-01 00:00:00").cast("timestamp"))
    return ledger.read(spark, path)


@query("SELECT p_partkey, p_brand, CASE WHEN p_partkey % 2 = 0 AND p_size < 10 THEN CASE WHEN p_partkey % 3 <> 0 THEN p_retailprice + 1 END ELSE p_retailprice END AS p_retailprice FROM part UNION ALL SELECT -p_partkey, p_brand, p_retailprice FROM part WHERE p_size = 1")
def s6_upsert_at_rest(spark, d):
    path = S.scratch(spark)
    p = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", "p_brand", "p_retailprice", "p_size")
    changed = p.filter("p_partkey % 2 = 0 and p_size < 10").withColumn("p_retailprice", F.when(F.col("p_partkey") % 3 == 0, float("nan")).otherwise(F.col("p_retailprice") + 1))
    new = p.filter("p_size = 1").withColumn("p_partkey", -F.col("p_partkey"))
    ledger.upsert(spark, path, p.drop("p_size"), ["p_partkey", "p_brand"], "p_brand", "first")
    ledger.upsert(spark, path, changed.unionByName(new).drop("p_size"), ["p_partkey", "p_brand"], "p_brand", "second")
    return ledger.read(spark, path)
