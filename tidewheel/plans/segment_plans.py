"""Drift, segments, model jobs (D) and tables at rest (S)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.operators import segments as D
from tidewheel.operators import similar
from tidewheel.operators.quality import file_deliveries
from tidewheel.plans.registry import query
from tidewheel.plans.time_plans import UNIT, WEEKLY_SQL, weekly
from tidewheel.sources import io as S
from tidewheel.sources.derived import ctes, outlets, products, profiles, revenue, usage

VALUES = ["amt", "trx"]
EDGES_SQL = WEEKLY_SQL + """, l AS (SELECT msisdn, weekstart, 'amt' AS feature, amt::DOUBLE AS value FROM weekly UNION ALL SELECT msisdn, weekstart, 'trx', trx::DOUBLE FROM weekly), base AS (SELECT * FROM l WHERE weekstart < DATE '1998-01-01'),
q AS (SELECT feature, list_sort(list_distinct([quantile_cont(value, 0.2), quantile_cont(value, 0.4), quantile_cont(value, 0.6), quantile_cont(value, 0.8)])) AS edges FROM base GROUP BY 1 HAVING count(DISTINCT value) > 3),
bl AS (SELECT q.feature, i AS bin, CASE WHEN i > 0 THEN edges[i] END AS low, CASE WHEN i < len(edges) THEN edges[i + 1] END AS high FROM q, unnest(range(0, len(edges) + 1)) AS r(i)),
bc AS (SELECT feature, len(list_filter(edges, lambda e: value >= e)) AS bin, count(*) AS n FROM base JOIN q USING (feature) GROUP BY ALL),
baseline AS (SELECT bl.feature, CAST(bl.bin AS INTEGER) AS bin, low, high, coalesce(n, 0)::DOUBLE / sum(coalesce(n, 0)) OVER (PARTITION BY bl.feature) AS proportion FROM bl LEFT JOIN bc ON bc.feature = bl.feature AND bc.bin = bl.bin)"""


def baseline(spark, d):
    return D.psi_baseline(weekly(spark, d).filter("weekstart < date'1998-01-01'"), VALUES, 5, 3)


@query(EDGES_SQL + " SELECT * FROM baseline")
def d1_psi_baseline(spark, d):
    return baseline(spark, d)


@query(EDGES_SQL + """, cc AS (SELECT feature, len(list_filter(edges, lambda e: value >= e)) AS bin, count(*) AS n FROM l JOIN q USING (feature) WHERE weekstart >= DATE '1998-01-01' GROUP BY ALL), cp AS (SELECT feature, bin, n / sum(n) OVER (PARTITION BY feature) AS c FROM cc),
b AS (SELECT feature, coalesce(CASE WHEN cp.c > 0 THEN cp.c END, 1) AS c, coalesce(CASE WHEN proportion > 0 THEN proportion END, 1) AS b FROM baseline FULL JOIN cp USING (feature, bin))
SELECT feature, sum((c - b) * ln(c / b)) AS psi FROM b GROUP BY 1""")
def d2_psi(spark, d):
    return D.psi(weekly(spark, d).filter("weekstart >= date'1998-01-01'"), baseline(spark, d), VALUES)


RFM_SQL = ctes("revenue", "profiles") + """, a AS (SELECT msisdn, max(channel) AS channel, coalesce(sum(amount) FILTER (status = 'F'), 0) AS s1, coalesce(sum(amount) FILTER (status = 'O'), 0) AS s2, coalesce(sum(amount) FILTER (status = 'P'), 0) AS s3, sum(amount) AS recharge, count(*) FILTER (status = 'F') AS trx FROM revenue GROUP BY 1),
rfm AS (SELECT a.msisdn, segment AS device, CASE WHEN segment IN ('BUILDING', 'MACHINERY') THEN 'smart' ELSE 'unknown' END AS device_class, CASE channel WHEN '5-LOW' THEN 3 WHEN '4-NOT SPECIFIED' THEN 2 ELSE 1 END AS channel_group, CAST(greatest(s1, s2, s3) AS BIGINT) AS max_spend, recharge / (CASE trx WHEN 0 THEN 1 ELSE trx END)::DOUBLE AS recharge_per_trx FROM a JOIN profiles USING (msisdn))"""


def rfm(spark, d):
    r = revenue(spark, d)
    per = r.groupBy("msisdn").agg(F.max("channel").alias("channel"), *(F.coalesce(F.sum(F.when(F.col("status") == s, F.col("amount"))), F.lit(0)).alias(f"spend_{i}") for i, s in enumerate("FOP", 1)), F.sum("amount").alias("recharge"), F.count_if(F.col("status") == "F").alias("trx"))
    p = profiles(spark, d)
    classes = p.select(F.col("segment").alias("device")).distinct().filter("device in ('BUILDING', 'MACHINERY')").withColumn("device_class", F.lit("smart"))
    rows = per.join(p.select("msisdn", F.col("segment").alias("device")), "msisdn")
    return D.rfm_inputs(rows, classes, {"5-LOW": 3, "4-NOT SPECIFIED": 2}).select("msisdn", "device", "device_class", "channel_group", "max_spend", "recharge_per_trx")


@query(RFM_SQL + " SELECT * FROM rfm")
def d3_rfm_inputs(spark, d):
    return rfm(spark, d)


CUTS = {"channel_group": (1, 2), "max_spend": (50_000_000, 150_000_000), "recharge_per_trx": (20_000_000, 60_000_000), "trx": (0, 2)}


@query(RFM_SQL + ", s AS (SELECT msisdn, 1 + (channel_group > 1)::INTEGER + (channel_group > 2)::INTEGER AS c, 1 + (max_spend > 50000000)::INTEGER + (max_spend > 150000000)::INTEGER AS m, 1 + (recharge_per_trx > 20000000)::INTEGER + (recharge_per_trx > 60000000)::INTEGER AS r FROM rfm) SELECT msisdn, c + m + r AS total_score, CASE WHEN c + m + r <= 7 THEN 'low' WHEN c + m + r <= 11 THEN 'medium' ELSE 'high' END AS segment FROM s")
def d4_rfm_score(spark, d):
    cuts = {k: v for k, v in CUTS.items() if k != "trx"}
    return D.rfm_score(rfm(spark, d), cuts).select("msisdn", "total_score", "segment")


@query(RFM_SQL + """, l AS (SELECT 'max_spend' AS measure, max_spend::DOUBLE AS v FROM rfm UNION ALL SELECT 'recharge_per_trx', recharge_per_trx FROM rfm), q AS (SELECT measure, quantile_cont(v, 0.33) AS a, quantile_cont(v, 0.67) AS b FROM l GROUP BY 1)
SELECT measure, avg(v) FILTER (v <= a) AS low_cut, avg(v) FILTER (v > a AND v <= b) AS high_cut FROM l JOIN q USING (measure) GROUP BY 1""")
def d5_rfm_cutoffs(spark, d):
    return D.rfm_cutoffs(rfm(spark, d), ["max_spend", "recharge_per_trx"])


@query(ctes("revenue", "profiles") + """, r AS (SELECT segment, 1 + (balance > 200000)::INTEGER + (balance > 600000)::INTEGER AS balance_band, amount FROM revenue JOIN profiles USING (msisdn)), g AS (SELECT segment, balance_band, count(*) AS ids, CAST(sum(amount) AS BIGINT) AS amount_sum, avg(amount) AS amount_avg FROM r GROUP BY ALL)
SELECT *, ids / (sum(ids) OVER (PARTITION BY segment))::DOUBLE AS share FROM g""")
def d6_d8_segment_summary(spark, d):
    rows = revenue(spark, d).join(profiles(spark, d), "msisdn")
    return D.segment_summary(rows, {"balance_band": ("balance", (200_000, 600_000))}, ["amount"])


@query(ctes("revenue", "profiles", "products") + """, r AS (SELECT msisdn, sum(amount) AS spend, count(*) AS trx FROM revenue GROUP BY 1),
b AS (SELECT msisdn, max((product LIKE 'ECONOMY%')::INTEGER) AS economy, max((product LIKE 'PROMO%')::INTEGER) AS promo FROM products GROUP BY 1),
j AS (SELECT segment, 1 + (balance > 200000)::INTEGER + (balance > 600000)::INTEGER AS balance_band, 1 + (trx > 5)::INTEGER + (trx > 15)::INTEGER AS trx_band,
  coalesce(economy, 0) AS economy, coalesce(promo, 0) AS promo, spend FROM r JOIN profiles USING (msisdn) LEFT JOIN b USING (msisdn))
SELECT segment, balance_band, trx_band, count(*) AS ids, CAST(sum(economy) AS BIGINT) AS economy_ids, avg(economy) AS economy_share, CAST(sum(promo) AS BIGINT) AS promo_ids, avg(promo) AS promo_share,
  CAST(sum(spend) AS BIGINT) AS spend_sum, avg(spend) AS spend_avg, CAST(min(spend) AS BIGINT) AS spend_min, CAST(max(spend) AS BIGINT) AS spend_max FROM j GROUP BY ALL""")
def d6_baseline_summary(spark, d):
    r = revenue(spark, d).groupBy("msisdn").agg(F.sum("amount").alias("spend"), F.count("*").alias("trx"))
    bought = lambda kind: F.max(F.col("product").startswith(kind).cast("int")).alias(kind.lower())
    interest = products(spark, d).groupBy("msisdn").agg(bought("ECONOMY"), bought("PROMO"))
    rows = r.join(profiles(spark, d), "msisdn").join(interest, "msisdn", "left").fillna(0, ["economy", "promo"])
    bands = {"balance_band": ("balance", (200_000, 600_000)), "trx_band": ("trx", (5, 15))}
    return D.baseline_summary(rows, bands, ["economy", "promo"], ["spend"])


@query(ctes("revenue", "profiles", "products") + """, r AS (SELECT msisdn, date_trunc('month', event_date)::DATE AS month, status, amount FROM revenue),
k AS (SELECT msisdn, month, sum(amount) FILTER (status = 'F') AS f, sum(amount) FILTER (status = 'O') AS o, sum(amount) FILTER (status = 'P') AS p, sum(amount) AS amount FROM r GROUP BY ALL),
b AS (SELECT DISTINCT msisdn, date_trunc('month', event_date)::DATE AS month FROM products),
l AS (SELECT DISTINCT msisdn, month FROM r WHERE status <> 'F'),
i AS (SELECT msisdn, month FROM k UNION SELECT msisdn, month FROM b)
SELECT segment, i.month, count(*) AS ids, CAST(coalesce(sum(f), 0) AS BIGINT) AS recharge_0, CAST(coalesce(sum(o), 0) AS BIGINT) AS recharge_1, CAST(coalesce(sum(p), 0) AS BIGINT) AS recharge_2, avg(coalesce(amount, 0)) AS recharge_avg,
  count(b.msisdn) AS buyers_ids, count(b.msisdn) / count(*)::DOUBLE AS buyers_share, count(l.msisdn) AS open_ids, count(l.msisdn) / count(*)::DOUBLE AS open_share
FROM i JOIN profiles USING (msisdn) LEFT JOIN k ON k.msisdn = i.msisdn AND k.month = i.month LEFT JOIN b ON b.msisdn = i.msisdn AND b.month = i.month LEFT JOIN l ON l.msisdn = i.msisdn AND l.month = i.month GROUP BY ALL""")
def d8_monthly_activity(spark, d):
    month = F.trunc("event_date", "month").alias("month")
    r = revenue(spark, d).select("msisdn", month, F.col("status").alias("kind"), "amount")
    activity = {"buyers": products(spark, d).select("msisdn", month), "open": r.filter("kind <> 'F'")}
    return D.monthly_segment_activity(profiles(spark, d).select("msisdn", "segment"), r, ["F", "O", "P"], activity)


@query(WEEKLY_SQL + ", p AS (SELECT CAST(c_custkey AS VARCHAR) AS msisdn, c_mktsegment AS segment FROM customer) SELECT segment, date_trunc('month', weekstart)::DATE AS month, count(*) AS n, CAST(sum(amt) AS BIGINT) AS amt FROM weekly JOIN p USING (msisdn) GROUP BY ALL")
def d7_segment_months(spark, d):
    return weekly(spark, d).join(profiles(spark, d), "msisdn").groupBy("segment", F.trunc("weekstart", "month").alias("month")).agg(F.count("*").alias("n"), F.sum("amt").alias("amt"))


@query("WITH n AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1) SELECT p_partkey, ln(1 + p_retailprice) AS p_retailprice, CASE WHEN n >= (SELECT avg(n) FROM n) THEN p_brand ELSE 'other' END AS p_brand, 2 AS tags FROM part JOIN n USING (p_brand)")
def d9_transforms(spark, d):
    p = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", "p_retailprice", "p_brand", F.array("p_type", "p_name").alias("tags"), F.lit("x").alias("unit"))
    mean = p.groupBy("p_brand").agg(F.count("*").alias("n")).agg(F.avg("n")).first()[0]
    return D.transforms(p, ["p_retailprice"], {"p_brand": mean}, ["tags"], ["unit"])


def wide(spark, d):
    """One row per id for the models, at rest: a fit reads its rows many times."""
    r = revenue(spark, d)
    per = r.groupBy("msisdn").agg(F.sum("amount").cast("double").alias("amount"), F.count("*").cast("double").alias("trx"), F.max("amount").cast("double").alias("top"), F.count_if(F.col("status") == "F").cast("double").alias("loans"))
    return S.at_rest(per.join(profiles(spark, d), "msisdn").withColumns({"treatment": (F.col("msisdn").cast("long") % 2).cast("int"), "outcome": (F.col("loans") > 3).cast("int"), "region": F.col("region").cast("string")}))


COLUMNS = ["amount", "trx", "top", "balance"]


@query()
def d10_pca(spark, d):
    w = wide(spark, d)
    scores = D.apply_pca(D.fit_pca(w, COLUMNS, 2), w, ["msisdn"], 2)
    return D.component_correlations(scores, w, "msisdn", COLUMNS, 2)


@query()
def d11_d12_clusters(spark, d):
    w = wide(spark, d)
    segments = [r.segment for r in w.select("segment").distinct().orderBy("segment").collect()]  # a handful of names
    clustered = D.kmeans_by_segment(w, COLUMNS, segments, 3)
    return D.cluster_profile(clustered, COLUMNS)


@query(ctes("revenue") + ", w AS (SELECT channel, amount, trx_id FROM revenue) SELECT channel, count(*) AS n, avg(amount) AS amount_mean, quantile_cont(amount, 0.5)::DOUBLE AS amount_median, quantile_cont(amount, 0.2)::DOUBLE AS amount_p20, quantile_cont(amount, 0.8)::DOUBLE AS amount_p80 FROM w GROUP BY 1")
def d12_cluster_profile(spark, d):
    return D.cluster_profile(revenue(spark, d), ["amount"], "channel")


@query()
def d13_silhouettes(spark, d):
    return D.silhouettes(wide(spark, d), COLUMNS, [2, 3])


PILOT_SQL = ctes("revenue", "profiles") + ", w AS (SELECT msisdn, segment, count(*) AS trx, count(*) FILTER (status = 'O') AS data, sum(amount) / 1000 AS spend, sum(amount) % 100003 AS score FROM revenue JOIN profiles USING (msisdn) GROUP BY ALL)"


def pilot(spark, d):
    r = revenue(spark, d).join(profiles(spark, d), "msisdn")
    return r.groupBy("msisdn", "segment").agg(F.count("*").alias("trx"), F.count_if(F.col("status") == "O").alias("data"), (F.sum("amount") / 1000).alias("spend"), (F.sum("amount") % 100003).alias("score"))


@query(PILOT_SQL + " SELECT msisdn, segment, (trx > 0)::INTEGER AS is_active, (data > 0)::INTEGER AS is_data_user, percent_rank() OVER (PARTITION BY segment ORDER BY score) AS score_percentile, 1 + (spend > 100000)::INTEGER + (spend > 300000)::INTEGER AS spend_bin FROM w")
def d14_pilot_features(spark, d):
    return D.pilot_features(pilot(spark, d), "segment").select("msisdn", "segment", "is_active", "is_data_user", "score_percentile", "spend_bin")


@query(PILOT_SQL + f""", r AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY score DESC, msisdn) AS r FROM w), h AS (SELECT *, row_number() OVER (PARTITION BY segment, r <= 5 ORDER BY {UNIT.format(k='msisdn', s=0)}, msisdn) AS h FROM r)
SELECT msisdn, segment, CASE WHEN r <= 5 THEN 'top' ELSE 'random' END AS pilot, ['b1', 'b2'][CAST(floor({UNIT.format(k='msisdn', s=1)} * 2) AS INTEGER) + 1] AS bid FROM h WHERE r <= 5 OR h <= 7""")
def d15_assign_pilot(spark, d):
    return D.assign_pilot(pilot(spark, d), "segment", 5, 7, ["b1", "b2"]).select("msisdn", "segment", "pilot", "bid")


@query()
def d16_d18_model_scores(spark, d):
    w = wide(spark, d)
    models = {n: D.train_propensity(w, COLUMNS, label, "msisdn")[0] for n, label in (("loan", "outcome"), ("treat", "treatment"))}
    return D.best_campaign(D.score_models(w, models), 0.3)


SCORES_SQL = ctes("products") + ", sc AS (SELECT msisdn, product AS campaign, sum(quantity)::DOUBLE AS score FROM products GROUP BY ALL)"


def campaign_scores(spark, d):
    return products(spark, d).groupBy("msisdn", F.col("product").alias("campaign")).agg(F.sum("quantity").cast("double").alias("score"))


@query(SCORES_SQL + """, names AS (SELECT DISTINCT campaign FROM sc), p AS (SELECT a.campaign AS a, b.campaign AS b FROM names a JOIN names b ON a.campaign <= b.campaign)
SELECT p.a, p.b, round(corr(x.score, y.score), 8) AS correlation FROM p LEFT JOIN sc x ON x.campaign = p.a LEFT JOIN sc y ON y.campaign = p.b AND y.msisdn = x.msisdn GROUP BY p.a, p.b""")
def d17_score_correlations(spark, d):
    scores = campaign_scores(spark, d)
    names = [r.campaign for r in scores.select("campaign").distinct().orderBy("campaign").collect()]  # a handful of names
    return D.score_correlations(scores, names).withColumn("correlation", F.round("correlation", 8))


@query(SCORES_SQL + " SELECT msisdn, campaign, score FROM (SELECT *, row_number() OVER (PARTITION BY msisdn ORDER BY score DESC, campaign) AS n FROM sc) WHERE n = 1 AND score > 100")
def d18_best_campaign(spark, d):
    return D.best_campaign(campaign_scores(spark, d), 100.0)


UPLIFT_SQL = ctes("revenue") + ", u AS (SELECT trx_id, (amount % 10007)::DOUBLE AS score, CAST(trx_id % 2 AS INTEGER) AS treatment, (status = 'F')::INTEGER AS outcome FROM revenue)"


def uplift_rows(spark, d):
    return revenue(spark, d).select("trx_id", (F.col("amount") % 10007).cast("double").alias("score"), (F.col("trx_id") % 2).cast("int").alias("treatment"), (F.col("status") == "F").cast("int").alias("outcome"))


CURVE_SQL = UPLIFT_SQL + ", ed AS (SELECT [" + ", ".join(f"quantile_cont(score, {1 - k / 20})" for k in range(1, 20)) + "] AS edges FROM u), b AS (SELECT 1 + len(list_filter(edges, lambda x: score < x)) AS quantile, * FROM u, ed)" + """,
p AS (SELECT quantile, count(*) FILTER (treatment = 1) AS nt, count(*) FILTER (treatment = 0) AS nc, coalesce(sum(outcome) FILTER (treatment = 1), 0) AS yt, coalesce(sum(outcome) FILTER (treatment = 0), 0) AS yc FROM b GROUP BY 1),
s AS (SELECT quantile, sum(nt) OVER w AS nt, sum(nc) OVER w AS nc, sum(yt) OVER w AS yt, sum(yc) OVER w AS yc FROM p WINDOW w AS (ORDER BY quantile)),
curve AS (SELECT CAST(quantile AS INTEGER) AS quantile, CAST(nt + nc AS BIGINT) AS n, coalesce(yt::DOUBLE / nullif(nt, 0), 0) - coalesce(yc::DOUBLE / nullif(nc, 0), 0) AS uplift FROM s)"""


@query(CURVE_SQL + " SELECT *, uplift * n AS gain FROM curve")
def d19_uplift_curve(spark, d):
    return D.uplift_curve(uplift_rows(spark, d))


@query(CURVE_SQL + ", g AS (SELECT n, uplift * n AS gain, lag(n) OVER (ORDER BY quantile) AS n0, lag(uplift * n) OVER (ORDER BY quantile) AS g0 FROM curve) SELECT sum((gain + coalesce(g0, 0)) / 2 * (n - coalesce(n0, 0))) / max(n) AS auuc FROM g")
def d20_area_under_uplift(spark, d):
    return D.area_under_uplift(D.uplift_curve(uplift_rows(spark, d)))


@query(UPLIFT_SQL + ", ed AS (SELECT [" + ", ".join(f"quantile_cont(score, {k / 5})" for k in range(1, 5)) + "] AS edges FROM u WHERE treatment = 1), b AS (SELECT 1 + len(list_filter(edges, lambda x: score > x)) AS quantile, * FROM u, ed) SELECT CAST(quantile AS INTEGER) AS quantile, count(*) AS n, avg(outcome) FILTER (treatment = 1) - avg(outcome) FILTER (treatment = 0) AS uplift FROM b GROUP BY 1")
def d21_uplift_by_quantile(spark, d):
    return D.uplift_by_quantile(uplift_rows(spark, d))


@query()
def d22_two_model_uplift(spark, d):
    return D.two_model_uplift(wide(spark, d), COLUMNS)


@query(UPLIFT_SQL + " SELECT avg(outcome) FILTER (treatment = 1) - avg(outcome) FILTER (treatment = 0) AS effect FROM u")
def d22_average_take_effect(spark, d):
    return D.average_take_effect(uplift_rows(spark, d))


@query(UPLIFT_SQL + ", ed AS (SELECT [" + ", ".join(f"quantile_cont(score, {k / 10})" for k in range(1, 10)) + "] AS edges FROM u WHERE treatment = 1), b AS (SELECT 1 + len(list_filter(edges, lambda x: score > x)) AS bin, * FROM u, ed), m AS (SELECT bin, avg(outcome) AS calibrated FROM b WHERE treatment = 1 GROUP BY 1) SELECT trx_id, CAST(bin AS INTEGER) AS bin, calibrated FROM b LEFT JOIN m USING (bin)")
def d22_calibrated_scores(spark, d):
    u = uplift_rows(spark, d)
    return D.calibrate(u, u.filter("treatment = 1")).select("trx_id", "bin", "calibrated")


@query()
def d23_propensity(spark, d):
    w = wide(spark, d)
    model, auc, importance = D.train_propensity(w, COLUMNS, "outcome", "msisdn")
    return spark.createDataFrame([(c, v, auc) for c, v in importance], "feature string, importance double, auc double")


@query(ctes("revenue", "profiles") + " SELECT segment, area, count(*) AS n, count(CASE WHEN status = 'F' THEN amount END) AS n_target, avg(CASE WHEN status = 'F' THEN amount END) AS mean_target FROM revenue JOIN profiles USING (msisdn) GROUP BY ALL")
def d24_group_means(spark, d):
    rows = revenue(spark, d).join(profiles(spark, d), "msisdn").withColumn("target", F.when(F.col("status") == "F", F.col("amount")))
    return D.group_means(rows, ["segment", "area"], "target")


@query(ctes("revenue") + """, s AS (SELECT channel, amount % 97 AS day, (status <> 'P')::INTEGER AS event FROM revenue), p AS (SELECT channel, day, count(*) AS l, sum(event) AS events FROM s GROUP BY ALL),
r AS (SELECT *, sum(l) OVER (PARTITION BY channel ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS at_risk FROM p)
SELECT channel, day, CAST(at_risk AS BIGINT) AS at_risk, CAST(events AS BIGINT) AS events, CASE WHEN max((events = at_risk)::INTEGER) OVER w = 1 THEN 0.0 ELSE exp(coalesce(sum(CASE WHEN events <> at_risk THEN ln(1 - events::DOUBLE / at_risk) END) OVER w, 0)) END AS survival FROM r WINDOW w AS (PARTITION BY channel ORDER BY day)""")
def d25_survival_curve(spark, d):
    return D.survival_curve(revenue(spark, d).select("channel", (F.col("amount") % 97).alias("day"), (F.col("status") != "P").cast("int").alias("event")), "channel")


@query("SELECT p_brand AS feature, avg(p_size) AS mean, min(p_size) AS min, max(p_size) AS max, stddev(p_size) AS std, CAST(sum(p_size) AS BIGINT) AS total FROM part GROUP BY 1 ORDER BY total DESC, feature LIMIT 10")
def d26_importance(spark, d):
    p = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_brand").alias("feature"), F.col("p_size").alias("importance"))
    return D.summarise_importance(p, 10)


@query(ctes("outlets") + ", r AS (SELECT outlet_id, balance, CASE WHEN outlet_id % 3 <> 0 THEN lat END AS distance FROM outlets WHERE balance > 0), q AS (SELECT quantile_cont(balance, 0.05) AS lo, quantile_cont(balance, 0.95) AS hi, max(distance) AS m FROM r) SELECT outlet_id, balance, coalesce(distance, m) AS distance FROM r, q WHERE balance BETWEEN lo AND hi")
def d27_outlet_sample(spark, d):
    o = outlets(spark, d).select("outlet_id", "balance", F.when(F.col("outlet_id") % 3 != 0, F.col("lat")).alias("distance"))
    return D.outlet_sample(o, "balance", 0.05, 0.95, ["distance"])


@query(ctes("outlets") + f""", r AS (SELECT outlet_id, CASE WHEN outlet_id % 10 = 0 THEN 0 ELSE balance END AS balance, coalesce(CASE WHEN outlet_id % 3 <> 0 THEN lat END, 9.5) AS distance FROM outlets),
q AS (SELECT quantile_cont(balance, 0.05) AS lo, quantile_cont(balance, 0.95) AS hi FROM r)
SELECT outlet_id, balance, distance, CASE WHEN balance = 0 THEN 'zero' WHEN balance < lo THEN 'bottom' WHEN balance > hi THEN 'top' WHEN {UNIT.format(k='outlet_id', s=0)} < 0.6 THEN 'sampled' ELSE 'left out' END AS outcome FROM r, q""")
def d27_sampled_outlets(spark, d):
    o = outlets(spark, d).select("outlet_id", F.when(F.col("outlet_id") % 10 == 0, 0).otherwise(F.col("balance")).alias("balance"), F.when(F.col("outlet_id") % 3 != 0, F.col("lat")).alias("distance"))
    return D.sampled_outlets(o.union(o), "balance", 0.05, 0.95, ["distance"], 9.5, 0.6)


@query(ctes("profiles") + f" SELECT msisdn, CAST(floor({UNIT.format(k='msisdn', s=0)} * 5) AS INTEGER) AS fold FROM profiles")
def d28_hash_fold(spark, d):
    return profiles(spark, d).select("msisdn", D.hash_fold("msisdn", 5).alias("fold"))


@query(ctes("profiles") + ", e AS (SELECT quantile_cont(balance, 0.25) AS a, quantile_cont(balance, 0.5) AS b, quantile_cont(balance, 0.75) AS c FROM profiles) SELECT msisdn, ((balance >= a)::INTEGER + (balance >= b)::INTEGER + (balance >= c)::INTEGER)::DOUBLE AS balance_bin FROM profiles, e")
def d29_quantile_bins(spark, d):
    return D.quantile_bins(profiles(spark, d), "balance", 4).select("msisdn", "balance_bin")


@query()
def d29_preprocessing(spark, d):
    w = wide(spark, d)
    model = D.preprocessing(COLUMNS, ["segment", "region"]).fit(w)
    sizes = F.array(*(F.size(vector_to_array(f"{c}_v")) for c in ("segment", "region")))
    return model.transform(w).select("msisdn", vector_to_array("features").alias("features"), sizes.alias("sizes"))


def leaves(spark, d):
    w = wide(spark, d)
    scored = D.fit_forest(w, ["trx", "top", "balance"], "amount").transform(w)
    return scored.select("msisdn", "amount", "prediction", vector_to_array("leaves").alias("leaves"))


@query()
def d30_forest_metrics(spark, d):
    return D.evaluate(leaves(spark, d), "amount")


@query(ctes("revenue") + ", p AS (SELECT amount::DOUBLE AS y, amount + trx_id % 1000 - 500 AS z FROM revenue), m AS (SELECT avg(y) AS m FROM p), s AS (SELECT sum((y - z) * (y - z)) / sum((y - m) * (y - m)) AS rse, sqrt(avg((y - z) * (y - z))) AS rmse, avg(abs(y - z)) AS mae, max(abs(y - z)) AS max_error FROM p, m) SELECT 1 - rse AS r2, rmse, mae, max_error, rse, sqrt(rse) AS rrse FROM s")
def d30_evaluate(spark, d):
    r = revenue(spark, d).select(F.col("amount").cast("double").alias("label"), (F.col("amount") + F.col("trx_id") % 1000 - 500).cast("double").alias("prediction"))
    return D.evaluate(r)


@query()
def d31_d33_similar_performance(spark, d):
    rows = leaves(spark, d)
    return D.dashboard_points(similar.performance(rows, rows, "msisdn", "amount"), "msisdn")


@query(ctes("profiles") + """, r AS (SELECT msisdn, balance AS v, balance % 7 AS a, balance % 11 AS b FROM profiles),
p AS (SELECT x.msisdn, x.v AS own, y.v FROM r x JOIN r y ON x.a = y.a OR x.b = y.b),
q AS (SELECT msisdn, quantile_cont(v, 0.95) AS edge FROM p GROUP BY 1),
k AS (SELECT msisdn, any_value(own) AS own, list_sort(list(v)) AS l FROM p JOIN q USING (msisdn) WHERE v <= edge GROUP BY msisdn),
s AS (SELECT *, len(l) AS n FROM k)
SELECT msisdn, 100.0 * len(list_filter(l, lambda x: x < own)) / (n + 1)::DOUBLE AS percentile, """ + ", ".join(
    f"CASE WHEN l[greatest(1, CAST(ceil((n + 1) * {s}) AS BIGINT))] <= own THEN l[greatest(1, CAST(ceil((n + 1) * {s}) AS BIGINT))] ELSE greatest(own, l[greatest(1, CAST(ceil((n + 1) * {s}) AS BIGINT)) - 1]) END AS {p}" for p, s in (("p90", "0.9::DOUBLE"), ("p95", "0.95::DOUBLE"), ("p100", "1.0::DOUBLE"))) + " FROM s")
def d32_performance_of_fixed_leaves(spark, d):
    b = F.col("balance")
    rows = profiles(spark, d).select("msisdn", F.array((b % 7).cast("int"), (b % 11).cast("int")).alias("leaves"), b.alias("v"))
    return similar.performance(rows, rows, "msisdn", "v")


@query()
def d34_grid_search(spark, d):
    model = D.grid_search(wide(spark, d), COLUMNS, "outcome", [2, 4])
    return spark.createDataFrame([(i, float(m)) for i, m in enumerate(model.avgMetrics)], "candidate int, auc double")


@query()
def d36_cross_fold_uplift(spark, d):
    return D.uplift_curve(D.cross_fold_scores(wide(spark, d), COLUMNS, "outcome", "msisdn"), 10)


@query(ctes("revenue") + " SELECT msisdn, trx_id, event_date FROM revenue WHERE weekstart BETWEEN DATE '1998-04-06' - 55 AND DATE '1998-04-06'")
def s1_s3_dated_window(spark, d):
    path = S.scratch(spark)
    r = revenue(spark, d)
    S.weekly_backfill_write(r.select("msisdn", "trx_id", "event_date", F.date_format("weekstart", "yyyy-MM-dd").alias("weekstart")), path)
    read = S.dated_window_read(spark, path, "weekstart", "2m", "%Y-%m-%d", dt.date(1998, 4, 6))
    return read.select("msisdn", "trx_id", "event_date")


@query(ctes("revenue") + " SELECT trx_id, amount + 1 AS amount FROM revenue")
def s2_versions(spark, d):
    path, r = S.scratch(spark), revenue(spark, d).select("trx_id", "amount")
    S.versioned_write(r, path, dt.date(2024, 1, 1))
    S.versioned_write(r.withColumn("amount", F.col("amount") + 1), path, dt.date(2024, 1, 2))
    S.versioned_write(r.withColumn("amount", F.col("amount") + 2), path, dt.date(2024, 1, 3))
    return S.read_version(spark, path, skip=1)


@query(ctes("usage") + " SELECT event_id, event_date FROM usage WHERE event_date = (SELECT max(event_date) FROM usage)")
def s4_latest_partition(spark, d):
    return S.latest_partition(usage(spark, d), "event_date").select("event_id", "event_date")


@query(ctes("usage") + """ SELECT DISTINCT 'usage' AS "table", event_date, true AS is_delivered FROM usage""")
def q10_file_deliveries(spark, d):
    path = S.scratch(spark)
    usage(spark, d).select("event_id", "event_date").hint("rebalance", "event_date").write.partitionBy("event_date").parquet(path)
    found = file_deliveries(spark, path, "usage", "event_date")
    return found.select("table", "event_date", (F.col("delivered") <= F.current_timestamp()).alias("is_delivered"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_retailprice + 1 END AS p_retailprice FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, p_retailprice FROM part WHERE p_partkey % 2 = 1")
def s6_keyed_upsert(spark, d):
    p = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", "p_retailprice")
    updates = p.filter("p_partkey % 2 = 0").withColumn("p_retailprice", F.when(F.col("p_partkey") % 3 == 0, float("nan")).otherwise(F.col("p_retailprice") + 1))
    return S.keyed_upsert(p, updates, ["p_partkey"])


@query(ctes("revenue") + " SELECT msisdn, trx_id, channel FROM revenue")
def s5_external_table(spark, d):
    path, name = S.scratch(spark), f"external_{uuid.uuid4().hex}"
    r = revenue(spark, d).select("msisdn", "trx_id", "channel")
    r.hint("rebalance", "channel").write.partitionBy("channel").parquet(path)
    S.register_external_table(spark, name, path, r.schema, ["channel"])
    return spark.table(name).select("msisdn", "trx_id", "channel")


@query("SELECT DISTINCT p_brand, p_type, CAST(p_size AS VARCHAR) AS slot FROM part")
def s7_delimited_export(spark, d):
    path = S.scratch(spark)
    p = spark.read.parquet(f"{d}/part.parquet").select("p_brand", "p_type", F.col("p_size").cast("string").alias("slot"))
    S.delimited_export(p, path, "slot")
    return spark.read.schema("p_brand string, p_type string, slot string").option("sep", "|").option("header", True).csv(path)


@query("SELECT 'not_null' AS rule, 'quality' AS \"column\", (SELECT count(*) FILTER (quality IS NULL) FROM labels) AS failures UNION ALL SELECT 'not_nan', 'x', (SELECT count(*) FILTER (doc_id % 7 = 0) FROM labels)")
def s8_s9_checks(spark, d):
    t = spark.read.parquet(f"{d}/labels.parquet").withColumn("x", F.when(F.col("doc_id") % 7 == 0, float("nan")).otherwise(F.lit(1.0)))
    wrong = S.schema_check(t, T.StructType([T.StructField("x", T.DoubleType())]))
    if wrong:
        raise ValueError(wrong)
    return S.rule_check(t, ["quality"], ["x"])
