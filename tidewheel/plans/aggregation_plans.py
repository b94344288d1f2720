"""Weekly and monthly aggregations (A rows) over records derived from events, orders and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewheel.operators import aggregation as A
from tidewheel.plans.registry import query
from tidewheel.sources.derived import ctes, places, products, profiles, revenue, usage

WEEKEND = "isodow(event_date) >= 6"


def calls(spark, d):
    u = usage(spark, d).filter(F.col("kind").isin("view", "click"))
    return u.select("msisdn", "weekstart", "hour", F.when(F.col("kind") == "view", "in").otherwise("out").alias("direction"), F.col("amount").alias("duration"), "party")


CALLS_SQL = ctes("usage") + """, calls AS (
  SELECT msisdn, weekstart, hour, CASE WHEN kind = 'view' THEN 'in' ELSE 'out' END AS direction, amount AS duration, party FROM usage WHERE kind IN ('view', 'click'))"""


@query(CALLS_SQL + """
SELECT msisdn, weekstart, CAST(coalesce(sum(duration) FILTER (direction = 'in'), 0) AS BIGINT) AS inc_call_dur, CAST(coalesce(sum(duration) FILTER (direction = 'out'), 0) AS BIGINT) AS out_call_dur,
  CAST(coalesce(sum(duration) FILTER (hour < 5), 0) AS BIGINT) AS tot_dur_12_5_am, coalesce(list_sort(list(party) FILTER (direction = 'in')), []) AS inc_call_nums,
  coalesce(list_sort(list(party) FILTER (direction = 'out')), []) AS out_call_nums, list_sort(list(party)) AS inc_out_call_nums
FROM calls GROUP BY ALL""")
def a1_voice_weekly(spark, d):
    return A.voice_weekly(calls(spark, d))


def texts(spark, d):
    u = usage(spark, d).filter("kind <> 'error'")
    return u.select("msisdn", "weekstart", F.when(F.col("kind").isin("view", "click"), "voice").otherwise("sms").alias("service"), F.when(F.col("kind").isin("view", "signup"), "in").otherwise("out").alias("direction"), (F.pmod("event_id", F.lit(3)) + 1).alias("trx"))


@query(ctes("usage") + """, t AS (
  SELECT msisdn, weekstart, CASE WHEN kind IN ('view', 'click') THEN 'voice' ELSE 'sms' END AS s, CASE WHEN kind IN ('view', 'signup') THEN 'in' ELSE 'out' END AS dir, event_id % 3 + 1 AS trx FROM usage WHERE kind <> 'error')
SELECT msisdn, weekstart, CAST(coalesce(sum(trx) FILTER (s = 'sms' AND dir = 'in'), 0) AS BIGINT) AS count_sms_inc, CAST(coalesce(sum(trx) FILTER (s = 'sms' AND dir = 'out'), 0) AS BIGINT) AS count_sms_out, CAST(coalesce(sum(trx) FILTER (s = 'sms'), 0) AS BIGINT) AS count_sms_all,
  CAST(coalesce(sum(trx) FILTER (s = 'voice' AND dir = 'in'), 0) AS BIGINT) AS count_voice_inc, CAST(coalesce(sum(trx) FILTER (s = 'voice' AND dir = 'out'), 0) AS BIGINT) AS count_voice_out, CAST(coalesce(sum(trx) FILTER (s = 'voice'), 0) AS BIGINT) AS count_voice_all
FROM t GROUP BY ALL""")
def a2_text_weekly(spark, d):
    return A.text_weekly(texts(spark, d))


def _hex_senders(spark, d):
    """Senders of three shapes: a name in hexadecimal (with ? for F), a plain number, and a name with an odd digit."""
    u = usage(spark, d)
    coded = F.translate(F.hex(F.concat(F.lit("o"), "party")), "F", "?")
    sender = F.when(F.pmod("event_id", F.lit(4)) == 0, F.concat(F.lit("628"), "event_id")).when(F.pmod("event_id", F.lit(4)) == 1, F.concat(coded, F.lit("7"))).otherwise(coded)
    return u.select("event_id", "msisdn", "weekstart", "party", sender.alias("sender"), F.lit(1).cast("long").alias("incoming"))


HEX_SQL = ctes("usage") + """, h AS (
  SELECT event_id, msisdn, weekstart, party, CASE WHEN event_id % 4 = 0 THEN '628' || event_id ELSE 'o' || party END AS name FROM usage)"""


@query(HEX_SQL + " SELECT event_id, name FROM h")
def a3_decode_hex_sender(spark, d):
    return _hex_senders(spark, d).select("event_id", A.decode_hex_sender("sender").alias("name"))


def _commercial(spark, d):
    t = _hex_senders(spark, d)
    party = t.select("party").distinct()
    number = F.substring("party", 2, 10).cast("int")
    senders = party.filter(number < 30).select(F.when(number < 15, F.concat(F.lit("o"), "party")).otherwise(F.col("party")).alias("sender"), F.when(number % 2 == 0, "bank").otherwise("shop").alias("category"))
    broken = party.filter(number.between(30, 34)).select(F.concat(F.lit("o"), "party").alias("number"), F.lit("on1").alias("sender"))
    return A.commercial_weekly(t, senders, broken, "on2")


COMMERCIAL_SQL = HEX_SQL + """, n AS (SELECT *, CASE WHEN starts_with(name, 'o') THEN CAST(substr(name, 3) AS INTEGER) END AS k FROM h),
com AS (SELECT *, CASE WHEN k < 30 THEN CASE WHEN k % 2 = 0 THEN 'bank' ELSE 'shop' END WHEN k BETWEEN 30 AND 34 THEN 'shop' END AS category FROM n)"""


@query(COMMERCIAL_SQL + """
SELECT msisdn, weekstart, category, list_sort(list(DISTINCT name)) AS senders_07d, count(*) AS incoming_count_07d, count(*) FILTER (name = 'on2') AS count_txt_tax
FROM com WHERE category IS NOT NULL GROUP BY ALL""")
def a4_commercial_weekly(spark, d):
    return _commercial(spark, d)


@query(COMMERCIAL_SQL + " SELECT DISTINCT msisdn FROM com WHERE name = 'on20' AND category IS NOT NULL")
def a5_ids_with_sender(spark, d):
    return A.ids_with_sender(_commercial(spark, d), "on20")


@query(ctes("revenue") + " SELECT msisdn, weekstart, CAST(sum(amount) AS BIGINT) AS tot_amt, count(*) AS tot_trx FROM revenue GROUP BY ALL")
def a6_recharge_weekly(spark, d):
    return A.recharge_weekly(revenue(spark, d))


@query(ctes("revenue") + """ SELECT msisdn, weekstart, CAST(coalesce(sum(amount) FILTER (channel = '1-URGENT'), 0) AS BIGINT) AS tot_amt_0, count(*) FILTER (channel = '1-URGENT') AS tot_trx_0,
  CAST(coalesce(sum(amount) FILTER (channel = '5-LOW'), 0) AS BIGINT) AS tot_amt_1, count(*) FILTER (channel = '5-LOW') AS tot_trx_1 FROM revenue GROUP BY ALL""")
def a6_recharge_by_channel_weekly(spark, d):
    return A.recharge_by_channel_weekly(revenue(spark, d), ["1-URGENT", "5-LOW"])


@query(ctes("usage") + """, b AS (SELECT msisdn, weekstart, event_date, event_id AS seq, amount - 1000 AS balance FROM usage WHERE kind <> 'signup'),
r AS (SELECT DISTINCT msisdn, event_date FROM usage WHERE kind = 'signup'),
m AS (SELECT b.*, row_number() OVER (PARTITION BY msisdn, event_date ORDER BY seq DESC) AS n, lag(balance) OVER (PARTITION BY msisdn ORDER BY event_date, seq) AS before FROM b),
x AS (SELECT m.*, r.msisdn IS NOT NULL AS refill, CASE WHEN n = 1 THEN balance END AS final FROM m LEFT JOIN r ON m.msisdn = r.msisdn AND m.event_date = r.event_date)
SELECT msisdn, weekstart, min(balance) AS min_balance, avg(balance) AS avg_balance, stddev(balance) AS stddev_balance, count(*) FILTER (balance <= 0) AS zero_or_neg_count,
  arg_max(balance, struct_pack(a := event_date, b := seq)) AS last_balance, count(*) FILTER (final > 5000) AS days_above_5k, count(*) FILTER (final > 10000) AS days_above_10k, count(*) FILTER (final > 20000) AS days_above_20k,
  count(*) FILTER (final < 500) AS days_below_500, count(*) FILTER (final BETWEEN 5000 AND 10000) AS days_5k_to_10k, max(event_date) FILTER (final > 5000) AS last_date_above_5k, max(event_date) FILTER (final <= 5000) AS last_date_below_5k,
  avg(before) FILTER (refill) AS avg_balance_before_recharge, coalesce(list_sort(list(DISTINCT event_date) FILTER (refill)), []) AS recharge_dates
FROM x GROUP BY ALL""")
def a7_balance_weekly(spark, d):
    u = usage(spark, d)
    balances = u.filter("kind <> 'signup'").select("msisdn", "weekstart", "event_date", F.col("event_id").alias("seq"), (F.col("amount") - 1000).alias("balance"))
    return A.balance_weekly(balances, u.filter("kind = 'signup'"))


PACKAGES_SQL = ctes("products") + """, pk AS (SELECT msisdn, weekstart, CAST(sum(amount) AS BIGINT) AS all_amt, count(*) AS all_trx, """ + ", ".join(f"CAST(coalesce(sum(amount) FILTER (product = '{t}'), 0) AS BIGINT) AS {t.lower()}_amt, count(*) FILTER (product = '{t}') AS {t.lower()}_trx" for t in ("ECONOMY", "PROMO")) + " FROM products GROUP BY ALL)"


@query(PACKAGES_SQL + " SELECT * FROM pk")
def a6_package_purchases_weekly(spark, d):
    return A.package_purchases_weekly(products(spark, d), ["ECONOMY", "PROMO"])


DAY_NIGHT_SQL = ctes("usage") + ", dn AS (SELECT msisdn, weekstart, CAST(sum(amount) AS BIGINT) AS volume, CAST(coalesce(sum(amount) FILTER (hour > 5), 0) AS BIGINT) AS volume_day, CAST(coalesce(sum(amount) FILTER (hour <= 5), 0) AS BIGINT) AS volume_night, list_sort(list(DISTINCT party)) AS cities FROM usage GROUP BY ALL)"


def day_night(spark, d):
    return A.day_night_weekly(usage(spark, d).withColumns({"volume": F.col("amount"), "city": F.col("party")}))


@query(DAY_NIGHT_SQL + " SELECT * FROM dn")
def a8_day_night_weekly(spark, d):
    return day_night(spark, d)


INTERNET_SQL = ctes("usage") + ", i AS (SELECT msisdn, weekstart, event_date, amount AS volume, party AS city FROM usage)"


def internet(spark, d):
    return usage(spark, d).select("msisdn", "weekstart", "event_date", F.col("amount").alias("volume"), F.col("party").alias("city"))


@query(INTERNET_SQL + f""", day AS (SELECT msisdn, weekstart, event_date, sum(volume) AS volume FROM i GROUP BY ALL),
c AS (SELECT msisdn, weekstart, count(DISTINCT city) AS n_cities FROM i GROUP BY ALL)
SELECT day.msisdn, day.weekstart, CAST(sum(volume) AS BIGINT) AS volume, CAST(min(volume) AS BIGINT) AS min_volume, quantile_cont(volume, 0.5)::DOUBLE AS med_volume, CAST(max(volume) AS BIGINT) AS max_volume, stddev(volume) AS stddev_volume,
  CAST(coalesce(sum(volume) FILTER ({WEEKEND}), 0) AS BIGINT) AS volume_weekend, CAST(coalesce(sum(volume) FILTER (NOT {WEEKEND}), 0) AS BIGINT) AS volume_weekday, count(*) FILTER (volume > 10000) AS days_above_threshold,
  any_value(n_cities) AS n_cities, 7 - count(*) AS days_without_usage
FROM day JOIN c ON c.msisdn = day.msisdn AND c.weekstart = day.weekstart GROUP BY ALL""")
def a8_internet_weekly(spark, d):
    return A.internet_weekly(internet(spark, d))


def _rules(spark, d):
    p = places(spark, d)
    content = p.select(F.col("poi_id").cast("string").alias("app"), F.col("category").alias("tier"), (F.col("weight") % 5).alias("level"))
    rules = p.groupBy("category").agg(F.max("weight").alias("w")).select(F.lit(None).cast("string").alias("app"), F.when(F.length("category") % 2 == 0, F.col("category")).alias("tier"), (F.col("w") % 5).alias("level"), F.concat(F.lit("Seg_"), "category").alias("segment"))
    return content, rules


@query(ctes("places") + """, r AS (SELECT CASE WHEN length(category) % 2 = 0 THEN category END AS tier, max(weight) % 5 AS level, 'seg_' || lower(category) AS feature FROM places GROUP BY category)
SELECT DISTINCT CAST(poi_id AS VARCHAR) AS app, feature FROM places JOIN r ON (r.tier IS NULL OR r.tier = category) AND r.level = weight % 5""")
def a9_app_mapping(spark, d):
    content, rules = _rules(spark, d)
    return A.app_mapping(content, rules, ["tier", "level"], "app")


APPS_SQL = ctes("usage") + """, app_use AS (SELECT msisdn, weekstart, event_date, party AS app, amount AS volume, event_id % 7 AS duration, event_id % 2 = 0 AS fast, CASE WHEN event_id % 5 > 0 THEN event_id % 11 END AS latency FROM usage),
map AS (SELECT DISTINCT party AS app, 'f' || CAST(substr(party, 2) AS INTEGER) % 4 AS feature FROM usage)"""


def app_use(spark, d):
    u = usage(spark, d)
    use = u.select("msisdn", "weekstart", "event_date", F.col("party").alias("app"), F.col("amount").alias("volume"), F.pmod("event_id", F.lit(7)).alias("duration"), (F.pmod("event_id", F.lit(2)) == 0).alias("fast"), F.when(F.pmod("event_id", F.lit(5)) > 0, F.pmod("event_id", F.lit(11))).alias("latency"))
    mapping = u.select(F.col("party").alias("app"), F.concat(F.lit("f"), (F.substring("party", 2, 10).cast("int") % 4).cast("string")).alias("feature")).distinct()
    return use, mapping


APP_WEEKLY_SQL = APPS_SQL + f""", app_weekly AS (
SELECT msisdn, weekstart, feature, CAST(sum(volume) AS BIGINT) AS volume, list_sort(list(DISTINCT app)) AS apps, CAST(coalesce(sum(volume) FILTER (fast AND {WEEKEND}), 0) AS BIGINT) AS volume_4g_weekend,
  CAST(coalesce(sum(volume) FILTER (fast AND NOT {WEEKEND}), 0) AS BIGINT) AS volume_4g_weekday, CAST(sum(duration) AS BIGINT) AS duration, count(*) FILTER (duration > 0) AS n_timed, CAST(sum(latency) AS BIGINT) AS latency_sum, count(latency) AS n_latency, min(event_date) AS first_date, max(event_date) AS last_date
FROM app_use JOIN map USING (app) GROUP BY ALL)"""


@query(APP_WEEKLY_SQL + " SELECT * FROM app_weekly")
def a10_app_usage_weekly(spark, d):
    return A.app_usage_weekly(*app_use(spark, d))


@query(ctes("usage") + "SELECT msisdn, weekstart, " + ", ".join(
    f"CAST(coalesce(sum(amount) FILTER (event_id % 3 = {i} AND {n}({WEEKEND})), 0) AS BIGINT) AS latency_{r}_{w}_sum, count(amount) FILTER (event_id % 3 = {i} AND {n}({WEEKEND})) AS latency_{r}_{w}_count"
    for i, r in enumerate(("3g", "4g")) for w, n in (("weekdays", "NOT "), ("weekends", ""))) + " FROM usage GROUP BY ALL")
def a11_connection_weekly(spark, d):
    u = usage(spark, d).withColumns({"latency": F.col("amount"), "radio": F.element_at(F.array(F.lit("3g"), F.lit("4g"), F.lit("5g")), (F.pmod("event_id", F.lit(3)) + 1).cast("int"))})
    return A.connection_weekly(u, ["latency"], ["3g", "4g"])


@query(ctes("usage") + """SELECT msisdn, strftime(event_date, '%Y-%m') AS mo_id, count(*) FILTER (kind = 'view') AS comp_websites_visits, CAST(coalesce(sum(amount) FILTER (kind = 'view'), 0) AS BIGINT) AS comp_websites_consumption,
  count(*) FILTER (kind = 'view' OR party IN ('n1', 'n2')) AS comp_apps_websites_visits, CAST(coalesce(sum(amount) FILTER (kind = 'view' OR party IN ('n1', 'n2')), 0) AS BIGINT) AS comp_apps_websites_consumption FROM usage GROUP BY ALL""")
def a12_competitor_monthly(spark, d):
    u = usage(spark, d).withColumns({"app": F.upper("party"), "site": F.col("kind"), "trx": F.lit(1).cast("long"), "payload": F.col("amount")})
    return A.competitor_monthly(u, ["n1", "n2"], ["view"])


_BANDS = [(0, 10_000_000), (10_000_000, 30_000_000), (30_000_000, None)]


@query(ctes("revenue", "usage") + """, e AS (
  SELECT msisdn, weekstart, event_date, CASE status WHEN 'F' THEN 'voice' WHEN 'O' THEN 'data' ELSE 'sms' END AS service, amount FROM revenue
  UNION ALL SELECT msisdn, weekstart, event_date, CASE kind WHEN 'view' THEN 'voice' ELSE 'data' END, amount FROM usage),
day AS (SELECT msisdn, weekstart, event_date, coalesce(sum(amount) FILTER (service = 'voice'), 0) AS voice, coalesce(sum(amount) FILTER (service = 'data'), 0) AS data, coalesce(sum(amount) FILTER (service = 'sms'), 0) AS sms, sum(amount) AS tot FROM e GROUP BY ALL)
SELECT msisdn, weekstart, """ + ", ".join(f"CAST(sum({s}) AS BIGINT) AS rev_{s}" for s in ("voice", "data", "sms", "tot")) + ", " + ", ".join(f"count(*) FILTER ({s} >= {lo}{f' AND {s} < {hi}' if hi else ''}) AS days_{s}_{lo}" for s in ("voice", "data", "sms", "tot") for lo, hi in _BANDS) + " FROM day GROUP BY ALL")
def a13_revenue_weekly(spark, d):
    cols = ("msisdn", "weekstart", "event_date", "service", "amount")
    orders = revenue(spark, d).withColumn("service", F.when(F.col("status") == "F", "voice").when(F.col("status") == "O", "data").otherwise("sms")).select(*cols)
    events = usage(spark, d).withColumn("service", F.when(F.col("kind") == "view", "voice").otherwise("data")).select(*cols)
    return A.revenue_weekly([orders, events], [lo for lo, _ in _BANDS])


@query(ctes("usage") + """, day AS (SELECT msisdn, event_date, sum(CASE WHEN kind = 'purchase' THEN amount ELSE 0 END) AS v FROM usage GROUP BY ALL)
SELECT msisdn, event_date, CAST(event_date - max(CASE WHEN v > 0 THEN event_date END) OVER (PARTITION BY msisdn ORDER BY event_date) AS INTEGER) AS days_since_last_rev FROM day""")
def a14_days_since_last_revenue(spark, d):
    u = usage(spark, d).withColumn("amount", F.when(F.col("kind") == "purchase", F.col("amount")).otherwise(F.lit(0)))
    return A.days_since_last(u)


@query(ctes("revenue") + " SELECT msisdn, weekstart, " + ", ".join(f"CAST(coalesce(sum(amount) FILTER (day(event_date) BETWEEN {a} AND {b}), 0) AS BIGINT) AS rev_{a}_{b}" for a, b in A.SALARY_BUCKETS) + " FROM revenue GROUP BY ALL")
def a15_salary_weekly(spark, d):
    return A.salary_weekly(revenue(spark, d))


@query(ctes("revenue") + f"""SELECT msisdn, weekstart, CAST(coalesce(sum(amount) FILTER ({WEEKEND}), 0) AS BIGINT) AS rev_weekend, CAST(coalesce(sum(amount) FILTER (status = 'F'), 0) AS BIGINT) AS rev_loan, CAST(coalesce(sum(amount) FILTER (status <> 'F'), 0) AS BIGINT) AS rev_non_loan,
  coalesce(list_sort(list(DISTINCT event_date) FILTER (status = 'O')), []) AS repayment_dates, count(*) FILTER (status = 'O') - count(*) FILTER (status = 'F') AS net_repayments,
  count(DISTINCT event_date) FILTER (amount >= 10000000) AS days_above_10m, count(DISTINCT event_date) FILTER (amount >= 30000000) AS days_above_30m FROM revenue GROUP BY ALL""")
def a16_revenue_alt_weekly(spark, d):
    return A.revenue_alt_weekly(revenue(spark, d).withColumns({"loan": F.col("status") == "F", "repaid": F.col("status") == "O"}))


@query(ctes("usage") + " SELECT msisdn, weekstart, CAST(sum(amount) AS BIGINT) AS package_revenue, count(DISTINCT event_date) AS login_days FROM usage GROUP BY ALL")
def a17_login_weekly(spark, d):
    return A.login_weekly(usage(spark, d))


_PAYU = {"weekend": WEEKEND, "weekday": f"NOT ({WEEKEND})", "night": "(hour < 6 OR hour >= 22)", "day": "NOT (hour < 6 OR hour >= 22)"}


@query(ctes("usage") + "SELECT msisdn, weekstart, " + ", ".join(f"CAST(coalesce(sum(amount) FILTER ({w}), 0) AS BIGINT) AS kb_{n}, count(*) FILTER ({w}) AS trx_{n}" for n, w in _PAYU.items()) + " FROM usage GROUP BY ALL")
def a18_payu_weekly(spark, d):
    return A.payu_weekly(usage(spark, d).withColumn("kb", F.col("amount")))


@query(ctes("revenue") + """, t AS (SELECT *, substr(channel, 1, 1) AS c, strftime(event_date, '%Y-%m') AS m FROM revenue),
p AS (SELECT msisdn, c, m, min(event_date) AS paid FROM t WHERE status = 'O' GROUP BY ALL),
l AS (SELECT t.msisdn, t.weekstart, p.paid - t.event_date AS late FROM t LEFT JOIN p ON t.msisdn = p.msisdn AND t.c = p.c AND t.m = p.m WHERE status = 'F')
SELECT msisdn, weekstart, count(*) AS loans, CAST(max(late) AS INTEGER) AS max_dpd, """ + ", ".join(f"count(*) FILTER (late > {k}) AS dpd_{k}" for k in (2, 10, 15, 20, 25)) + " FROM l GROUP BY ALL")
def a19_loan_dpd_weekly(spark, d):
    r = revenue(spark, d).withColumn("campaign", F.col("channel"))
    return A.loan_dpd_weekly(r.filter("status = 'F'"), r.filter("status = 'O'").select("msisdn", "event_date", "campaign"))


LOAN_STEPS_SQL = ctes("revenue") + """, s AS (SELECT msisdn, weekstart, event_date, trx_id, 'LOAN_' || substr(channel, 1, 1) || '_' || (trx_id % 9 + 1) || 'K' AS campaign, CASE status WHEN 'P' THEN 'offered' WHEN 'F' THEN 'taken' ELSE 'repaid' END AS step, (trx_id % 9 + 1) * 1000 AS amount FROM revenue)"""


def loan_steps(spark, d):
    r = revenue(spark, d)
    campaign = F.concat(F.lit("LOAN_"), F.substring("channel", 1, 1), F.lit("_"), (F.pmod("trx_id", F.lit(9)) + 1).cast("string"), F.lit("K"))
    return r.select("msisdn", "weekstart", "event_date", "trx_id", campaign.alias("campaign"), F.when(F.col("status") == "P", "offered").when(F.col("status") == "F", "taken").otherwise("repaid").alias("step"))


@query(LOAN_STEPS_SQL + """
SELECT msisdn, weekstart, coalesce(list_sort(list(struct_pack(event_date := event_date, campaign := campaign)) FILTER (step = 'offered')), []) AS offers, coalesce(list_sort(list(struct_pack(event_date := event_date, campaign := campaign)) FILTER (step = 'taken')), []) AS taken,
  count(DISTINCT campaign) FILTER (step = 'repaid') AS offers_repaid, count(DISTINCT campaign) FILTER (step = 'offered') AS offers_eligible, avg(amount) FILTER (step = 'offered') AS avg_eligible_amount FROM s GROUP BY ALL""")
def a20_loan_tracker_weekly(spark, d):
    return A.loan_tracker_weekly(loan_steps(spark, d))


@query(ctes("revenue") + """, e AS (SELECT msisdn, event_date, weekstart, event_date - CAST(trx_id % 40 AS INTEGER) AS activation_date, status AS kind FROM revenue),
m AS (SELECT *, lag(event_date) OVER w AS le, lag(activation_date) OVER w AS la FROM e WINDOW w AS (PARTITION BY msisdn ORDER BY event_date, activation_date, kind)),
v AS (SELECT *, last_value(CASE WHEN la IS NULL OR event_date - le > 90 THEN activation_date END IGNORE NULLS) OVER (PARTITION BY msisdn ORDER BY event_date, activation_date, kind ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stands FROM m)
SELECT msisdn, weekstart, arg_max(stands, struct_pack(a := event_date, b := activation_date, c := kind)) AS activation_date FROM v GROUP BY ALL""")
def a21_length_of_service(spark, d):
    r = revenue(spark, d)
    e = r.select("msisdn", "event_date", "weekstart", F.expr("date_sub(event_date, cast(trx_id % 40 as int))").alias("activation_date"), F.col("status").alias("kind"))
    return A.length_of_service([e.filter(F.col("kind") == k) for k in ("F", "O", "P")])


@query(ctes("revenue", "profiles") + """, s AS (SELECT r.msisdn, weekstart, segment, area, amount AS points FROM revenue r JOIN profiles p ON r.msisdn = p.msisdn)
SELECT msisdn, weekstart, max(segment) AS segment, max(area) AS area, avg(points) AS points_avg, min(points) AS points_min FROM s GROUP BY ALL""")
def a22_profile_weekly(spark, d):
    return A.profile_weekly(revenue(spark, d).join(profiles(spark, d), "msisdn").withColumn("points", F.col("amount")), ["segment", "area"], "points")


@query(ctes("usage") + " SELECT CASE WHEN event_id % 2 = 0 THEN '62' || msisdn ELSE msisdn END AS msisdn, max(event_date) AS event_date, 1 AS is_nsb FROM (SELECT event_id, event_date, ltrim(msisdn, '0') AS msisdn FROM usage) GROUP BY 1")
def a23_new_sales(spark, d):
    u = usage(spark, d).select("event_date", F.when(F.pmod("event_id", F.lit(2)) == 0, F.concat(F.lit("0"), F.ltrim("msisdn", F.lit("0")))).otherwise(F.ltrim("msisdn", F.lit("0"))).alias("b_number"))
    return A.new_sales(u)


@query(ctes("revenue") + " SELECT msisdn, weekstart, max(event_date + CAST(trx_id % 30 AS INTEGER)) AS expected_expiry_date FROM revenue GROUP BY ALL")
def a23_latest_expiry(spark, d):
    return A.latest_expiry(revenue(spark, d).withColumn("expiry", F.expr("date_add(event_date, cast(trx_id % 30 as int))")))


@query(ctes("products") + " SELECT outlet_id, weekstart, arg_max(product, struct_pack(a := event_date, b := trx_id)) AS product, arg_max(maker, struct_pack(a := event_date, b := trx_id)) AS maker FROM products GROUP BY ALL")
def a24_outlet_weekly(spark, d):
    return A.latest_attributes(products(spark, d), ["outlet_id", "weekstart"], ["product", "maker"], ["event_date", "trx_id"])


@query(ctes("products") + """, u AS (SELECT msisdn, weekstart, lpad(CAST(quantity AS VARCHAR), 8, '1') || lpad(CAST(validity AS VARCHAR), 6, '0') AS imei, maker, product FROM products),
l AS (SELECT substr(imei, 1, 8) AS tac, min(struct_pack(maker := maker, model := product)) AS m FROM u GROUP BY 1)
SELECT msisdn, weekstart, list_sort(list(DISTINCT l.m.maker)) AS makers, list_sort(list(DISTINCT imei)) AS imeis, list_sort(list(DISTINCT l.m.model)) AS models FROM u JOIN l ON substr(imei, 1, 8) = tac GROUP BY ALL""")
def a25_device_weekly(spark, d):
    u = products(spark, d).select("msisdn", "weekstart", F.concat(F.lpad(F.col("quantity").cast("string"), 8, "1"), F.lpad(F.col("validity").cast("string"), 6, "0")).alias("imei"), "maker", F.col("product").alias("model"))
    lookup = A.device_lookup(u.select(F.substring("imei", 1, 8).alias("tac"), "maker", "model"))
    return A.device_weekly(u.select("msisdn", "weekstart", "imei"), lookup)


@query(ctes("usage") + " SELECT party AS cell, weekstart, avg(amount) AS latency, max(hour) AS busy FROM usage GROUP BY ALL")
def a26_kpi_weekly(spark, d):
    u = usage(spark, d).select(F.col("party").alias("cell"), "weekstart", F.col("amount").alias("latency"), F.col("hour").alias("busy"))
    return A.kpi_weekly(u, "cell", ["latency"], ["busy"])


@query(ctes("usage") + """, k AS (SELECT party AS cell, event_date, weekstart, avg(amount) AS latency, max(hour) AS busy FROM usage GROUP BY ALL),
s AS (SELECT msisdn, event_date, min(party) AS cell FROM usage GROUP BY ALL)
SELECT msisdn, weekstart, avg(latency) AS latency, max(busy) AS busy FROM s JOIN k ON s.cell = k.cell AND s.event_date = k.event_date GROUP BY ALL""")
def a26_kpi_by_id_weekly(spark, d):
    u = usage(spark, d)
    k = u.groupBy(F.col("party").alias("cell"), "event_date", "weekstart").agg(F.avg("amount").alias("latency"), F.max("hour").alias("busy"))
    return A.kpi_by_id_weekly(k, u.groupBy("msisdn", "event_date").agg(F.min("party").alias("cell")), ["latency"], ["busy"])


@query(ctes("usage") + """, g AS (SELECT party AS location, weekstart, """ + ", ".join(f"avg(amount) FILTER (kind = '{o}' AND event_id % 2 = {n}) AS \"{o}_n{n}_speed\"" for o in ("view", "click") for n in (0, 1)) + """ FROM usage GROUP BY ALL)
SELECT *, view_n0_speed - click_n0_speed AS gap_click_n0_speed, view_n1_speed - click_n1_speed AS gap_click_n1_speed FROM g""")
def a27_benchmark_weekly(spark, d):
    u = usage(spark, d).select(F.col("party").alias("location"), "weekstart", F.col("kind").alias("operator"), F.concat(F.lit("n"), F.pmod("event_id", F.lit(2)).cast("string")).alias("node"), F.col("amount").alias("speed"))
    return A.benchmark_weekly(u, ["view", "click"], ["n0", "n1"], ["speed"], "view")


_LEVEL = "CASE WHEN {c} <= 0 THEN '0' WHEN {c} <= {a} THEN 'L' WHEN {c} <= {b} THEN 'M' ELSE 'H' END"


@query("SELECT p_partkey, 'V' || " + _LEVEL.format(c="p_size % 40", a=10, b=30) + " || '_D' || " + _LEVEL.format(c="p_size", a=20, b=35) + " || '_S' || " + _LEVEL.format(c="p_size % 7", a=5, b=25) + " || '_' || CASE WHEN p_size <= 1 THEN '1d' WHEN p_size <= 7 THEN '7d' WHEN p_size <= 30 THEN '30d' ELSE '30d+' END AS code FROM part")
def a28_product_category(spark, d):
    p = spark.read.parquet(f"{d}/part.parquet").withColumns({"v": F.col("p_size") % 40, "s": F.col("p_size") % 7})
    return p.select("p_partkey", A.product_category("v", "p_size", "s", "p_size").alias("code"))


MAPPING_SQL = ctes("products") + """, c AS (SELECT maker AS sku, product AS code, min(validity) AS rank FROM products GROUP BY ALL),
top AS (SELECT sku, arg_min(code, struct_pack(a := rank, b := code)) AS code FROM c GROUP BY 1),
j AS (SELECT msisdn AS bid, code, sum(amount) AS revenue FROM products JOIN top ON maker = sku GROUP BY ALL),
s AS (SELECT bid, code, revenue::DOUBLE / sum(revenue) OVER (PARTITION BY bid)::DOUBLE AS rev_share FROM j),
m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY bid ORDER BY rev_share DESC, code) AS n FROM s) WHERE n = 1 AND code IN ('ECONOMY', 'PROMO', 'STANDARD'))"""


def product_map(spark, d):
    p = products(spark, d)
    use = p.select(F.col("msisdn").alias("bid"), F.col("maker").alias("sku"), F.col("amount").alias("revenue"))
    catalogue = p.groupBy(F.col("maker").alias("sku"), F.col("product").alias("code")).agg(F.min("validity").alias("rank"))
    return A.product_mapping(use, catalogue, ["ECONOMY", "PROMO", "STANDARD"])


@query(MAPPING_SQL + " SELECT bid, code, rev_share FROM m")
def a29_product_mapping(spark, d):
    return product_map(spark, d)


@query(MAPPING_SQL + " SELECT bid, 'BASE' AS code, 1.0::DOUBLE AS rev_share FROM m WHERE CAST(bid AS BIGINT) % 2 = 0 UNION ALL SELECT bid, code, rev_share FROM m WHERE CAST(bid AS BIGINT) % 2 = 1")
def a30_merge_mapping(spark, d):
    new = product_map(spark, d)
    base = new.filter(F.col("bid").cast("long") % 2 == 0).select("bid", F.lit("BASE").alias("code"), F.lit(1.0).alias("rev_share"))
    return A.merge_mapping(base, new)


@query(ctes("products") + """, o AS (SELECT *, CASE validity_unit WHEN 'Hours' THEN CAST(ceil(validity / 24.0) AS BIGINT) WHEN 'Weeks' THEN validity * 7 ELSE validity END AS days FROM (SELECT unnest(min(struct_pack(msisdn := msisdn, weekstart := weekstart, product := product, validity := validity, validity_unit := validity_unit))) FROM products GROUP BY trx_id)),
g AS (SELECT msisdn, weekstart, product, days, count(*) AS n FROM o GROUP BY ALL)
SELECT msisdn, weekstart, CAST(sum(n) AS BIGINT) AS activations, CAST(coalesce(sum(n) FILTER (days <= 1), 0) AS BIGINT) AS activations_1d, CAST(coalesce(sum(n) FILTER (days BETWEEN 2 AND 7), 0) AS BIGINT) AS activations_7d, CAST(coalesce(sum(n) FILTER (days > 7), 0) AS BIGINT) AS activations_over_7d,
  list_sort(list([product, CAST(n AS VARCHAR), CAST(days AS VARCHAR)])) AS product_list, CAST(coalesce(sum(n) FILTER (product = 'ECONOMY'), 0) AS BIGINT) AS n_economy, CAST(coalesce(sum(n) FILTER (product = 'PROMO'), 0) AS BIGINT) AS n_promo FROM g GROUP BY ALL""")
def a31_product_weekly(spark, d):
    p = products(spark, d)
    return A.product_weekly(p.union(p), ["ECONOMY", "PROMO"])


@query(ctes("products") + """, b AS (SELECT maker AS sku, max(validity) AS minutes, min(quantity) AS megabytes FROM products WHERE maker <> 'Brand#1' GROUP BY 1)
SELECT msisdn, weekstart, CAST(sum(coalesce(minutes, 0)) AS BIGINT) AS minutes, CAST(sum(coalesce(megabytes, 0)) AS BIGINT) AS megabytes FROM products LEFT JOIN b ON maker = sku GROUP BY ALL""")
def a32_allowance_weekly(spark, d):
    p = products(spark, d)
    buckets = p.filter("maker <> 'Brand#1'").groupBy(F.col("maker").alias("sku")).agg(F.max("validity").alias("minutes"), F.min("quantity").alias("megabytes"))
    return A.allowance_weekly(p.withColumn("sku", F.col("maker")), buckets, ["minutes", "megabytes"])
