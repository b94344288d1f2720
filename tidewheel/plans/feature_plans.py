"""Features (F) over series derived from events, orders and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewheel.functions.timekeys import period_days
from tidewheel.operators import aggregation as A
from tidewheel.operators import features as X
from tidewheel.operators import scaffold as P
from tidewheel.plans.aggregation_plans import APP_WEEKLY_SQL, CALLS_SQL, COMMERCIAL_SQL, DAY_NIGHT_SQL, LOAN_STEPS_SQL, PACKAGES_SQL, WEEKEND, _commercial, app_use, calls, day_night, internet, loan_steps, texts
from tidewheel.plans.registry import query
from tidewheel.plans.time_plans import WEEKLY_SQL, fixed, over, weekly
from tidewheel.sources.derived import ctes, products, profiles, revenue, usage

ALL = [(f"0{p}", period_days(p)) for p in X.PERIODS]
K = "msisdn, weekstart"


def scaffolded(spark, d, df):
    return P.dense_weekly(df)


def scaffold_sql(table: str) -> str:
    """A CTE ``s``: the table on the weekly scaffold of its ids."""
    return f""", grid AS (SELECT msisdn, CAST(w AS DATE) AS weekstart FROM (SELECT msisdn, min(weekstart)::TIMESTAMP AS lo, max(weekstart)::TIMESTAMP AS hi FROM {table} GROUP BY 1), unnest(generate_series(lo, hi, INTERVAL 7 DAYS)) AS g(w)),
s AS (SELECT * FROM grid LEFT JOIN {table} USING (msisdn, weekstart))"""


def rsum(c: str, n: int, keys: str = "msisdn") -> str:
    return c if n == 7 else f"sum({c}) OVER {over(n, keys=keys)}"


def big(c: str) -> str:
    return f"CAST({c} AS BIGINT)"


def since(active: str, lookback: int = 11) -> str:
    past = f"last_value(CASE WHEN {active} THEN weekstart END IGNORE NULLS) OVER (PARTITION BY msisdn ORDER BY weekstart ROWS BETWEEN {lookback} PRECEDING AND 1 PRECEDING)"
    return f"CAST(CASE WHEN coalesce({active}, false) THEN 0 ELSE coalesce((weekstart - {past}) // 7, 99999) END AS BIGINT)"


def idle(c: str, s: int, e: int) -> str:
    return f"CAST(sum((coalesce({c}, 0) = 0)::INTEGER) OVER {fixed(s, e)} AS BIGINT)"


VOICE_SQL = CALLS_SQL + """, v AS (SELECT msisdn, weekstart, coalesce(sum(duration) FILTER (direction = 'in'), 0) AS i, coalesce(sum(duration) FILTER (direction = 'out'), 0) AS o, coalesce(sum(duration) FILTER (hour < 5), 0) AS night,
  coalesce(list(party) FILTER (direction = 'in'), []) AS ip, coalesce(list(party) FILTER (direction = 'out'), []) AS op, list(party) AS ap FROM calls GROUP BY ALL)""" + scaffold_sql("v") + ", x AS (SELECT *, coalesce(len(ip), 0) AS n_in, coalesce(len(op), 0) AS n_out, coalesce(len(ap), 0) AS n_all, coalesce(i, 0) + coalesce(o, 0) AS dur FROM s)"


def uniq(c: str, n: int, missing: str = "-1") -> str:
    if n == 7:
        return f"CAST(len(list_distinct({c})) AS INTEGER)"
    return f"CAST(len(list_distinct(flatten(list({c}) FILTER ({c} IS NOT NULL) OVER {over(n)}))) AS INTEGER)"


@query(VOICE_SQL + f" SELECT {K}, " + ", ".join(
    [f"{big(rsum(c, n))} AS fea_voice_{m}_{p}" for m, c in (("inc_dur", "i"), ("out_dur", "o"), ("night_dur", "night"), ("inc_count", "n_in"), ("out_count", "n_out"), ("all_count", "n_all")) for p, n in ALL]
    + [f"coalesce({uniq(c, n)}, CASE WHEN {n} > 7 THEN 0 END) AS fea_voice_uniq_{m}_{p}" for m, c in (("in", "ip"), ("out", "op"), ("all", "ap")) for p, n in ALL]
    + [f"(sum(n_in) OVER {over(91)})::DOUBLE / nullif(sum(n_all) OVER {over(91)}, 0) AS fea_voice_share_inc_count_03m", f"(sum(i) OVER {over(91)})::DOUBLE / nullif(sum(dur) OVER {over(91)}, 0) AS fea_voice_share_inc_dur_03m", f"{since('i > 0')} AS fea_voice_weeks_since_last_inc", f"{since('o > 0')} AS fea_voice_weeks_since_last_out"]
    + [f"{idle('dur', s, e)} AS fea_voice_idle_weeks_{e // 7}_to_{s // 7}" for s, e in X.BANDS]
    + [f"coalesce({uniq('ap', 91)}, 0) / 3.0::DOUBLE AS fea_voice_uniq_all_03m_third"]) + " FROM x")
def f1_voice(spark, d):
    return X.voice(scaffolded(spark, d, A.voice_weekly(calls(spark, d))))


TEXT_SQL = ctes("usage") + """, t AS (SELECT msisdn, weekstart, CASE WHEN kind IN ('view', 'click') THEN 'voice' ELSE 'sms' END AS s, CASE WHEN kind IN ('view', 'signup') THEN 'in' ELSE 'out' END AS dir, event_id % 3 + 1 AS trx FROM usage WHERE kind <> 'error'),
tw AS (SELECT msisdn, weekstart, """ + ", ".join(f"coalesce(sum(trx) FILTER (s = '{s}'{f' AND dir = {q}' if q else ''}), 0) AS {s}_{n}" for s in ("sms", "voice") for n, q in (("inc", "'in'"), ("out", "'out'"), ("all", ""))) + " FROM t GROUP BY ALL)"


@query(TEXT_SQL + scaffold_sql("tw") + f" SELECT {K}, " + ", ".join(
    [f"{big(rsum(f'sms_{m}', n))} AS fea_text_sms_{m}_{p}" for m in ("inc", "out", "all") for p, n in ALL]
    + [f"(sum(sms_{m}) OVER {over(n)})::DOUBLE / nullif(sum(sms_{m}) OVER {over(n)} + sum(voice_{m}) OVER {over(n)}, 0) AS fea_text_share_{m}_{p}" for m in ("inc", "out", "all") for p, n in (("01m", 28), ("03m", 91))]
    + [f"{since('sms_all > 0')} AS fea_text_weeks_since_last"] + [f"{idle('sms_all', s, e)} AS fea_text_idle_weeks_{e // 7}_to_{s // 7}" for s, e in X.BANDS]) + " FROM s")
def f3_texts(spark, d):
    return X.texts(scaffolded(spark, d, A.text_weekly(texts(spark, d))))


@query(COMMERCIAL_SQL + f""", cw AS (SELECT msisdn, weekstart, category, list(DISTINCT name) AS names, count(*) AS n FROM com WHERE category IS NOT NULL GROUP BY ALL),
r AS (SELECT msisdn, weekstart, category, sum(n) OVER {over(7, keys='msisdn, category')} AS c1, sum(n) OVER {over(28, keys='msisdn, category')} AS c4, len(list_distinct(names)) AS s1, len(list_distinct(flatten(list(names) OVER {over(28, keys='msisdn, category')}))) AS s4 FROM cw)
SELECT {K}, """ + ", ".join(f"CAST(max({v}) FILTER (category = '{c}') AS {'INTEGER' if v[0] == 's' else 'BIGINT'}) AS fea_comm_text_{c}_{n}" for c in ("bank", "shop") for n, v in (("count_1w", "c1"), ("senders_1w", "s1"), ("count_1m", "c4"), ("senders_1m", "s4"))) + " FROM r GROUP BY ALL")
def f4_commercial_texts(spark, d):
    return X.commercial_texts(_commercial(spark, d), ["bank", "shop"])


BALANCE_SQL = ctes("usage") + """, u AS (SELECT *, row_number() OVER (PARTITION BY msisdn, event_date, kind <> 'signup' ORDER BY event_id DESC) AS k FROM usage),
bw AS (SELECT msisdn, weekstart, sum(amount) AS tot_amt, count(*) FILTER (kind = 'signup') AS tot_trx, min(amount - 1000) FILTER (kind <> 'signup') AS min_balance, avg(amount - 1000) FILTER (kind <> 'signup') AS avg_balance,
  count(*) FILTER (kind <> 'signup' AND k = 1 AND amount - 1000 > 5000) AS days_above_5k FROM u GROUP BY ALL)"""


def balance(spark, d):
    u = usage(spark, d)
    b = A.balance_weekly(u.filter("kind <> 'signup'").select("msisdn", "weekstart", "event_date", F.col("event_id").alias("seq"), (F.col("amount") - 1000).alias("balance")), u.filter("kind = 'signup'"))
    totals = u.groupBy("msisdn", "weekstart").agg(F.sum("amount").alias("tot_amt"), F.count_if(F.col("kind") == "signup").alias("tot_trx"))
    return totals.join(b.select("msisdn", "weekstart", "min_balance", "avg_balance", "days_above_5k"), ["msisdn", "weekstart"], "left").fillna(0, ["days_above_5k"])


@query(BALANCE_SQL + scaffold_sql("bw") + f" SELECT {K}, CAST(weekstart - last_value(CASE WHEN tot_trx > 0 THEN weekstart END IGNORE NULLS) OVER (PARTITION BY msisdn ORDER BY weekstart) AS INTEGER) AS fea_rech_days_since_last, (sum(tot_amt) OVER {over(28)})::DOUBLE / nullif(sum(tot_amt) OVER {fixed(56, 28)}, 0) AS fea_rech_trend_01m_to_02m, " + ", ".join(
    [f"{big(rsum(c, n))} AS fea_rech_{m}_{p}" for m, c in (("amt", "tot_amt"), ("trx", "tot_trx"), ("days_above_5k", "days_above_5k")) for p, n in ALL]
    + [f"(sum(tot_amt) OVER {over(n)})::DOUBLE / nullif(sum(tot_trx) OVER {over(n)}, 0) AS fea_rech_amt_per_trx_{p}" for p, n in ALL]
    + [("min_balance" if n == 7 else f"min(min_balance) OVER {over(n)}") + f" AS fea_rech_bal_min_{p}" for p, n in ALL] + [("avg_balance" if n == 7 else f"avg(avg_balance) OVER {over(n)}") + f" AS fea_rech_bal_avg_{p}" for p, n in ALL]) + " FROM s")
def f6_recharge(spark, d):
    return X.recharge(scaffolded(spark, d, balance(spark, d)))


def dominant_sql(name: str, n: int, first: str, second: str) -> str:
    w = over(n, keys="msisdn, channel")
    return f""", {name}_s AS (SELECT msisdn, weekstart, channel, sum(v) OVER {w} AS v, sum(n) OVER {w} AS n FROM g),
{name} AS (SELECT msisdn, weekstart, channel FROM (SELECT *, row_number() OVER (PARTITION BY msisdn, weekstart ORDER BY {first} DESC, {second} DESC, channel) AS r FROM {name}_s WHERE n IS NOT NULL) WHERE r = 1)"""


@query(ctes("revenue") + """, t AS (SELECT msisdn, weekstart, channel, sum(amount) AS v, count(*) AS n FROM revenue GROUP BY ALL),
g AS (SELECT w.msisdn, w.weekstart, c.channel, t.v, t.n FROM (SELECT DISTINCT msisdn, weekstart FROM revenue) w JOIN (SELECT DISTINCT msisdn, channel FROM revenue) c USING (msisdn) LEFT JOIN t ON t.msisdn = w.msisdn AND t.weekstart = w.weekstart AND t.channel = c.channel)""" + dominant_sql("dv", 91, "v", "n") + dominant_sql("dc", 91, "n", "v") + f""",
p AS (SELECT msisdn, weekstart, coalesce(sum(v) FILTER (channel = '1-URGENT'), 0) AS a, coalesce(sum(n) FILTER (channel = '1-URGENT'), 0) AS b FROM t GROUP BY ALL)
SELECT p.msisdn, p.weekstart, {big(f"sum(a) OVER {over(91, 'p.weekstart', 'p.msisdn')}")} AS fea_rech_amt_0_03m, {big(f"sum(b) OVER {over(91, 'p.weekstart', 'p.msisdn')}")} AS fea_rech_trx_0_03m, dv.channel AS fea_rech_dominant_by_value_03m, dc.channel AS fea_rech_dominant_by_count_03m
FROM p JOIN dv ON dv.msisdn = p.msisdn AND dv.weekstart = p.weekstart JOIN dc ON dc.msisdn = p.msisdn AND dc.weekstart = p.weekstart""")
def f7_recharge_by_channel(spark, d):
    return X.recharge_by_channel(revenue(spark, d), ["1-URGENT"], ("3m",))


_RECENT = [(f"0{p}", period_days(p)) for p in ("1m", "3m")]


@query(ctes("products") + """, t AS (SELECT msisdn, weekstart, validity_unit AS channel, sum(amount) AS v, count(*) AS n FROM products GROUP BY ALL),
g AS (SELECT w.msisdn, w.weekstart, c.channel, t.v, t.n FROM (SELECT DISTINCT msisdn, weekstart FROM products) w
  JOIN (SELECT DISTINCT msisdn, validity_unit AS channel FROM products) c USING (msisdn)
  LEFT JOIN t ON t.msisdn = w.msisdn AND t.weekstart = w.weekstart AND t.channel = c.channel)""" + "".join(dominant_sql(f"d{p}", n, "v", "n") for p, n in _RECENT) + """,
p AS (SELECT msisdn, weekstart, sum(v) AS revenue, sum(n) AS trx FROM t GROUP BY ALL),
r AS (SELECT msisdn, weekstart, """ + ", ".join(f"{big(rsum(c, n))} AS fea_app_rev_{m}_{p}" for c, m in (("revenue", "sum"), ("trx", "trx")) for p, n in _RECENT) + """ FROM p)
SELECT r.*, """ + ", ".join(f"d{p}.channel AS fea_app_rev_dominant_method_{p}" for p, _ in _RECENT) + " FROM r " + " ".join(f"JOIN d{p} ON d{p}.msisdn = r.msisdn AND d{p}.weekstart = r.weekstart" for p, _ in _RECENT))
def f11_app_revenue(spark, d):
    return X.app_revenue(products(spark, d).withColumnRenamed("validity_unit", "method"), ("1m", "3m"))


SERVICES_SQL = ctes("revenue") + ", rw AS (SELECT msisdn, weekstart, " + ", ".join(f"coalesce(sum(amount) FILTER (status = '{s}'), 0) AS rev_{s.lower()}" for s in "FOP") + ", sum(amount) AS rev_tot FROM revenue GROUP BY ALL)"


def services(spark, d):
    r = revenue(spark, d)
    return r.groupBy("msisdn", "weekstart").agg(*(F.coalesce(F.sum(F.when(F.col("status") == s, F.col("amount"))), F.lit(0)).alias(f"rev_{s.lower()}") for s in "FOP"), F.sum("amount").alias("rev_tot"))


@query(SERVICES_SQL + f" SELECT {K}, " + ", ".join(f"{big(rsum(f'rev_{s}', n))} AS fea_rev_{s}_sum_{p}" for s in "fop" for p, n in ALL) + ", " + ", ".join(f"{big(rsum('(rev_f + rev_o + rev_p)', n))} AS fea_rev_tot_sum_{p}" for p, n in ALL) + " FROM rw")
def f9_revenue(spark, d):
    return X.revenue(services(spark, d), ["f", "o", "p"])


@query(SERVICES_SQL + f" SELECT {K}, " + ", ".join([(f"avg(rev_f) OVER {over(n)}" if a == "avg" else big(f"{a}(rev_f) OVER {over(n)}")) + f" AS fea_spend_f_{a}_{p}" for a in ("min", "max", "avg") for p, n in (("01m", 28), ("03m", 91))]) + f", {big(f'sum(rev_f) OVER {fixed(56, 28)}')} AS fea_spend_f_past_5w_8w, (sum(rev_f) OVER {over(28)})::DOUBLE / nullif(sum(rev_f) OVER {fixed(56, 28)}, 0) AS fea_spend_f_trend, {big(f'max(rev_f) OVER {over(91)} - min(rev_f) OVER {over(91)}')} AS fea_spend_f_range_03m FROM rw")
def f10_monthly_spend(spark, d):
    return X.monthly_spend(services(spark, d), ["f"])


@query(ctes("revenue") + ", w AS (SELECT msisdn, weekstart, " + ", ".join(f"coalesce(sum(amount) FILTER (day(event_date) BETWEEN {a} AND {b}), 0) AS rev_{a}_{b}" for a, b in A.SALARY_BUCKETS) + f", sum(amount) AS t FROM revenue GROUP BY ALL) SELECT {K}, " + ", ".join(f"(sum(rev_{a}_{b}) OVER {over(91)})::DOUBLE / nullif(sum(t) OVER {over(91)}, 0) AS fea_salary_rev_{a}_{b}_03m" for a, b in A.SALARY_BUCKETS) + " FROM w")
def f12_salary_shares(spark, d):
    return X.salary_shares(A.salary_weekly(revenue(spark, d)), [f"rev_{a}_{b}" for a, b in A.SALARY_BUCKETS])


@query(SERVICES_SQL + f" SELECT {K}, CAST(weekstart - last_value(CASE WHEN rev_tot > 0 THEN weekstart END IGNORE NULLS) OVER (PARTITION BY msisdn ORDER BY weekstart) AS INTEGER) AS fea_days_since_last_rev, {since('rev_f > 0')} AS fea_weeks_since_last_rev_f, " + ", ".join(f"(sum(rev_f) OVER {over(n)})::DOUBLE / nullif(sum(rev_tot) OVER {over(n)}, 0) AS fea_rev_f_share_{p}" for p, n in ALL if n > 7) + " FROM rw")
def f13_f15_f22_spend_pattern(spark, d):
    return X.spend_pattern(services(spark, d), "rev_f", "rev_tot")


@query(ctes("revenue") + f""", w AS (SELECT msisdn, weekstart, count(*) FILTER (amount >= 10000000) AS days_10m, count(*) FILTER (amount >= 30000000) AS days_30m FROM (SELECT msisdn, weekstart, event_date, sum(amount) AS amount FROM revenue GROUP BY ALL) GROUP BY ALL)
SELECT {K}, """ + ", ".join(f"{big(rsum(c, n))} AS fea_rev_{c}_{p}" for c in ("days_10m", "days_30m") for p, n in ALL) + " FROM w")
def f14_threshold_days(spark, d):
    daily = revenue(spark, d).groupBy("msisdn", "weekstart", "event_date").agg(F.sum("amount").alias("amount"))
    w = daily.groupBy("msisdn", "weekstart").agg(*(F.count_if(F.col("amount") >= k * 1_000_000).alias(f"days_{k}m") for k in (10, 30)))
    return X.sums_over_list(w, ["days_10m", "days_30m"], "rev")


@query(ctes("usage") + f""", day AS (SELECT msisdn, weekstart, event_date, sum(amount) AS volume FROM usage GROUP BY ALL),
iw AS (SELECT msisdn, weekstart, sum(volume) AS volume, min(volume) AS lo, max(volume) AS hi, coalesce(sum(volume) FILTER ({WEEKEND}), 0) AS we, coalesce(sum(volume) FILTER (NOT {WEEKEND}), 0) AS wd, count(*) FILTER (volume > 10000) AS thr FROM day GROUP BY ALL)
SELECT {K}, (sum(we) OVER {over(28)})::DOUBLE / nullif(sum(volume) OVER {over(28)}, 0) AS fea_int_weekend_share_01m, """ + ", ".join(
    [f"{big(rsum(c, n))} AS fea_int_{m}_{p}" for m, c in (("volume", "volume"), ("volume_weekend", "we"), ("volume_weekday", "wd"), ("days_above_threshold", "thr")) for p, n in ALL]
    + [big(c if n == 7 else f"{f}({c}) OVER {over(n)}") + f" AS fea_int_{f}_{p}" for f, c in (("min", "lo"), ("max", "hi")) for p, n in ALL]
    + [f"quantile_cont(volume, 0.5) OVER {over(n)} AS fea_int_med_{p}, stddev(volume) OVER {over(n)} AS fea_int_std_{p}" for p, n in (("01m", 28), ("03m", 91))]) + " FROM iw")
def f16_internet_usage(spark, d):
    return X.internet_usage(A.internet_weekly(internet(spark, d)))


def _clamp(c: str) -> str:
    return f"CAST(greatest(-1, least(91, coalesce({c}, -1))) AS INTEGER)"


_FK = "msisdn, feature"


@query(APP_WEEKLY_SQL + f""", r AS (SELECT msisdn, weekstart, feature, sum(volume) OVER {over(7, keys=_FK)} AS volume_01w, sum(volume) OVER {over(28, keys=_FK)} AS volume_01m, len(list_distinct(flatten(list(apps) OVER {over(7, keys=_FK)}))) AS apps_01w, len(list_distinct(flatten(list(apps) OVER {over(28, keys=_FK)}))) AS apps_01m,
  {_clamp(f"weekstart - min(first_date) OVER (PARTITION BY {_FK} ORDER BY weekstart)")} AS days_since_first, {_clamp(f"weekstart - max(last_date) OVER (PARTITION BY {_FK} ORDER BY weekstart)")} AS days_since_last FROM app_weekly)
SELECT {K}, """ + ", ".join(f"CAST(max({n}) FILTER (feature = '{f}') AS {'BIGINT' if n[0] == 'v' else 'INTEGER'}) AS fea_app_{f}_{n}" for f in ("f0", "f1") for n in ("volume_01w", "volume_01m", "apps_01w", "apps_01m", "days_since_first", "days_since_last")) + " FROM r GROUP BY ALL")
def f18_app_usage(spark, d):
    return X.app_usage(A.app_usage_weekly(*app_use(spark, d)), ["f0", "f1"], ("1w", "1m"))


@query(ctes("usage") + f", w AS (SELECT msisdn, weekstart, sum(amount) AS s, count(*) FILTER (event_id % 3 <> 0) AS c FROM usage GROUP BY ALL) SELECT {K}, " + ", ".join(f"(sum(s) OVER {over(n)})::DOUBLE / nullif(sum(c) OVER {over(n)}, 0) AS fea_conn_latency_{p}" for p, n in ALL) + " FROM w")
def f20_connection(spark, d):
    w = usage(spark, d).groupBy("msisdn", "weekstart").agg(F.sum("amount").alias("latency_sum"), F.count_if(F.pmod("event_id", F.lit(3)) != 0).alias("latency_count"))
    return X.connection(w, ["latency"])


@query(ctes("revenue") + """, m AS (SELECT msisdn, CAST(date_trunc('month', event_date) AS DATE) AS month, sum(amount) AS v FROM revenue GROUP BY ALL),
r AS (SELECT msisdn, month, v AS v1, sum(v) OVER (PARTITION BY msisdn ORDER BY month RANGE BETWEEN INTERVAL 1 MONTH PRECEDING AND CURRENT ROW) AS v2, sum(v) OVER (PARTITION BY msisdn ORDER BY month RANGE BETWEEN INTERVAL 2 MONTHS PRECEDING AND CURRENT ROW) AS v3 FROM m),
w AS (SELECT DISTINCT weekstart, CAST(date_trunc('month', weekstart) - CASE WHEN day(weekstart) < 10 THEN INTERVAL 2 MONTHS ELSE INTERVAL 1 MONTH END AS DATE) AS month FROM revenue)
SELECT msisdn, weekstart, CAST(v1 AS BIGINT) AS fea_comp_v_01m, CAST(v2 AS BIGINT) AS fea_comp_v_02m, CAST(v3 AS BIGINT) AS fea_comp_v_03m FROM r JOIN w USING (month)""")
def f21_competitor_apps(spark, d):
    r = revenue(spark, d)
    return X.competitor_apps(r.groupBy("msisdn", F.trunc("event_date", "month").alias("month")).agg(F.sum("amount").alias("v")), r, ["v"])


PERIODS = {"pre": ("1996-01-01", "1996-06-24"), "during": ("1996-07-01", "1996-12-30"), "post": ("1997-01-06", "1997-06-30")}
_SOFAR = "OVER (PARTITION BY msisdn ORDER BY weekstart)"


@query(WEEKLY_SQL + ", c AS (SELECT msisdn, weekstart, " + ", ".join(f"{big(f"sum(CASE WHEN weekstart BETWEEN DATE '{a}' AND DATE '{b}' THEN loan END) {_SOFAR}")} AS {n}" for n, (a, b) in PERIODS.items()) + f" FROM weekly) SELECT {K}, pre AS fea_loan_pre, during AS fea_loan_during, post AS fea_loan_post, " + ", ".join(f"CASE WHEN pre <> 0 AND {n} <> 0 THEN pre::DOUBLE / (pre + {n}) END AS fea_loan_ratio_pre_{n}" for n in ("during", "post")) + " FROM c")
def f24_fixed_period_compare(spark, d):
    return X.fixed_period_compare(weekly(spark, d), "loan", PERIODS)


for _name, _column in (("f2_voice_fixed_periods", "trx"), ("f8_recharge_fixed_periods", "amt")):
    def _fixed(spark, d, column=_column):
        return X.fixed_period_compare(weekly(spark, d), column, PERIODS)

    _fixed.__name__ = _name
    query(WEEKLY_SQL + ", c AS (SELECT msisdn, weekstart, " + ", ".join(f"{big(f"sum(CASE WHEN weekstart BETWEEN DATE '{a}' AND DATE '{b}' THEN {_column} END) {_SOFAR}")} AS {n}" for n, (a, b) in PERIODS.items()) + f" FROM weekly) SELECT {K}, pre AS fea_{_column}_pre, during AS fea_{_column}_during, post AS fea_{_column}_post, " + ", ".join(f"CASE WHEN pre <> 0 AND {n} <> 0 THEN pre::DOUBLE / (pre + {n}) END AS fea_{_column}_ratio_pre_{n}" for n in ("during", "post")) + " FROM c")(_fixed)


def _inside(n: str) -> str:
    return "weekstart BETWEEN DATE '{}' AND DATE '{}'".format(*PERIODS[n])


def _ratios(name: str) -> list[str]:
    return [f"CASE WHEN fea_{name}_pre <> 0 AND fea_{name}_{n} <> 0 THEN fea_{name}_pre::DOUBLE / (fea_{name}_pre + fea_{name}_{n}) END AS fea_{name}_ratio_pre_{n}" for n in ("during", "post")]


CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(ctes("products") + ", vw AS (SELECT msisdn, weekstart, CAST(sum(quantity) AS BIGINT) AS seconds, list(DISTINCT maker) AS numbers FROM products GROUP BY ALL)" + scaffold_sql("vw") + ", m AS (SELECT msisdn, " + ", ".join(
    f"{big(f'sum(seconds) FILTER ({_inside(n)})')} AS fea_voice_secs_{n}, count(*) FILTER ({_inside(n)} AND coalesce(seconds, 0) = 0) AS fea_voice_idle_weeks_{n}, CAST(coalesce(len(list_distinct(flatten(list(numbers) FILTER ({_inside(n)} AND numbers IS NOT NULL)))), 0) AS INTEGER) AS fea_voice_numbers_{n}" for n in PERIODS)
    + " FROM s GROUP BY 1) SELECT *, " + ", ".join(_ratios("voice_secs")) + " FROM m")
def f2_voice_fixed_measures(spark, d):
    w = products(spark, d).groupBy("msisdn", "weekstart").agg(F.sum("quantity").alias("seconds"), F.collect_set("maker").alias("numbers"))
    return X.voice_fixed_periods(scaffolded(spark, d, w), PERIODS)


def _category_sql(name: str, value: str) -> str:
    sums = ", ".join(f"{big(f"sum({value}) FILTER (category = '{c}' AND {_inside(n)})")} AS fea_{name}_{c}_{n}" for c in CATEGORIES for n in PERIODS)
    return ctes("products") + f", w AS (SELECT msisdn, weekstart, product AS category, count(*) AS n, sum(quantity) AS volume FROM products GROUP BY ALL), m AS (SELECT msisdn, {sums} FROM w GROUP BY 1) SELECT *, " + ", ".join(r for c in CATEGORIES for r in _ratios(f"{name}_{c}")) + " FROM m"


def by_category(spark, d):
    return products(spark, d).groupBy("msisdn", "weekstart", F.col("product").alias("category")).agg(F.count("*").alias("n"), F.sum("quantity").alias("volume"))


@query(_category_sql("comm", "n"))
def f5_commercial_fixed_measures(spark, d):
    return X.category_fixed_periods(by_category(spark, d), CATEGORIES, "n", "comm", PERIODS)


@query(_category_sql("app", "volume"))
def f19_app_fixed_measures(spark, d):
    return X.category_fixed_periods(by_category(spark, d), CATEGORIES, "volume", "app", PERIODS)


@query(ctes("products") + f", w AS (SELECT msisdn, weekstart, product AS category, sum(quantity) AS volume FROM products GROUP BY ALL) SELECT {K}, category, volume::DOUBLE / sum(volume) OVER {over(28, keys='msisdn, category')} AS fea_volume_trend FROM w")
def f19_app_trend(spark, d):
    return X.category_trend(by_category(spark, d).drop("n"), "volume")


@query(ctes("revenue") + f", w AS (SELECT msisdn, weekstart, CAST(sum(amount) AS BIGINT) AS volume, CAST(coalesce(sum(amount) FILTER ({WEEKEND}), 0) AS BIGINT) AS we FROM revenue GROUP BY ALL), m AS (SELECT msisdn, max_by(volume, weekstart) AS last, " + ", ".join(
    f"{big(f'sum(volume) FILTER ({_inside(n)})')} AS fea_int_sum_{n}, avg(volume) FILTER ({_inside(n)}) AS fea_int_avg_{n}, stddev(volume) FILTER ({_inside(n)}) AS fea_int_std_{n}, (sum(we) FILTER ({_inside(n)}))::DOUBLE / (sum(volume) FILTER ({_inside(n)})) AS fea_int_weekend_share_{n}" for n in PERIODS)
    + " FROM w GROUP BY 1) SELECT * EXCLUDE (last), fea_int_avg_during - fea_int_avg_pre AS fea_int_change_pre_during, fea_int_avg_post - fea_int_avg_pre AS fea_int_change_pre_post, last / (last + fea_int_avg_pre) AS fea_int_last_ratio, " + ", ".join([*_ratios("int_sum"), *_ratios("int_avg")]) + " FROM m")
def f17_internet_fixed_measures(spark, d):
    weekend = F.dayofweek("event_date").isin(1, 7)
    w = revenue(spark, d).groupBy("msisdn", "weekstart").agg(F.sum("amount").alias("volume"), F.sum(F.when(weekend, F.col("amount")).otherwise(0)).alias("volume_weekend"))
    return X.internet_fixed_periods(w, PERIODS)


PRODUCT_SQL = ctes("products") + """, o AS (SELECT *, CASE validity_unit WHEN 'Hours' THEN CAST(ceil(validity / 24.0) AS BIGINT) WHEN 'Weeks' THEN validity * 7 ELSE validity END AS days FROM (SELECT unnest(min(struct_pack(msisdn := msisdn, weekstart := weekstart, product := product, validity := validity, validity_unit := validity_unit))) FROM products GROUP BY trx_id)),
g AS (SELECT msisdn, weekstart, product, days, count(*) AS n FROM o GROUP BY ALL),
pw AS (SELECT msisdn, weekstart, count(*) AS activated, max(days) AS longest, arg_max(product, struct_pack(a := n, b := product)) AS best, list(struct_pack(p := product, until := weekstart + CAST(days AS INTEGER))) AS dated FROM g GROUP BY ALL)"""


@query(PRODUCT_SQL + f""", c AS (SELECT *, coalesce(best <> lag(best) OVER (PARTITION BY msisdn ORDER BY weekstart), false)::INTEGER AS changed, flatten(list(dated) OVER {over(91)}) AS recent FROM pw)
SELECT {K}, CAST(activated AS INTEGER) AS fea_prod_activated, CAST(len(list_distinct(list_transform(list_filter(recent, lambda x: x.until >= weekstart), lambda x: x.p))) AS INTEGER) AS fea_prod_active, CAST(sum(changed) OVER {over(91)} AS BIGINT) AS fea_prod_changes_03m, best AS fea_prod_most_used, longest AS fea_prod_max_validity FROM c""")
def f25_products(spark, d):
    return X.products(A.product_weekly(products(spark, d), []))


@query(ctes("products") + f", w AS (SELECT msisdn, weekstart, sum(validity) AS minutes, sum(quantity) AS megabytes FROM products GROUP BY ALL) SELECT {K}, " + ", ".join(f"{big(rsum(c, n))} AS fea_allow_{c}_{p}" for c in ("minutes", "megabytes") for p, n in ALL) + " FROM w")
def f23_f26_f38_rolling_sums(spark, d):
    w = products(spark, d).groupBy("msisdn", "weekstart").agg(F.sum("validity").alias("minutes"), F.sum("quantity").alias("megabytes"))
    return X.sums_over_list(w, ["minutes", "megabytes"], "allow")


@query(ctes("products") + f""", w AS (SELECT msisdn, weekstart, list_sort(list(DISTINCT maker)) AS makers, list_sort(list(DISTINCT trx_id)) AS imeis FROM products GROUP BY ALL),
b AS (SELECT *, makers[1] AS maker, last_value(makers[1] IGNORE NULLS) OVER (PARTITION BY msisdn ORDER BY weekstart ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM w)
SELECT {K}, before AS fea_device_last_maker, CAST(len(list_distinct(flatten(list(imeis) OVER {over(91)}))) AS INTEGER) AS fea_device_count_03m, CAST(sum(coalesce(maker <> before, false)::INTEGER) OVER {over(91)} AS BIGINT) AS fea_device_changes_03m, list_transform(imeis, lambda i: substr(i, 1, 14)) AS fea_device_imeis FROM b""")
def f27_devices(spark, d):
    w = products(spark, d).groupBy("msisdn", "weekstart").agg(F.array_sort(F.collect_set("maker")).alias("makers"), F.array_sort(F.collect_set("trx_id")).alias("imeis"))
    return X.devices(w)


def _modes_sql(c: str) -> str:
    best = f"row_number() OVER (PARTITION BY msisdn, weekstart ORDER BY n DESC, {c})"
    return f""", n_{c} AS (SELECT msisdn, weekstart, {c}, count(*) AS n FROM daily GROUP BY ALL),
a_{c} AS (SELECT msisdn, weekstart + 7 * k AS weekstart, {c}, sum(n) AS n FROM n_{c}, unnest([0, 1, 2, 3]) AS t(k) GROUP BY ALL),
w_{c} AS (SELECT msisdn, weekstart, {c} AS fea_device_{c}_mode_01w FROM (SELECT *, {best} AS r FROM n_{c}) WHERE r = 1),
m_{c} AS (SELECT msisdn, weekstart, {c} AS fea_device_{c}_mode_04w FROM (SELECT *, {best} AS r FROM a_{c}) WHERE r = 1),
i_{c} AS (SELECT weekstart, {c} AS fea_device_{c}_mode_01w, count(DISTINCT msisdn) AS fea_device_same_{c}_ids FROM daily GROUP BY ALL)"""


@query(ctes("products") + ", daily AS (SELECT msisdn, weekstart, product AS tac, maker FROM products)" + _modes_sql("tac") + _modes_sql("maker") + """
SELECT * FROM w_tac JOIN m_tac USING (msisdn, weekstart) JOIN w_maker USING (msisdn, weekstart) JOIN m_maker USING (msisdn, weekstart)
JOIN i_tac USING (weekstart, fea_device_tac_mode_01w) JOIN i_maker USING (weekstart, fea_device_maker_mode_01w)""")
def f29_device_modes(spark, d):
    return X.device_modes(products(spark, d).select("msisdn", "weekstart", F.col("product").alias("tac"), "maker"))


@query(ctes("products") + """, c AS (SELECT maker AS imei, CAST(date_trunc('month', event_date) AS DATE) AS month, count(DISTINCT msisdn) AS ids FROM products GROUP BY ALL),
e AS (SELECT DISTINCT msisdn, weekstart, maker AS imei, CAST(date_trunc('month', weekstart) - CASE WHEN day(weekstart) < 10 THEN INTERVAL 2 MONTHS ELSE INTERVAL 1 MONTH END AS DATE) AS month FROM products)
SELECT msisdn, weekstart, max(ids) AS fea_device_max_ids FROM e LEFT JOIN c USING (imei, month) GROUP BY ALL""")
def f28_shared_devices(spark, d):
    p = products(spark, d)
    w = p.groupBy("msisdn", "weekstart").agg(F.collect_set("maker").alias("imeis"))
    return X.shared_devices(w, p.groupBy(F.col("maker").alias("imei"), F.trunc("event_date", "month").alias("month")).agg(F.countDistinct("msisdn").alias("ids")))


@query(WEEKLY_SQL + """, a AS (SELECT msisdn, weekstart, CASE WHEN loan > 0 THEN weekstart - 10 END AS d FROM weekly),
f AS (SELECT msisdn, weekstart, coalesce(last_value(d IGNORE NULLS) OVER (PARTITION BY msisdn ORDER BY weekstart ROWS BETWEEN 12 PRECEDING AND CURRENT ROW), first_value(d IGNORE NULLS) OVER (PARTITION BY msisdn ORDER BY weekstart ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)) AS d FROM a)
SELECT msisdn, weekstart, CAST(CASE WHEN weekstart - d >= 0 THEN weekstart - d END AS INTEGER) AS fea_los_days FROM f""")
def f30_length_of_service(spark, d):
    return X.length_of_service(weekly(spark, d).withColumn("activation_date", F.when(F.col("loan") > 0, F.date_sub("weekstart", 10))))


@query(ctes("revenue") + """, d AS (SELECT msisdn, event_date, sum(amount) AS points FROM revenue GROUP BY ALL), s AS (SELECT *, coalesce(points - lag(points) OVER (PARTITION BY msisdn ORDER BY event_date), 0) AS step FROM d)
SELECT msisdn, event_date, """ + ", ".join(f"CAST(sum(greatest({g}step, 0)) OVER {over(n, 'event_date')} AS BIGINT) AS fea_points_{m}_{n}d" for m, g in (("earned", ""), ("used", "-")) for n in (30, 90)) + " FROM s")
def f31_loyalty_points(spark, d):
    return X.loyalty_points(revenue(spark, d).groupBy("msisdn", "event_date").agg(F.sum("amount").alias("points")))


@query(ctes("products") + f", w AS (SELECT msisdn, weekstart, max(CASE WHEN outlet_id % 2 = 0 THEN outlet_id END) AS outlet_id FROM products GROUP BY ALL) SELECT {K}, last_value(outlet_id IGNORE NULLS) OVER {over(182)} AS fea_custprof_activation_outlet_06m FROM w")
def f31_activation_outlet(spark, d):
    return X.activation_outlet(products(spark, d).groupBy("msisdn", "weekstart").agg(F.max(F.when(F.col("outlet_id") % 2 == 0, F.col("outlet_id"))).alias("outlet_id")))


@query(ctes("usage") + ", w AS (SELECT party AS cell, weekstart, avg(amount) AS latency FROM usage GROUP BY ALL) SELECT cell, weekstart, " + ", ".join(("latency" if n == 7 else f"avg(latency) OVER {over(n, keys='cell')}") + f" AS fea_network_latency_{p}" for p, n in ALL) + " FROM w")
def f32_network_kpis(spark, d):
    w = usage(spark, d).groupBy(F.col("party").alias("cell"), "weekstart").agg(F.avg("amount").alias("latency"))
    return X.network_kpis(w, "cell", ["latency"])


@query(ctes("usage") + f""", w AS (SELECT party AS location, weekstart, avg(amount) FILTER (kind = 'view') AS v, avg(amount) FILTER (kind = 'click') AS c, max(amount) FILTER (kind = 'view') AS hi, min(amount) FILTER (kind = 'view') AS lo FROM usage GROUP BY ALL)
SELECT location, weekstart, avg(v) OVER {over(28, keys='location')} AS fea_bench_own_avg_01m, avg(c) OVER {over(28, keys='location')} AS fea_bench_other_avg_01m, CASE WHEN lo > c THEN 'p10' WHEN hi > c THEN 'p90' END AS fea_bench_first_better FROM w""")
def f33_f34_benchmark(spark, d):
    of = lambda k: F.when(F.col("kind") == k, F.col("amount"))
    w = usage(spark, d).groupBy(F.col("party").alias("location"), "weekstart").agg(F.avg(of("view")).alias("own_avg"), F.avg(of("click")).alias("other_avg"), F.max(of("view")).alias("own_p90"), F.min(of("view")).alias("own_p10"))
    return X.map_location_features(w.select("location", "weekstart"), X.benchmark(w, "own", "other", ["p10", "p90"]))


LOANS_SQL = LOAN_STEPS_SQL + """, lw AS (SELECT msisdn, weekstart, coalesce(list(DISTINCT campaign) FILTER (step = 'offered'), []) AS sent, coalesce(list(DISTINCT campaign) FILTER (step = 'taken'), []) AS accepted FROM s GROUP BY ALL)"""


@query(LOANS_SQL + f""", d AS (SELECT t.msisdn, t.weekstart, max(t.event_date - o.event_date) AS days FROM s t JOIN s o ON o.msisdn = t.msisdn AND o.campaign = t.campaign AND o.step = 'offered' AND t.step = 'taken' AND t.event_date >= o.event_date GROUP BY ALL)
SELECT lw.msisdn, lw.weekstart, """ + ", ".join(f"CAST(len(list_distinct({c if n == 7 else f'flatten(list({c}) OVER {over(n, "lw.weekstart", "lw.msisdn")})'})) AS INTEGER) AS fea_loan_offers_{c}_{p}" for c in ("sent", "accepted") for p, n in (("01w", 7), ("01m", 28), ("03m", 91))) + f", avg(days) OVER {over(91, 'lw.weekstart', 'lw.msisdn')} AS fea_loan_takeup_days_03m FROM lw LEFT JOIN d ON d.msisdn = lw.msisdn AND d.weekstart = lw.weekstart")
def f35_loans(spark, d):
    return X.loans(A.loan_tracker_weekly(loan_steps(spark, d)))


_STEPS = ["offered", "taken", "repaid"]


@query(LOAN_STEPS_SQL + ", w AS (SELECT msisdn, weekstart, " + ", ".join(f"count(*) FILTER (step = '{s}') AS n_{s}" for s in _STEPS) + " FROM s GROUP BY ALL) "
       + f"SELECT {K}, " + ", ".join(f"{big(rsum(f'n_{s}', n))} AS fea_loan_notifications_{s}_{p}" for s in _STEPS for p, n in ALL) + " FROM w")
def f35_loan_notifications(spark, d):
    return X.loan_notifications(loan_steps(spark, d), _STEPS)


@query(LOANS_SQL + f""", b AS (SELECT msisdn, weekstart, min(trx_id % 1000) AS low FROM s GROUP BY ALL), j AS (SELECT lw.msisdn, lw.weekstart, CASE WHEN low <= 500 THEN sent ELSE [] END AS sent FROM lw JOIN b USING (msisdn, weekstart))
SELECT {K}, CAST(len(list_distinct(flatten(list(sent) OVER {over(91)}))) AS INTEGER) AS fea_loan_triggered_offers_03m FROM j""")
def f36_triggered_offers(spark, d):
    s = loan_steps(spark, d)
    return X.triggered_offers(A.loan_tracker_weekly(s), s.groupBy("msisdn", "weekstart").agg(F.min(F.pmod("trx_id", F.lit(1000))).alias("min_balance")))


@query(LOAN_STEPS_SQL + """, o AS (SELECT msisdn, min(struct_pack(d := event_date, c := campaign)) AS o FROM s WHERE step = 'offered' GROUP BY 1), p AS (SELECT msisdn, o.d AS offered, substr(o.c, 1, 6) AS prefix FROM o)
SELECT p.msisdn, offered, CAST((SELECT min(event_date) FROM s WHERE s.msisdn = p.msisdn AND step = 'taken' AND event_date >= offered AND substr(campaign, 1, 6) = prefix) - offered AS INTEGER) AS days_to_accept,
  CAST((SELECT min(event_date) FROM s WHERE s.msisdn = p.msisdn AND step = 'repaid' AND event_date >= offered) - offered AS INTEGER) AS days_to_recharge FROM p""")
def f36_first_steps(spark, d):
    s = loan_steps(spark, d)
    return X.first_steps(A.loan_tracker_weekly(s), s.filter("step = 'repaid'"))


@query(LOAN_STEPS_SQL + """, w AS (SELECT DISTINCT msisdn, weekstart FROM s),
o AS (SELECT msisdn, weekstart, campaign, event_date AS made FROM s WHERE step = 'offered'),
oa AS (
  SELECT o.msisdn, o.weekstart, o.made, min(t.event_date) AS accepted FROM o LEFT JOIN s t
  ON t.msisdn = o.msisdn AND t.step = 'taken' AND t.campaign = o.campaign AND t.event_date >= o.made GROUP BY o.msisdn, o.weekstart, o.campaign, o.made),
f AS (SELECT msisdn, weekstart, min(made) AS made, min(accepted) AS accepted FROM oa GROUP BY ALL),
g AS (
  SELECT f.msisdn, f.weekstart, f.made, f.accepted, min(t.event_date) AS refilled FROM f LEFT JOIN s t
  ON t.msisdn = f.msisdn AND t.step = 'repaid' AND t.event_date >= f.made GROUP BY ALL),
j AS (SELECT msisdn, weekstart, CASE WHEN accepted IS NULL OR accepted > refilled THEN refilled - made END AS gap FROM w LEFT JOIN g USING (msisdn, weekstart))
""" + f"SELECT {K}, " + ", ".join(("gap::DOUBLE" if n == 7 else f"avg(gap) OVER {over(n)}") + f" AS fea_loan_recharge_gap_{p}" for p, n in ALL) + " FROM j")
def f36_recharge_gaps(spark, d):
    s = loan_steps(spark, d)
    out = X.recharge_gaps(A.loan_tracker_weekly(s), s.filter("step = 'repaid'"))
    return out.withColumn("fea_loan_recharge_gap_01w", F.col("fea_loan_recharge_gap_01w").cast("double"))


@query(ctes("revenue") + """, e AS (SELECT msisdn, event_date, weekstart, trx_id, CASE WHEN status = 'O' THEN 1 ELSE 0 END AS r FROM revenue WHERE status IN ('F', 'O')),
k AS (SELECT *, coalesce(sum(r) OVER (PARTITION BY msisdn ORDER BY event_date, r, trx_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stretch FROM e),
f AS (
  SELECT *, first_value(CASE WHEN r = 0 THEN event_date END IGNORE NULLS) OVER (PARTITION BY msisdn, stretch ORDER BY event_date, r, trx_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS a,
         last_value(CASE WHEN r = 0 THEN event_date END IGNORE NULLS) OVER (PARTITION BY msisdn ORDER BY event_date, r, trx_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b FROM k),
p AS (SELECT msisdn, weekstart, sum(event_date - coalesce(a, b)) AS days, count(event_date - coalesce(a, b)) AS n FROM f WHERE r = 1 GROUP BY ALL),
w AS (SELECT DISTINCT msisdn, weekstart FROM revenue),
j AS (SELECT * FROM w LEFT JOIN p USING (msisdn, weekstart))
""" + f"SELECT {K}, " + ", ".join(f"(sum(days) OVER {over(n)})::DOUBLE / nullif(sum(n) OVER {over(n)}, 0) AS fea_loan_repay_days_{p}" for p, n in ALL if n in (28, 56, 91)) + " FROM j")
def f37_repayment_means(spark, d):
    r = revenue(spark, d)
    repaid = X.repayments(r.filter("status = 'F'"), r.filter("status = 'O'"))
    return X.repayment_means(r.select("msisdn", "weekstart").distinct(), repaid)


@query(ctes("revenue") + """, e AS (SELECT msisdn, event_date, trx_id, CASE WHEN status = 'O' THEN 1 ELSE 0 END AS r FROM revenue WHERE status IN ('F', 'O')),
k AS (SELECT *, coalesce(sum(r) OVER (PARTITION BY msisdn ORDER BY event_date, r, trx_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stretch FROM e),
f AS (SELECT *, first_value(CASE WHEN r = 0 THEN event_date END IGNORE NULLS) OVER (PARTITION BY msisdn, stretch ORDER BY event_date, r, trx_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS a, last_value(CASE WHEN r = 0 THEN event_date END IGNORE NULLS) OVER (PARTITION BY msisdn ORDER BY event_date, r, trx_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b FROM k)
SELECT msisdn, trx_id, event_date, coalesce(a, b) AS loan_date, CAST(event_date - coalesce(a, b) AS INTEGER) AS days_to_repay FROM f WHERE r = 1""")
def f37_repayments(spark, d):
    r = revenue(spark, d)
    return X.repayments(r.filter("status = 'F'"), r.filter("status = 'O'"))


@query(ctes("revenue") + """, e AS (SELECT msisdn, event_date, trx_id, CASE WHEN status = 'F' THEN 1 ELSE 0 END AS l FROM revenue WHERE status IN ('F', 'O')), k AS (SELECT *, lag(l) OVER (PARTITION BY msisdn ORDER BY event_date, l, trx_id) AS before FROM e)
SELECT msisdn, trx_id, event_date, CAST(coalesce(before, 0) = 1 AS INTEGER) AS without_repayment FROM k WHERE l = 1""")
def f37_unpaid_loans(spark, d):
    r = revenue(spark, d)
    return X.unpaid_loans(r.filter("status = 'F'"), r.filter("status = 'O'"))


@query(ctes("revenue") + """, n AS (SELECT msisdn, weekstart, sum(amount) AS revenue FROM revenue WHERE status = 'P' GROUP BY ALL),
l AS (SELECT l.*, CASE WHEN EXISTS (SELECT 1 FROM revenue r WHERE r.status = 'O' AND r.msisdn = l.msisdn AND r.event_date >= l.event_date AND r.event_date <= last_day(l.event_date) + 93) THEN 1 ELSE 0 END AS flag FROM revenue l WHERE status = 'F')
SELECT l.msisdn, l.trx_id, flag, (coalesce(n.revenue, 0) + l.amount * flag)::DOUBLE + 0.08::DOUBLE * l.amount * (flag - 1) AS target FROM l LEFT JOIN n ON n.msisdn = l.msisdn AND n.weekstart = l.weekstart""")
def f39_proxy_target(spark, d):
    r = revenue(spark, d)
    non_loan = r.filter("status = 'P'").groupBy("msisdn", "weekstart").agg(F.sum("amount").alias("revenue"))
    return X.proxy_target(r.filter("status = 'F'").select("msisdn", "trx_id", "event_date", "weekstart", "amount"), r.filter("status = 'O'").select("msisdn", "event_date"), non_loan).withColumn("target", F.col("target").cast("double"))


BANDS_SQL = ctes("usage") + """, u AS (SELECT *, row_number() OVER (PARTITION BY msisdn, event_date, kind <> 'signup' ORDER BY event_id DESC) AS k, amount - 1000 AS b FROM usage),
bw AS (SELECT msisdn, weekstart, avg(b) AS avg_balance, count(*) FILTER (k = 1 AND b > 10000) AS days_above_10k, count(*) FILTER (k = 1 AND b BETWEEN 5000 AND 10000) AS days_5k_to_10k, count(*) FILTER (k = 1 AND b < 500) AS days_below_500 FROM u WHERE kind <> 'signup' GROUP BY ALL)"""
BANDS = ["above_10k", "5k_to_10k", "below_500"]


@query(BANDS_SQL + scaffold_sql("bw") + f" SELECT {K}, " + ", ".join(
    [f"stddev(avg_balance) OVER {over(n)} AS fea_rech_bal_std_{p}" for p, n in (("01m", 28), ("03m", 91))] + [f"{big(rsum(f'days_{b}', n))} AS fea_rech_days_{b}_{p}" for b in BANDS for p, n in ALL]) + " FROM s")
def f6_balance_measures(spark, d):
    u = usage(spark, d)
    balances = u.filter("kind <> 'signup'").select("msisdn", "weekstart", "event_date", F.col("event_id").alias("seq"), (F.col("amount") - 1000).alias("balance"))
    return X.balance_measures(scaffolded(spark, d, A.balance_weekly(balances, u.filter("kind = 'signup'"))), BANDS)


PACKAGES = ["all_amt", "all_trx", "economy_amt", "economy_trx", "promo_amt", "promo_trx"]


@query(PACKAGES_SQL + f" SELECT {K}, " + ", ".join(f"{big(rsum(c, n))} AS fea_pack_{c}_{p}" for c in PACKAGES for p, n in ALL) + " FROM pk")
def f6_package_sums(spark, d):
    return X.sums_over_list(A.package_purchases_weekly(products(spark, d), ["ECONOMY", "PROMO"]), PACKAGES, "pack")


@query(DAY_NIGHT_SQL + f" SELECT {K}, (sum(volume_night) OVER {over(28)})::DOUBLE / nullif(sum(volume) OVER {over(28)}, 0) AS fea_int_night_share_01m, " + ", ".join(
    [f"{big(rsum(c, n))} AS fea_int_{c}_{p}" for c in ("volume_day", "volume_night") for p, n in ALL] + [f"CAST(len(list_distinct(flatten(list(cities) OVER {over(n)}))) AS INTEGER) AS fea_int_cities_{p}" for p, n in ALL]) + " FROM dn")
def f16_internet_day_night(spark, d):
    return X.internet_day_night(day_night(spark, d))


_APP = {"latency": "sum(latency_sum) OVER {w} / nullif((sum(n_latency) OVER {w})::DOUBLE, 0)", "speed": "sum(volume) OVER {w} / nullif((sum(duration) OVER {w})::DOUBLE, 0)", **{c: f"CAST(sum({c}) OVER {{w}} AS BIGINT)" for c in ("duration", "volume_4g_weekday", "volume_4g_weekend")}}


@query(APP_WEEKLY_SQL + ", r AS (SELECT msisdn, weekstart, feature, " + ", ".join(f"{e.format(w=over(n, keys=_FK))} AS {m}_{p}" for m, e in _APP.items() for p, n in (("01w", 7), ("01m", 28))) + f" FROM app_weekly) SELECT {K}, " + ", ".join(
    f"max({m}_{p}) FILTER (feature = '{f}') AS fea_app_{f}_{m}_{p}" for f in ("f0", "f1") for m in _APP for p in ("01w", "01m")) + " FROM r GROUP BY ALL")
def f18_app_quality(spark, d):
    return X.app_quality(A.app_usage_weekly(*app_use(spark, d)), ["f0", "f1"], ("1w", "1m"))


@query(PRODUCT_SQL + ", m AS (SELECT msisdn, weekstart, " + ", ".join(f"coalesce(sum(n) FILTER (product = '{t}'), 0) AS {t.lower()}" for t in ("ECONOMY", "PROMO")) + f""", min(days) AS lo, max(days) AS hi, sum(days) AS total, count(*) AS kinds FROM g GROUP BY ALL)
SELECT {K}, """ + ", ".join(f"{big(f'sum({t}) OVER {over(n)}')} AS fea_prod_{t}_{p}" for t in ("economy", "promo") for p, n in (("01w", 7), ("01m", 28), ("03m", 91))) + ", " + ", ".join(
    f"{big(f'min(lo) OVER {over(n)}')} AS fea_prod_validity_min_{p}, {big(f'max(hi) OVER {over(n)}')} AS fea_prod_validity_max_{p}, (sum(total) OVER {over(n)})::DOUBLE / (sum(kinds) OVER {over(n)})::DOUBLE AS fea_prod_validity_avg_{p}" for p, n in (("01w", 7), ("01m", 28), ("03m", 91))) + " FROM m")
def f25_product_measures(spark, d):
    return X.product_measures(A.product_weekly(products(spark, d), []), ["ECONOMY", "PROMO"])


@query(ctes("products") + ", w AS (SELECT msisdn, weekstart, min(maker) AS maker, max(product) FILTER (quantity > 25) AS type, max(trx_id) FILTER (quantity > 10) AS name FROM products GROUP BY ALL) SELECT msisdn, weekstart, " + ", ".join(
    f"last_value({c} IGNORE NULLS) OVER (PARTITION BY msisdn ORDER BY weekstart ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS fea_device_last_{c}" for c in ("maker", "type", "name")) + " FROM w")
def f27_device_attributes(spark, d):
    where = lambda n, c: F.max(F.when(F.col("quantity") > n, F.col(c)))
    w = products(spark, d).groupBy("msisdn", "weekstart").agg(F.min("maker").alias("maker"), where(25, "product").alias("type"), where(10, "trx_id").alias("name"))
    return X.device_attributes(w, ["maker", "type", "name"])


@query(ctes("usage", "profiles") + f""", w AS (SELECT u.msisdn, u.weekstart, max(event_date) + 30 AS expiry_date, max((kind = 'signup')::INTEGER) AS is_new, sum(amount) AS points, max(area) FILTER (event_id % 3 = 0) AS area FROM usage u LEFT JOIN profiles p ON p.msisdn = u.msisdn GROUP BY ALL)
SELECT {K}, CAST(expiry_date - weekstart AS INTEGER) AS fea_custprof_days_to_expiry, max(is_new) OVER {over(182)} AS fea_custprof_is_new_06m, {big(f"sum(points) OVER {over(182)}")} AS fea_custprof_points_sum_06m, avg(points) OVER {over(182)} AS fea_custprof_points_avg_06m,
  {big(f"min(points) OVER {over(182)}")} AS fea_custprof_points_min_06m, {big(f"max(points) OVER {over(182)}")} AS fea_custprof_points_max_06m, last_value(area IGNORE NULLS) OVER (PARTITION BY msisdn ORDER BY weekstart) AS fea_custprof_area FROM w""")
def f31_profile(spark, d):
    rows = usage(spark, d).join(profiles(spark, d).select("msisdn", "area"), "msisdn", "left")
    w = rows.groupBy("msisdn", "weekstart").agg(F.date_add(F.max("event_date"), 30).alias("expiry_date"), F.max((F.col("kind") == "signup").cast("int")).alias("is_new"), F.sum("amount").alias("points"), F.max(F.when(F.pmod("event_id", F.lit(3)) == 0, F.col("area"))).alias("area"))
    return X.profile(w, ["area"])


GRADES = {"good": "amount > 15000", "fair": "amount BETWEEN 5000 AND 15000", "bad": "amount < 5000"}


@query(ctes("usage") + ", w AS (SELECT party AS location, weekstart, " + ", ".join(f"count(*) FILTER ({e}) AS {g}" for g, e in GRADES.items()) + " FROM usage GROUP BY ALL) SELECT location, weekstart, " + ", ".join(
    f"(sum({g}) OVER {over(n, keys='location')})::DOUBLE / nullif((sum(good + fair + bad) OVER {over(n, keys='location')})::DOUBLE, 0) AS fea_network_{g}_share_{p}" for g in GRADES for p, n in (("01m", 28), ("03m", 91))) + " FROM w")
def f33_signal_shares(spark, d):
    w = usage(spark, d).groupBy(F.col("party").alias("location"), "weekstart").agg(*(F.count_if(F.expr(e)).alias(g) for g, e in GRADES.items()))
    return X.signal_shares(w, list(GRADES))
