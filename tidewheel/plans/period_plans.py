"""Features of fixed periods, dealt to the weeks after their close (F2, F3, F17, F24)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewheel.operators import aggregation as A
from tidewheel.operators import periods as T
from tidewheel.plans.aggregation_plans import WEEKEND
from tidewheel.plans.feature_plans import PERIODS, TEXT_SQL, _inside, scaffold_sql, scaffolded, texts
from tidewheel.plans.registry import query
from tidewheel.sources.derived import ctes, products, revenue

K = "msisdn, weekstart"
ASOF = "(PARTITION BY msisdn ORDER BY weekstart ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def closed_sql(table: str, measures: dict[str, str], periods: list[str] = tuple(PERIODS)) -> str:
    """CTEs ``m`` and ``c``: the table with <measure>_<period>; measures name -> SQL with {w} for the rows of the period and
    a number of days (-1: all) as in over(sum(x), {w28})."""
    frame = lambda n, days: f"(PARTITION BY msisdn, {_inside(n)} ORDER BY weekstart " + ("ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)" if days < 0 else f"RANGE BETWEEN INTERVAL {days - 1} DAYS PRECEDING AND CURRENT ROW)")
    of = lambda n, sql: sql.format(w28=frame(n, 28), w91=frame(n, 91), all=frame(n, -1))
    packs = ", ".join(f"CASE WHEN {_inside(n)} THEN struct_pack(" + ", ".join(f"{m} := {of(n, sql)}" for m, sql in measures.items()) + f") END AS m_{n}" for n in periods)
    last = ", ".join(f"last_value(m_{n} IGNORE NULLS) OVER {ASOF} AS c_{n}" for n in periods)
    named = ", ".join(f"c_{n}.{m} AS {m}_{n}" for n in periods for m in measures)
    return f", m AS (SELECT *, {packs} FROM {table}), l AS (SELECT *, {last} FROM m), c AS (SELECT *, {named} FROM l)"


NUMBERS_SQL = ctes("products") + """, vw AS (
  SELECT msisdn, weekstart, list(DISTINCT maker) FILTER (quantity > 10) AS outs, list(DISTINCT product) FILTER (quantity > 25) AS incs FROM products GROUP BY ALL)""" + scaffold_sql("vw")


@query(NUMBERS_SQL + closed_sql("s", {"no_inc": "CAST(sum((coalesce(len(incs), 0) = 0)::INTEGER) OVER {all} AS BIGINT)", "no_out": "CAST(sum((coalesce(len(outs), 0) = 0)::INTEGER) OVER {all} AS BIGINT)"}, ["pre"]) + f""",
e AS (SELECT msisdn, weekstart, unnest(outs) AS x FROM s),
n AS (SELECT msisdn, """ + ", ".join(f"count(DISTINCT x) FILTER ({_inside(n)}) AS {n}" for n in PERIODS) + f""" FROM e GROUP BY msisdn)
SELECT c.msisdn, c.weekstart, CASE WHEN weekstart > DATE '{PERIODS["pre"][1]}' THEN no_inc_pre END AS fea_voice_no_inc_pre, CASE WHEN weekstart > DATE '{PERIODS["pre"][1]}' THEN no_out_pre END AS fea_voice_no_out_pre, """
    + ", ".join(f"CASE WHEN weekstart > DATE '{PERIODS['post'][1]}' THEN coalesce(n.pre, 0)::DOUBLE / nullif(coalesce(n.pre, 0) + coalesce(n.{n}, 0), 0) END AS fea_voice_uniq_out_ratio_pre_{n}" for n in ("during", "post"))
    + " FROM c LEFT JOIN n USING (msisdn)")
def f2_voice_weeks(spark, d):
    q = F.col("quantity")
    w = products(spark, d).groupBy("msisdn", "weekstart").agg(F.collect_set(F.when(q > 10, F.col("maker"))).alias("out_call_nums"), F.collect_set(F.when(q > 25, F.col("product"))).alias("inc_call_nums"))
    return T.voice_weeks(scaffolded(spark, d, w), PERIODS)


TEXT_PERIODS = {"pre": ("2024-01-08", "2024-01-15"), "during": ("2024-01-22", "2024-01-22"), "post": ("2024-01-29", "2024-02-05")}
_TEXT_PRE = "weekstart BETWEEN DATE '{}' AND DATE '{}'".format(*TEXT_PERIODS["pre"])


@query(TEXT_SQL + scaffold_sql("tw") + f""", p AS (
  SELECT msisdn, CAST(sum((coalesce(sms_inc, 0) = 0)::INTEGER) AS BIGINT) AS i, CAST(sum((coalesce(sms_out, 0) = 0)::INTEGER) AS BIGINT) AS o FROM s WHERE {_TEXT_PRE} GROUP BY msisdn)
SELECT {K}, CASE WHEN weekstart > DATE '{TEXT_PERIODS["pre"][1]}' THEN i END AS fea_text_no_inc_pre, CASE WHEN weekstart > DATE '{TEXT_PERIODS["pre"][1]}' THEN o END AS fea_text_no_out_pre FROM s LEFT JOIN p USING (msisdn)""")
def f3_text_weeks(spark, d):
    return T.text_weeks(scaffolded(spark, d, A.text_weekly(texts(spark, d))), TEXT_PERIODS)


INT_MEASURES = {
    "fea_int_avg": "avg(volume) OVER {w28}", "fea_int_tot": "CAST(sum(volume) OVER {w28} AS BIGINT)", "fea_int_std": "stddev(volume) OVER {w91}",
    "fea_int_weekend": "(sum(we) OVER {w28})::DOUBLE / nullif(sum(volume) OVER {w28}, 0)", "fea_int_change": "avg(volume) OVER {w28} / nullif(avg(volume) OVER {w28} + avg(volume) OVER {w91}, 0)",
}
INT_SQL = ctes("revenue") + f""", w AS (
  SELECT msisdn, weekstart, CAST(sum(amount) AS BIGINT) AS volume, CAST(coalesce(sum(amount) FILTER ({WEEKEND}), 0) AS BIGINT) AS we FROM revenue GROUP BY ALL),
d AS (SELECT *, stddev(volume) OVER (PARTITION BY msisdn ORDER BY weekstart RANGE BETWEEN INTERVAL 90 DAYS PRECEDING AND CURRENT ROW) AS dev FROM w)"""
_WITH = [(m, n) for m in INT_MEASURES for n in ("during", "post")]


@query(INT_SQL + closed_sql("d", INT_MEASURES) + ", r AS (SELECT *, " + ", ".join(f"{m}_{n}::DOUBLE / nullif({m}_{n} + {m}_pre, 0) AS r_{m}_{n}" for m, n in _WITH) + " FROM c)"
    + f" SELECT {K}, " + ", ".join([f"{m}_{n}" for m in INT_MEASURES for n in PERIODS] + [f"last_value(r_{m}_{n} IGNORE NULLS) OVER {ASOF} AS {m}_{n}_with_pre" for m, n in _WITH]
    + [f"{v}::DOUBLE / nullif({v} + {m}_{n}, 0) AS {m}_trend_{n}" for m, v in (("fea_int_tot", "volume"), ("fea_int_std", "dev")) for n in PERIODS]) + " FROM r")
def f17_internet_weeks(spark, d):
    weekend = F.dayofweek("event_date").isin(1, 7)
    w = revenue(spark, d).groupBy("msisdn", "weekstart").agg(F.sum("amount").alias("volume"), F.sum(F.when(weekend, F.col("amount")).otherwise(0)).alias("volume_weekend"))
    return T.internet_weeks(w, PERIODS)


@query(ctes("revenue") + ", w AS (SELECT msisdn, weekstart, CAST(sum(amount) AS BIGINT) AS amt, count(*) AS trx FROM revenue GROUP BY ALL)"
    + closed_sql("w", {"amt_max": "max(amt) OVER {w91}", "trx_avg": "avg(trx) OVER {all}"}) + f" SELECT {K}, " + ", ".join(f"amt_max_{n}, trx_avg_{n}" for n in PERIODS)
    + ", " + ", ".join(f"trx_avg_{n} / nullif(trx_avg_{n} + trx_avg_pre, 0) AS trx_avg_{n}_with_pre" for n in ("during", "post")) + " FROM c")
def f24_period_closing(spark, d):
    w = revenue(spark, d).groupBy("msisdn", "weekstart").agg(F.sum("amount").alias("amt"), F.count("*").alias("trx"))
    closed = T.closing_measures(w, {"amt_max": T.over(F.max, "amt", 91), "trx_avg": T.over(F.avg, "trx", -1)}, PERIODS)
    return T.period_ratios(closed, ["trx_avg"], PERIODS, carry=False).drop("amt", "trx")
