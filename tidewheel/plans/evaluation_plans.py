"""Evaluation of models (D): stratified repeats, uplift by repeat, ROC and AUC over given scores, and model runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewheel.operators import evaluation as E
from tidewheel.plans.registry import query
from tidewheel.plans.segment_plans import COLUMNS, wide
from tidewheel.sources.derived import ctes, revenue

REPEATS, SHARE = 3, 0.7
SPLIT_SQL = ctes("revenue") + f""", u AS (
  SELECT trx_id, amount, CAST(trx_id % 2 AS INTEGER) AS treatment, (status = 'F')::INTEGER AS outcome FROM revenue),
each AS (SELECT *, CAST(unnest(range(0, {REPEATS})) AS INTEGER) AS repeat FROM u),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY repeat, treatment, outcome ORDER BY md5(trx_id || '#' || repeat), trx_id) AS k,
         count(*) OVER (PARTITION BY repeat, treatment, outcome) AS n FROM each),
split AS (
  SELECT repeat, trx_id, ((amount + repeat) % 10007)::DOUBLE AS score, treatment, outcome, k <= floor(n * {SHARE}::DOUBLE + 0.5) AS train FROM placed)"""


def split(spark, d):
    r = revenue(spark, d).select("trx_id", "amount", (F.col("trx_id") % 2).cast("int").alias("treatment"), (F.col("status") == "F").cast("int").alias("outcome"))
    rows = E.stratified_repeats(r, "trx_id", ["treatment", "outcome"], SHARE, REPEATS)
    return rows.withColumn("score", ((F.col("amount") + F.col("repeat")) % 10007).cast("double"))


def tested(spark, d):
    return split(spark, d).filter("not train").select("repeat", "trx_id", "score", "treatment", "outcome")


@query(SPLIT_SQL + " SELECT repeat, trx_id, train FROM split")
def d36_stratified_repeats(spark, d):
    return split(spark, d).select("repeat", "trx_id", "train")


FOLD_CURVE_SQL = SPLIT_SQL + """, t AS (SELECT * FROM split WHERE NOT train),
edges AS (SELECT repeat, [""" + ", ".join(f"quantile_cont(score, {1 - k / 10})" for k in range(1, 10)) + """] AS edges FROM t GROUP BY repeat),
b AS (SELECT t.*, CAST(1 + len(list_filter(edges, lambda e: score < e)) AS INTEGER) AS quantile FROM t JOIN edges USING (repeat)),
p AS (
  SELECT repeat, quantile, count(*) FILTER (treatment = 1) AS nt, count(*) FILTER (treatment = 0) AS nc,
         coalesce(sum(outcome) FILTER (treatment = 1), 0) AS yt, coalesce(sum(outcome) FILTER (treatment = 0), 0) AS yc FROM b GROUP BY ALL),
s AS (
  SELECT repeat, quantile, sum(nt) OVER w AS nt, sum(nc) OVER w AS nc, sum(yt) OVER w AS yt, sum(yc) OVER w AS yc
  FROM p WINDOW w AS (PARTITION BY repeat ORDER BY quantile)),
c AS (
  SELECT repeat, quantile, CAST(nt + nc AS BIGINT) AS n, coalesce(yt::DOUBLE / nullif(nt, 0), 0) - coalesce(yc::DOUBLE / nullif(nc, 0), 0) AS uplift FROM s),
curve AS (SELECT *, uplift * n AS gain FROM c)"""


@query(FOLD_CURVE_SQL + " SELECT * FROM curve")
def d36_fold_curves(spark, d):
    return E.uplift_curves(tested(spark, d), ["repeat"], 10)


@query(FOLD_CURVE_SQL + """, g AS (
  SELECT repeat, n, gain, lag(n) OVER w AS n0, lag(gain) OVER w AS g0 FROM curve WINDOW w AS (PARTITION BY repeat ORDER BY quantile))
SELECT repeat, sum((gain + coalesce(g0, 0)) / 2 * (n - coalesce(n0, 0))) / max(n) AS auuc FROM g GROUP BY repeat""")
def d36_fold_areas(spark, d):
    return E.uplift_areas(E.uplift_curves(tested(spark, d), ["repeat"], 10), ["repeat"])


@query(FOLD_CURVE_SQL + """ SELECT quantile, avg(uplift) AS uplift_mean, median(uplift) AS uplift_median, min(uplift) AS uplift_min, max(uplift) AS uplift_max,
  avg(gain) AS gain_mean, median(gain) AS gain_median, min(gain) AS gain_min, max(gain) AS gain_max FROM curve GROUP BY quantile""")
def d36_curve_summary(spark, d):
    return E.curve_summary(E.uplift_curves(tested(spark, d), ["repeat"], 10))


@query(SPLIT_SQL + """, t AS (SELECT * FROM split WHERE NOT train),
edges AS (SELECT [""" + ", ".join(f"quantile_cont(score, {k / 5})" for k in range(1, 5)) + """] AS edges FROM t WHERE treatment = 1),
b AS (SELECT t.*, CAST(1 + len(list_filter(list_distinct(edges), lambda e: score > e)) AS INTEGER) AS quantile FROM t, edges)
SELECT repeat, quantile, count(*) AS n, coalesce(avg(outcome) FILTER (treatment = 1), 0) - coalesce(avg(outcome) FILTER (treatment = 0), 0) AS uplift
FROM b GROUP BY repeat, quantile""")
def d21_bins_by_fold(spark, d):
    return E.uplift_bins(tested(spark, d), ["repeat"], 5)


ROC_SQL = ctes("revenue") + """, s AS (SELECT channel, (amount % 1009)::DOUBLE AS score, (status = 'F')::INTEGER AS label FROM revenue),
c AS (SELECT channel, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM s GROUP BY ALL),
r AS (
  SELECT *, sum(pos) OVER w AS positives, sum(neg) OVER w AS negatives, sum(pos) OVER (PARTITION BY channel) AS p, sum(neg) OVER (PARTITION BY channel) AS q
  FROM c WINDOW w AS (PARTITION BY channel ORDER BY score DESC))"""


def scored(spark, d):
    return revenue(spark, d).select("channel", (F.col("amount") % 1009).cast("double").alias("score"), (F.col("status") == "F").cast("int").alias("label"))


@query(ROC_SQL + " SELECT channel, score, pos, neg, CAST(positives AS BIGINT) AS positives, CAST(negatives AS BIGINT) AS negatives, negatives / q::DOUBLE AS fpr, positives / p::DOUBLE AS tpr FROM r")
def d23_roc(spark, d):
    return E.roc_points(scored(spark, d), ["channel"])


@query(ROC_SQL + " SELECT channel, CAST(max(p) AS BIGINT) AS positives, CAST(max(q) AS BIGINT) AS negatives, sum(neg * (positives - pos + pos / 2.0)) / (max(p) * max(q)) AS auc FROM r GROUP BY channel")
def d23_auc_by_channel(spark, d):
    return E.roc_areas(E.roc_points(scored(spark, d), ["channel"]), ["channel"])


@query(ctes("revenue") + """, s AS (SELECT amount::DOUBLE AS score, (status = 'F')::INTEGER AS label FROM revenue),
r AS (SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS mid FROM s),
n AS (SELECT count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives, sum(mid) FILTER (label = 1) AS ranks FROM r)
SELECT positives, negatives, (ranks - positives * (positives + 1) / 2.0) / (positives * negatives)::DOUBLE AS auc FROM n""")
def d23_auc(spark, d):
    rows = revenue(spark, d).select(F.col("amount").cast("double").alias("score"), (F.col("status") == "F").cast("int").alias("label"))
    return E.roc_areas(E.roc_points(rows, []), [])


CLASSES_SQL = ctes("revenue") + """, s AS (
  SELECT CAST(amount % 3 AS INTEGER) AS label, (amount % 101)::DOUBLE / 101 AS p0, (amount % 103)::DOUBLE / 103 AS p1, (amount % 107)::DOUBLE / 107 AS p2 FROM revenue)"""


def classified(spark, d):
    a = F.col("amount")
    return revenue(spark, d).select((a % 3).cast("int").alias("label"), *(((a % m).cast("double") / m).alias(f"p{k}") for k, m in enumerate((101, 103, 107))))


@query(CLASSES_SQL + """, e AS (
  SELECT k, CASE k WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END AS score, (label = k)::INTEGER AS y FROM s, range(0, 3) AS r(k)),
r AS (SELECT *, rank() OVER (PARTITION BY k ORDER BY score) + (count(*) OVER (PARTITION BY k, score) - 1) / 2.0 AS mid FROM e),
a AS (SELECT k, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS q, sum(mid) FILTER (y = 1) AS ranks FROM r GROUP BY k)
SELECT sum((ranks - p * (p + 1) / 2.0) / (p * q)::DOUBLE * p) / sum(p) AS auc_weighted FROM a""")
def d30_auc_weighted(spark, d):
    return E.weighted_auc(classified(spark, d), ["p0", "p1", "p2"], "label")


@query(CLASSES_SQL + """, p AS (SELECT label AS actual, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS predicted FROM s)
SELECT actual, predicted, count(*) AS n, count(*) / (SELECT count(*) FROM p)::DOUBLE AS share FROM p GROUP BY ALL""")
def d30_confusion(spark, d):
    best = F.when((F.col("p0") >= F.col("p1")) & (F.col("p0") >= F.col("p2")), 0).when(F.col("p1") >= F.col("p2"), 1).otherwise(2)
    return E.confusion(classified(spark, d).withColumn("predicted", best), "label", "predicted")


@query()
def d23_boosted_propensity(spark, d):
    """The boosted learner, fitted to one stratified part and judged on the other."""
    rows = E.at_rest(E.stratified_repeats(wide(spark, d), "msisdn", ["outcome"], 0.8, 1))
    model, importance = E.fit(rows.filter("train"), COLUMNS, "outcome", "boosted")
    points = E.roc_points(E.probability(model, rows.filter("not train"), "score"), [], "score", "outcome")
    named = spark.createDataFrame(importance, "feature string, importance double")
    # One row of figures.
    return named.join(F.broadcast(E.roc_areas(points, [])), F.lit(True))


@query()
def d35_comparability(spark, d):
    areas, _ = E.comparability(wide(spark, d), COLUMNS, "treatment", "msisdn", ["treatment", "segment"], repeats=2)
    return areas


@query()
def d35_importances(spark, d):
    _, importances = E.comparability(wide(spark, d), COLUMNS, "treatment", "msisdn", ["treatment", "segment"], repeats=2, kind="forest")
    return E.importance_summary(importances)


@query()
def d36_selected_uplift(spark, d):
    """Two features chosen by median importance over two repeats, then the curves of two repeats with these alone."""
    chosen, scored_rows, _ = E.selected_uplift(wide(spark, d), COLUMNS, "msisdn", ["treatment", "outcome"], 0.7, 2, 2)
    return E.uplift_curves(scored_rows, ["repeat"], 5).withColumn("features", F.lit(",".join(chosen)))
