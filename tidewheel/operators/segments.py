"""Drift, scores, segments and model jobs, all as Spark jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.ml.feature import PCA, Bucketizer, Imputer, OneHotEncoder, RobustScaler, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.functions.quantiles import exact_percentiles, percent_rank, percentiles_of
from tidewheel.functions.relational import hash_unit
from tidewheel.sources.io import at_rest


def long_values(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """keys, feature, value."""
    rows = F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns))
    return df.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")


def psi_baseline(df: DataFrame, columns: list[str], bins: int = 5, least_distinct: int = 5) -> DataFrame:
    """D1. feature, bin, low, high, proportion: quantile bins of features with more than so many distinct values.

    A bin reaches from its lower edge to below the next; the first and last are open.
    """
    v = long_values(df, [], columns).filter("value is not null")
    per = v.groupBy("feature").agg(F.countDistinct("value").alias("n")).filter(F.col("n") > least_distinct)
    quantiles = exact_percentiles(v, ["feature"], "value", tuple(k / bins for k in range(1, bins)))
    edges = per.join(quantiles, "feature").select("feature", F.array_distinct(F.array_sort("q")).alias("edges"))
    ends = F.concat(F.array(F.lit(None).cast("double")), F.col("edges"), F.array(F.lit(None).cast("double")))
    table = edges.select("feature", F.posexplode(F.arrays_zip(F.slice(ends, F.lit(1), F.size("edges") + 1).alias("low"), F.slice(ends, F.lit(2), F.size("edges") + 1).alias("high"))).alias("bin", "e")).select("feature", "bin", "e.low", "e.high")
    counts = binned(v, edges).groupBy("feature", "bin").agg(F.count("*").alias("n"))
    joined = table.join(counts, ["feature", "bin"], "left").fillna(0, ["n"])
    return joined.withColumn("proportion", F.try_divide(F.col("n").cast("double"), F.sum("n").over(Window.partitionBy("feature")))).drop("n")


def binned(values: DataFrame, edges: DataFrame) -> DataFrame:
    """values (feature, value) with their bin: the number of edges at or below the value."""
    return values.join(edges, "feature").withColumn("bin", F.size(F.filter("edges", lambda e: F.col("value") >= e))).drop("edges")


def psi(current: DataFrame, baseline: DataFrame, columns: list[str]) -> DataFrame:
    """D2. feature, psi: sum of (current - base) * ln(current / base); a bin missing on either side counts as 1."""
    v = long_values(current, [], columns).filter("value is not null")
    edges = baseline.groupBy("feature").agg(F.array_sort(F.array_compact(F.collect_list("low"))).alias("edges"))
    now = binned(v, edges).groupBy("feature", "bin").agg(F.count("*").alias("n"))
    now = now.withColumn("current", F.col("n") / F.sum("n").over(Window.partitionBy("feature"))).drop("n")
    one = lambda c: F.coalesce(F.when(F.col(c) > 0, F.col(c)), F.lit(1.0))
    both = baseline.select("feature", "bin", "proportion").join(now, ["feature", "bin"], "full").select("feature", one("current").alias("c"), one("proportion").alias("b"))
    return both.groupBy("feature").agg(F.sum((F.col("c") - F.col("b")) * F.log(F.col("c") / F.col("b"))).alias("psi"))


def rfm_inputs(profile: DataFrame, classes: DataFrame, channels: dict[str, int]) -> DataFrame:
    """D3. profile: msisdn, device, channel, spend_1..3, recharge, trx. Device class, channel group 1-3, greatest spend, recharge per transaction."""
    group = F.coalesce(*(F.when(F.col("channel") == k, v) for k, v in channels.items()), F.lit(1))
    joined = profile.join(classes, "device", "left").withColumns({"device_class": F.coalesce("device_class", F.lit("unknown")), "channel_group": group})
    return joined.withColumns({"max_spend": F.greatest("spend_1", "spend_2", "spend_3"), "recharge_per_trx": F.col("recharge") / F.when(F.col("trx") == 0, 1).otherwise(F.col("trx"))})


def band_score(column: str, cuts: tuple[float, ...]) -> Column:
    """1 for values up to the first cut, one more for each further one."""
    return reduce(lambda a, b: a + b, ((F.coalesce(F.col(column), F.lit(0)) > c).cast("int") for c in cuts), F.lit(1))


def rfm_score(df: DataFrame, cuts: dict[str, tuple[float, float]]) -> DataFrame:
    """D4. A score of 1 to 3 per measure, their total, and segment: 5-7 low, 8-11 medium, else high."""
    scored = df.withColumns({f"{c}_score": band_score(c, v) for c, v in cuts.items()})
    total = reduce(lambda a, b: a + b, (F.col(f"{c}_score") for c in cuts))
    segment = F.when(F.col("total_score") <= 7, "low").when(F.col("total_score") <= 11, "medium").otherwise("high")
    return scored.withColumn("total_score", total).withColumn("segment", segment)


def rfm_cutoffs(df: DataFrame, columns: list[str]) -> DataFrame:
    """D5. measure, low_cut, high_cut: means of the values between the 1st and 33rd and the 33rd and 67th percentile.

    Percentile bands come from counts of values instead of a sort of all rows into a hundred tiles.
    """
    v = long_values(df, [], columns).filter("value is not null")
    q = exact_percentiles(v, ["feature"], "value", (0.33, 0.67))
    joined = v.join(q, "feature")
    low, mid = F.col("value") <= F.col("q")[0], (F.col("value") > F.col("q")[0]) & (F.col("value") <= F.col("q")[1])
    return joined.groupBy(F.col("feature").alias("measure")).agg(F.avg(F.when(low, F.col("value"))).alias("low_cut"), F.avg(F.when(mid, F.col("value"))).alias("high_cut"))


def segment_summary(df: DataFrame, bands: dict[str, tuple[str, tuple[float, ...]]], measures: list[str]) -> DataFrame:
    """D6, D8. Counts, sums, means and share of ids by segment and banded columns. bands: name -> (column, cuts)."""
    out = df.withColumns({n: band_score(c, cuts) for n, (c, cuts) in bands.items()})
    per = out.groupBy("segment", *bands).agg(F.count("*").alias("ids"), *(a for m in measures for a in (F.sum(m).alias(f"{m}_sum"), F.avg(m).alias(f"{m}_avg"))))
    return per.withColumn("share", F.col("ids") / F.sum("ids").over(Window.partitionBy("segment")))


def baseline_summary(df: DataFrame, bands: dict[str, tuple[str, tuple[float, ...]]], flags: list[str], measures: list[str]) -> DataFrame:
    """D6. By segment and banded columns: ids, ids with each interest flag and their share, sum, mean and range of measures."""
    out = df.withColumns({n: band_score(c, cuts) for n, (c, cuts) in bands.items()})
    has = [a for f in flags for a in (F.sum(f).alias(f"{f}_ids"), F.avg(f).alias(f"{f}_share"))]
    of = [a for m in measures for a in (F.sum(m).alias(f"{m}_sum"), F.avg(m).alias(f"{m}_avg"), F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max"))]
    return out.groupBy("segment", *bands).agg(F.count("*").alias("ids"), *has, *of)


def monthly_segment_activity(segments: DataFrame, recharges: DataFrame, kinds: list[str], activity: dict[str, DataFrame]) -> DataFrame:
    """D8. By segment and month: recharge totals of each kind, ids active in each table and their share of the active ones.

    segments: msisdn, segment. recharges: msisdn, month, kind, amount. activity: tables of msisdn, month.
    """
    of_kind = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("amount"))), F.lit(0)).alias(f"recharge_{i}") for i, k in enumerate(kinds)]
    per = recharges.groupBy("msisdn", "month").agg(*of_kind, F.sum("amount").alias("recharge"))
    for name, table in activity.items():
        per = per.join(table.select("msisdn", "month").distinct().withColumn(name, F.lit(1)), ["msisdn", "month"], "full")
    sums = [F.coalesce(F.sum(f"recharge_{i}"), F.lit(0)).alias(f"recharge_{i}") for i in range(len(kinds))]
    active = [a for n in activity for a in (F.count(n).alias(f"{n}_ids"), (F.count(n) / F.count("*")).alias(f"{n}_share"))]
    per_id = F.avg(F.coalesce("recharge", F.lit(0))).alias("recharge_avg")
    return per.join(segments, "msisdn").groupBy("segment", "month").agg(F.count("*").alias("ids"), *sums, per_id, *active)


def transforms(df: DataFrame, logs: list[str], rare: dict[str, int], lists: list[str], units: list[str]) -> DataFrame:
    """D9. log1p of columns, categories rarer than a count to ``other``, lists to their length, unit columns dropped."""
    out = df.withColumns({c: F.log1p(F.greatest(F.col(c).cast("double"), F.lit(0.0))) for c in logs} | {c: F.size(c) for c in lists})
    for c, least in rare.items():
        n = df.groupBy(c).agg(F.count("*").alias("_n")).withColumnRenamed(c, "_k")
        out = out.join(n, F.col(c).eqNullSafe(F.col("_k")), "left").withColumn(c, F.when(F.col("_n") >= least, F.col(c)).otherwise("other")).drop("_n", "_k")
    return out.drop(*units)


def _vector(columns: list[str], out: str = "features") -> list:
    return [Imputer(inputCols=columns, outputCols=[f"_{c}" for c in columns]), VectorAssembler(inputCols=[f"_{c}" for c in columns], outputCol=out, handleInvalid="keep")]


def fit_pca(df: DataFrame, columns: list[str], k: int) -> PipelineModel:
    """D10. Imputed, standardised, projected to k components."""
    return Pipeline(stages=[*_vector(columns, "raw"), StandardScaler(inputCol="raw", outputCol="scaled", withMean=True), PCA(k=k, inputCol="scaled", outputCol="components")]).fit(df)


def apply_pca(model: PipelineModel, df: DataFrame, keys: list[str], k: int) -> DataFrame:
    parts = vector_to_array("components")
    return model.transform(df).select(*keys, *(parts[i].alias(f"component_{i + 1}") for i in range(k)))


def component_correlations(scores: DataFrame, df: DataFrame, key: str, columns: list[str], k: int) -> DataFrame:
    """D10. feature, component, correlation."""
    joined = scores.join(df.select(key, *columns), key)
    wide = joined.agg(*(F.corr(c, f"component_{i + 1}").alias(f"{c}__{i + 1}") for c in columns for i in range(k)))
    rows = F.array(*(F.struct(F.lit(c).alias("feature"), F.lit(i + 1).alias("component"), F.col(f"{c}__{i + 1}").alias("correlation")) for c in columns for i in range(k)))
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def fit_kmeans(df: DataFrame, columns: list[str], k: int, seed: int = 7) -> PipelineModel:
    """D11."""
    return Pipeline(stages=[*_vector(columns, "raw"), StandardScaler(inputCol="raw", outputCol="features", withMean=True), KMeans(k=k, seed=seed, predictionCol="cluster")]).fit(df)


def kmeans_by_segment(df: DataFrame, columns: list[str], segments: list[str], k: int) -> DataFrame:
    """D11. One model per segment, results united and at rest, since profiles read them many times. So do the fits: df should be
    cheap to read (a written table)."""
    out = None
    for s in segments:
        rows = df.filter(F.col("segment") == s)
        part = fit_kmeans(rows, columns, k).transform(rows).select(*df.columns, "cluster")
        out = part if out is None else out.unionByName(part)
    return at_rest(out)


def cluster_profile(df: DataFrame, columns: list[str], by: str = "cluster") -> DataFrame:
    """D12. Size, and mean, median, 20th and 80th percentile of each column per cluster."""
    q = {"median": 0.5, "p20": 0.2, "p80": 0.8}
    out = df.groupBy(by).agg(F.count("*").alias("n"), *(F.avg(c).alias(f"{c}_mean") for c in columns))
    for c in columns:
        found = exact_percentiles(df, [by], c, tuple(q.values()))
        out = out.join(found.select(by, *(F.col("q")[k].alias(f"{c}_{n}") for k, n in enumerate(q))), by, "left")
    return out


def silhouettes(df: DataFrame, columns: list[str], ks: list[int]) -> DataFrame:
    """D13. k, silhouette, inertia."""
    rows = []
    for k in ks:
        model = fit_kmeans(df, columns, k)
        score = ClusteringEvaluator(predictionCol="cluster", featuresCol="features").evaluate(model.transform(df))
        rows.append((k, float(score), float(model.stages[-1].summary.trainingCost)))
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double, inertia double")


def pilot_features(df: DataFrame, group: str) -> DataFrame:
    """D14. Active and data-user flags, percentile of the score within a group, spend bin."""
    ranked = percent_rank(df, group, "score", "score_percentile")
    return ranked.withColumns({"is_active": (F.col("trx") > 0).cast("int"), "is_data_user": (F.col("data") > 0).cast("int"), "spend_bin": band_score("spend", (100_000, 300_000))})


def assign_pilot(df: DataFrame, group: str, top: int, random: int, bids: list[str], salt: int = 0) -> DataFrame:
    """D15. Per group the best ``top`` by score and ``random`` of the rest by hash, each with one of the bids.

    Both are limits on a row number, which Spark applies in every task first: no task sorts a whole group.
    """
    first = lambda rows, n, *order: rows.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("_r") <= n).drop("_r")
    best = first(df, top, F.col("score").desc(), "msisdn").withColumn("pilot", F.lit("top"))
    # The best are a few of each group; `top + random` by hash hold `random` that are not among them.
    drawn = first(df, top + random, hash_unit("msisdn", salt), "msisdn").join(best.select("msisdn", group), ["msisdn", group], "left_anti")
    rest = first(drawn, random, hash_unit("msisdn", salt), "msisdn").withColumn("pilot", F.lit("random"))
    bid = F.element_at(F.array(*map(F.lit, bids)), (F.floor(hash_unit("msisdn", salt + 1) * len(bids)) + 1).cast("int"))
    return best.unionByName(rest).withColumn("bid", bid)


def score_models(df: DataFrame, models: dict[str, PipelineModel], key: str = "msisdn") -> DataFrame:
    """D16. msisdn, campaign, score of every model."""
    out = None
    for name, model in models.items():
        part = model.transform(df).select(key, F.lit(name).alias("campaign"), vector_to_array("probability")[1].alias("score"))
        out = part if out is None else out.unionByName(part)
    return out


def score_correlations(scores: DataFrame, campaigns: list[str], key: str = "msisdn") -> DataFrame:
    """D17. Scores pivoted by campaign, then every pair's correlation."""
    wide = scores.groupBy(key).pivot("campaign", campaigns).agg(F.max("score"))
    pairs = [(a, b) for i, a in enumerate(campaigns) for b in campaigns[i:]]
    one = wide.agg(*(F.corr(F.col(f"`{a}`"), F.col(f"`{b}`")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)))
    rows = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("correlation")) for i, (a, b) in enumerate(pairs)))
    return one.select(F.explode(rows).alias("r")).select("r.*")


def best_campaign(scores: DataFrame, threshold: float) -> DataFrame:
    """D18. Each id's campaign of the highest score (ties to the smaller name), if above a threshold."""
    w = Window.partitionBy("msisdn").orderBy(F.col("score").desc(), "campaign")
    return scores.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n").filter(F.col("score") > threshold)


def uplift_curve(df: DataFrame, quantiles: int = 20) -> DataFrame:
    """D19. quantile, n, cumulative uplift and gain. df: score, treatment, outcome; the best scores come first.

    Quantile edges come from counts of values and the curve sums over quantiles, so rows are never sorted in one task.
    """
    edges = percentiles_of(df, "score", tuple(1 - k / quantiles for k in range(1, quantiles)))
    bucket = reduce(lambda a, b: a + b, ((F.col("score") < e).cast("int") for e in edges), F.lit(1))
    t, c = F.col("treatment") == 1, F.col("treatment") == 0
    per = df.groupBy(bucket.alias("quantile")).agg(F.count_if(t).alias("nt"), F.count_if(c).alias("nc"), F.sum(F.when(t, F.col("outcome")).otherwise(0)).alias("yt"), F.sum(F.when(c, F.col("outcome")).otherwise(0)).alias("yc"))
    run = Window.orderBy("quantile").rowsBetween(Window.unboundedPreceding, 0)  # over the quantiles, a few rows
    s = per.select("quantile", *(F.sum(k).over(run).alias(k) for k in ("nt", "nc", "yt", "yc")))
    uplift = F.coalesce(F.try_divide(F.col("yt").cast("double"), F.col("nt")), F.lit(0.0)) - F.coalesce(F.try_divide(F.col("yc").cast("double"), F.col("nc")), F.lit(0.0))
    return s.select("quantile", (F.col("nt") + F.col("nc")).alias("n"), uplift.alias("uplift"), (uplift * (F.col("nt") + F.col("nc"))).alias("gain"))


def area_under_uplift(curve: DataFrame) -> DataFrame:
    """D20. Trapezoids of gain over n, by the whole n."""
    w = Window.orderBy("quantile")
    step = (F.col("gain") + F.coalesce(F.lag("gain").over(w), F.lit(0.0))) / 2 * (F.col("n") - F.coalesce(F.lag("n").over(w), F.lit(0)))
    return curve.withColumn("area", step).agg(F.try_divide(F.sum("area"), F.max("n")).alias("auuc"))


def uplift_by_quantile(df: DataFrame, quantiles: int = 5) -> DataFrame:
    """D21. Treated minus control mean in bins of the treated rows' scores."""
    edges = percentiles_of(df.filter("treatment = 1"), "score", tuple(k / quantiles for k in range(1, quantiles)))
    bucket = reduce(lambda a, b: a + b, ((F.col("score") > e).cast("int") for e in edges), F.lit(1))
    mean = lambda k: F.avg(F.when(F.col("treatment") == k, F.col("outcome")))
    return df.groupBy(bucket.alias("quantile")).agg(F.count("*").alias("n"), (mean(1) - mean(0)).alias("uplift"))


def two_model_uplift(df: DataFrame, columns: list[str], key: str = "msisdn") -> DataFrame:
    """D22. Difference of two boosted-tree models' scores, of treated and control rows."""
    out = df.select(key)
    for k, name in ((1, "treated"), (0, "control")):
        model = Pipeline(stages=[*_vector(columns), GBTClassifier(labelCol="outcome", maxIter=5, maxDepth=3, seed=7)]).fit(df.filter(F.col("treatment") == k))
        out = out.join(model.transform(df).select(key, vector_to_array("probability")[1].alias(name)), key)
    return out.withColumn("uplift", F.col("treated") - F.col("control"))


def average_take_effect(df: DataFrame) -> DataFrame:
    """D22. Treated minus control mean outcome."""
    mean = lambda k: F.avg(F.when(F.col("treatment") == k, F.col("outcome")))
    return df.agg((mean(1) - mean(0)).alias("effect"))


def calibrate(scores: DataFrame, reference: DataFrame, quantiles: int = 10) -> DataFrame:
    """D22. Each score replaced by the reference mean of its quantile bin."""
    edges = percentiles_of(reference, "score", tuple(k / quantiles for k in range(1, quantiles)))
    bucket = reduce(lambda a, b: a + b, ((F.col("score") > e).cast("int") for e in edges), F.lit(1))
    means = reference.groupBy(bucket.alias("bin")).agg(F.avg("outcome").alias("calibrated"))
    return scores.withColumn("bin", bucket).join(means, "bin", "left")


def hash_fold(key: str, k: int, salt: int = 0) -> Column:
    """D28. Fold of an id; all rows of an id share it."""
    return F.floor(hash_unit(key, salt) * k).cast("int")


def train_propensity(df: DataFrame, columns: list[str], label: str, key: str) -> tuple[PipelineModel, float, list[tuple[str, float]]]:
    """D23. Forest on four fifths of the ids; AUC on the rest; importances."""
    fold = df.withColumn("_fold", hash_fold(key, 5))
    model = Pipeline(stages=[*_vector(columns), RandomForestClassifier(labelCol=label, numTrees=20, maxDepth=5, seed=7)]).fit(fold.filter("_fold > 0"))
    auc = BinaryClassificationEvaluator(labelCol=label).evaluate(model.transform(fold.filter("_fold = 0")))
    importance = list(zip(columns, model.stages[-1].featureImportances.toArray().tolist(), strict=True))
    return model, float(auc), sorted(importance, key=lambda x: (-x[1], x[0]))


def group_means(df: DataFrame, by: list[str], target: str) -> DataFrame:
    """D24. Number of rows and targets, mean target."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.count(target).alias("n_target"), F.avg(target).alias("mean_target"))


def survival_curve(df: DataFrame, group: str) -> DataFrame:
    """D25. Kaplan-Meier: group, day, at_risk, events, survival. df: group, day, event (1; 0 for censored)."""
    per = df.groupBy(group, "day").agg(F.count("*").alias("left"), F.sum("event").alias("events"))
    at_risk = F.sum("left").over(Window.partitionBy(group).orderBy("day").rowsBetween(0, Window.unboundedFollowing))
    rows = per.withColumn("at_risk", at_risk).withColumn("gone", F.col("events") == F.col("at_risk"))
    run = Window.partitionBy(group).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    log = F.sum(F.when(~F.col("gone"), F.log(1 - F.col("events") / F.col("at_risk")))).over(run)
    survival = F.when(F.max("gone").over(run), 0.0).otherwise(F.exp(F.coalesce(log, F.lit(0.0))))
    return rows.select(group, "day", "at_risk", "events", survival.alias("survival"))


def summarise_importance(folds: DataFrame, n: int) -> DataFrame:
    """D26. feature, mean, min, max, std over folds, total; the top n."""
    per = folds.groupBy("feature").agg(F.avg("importance").alias("mean"), F.min("importance").alias("min"), F.max("importance").alias("max"), F.stddev("importance").alias("std"), F.sum("importance").alias("total"))
    return per.orderBy(F.col("total").desc(), "feature").limit(n)


def outlet_sample(df: DataFrame, target: str, low: float, high: float, distances: list[str]) -> DataFrame:
    """D27. Rows with a target above zero and within two quantiles; missing distances are the column's greatest."""
    rows = df.filter(F.col(target) > 0)
    first, last = percentiles_of(rows, target, (low, high))
    q = rows.agg(F.count("*"), *(F.max(c).alias(c) for c in distances)).first()
    kept = rows.filter(F.col(target).between(first, last))
    return kept.fillna({c: q[c] for c in distances if q[c] is not None})


def sampled_outlets(df: DataFrame, target: str, low: float, high: float, distances: list[str], farthest: float, share: float, key: str = "outlet_id") -> DataFrame:
    """D27. key, columns, outcome: equal rows once; ``zero``, ``bottom`` and ``top`` for targets of 0 and beyond the quantiles of all
    rows, ``left out`` and ``sampled`` by a share of the others, chosen by hash. Missing distances are ``farthest``."""
    rows = df.dropDuplicates().fillna(dict.fromkeys(distances, farthest))
    first, last = percentiles_of(rows, target, (low, high))
    t = F.col(target)
    outcome = F.when(t == 0, "zero").when(t < first, "bottom").when(t > last, "top").when(hash_unit(key) < share, "sampled").otherwise("left out")
    return rows.withColumn("outcome", F.when(t.isNotNull(), outcome).otherwise("zero"))


def preprocessing(numeric: list[str], categories: list[str]) -> Pipeline:
    """D29. Imputed and robustly scaled numbers, indexed and encoded categories."""
    stages = [Imputer(inputCols=numeric, outputCols=[f"_{c}" for c in numeric]), VectorAssembler(inputCols=[f"_{c}" for c in numeric], outputCol="numbers"), RobustScaler(inputCol="numbers", outputCol="scaled")]
    stages += [StringIndexer(inputCols=categories, outputCols=[f"{c}_i" for c in categories], handleInvalid="keep"), OneHotEncoder(inputCols=[f"{c}_i" for c in categories], outputCols=[f"{c}_v" for c in categories])]
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=["scaled", *(f"{c}_v" for c in categories)], outputCol="features")])


def quantile_bins(df: DataFrame, target: str, n: int) -> DataFrame:
    """D29. Bin of the target by exact quantiles."""
    edges = percentiles_of(df, target, tuple(k / n for k in range(1, n)))
    splits = [-float("inf"), *sorted(set(edges)), float("inf")]
    return Bucketizer(splits=splits, inputCol=target, outputCol=f"{target}_bin").transform(df.withColumn(target, F.col(target).cast("double")))


def fit_forest(df: DataFrame, columns: list[str], label: str, trees: int = 10) -> PipelineModel:
    """D30. Regression forest that also tells each row's leaf in each tree."""
    return Pipeline(stages=[*_vector(columns), RandomForestRegressor(labelCol=label, numTrees=trees, maxDepth=5, seed=7, leafCol="leaves")]).fit(df)


def evaluate(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """D30. r2, rmse, mae, greatest error, relative squared error and its root, as two aggregations."""
    mean = df.agg(F.avg(label)).first()[0] or 0.0
    e = F.col(label) - F.col(prediction)
    rse = F.try_divide(F.sum(e * e), F.sum((F.col(label) - mean) * (F.col(label) - mean)))
    return df.agg((1 - rse).alias("r2"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), F.max(F.abs(e)).alias("max_error"), rse.alias("rse"), F.sqrt(rse).alias("rrse"))


def similar_counts(train: DataFrame, rows: DataFrame, key: str, value: str) -> DataFrame:
    """D31. leaves, value, n: the targets of training rows that share a leaf with rows of these leaves in any tree, and how often each occurs.

    train, rows: key, leaves (array); train also value. Rows of equal leaves are one class; classes are joined with the
    counted targets of training classes on (tree, leaf), each pair in the first tree where it agrees, and counted.
    """
    at = lambda df, name: df.select("*", F.posexplode(name).alias("tree", "leaf"))
    classes = at(rows.select("leaves").distinct(), "leaves")
    targets = at(train.groupBy(F.col("leaves").alias("_leaves"), value).agg(F.countDistinct(key).alias("n")), "_leaves")
    agree = F.array_position(F.zip_with("leaves", "_leaves", lambda a, b: a == b), True)
    pairs = classes.join(targets, ["tree", "leaf"]).filter(agree == F.col("tree") + 1)
    return pairs.groupBy("leaves", value).agg(F.sum("n").alias("n"))


def below_top(counts: DataFrame, value: str, drop_share: float = 0.05) -> DataFrame:
    """D31. leaves, value, n, upto (rows up to the value), all: the counts without those above the interpolated percentile 1 - drop_share."""
    of = Window.partitionBy("leaves")
    placed = counts.withColumns({"upto": F.sum("n").over(of.orderBy(value)), "all": F.sum("n").over(of), "next": F.lead(value).over(of.orderBy(value))})
    rank = (1 - drop_share) * (F.col("all") - 1)
    low = (F.col("upto") > F.floor(rank)) & (F.col("upto") - F.col("n") <= F.floor(rank))
    # The percentile lies at this value, or between it and the next one.
    limit = F.when(F.col("upto") > F.ceil(rank), F.col(value).cast("double")).otherwise(F.col(value) * (F.ceil(rank) - rank) + F.col("next") * (rank - F.floor(rank)))
    kept = placed.withColumn("_limit", F.max(F.when(low, limit)).over(of)).filter(F.col(value) <= F.col("_limit"))
    return kept.withColumn("all", F.sum("n").over(of)).select("leaves", value, "n", "upto", "all")


def similar_rows(train: DataFrame, rows: DataFrame, key: str, value: str, drop_share: float = 0.05) -> DataFrame:
    """D31. key, values: a row's similar targets as an array, for few rows to be shown; the counts are ``below_top``'s."""
    each = F.array_sort(F.flatten(F.collect_list(F.array_repeat(F.col(value), F.col("n").cast("int")))))
    lists = below_top(similar_counts(train, rows, key, value), value, drop_share).groupBy("leaves").agg(each.alias("values"))
    return rows.join(lists, "leaves").select(key, "values")


def performance_of_classes(counts: DataFrame, own: DataFrame, key: str, value: str) -> DataFrame:
    """D32. As performance_percentile, from the counts of ``below_top``. own: key, leaves, value.

    Own values are placed among their class's in one ordered pass over the union of both. At a share of the similar
    values and the own one together lies the own value, or the similar value at that rank or at the rank before.
    """
    rows = counts.select("leaves", value, "n", F.lit(None).cast(own.schema[key].dataType).alias(key)).unionByName(own.select("leaves", value, F.lit(0).cast("long").alias("n"), key))
    before = Window.partitionBy("leaves").orderBy(value).rangeBetween(Window.unboundedPreceding, -1)
    shares = {"p90": 0.9, "p95": 0.95, "p100": 1.0}
    rank = {p: F.greatest(F.lit(1), F.ceil((F.col("all") + 1) * s)) for p, s in shares.items()}
    upto = lambda r: (F.col("upto") >= r) & (F.col("upto") - F.col("n") < r)
    marks = counts.groupBy("leaves").agg(F.first("all").alias("all"), *(m for p, r in rank.items() for m in (F.max(F.when(upto(r), F.col(value))).alias(f"_{p}"), F.max(F.when(upto(r - 1), F.col(value))).alias(f"_{p}_before"))))
    placed = rows.withColumn("below", F.coalesce(F.sum("n").over(before), F.lit(0))).filter(F.col(key).isNotNull()).join(marks, "leaves")
    # The own value moves those above it one rank on; greatest() passes over nulls.
    at = lambda p: F.when(F.col(f"_{p}") <= F.col(value), F.col(f"_{p}")).otherwise(F.greatest(value, f"_{p}_before"))
    return placed.select(key, (100.0 * F.col("below") / (F.col("all") + 1)).alias("percentile"), *(at(p).alias(p) for p in shares))


def performance_percentile(similar: DataFrame, own: DataFrame, key: str, value: str) -> DataFrame:
    """D32. Percent of similar values (and the own one) below the own, and the 90th, 95th and 100th percentile from below; for few rows to be shown."""
    j = similar.join(own.select(key, value), key).withColumn("all", F.array_sort(F.concat("values", F.array(F.col(value)))))
    below = F.size(F.filter("all", lambda x: x < F.col(value)))
    at = lambda p: F.element_at("all", F.greatest(F.lit(1), F.ceil(F.size("all") * p).cast("int")))
    return j.select(key, (100.0 * below / F.size("all")).alias("percentile"), at(0.9).alias("p90"), at(0.95).alias("p95"), at(1.0).alias("p100"))


def dashboard_points(percentiles: DataFrame, key: str) -> DataFrame:
    """D33. Rounded percentiles as rows of key, point, value."""
    cols = [c for c in percentiles.columns if c != key]
    return percentiles.select(key, *(F.round(F.col(c).cast("double"), 2).alias(c) for c in cols)).unpivot([key], cols, "point", "value")


def grid_search(df: DataFrame, columns: list[str], label: str, depths: list[int], folds: int = 3):
    """D34. Cross-validated forest over depths; returns the fitted model."""
    forest = RandomForestClassifier(labelCol=label, numTrees=10, seed=7)
    grid = ParamGridBuilder().addGrid(forest.maxDepth, depths).build()
    return CrossValidator(estimator=Pipeline(stages=[*_vector(columns), forest]), estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(labelCol=label), numFolds=folds, seed=7).fit(df)


def cross_fold_scores(df: DataFrame, columns: list[str], label: str, key: str, k: int = 3) -> DataFrame:
    """D36. Out-of-fold scores: every row is scored by a model that did not see its id."""
    fold = df.withColumn("fold", hash_fold(key, k))
    out = None
    for i in range(k):
        model = Pipeline(stages=[*_vector(columns), GBTClassifier(labelCol=label, maxIter=5, maxDepth=3, seed=7)]).fit(fold.filter(F.col("fold") != i))
        part = model.transform(fold.filter(F.col("fold") == i)).select(*df.columns, "fold", vector_to_array("probability")[1].alias("score"))
        out = part if out is None else out.unionByName(part)
    return out
