"""Evaluation of models by repeated stratified splits: exact shares, uplift curves and bins of every repeat, ROC and AUC.

All repeats are one key of the rows, so each figure of all repeats is one grouped aggregation. No group is sorted or held
in one task: quantile edges come from counts of values, ROC curves from running totals over ranges of distinct scores.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.functions.quantiles import exact_percentiles, percentiles_of
from tidewheel.functions.ranks import running_totals
from tidewheel.sources.io import at_rest, broadcast_if_counted


def stratified_repeats(df: DataFrame, key: str, strata: list[str], share: float, repeats: int) -> DataFrame:
    """D36. Every row once for each repeat, with ``repeat`` (from 0) and ``train``.

    In each repeat and stratum the rows of the smallest md5 of key and repeat, ties to the smaller key, are the training
    rows: exactly floor(share * rows + 0.5) of them. Rows are counted in 4096 buckets of the hash, which settles all
    buckets but one of each stratum; only that one's rows are numbered.
    """
    of = F.struct(*(F.col(c) for c in strata))
    each = df.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    hashed = each.withColumn("_h", F.md5(F.concat(F.col(key).cast("string"), F.lit("#"), F.col("repeat").cast("string")).cast("binary")))
    rows = hashed.withColumns({"_b": F.substring("_h", 1, 3), "_s": of})
    counts = rows.groupBy("repeat", "_s", "_b").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy("repeat", "_s")
    upto = counts.withColumns({"_upto": F.sum("_n").over(whole.orderBy("_b")), "_want": F.floor(F.sum("_n").over(whole) * share + 0.5)})
    # The bucket in which the share is reached, and how many of its rows are still wanted.
    edge = upto.filter("_upto >= _want").groupBy("repeat", "_s").agg(F.min(F.struct("_b", (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_more"))).alias("_e"))
    edges = broadcast_if_counted(at_rest(edge.select(F.col("repeat").alias("_r"), F.col("_s").alias("_of"), "_e._b", "_e._more").withColumnRenamed("_b", "_edge")))
    met = rows.join(edges, (F.col("repeat") == F.col("_r")) & F.col("_s").eqNullSafe(F.col("_of")))
    own = F.row_number().over(Window.partitionBy("repeat", "_s").orderBy("_h", key))
    settled = met.filter("_b <> _edge").withColumn("train", F.col("_b") < F.col("_edge"))
    numbered = met.filter("_b = _edge").withColumn("train", own <= F.col("_more"))
    return settled.unionByName(numbered).select(*df.columns, "repeat", "train")


def _bucketed(df: DataFrame, edges: DataFrame, by: list[str], bucket: Column) -> DataFrame:
    """df with its group's edges in _q and the bucket made of them."""
    return df.join(broadcast_if_counted(at_rest(edges)), by).withColumn("quantile", bucket)


def uplift_curves(df: DataFrame, by: list[str], quantiles: int = 20) -> DataFrame:
    """D19, D36. by, quantile, n, cumulative uplift and gain of each group. df: by, score, treatment, outcome; best scores first."""
    edges = exact_percentiles(df, by, "score", tuple(1 - k / quantiles for k in range(1, quantiles))).withColumnRenamed("q", "_q")
    rows = _bucketed(df, edges, by, 1 + F.size(F.filter("_q", lambda e: F.col("score") < e)))
    t, c = F.col("treatment") == 1, F.col("treatment") == 0
    sums = {"nt": F.count_if(t), "nc": F.count_if(c), "yt": F.sum(F.when(t, F.col("outcome")).otherwise(0)), "yc": F.sum(F.when(c, F.col("outcome")).otherwise(0))}
    per = rows.groupBy(*by, "quantile").agg(*(v.alias(k) for k, v in sums.items()))
    run = Window.partitionBy(*by).orderBy("quantile").rowsBetween(Window.unboundedPreceding, 0)  # a row for each quantile
    s = per.select(*by, "quantile", *(F.sum(k).over(run).alias(k) for k in sums))
    mean = lambda y, n: F.coalesce(F.try_divide(F.col(y).cast("double"), F.col(n)), F.lit(0.0))
    n, uplift = F.col("nt") + F.col("nc"), mean("yt", "nt") - mean("yc", "nc")
    return s.select(*by, "quantile", n.alias("n"), uplift.alias("uplift"), (uplift * n).alias("gain"))


def uplift_areas(curves: DataFrame, by: list[str]) -> DataFrame:
    """D20, D36. by, auuc: trapezoids of gain over n, by the whole n."""
    w = Window.partitionBy(*by).orderBy("quantile")
    step = (F.col("gain") + F.coalesce(F.lag("gain").over(w), F.lit(0.0))) / 2 * (F.col("n") - F.coalesce(F.lag("n").over(w), F.lit(0)))
    return curves.withColumn("_area", step).groupBy(*by).agg(F.try_divide(F.sum("_area"), F.max("n")).alias("auuc"))


def curve_summary(curves: DataFrame) -> DataFrame:
    """D36. quantile, and mean, median, least and greatest uplift and gain over the repeats."""
    of = lambda c: (F.avg(c).alias(f"{c}_mean"), F.median(c).alias(f"{c}_median"), F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"))
    return curves.groupBy("quantile").agg(*of("uplift"), *of("gain"))


def uplift_bins(df: DataFrame, by: list[str], quantiles: int = 5) -> DataFrame:
    """D21, D36. by, quantile, n, uplift (treated minus control mean, 0 for a side without rows).

    The bins are the same for all groups: quantiles of the treated rows' scores of all of them together, equal edges once.
    """
    edges = sorted(set(percentiles_of(df.filter("treatment = 1"), "score", tuple(k / quantiles for k in range(1, quantiles)))))
    rows = df.withColumn("quantile", reduce(lambda a, b: a + b, ((F.col("score") > e).cast("int") for e in edges), F.lit(1)))
    mean = lambda k: F.coalesce(F.avg(F.when(F.col("treatment") == k, F.col("outcome"))), F.lit(0.0))
    return rows.groupBy(*by, "quantile").agg(F.count("*").alias("n"), (mean(1) - mean(0)).alias("uplift"))


def roc_points(df: DataFrame, by: list[str], score: str = "score", label: str = "label") -> DataFrame:
    """D23. by, score, positives and negatives at or above it, fpr and tpr: a point for each distinct score.

    Rows are counted by score; the counts, not the rows, get running totals. Null scores and labels take no part; a rate
    without rows is null.
    """
    fine = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    counted = fine.groupBy(*by, F.col(score).cast("double").alias("score")).agg(F.count_if(F.col(label) > 0).alias("pos"), F.count_if(F.col(label) <= 0).alias("neg"))
    upto = running_totals(counted, by, [F.col("score").desc()], ["pos", "neg"])
    total = broadcast_if_counted(at_rest(upto.groupBy(*(F.col(c).alias(f"_{c}_of") for c in by)).agg(F.max("upto_pos").alias("_pos"), F.max("upto_neg").alias("_neg"))))
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}_of"))
    rate = lambda n, of: F.try_divide(F.col(n).cast("double"), F.col(of))
    return upto.join(total, on).select(*by, "score", "pos", "neg", F.col("upto_pos").alias("positives"), F.col("upto_neg").alias("negatives"), rate("upto_neg", "_neg").alias("fpr"), rate("upto_pos", "_pos").alias("tpr"))


def roc_areas(points: DataFrame, by: list[str]) -> DataFrame:
    """D23. by, positives, negatives, auc: the chance that a positive row scores above a negative one, ties counting a half.

    In whole numbers up to the last division, so it is exact; null without rows of both kinds.
    """
    twice = F.col("neg").cast("decimal(19,0)") * (2 * (F.col("positives") - F.col("pos")) + F.col("pos")).cast("decimal(19,0)")
    per = points.groupBy(*by).agg(F.sum(twice).alias("_twice"), F.max("positives").alias("positives"), F.max("negatives").alias("negatives"))
    auc = F.try_divide(F.col("_twice").cast("double"), 2.0 * F.col("positives") * F.col("negatives"))
    return per.select(*by, "positives", "negatives", auc.alias("auc"))


def weighted_auc(df: DataFrame, probabilities: list[str], label: str) -> DataFrame:
    """D30. One row, auc_weighted: each class against the rest, by its share of the rows. probabilities: a column for each class from 0."""
    each = F.array(*(F.struct(F.lit(k).alias("class"), F.col(c).alias("score"), (F.col(label) == k).cast("int").alias("label")) for k, c in enumerate(probabilities)))
    areas = roc_areas(roc_points(df.select(F.explode(each).alias("x")).select("x.*"), ["class"]), ["class"])
    return areas.agg(F.try_divide(F.sum(F.col("auc") * F.col("positives")), F.sum("positives").cast("double")).alias("auc_weighted"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """D30. actual, predicted, n and share of all rows."""
    per = df.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(F.count("*").alias("n"))
    return per.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def learner(kind: str, label: str, seed: int, rounds: int = 5, depth: int = 3):
    """D23. A forest or boosted trees."""
    made = {"forest": lambda: RandomForestClassifier(labelCol=label, numTrees=20, maxDepth=5, seed=seed), "boosted": lambda: GBTClassifier(labelCol=label, maxIter=rounds, maxDepth=depth, seed=seed)}
    return made[kind]()


def fit(df: DataFrame, columns: list[str], label: str, kind: str = "boosted", seed: int = 7) -> tuple[PipelineModel, list[tuple[str, float]]]:
    """The model and the importance of each column."""
    vector = VectorAssembler(inputCols=columns, outputCol="_features", handleInvalid="keep")
    model = Pipeline(stages=[vector, learner(kind, label, seed).setFeaturesCol("_features")]).fit(df)
    return model, list(zip(columns, model.stages[-1].featureImportances.toArray().tolist(), strict=True))


def probability(model: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    out = model.transform(df).withColumn(name, vector_to_array("probability")[1])
    return out.select(*df.columns, name)


def importance_summary(importances: DataFrame) -> DataFrame:
    """D26, D36. feature, and median, mean, standard deviation, least and greatest importance over repeats."""
    return importances.groupBy("feature").agg(F.median("importance").alias("median"), F.avg("importance").alias("mean"), F.stddev("importance").alias("std"), F.min("importance").alias("min"), F.max("importance").alias("max"))


def most_important(summary: DataFrame, n: int) -> list[str]:
    """The n features of the greatest median importance, ties to the smaller name."""
    return [r.feature for r in summary.orderBy(F.col("median").desc(), "feature").limit(n).collect()]


def repeated_uplift(df: DataFrame, columns: list[str], key: str, strata: list[str], share: float, repeats: int, kind: str = "boosted") -> tuple[DataFrame, DataFrame]:
    """D36. The test rows of every repeat with score, and the importances (repeat, feature, importance).

    df: key, columns, treatment, outcome, strata. In each repeat one model is fitted to the treated and one to the
    control training rows; the score is the difference of their probabilities.
    """
    split = at_rest(stratified_repeats(df, key, strata, share, repeats))
    scored, rows = None, []
    for r in range(repeats):
        train, test = split.filter((F.col("repeat") == r) & F.col("train")), split.filter((F.col("repeat") == r) & ~F.col("train"))
        for k, name in ((1, "treated"), (0, "control")):
            model, importance = fit(train.filter(F.col("treatment") == k), columns, "outcome", kind, seed=r)
            test = probability(model, test, name)
            rows += [(r, c, name, v) for c, v in importance]
        test = test.withColumn("score", F.col("treated") - F.col("control")).drop("treated", "control", "train")
        scored = test if scored is None else scored.unionByName(test)
    # Repeats times columns rows.
    importances = df.sparkSession.createDataFrame(rows, "repeat int, feature string, model string, importance double")
    return at_rest(scored), importances.groupBy("repeat", "feature").agg(F.avg("importance").alias("importance"))


def selected_uplift(df: DataFrame, columns: list[str], key: str, strata: list[str], share: float, repeats: int, n_features: int, kind: str = "boosted") -> tuple[list[str], DataFrame, DataFrame]:
    """D36. The features of the greatest median importance over repeats with all columns; then the scored test rows and the
    importances of repeats with these features alone."""
    _, importances = repeated_uplift(df, columns, key, strata, share, repeats, kind)
    chosen = most_important(importance_summary(importances), n_features)
    return chosen, *repeated_uplift(df, chosen, key, strata, share, repeats, kind)


def comparability(df: DataFrame, columns: list[str], group: str, key: str, strata: list[str], share: float = 0.75, repeats: int = 3, kind: str = "boosted") -> tuple[DataFrame, DataFrame]:
    """D35. repeat, auc of telling two groups apart on the test rows of stratified splits, near 0.5 if they are alike; and the importances."""
    split = at_rest(stratified_repeats(df, key, strata, share, repeats))
    scored, rows = None, []
    for r in range(repeats):
        model, importance = fit(split.filter((F.col("repeat") == r) & F.col("train")), columns, group, kind, seed=r)
        rows += [(r, c, v) for c, v in importance]
        part = probability(model, split.filter((F.col("repeat") == r) & ~F.col("train")), "score").select("repeat", "score", F.col(group).alias("label"))
        scored = part if scored is None else scored.unionByName(part)
    areas = roc_areas(roc_points(at_rest(scored), ["repeat"]), ["repeat"]).select("repeat", "auc")
    return areas, df.sparkSession.createDataFrame(rows, "repeat int, feature string, importance double")
