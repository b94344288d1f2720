"""Data quality: metrics per week and column in long form, scores, profiles. One aggregation per table, then unpivot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions.frames import percentiles_over_window
from tidewheel.functions.quantiles import exact_percentiles, fit_a_buffer
from tidewheel.functions.relational import columns_of_type

PERCENTILES = (0.25, 0.5, 0.75)


def measured(df: DataFrame) -> DataFrame:
    """Array columns as their lengths."""
    arrays = columns_of_type(df, "array")
    return df.withColumns({c: F.size(c) for c in arrays}) if arrays else df


def long_metrics(df: DataFrame, by: list[str], columns: list[str], metrics: dict[str, callable], quartiles: dict[str, float] | None = None) -> DataFrame:
    """Q1, Q5. by, column and a column per metric and percentile: one wide aggregation, one struct per column, exploded."""
    of = quartiles or {}
    percentiles = [F.percentile(c, list(of.values())).alias(f"{c}__q") for c in columns] if of else []
    wide = df.groupBy(*by).agg(*(m(F.col(c)).cast("double").alias(f"{c}__{n}") for c in columns for n, m in metrics.items()), *percentiles)
    rows = F.array(*(F.struct(F.lit(c).alias("column"), *(F.col(f"{c}__{n}").alias(n) for n in metrics), *(F.col(f"{c}__q")[i].alias(n) for i, n in enumerate(of))) for c in columns))
    return wide.select(*by, F.explode(rows).alias("r")).select(*by, "r.*")


def accuracy_completeness(df: DataFrame, columns: list[str], by: list[str] = ("weekstart",)) -> DataFrame:
    """Q1. Per week and column: max, min, mean (four places), percent null and negative, quartiles."""
    metrics = {
        "max": F.max,
        "min": F.min,
        "mean": lambda c: F.round(F.avg(c), 4),
        "null_percent": lambda c: F.avg(c.isNull().cast("double")) * 100,
        "negative_percent": lambda c: F.avg(F.coalesce(c < 0, F.lit(False)).cast("double")) * 100,
    }
    rows = measured(df)
    names = [f"percentile_{p}".replace("0.", "") for p in PERCENTILES]
    if fit_a_buffer(rows, list(by), columns):
        return long_metrics(rows, list(by), columns, metrics, dict(zip(names, PERCENTILES, strict=True)))
    out = long_metrics(rows, list(by), columns, metrics)
    quartiles = exact_percentiles(long_values(rows, list(by), columns), [*by, "column"], "value", PERCENTILES)
    named = quartiles.select(*by, "column", *(F.col("q")[k].alias(n) for k, n in enumerate(names)))
    return out.join(named, [*by, "column"], "left")


def long_values(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """by, column, value."""
    rows = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns))
    return df.select(*by, F.explode(rows).alias("r")).select(*by, "r.*")


def tukey_outliers(df: DataFrame, columns: list[str], by: str = "weekstart") -> DataFrame:
    """Q2. Values beyond 1.5 interquartile ranges of the week's quartiles."""
    long = long_values(df, [by], columns)
    q = exact_percentiles(long, [by, "column"], "value", (0.25, 0.75)).select(by, "column", F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    joined = long.join(q, [by, "column"])
    return joined.groupBy(by, "column").agg(F.count_if(F.col("value") < F.col("q1") - 1.5 * iqr).alias("below"), F.count_if(F.col("value") > F.col("q3") + 1.5 * iqr).alias("above"))


def consistency(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str], by: str = "weekstart") -> DataFrame:
    """Q3. Percent of equal (or both null) values of rows in both tables, per week and column."""
    n = new.select(*keys, *(F.col(c).alias(f"{c}__new") for c in columns))
    same = old.join(n, keys).select(*keys, *(F.col(c).eqNullSafe(F.col(f"{c}__new")).cast("double").alias(c) for c in columns))
    return long_metrics(same, [by], columns, {"same_percent": lambda c: F.avg(c) * 100})


def monthly_unique_ids(df: DataFrame, key: str = "msisdn") -> DataFrame:
    """Q4."""
    return df.groupBy(F.trunc("weekstart", "month").alias("month")).agg(F.countDistinct(key).alias("ids"))


def melt_metrics(wide: DataFrame, by: list[str]) -> DataFrame:
    """Q5. Columns named column__metric to rows of by, column, metric, value."""
    cols = [c for c in wide.columns if "__" in c]
    long = wide.unpivot(by, cols, "name", "value")
    return long.select(*by, F.substring_index("name", "__", 1).alias("column"), F.substring_index("name", "__", -1).alias("metric"), "value")


def sampled_metrics(df: DataFrame, ids: DataFrame, columns: list[str], table: str, run: str) -> DataFrame:
    """Q6. Q1 over sampled ids, with the table's name and the run's."""
    return accuracy_completeness(df.join(ids.select("msisdn").distinct(), "msisdn", "left_semi"), columns).withColumns({"table": F.lit(table), "run": F.lit(run)})


def threshold_score(metrics: DataFrame, days: int, by: list[str] = ("table", "column", "metric"), step: int = 1) -> DataFrame:
    """Q7. 100 where a value lies within 1.5 interquartile ranges of the quartiles of the last days, else 0. step: days between runs."""
    rows = percentiles_over_window(metrics, {"q1": ("value", days, 0.25), "q3": ("value", days, 0.75)}, list(by), "run_date", step)
    iqr = F.col("q3") - F.col("q1")
    return rows.withColumn("score", F.when(F.col("value").between(F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr), 100).otherwise(0)).drop("q1", "q3")


def domain_scores(scores: DataFrame, domains: dict[str, str], dimensions: dict[str, str]) -> DataFrame:
    """Q8. Mean score by domain (from the column's prefix) and dimension (from the metric)."""
    label = lambda column, known: F.coalesce(*(F.when(F.col(column).startswith(k), v) for k, v in known.items()), F.lit("other"))
    named = scores.withColumns({"domain": label("column", domains), "dimension": label("metric", dimensions)})
    return named.groupBy("domain", "dimension").agg(F.avg("score").alias("score"), F.count("*").alias("n"))


def layer_scores(scores: DataFrame, layers: dict[str, str], domains: dict[str, str], dimensions: dict[str, str]) -> DataFrame:
    """Q8. Mean score by layer (from the table's prefix), domain and dimension, of the latest run of each table."""
    label = lambda column, known: F.coalesce(*(F.when(F.col(column).startswith(k), v) for k, v in known.items()), F.lit("other"))
    newest = scores.groupBy("table").agg(F.max("run_date").alias("run_date"))
    named = scores.join(newest, ["table", "run_date"]).withColumns({"layer": label("table", layers), "domain": label("column", domains), "dimension": label("metric", dimensions)})
    return named.groupBy("layer", "domain", "dimension").agg(F.avg("score").alias("score"), F.count("*").alias("n"))


def availability(arrivals: DataFrame, first: str, last: str) -> DataFrame:
    """Q9. Per table: dates missing between two dates, how many, and the share that is there in percent. arrivals: table, event_date."""
    span = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    have = arrivals.groupBy("table").agg(F.collect_set("event_date").alias("have"))
    missing = have.withColumn("missing", F.array_sort(F.array_except(span, "have")))
    return missing.select("table", "missing", F.size("missing").alias("n_missing"), (100.0 * (F.size(span) - F.size("missing")) / F.size(span)).alias("score"))


def timeliness(deliveries: DataFrame, sla_days: int) -> DataFrame:
    """Q10. deliveries: table, event_date, delivered (timestamp). Delay in hours after date + SLA, 0 at least, and score of a week's 168 hours."""
    hours = (F.unix_timestamp("delivered") - F.unix_timestamp(F.date_add("event_date", sla_days).cast("timestamp"))) / 3600
    latest = deliveries.groupBy("table", "event_date").agg(F.max("delivered").alias("delivered")).withColumn("delay_hours", F.greatest(hours, F.lit(0.0)))
    return latest.withColumn("score", F.greatest(F.lit(0.0), 100 * (168 - F.col("delay_hours")) / 168))


def file_deliveries(spark, path: str, name: str, partition: str = "event_date") -> DataFrame:
    """Q10. Deliveries of a partitioned table from its files' modification times."""
    t = spark.read.parquet(path).select(F.col(partition).alias("event_date"), F.col("_metadata.file_modification_time").alias("delivered"))
    return t.groupBy("event_date").agg(F.max("delivered").alias("delivered")).withColumn("table", F.lit(name))


def _blank(df: DataFrame, c: str) -> Column:
    return F.col(c).isNull() | (F.trim(c) == "") if c in columns_of_type(df, "string") else F.col(c).isNull()


def _number(df: DataFrame, c: str) -> Column:
    return F.col(c).cast("double") if c in columns_of_type(df, "numeric") else F.lit(None).cast("double")


def table_profile(df: DataFrame) -> DataFrame:
    """Q11. Per column: rows, distinct values, sum, mean, max, min (numeric columns), missing (null or blank) and its percent.

    Distinct values are counted column by column: each count reads its column only, keeps different values before the
    shuffle, and never sees the rows once for every column. All else is one aggregation.
    """
    cols = df.columns
    wide = df.agg(F.count("*").alias("n"), *(a for c in cols for a in (F.sum(_number(df, c)).alias(f"{c}__sum"), F.avg(_number(df, c)).alias(f"{c}__mean"), F.max(_number(df, c)).alias(f"{c}__max"), F.min(_number(df, c)).alias(f"{c}__min"), F.count_if(_blank(df, c)).alias(f"{c}__missing"))))
    names = ("sum", "mean", "max", "min", "missing")
    rows = F.array(*(F.struct(F.lit(c).alias("column"), *(F.col(f"{c}__{n}").alias(n) for n in names)) for c in cols))
    distinct = reduce(DataFrame.union, (df.agg(F.countDistinct(c).alias("distinct")).select(F.lit(c).alias("column"), "distinct") for c in cols))
    out = wide.select("n", F.explode(rows).alias("r")).select("n", "r.*").join(distinct, "column")  # a row for each column
    return out.select("n", "column", "distinct", *names, F.try_divide(F.col("missing") * 100.0, F.col("n")).alias("missing_percent"))


SKETCH_BITS = 12


def day_profiles(df: DataFrame, day: str) -> DataFrame:
    """Q11, Q4. day, column, n, missing, sum, max, min and a sketch of the different values: a row for each day and column.

    One aggregation for all columns. Rows of this table are kept and merged over any days, so no day is read twice.
    """
    cols = [c for c in df.columns if c != day]
    measures = {"missing": lambda c: F.count_if(_blank(df, c)), "sum": lambda c: F.sum(_number(df, c)), "max": lambda c: F.max(_number(df, c)), "min": lambda c: F.min(_number(df, c)), "sketch": lambda c: F.hll_sketch_agg(F.col(c).cast("string"), SKETCH_BITS)}
    wide = df.groupBy(F.col(day).alias("day")).agg(F.count("*").alias("n"), *(m(c).alias(f"{c}__{k}") for c in cols for k, m in measures.items()))
    rows = F.array(*(F.struct(F.lit(c).alias("column"), *(F.col(f"{c}__{k}").alias(k) for k in measures)) for c in cols))
    return wide.select("day", "n", F.explode(rows).alias("r")).select("day", "n", "r.*")


def merged_profiles(days: DataFrame, by: list[str] = ()) -> DataFrame:
    """Q11, Q4. by, column, n, missing, sum, mean, max, min and about how many different values: exact but for the last, which
    is within some two percent, and exact for few values."""
    out = days.groupBy(*by, "column").agg(F.sum("n").alias("n"), F.sum("missing").alias("missing"), F.sum("sum").alias("sum"), F.max("max").alias("max"), F.min("min").alias("min"), F.hll_union_agg("sketch").alias("_s"), F.sum(F.when(F.col("sum").isNotNull(), F.col("n") - F.col("missing"))).alias("_numbers"))
    return out.select(*by, "column", "n", "missing", "sum", F.try_divide("sum", F.col("_numbers").cast("double")).alias("mean"), "max", "min", F.hll_sketch_estimate("_s").alias("about"))


def special_shares(df: DataFrame, columns: list[str], by: str = "weekstart") -> DataFrame:
    """Q12. Share of nulls, zeros and -1 per week and column."""
    share = lambda test: lambda c: F.avg(F.coalesce(test(c), F.lit(False)).cast("double"))
    return long_metrics(df, [by], columns, {"null_share": share(lambda c: c.isNull()), "zero_share": share(lambda c: c == 0), "minus_one_share": share(lambda c: c == -1)})


def columns_above(shares: DataFrame, metric: str, limit: float) -> DataFrame:
    """Q12. Columns whose mean share over weeks exceeds a limit."""
    return shares.groupBy("column").agg(F.avg(metric).alias("mean")).filter(F.col("mean") > limit)


def dataset_checks(df: DataFrame, key: str, flag: str, flags: list, rows: tuple[int, int]) -> DataFrame:
    """Q13. One row of booleans."""
    return df.agg((F.count_if(~F.col(flag).isin(flags) | F.col(flag).isNull()) == 0).alias("flags_known"), (F.count("*") == F.countDistinct(key)).alias("ids_unique"), F.count("*").between(*rows).alias("rows_in_range"))


def score_consistency(scores: DataFrame, by: Column | str) -> DataFrame:
    """Q14."""
    return scores.groupBy(by).agg(F.count("*").alias("n"), F.countDistinct("msisdn").alias("ids"), F.min("score").alias("min"), F.avg("score").alias("avg"), F.stddev("score").alias("stddev"), F.max("score").alias("max"))


def columns_below(shares: DataFrame, metric: str, limit: float) -> DataFrame:
    """Q12. Columns whose median share over weeks is under a limit."""
    median = exact_percentiles(shares, ["column"], metric, (0.5,)).select("column", F.col("q")[0].alias("median"))
    return median.filter(F.col("median") < limit)
