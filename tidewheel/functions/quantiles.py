"""Exact percentiles and ranks of groups of any size: no task holds or sorts all values of a group."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.sources.io import at_rest, broadcast_if_counted

#: Of the sketches: brackets of the percentiles are some few ten-thousandths of a group.
ACCURACY = 10_000
#: A group of at most about so many different values fits the buffer of the built-in exact percentile.
DISTINCT = 16_384
BUCKETS = 64


def fit_a_buffer(df: DataFrame, by: list[str], columns: list[str]) -> bool:
    """Whether, in every group, each of the columns has few enough different values for the built-in exact percentile."""
    rows = df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
    if rows <= DISTINCT:
        return True
    each = df.groupBy(*by).agg(*(F.approx_count_distinct(c).alias(f"_d{i}") for i, c in enumerate(columns)))
    most = each.agg(F.greatest(*(F.max(f"_d{i}") for i in range(len(columns))), F.lit(0), F.lit(0))).first()[0]
    return most <= DISTINCT


def exact_percentiles(df: DataFrame, by: list[str], value: str, ps: tuple[float, ...]) -> DataFrame:
    """by, q: the interpolated percentiles ``ps`` of a numeric column, nulls left out; groups without values are absent.

    Groups of few different values take the built-in percentile. For others a sketch gives each percentile a bracket of
    values that is sure to hold it, and one aggregation counts the values outside the brackets by where they lie and the
    values inside one by one.
    """
    keys = [*by] or ["_all"]
    v = df.select(*(by or [F.lit(0).alias("_all")]), F.col(value).cast("double").alias("_v")).filter("_v is not null")
    wide = v.groupBy(*keys).agg(F.approx_count_distinct("_v").alias("_d")).filter(F.col("_d") > DISTINCT).select(*(F.col(k).alias(f"_{k}_of") for k in keys))
    few = lambda rows: rows.groupBy(*keys).agg(F.percentile("_v", list(ps)).alias("q")).select(*by, "q")
    if wide.isEmpty():
        return few(v)
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}_of")) for k in keys))
    wide = broadcast_if_counted(at_rest(wide))
    return few(v.join(wide, same, "left_anti")).unionByName(_bracketed(v.join(wide, same, "left_semi"), keys, ps).select(*by, "q"))


def _bracketed(v: DataFrame, keys: list[str], ps: tuple[float, ...]) -> DataFrame:
    """keys, q for groups of many values. ps need not be sorted."""
    order = sorted(range(len(ps)), key=lambda i: ps[i])
    slack = 3 / ACCURACY
    ends = [min(max(ps[i] + s, 0.0), 1.0) for s in (-slack, slack) for i in order]
    sketch = v.groupBy(*keys).agg(F.count("*").alias("_n"), F.percentile_approx("_v", ends, ACCURACY).alias("_e"))
    m = len(ps)
    brackets = broadcast_if_counted(at_rest(sketch.select(*(F.col(k).alias(f"_{k}_of") for k in keys), "_n", F.slice("_e", 1, m).alias("_low"), F.slice("_e", m + 1, m).alias("_high"))))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}_of")) for k in keys))
    inside = F.exists(F.arrays_zip("_low", "_high"), lambda x: F.col("_v").between(x["_low"], x["_high"]))
    # Lows ascend with the percentiles, so a value is below the bracket i if at most i lows are no greater.
    lows = F.size(F.filter("_low", lambda x: x <= F.col("_v")))
    counts = v.join(brackets, same).groupBy(*keys, lows.alias("_lows"), F.when(inside, F.col("_v")).alias("_v")).agg(F.count("*").alias("_c"))
    each = counts.join(brackets, same).select(*keys, "_n", "_lows", "_v", "_c", F.posexplode(F.arrays_zip("_low", "_high")).alias("_i", "_b"))
    within = F.col("_v").between(F.col("_b._low"), F.col("_b._high"))
    each = each.filter((F.col("_lows") <= F.col("_i")) | within).withColumn("_v", F.when(within, F.col("_v")))
    upto = F.sum("_c").over(Window.partitionBy(*keys, "_i").orderBy(F.col("_v").asc_nulls_first()))
    at = F.element_at(F.array(*(F.lit(ps[i]) for i in order)), F.col("_i") + 1) * (F.col("_n") - 1)
    placed = each.withColumns({"_to": upto, "_at": at}).filter("_v is not null").withColumn("_from", F.col("_to") - F.col("_c"))
    pick = lambda rank: F.max(F.when((rank >= F.col("_from")) & (rank < F.col("_to")), F.col("_v")))
    found = placed.groupBy(*keys, "_i").agg(F.first("_at").alias("_at"), pick(F.floor("_at")).alias("_a"), pick(F.ceil("_at")).alias("_b"))
    low, high = F.floor("_at"), F.ceil("_at")
    q = F.when(low == high, F.col("_a")).otherwise(F.col("_a") * (high - F.col("_at")) + F.col("_b") * (F.col("_at") - low))
    given = F.element_at(F.array(*map(F.lit, order)), F.col("_i") + 1)
    rows = found.select(*keys, F.struct(given.alias("i"), q.alias("q")).alias("_q")).groupBy(*keys).agg(F.array_sort(F.collect_list("_q")).alias("_q"))
    return rows.select(*keys, F.transform("_q", lambda x: x["q"]).alias("q"))


def percentiles_of(df: DataFrame, value: str, ps: tuple[float, ...]) -> list[float]:
    """The percentiles of a whole column; NaN where it has no values."""
    found = exact_percentiles(df, [], value, ps).first()
    return list(found.q) if found else [math.nan] * len(ps)


def percent_rank(df: DataFrame, by: str, value: str, name: str) -> DataFrame:
    """df with the share of a group's other rows below a row's value, as percent_rank gives it; a null value is below all.

    Rows are ranked within ranges of values, and the ranges before count by their size.
    """
    edges = df.groupBy(by).agg(F.count("*").alias("_n"), F.percentile_approx(value, [k / BUCKETS for k in range(1, BUCKETS)], ACCURACY).alias("_e")).withColumnRenamed(by, "_by")
    bucket = F.coalesce(F.size(F.filter("_e", lambda e: e < F.col(value))) + 1, F.lit(0))
    edges = broadcast_if_counted(at_rest(edges))
    bucketed = df.join(edges, F.col(by).eqNullSafe(F.col("_by"))).withColumn("_bucket", F.when(F.col(value).isNull(), 0).otherwise(bucket)).drop("_e", "_by")
    sizes = bucketed.groupBy(F.col(by).alias("_by"), F.col("_bucket").alias("_k")).agg(F.count("*").alias("_c"))
    before = Window.partitionBy("_by").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0))).drop("_c")
    rank = F.rank().over(Window.partitionBy(by, "_bucket").orderBy(value))
    out = bucketed.join(sizes, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_bucket") == F.col("_k"))).withColumn("_rank", rank + F.col("_before"))
    share = F.when(F.col("_n") > 1, (F.col("_rank") - 1) / (F.col("_n") - 1)).otherwise(0.0)
    return out.withColumn(name, share).drop("_n", "_bucket", "_by", "_k", "_before", "_rank")
