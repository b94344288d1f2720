"""Dense series: one row per key and week, month or day, and filling them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.functions.timekeys import prev_week_start


def weekly_scaffold(key: str = "msisdn") -> Callable[..., DataFrame]:
    """P1. For frames with key and weekstart: every Monday between a key's first and last week in any of them."""

    def build(*dfs: DataFrame) -> DataFrame:
        every = reduce(DataFrame.union, [d.select(key, "weekstart") for d in dfs])
        bounds = every.groupBy(key).agg(F.min("weekstart").alias("lo"), F.max("weekstart").alias("hi")).filter("lo is not null")
        return bounds.select(key, F.explode(F.expr("sequence(lo, hi, interval 7 days)")).alias("weekstart"))

    return build


def monthly_scaffold(key: str = "msisdn") -> Callable[..., DataFrame]:
    """P2. The same by month, ``mo_id`` as yyyy-MM."""

    def build(*dfs: DataFrame) -> DataFrame:
        every = reduce(DataFrame.union, [d.select(key, F.to_date(F.concat("mo_id", F.lit("-01"))).alias("m")) for d in dfs])
        bounds = every.groupBy(key).agg(F.min("m").alias("lo"), F.max("m").alias("hi")).filter("lo is not null")
        return bounds.select(key, F.explode(F.expr("sequence(lo, hi, interval 1 month)")).alias("m")).select(key, F.date_format("m", "yyyy-MM").alias("mo_id"))

    return build


def daily_scaffold(bounds: DataFrame, key: str, first: str, last: str) -> DataFrame:
    """P3. Every date between two columns."""
    return bounds.filter(F.col(first) <= F.col(last)).select(key, F.explode(F.sequence(F.col(first), F.col(last))).alias("event_date"))


def id_scaffold(prepaid: DataFrame, postpaid: DataFrame, ids: DataFrame, between: tuple[str, str] | None = None) -> DataFrame:
    """P4. The weekly scaffold of listed ids over both sources; optionally only weeks between two dates."""
    listed = ids.select("msisdn").distinct()
    out = weekly_scaffold()(*(d.join(listed, "msisdn", "left_semi") for d in (prepaid, postpaid)))
    return out.filter(F.col("weekstart").between(*(F.lit(b).cast("date") for b in between))) if between else out


def fill_time_series(scaffold: DataFrame, df: DataFrame, keys: list[str]) -> DataFrame:
    """P5. Gaps are null."""
    return scaffold.join(df, keys, "left")


def dense_weekly(df: DataFrame, key: str = "msisdn", zero: bool = False) -> DataFrame:
    """P1 and P5 (P7 with ``zero``) in one pass: df on the weekly scaffold of its own keys, as fill_time_series gives it.

    A row makes the empty weeks up to the next one, in the task that has its key; so the rows are dealt once and the
    scaffold, many times as large, never.
    """
    rows = df.filter(F.col("weekstart").isNotNull())
    own = Window.partitionBy(key)
    placed = rows.withColumns({"_next": F.lead("weekstart").over(own.orderBy("weekstart")), "_low": F.min("weekstart").over(own), "_high": F.max("weekstart").over(own)})
    # Rows between the scaffold's weeks are on none of them, but their share of weeks is.
    weeks = lambda of: F.floor(F.datediff(of, "_low") / 7)
    on = F.datediff("weekstart", "_low") % 7 == 0
    last = F.when(F.col("_next").isNull(), weeks("_high")).otherwise(F.ceil(F.datediff("_next", "_low") / 7) - 1)
    first = F.ceil(F.datediff("weekstart", "_low") / 7)
    # A null key matches nothing: its weeks stay, once each and empty.
    twice = F.col(key).isNull() & F.coalesce(F.col("_next") == F.col("weekstart"), F.lit(False))
    made = F.when(twice, F.lit(None)).when(on, F.sequence(first, F.greatest(first, last))).when(first <= last, F.sequence(first, F.greatest(first, last)))
    each = placed.withColumns({"_on": on, "_first": first}).withColumn("_week", F.explode(made))
    at, keeps = F.date_add("_low", (F.col("_week") * 7).cast("int")), F.col(key).isNotNull() & F.col("_on") & (F.col("_week") == F.col("_first"))
    values = [F.when(keeps, F.col(c)).alias(c) for c in df.columns if c not in (key, "weekstart")]
    out = each.select(key, at.alias("weekstart"), *values)
    return out.fillna(0) if zero else out


def fill_with_category(scaffold: DataFrame, categories: list[str], df: DataFrame, keys: list[str], name: str = "category") -> DataFrame:
    """P6. Each scaffold row for each category of a short list, then filled."""
    grid = scaffold.withColumn(name, F.explode(F.array(*map(F.lit, categories))))
    return grid.join(df, [*keys, name], "left")


def fill_with_zero(scaffold: DataFrame, df: DataFrame, keys: list[str]) -> DataFrame:
    """P7."""
    return scaffold.join(df, keys, "left").fillna(0)


def id_week_grid(ids: DataFrame, first: Column, last: Column) -> DataFrame:
    """P8. Every id with every Monday from first to last."""
    return ids.select("msisdn").distinct().withColumn("weekstart", F.explode(F.sequence(first, last, F.expr("interval 7 days"))))


def pack_use_cases(lists: dict[str, DataFrame]) -> DataFrame:
    """P9. msisdn, use_case: the sorted set of the lists that name an id."""
    every = reduce(DataFrame.union, [df.select("msisdn", F.lit(name).alias("use_case")) for name, df in sorted(lists.items())])
    return every.groupBy("msisdn").agg(F.array_sort(F.collect_set("use_case")).alias("use_case"))


def new_id_report(now: DataFrame, before: DataFrame) -> DataFrame:
    """P10. use_case, total and new ids, for two packed lists."""
    each = now.withColumn("use", F.explode("use_case"))
    fresh = each.join(before.select("msisdn").distinct(), "msisdn", "left_anti")
    total = each.groupBy("use").agg(F.count("*").alias("total"))
    return total.join(fresh.groupBy("use").agg(F.count("*").alias("new")), "use", "left").fillna(0).withColumnRenamed("use", "use_case")


def unpack(output: DataFrame, requests: DataFrame) -> DataFrame:
    """P11. Rows of an output for requests (msisdn, request_date, alias), at the Monday on or before the request, by alias."""
    at = requests.select("msisdn", "alias", prev_week_start("request_date").alias("weekstart")).distinct()
    return output.join(at, ["msisdn", "weekstart"]).drop("msisdn").withColumnRenamed("alias", "msisdn")
