"""Places and running totals in a total order, for groups of any size: no group, and not the whole table, is one task.

Rows are dealt by ranges of the order and written, so that a row's range stays what it was if the work is repeated. Each
group's rows or sums in a range are counted, the ranges before add up over a few rows, and a row adds its place or sum
within its own range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.sources.io import broadcast_if_counted, scratch

#: monotonically_increasing_id holds the task in its upper bits and the place in the task in its 33 lower ones.
_PLACE_BITS = 33


def _ranged(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """df with _range (a stretch of the order) and _place (in the stretch), at rest."""
    keys = [*(F.col(c) for c in by), *order]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id())
    path = scratch(df.sparkSession)
    dealt.withColumns({"_range": F.shiftright("_id", _PLACE_BITS), "_place": F.col("_id").bitwiseAND((1 << _PLACE_BITS) - 1)}).drop("_id").write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _joined(rows: DataFrame, before: DataFrame, by: list[str]) -> DataFrame:
    """A row for each group and range that it lies in: as many as ranges and groups together, at most."""
    names = {c: f"_{c}_of" for c in by}
    small = broadcast_if_counted(before.withColumnsRenamed(names).withColumnRenamed("_range", "_range_of"))
    on = F.col("_range") == F.col("_range_of")
    for c, other in names.items():
        on = on & F.col(c).eqNullSafe(F.col(other))
    return rows.join(small, on).drop("_range_of", *names.values())


def row_numbers(df: DataFrame, by: list[str], order: list[Column], name: str) -> DataFrame:
    """df with a row's place in its group from 1, by a total order. Nulls of ``by`` are a group."""
    rows = _ranged(df, by, order)
    per = rows.groupBy(*by, "_range").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select(*by, "_range", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return _joined(rows, starts, by).withColumn(name, F.col("_start") + F.col("_place") - F.col("_first") + 1).drop("_range", "_place", "_first", "_start")


def running_totals(df: DataFrame, by: list[str], order: list[Column], values: list[str]) -> DataFrame:
    """df with each value's total over its group's rows up to this one in a total order, as upto_<value>. Exact for integers."""
    rows = _ranged(df, by, order)
    per = rows.groupBy(*by, "_range").agg(*(F.sum(v).alias(f"_{v}") for v in values))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select(*by, "_range", *(F.coalesce(F.sum(f"_{v}").over(before), F.lit(0)).alias(f"_{v}") for v in values))
    within = Window.partitionBy(*by, "_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumns({f"upto_{v}": F.coalesce(F.sum(v).over(within), F.lit(0)) for v in values})
    return _joined(summed, starts, by).withColumns({f"upto_{v}": F.col(f"upto_{v}") + F.col(f"_{v}") for v in values}).drop("_range", "_place", *(f"_{v}" for v in values))
