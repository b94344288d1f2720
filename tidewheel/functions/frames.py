"""Window frames over (key, weekstart) series.

Range frames count days since 1970, so they hold in any session time zone. A frame of n days reaches back n - 1 days: on
weekly rows 7 days are this row and 28 days are four.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

NEVER = 99999


def _days(order: str) -> Column:
    return F.unix_date(F.col(order))


def rolling(days: int, key: str | list[str] = "msisdn", order: str = "weekstart", extra: list[str] = ()) -> WindowSpec:
    """The row and the ``days`` - 1 days before it; -1: all the past."""
    keys = [key] if isinstance(key, str) else list(key)
    low = Window.unboundedPreceding if days == -1 else -(days - 1)
    return Window.partitionBy(*keys, *extra).orderBy(_days(order)).rangeBetween(low, 0)


def rolling_fixed(start: int, end: int, key: str | list[str] = "msisdn", order: str = "weekstart", extra: list[str] = ()) -> WindowSpec:
    """From ``start`` to ``end`` days back, each less one unless zero."""
    keys = [key] if isinstance(key, str) else list(key)
    less = lambda n: n - 1 if n else 0
    return Window.partitionBy(*keys, *extra).orderBy(_days(order)).rangeBetween(-less(start), -less(end))


def offset_window(first: int, last: int, key: str = "msisdn", order: str = "weekstart") -> WindowSpec:
    """From ``first`` to ``last`` days after the row; negative: before it."""
    return Window.partitionBy(key).orderBy(_days(order)).rangeBetween(first, last)


def weeks_frame(n: int, key: str = "msisdn", order: str = "weekstart") -> WindowSpec:
    """The last n rows."""
    return Window.partitionBy(key).orderBy(order).rowsBetween(-(n - 1), 0)


def rows_frame(start: int, end: int, key: str = "msisdn", order: str = "weekstart", ascending: bool = True) -> WindowSpec:
    by = F.col(order).asc() if ascending else F.col(order).desc()
    return Window.partitionBy(key).orderBy(by).rowsBetween(start, end)


def last_row_per(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each group; ``order`` must be total, else ties are settled by nothing."""
    w = Window.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() for c in order))
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def collect_windows(df: DataFrame, columns: list[str], pairs: list[tuple[int, int]], key: str = "msisdn") -> DataFrame:
    """A sorted list column for each column and (start, end) pair, named column_end_to_start."""
    lists = {f"{c}_{e}_to_{s}": F.array_sort(F.collect_list(c).over(rolling_fixed(s, e, key))) for c in columns for s, e in pairs}
    return df.withColumns(lists)


def weeks_since_last_activity(column: str, lookback: int, key: str = "msisdn") -> Column:
    """0 if active this week, NEVER if not in the last ``lookback`` rows before, else weeks since the last active one."""
    active = F.when(F.coalesce(F.col(column), F.lit(0)) > 0, F.col("weekstart"))
    past = F.last(active, ignorenulls=True).over(rows_frame(-lookback, -1, key))
    return F.when(active.isNotNull(), 0).otherwise(F.coalesce(F.floor(F.datediff("weekstart", past) / 7), F.lit(NEVER))).cast("long")


def distinct_over_window(df: DataFrame, counts: dict[str, tuple[str, int]], keys: list[str] = ("msisdn",), order: str = "weekstart") -> DataFrame:
    """df with, for each name -> (array column, days), the number of different elements over the rolling frame.

    A sweep over occurrences: an element counts from its occurrence until it has been away for the frame's days, so an
    occurrence adds one if the element's last one is too long ago, and takes one away when it runs out before the next.
    A day's changes are counted by the day of their occurrence, then moved as sums, and a row has the sum of all changes up
    to it. No list is gathered, and memory does not grow with the lists. Null elements count as one element; null arrays
    hold none.
    """
    lists = list(dict.fromkeys(c for c, _ in counts.values()))
    tagged = lambda k, c: F.transform(F.array_distinct(c), lambda e: F.struct(F.lit(k).alias("tag"), e.cast("string").alias("e")))
    none = F.array().cast("array<struct<tag:int,e:string>>")
    every = F.flatten(F.array(*(F.coalesce(tagged(k, c), none) for k, c in enumerate(lists))))
    # All steps below group within the keys, so this is the only exchange of elements.
    each = df.select(*keys, _days(order).alias("_day"), every.alias("_every")).repartition(*keys).select(*keys, "_day", F.explode("_every").alias("_x")).select(*keys, "_day", "_x.tag", "_x.e")
    w = Window.partitionBy(*keys, "tag", "e").orderBy("_day")
    seen = each.withColumns({"_before": F.lag("_day").over(w), "_after": F.lead("_day").over(w)})
    frames = sorted({days for _, days in counts.values()})
    at = [(lists.index(c), days) for c, days in counts.values()]
    # An occurrence stays one row here: elements outnumber the days by far.
    comes = lambda tag, days: F.count_if((F.col("tag") == tag) & (F.col("_before").isNull() | (F.col("_day") - F.col("_before") >= days)))
    goes = lambda tag, days: F.count_if((F.col("tag") == tag) & (F.col("_after").isNull() | (F.col("_after") - F.col("_day") >= days)))
    per = seen.groupBy(*keys, "_day").agg(*(of(tag, days).alias(f"_{k}{n}") for n, (tag, days) in enumerate(at) for k, of in (("c", comes), ("g", goes))))
    zero = F.lit(0).cast("long")
    come = F.struct(F.col("_day").cast("int").alias("_day"), *(F.col(f"_c{n}").alias(f"_n{n}") for n in range(len(at))))
    gone = [F.struct((F.col("_day") + f).cast("int").alias("_day"), *((-F.col(f"_g{n}") if days == f else zero).alias(f"_n{n}") for n, (_, days) in enumerate(at))) for f in frames]
    sums = per.select(*keys, F.explode(F.array(come, *gone)).alias("_m")).select(*keys, "_m.*")
    rows = df.select(*keys, _days(order).alias("_day"), F.struct(*df.columns).alias("_row"))
    both = rows.unionByName(sums, allowMissingColumns=True)
    upto = Window.partitionBy(*keys).orderBy("_day").rangeBetween(Window.unboundedPreceding, 0)
    swept = both.select("_row", *(F.coalesce(F.sum(f"_n{n}").over(upto), F.lit(0)).cast("int").alias(f"_n{n}") for n in range(len(at))))
    return swept.filter("_row is not null").select("_row.*", *(F.col(f"_n{n}").alias(name) for n, name in enumerate(counts)))


def percentiles_over_window(df: DataFrame, wanted: dict[str, tuple[str, int, float]], keys: list[str] = ("msisdn",), order: str = "weekstart", step: int = 7) -> DataFrame:
    """df with, for each name -> (column, days, p), the exact interpolated percentile over the rolling frame; nulls left out.

    Rows lie whole steps of ``step`` days apart. A row's values are handed ahead to every step of the key's rows whose frame holds
    them, within the task that has the key, and each step is one small group there: nothing is rebuilt from row to row. Steps
    without rows get nothing: a sparse series is handed on as few times as its frames hold rows.
    """
    columns = sorted({c for c, *_ in wanted.values()})
    longest = max(days for _, days, _ in wanted.values())
    values = df.select(*keys, _days(order).alias("_day"), *(F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(columns))).repartition(*keys)
    # Of the steps ahead, at most longest / step, those that have rows; rows of one step see the same.
    ahead = F.collect_set("_day").over(Window.partitionBy(*keys).orderBy("_day").rangeBetween(0, (longest - 1) // step * step))
    handed = values.withColumn("_ahead", ahead).withColumn("_at", F.explode("_ahead")).withColumn("_age", F.col("_at") - F.col("_day"))
    value = lambda c, days: F.when(F.col("_age") < days, F.col(f"_v{columns.index(c)}"))
    per = handed.groupBy(*(F.col(k).alias(f"_{k}_of") for k in keys), "_at").agg(F.min("_age").alias("_least"), *(F.percentile(value(c, days), p).alias(n) for n, (c, days, p) in wanted.items()))
    same = _days(order) == F.col("_at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}_of"))
    return df.join(per.filter("_least = 0"), same).select(*df.columns, *wanted)


def unique_list_per(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Distinct elements of an array column per group: exploded and counted, so long lists are never gathered."""
    return df.select(*keys, F.explode(column).alias("_e")).groupBy(*keys).agg(F.countDistinct("_e").alias(f"unique_{column}"))


def dominant_category(df: DataFrame, category: str, value: str, count: str, days: int, key: str = "msisdn") -> DataFrame:
    """key, weekstart, dominant: the category with most value over the rolling days, ties by count, then by name.

    Categories of earlier weeks of the frame count though they are absent this week.
    """
    weeks = df.select(key, "weekstart").distinct()
    categories = df.select(key, category).distinct()
    totals = df.groupBy(key, "weekstart", category).agg(F.sum(value).alias("_v"), F.sum(count).alias("_n"))
    grid = weeks.join(categories, key).join(totals, [key, "weekstart", category], "left")
    frame = rolling(days, key, extra=[category])
    summed = grid.withColumns({"_v": F.sum("_v").over(frame), "_n": F.sum("_n").over(frame)}).filter("_n is not null")
    best = Window.partitionBy(key, "weekstart").orderBy(F.col("_v").desc(), F.col("_n").desc(), category)
    return summed.withColumn("_r", F.row_number().over(best)).filter("_r = 1").select(key, "weekstart", F.col(category).alias("dominant"))


def weeks_of_categories(df: DataFrame, category: str, value: str, count: str, key: str = "msisdn", **sums: Column) -> DataFrame:
    """key, weekstart and aggregates of the week's rows; with what dominant_categories needs, the week's value and count by category.
    Totals are dealt once, by key, and all that follows by key or week needs no other exchange."""
    made = {f"_s{i}": c for i, c in enumerate(sums.values())}
    per = df.groupBy(key, "weekstart", category).agg(F.sum(value).alias("_v"), F.sum(count).alias("_n"), *(c.alias(n) for n, c in made.items())).repartition(key)
    own = F.when(F.col(category).isNotNull() & F.col("weekstart").isNotNull(), F.struct(F.col(category).alias("c"), F.struct("_v", "_n").alias("x")))
    return per.groupBy(key, "weekstart").agg(F.map_from_entries(F.collect_list(own)).alias("_own"), *(F.sum(n).alias(name) for n, name in zip(made, sums, strict=True)))


def dominant_categories(weeks: DataFrame, wanted: dict[str, tuple[int, bool]], keep: list[str], key: str = "msisdn") -> DataFrame:
    """key, weekstart, the kept columns and, for each name -> (days, by count), the category with most value (or count) over the
    rolling days; ties by the other one, then by name; null where the frame holds nothing. weeks: of weeks_of_categories.

    All frames are sums of one pass over the grid of weeks and categories, made within the task that has the key, and each best
    one is a minimum, not a ranking.
    """
    # Before the explosion, in the sort of the key's weeks.
    every = F.array_distinct(F.flatten(F.collect_set(F.map_keys("_own")).over(Window.partitionBy(key).orderBy(_days("weekstart")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    every = F.when(F.col(key).isNotNull(), every)
    grid = weeks.withColumn("_all", every).select(key, "weekstart", F.struct(*keep).alias("_keep"), "_own", F.explode_outer("_all").alias("_c"))
    own = F.try_element_at("_own", F.col("_c"))
    grid = grid.select(key, "weekstart", "_keep", "_c", own["_v"].alias("_v"), own["_n"].alias("_n"))
    frames = sorted({days for days, _ in wanted.values()})
    summed = grid.select(key, "weekstart", "_keep", "_c", *(F.sum(c).over(rolling(d, key, extra=["_c"])).alias(f"{c}{d}") for d in frames for c in ("_v", "_n")))
    first = lambda d, by_count: (f"_n{d}", f"_v{d}") if by_count else (f"_v{d}", f"_n{d}")
    best = lambda d, by_count: F.min(F.when(F.col(f"_n{d}").isNotNull(), F.struct(*((-F.col(c)).alias(c) for c in first(d, by_count)), F.col("_c").alias("c"))))["c"]
    return summed.groupBy(key, "weekstart").agg(F.first("_keep").alias("_keep"), *(best(*w).alias(name) for name, w in wanted.items())).select(key, "weekstart", "_keep.*", *wanted)


def zero_runs(df: DataFrame, key: str, order: str, target: str) -> DataFrame:
    """df with ``run``: the length so far of the run of zero (or null) targets that a row is in; 0 elsewhere."""
    zero = F.coalesce(F.col(target), F.lit(0)) == 0
    all_rows = F.row_number().over(Window.partitionBy(key).orderBy(order))
    same = F.row_number().over(Window.partitionBy(key, zero).orderBy(order))
    island = df.withColumn("_zero", zero).withColumn("_island", all_rows - same)
    run = F.row_number().over(Window.partitionBy(key, "_zero", "_island").orderBy(order))
    return island.withColumn("run", F.when(F.col("_zero"), run).otherwise(0)).drop("_zero", "_island")


def streak_filter(df: DataFrame, key: str, order: str, target: str, n: int) -> DataFrame:
    """df without the keys that have a run of n or more zero targets."""
    long_run = F.max("run").over(Window.partitionBy(key))
    return zero_runs(df, key, order, target).withColumn("_max", long_run).filter(F.col("_max") < n).drop("_max", "run")


def inactivity_periods(df: DataFrame, column: str, key: str = "msisdn") -> DataFrame:
    """One row per run of inactive weeks: key, period, first week and length."""
    active = (F.coalesce(F.col(column), F.lit(0)) > 0).cast("int")
    order = Window.partitionBy(key).orderBy("weekstart")
    marked = df.withColumn("_a", active).withColumn("_break", (F.col("_a") != F.coalesce(F.lag("_a").over(order), F.lit(-1))).cast("int"))
    period = marked.withColumn("period", F.sum("_break").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return period.filter("_a = 0").groupBy(key, "period").agg(F.min("weekstart").alias("first_week"), F.count("*").alias("weeks"))


def cases_by_length(periods: DataFrame) -> DataFrame:
    """weeks, cases, cases of that length or longer."""
    counts = periods.groupBy("weeks").agg(F.count("*").alias("cases"))
    return counts.withColumn("at_least", F.sum("cases").over(Window.orderBy("weeks").rowsBetween(0, Window.unboundedFollowing)))
