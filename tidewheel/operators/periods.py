"""Fixed periods (F24): rolling measures inside each of several periods, dealt to the weeks after a period has closed.

A measure of a period sees the period's rows only. Inside the period a row has the measure so far; the period closes with
the value of the key's last row in it, and all later rows carry that value. Before the period there is none. All of it is
one partitioning and one sort of the series by key: a measure sees a column as null outside its period, so the frames of all
periods are over the same rows; then one as-of pass for all measures.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidewheel.functions.expr import ratio

Periods = dict[str, tuple[str, str]]
#: Of the key's rows in order, and of how a column looks within the period (null outside it), the measure.
Measure = Callable[[WindowSpec, Callable[[str | Column], Column]], Column]


#: A row's day as a number. As a column of its own it lets all windows use one sort.
DAY = "_day"


def dated(df: DataFrame, order: str = "weekstart") -> DataFrame:
    return df if DAY in df.columns else df.withColumn(DAY, F.unix_date(order))


def inside(period: tuple[str, str], order: str = "weekstart") -> Column:
    first, last = (F.lit(x).cast("date") for x in period)
    return F.col(order).between(first, last)


def frame(days: int, key: str = "msisdn", order: str = "weekstart") -> Callable[[WindowSpec], WindowSpec]:
    """Of a key's rows, those of the last ``days`` days; -1: all so far."""
    low = Window.unboundedPreceding if days == -1 else -(days - 1)
    return lambda rows: rows.rangeBetween(low, 0)


def over(aggregate: Callable[[Column], Column], column: str, days: int) -> Measure:
    """A rolling aggregate inside the period; one that leaves nulls out."""
    return lambda rows, of: aggregate(of(column)).over(frame(days)(rows))


def share_over(part: str, whole: str, days: int) -> Measure:
    return lambda rows, of: F.try_divide(F.sum(of(part)).over(frame(days)(rows)).cast("double"), F.sum(of(whole)).over(frame(days)(rows)).cast("double"))


def change_over(column: str, days: int, longer: int) -> Measure:
    """Mean of the last days against the mean of a longer stretch, as a share of both."""
    mean = lambda rows, of, n: F.avg(of(column)).over(frame(n)(rows))
    return lambda rows, of: F.try_divide(mean(rows, of, days), mean(rows, of, days) + mean(rows, of, longer))


def closing_measures(weekly: DataFrame, measures: dict[str, Measure], periods: Periods, key: str = "msisdn", order: str = "weekstart", running: bool = True) -> DataFrame:
    """F24. weekly with <measure>_<period> for each measure and period.

    running: rows inside a period have the measure so far; else they have none until the period is over, whether or not
    the key has a row in its last week. A closing value that is null stays null afterwards.
    """
    known, rows = {}, Window.partitionBy(key).orderBy(DAY)
    for name, period in periods.items():
        within = inside(period, order)
        of = lambda c, within=within: F.when(within, F.col(c) if isinstance(c, str) else c)
        for m, measure in measures.items():
            known[f"{m}_{name}"] = F.when(within, F.struct(measure(rows, of).alias("v")))
    # A struct, so that a null value is told from a row outside the period.
    marked = dated(weekly, order).withColumns({f"_{n}": c for n, c in known.items()})
    asof = rows.rowsBetween(Window.unboundedPreceding, 0)
    out = marked.withColumns({n: F.last(f"_{n}", ignorenulls=True).over(asof)["v"] for n in known}).drop(*(f"_{n}" for n in known), *({DAY} - set(weekly.columns)))
    if not running:
        over_ = {name: F.col(order) > F.lit(last).cast("date") for name, (_, last) in periods.items()}
        out = out.withColumns({f"{m}_{name}": F.when(c, F.col(f"{m}_{name}")) for name, c in over_.items() for m in measures})
    return out


def period_ratios(closed: DataFrame, measures: list[str], periods: Periods, key: str = "msisdn", order: str = "weekstart", carry: bool = True) -> DataFrame:
    """F24. closed with <measure>_<later>_with_<first>: the later period's value as a share of it and the first's.

    carry: where a ratio is not known, the last known one of the key's rows before.
    """
    first, *later = periods
    ratios = {f"{m}_{n}_with_{first}": ratio(f"{m}_{n}", f"{m}_{first}") for m in measures for n in later}
    out = closed.withColumns(ratios)
    if carry:
        asof = Window.partitionBy(key).orderBy(DAY).rowsBetween(Window.unboundedPreceding, 0)
        out = dated(out, order).withColumns({r: F.last(r, ignorenulls=True).over(asof) for r in ratios}).drop(*({DAY} - set(closed.columns)))
    return out


def period_trends(closed: DataFrame, current: dict[str, str], periods: Periods) -> DataFrame:
    """F17. closed with <measure>_trend_<period>: this week's value of a column as a share of it and the period's measure. current: measure -> column."""
    return closed.withColumns({f"{m}_trend_{n}": ratio(c, f"{m}_{n}") for m, c in current.items() for n in periods})


def distinct_by_period(weekly: DataFrame, arrays: dict[str, str], periods: Periods, key: str = "msisdn", order: str = "weekstart") -> DataFrame:
    """F2. key, and <name>_<period>: different elements of an array column over all of a period's rows. Elements are counted, never gathered."""
    tagged = lambda n: lambda e: F.struct(F.lit(n).alias("n"), e.cast("string").alias("e"))
    every = [F.transform(F.array_distinct(c), tagged(n)) for n, c in arrays.items()]
    each = weekly.select(key, order, F.explode(F.flatten(F.array_compact(F.array(*every)))).alias("x"))
    marks = [F.when(inside(p, order), F.lit(n)) for n, p in periods.items()]
    of = each.select(key, F.col("x.n").alias("n"), F.col("x.e").alias("e"), F.explode(F.array_compact(F.array(*marks))).alias("p"))
    per = of.filter("e is not null").distinct().groupBy(key).agg(*(F.count_if((F.col("n") == n) & (F.col("p") == p)).alias(f"{n}_{p}") for n in arrays for p in periods))
    return weekly.select(key).distinct().join(per, key, "left").fillna(0)


def deal_after(weeks: DataFrame, values: DataFrame, columns: dict[str, str], key: str = "msisdn", order: str = "weekstart") -> DataFrame:
    """F2, F3. weeks with columns of values (one row a key) in the weeks after a date. columns: column -> last week before it shows."""
    joined = weeks.join(values.select(key, *columns), key, "left")
    return joined.withColumns({c: F.when(F.col(order) > F.lit(last).cast("date"), F.col(c)) for c, last in columns.items()})


def idle(column: str) -> Measure:
    """Weeks so far of the period without activity."""
    return lambda rows, of: F.sum(of(F.coalesce(F.col(column), F.lit(0)) == 0).cast("long")).over(frame(-1)(rows))


def voice_weeks(weekly: DataFrame, periods: Periods) -> DataFrame:
    """F2. weekly: out_call_nums, inc_call_nums (arrays) on the scaffold; three periods. By id and week: weeks of the first period
    without calls in and out, known after it; ratios of the different numbers called in the first period against the
    second and the third, known after the third."""
    first, second, third = periods
    df = weekly.withColumns({"n_out": F.size("out_call_nums"), "n_inc": F.size("inc_call_nums")})
    closed = closing_measures(df, {"fea_voice_no_inc": idle("n_inc"), "fea_voice_no_out": idle("n_out")}, {first: periods[first]}, running=False)
    numbers = distinct_by_period(weekly, {"out": "out_call_nums"}, periods)
    ratios = {f"fea_voice_uniq_out_ratio_{first}_{n}": ratio(f"out_{first}", f"out_{n}") for n in (second, third)}
    dealt = deal_after(closed, numbers.withColumns(ratios), dict.fromkeys(ratios, periods[third][1]))
    return dealt.select("msisdn", "weekstart", f"fea_voice_no_inc_{first}", f"fea_voice_no_out_{first}", *ratios)


def text_weeks(weekly: DataFrame, periods: Periods) -> DataFrame:
    """F3. weekly: A2 on the scaffold. By id and week: weeks of the first period without texts in and out, known after it."""
    first = next(iter(periods))
    closed = closing_measures(weekly, {"fea_text_no_inc": idle("count_sms_inc"), "fea_text_no_out": idle("count_sms_out")}, {first: periods[first]}, running=False)
    return closed.select("msisdn", "weekstart", f"fea_text_no_inc_{first}", f"fea_text_no_out_{first}")


def internet_weeks(weekly: DataFrame, periods: Periods) -> DataFrame:
    """F17. weekly: volume, volume_weekend on the scaffold. By id and week, for each period: mean, total and deviation of a
    month, weekend share and change, each carried on after its close; ratios with the first period, the last known one
    carried forward; trends of this week's volume and of its deviation against the periods."""
    month, quarter = 28, 91
    measures = {"avg": over(F.avg, "volume", month), "tot": over(F.sum, "volume", month), "std": over(F.stddev, "volume", quarter), "weekend": share_over("volume_weekend", "volume", month), "change": change_over("volume", month, quarter)}
    named = {f"fea_int_{m}": of for m, of in measures.items()}
    std = Window.partitionBy("msisdn").orderBy(DAY).rangeBetween(-(quarter - 1), 0)
    closed = closing_measures(dated(weekly).withColumn("_std", F.stddev("volume").over(std)), named, periods)
    out = period_trends(period_ratios(closed, list(named), periods), {"fea_int_tot": "volume", "fea_int_std": "_std"}, periods)
    return out.select("msisdn", "weekstart", *(c for c in out.columns if c.startswith("fea_int_")))
