"""Weeks, months and look-back periods.

The key of the time series is ``weekstart``: the Monday strictly after a date, so Monday to Sunday of one week share the
following Monday.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WEEK_PERIODS = {f"{n}w": 7 * n for n in (1, 2, 3)}
#: Days of the periods of one to six months in whole weeks.
MONTH_PERIODS = {"1m": 28, "2m": 56, "3m": 91, "4m": 119, "5m": 154, "6m": 182}
CALENDAR_PERIODS = {f"{n}cm": 30 * n for n in range(1, 7)}
MONTH_MAPPED = {"1m": 1, "2m": 2, "3m": 3}


def next_week_start(date: Column | str) -> Column:
    """Monday strictly after the date; null for null."""
    return F.next_day(F.to_date(date), "monday")


def prev_week_start(date: Column | str) -> Column:
    """Monday on or before the date; null for null."""
    return F.date_sub(F.next_day(F.to_date(date), "monday"), 7)


def strip_prefix(period: str) -> str:
    """The period at the end of a name such as ``tot_amt_03m`` or ``last_2w``."""
    found = re.search(r"0*(\d+(?:cm|w|m))$", period)
    if not found:
        raise ValueError(f"no period in {period!r}")
    return found[1]


def period_days(period: str, month_mapped: bool = False) -> int:
    """Days of a period; in month-mapped series a month is one day. -1 stands for all of the past."""
    if period in ("-1", "all"):
        return -1
    known = MONTH_MAPPED if month_mapped else WEEK_PERIODS | MONTH_PERIODS | CALENDAR_PERIODS
    if period not in known:
        raise ValueError(f"unknown period {period!r}")
    return known[period]


def run_window(period: str, first: str | None = None, last: str | None = None, today: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """First and last weekstart of a run. Without dates the last is the Monday on or before two days ago."""
    end = dt.date.fromisoformat(last) if last else (lambda d: d - dt.timedelta(d.weekday()))((today or dt.date.today()) - dt.timedelta(2))
    start = dt.date.fromisoformat(first) if first else end - dt.timedelta(period_days(period) - 7)
    for d in (start, end):
        if d.weekday():
            raise ValueError(f"{d} is no Monday")
    return start, end


def last_month(today: dt.date | None = None) -> dt.date:
    """First day of the month of five days ago."""
    return ((today or dt.date.today()) - dt.timedelta(5)).replace(day=1)


def date_spine(spark: SparkSession, start: dt.date, end: dt.date, step: str = "1 day") -> DataFrame:
    """Every date from start to end with its weekstart."""
    span = F.sequence(F.lit(start), F.lit(end), F.expr(f"interval {step}"))
    return spark.range(1).select(F.explode(span).alias("date")).withColumn("weekstart", next_week_start("date"))


def sla_month(weekstart: Column | str, sla_day: int) -> Column:
    """The newest month delivered by a weekstart: two back before the delivery day of the month, else one back."""
    w = F.col(weekstart) if isinstance(weekstart, str) else weekstart
    back = F.when(F.dayofmonth(w) < sla_day, -2).otherwise(-1)
    return F.add_months(F.trunc(w, "month"), back)
