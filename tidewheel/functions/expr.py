"""Feature expressions that are the same for each look-back period.

An expression is a function of (name of the period, days) that gives a column; seven days mean the current week's column
itself. ``period_features`` puts them all into one select, so that all frames share one sort of the series.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions.frames import distinct_over_window, percentiles_over_window, rolling
from tidewheel.functions.timekeys import period_days

Expression = Callable[[str, int], Column]


@dataclass(frozen=True)
class Feature:
    """``name`` with ``{period}`` in it, its expression and its periods."""

    name: str
    expression: Expression
    periods: tuple[str, ...] = ("1w", "2w", "3w", "1m", "2m", "3m")

    def columns(self) -> dict[str, Column]:
        return {n: self.expression(p, period_days(p)) for n, p in zip(self.names(), self.periods, strict=True)}

    def names(self) -> list[str]:
        """Column names, periods written with two digits."""
        return [self.name.format(period=f"{int(p[:-1]):02d}{p[-1]}") for p in self.periods]


@dataclass
class FeatureSet:
    features: list[Feature] = field(default_factory=list)

    def add(self, name: str, expression: Expression, *periods: str) -> FeatureSet:
        self.features.append(Feature(name, expression, periods) if periods else Feature(name, expression))
        return self


def period_features(df: DataFrame, features: FeatureSet | list[Feature], keep: list[str] | None = None) -> DataFrame:
    """The kept columns (default: all) and one column per feature and period, in one select."""
    of = features.features if isinstance(features, FeatureSet) else features
    keep = keep if keep is not None else df.columns
    # Counts of different elements are swept for all features at once, by their keys.
    swept: dict[tuple, dict] = {}
    for f in of:
        if isinstance(f.expression, DistinctOver):
            swept.setdefault(f.expression.keys, {}).update({n: (f.expression.column, period_days(p)) for n, p in zip(f.names(), f.periods, strict=True) if period_days(p) != 7})
    for keys, counts in swept.items():
        df = distinct_over_window(df, counts, list(keys)) if counts else df
    columns = {n: c for f in of for n, c in f.columns().items()}
    ranked: dict[tuple, dict] = {}
    for f in of:
        if isinstance(f.expression, PercentileOver):
            ranked.setdefault(f.expression.keys, {}).update({n: (f.expression.column, period_days(p), f.expression.p) for n, p in zip(f.names(), f.periods, strict=True) if period_days(p) != 7})
    for keys, wanted in ranked.items():
        df = percentiles_over_window(df, wanted, list(keys)) if wanted else df
    known = {n for made in (*swept.values(), *ranked.values()) for n in made}
    return df.select(*keep, *(F.col(n) if n in known else c.alias(n) for n, c in columns.items()))


def feature_names(features: FeatureSet) -> list[str]:
    return [n for f in features.features for n in f.names()]


def row_sum(columns: list[str]) -> Column:
    """Sum of columns of a row; null if any is."""
    return reduce(add, map(F.col, columns))


def _over(aggregate: Callable[[Column], Column], columns: str | list[str], key: str, extra: list[str] = ()) -> Expression:
    of = row_sum([columns] if isinstance(columns, str) else columns)
    return lambda name, days: of if days == 7 else aggregate(of).over(rolling(days, key, extra=extra))


def sum_over(columns: str | list[str], key: str = "msisdn", extra: list[str] = ()) -> Expression:
    return _over(F.sum, columns, key, extra)


def avg_over(column: str, key: str = "msisdn", extra: list[str] = ()) -> Expression:
    return _over(F.avg, column, key, extra)


def min_over(column: str, key: str = "msisdn") -> Expression:
    return _over(F.min, column, key)


def max_over(column: str, key: str = "msisdn") -> Expression:
    return _over(F.max, column, key)


def first_over(column: str, key: str = "msisdn") -> Expression:
    return _over(F.first, column, key)


@dataclass(frozen=True)
class PercentileOver:
    """Exact interpolated percentile of a column over the period of a weekly series; ``period_features`` makes them all at once."""

    column: str
    p: float = 0.5
    keys: tuple[str, ...] = ("msisdn",)

    def __call__(self, name: str, days: int) -> Column:
        return F.col(self.column)


def median_over(column: str, key: str = "msisdn") -> Expression:
    return PercentileOver(column, 0.5, (key,))


def stddev_over(column: str, key: str = "msisdn") -> Expression:
    return lambda name, days: F.stddev(column).over(rolling(days, key))


def monthly_avg_over(column: str, key: str = "msisdn") -> Expression:
    """Sum over the period by its whole months of 28 days."""
    return lambda name, days: F.sum(column).over(rolling(days, key)) / max(days // 28, 1)


def sum_over_months(columns: str | list[str], key: str = "msisdn", order: str = "month_mapped_dt") -> Expression:
    """For series in which months are consecutive days."""
    of = row_sum([columns] if isinstance(columns, str) else columns)
    return lambda name, days: of if days == 1 else F.sum(of).over(rolling(days, key, order))


@dataclass(frozen=True)
class DistinctOver:
    """Different elements of an array column over the period; ``period_features`` sweeps them."""

    column: str
    keys: tuple[str, ...] = ("msisdn",)

    def __call__(self, name: str, days: int) -> Column:
        return F.size(F.array_distinct(F.col(self.column)))


def diff(a: str, b: str) -> Column:
    return F.col(a) - F.col(b)


def division(a: str, b: str) -> Column:
    """a / b; null where b is 0 or null."""
    return F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))


def ratio(a: str, b: str) -> Column:
    """a's share of a + b; null where that is 0 or null."""
    return F.try_divide(F.col(a).cast("double"), (F.col(a) + F.col(b)).cast("double"))


def division_of_sums(num: str, den: str, key: str = "msisdn") -> Expression:
    return lambda name, days: F.try_divide(F.sum(num).over(rolling(days, key)).cast("double"), F.sum(den).over(rolling(days, key)).cast("double"))
