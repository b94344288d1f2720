"""Features by domain over dense weekly series: one row per id and week, look-backs from one week to three months.

Every function makes all its columns in one or two selects, so a series is sorted once. Columns are named
``fea_<domain>_<measure>_<period>``; seven days mean the week itself.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.functions.expr import DistinctOver, FeatureSet, avg_over, division_of_sums, max_over, median_over, min_over, period_features, stddev_over, sum_over
from tidewheel.functions.frames import distinct_over_window, dominant_categories, rolling, rolling_fixed, rows_frame, weeks_of_categories, weeks_since_last_activity
from tidewheel.functions.timekeys import next_week_start, period_days, sla_month

KEY = ["msisdn", "weekstart"]
PERIODS = ("1w", "2w", "3w", "1m", "2m", "3m")


def share(a: Column, b: Column) -> Column:
    """a / (a + b); null where that is 0 or null."""
    return F.try_divide(a.cast("double"), (a + b).cast("double"))


def rolled_share(part: str, whole: str, days: int) -> Column:
    w = rolling(days)
    return F.try_divide(F.sum(part).over(w).cast("double"), F.sum(whole).over(w).cast("double"))


def idle_weeks(column: str, start: int, end: int) -> Column:
    """Weeks without activity from ``start`` to ``end`` days back."""
    return F.sum((F.coalesce(F.col(column), F.lit(0)) == 0).cast("int")).over(rolling_fixed(start, end))


BANDS = ((28, 0), (56, 28), (84, 56))


def voice(weekly: DataFrame) -> DataFrame:
    """F1. weekly: A1 on the scaffold."""
    into, out, both = (F.size(F.coalesce(F.col(c), F.array().cast("array<string>"))).cast("long") for c in ("inc_call_nums", "out_call_nums", "inc_out_call_nums"))
    df = weekly.withColumns({"n_in": into, "n_out": out, "n_all": both, "dur": F.coalesce("inc_call_dur", F.lit(0)) + F.coalesce("out_call_dur", F.lit(0))})
    fs = FeatureSet()
    for name, column in (("inc_dur", "inc_call_dur"), ("out_dur", "out_call_dur"), ("night_dur", "tot_dur_12_5_am"), ("inc_count", "n_in"), ("out_count", "n_out"), ("all_count", "n_all")):
        fs.add(f"fea_voice_{name}_{{period}}", sum_over(column), *PERIODS)
    for name, column in (("in", "inc_call_nums"), ("out", "out_call_nums"), ("all", "inc_out_call_nums")):
        fs.add(f"fea_voice_uniq_{name}_{{period}}", DistinctOver(column), *PERIODS)
    extra = {
        "fea_voice_share_inc_count_03m": rolled_share("n_in", "n_all", 91),
        "fea_voice_share_inc_dur_03m": rolled_share("inc_call_dur", "dur", 91),
        "fea_voice_weeks_since_last_inc": weeks_since_last_activity("inc_call_dur", 11),
        "fea_voice_weeks_since_last_out": weeks_since_last_activity("out_call_dur", 11),
        **{f"fea_voice_idle_weeks_{e // 7}_to_{s // 7}": idle_weeks("dur", s, e) for s, e in BANDS},
    }
    out_df = period_features(df, fs, [*KEY, *(c.alias(n) for n, c in extra.items())])
    return out_df.withColumn("fea_voice_uniq_all_03m_third", F.col("fea_voice_uniq_all_03m") / 3)


def texts(weekly: DataFrame) -> DataFrame:
    """F3. weekly: A2 on the scaffold."""
    fs = FeatureSet()
    for n in ("inc", "out", "all"):
        fs.add(f"fea_text_sms_{n}_{{period}}", sum_over(f"count_sms_{n}"), *PERIODS)
        fs.add(f"fea_text_share_{n}_{{period}}", lambda p, days, n=n: share(F.sum(f"count_sms_{n}").over(rolling(days)), F.sum(f"count_voice_{n}").over(rolling(days))), "1m", "3m")
    extra = {"fea_text_weeks_since_last": weeks_since_last_activity("count_sms_all", 11), **{f"fea_text_idle_weeks_{e // 7}_to_{s // 7}": idle_weeks("count_sms_all", s, e) for s, e in BANDS}}
    return period_features(weekly, fs, [*KEY, *(c.alias(n) for n, c in extra.items())])


def commercial_texts(weekly: DataFrame, categories: list[str], periods: tuple[str, ...] = ("1w", "1m")) -> DataFrame:
    """F4. Rolling counts and distinct senders per category as columns. weekly: A4 filled by category."""
    days = [(p, period_days(p)) for p in periods]
    swept = distinct_over_window(weekly, {f"senders_{p}": ("senders_07d", n) for p, n in days}, ["msisdn", "category"])
    rolled = swept.select(*KEY, "category", *(F.sum("incoming_count_07d").over(rolling(n, extra=["category"])).alias(f"count_{p}") for p, n in days), *(f"senders_{p}" for p, _ in days))
    names = [f"{m}_{p}" for p in periods for m in ("count", "senders")]
    per = lambda c, n: F.max(F.when(F.col("category") == c, F.col(n))).alias(f"fea_comm_text_{c}_{n}")
    return rolled.groupBy(*KEY).agg(*(per(c, n) for c in categories for n in names))


def recharge(weekly: DataFrame) -> DataFrame:
    """F6. weekly: tot_amt, tot_trx and balance columns (A6, A7) on the scaffold."""
    fs = FeatureSet()
    fs.add("fea_rech_amt_{period}", sum_over("tot_amt"), *PERIODS).add("fea_rech_trx_{period}", sum_over("tot_trx"), *PERIODS)
    fs.add("fea_rech_amt_per_trx_{period}", division_of_sums("tot_amt", "tot_trx"), *PERIODS)
    fs.add("fea_rech_bal_min_{period}", min_over("min_balance"), *PERIODS).add("fea_rech_bal_avg_{period}", avg_over("avg_balance"), *PERIODS)
    fs.add("fea_rech_days_above_5k_{period}", sum_over("days_above_5k"), *PERIODS)
    topped = F.last(F.when(F.col("tot_trx") > 0, F.col("weekstart")), ignorenulls=True).over(rolling(-1))
    trend = F.try_divide(F.sum("tot_amt").over(rolling(28)).cast("double"), F.sum("tot_amt").over(rolling_fixed(56, 28)).cast("double"))
    return period_features(weekly, fs, [*KEY, F.datediff("weekstart", topped).alias("fea_rech_days_since_last"), trend.alias("fea_rech_trend_01m_to_02m")])


def recharge_by_channel(records: DataFrame, channels: list[str], periods: tuple[str, ...] = ("1m", "3m")) -> DataFrame:
    """F7. records: msisdn, weekstart, channel, amount. Sums by channel and the dominant one by value and by count."""
    one = records.withColumn("one", F.lit(1).cast("long"))
    sums = {n: c for i, k in enumerate(channels) for n, c in ((f"amt_{i}", F.coalesce(F.sum(F.when(F.col("channel") == k, F.col("amount"))), F.lit(0))), (f"trx_{i}", F.count_if(F.col("channel") == k)))}
    per = weeks_of_categories(one, "channel", "amount", "one", **sums)
    out = per.select(*KEY, "_own", *(F.sum(f"{m}_{i}").over(rolling(period_days(p))).alias(f"fea_rech_{m}_{i}_0{p}") for p in periods for i in range(len(channels)) for m in ("amt", "trx")))
    wanted = {f"fea_rech_dominant_by_{name}_0{p}": (period_days(p), name == "count") for p in periods for name in ("value", "count")}
    return dominant_categories(out, wanted, [c for c in out.columns if c.startswith("fea_")])


def app_revenue(records: DataFrame, periods: tuple[str, ...] = PERIODS) -> DataFrame:
    """F11. records: msisdn, weekstart, method, amount. Rolling sums of app revenue and the payment method of most value."""
    one = records.withColumn("one", F.lit(1).cast("long"))
    fs = FeatureSet().add("fea_app_rev_sum_{period}", sum_over("revenue"), *periods).add("fea_app_rev_trx_{period}", sum_over("trx"), *periods)
    out = period_features(weeks_of_categories(one, "method", "amount", "one", revenue=F.sum("amount"), trx=F.count("*")), fs, [*KEY, "_own"])
    wanted = {f"fea_app_rev_dominant_method_0{p}": (period_days(p), False) for p in periods}
    return dominant_categories(out, wanted, [c for c in out.columns if c.startswith("fea_")])


def revenue(weekly: DataFrame, services: list[str]) -> DataFrame:
    """F9. Sums by service and their total over periods. weekly: rev_<service>."""
    fs = FeatureSet()
    for s in services:
        fs.add(f"fea_rev_{s}_sum_{{period}}", sum_over(f"rev_{s}"), *PERIODS)
    return period_features(weekly, fs.add("fea_rev_tot_sum_{period}", sum_over([f"rev_{s}" for s in services]), *PERIODS), KEY)


def monthly_spend(weekly: DataFrame, services: list[str]) -> DataFrame:
    """F10. Minimum, maximum and mean over one and three months, the sum five to eight weeks back, range and trend."""
    fs = FeatureSet()
    for s in services:
        c = f"rev_{s}"
        fs.add(f"fea_spend_{s}_min_{{period}}", min_over(c), "1m", "3m").add(f"fea_spend_{s}_max_{{period}}", max_over(c), "1m", "3m").add(f"fea_spend_{s}_avg_{{period}}", avg_over(c), "1m", "3m")
    extra = {}
    for s in services:
        past, now = F.sum(f"rev_{s}").over(rolling_fixed(56, 28)), F.sum(f"rev_{s}").over(rolling(28))
        w = rolling(91)
        extra |= {f"fea_spend_{s}_past_5w_8w": past, f"fea_spend_{s}_trend": F.try_divide(now.cast("double"), past.cast("double")), f"fea_spend_{s}_range_03m": F.max(f"rev_{s}").over(w) - F.min(f"rev_{s}").over(w)}
    return period_features(weekly, fs, [*KEY, *(c.alias(n) for n, c in extra.items())])


def salary_shares(weekly: DataFrame, buckets: list[str]) -> DataFrame:
    """F12. Each day-of-month bucket's revenue of three months over all revenue of three months."""
    w = rolling(91)
    total = reduce(lambda a, b: a + b, (F.sum(b).over(w) for b in buckets))
    return weekly.select(*KEY, *(F.try_divide(F.sum(b).over(w).cast("double"), total.cast("double")).alias(f"fea_salary_{b}_03m") for b in buckets))


def spend_pattern(weekly: DataFrame, part: str, total: str) -> DataFrame:
    """F13, F15, F22. A part's share of a total over periods, days since last revenue, weeks since the part was last used."""
    last = F.last(F.when(F.col(total) > 0, F.col("weekstart")), ignorenulls=True).over(rolling(-1))
    shares = (rolled_share(part, total, period_days(p)).alias(f"fea_{part}_share_0{p}") for p in PERIODS if p != "1w")
    return weekly.select(*KEY, F.datediff("weekstart", last).alias("fea_days_since_last_rev"), weeks_since_last_activity(part, 11).alias(f"fea_weeks_since_last_{part}"), *shares)


def sums_over_list(weekly: DataFrame, columns: list[str], prefix: str, periods: tuple[str, ...] = PERIODS) -> DataFrame:
    """F14, F23, F26, F38. Rolling sums of a list of columns."""
    fs = FeatureSet()
    for c in columns:
        fs.add(f"fea_{prefix}_{c}_{{period}}", sum_over(c), *periods)
    return period_features(weekly, fs, KEY)


def internet_usage(weekly: DataFrame) -> DataFrame:
    """F16. weekly: A8."""
    fs = FeatureSet()
    for c in ("volume", "volume_weekend", "volume_weekday", "days_above_threshold"):
        fs.add(f"fea_int_{c}_{{period}}", sum_over(c), *PERIODS)
    fs.add("fea_int_min_{period}", min_over("min_volume"), *PERIODS).add("fea_int_max_{period}", max_over("max_volume"), *PERIODS)
    fs.add("fea_int_med_{period}", median_over("volume"), "1m", "3m").add("fea_int_std_{period}", stddev_over("volume"), "1m", "3m")
    return period_features(weekly, fs, [*KEY, rolled_share("volume_weekend", "volume", 28).alias("fea_int_weekend_share_01m")])


def app_usage(weekly: DataFrame, features: list[str], periods: tuple[str, ...] = ("1w", "1m", "3m")) -> DataFrame:
    """F18. Per category: volume, distinct apps, days since first and last use kept within -1 and 91; a column each. weekly: A10."""
    w = lambda p: rolling(period_days(p), extra=["feature"])
    ever = rolling(-1, extra=["feature"])
    clamp = lambda c: F.greatest(F.lit(-1), F.least(F.lit(91), F.coalesce(c, F.lit(-1))))
    swept = distinct_over_window(weekly, {f"apps_0{p}": ("apps", period_days(p)) for p in periods}, ["msisdn", "feature"])
    rolled = swept.select(
        *KEY,
        "feature",
        *(F.sum("volume").over(w(p)).alias(f"volume_0{p}") for p in periods),
        *(f"apps_0{p}" for p in periods),
        clamp(F.datediff("weekstart", F.min("first_date").over(ever))).alias("days_since_first"),
        clamp(F.datediff("weekstart", F.max("last_date").over(ever))).alias("days_since_last"),
    )
    names = [c for c in rolled.columns if c not in (*KEY, "feature")]
    return rolled.groupBy(*KEY).agg(*(F.max(F.when(F.col("feature") == f, F.col(n))).alias(f"fea_app_{f}_{n}") for f in features for n in names))


def connection(weekly: DataFrame, measures: list[str]) -> DataFrame:
    """F20. Ratio of rolling sums to rolling counts. weekly: A11, <measure>_sum and <measure>_count."""
    fs = FeatureSet()
    for m in measures:
        fs.add(f"fea_conn_{m}_{{period}}", division_of_sums(f"{m}_sum", f"{m}_count"), *PERIODS)
    return period_features(weekly, fs, KEY)


def competitor_apps(monthly: DataFrame, weeks: DataFrame, columns: list[str], sla_day: int = 10) -> DataFrame:
    """F21. Sums over one to three months, for each week those of the newest month delivered. monthly: msisdn, month, columns."""
    at = monthly.withColumn("month_mapped_dt", F.date_add(F.lit("2000-01-01").cast("date"), F.months_between("month", F.lit("2000-01-01").cast("date")).cast("int")))
    sums = at.select("msisdn", "month", *(F.sum(c).over(rolling(m, "msisdn", "month_mapped_dt")).alias(f"fea_comp_{c}_0{m}m") for c in columns for m in (1, 2, 3)))
    return weeks.select("weekstart").distinct().withColumn("month", sla_month("weekstart", sla_day)).join(sums, "month").drop("month")


def fixed_period_measures(weekly: DataFrame, measures: dict[str, Callable[[Column], Column]], periods: dict[str, tuple[str, str]], compared: tuple[str, ...] = ()) -> DataFrame:
    """F2, F5, F17, F19. One row per id: each measure over each of several fixed periods, and the ratios of those compared.

    A measure is an aggregate that is given the condition of being inside the period. periods: name -> (first, last
    weekstart), the first named is the base. Ratios are a / (a + b), null where either is 0 or not known.
    """
    inside = {n: F.col("weekstart").between(F.lit(a).cast("date"), F.lit(b).cast("date")) for n, (a, b) in periods.items()}
    out = weekly.groupBy("msisdn").agg(*(f(c).alias(f"fea_{m}_{n}") for m, f in measures.items() for n, c in inside.items()))
    base, *later = periods
    known = lambda m, n: F.when(F.col(f"fea_{m}_{n}") != 0, F.col(f"fea_{m}_{n}"))
    return out.withColumns({f"fea_{m}_ratio_{base}_{n}": known(m, base) / (known(m, base) + known(m, n)) for m in compared for n in later})


def within(of: Callable[[Column], Column], column: str, where: Column | None = None) -> Callable[[Column], Column]:
    """A measure: the aggregate of a column's values inside the period, where a condition holds."""
    return lambda inside: of(F.when(inside if where is None else inside & where, F.col(column)))


def voice_fixed_periods(weekly: DataFrame, periods: dict[str, tuple[str, str]]) -> DataFrame:
    """F2. weekly: seconds and numbers (array) on the scaffold. Seconds, weeks without calls, distinct numbers."""
    numbers = lambda inside: F.size(F.array_distinct(F.flatten(F.collect_list(F.when(inside, F.col("numbers"))))))
    idle = lambda inside: F.count_if(inside & (F.coalesce("seconds", F.lit(0)) == 0))
    return fixed_period_measures(weekly, {"voice_secs": within(F.sum, "seconds"), "voice_idle_weeks": idle, "voice_numbers": numbers}, periods, ("voice_secs",))


def internet_fixed_periods(weekly: DataFrame, periods: dict[str, tuple[str, str]]) -> DataFrame:
    """F17. weekly: volume and volume_weekend. Total, mean and deviation, weekend share, change of the mean, last volume against the base's mean."""
    m = {"int_sum": within(F.sum, "volume"), "int_avg": within(F.avg, "volume"), "int_std": within(F.stddev, "volume"), "int_weekend": within(F.sum, "volume_weekend"), "int_last": lambda _: F.max_by("volume", "weekstart")}
    out = fixed_period_measures(weekly, m, periods, ("int_sum", "int_avg"))
    base, *later = periods
    share = {f"fea_int_weekend_share_{n}": F.try_divide(F.col(f"fea_int_weekend_{n}").cast("double"), F.col(f"fea_int_sum_{n}").cast("double")) for n in periods}
    change = {f"fea_int_change_{base}_{n}": F.col(f"fea_int_avg_{n}") - F.col(f"fea_int_avg_{base}") for n in later}
    last = {"fea_int_last_ratio": F.col(f"fea_int_last_{base}") / (F.col(f"fea_int_last_{base}") + F.col(f"fea_int_avg_{base}"))}
    return out.withColumns(share | change | last).drop(*(f"fea_int_{m}_{n}" for n in periods for m in ("weekend", "last")))


def category_fixed_periods(weekly: DataFrame, categories: list[str], column: str, name: str, periods: dict[str, tuple[str, str]]) -> DataFrame:
    """F5, F19. weekly: category and a column. The column's sum per category and fixed period, pivoted, with ratios."""
    m = {f"{name}_{c}": within(F.sum, column, F.col("category") == c) for c in categories}
    return fixed_period_measures(weekly, m, periods, tuple(m))


def category_trend(weekly: DataFrame, column: str) -> DataFrame:
    """F19. Per id, week and category: the week's share of the last month's sum."""
    month = F.sum(column).over(rolling(28, extra=["category"]))
    return weekly.select(*KEY, "category", F.try_divide(F.col(column).cast("double"), month.cast("double")).alias(f"fea_{column}_trend"))


def fixed_period_compare(weekly: DataFrame, column: str, periods: dict[str, tuple[str, str]]) -> DataFrame:
    """F2, F5, F8, F17, F19, F24. Sum of a column in each of several fixed periods, and shares of the first against the later ones.

    periods: name -> (first, last weekstart), the first named is the base. A week gets a period's value once the period
    is over; within a running period it gets the sum so far; before it, null. Ratios are a / (a + b), null where either
    is 0 or not known.
    """
    inside = {n: F.col("weekstart").between(F.lit(a).cast("date"), F.lit(b).cast("date")) for n, (a, b) in periods.items()}
    sofar = Window.partitionBy("msisdn").orderBy("weekstart").rowsBetween(Window.unboundedPreceding, 0)
    out = weekly.select(*KEY, *(F.sum(F.when(c, F.col(column))).over(sofar).alias(f"fea_{column}_{n}") for n, c in inside.items()))
    base, *later = periods
    known = lambda n: F.when(F.col(f"fea_{column}_{n}") != 0, F.col(f"fea_{column}_{n}"))
    return out.withColumns({f"fea_{column}_ratio_{base}_{n}": share(known(base), known(n)) for n in later})


def products(weekly: DataFrame) -> DataFrame:
    """F25. weekly: msisdn, weekstart, product_list of [product, count, days] (A31).

    Products activated this week; those active (validity not over, from the last 13 weeks); whether the most used one
    changed; the most used product (ties to the greatest name); longest validity.
    """
    triples = F.col("product_list")
    best = F.array_max(F.transform(triples, lambda t: F.struct(F.element_at(t, 2).cast("long").alias("n"), F.element_at(t, 1).alias("p"))))["p"]
    dated = F.transform(triples, lambda t: F.struct(F.element_at(t, 1).alias("p"), F.date_add("weekstart", F.element_at(t, 3).cast("int")).alias("until")))
    df = weekly.withColumns({"best": best, "dated": dated})
    recent = F.flatten(F.collect_list("dated").over(rolling(91)))
    active = F.size(F.array_distinct(F.transform(F.filter("recent", lambda x: x["until"] >= F.col("weekstart")), lambda x: x["p"])))
    changed = F.coalesce(F.col("best") != F.lag("best").over(Window.partitionBy("msisdn").orderBy("weekstart")), F.lit(False)).cast("int")
    longest = F.array_max(F.transform(triples, lambda t: F.element_at(t, 3).cast("long")))
    rows = df.withColumns({"recent": recent, "changed": changed})
    return rows.select(*KEY, F.size(triples).alias("fea_prod_activated"), active.alias("fea_prod_active"), F.sum("changed").over(rolling(91)).alias("fea_prod_changes_03m"), F.col("best").alias("fea_prod_most_used"), longest.alias("fea_prod_max_validity"))


def devices(weekly: DataFrame) -> DataFrame:
    """F27. weekly: makers, imeis (A25). Last known maker before this week, distinct devices, changes, 14-digit imeis."""
    first = F.get("makers", F.lit(0))
    df = weekly.withColumn("maker", first)
    before = F.last("maker", ignorenulls=True).over(rows_frame(Window.unboundedPreceding, -1))
    changed = F.coalesce(F.col("maker") != before, F.lit(False)).cast("int")
    df = distinct_over_window(df.withColumn("changed", changed), {"fea_device_count_03m": ("imeis", 91)})
    return df.select(*KEY, before.alias("fea_device_last_maker"), "fea_device_count_03m", F.sum("changed").over(rolling(91)).alias("fea_device_changes_03m"), F.transform("imeis", lambda i: F.substring(i, 1, 14)).alias("fea_device_imeis"))


def device_modes(daily: DataFrame, weeks: int = 4) -> DataFrame:
    """F29. daily: msisdn, weekstart, tac, maker. Per id and week: the most frequent of either in the week and in the last
    weeks up to it (ties to the smaller), and how many ids have the week's.

    Rows are dealt by id once, and both columns are counted in one pass; a week's sums are handed to the weeks whose window
    they fall into within the task that has the id.
    """
    columns, kinds = ("tac", "maker"), dict(daily.dtypes)
    none = {c: F.lit(None).cast(kinds[c]).alias(c) for c in columns}
    one = lambda t: F.struct(F.lit(t).alias("t"), *(F.col(c).alias(c) if columns[t : t + 1] == (c,) else none[c] for c in columns))
    # The third entry holds the week itself, also where neither column is known.
    each = daily.select(*KEY, *columns).repartition("msisdn").select(*KEY, F.explode(F.array(one(0), one(1), one(2))).alias("_x")).select(*KEY, "_x.*")
    n = each.groupBy(*KEY, "t", *columns).agg(F.count("*").alias("n"))
    ahead = n.withColumn("_age", F.explode(F.sequence(F.lit(0), F.lit(weeks - 1)))).withColumn("weekstart", F.expr("date_add(weekstart, 7 * _age)"))
    sums = ahead.groupBy(*KEY, "t", *columns).agg(F.sum("n").alias("_all"), F.sum(F.when(F.col("_age") == 0, F.col("n"))).alias("_own"))
    mode = lambda t, s: F.min(F.when((F.col("t") == t) & F.col(s).isNotNull() & F.col(columns[t]).isNotNull(), F.struct((-F.col(s)).alias("n"), F.col(columns[t]).alias("c"))))["c"]
    modes = {f"fea_device_{c}_mode_{p}w": mode(t, s) for t, c in enumerate(columns) for p, s in (("01", "_own"), (f"{weeks:02d}", "_all"))}
    out = sums.groupBy(*KEY).agg(F.max("_own").alias("_here"), *(m.alias(name) for name, m in modes.items())).filter("_here is not null").drop("_here")
    for t, c in enumerate(columns):
        known = n.filter((F.col("t") == t) & F.col(c).isNotNull())
        ids = known.groupBy("weekstart", F.col(c).alias(f"fea_device_{c}_mode_01w")).agg(F.count("*").alias(f"fea_device_same_{c}_ids"))
        out = out.join(ids, ["weekstart", f"fea_device_{c}_mode_01w"], "left")
    return out


def shared_devices(weekly: DataFrame, counts: DataFrame, sla_day: int = 10) -> DataFrame:
    """F28. Most ids that share one of an id's imeis, by the newest month delivered. counts: imei, month, ids."""
    each = weekly.select(*KEY, F.explode("imeis").alias("imei")).withColumn("month", sla_month("weekstart", sla_day))
    return each.join(counts, ["imei", "month"], "left").groupBy(*KEY).agg(F.max("ids").alias("fea_device_max_ids"))


def length_of_service(weekly: DataFrame) -> DataFrame:
    """F30. Days since activation, the date filled from 12 rows back, then from 12 ahead; null where it would be negative."""
    back = F.last("activation_date", ignorenulls=True).over(rows_frame(-12, 0))
    ahead = F.first("activation_date", ignorenulls=True).over(rows_frame(0, 12))
    days = F.datediff("weekstart", F.coalesce(back, ahead))
    return weekly.select(*KEY, F.when(days >= 0, days).alias("fea_los_days"))


def loyalty_points(daily: DataFrame) -> DataFrame:
    """F31. Points earned and used over 30 and 90 days from the sign of the daily difference. daily: msisdn, event_date, points."""
    step = F.col("points") - F.lag("points").over(Window.partitionBy("msisdn").orderBy("event_date"))
    df = daily.withColumn("step", F.coalesce(step, F.lit(0)))
    cols = [F.sum(F.when(F.col("step") > 0, F.col("step")).otherwise(0)).over(rolling(n, "msisdn", "event_date")).alias(f"fea_points_earned_{n}d") for n in (30, 90)]
    cols += [F.sum(F.when(F.col("step") < 0, -F.col("step")).otherwise(0)).over(rolling(n, "msisdn", "event_date")).alias(f"fea_points_used_{n}d") for n in (30, 90)]
    return df.select("msisdn", "event_date", *cols)


def activation_outlet(weekly: DataFrame) -> DataFrame:
    """F31. The outlet last known within six months."""
    return weekly.select(*KEY, F.last("outlet_id", ignorenulls=True).over(rolling(182)).alias("fea_custprof_activation_outlet_06m"))


def network_kpis(weekly: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """F32. Rolling means per id, cell or area."""
    return weekly.select(key, "weekstart", *((F.col(c) if p == "1w" else F.avg(c).over(rolling(period_days(p), key))).alias(f"fea_network_{c}_0{p}") for c in columns for p in PERIODS))


def benchmark(weekly: DataFrame, own: str, other: str, percentiles: list[str]) -> DataFrame:
    """F33. weekly: A27. Rolling means, and the first own percentile that beats the competitor's mean (null if none does)."""
    beats = F.coalesce(*(F.when(F.col(f"{own}_{p}") > F.col(f"{other}_avg"), F.lit(p)) for p in percentiles))
    return weekly.select("location", "weekstart", F.avg(f"{own}_avg").over(rolling(28, "location")).alias("fea_bench_own_avg_01m"), F.avg(f"{other}_avg").over(rolling(28, "location")).alias("fea_bench_other_avg_01m"), beats.alias("fea_bench_first_better"))


def map_location_features(ids: DataFrame, features: DataFrame) -> DataFrame:
    """F34. By location and week."""
    return ids.join(features, ["location", "weekstart"])


def loan_notifications(events: DataFrame, steps: list[str], periods: tuple[str, ...] = PERIODS) -> DataFrame:
    """F35. events: msisdn, weekstart, step, one row a notification. Rolling sums of notifications of each step."""
    weekly = events.groupBy(*KEY).agg(*(F.count_if(F.col("step") == s).alias(f"notifications_{s}") for s in steps))
    return sums_over_list(weekly, [f"notifications_{s}" for s in steps], "loan", periods)


def loans(weekly: DataFrame) -> DataFrame:
    """F35. weekly: A20. Distinct offers sent and accepted over periods, and mean days from offer to acceptance of the same campaign."""
    names = lambda c: F.array_distinct(F.transform(c, lambda x: x["campaign"]))
    df = weekly.withColumns({"sent": names("offers"), "accepted": names("taken")})
    fs = FeatureSet()
    for n in ("sent", "accepted"):
        fs.add(f"fea_loan_offers_{n}_{{period}}", DistinctOver(n), "1w", "1m", "3m")
    out = period_features(df, fs, KEY)
    o = weekly.select("msisdn", F.explode("offers").alias("o")).groupBy("msisdn", F.col("o.campaign").alias("campaign")).agg(F.min("o.event_date").alias("offered"))
    t = weekly.select(*KEY, F.explode("taken").alias("t")).select(*KEY, F.col("t.campaign").alias("campaign"), F.col("t.event_date").alias("at"))
    days = t.join(o, ["msisdn", "campaign"]).filter("at >= offered").groupBy(*KEY).agg(F.max(F.datediff("at", "offered")).alias("days"))
    rolled = out.join(days, KEY, "left")
    return rolled.withColumn("fea_loan_takeup_days_03m", F.avg("days").over(rolling(91))).drop("days")


def triggered_offers(weekly: DataFrame, balance: DataFrame, limit: int = 500) -> DataFrame:
    """F36. Distinct offers of weeks whose lowest balance is at most a limit, over three months."""
    joined = weekly.join(balance.select(*KEY, "min_balance"), KEY, "left")
    sent = F.when(F.col("min_balance") <= limit, F.transform("offers", lambda x: x["campaign"])).otherwise(F.array().cast("array<string>"))
    return distinct_over_window(joined.withColumn("sent", sent), {"fea_loan_triggered_offers_03m": ("sent", 91)}).select(*KEY, "fea_loan_triggered_offers_03m")


def first_steps(weekly: DataFrame, recharges: DataFrame) -> DataFrame:
    """F36. Per id: first offer, days to the first acceptance on or after it (same campaign prefix) and to the first recharge."""
    prefix = lambda c: F.regexp_extract(c, r"^([A-Za-z]+_[A-Za-z0-9]+)", 1)
    o = weekly.select("msisdn", F.explode("offers").alias("x")).groupBy("msisdn").agg(F.min("x").alias("o"))
    o = o.select("msisdn", F.col("o.event_date").alias("offered"), prefix("o.campaign").alias("prefix"))
    t = weekly.select("msisdn", F.explode("taken").alias("x")).select("msisdn", F.col("x.event_date").alias("at"), prefix("x.campaign").alias("p"))
    accepted = o.join(t, "msisdn").filter("at >= offered and p = prefix").groupBy("msisdn").agg(F.min("at").alias("accepted"))
    refilled = o.join(recharges.select("msisdn", "event_date"), "msisdn").filter("event_date >= offered").groupBy("msisdn").agg(F.min("event_date").alias("refilled"))
    joined = o.join(accepted, "msisdn", "left").join(refilled, "msisdn", "left")
    return joined.select("msisdn", "offered", F.datediff("accepted", "offered").alias("days_to_accept"), F.datediff("refilled", "offered").alias("days_to_recharge"))


def recharge_gaps(weekly: DataFrame, recharges: DataFrame, periods: tuple[str, ...] = PERIODS) -> DataFrame:
    """F36. By id and week: mean days, over periods, from a week's first offer to the first recharge on or after it, of weeks in
    which no offer of theirs was accepted before that recharge. weekly: A20; recharges: msisdn, event_date.

    What comes first after an offer is found in ordered passes over offers and events together, without a join by date.
    """
    offers = weekly.select(*KEY, F.explode("offers").alias("o")).select(*KEY, F.col("o.campaign").alias("campaign"), F.col("o.event_date").alias("at"))
    ahead = lambda *keys: Window.partitionBy(*keys).orderBy(F.unix_date("at")).rangeBetween(0, Window.unboundedFollowing)
    none = F.lit(None).cast("date")
    taken = weekly.select("msisdn", F.lit(None).cast("date").alias("weekstart"), F.explode("taken").alias("t")).select("msisdn", "weekstart", F.col("t.campaign").alias("campaign"), F.col("t.event_date").alias("at"), F.col("t.event_date").alias("accepted"))
    both = offers.withColumn("accepted", none).unionByName(taken)
    accepted = both.withColumn("accepted", F.min("accepted").over(ahead("msisdn", "campaign"))).filter("weekstart is not null")
    first = accepted.groupBy(*KEY).agg(F.min("at").alias("at"), F.min("accepted").alias("accepted"))
    refills = recharges.select("msisdn", none.alias("weekstart"), F.col("event_date").alias("at"), none.alias("accepted"), F.col("event_date").alias("refilled"))
    every = first.withColumn("refilled", none).unionByName(refills)
    met = every.withColumn("refilled", F.min("refilled").over(ahead("msisdn"))).filter("weekstart is not null")
    gap = F.when(F.col("accepted").isNull() | (F.col("accepted") > F.col("refilled")), F.datediff("refilled", "at"))
    rows = weekly.select(*KEY).join(met.select(*KEY, gap.alias("gap")), KEY, "left")
    return period_features(rows, FeatureSet().add("fea_loan_recharge_gap_{period}", avg_over("gap"), *periods), KEY)


def repayment_means(weeks: DataFrame, repaid: DataFrame, periods: tuple[str, ...] = ("1m", "2m", "3m")) -> DataFrame:
    """F37. By id and week: mean days to repay over periods. weeks: msisdn, weekstart; repaid: F37's repayments."""
    per = repaid.groupBy("msisdn", next_week_start("event_date").alias("weekstart")).agg(F.sum("days_to_repay").alias("days"), F.count("days_to_repay").alias("n"))
    rows = weeks.select(*KEY).join(per, KEY, "left")
    return period_features(rows, FeatureSet().add("fea_loan_repay_days_{period}", division_of_sums("days", "n"), *periods), KEY)


def repayments(taken: DataFrame, repaid: DataFrame) -> DataFrame:
    """F37. Each repayment with its loan: the first after the repayment before, else the latest on or before it.

    taken, repaid: msisdn, event_date, trx_id. One ordered pass over the union of both, no join: within the stretch that
    a repayment ends, the first loan; over all earlier rows, the last one.
    """
    every = taken.select("msisdn", "event_date", "trx_id", F.lit(0).alias("is_repayment")).union(repaid.select("msisdn", "event_date", "trx_id", F.lit(1)))
    order = Window.partitionBy("msisdn").orderBy("event_date", "is_repayment", "trx_id")
    stretch = F.coalesce(F.sum("is_repayment").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    loan = F.when(F.col("is_repayment") == 0, F.col("event_date"))
    inside = Window.partitionBy("msisdn", "stretch").orderBy("event_date", "is_repayment", "trx_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = every.withColumn("stretch", stretch).withColumns({"first_in": F.first(loan, ignorenulls=True).over(inside), "last_before": F.last(loan, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))})
    found = F.coalesce("first_in", "last_before")
    return rows.filter("is_repayment = 1").select("msisdn", "trx_id", "event_date", found.alias("loan_date"), F.datediff("event_date", found).alias("days_to_repay"))


def unpaid_loans(taken: DataFrame, repaid: DataFrame) -> DataFrame:
    """F37. Loans with no repayment since the loan before."""
    every = taken.select("msisdn", "event_date", "trx_id", F.lit(1).alias("is_loan")).union(repaid.select("msisdn", "event_date", "trx_id", F.lit(0)))
    order = Window.partitionBy("msisdn").orderBy("event_date", "is_loan", "trx_id")
    rows = every.withColumn("before", F.lag("is_loan").over(order))
    return rows.filter("is_loan = 1").select("msisdn", "trx_id", "event_date", (F.coalesce("before", F.lit(0)) == 1).cast("int").alias("without_repayment"))


def proxy_target(loans_taken: DataFrame, repaid: DataFrame, non_loan: DataFrame) -> DataFrame:
    """F39. Per loan: repaid within the month and 93 days (flag), and non-loan revenue + amount * flag + 0.08 * amount * (flag - 1).

    loans_taken: msisdn, trx_id, event_date, weekstart, amount. repaid: msisdn, event_date. non_loan: msisdn, weekstart, revenue.
    """
    until = F.date_add(F.last_day("l.event_date"), 93)
    on = (F.col("l.msisdn") == F.col("r.msisdn")) & (F.col("r.event_date") >= F.col("l.event_date")) & (F.col("r.event_date") <= until)
    hit = loans_taken.alias("l").join(repaid.alias("r"), on, "left_semi").select("trx_id", F.lit(1).alias("flag"))
    joined = loans_taken.join(hit, "trx_id", "left").join(non_loan, KEY, "left").withColumns({"flag": F.coalesce("flag", F.lit(0)), "revenue": F.coalesce("revenue", F.lit(0))})
    return joined.select("msisdn", "trx_id", "flag", (F.col("revenue") + F.col("amount") * F.col("flag") + 0.08 * F.col("amount") * (F.col("flag") - 1)).alias("target"))


def balance_measures(weekly: DataFrame, bands: list[str]) -> DataFrame:
    """F6. Deviation of the mean balance, and days in each band over periods. weekly: A7 on the scaffold."""
    fs = FeatureSet().add("fea_rech_bal_std_{period}", stddev_over("avg_balance"), "1m", "3m")
    for b in bands:
        fs.add(f"fea_rech_days_{b}_{{period}}", sum_over(f"days_{b}"), *PERIODS)
    return period_features(weekly, fs, KEY)


def internet_day_night(weekly: DataFrame) -> DataFrame:
    """F16. weekly: volume_day, volume_night, volume and cities (array). Sums, distinct cities, and the night's share of a month."""
    fs = FeatureSet()
    for c in ("volume_day", "volume_night"):
        fs.add(f"fea_int_{c}_{{period}}", sum_over(c), *PERIODS)
    fs.add("fea_int_cities_{period}", DistinctOver("cities"), *PERIODS)
    return period_features(weekly, fs, [*KEY, rolled_share("volume_night", "volume", 28).alias("fea_int_night_share_01m")])


def app_quality(weekly: DataFrame, features: list[str], periods: tuple[str, ...] = ("1w", "1m", "3m")) -> DataFrame:
    """F18. Per category: mean latency, volume a second of use, seconds of use, 4G volume by kind of day; a column each. weekly: A10."""
    total = lambda c, p: F.sum(c).over(rolling(period_days(p), extra=["feature"]))
    mean = lambda a, b, p: F.try_divide(total(a, p).cast("double"), total(b, p).cast("double"))
    measures = {
        "latency": lambda p: mean("latency_sum", "n_latency", p),
        "speed": lambda p: mean("volume", "duration", p),
        **{c: lambda p, c=c: total(c, p) for c in ("duration", "volume_4g_weekday", "volume_4g_weekend")},
    }
    rolled = weekly.select(*KEY, "feature", *(f(p).alias(f"{m}_0{p}") for m, f in measures.items() for p in periods))
    names = [c for c in rolled.columns if c not in (*KEY, "feature")]
    return rolled.groupBy(*KEY).agg(*(F.max(F.when(F.col("feature") == f, F.col(n))).alias(f"fea_app_{f}_{n}") for f in features for n in names))


def product_measures(weekly: DataFrame, names: list[str], periods: tuple[str, ...] = ("1w", "1m", "3m")) -> DataFrame:
    """F25. weekly as in products. Activations of each product named; shortest, longest and mean validity over periods."""
    triples = F.col("product_list")
    count = lambda name: F.aggregate(F.filter(triples, lambda t: F.element_at(t, 1) == name), F.lit(0).cast("long"), lambda a, t: a + F.element_at(t, 2).cast("long"))
    days = F.transform(triples, lambda t: F.element_at(t, 3).cast("long"))
    total = F.aggregate("days", F.lit(0).cast("long"), lambda a, x: a + x)
    df = weekly.withColumns({"days": days, **{f"n_{i}": count(n) for i, n in enumerate(names)}})
    df = df.withColumns({"lo": F.array_min("days"), "hi": F.array_max("days"), "total": total, "kinds": F.size("days").cast("long")})
    fs = FeatureSet()
    for i, n in enumerate(names):
        fs.add(f"fea_prod_{n.lower()}_{{period}}", sum_over(f"n_{i}"), *periods)
    fs.add("fea_prod_validity_min_{period}", min_over("lo"), *periods).add("fea_prod_validity_max_{period}", max_over("hi"), *periods)
    return period_features(df, fs.add("fea_prod_validity_avg_{period}", division_of_sums("total", "kinds"), *periods), KEY)


def device_attributes(weekly: DataFrame, attributes: list[str]) -> DataFrame:
    """F27. Last known value of each attribute (maker, name, type) before this week."""
    return weekly.select(*KEY, *(F.last(c, ignorenulls=True).over(rows_frame(Window.unboundedPreceding, -1)).alias(f"fea_device_last_{c}") for c in attributes))


def profile(weekly: DataFrame, demography: list[str]) -> DataFrame:
    """F31. weekly: expiry_date, is_new, points and demography. Days to the expiry; over six months whether newly sold,
    and sum, mean, least and most points; demography last known."""
    half = rolling(182)
    points = {n: f("points").over(half).alias(f"fea_custprof_points_{n}_06m") for n, f in (("sum", F.sum), ("avg", F.avg), ("min", F.min), ("max", F.max))}
    known = (F.last(c, ignorenulls=True).over(rolling(-1)).alias(f"fea_custprof_{c}") for c in demography)
    return weekly.select(*KEY, F.datediff("expiry_date", "weekstart").alias("fea_custprof_days_to_expiry"), F.max("is_new").over(half).alias("fea_custprof_is_new_06m"), *points.values(), *known)


def signal_shares(weekly: DataFrame, grades: list[str], periods: tuple[str, ...] = ("1m", "3m")) -> DataFrame:
    """F33. weekly: location, weekstart and a column per grade of signal. Each grade's share of all over periods."""
    total = lambda c, p: F.sum(c).over(rolling(period_days(p), "location"))
    whole = lambda p: reduce(lambda a, b: a + b, (F.coalesce(total(g, p), F.lit(0)) for g in grades))
    return weekly.select("location", "weekstart", *(F.try_divide(F.coalesce(total(g, p), F.lit(0)).cast("double"), whole(p).cast("double")).alias(f"fea_network_{g}_share_0{p}") for g in grades for p in periods))
