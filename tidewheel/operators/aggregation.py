"""Daily records to (id, weekstart) or (id, month): conditional sums, lists, stages and lookups.

Records carry msisdn, event_date and weekstart. Every function groups once per stage; combined sums happen before the
shuffle. Picks of one row have a total order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEEK = ["msisdn", "weekstart"]


def sum_where(condition: Column, value: Column | str) -> Column:
    """Sum of the value over rows that meet the condition; 0 where none does."""
    return F.coalesce(F.sum(F.when(condition, F.col(value) if isinstance(value, str) else value)), F.lit(0))


def is_weekend(date: str = "event_date") -> Column:
    return F.weekday(date) >= 5


def voice_weekly(calls: DataFrame) -> DataFrame:
    """A1. calls: msisdn, weekstart, direction (in, out), duration, hour, party."""
    into, out = F.col("direction") == "in", F.col("direction") == "out"
    numbers = lambda c: F.array_sort(F.collect_list(F.when(c, F.col("party"))))
    return calls.groupBy(*WEEK).agg(
        sum_where(into, "duration").alias("inc_call_dur"),
        sum_where(out, "duration").alias("out_call_dur"),
        sum_where(F.col("hour") < 5, "duration").alias("tot_dur_12_5_am"),
        numbers(into).alias("inc_call_nums"),
        numbers(out).alias("out_call_nums"),
        numbers(into | out).alias("inc_out_call_nums"),
    )


def text_weekly(records: DataFrame) -> DataFrame:
    """A2. records: msisdn, weekstart, service (sms, voice), direction, trx. Six conditional transaction counts."""
    cols = []
    for service in ("sms", "voice"):
        of = F.col("service") == service
        cols += [sum_where(of & (F.col("direction") == d), "trx").alias(f"count_{service}_{n}") for d, n in (("in", "inc"), ("out", "out"))]
        cols.append(sum_where(of, "trx").alias(f"count_{service}_all"))
    return records.groupBy(*WEEK).agg(*cols)


def decode_hex_sender(sender: str) -> Column:
    """A3. Senders in hexadecimal with ``:;<=>?`` for A to F, to text; the last digit of an odd length is dropped.

    Senders that start with 628, and what is no hexadecimal, stay.
    """
    c = F.col(sender)
    digits = F.translate(F.substring(c, F.lit(1), F.length(c) - F.pmod(F.length(c), F.lit(2))), ":;<=>?", "ABCDEF")
    hexadecimal = digits.rlike("^([0-9A-Fa-f]{2})+$")
    return F.when(c.startswith("628") | ~hexadecimal, c).otherwise(F.decode(F.unhex(F.when(hexadecimal, digits)), "UTF-8"))


def commercial_weekly(texts: DataFrame, senders: DataFrame, broken: DataFrame, tax_sender: str) -> DataFrame:
    """A4. texts: msisdn, weekstart, sender, incoming. senders: sender, category. broken: number, sender.

    Category by three lookups in order: the decoded sender, the same without its first character, the map of broken
    numbers. Texts without one are left out.
    """
    decoded = texts.withColumn("name", F.lower(decode_hex_sender("sender"))).withColumn("short", F.substring("name", 2, 1000))
    known = senders.select(F.lower("sender").alias("k"), "category").groupBy("k").agg(F.min("category").alias("category"))
    fixed = broken.join(senders.groupBy("sender").agg(F.min("category").alias("category")), "sender").groupBy(F.lower("number").alias("k3")).agg(F.min("category").alias("c3"))
    joined = decoded.join(known.withColumnsRenamed({"k": "k1", "category": "c1"}), F.col("name") == F.col("k1"), "left")
    joined = joined.join(known.withColumnsRenamed({"k": "k2", "category": "c2"}), F.col("short") == F.col("k2"), "left")
    joined = joined.join(fixed, F.col("name") == F.col("k3"), "left").withColumn("category", F.coalesce("c1", "c2", "c3"))
    return joined.filter("category is not null").groupBy(*WEEK, "category").agg(
        F.array_sort(F.collect_set("name")).alias("senders_07d"), F.sum("incoming").alias("incoming_count_07d"), sum_where(F.col("name") == tax_sender, "incoming").alias("count_txt_tax")
    )


def ids_with_sender(weekly: DataFrame, name: str) -> DataFrame:
    """A5."""
    return weekly.filter(F.array_contains("senders_07d", name)).select("msisdn").distinct()


def recharge_weekly(records: DataFrame) -> DataFrame:
    """A6. Totals of amount and transactions."""
    return records.groupBy(*WEEK).agg(F.sum("amount").alias("tot_amt"), F.count("*").alias("tot_trx"))


def recharge_by_channel_weekly(records: DataFrame, channels: list[str]) -> DataFrame:
    """A6. Totals by channel, one column pair each."""
    cols = [c for i, name in enumerate(channels) for c in (sum_where(F.col("channel") == name, "amount").alias(f"tot_amt_{i}"), F.count_if(F.col("channel") == name).alias(f"tot_trx_{i}"))]
    return records.groupBy(*WEEK).agg(*cols)


def package_purchases_weekly(records: DataFrame, types: list[str]) -> DataFrame:
    """A6. records: msisdn, weekstart, product, amount. Amount and purchases of packages, in all and by type."""
    of = lambda t: F.col("product") == t
    by = (c for t in types for c in (sum_where(of(t), "amount").alias(f"{t.lower()}_amt"), F.count_if(of(t)).alias(f"{t.lower()}_trx")))
    return records.groupBy(*WEEK).agg(F.sum("amount").alias("all_amt"), F.count("*").alias("all_trx"), *by)


def balance_weekly(balances: DataFrame, recharges: DataFrame) -> DataFrame:
    """A7. balances: msisdn, weekstart, event_date, seq, balance. recharges: msisdn, event_date.

    Minimum, mean, deviation and last balance; days at or under zero; days of the day's last balance in bands; last date
    above and below 5000; mean balance of the day before a recharge.
    """
    last = F.row_number().over(Window.partitionBy("msisdn", "event_date").orderBy(F.col("seq").desc()))
    before = F.lag("balance").over(Window.partitionBy("msisdn").orderBy("event_date", "seq"))
    refill = recharges.select("msisdn", "event_date").distinct().withColumn("refill", F.lit(True))
    rows = balances.withColumn("n", last).withColumn("before", before).join(refill, ["msisdn", "event_date"], "left").withColumn("final", F.when(F.col("n") == 1, F.col("balance")))
    days = {"above_5k": F.col("final") > 5000, "above_10k": F.col("final") > 10000, "above_20k": F.col("final") > 20000, "below_500": F.col("final") < 500, "5k_to_10k": F.col("final").between(5000, 10000)}
    return rows.groupBy(*WEEK).agg(
        F.min("balance").alias("min_balance"),
        F.avg("balance").alias("avg_balance"),
        F.stddev("balance").alias("stddev_balance"),
        F.count_if(F.col("balance") <= 0).alias("zero_or_neg_count"),
        F.max_by("balance", F.struct("event_date", "seq")).alias("last_balance"),
        *(F.count_if(c).alias(f"days_{n}") for n, c in days.items()),
        F.max(F.when(F.col("final") > 5000, F.col("event_date"))).alias("last_date_above_5k"),
        F.max(F.when(F.col("final") <= 5000, F.col("event_date"))).alias("last_date_below_5k"),
        F.avg(F.when(F.col("refill"), F.col("before"))).alias("avg_balance_before_recharge"),
        F.array_sort(F.collect_set(F.when(F.col("refill"), F.col("event_date")))).alias("recharge_dates"),
    )


def internet_weekly(usage: DataFrame) -> DataFrame:
    """A8. Days first, then weeks. usage: msisdn, weekstart, event_date, volume, city."""
    daily = usage.groupBy(*WEEK, "event_date").agg(F.sum("volume").alias("volume"), F.collect_set("city").alias("cities"))
    weekend = F.coalesce(is_weekend(), F.lit(False))
    return daily.groupBy(*WEEK).agg(
        F.sum("volume").alias("volume"),
        F.min("volume").alias("min_volume"),
        F.percentile("volume", 0.5).alias("med_volume"),
        F.max("volume").alias("max_volume"),
        F.stddev("volume").alias("stddev_volume"),
        sum_where(weekend, "volume").alias("volume_weekend"),
        sum_where(~weekend, "volume").alias("volume_weekday"),
        F.count_if(F.col("volume") > 10_000).alias("days_above_threshold"),
        F.size(F.array_distinct(F.flatten(F.collect_set("cities")))).cast("long").alias("n_cities"),
        (7 - F.count("*")).alias("days_without_usage"),
    )


def day_night_weekly(usage: DataFrame, night: tuple[int, int] = (0, 5)) -> DataFrame:
    """A8. usage: msisdn, weekstart, hour, volume, city. Volume in the hours of the night and outside them, and the cities."""
    dark = F.col("hour").between(*night)
    return usage.groupBy(*WEEK).agg(F.sum("volume").alias("volume"), sum_where(~dark, "volume").alias("volume_day"), sum_where(dark, "volume").alias("volume_night"), F.array_sort(F.collect_set("city")).alias("cities"))


WILDCARDS = ["iab_tier1", "iab_tier2", "iab_content_channel", "iab_content_media_format", "iab_content_type"]


def app_mapping(content: DataFrame, segments: DataFrame, attributes: list[str] = WILDCARDS, app: str = "accessed_app") -> DataFrame:
    """A9. accessed_app, feature: content joined with segment rules in which a null attribute matches anything.

    Rules that name the same attributes are one equi join on them; there are at most as many joins as sets of attributes
    that the rules name. A rule that names none matches every app.
    """
    names = [app, *attributes]
    given = segments.select("segment", *(F.col(n).alias(f"_{n}") for n in names), F.concat(*(F.col(n).isNotNull().cast("int").cast("string") for n in names)).alias("_given"))
    found = None
    for row in given.select("_given").distinct().orderBy("_given").collect():  # at most 2 ** len(names) rows
        rules = given.filter(F.col("_given") == row["_given"])
        on = [content[n] == rules[f"_{n}"] for n, known in zip(names, row["_given"], strict=True) if known == "1"]
        joined = content.join(rules, on) if on else content.crossJoin(rules.select("segment").distinct())
        part = joined.select(content[app].alias(app), F.lower("segment").alias("feature"))
        found = part if found is None else found.union(part)
    return content.select(app, F.lit("").alias("feature")).limit(0) if found is None else found.distinct()


def app_usage_weekly(usage: DataFrame, mapping: DataFrame) -> DataFrame:
    """A10. usage: msisdn, weekstart, event_date, app, volume, duration, fast, latency. mapping: app, feature."""
    weekend = is_weekend()
    return usage.join(mapping, "app").groupBy(*WEEK, "feature").agg(
        F.sum("volume").alias("volume"),
        F.array_sort(F.collect_set("app")).alias("apps"),
        sum_where(F.col("fast") & weekend, "volume").alias("volume_4g_weekend"),
        sum_where(F.col("fast") & ~weekend, "volume").alias("volume_4g_weekday"),
        F.sum("duration").alias("duration"),
        F.count_if(F.col("duration") > 0).alias("n_timed"),
        F.sum("latency").alias("latency_sum"),
        F.count("latency").alias("n_latency"),
        F.min("event_date").alias("first_date"),
        F.max("event_date").alias("last_date"),
    )


def connection_weekly(usage: DataFrame, measures: list[str], radios: list[str]) -> DataFrame:
    """A11. Sum and count of each measure by radio type and weekday or weekend."""
    cols = []
    for m in measures:
        for r in radios:
            for name, day in (("weekdays", ~is_weekend()), ("weekends", is_weekend())):
                of = (F.col("radio") == r) & day
                cols += [sum_where(of, m).alias(f"{m}_{r}_{name}_sum"), F.count(F.when(of, F.col(m))).alias(f"{m}_{r}_{name}_count")]
    return usage.groupBy(*WEEK).agg(*cols)


def competitor_monthly(usage: DataFrame, apps: list[str], sites: list[str]) -> DataFrame:
    """A12. Visits and payload of listed apps and sites per month. usage: msisdn, event_date, app, site, trx, payload."""
    on_app, on_site = F.lower("app").isin(apps), F.lower("site").isin(sites)
    return usage.groupBy("msisdn", F.date_format("event_date", "yyyy-MM").alias("mo_id")).agg(
        sum_where(on_site, "trx").alias("comp_websites_visits"),
        sum_where(on_site, "payload").alias("comp_websites_consumption"),
        sum_where(on_app | on_site, "trx").alias("comp_apps_websites_visits"),
        sum_where(on_app | on_site, "payload").alias("comp_apps_websites_consumption"),
    )


def revenue_weekly(sources: list[DataFrame], thresholds: list[int]) -> DataFrame:
    """A13. Sources of msisdn, weekstart, event_date, service, amount are united and summed by day, then by week.

    Per service the sum and the days in bands between thresholds.
    """
    every = sources[0]
    for s in sources[1:]:
        every = every.unionByName(s)
    services = ["voice", "data", "sms"]
    daily = every.groupBy(*WEEK, "event_date").agg(*(sum_where(F.col("service") == s, "amount").alias(s) for s in services), F.sum("amount").alias("tot"))
    bands = list(zip(thresholds, [*thresholds[1:], None], strict=True))
    day_counts = [F.count_if((F.col(s) >= lo) & (F.col(s) < hi) if hi else F.col(s) >= lo).alias(f"days_{s}_{lo}") for s in (*services, "tot") for lo, hi in bands]
    return daily.groupBy(*WEEK).agg(*(F.sum(s).alias(f"rev_{s}") for s in (*services, "tot")), *day_counts)


def days_since_last(records: DataFrame, column: str = "amount") -> DataFrame:
    """A14. Per day with records: days since the last day with revenue, 0 on such a day, null before the first."""
    daily = records.groupBy("msisdn", "event_date").agg(F.sum(column).alias("v"))
    active = F.when(F.col("v") > 0, F.col("event_date"))
    upto = Window.partitionBy("msisdn").orderBy("event_date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select("msisdn", "event_date", F.datediff("event_date", F.last(active, ignorenulls=True).over(upto)).alias("days_since_last_rev"))


#: The day-of-month buckets of salary windows.
SALARY_BUCKETS = ((1, 5), (6, 10), (11, 15), (16, 20), (21, 25), (26, 31))


def salary_weekly(records: DataFrame) -> DataFrame:
    """A15. Revenue in buckets of the day of the month."""
    day = F.dayofmonth("event_date")
    return records.groupBy(*WEEK).agg(*(sum_where(day.between(a, b), "amount").alias(f"rev_{a}_{b}") for a, b in SALARY_BUCKETS))


def revenue_alt_weekly(records: DataFrame) -> DataFrame:
    """A16. records: msisdn, weekstart, event_date, service, loan, repaid, amount. Loan split, repayments, threshold days."""
    weekend = is_weekend()
    days = lambda c: F.countDistinct(F.when(c, F.col("event_date")))
    return records.groupBy(*WEEK).agg(
        sum_where(weekend, "amount").alias("rev_weekend"),
        sum_where(F.col("loan"), "amount").alias("rev_loan"),
        sum_where(~F.col("loan"), "amount").alias("rev_non_loan"),
        F.array_sort(F.collect_set(F.when(F.col("repaid"), F.col("event_date")))).alias("repayment_dates"),
        (F.count_if(F.col("repaid")) - F.count_if(F.col("loan"))).alias("net_repayments"),
        days(F.col("amount") >= 10_000_000).alias("days_above_10m"),
        days(F.col("amount") >= 30_000_000).alias("days_above_30m"),
    )


def login_weekly(records: DataFrame) -> DataFrame:
    """A17. Package revenue, and days with a login."""
    return records.groupBy(*WEEK).agg(F.sum("amount").alias("package_revenue"), F.countDistinct("event_date").alias("login_days"))


def payu_weekly(records: DataFrame) -> DataFrame:
    """A18. Kilobytes and transactions by weekday, weekend, day and night."""
    night = (F.col("hour") < 6) | (F.col("hour") >= 22)
    of = {"weekend": is_weekend(), "weekday": ~is_weekend(), "night": night, "day": ~night}
    return records.groupBy(*WEEK).agg(*(c for n, w in of.items() for c in (sum_where(w, "kb").alias(f"kb_{n}"), F.count_if(w).alias(f"trx_{n}"))))


def loan_dpd_weekly(takers: DataFrame, payments: DataFrame, days: tuple[int, ...] = (2, 10, 15, 20, 25)) -> DataFrame:
    """A19. takers, payments: msisdn, event_date, campaign; payments meet loans on id, campaign prefix and month.

    Counts of loans repaid more than so many days later; a loan never repaid counts in none.
    """
    month = lambda d: F.date_format(d, "yyyy-MM")
    paid = payments.groupBy("msisdn", F.substring("campaign", 1, 1).alias("c"), month("event_date").alias("m")).agg(F.min("event_date").alias("paid"))
    loans = takers.withColumns({"c": F.substring("campaign", 1, 1), "m": month("event_date")}).join(paid, ["msisdn", "c", "m"], "left")
    late = F.datediff("paid", "event_date")
    return loans.groupBy(*WEEK).agg(F.count("*").alias("loans"), F.max(late).alias("max_dpd"), *(F.count_if(late > k).alias(f"dpd_{k}") for k in days))


def loan_amount(campaign: str) -> Column:
    """The amount at the end of a campaign id such as ``LOAN_A_5K``; K stands for thousands."""
    return F.regexp_replace(F.substring_index(F.upper(campaign), "_", -1), "K$", "000").try_cast("long")


def loan_tracker_weekly(events: DataFrame) -> DataFrame:
    """A20. events: msisdn, weekstart, event_date, campaign, step (offered, taken, repaid)."""
    at = lambda s: F.col("step") == s
    pairs = lambda s: F.array_sort(F.collect_list(F.when(at(s), F.struct("event_date", "campaign"))))
    return events.withColumn("amount", loan_amount("campaign")).groupBy(*WEEK).agg(
        pairs("offered").alias("offers"),
        pairs("taken").alias("taken"),
        F.countDistinct(F.when(at("repaid"), F.col("campaign"))).alias("offers_repaid"),
        F.countDistinct(F.when(at("offered"), F.col("campaign"))).alias("offers_eligible"),
        F.avg(F.when(at("offered"), F.col("amount"))).alias("avg_eligible_amount"),
    )


def length_of_service(sources: list[DataFrame], churn_days: int = 90) -> DataFrame:
    """A21. Per id and week the valid activation date. Sources: msisdn, event_date, weekstart, activation_date, kind.

    An activation later than the one before is valid only if the id was silent for longer than the churn period, or if
    there is none before; else the earlier one stands.
    """
    every = sources[0]
    for s in sources[1:]:
        every = every.unionByName(s)
    order = Window.partitionBy("msisdn").orderBy("event_date", "activation_date", "kind")
    marked = every.withColumns({"last_event": F.lag("event_date").over(order), "last_activation": F.lag("activation_date").over(order)})
    valid = F.col("last_activation").isNull() | (F.datediff("event_date", "last_event") > churn_days)
    stands = F.last(F.when(valid, F.col("activation_date")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("stands", stands).groupBy(*WEEK).agg(F.max_by("stands", F.struct("event_date", "activation_date", "kind")).alias("activation_date"))


def merge_activation(new: DataFrame, prior: DataFrame) -> DataFrame:
    """A21, next run: the prior valid date stands where there is one."""
    return new.join(prior.select("msisdn", F.col("activation_date").alias("prior")), "msisdn", "left").withColumn("activation_date", F.coalesce("prior", "activation_date")).drop("prior")


def profile_weekly(snapshots: DataFrame, attributes: list[str], points: str) -> DataFrame:
    """A22. Maximum of the attributes, mean and minimum of the points."""
    return snapshots.groupBy(*WEEK).agg(*(F.max(a).alias(a) for a in attributes), F.avg(points).alias(f"{points}_avg"), F.min(points).alias(f"{points}_min"))


def new_sales(records: DataFrame) -> DataFrame:
    """A23. records: b_number, event_date. A leading 0 becomes 62; the latest date of each number."""
    number = F.regexp_replace("b_number", "^0", "62")
    return records.groupBy(number.alias("msisdn")).agg(F.max("event_date").alias("event_date")).withColumn("is_nsb", F.lit(1))


def latest_expiry(records: DataFrame) -> DataFrame:
    """A23."""
    return records.groupBy(*WEEK).agg(F.max("expiry").alias("expected_expiry_date"))


def latest_attributes(records: DataFrame, keys: list[str], attributes: list[str], order: list[str]) -> DataFrame:
    """A24. The attributes of a group's last row."""
    at = F.struct(*order)
    return records.groupBy(*keys).agg(*(F.max_by(a, at).alias(a) for a in attributes))


def device_lookup(devices: DataFrame) -> DataFrame:
    """A25. One device per type code (first eight digits of an imei): the first by maker and name."""
    best = Window.partitionBy("tac").orderBy("maker", "model")
    return devices.withColumn("n", F.row_number().over(best)).filter("n = 1").drop("n")


def device_weekly(usage: DataFrame, lookup: DataFrame) -> DataFrame:
    """A25. usage: msisdn, weekstart, imei."""
    joined = usage.withColumn("tac", F.substring("imei", 1, 8)).join(lookup, "tac", "left")
    return joined.groupBy(*WEEK).agg(*(F.array_sort(F.collect_set(c)).alias(f"{c}s") for c in ("maker", "imei", "model")))


def kpi_weekly(kpis: DataFrame, key: str, means: list[str], maxima: list[str]) -> DataFrame:
    """A26. By any key."""
    return kpis.groupBy(key, "weekstart").agg(*(F.avg(c).alias(c) for c in means), *(F.max(c).alias(c) for c in maxima))


def kpi_by_id_weekly(kpis: DataFrame, stays: DataFrame, means: list[str], maxima: list[str]) -> DataFrame:
    """A26. KPIs of the cell an id was in on each day. stays: msisdn, event_date, cell."""
    joined = stays.select("msisdn", "event_date", "cell").join(kpis, ["cell", "event_date"])
    return kpi_weekly(joined, "msisdn", means, maxima)


def benchmark_weekly(samples: DataFrame, operators: list[str], nodes: list[str], measures: list[str], own: str) -> DataFrame:
    """A27. One column for each operator, node and measure; and own minus each competitor."""
    pivoted = samples.withColumn("o_n", F.concat_ws("_", "operator", "node")).groupBy("location", "weekstart").pivot("o_n", [f"{o}_{n}" for o in operators for n in nodes]).agg(*(F.avg(m).alias(m) for m in measures))
    if len(measures) == 1:  # then Spark names the columns without the measure
        pivoted = pivoted.withColumnsRenamed({f"{o}_{n}": f"{o}_{n}_{measures[0]}" for o in operators for n in nodes})
    gaps = {f"gap_{o}_{n}_{m}": F.col(f"{own}_{n}_{m}") - F.col(f"{o}_{n}_{m}") for o in operators if o != own for n in nodes for m in measures}
    return pivoted.withColumns(gaps)


def product_category(voice: str, data: str, sms: str, validity: str) -> Column:
    """A28. A code of binned allowances and validity."""
    level = lambda c, cuts: F.when(F.coalesce(F.col(c), F.lit(0)) <= 0, "0").when(F.col(c) <= cuts[0], "L").when(F.col(c) <= cuts[1], "M").otherwise("H")
    days = F.when(F.col(validity) <= 1, "1d").when(F.col(validity) <= 7, "7d").when(F.col(validity) <= 30, "30d").otherwise("30d+")
    return F.concat_ws("_", F.concat(F.lit("V"), level(voice, (10, 30))), F.concat(F.lit("D"), level(data, (20, 35))), F.concat(F.lit("S"), level(sms, (5, 25))), days)


def product_mapping(usage: DataFrame, catalogue: DataFrame, base: list[str]) -> DataFrame:
    """A29. usage: bid, sku, revenue. catalogue: sku, code, rank. Best catalogue row per sku, share of an id's revenue, best row per id, codes of the base only."""
    top = catalogue.withColumn("n", F.row_number().over(Window.partitionBy("sku").orderBy("rank", "code"))).filter("n = 1").drop("n", "rank")
    joined = usage.join(top, "sku").groupBy("bid", "code").agg(F.sum("revenue").alias("revenue"))
    share = F.try_divide(F.col("revenue").cast("double"), F.sum("revenue").over(Window.partitionBy("bid")).cast("double"))
    ranked = joined.withColumn("rev_share", share).withColumn("n", F.row_number().over(Window.partitionBy("bid").orderBy(F.col("rev_share").desc(), "code")))
    return ranked.filter("n = 1").filter(F.col("code").isin(base)).select("bid", "code", "rev_share")


def merge_mapping(base: DataFrame, new: DataFrame) -> DataFrame:
    """A30. The base and, of ids it lacks, the row with the best share."""
    fresh = new.join(base.select("bid"), "bid", "left_anti")
    best = fresh.withColumn("n", F.row_number().over(Window.partitionBy("bid").orderBy(F.col("rev_share").desc(), "code"))).filter("n = 1").drop("n")
    return base.unionByName(best)


def validity_days(validity: str, unit: str) -> Column:
    u = F.lower(unit)
    return F.when(u.startswith("hour"), F.ceil(F.col(validity) / 24)).when(u.startswith("week"), F.col(validity) * 7).when(u.startswith("month"), F.col(validity) * 30).otherwise(F.col(validity)).cast("long")


def product_weekly(events: DataFrame, products: list[str]) -> DataFrame:
    """A31. events: msisdn, weekstart, trx_id, product, validity, validity_unit.

    A transaction counts once. Counts by validity band, sorted [product, count, validity] triples, a count per product.
    """
    once = events.groupBy("trx_id").agg(F.min(F.struct(*WEEK, "product", "validity", "validity_unit")).alias("e")).select("e.*").withColumn("days", validity_days("validity", "validity_unit"))
    per = once.groupBy(*WEEK, "product", "days").agg(F.count("*").alias("n"))
    triple = F.array("product", F.col("n").cast("string"), F.col("days").cast("string"))
    return per.groupBy(*WEEK).agg(
        F.sum("n").alias("activations"),
        sum_where(F.col("days") <= 1, "n").alias("activations_1d"),
        sum_where(F.col("days").between(2, 7), "n").alias("activations_7d"),
        sum_where(F.col("days") > 7, "n").alias("activations_over_7d"),
        F.array_sort(F.collect_list(triple)).alias("product_list"),
        *(sum_where(F.col("product") == p, "n").alias(f"n_{p.lower()}") for p in products),
    )


def allowance_weekly(usage: DataFrame, buckets: DataFrame, columns: list[str]) -> DataFrame:
    """A32. usage left joined with the sku's allowances; a sum of each."""
    return usage.join(buckets, "sku", "left").groupBy(*WEEK).agg(*(F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in columns))
