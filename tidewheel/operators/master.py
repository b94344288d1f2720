"""Master tables, dimensions and targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.functions.frames import rows_frame
from tidewheel.functions.relational import mode_with_count
from tidewheel.functions.timekeys import prev_week_start
from tidewheel.sources.io import bucketed


def hashed_id(column: str, salt: str) -> Column:
    """M1. First five characters and the md5 of id and salt."""
    return F.concat(F.substring(column, 1, 5), F.md5(F.concat(F.col(column), F.lit(salt)).cast("binary")))


def master_dimension(ids: DataFrame, salt: str | None = None) -> DataFrame:
    """M1. One row per id and use case; ids hashed where there is a salt."""
    out = ids.withColumn("use_case", F.explode("use_case"))
    return out.withColumn("msisdn", hashed_id("msisdn", salt)) if salt else out


def build_master(dimension: DataFrame, features: list[DataFrame], keys: list[str]) -> DataFrame:
    """M2. Left joins on one key, so that one partitioning serves all of them."""
    out = dimension
    for f in features:
        out = out.join(f, keys, "left")
    return out


def build_bucketed_master(dimension: DataFrame, features: list[DataFrame], keys: list[str], buckets: int) -> DataFrame:
    """M2. The same from tables stored in buckets of the keys: many masters over many tables, and no table is shuffled again."""
    return build_master(bucketed(dimension, keys, buckets), [bucketed(f, keys, buckets) for f in features], keys)


def feature_metadata(tables: dict[str, DataFrame]) -> DataFrame:
    """M3. feature, table, has_data: one row for each feature column of each table."""
    out = None
    for name, df in sorted(tables.items()):
        cols = [c for c in df.columns if c.startswith("fea_")]
        any_row = df.limit(1).agg(F.count("*").alias("n"))
        part = any_row.select(F.explode(F.array(*map(F.lit, cols))).alias("feature"), F.lit(name).alias("table"), (F.col("n") > 0).alias("has_data"))
        out = part if out is None else out.union(part)
    return out


def outlet_master(outlets: DataFrame, districts: list[DataFrame], keys: list[str]) -> DataFrame:
    """M4. Outlets with district tables, each on its own key."""
    out = outlets
    for table, key in zip(districts, keys, strict=True):
        out = out.join(table, key, "left")
    return out


def latest_only(master: DataFrame, key: str = "msisdn") -> DataFrame:
    """M4. Each id's last week."""
    w = Window.partitionBy(key).orderBy(F.col("weekstart").desc())
    return master.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def outlet_monthly(daily: DataFrame, components: list[str], created: DataFrame, created_before: str) -> DataFrame:
    """M5. Per outlet and month: target (sum of the components, nulls as 0), its mean over active days, maximum, last value, and last month's target.

    Only outlets created before a date.
    """
    old = created.filter(F.col("created_at") < F.lit(created_before).cast("date")).select("outlet_id")
    target = sum((F.coalesce(F.col(c), F.lit(0)) for c in components[1:]), F.coalesce(F.col(components[0]), F.lit(0)))
    rows = daily.join(old, "outlet_id", "left_semi").withColumns({"target": target, "month": F.trunc("event_date", "month")})
    active = F.count_if(F.col("target") > 0)
    per = rows.groupBy("outlet_id", "month").agg(F.sum("target").alias("target"), F.try_divide(F.sum("target").cast("double"), active).alias("target_mean"), F.max("target").alias("target_max"), F.max_by("target", "event_date").alias("target_last"))
    before = Window.partitionBy("outlet_id").orderBy(F.months_between("month", F.lit("1970-01-01").cast("date")).cast("int")).rangeBetween(-1, -1)
    return per.withColumn("target_lag_1m", F.first("target").over(before))


def outlet_monthly_numbers(daily: DataFrame, numbers: list[str], target: str, lags: tuple[int, ...]) -> DataFrame:
    """M5. Per outlet and month: sum and mean of each number over active days (target not 0), nulls as 0, and both of months before.

    daily: outlet_id, event_date, the numbers and the target. A month without rows has no value to lag.
    """
    rows = daily.withColumn("month", F.trunc("event_date", "month")).fillna(0, numbers).filter(F.coalesce(F.col(target), F.lit(0)) != 0)
    per = rows.groupBy("outlet_id", "month").agg(F.count("*").alias("active_days"), *(a for c in numbers for a in (F.sum(c).alias(f"{c}_sum"), F.avg(c).alias(f"{c}_mean"))))
    months = Window.partitionBy("outlet_id").orderBy(F.months_between("month", F.lit("1970-01-01").cast("date")).cast("int"))
    lagged = {f"{c}_{m}_lag_{k}m": F.first(f"{c}_{m}").over(months.rangeBetween(-k, -k)) for c in numbers for m in ("sum", "mean") for k in lags}
    return per.withColumns(lagged)


def removal_report(ids: DataFrame, steps: dict[str, DataFrame], key: str = "outlet_id") -> DataFrame:
    """M6. key, reason of the ids that each filter loses; ``steps`` are what is left after each."""
    out, before = None, ids.select(key).distinct()
    for name, kept in steps.items():
        left = kept.select(key).distinct()
        lost = before.join(left, key, "left_anti").withColumn("reason", F.lit(name))
        out, before = lost if out is None else out.union(lost), left
    return out


def revenue_by_monday(sources: list[DataFrame]) -> DataFrame:
    """M7. Revenue per id and Monday on or before, over sources of msisdn, event_date, amount, digital (or 0)."""
    per = [s.groupBy("msisdn", prev_week_start("event_date").alias("monday")).agg(F.sum("amount").alias("revenue"), F.sum("digital").alias("digital")) for s in sources]
    out = per[0]
    for p in per[1:]:
        out = out.union(p)
    return out.groupBy("msisdn", "monday").agg(F.sum("revenue").alias("revenue"), F.sum("digital").alias("digital"))


def churn_target(df: DataFrame, source: str, lag: int, window: int, key: str = "msisdn") -> DataFrame:
    """M8. The smallest value of the source over rows lag to lag + window - 1 ahead; 1 where those are not complete."""
    ahead = rows_frame(lag, lag + window - 1, key)
    full = F.count("*").over(ahead) == window
    return df.withColumn("target", F.when(full, F.min(source).over(ahead)).otherwise(1))


def in_life_target(df: DataFrame, source: str, key: str = "msisdn") -> DataFrame:
    """M9. Mean after minus mean before; ids with both only. df: key, after (boolean), source."""
    mean = lambda c: F.avg(F.when(c, F.col(source)))
    return df.groupBy(key).agg((mean(F.col("after")) - mean(~F.col("after"))).alias("target")).filter("target is not null")


def adoption_target(df: DataFrame, source: str, key: str = "msisdn") -> DataFrame:
    """M9. Greatest use after of ids with none before."""
    used = df.filter(~F.col("after") & (F.col(source) > 0)).select(key).distinct()
    return df.filter("after").join(used, key, "left_anti").groupBy(key).agg(F.max(source).alias("target"))


def training_slice(df: DataFrame, campaign_date: str, before_days: int, after_days: int, treated: DataFrame) -> DataFrame:
    """M10. Rows of the observation window, whether after the campaign, and whether the id was treated."""
    day = F.lit(campaign_date).cast("date")
    rows = df.filter(F.col("weekstart").between(F.date_sub(day, before_days), F.date_add(day, after_days)))
    flag = treated.select("msisdn").distinct().withColumn("is_treatment", F.lit(1))
    return rows.join(flag, "msisdn", "left").withColumns({"is_treatment": F.coalesce("is_treatment", F.lit(0)), "after": F.col("weekstart") >= day})


def campaign_wordings(campaigns: DataFrame, priority: list[str]) -> DataFrame:
    """M11. One wording per campaign by type priority, then the latest date. campaigns: campaign, type, date, wording."""
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col("type"))
    w = Window.partitionBy("campaign").orderBy(F.when(rank > 0, rank).otherwise(len(priority) + 1), F.col("date").desc(), "wording")
    return campaigns.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def monday_snapshots(df: DataFrame, date: str = "event_date") -> DataFrame:
    """M12. Rows of Mondays."""
    return df.filter(F.weekday(date) == 0)


def outlet_monthly_modes(daily: DataFrame, columns: list[str], ratios: dict[str, tuple[str, str]]) -> DataFrame:
    """M5. Per outlet and month: most frequent value of each column (ties to the smaller) and ratios of sums. ratios: name -> (above, below)."""
    rows = daily.withColumn("month", F.trunc("event_date", "month"))
    key = ["outlet_id", "month"]
    out = rows.groupBy(*key).agg(*(F.try_divide(F.sum(a).cast("double"), F.sum(b).cast("double")).alias(n) for n, (a, b) in ratios.items()))
    for c in columns:
        out = out.join(mode_with_count(rows.withColumn("_one", F.lit(1)), key, c, "_one").drop(f"{c}_mode_count"), key, "left")
    return out


def campaign_tracking(campaigns: DataFrame, tracking: DataFrame, stages: list[str]) -> DataFrame:
    """M11. Campaigns (one row each) with the number of ids that reached each stage and the first and last date tracked.

    tracking: campaign, msisdn, stage, event_date. Names count once whatever the case of their letters.
    """
    one = campaigns.withColumn("_name", F.lower("campaign"))
    per = tracking.groupBy(F.lower("campaign").alias("_name")).agg(F.min("event_date").alias("first_date"), F.max("event_date").alias("last_date"), *(F.countDistinct(F.when(F.col("stage") == s, F.col("msisdn"))).alias(f"ids_{s}") for s in stages))
    return one.groupBy("_name").agg(*(F.min_by(c, "campaign").alias(c) for c in campaigns.columns)).join(per, "_name", "left").drop("_name")


def campaign_master(campaigns: DataFrame, tables: list[DataFrame], dimension: DataFrame, date: str = "event_date") -> DataFrame:
    """M12. Campaign rows (msisdn, date) with the united tables' snapshot of the Monday on or before the date, and a dimension by id."""
    united = tables[0]
    for t in tables[1:]:
        united = united.unionByName(t, allowMissingColumns=True)
    snapshot = monday_snapshots(united, date).withColumnRenamed(date, "_monday")
    return campaigns.withColumn("_monday", prev_week_start(date)).join(snapshot, ["msisdn", "_monday"], "left").drop("_monday").join(dimension, "msisdn", "left")
