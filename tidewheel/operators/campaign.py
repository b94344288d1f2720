"""Campaign lists: normalisation, validation, ranking, pacing and configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.functions.ranks import row_numbers
from tidewheel.sources.io import broadcast_if_counted

CRITERIA = ["criteria_1", "criteria_2", "criteria_3", "criteria_4", "criteria_5"]


def normalise_phone(column: str) -> Column:
    """C1. +62..., 62..., 0062..., 0... and 8... to 62...; anything else as it is, without a plus sign."""
    c = F.regexp_replace(F.trim(column), r"^\+", "")
    return F.when(c.startswith("0062"), F.substring(c, 3, 100)).when(c.startswith("0"), F.concat(F.lit("62"), F.substring(c, 2, 100))).when(c.startswith("8") & (F.length(c) <= 12), F.concat(F.lit("62"), c)).otherwise(c)


def criteria_flags(df: DataFrame, channels: list[str]) -> DataFrame:
    """C2. Criteria as numbers (null and blank as 0) and Yes/No flags."""
    yes = lambda c: F.when(F.coalesce(c, F.lit(False)), "Yes").otherwise("No")
    out = df.withColumns({c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in CRITERIA})
    positive = F.lit(True)
    for c in CRITERIA:
        positive = positive & (F.col(c) >= 0)
    phone = F.col("msisdn").rlike("^62[0-9]{9,11}$")
    return out.withColumns({"valid_criteria": yes(positive), "valid_msisdn": yes(phone), "valid_channel": yes(F.col("push_channel").isin(channels))})


def validate(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """C3. Rows that pass all flags, and one row of counts."""
    flags = ["valid_criteria", "valid_msisdn", "valid_channel"]
    counts = df.agg(F.count("*").alias("total"), *(F.count_if(F.col(f) == "No").alias(f"in{f}") for f in flags))
    return df.filter(" and ".join(f"{f} = 'Yes'" for f in flags)), counts


def rank(df: DataFrame, n: int) -> DataFrame:
    """C4. The best n rows of each id and channel by the five criteria, ties to the smaller campaign."""
    w = Window.partitionBy("msisdn", "push_channel").orderBy(*(F.col(c).desc() for c in CRITERIA), "campaign")
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def combine(dfs: list[DataFrame]) -> DataFrame:
    """C5."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def event_rows(df: DataFrame, push_date: str, constants: dict[str, str]) -> DataFrame:
    """C6. Constant fields, push time, and a transaction number made of the date and the row's key."""
    number = F.concat(F.lit(push_date.replace("-", "")), F.lit("-"), "msisdn", F.lit("-"), "campaign")
    return df.withColumns({**{k: F.lit(v) for k, v in constants.items()}, "push_time": F.lit(f"{push_date} 09:00:00").cast("timestamp"), "transaction_id": number})


def pace(df: DataFrame, limits: DataFrame) -> DataFrame:
    """C7. rank_by_channel: place in the channel by the five criteria (those that df has), the greatest first, ties to the smaller id, then campaign;
    slot = ceil(place / the channel's limit per hour). limits: push_channel, hourly.

    Channels are numbered by ranges of the order, so a large channel is many tasks.
    """
    order = [*(F.col(c).desc() for c in CRITERIA if c in df.columns), F.col("msisdn").asc(), F.col("campaign").asc()]
    placed = row_numbers(df, ["push_channel"], order, "rank_by_channel").join(broadcast_if_counted(limits), "push_channel")
    return placed.withColumn("slot", F.ceil(F.col("rank_by_channel") / F.col("hourly")).cast("long")).drop("hourly")


def slot_sizes(paced: DataFrame) -> DataFrame:
    """C7. slot, push_channel, n: what is sent in an hour, channels together."""
    return paced.groupBy("slot", "push_channel").agg(F.count("*").alias("n"))


def missing_configuration(ranking: DataFrame, channels: DataFrame, keys: list[str]) -> DataFrame:
    """C8. Keys in only one of two configuration tables, and which lacks them."""
    a, b = ranking.select(*keys).distinct().withColumn("_a", F.lit(1)), channels.select(*keys).distinct().withColumn("_b", F.lit(1))
    both = a.join(b, keys, "full").filter("_a is null or _b is null")
    return both.select(*keys, F.when(F.col("_a").isNull(), "ranking").otherwise("channels").alias("missing_in"))


def duplicate_configuration(config: DataFrame, keys: list[str]) -> DataFrame:
    """C8. Keys with several rows."""
    return config.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def several_rows_of_system(config: DataFrame, keys: list[str], system: str, single: str) -> DataFrame:
    """C8. Keys with several rows of a system that takes a single one, and how many."""
    return config.filter(F.col(system) == single).groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def build_input(scores: DataFrame, config: DataFrame, ranking: DataFrame) -> DataFrame:
    """C9. Scores with configuration and ranking, keyword by system, and the criteria. config: campaign, family, system, push_channel, code. ranking: campaign, priority."""
    joined = scores.join(config, "campaign", "left").join(ranking, "campaign", "left")
    keyword = F.when(F.col("system") == "A", F.concat_ws("_", "family", "campaign")).when(F.col("system") == "B", F.concat_ws("|", "code", "campaign")).otherwise(F.col("campaign"))
    return joined.withColumns({"keyword": keyword, "criteria_1": F.coalesce("priority", F.lit(0)), "criteria_2": F.col("score")})


def ranking_changes(active: DataFrame, wanted: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """C10. key, action: deactivate what is gone or changed, insert what is new or changed."""
    a, w = active.select(key, F.struct(*columns).alias("old")), wanted.select(key, F.struct(*columns).alias("new"))
    both = a.join(w, key, "full").filter(~F.col("old").eqNullSafe(F.col("new")))
    actions = F.array_compact(F.array(F.when(F.col("old").isNotNull(), F.lit("deactivate")), F.when(F.col("new").isNotNull(), F.lit("insert"))))
    return both.select(key, F.explode(actions).alias("action"))


def melt_criteria(ranking: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """C10."""
    return ranking.unpivot([key], columns, "criterion", "value")
