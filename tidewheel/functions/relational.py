"""Small relational helpers."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = {
    "numeric": (T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.FloatType, T.DoubleType, T.DecimalType),
    "string": (T.StringType,),
    "boolean": (T.BooleanType,),
    "date": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "array": (T.ArrayType,),
}


def melt(df: DataFrame, ids: list[str], values: list[str], var_name: str = "variable", value_name: str = "value") -> DataFrame:
    return df.unpivot(ids, values, var_name, value_name)


def union_all(*dfs: DataFrame) -> DataFrame:
    """By position."""
    return reduce(DataFrame.union, dfs)


def union_by_name(dfs: list[DataFrame], missing: bool = False) -> DataFrame:
    """By name; with ``missing``, columns that a frame lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=missing), dfs)


def join_all(dfs: list[DataFrame], on: list[str], how: str = "inner") -> DataFrame:
    return reduce(lambda a, b: a.join(b, on, how), dfs)


def full_join_all(dfs: list[DataFrame], key: list[str]) -> DataFrame:
    return join_all(dfs, key, "full")


def affix_columns(df: DataFrame, prefix: str = "", suffix: str = "", ignore: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*(F.col(c) if c in ignore else F.col(c).alias(f"{prefix}{c}{suffix}") for c in df.columns))


def prefix_features(df: DataFrame, ignore: tuple[str, ...] = ("msisdn", "weekstart")) -> DataFrame:
    return affix_columns(df, "fea_", ignore=ignore)


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def normalise_column_names(df: DataFrame) -> DataFrame:
    """Lower case, blanks as underscores."""
    return df.select(*(F.col(f"`{c}`").alias(c.strip().lower().replace(" ", "_")) for c in df.columns))


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, KINDS[kind])]


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("fea_")]


def nan_to_null(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    of = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType)) and (subset is None or f.name in subset)]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in of}) if of else df


def required_columns(df: DataFrame, wanted: list[str], keep: list[str], mode: str = "feature_list") -> DataFrame:
    """All columns, or the key columns and those wanted that exist."""
    return df if mode == "all" else df.select(*keep, *(c for c in wanted if c in df.columns and c not in keep))


def apply_feature_mapping(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename to an interface; missing old names and new names that are taken are errors."""
    missing = [c for c in names if c not in df.columns]
    taken = [n for n in names.values() if n in df.columns and n not in names]
    if missing or taken or len(set(names.values())) < len(names):
        raise ValueError(f"feature mapping: missing {missing}, taken {taken}")
    return df.withColumnsRenamed(names)


def mode_with_count(df: DataFrame, keys: list[str], column: str, count: str) -> DataFrame:
    """keys, mode of the column weighted by ``count`` and that weight; nulls do not count, ties go to the smaller value."""
    sums = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.sum(count).alias("_n"))
    best = Window.partitionBy(*keys).orderBy(F.col("_n").desc_nulls_last(), column)
    return sums.withColumn("_r", F.row_number().over(best)).filter("_r = 1").select(*keys, F.col(column).alias(f"{column}_mode"), F.col("_n").alias(f"{column}_mode_count"))


def mode_of_array(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """keys, most frequent element of an array column; empty arrays give null, ties go to the smaller element."""
    each = df.select(*keys, F.explode_outer(column).alias("_e")).groupBy(*keys, "_e").agg(F.count("_e").alias("_n"))
    best = Window.partitionBy(*keys).orderBy(F.col("_n").desc(), F.col("_e").asc_nulls_last())
    return each.withColumn("_r", F.row_number().over(best)).filter("_r = 1").select(*keys, F.col("_e").alias(f"{column}_mode"))


def allow_list(df: DataFrame, keys: DataFrame, key: str = "msisdn", enabled: bool = True) -> DataFrame:
    return df.join(keys.select(key).distinct(), key, "left_semi") if enabled else df


def allow_list_between(df: DataFrame, keys: DataFrame, first: str, last: str, key: str = "msisdn") -> DataFrame:
    return allow_list(df.filter(F.col("weekstart").between(F.lit(first).cast("date"), F.lit(last).cast("date"))), keys, key)


def dedupe(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first by a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def select_by_rule(df: DataFrame, required: tuple[str, ...] = (), excluded: tuple[str, ...] = (), prefixes: tuple[str, ...] = (), suffixes: tuple[str, ...] = (), kinds: tuple[str, ...] = ()) -> DataFrame:
    """Required columns, and those that pass: not excluded, prefix and suffix not among those to drop, of a kind wanted."""
    of_kind = {c for k in kinds for c in columns_of_type(df, k)} if kinds else set(df.columns)
    keep = [c for c in df.columns if c in required or (c not in excluded and not c.startswith(prefixes or ("\0",)) and not c.endswith(suffixes or ("\0",)) and c in of_kind)]
    return df.select(*keep)


def hash_unit(key: str, salt: int = 0) -> Column:
    """A number in [0, 1) from a key's md5; the same on every run and engine."""
    text = F.concat(F.col(key).cast("string"), F.lit(f"#{salt}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / float(1 << 32)


def sample_ids(df: DataFrame, key: str, share: float, salt: int = 0) -> DataFrame:
    return df.filter(hash_unit(key, salt) < share)


def downsample_to(df: DataFrame, key: str, n: int, salt: int = 0) -> DataFrame:
    """The ``n`` rows of the smallest hashes of a key; every task keeps n at most."""
    return df.orderBy(hash_unit(key, salt), key).limit(n)


def sampled_names(names: list[str], n: int, salt: int = 0) -> list[str]:
    """``n`` of the names, chosen by hash, in their order."""
    chosen = sorted(names, key=lambda c: (hashlib.md5(f"{c}#{salt}".encode()).hexdigest(), c))[:n]
    return [c for c in names if c in chosen]


def sample_rows_and_features(df: DataFrame, key: str, n_rows: int, n_features: int, salt: int = 0) -> DataFrame:
    """The key and some of the other columns, of some of the rows."""
    features = sampled_names([c for c in df.columns if c != key], n_features, salt)
    return downsample_to(df.select(key, *features), key, n_rows, salt)


def stratified_downsample(df: DataFrame, strata: list[str], key: str, target: int, salt: int = 0) -> DataFrame:
    """About ``target`` rows of each stratum, all where it has fewer, chosen by hash."""
    counts = df.groupBy(*strata).agg(F.count("*").alias("_n"))
    return df.join(counts, strata).filter(hash_unit(key, salt) * F.col("_n") < target).drop("_n")


def downsample_with_control(df: DataFrame, strata: list[str], key: str, control: Column, target: int, most: float, salt: int = 0) -> DataFrame:
    """About ``target`` rows of each stratum, of which the control rows are at most a share ``most`` (below 1), chosen by hash."""
    counts = df.groupBy(*strata).agg(F.count_if(control).alias("_c"), F.count_if(~control).alias("_t"))
    all_of = F.least(F.lit(1.0), F.lit(float(target)) / (F.col("_c") + F.col("_t")))
    of_control = F.least(all_of, F.try_divide(all_of * F.col("_t") * (most / (1 - most)), F.col("_c").cast("double")))
    return df.join(counts, strata).filter(hash_unit(key, salt) < F.when(control, of_control).otherwise(all_of)).drop("_c", "_t")


def random_value(key: str, values: list[str], salt: int = 0) -> Column:
    """One of the values per row, uniform over keys."""
    return F.element_at(F.array(*map(F.lit, values)), (F.floor(hash_unit(key, salt) * len(values)) + 1).cast("int"))


def random_batch(key: str, n: int, salt: int = 0) -> Column:
    return F.floor(hash_unit(key, salt) * n).cast("int")


def normalise_cell_id(column: str) -> Column:
    """The first two parts of a pipe-separated cell id, without quotes."""
    return F.substring_index(F.regexp_replace(column, '"', ""), "|", 2)


def cell_area(column: str) -> Column:
    return F.element_at(F.split(column, "-"), 1)


def feature_subset(df: DataFrame, importance: DataFrame, keys: list[str], top: int | None = None) -> DataFrame:
    """Key columns and the features that a table of importances (feature, importance) names."""
    names = importance.orderBy(F.col("importance").desc(), "feature")
    known = {r.feature for r in (names.limit(top) if top else names).select("feature").collect()}
    return df.select(*keys, *(c for c in df.columns if c in known and c not in keys))
