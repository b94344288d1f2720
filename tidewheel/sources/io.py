"""Reading and writing tables: dated windows, versions, partitions, upserts, exports and checks."""

from __future__ import annotations

import datetime as dt
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.functions.relational import nan_to_null
from tidewheel.functions.timekeys import period_days

BROADCAST_ROWS = 100_000


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share: in spark.checkpoint.dir, or, on one machine only, a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-scratch-")
    return f"{base.rstrip('/')}/tables-{uuid.uuid4().hex}"


def at_rest(df: DataFrame) -> DataFrame:
    """df written to a new shared folder and read again: what is random or costly in it happens once, and lost executors do no harm."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_counted(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df, of narrow rows, marked for broadcast if it has at most ``most`` rows; else it is left to a shuffle join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def bucketed(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """df as a table at rest in buckets of its keys, sorted by them: joins with tables of the same keys and buckets read it as it
    lies, without an exchange. Each bucket is one file."""
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", scratch(spark))
    writer.saveAsTable(name)
    return spark.table(name)


def dated_window_read(spark: SparkSession, path: str, partition_column: str, period: str, date_format: str, end: dt.date) -> DataFrame:
    """S1. Rows of the partitions from ``period`` before ``end`` to ``end``; the filter prunes partitions."""
    if not period or not date_format:
        raise ValueError("a period and a date format are needed")
    start = end - dt.timedelta(period_days(period) - 1)
    return spark.read.parquet(path).filter(F.col(partition_column).between(start.strftime(date_format), end.strftime(date_format)))


def versioned_write(df: DataFrame, path: str, created_at: dt.date) -> None:
    """S2. Write as the version of a date; a version written again is replaced."""
    df.withColumn("created_at", F.lit(created_at.isoformat())).write.partitionBy("created_at").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_version(spark: SparkSession, path: str, version: str | None = None, skip: int = 0) -> DataFrame:
    """S2. A pinned version, or the newest after skipping some."""
    df = spark.read.parquet(path).withColumn("created_at", F.col("created_at").cast("string"))
    if version is None:
        newest = df.select("created_at").distinct().orderBy(F.col("created_at").desc()).limit(skip + 1).collect()
        if len(newest) <= skip:
            raise ValueError(f"{path} has only {len(newest)} versions")
        version = newest[skip].created_at
    return df.filter(F.col("created_at") == version).drop("created_at")


def weekly_backfill_write(df: DataFrame, path: str) -> None:
    """S3. All weeks in one job; only the weeks in df are replaced. A large week is several tasks and files."""
    df.hint("rebalance", "weekstart").write.partitionBy("weekstart").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def latest_partition(df: DataFrame, column: str) -> DataFrame:
    """S4. Rows of the greatest value of a column; no rows for an empty table."""
    return df.filter(F.col(column) == df.agg(F.max(column)).first()[0])


def register_external_table(spark: SparkSession, name: str, path: str, schema: T.StructType, partition_columns: list[str]) -> None:
    """S5. Register partitioned Parquet files as a table and find their partitions."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f"PARTITIONED BY ({', '.join(partition_columns)})" if partition_columns else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet {by} LOCATION '{path}'")
    if partition_columns:
        spark.catalog.recoverPartitions(name)


def keyed_upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """S6. Target rows whose key is not in the updates, and all updates with NaN as null."""
    missing = [k for k in keys if k not in target.columns or k not in updates.columns]
    if missing or not keys:
        raise ValueError(f"missing keys {missing or keys}")
    return target.join(updates.select(*keys).distinct(), keys, "left_anti").unionByName(nan_to_null(updates))


def delimited_export(df: DataFrame, path: str, slot: str, separator: str = "|") -> None:
    """S7. Distinct rows as delimited text, a folder for each slot."""
    df.distinct().write.partitionBy(slot).mode("overwrite").option("sep", separator).option("header", True).csv(path)


def schema_check(df: DataFrame, expected: T.StructType) -> list[str]:
    """S8. What is wrong: columns missing or of another type, or no rows."""
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f"{f.name} is missing" if f.name not in have else f"{f.name} is {have[f.name].simpleString()}" for f in expected.fields if have.get(f.name) != f.dataType]
    return wrong or (["no rows"] if df.isEmpty() else [])


def rule_check(df: DataFrame, not_null: list[str], not_nan: list[str]) -> DataFrame:
    """S9. rule, column, failures: one aggregation for all rules."""
    rules = [("not_null", c, F.col(c).isNull()) for c in not_null] + [("not_nan", c, F.isnan(c)) for c in not_nan]
    one = df.agg(*(F.count_if(F.coalesce(bad, F.lit(False))).alias(f"r{i}") for i, (_, _, bad) in enumerate(rules)))
    rows = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column"), F.col(f"r{i}").alias("failures")) for i, (r, c, _) in enumerate(rules)))
    return one.select(F.explode(rows).alias("x")).select("x.*")
