"""Tables at rest that are changed in place: only touched partitions are rewritten, and a change shows whole or not at all.

A table is a folder of two parts. ``data`` holds rows by batch (one for each change) and part (a column of the rows).
``parts`` says for each version which batch holds each part; a version is one file, written last, so a run that fails
leaves the version before it, and its batch is in no version. A run has a name: a run that is in the table already does
nothing, so a job can be repeated. One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions.relational import nan_to_null
from tidewheel.sources.io import at_rest

PARTS = "part string, batch string, run string, version long"


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """The parts of all versions; no rows for a new table."""
    try:
        return spark.read.schema(PARTS).parquet(f"{path}/parts")
    except AnalysisException:
        return spark.createDataFrame([], PARTS)


def newest(spark: SparkSession, path: str) -> int:
    """The newest version; 0 for a new table."""
    return _parts(spark, path).agg(F.coalesce(F.max("version"), F.lit(0)).alias("v")).first().v


def _name(part: str) -> Column:
    """The name of a part in folders: always text, for nulls too."""
    return F.concat(F.lit("p-"), F.coalesce(F.col(part).cast("string"), F.lit("")))


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version, the newest by default. Batches and parts of other versions are pruned before they are read."""
    version = newest(spark, path) if version is None else version
    held = _parts(spark, path).filter((F.col("version") == version) & F.col("batch").isNotNull()).select(F.col("part").alias("_part"), F.col("batch").alias("_batch"))
    rows = spark.read.parquet(f"{path}/data")
    # A row for each part.
    return rows.join(F.broadcast(held), (F.col("ledger_part") == F.col("_part")) & (F.col("ledger_batch") == F.col("_batch"))).drop("_part", "_batch", "ledger_part", "ledger_batch")


def _commit(spark: SparkSession, path: str, parts: DataFrame, version: int) -> None:
    parts.withColumn("version", F.lit(version).cast("long")).coalesce(1).write.mode("append").parquet(f"{path}/parts")


def rewrite(spark: SparkSession, path: str, part: str, touched: DataFrame, rows: DataFrame, run: str) -> int:
    """A new version in which the parts of ``touched`` (column part) hold ``rows``, and no others change. Returns the version.

    A run of this name that is in the table already changes nothing. A part without rows is empty from then on.
    """
    held = _parts(spark, path)
    done = held.filter(F.col("run") == run).agg(F.min("version").alias("v")).first().v
    if done is not None:
        return done
    version, batch = newest(spark, path), f"b-{uuid.uuid4().hex}"
    named = rows.withColumns({"ledger_batch": F.lit(batch), "ledger_part": _name(part)})
    named.hint("rebalance", "ledger_part").write.mode("append").partitionBy("ledger_batch", "ledger_part").parquet(f"{path}/data")
    changed = at_rest(touched.select(_name(part).alias("part")).distinct())
    before = held.filter(F.col("version") == version).select("part", "batch")
    same = before.join(changed, "part", "left_anti").withColumn("run", F.lit(None).cast("string"))
    new = changed.select("part", F.lit(batch).alias("batch"), F.lit(run).alias("run"))
    _commit(spark, path, at_rest(same.unionByName(new)), version + 1)
    return version + 1


def _touched_rows(spark: SparkSession, path: str, part: str, changed: DataFrame) -> DataFrame | None:
    """The present rows of the parts that ``changed`` touches; None for a new table."""
    if newest(spark, path) == 0:
        return None
    of = changed.select(F.col(part).alias("_changed")).distinct()
    return read(spark, path).join(of, F.col(part).eqNullSafe(F.col("_changed")), "left_semi")


def upload(spark: SparkSession, path: str, rows: DataFrame, group: list[str], part: str, run: str, at: Column) -> int:
    """C10. Rows of a configuration take effect: active rows of their groups become inactive, and they are inserted as active.

    The table has the columns of rows, with status, created_at and deactivated_at; history stays. ``part`` must follow
    from the group. Equal rows are inserted once.
    """
    wanted = at_rest(rows.distinct())
    new = wanted.withColumns({"status": F.lit("active"), "created_at": at, "deactivated_at": F.lit(None).cast("timestamp")})
    present = _touched_rows(spark, path, part, wanted)
    if present is None:
        return rewrite(spark, path, part, wanted, new, run)
    uploaded = wanted.select(*(F.col(c).alias(f"_{c}") for c in group)).distinct().withColumn("_up", F.lit(True))
    same = F.lit(True)
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    retire = F.col("_up").isNotNull() & (F.col("status") == "active")
    old = present.join(uploaded, same, "left").withColumn("deactivated_at", F.when(retire, at).otherwise(F.col("deactivated_at")))
    old = old.withColumn("status", F.when(retire, "inactive").otherwise(F.col("status"))).select(*new.columns)
    return rewrite(spark, path, part, wanted, old.unionByName(new), run)


def upsert(spark: SparkSession, path: str, updates: DataFrame, keys: list[str], part: str, run: str) -> int:
    """S6. Updates with NaN as null replace the rows of their keys, in the parts that they touch. ``part`` must follow from the keys."""
    new = at_rest(nan_to_null(updates))
    present = _touched_rows(spark, path, part, new)
    rows = new if present is None else present.join(new.select(*keys).distinct(), keys, "left_anti").select(*new.columns).unionByName(new)
    return rewrite(spark, path, part, new, rows, run)
