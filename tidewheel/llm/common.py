"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; where unset, and on one machine only, a new temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _own_dir:
            _own_dir.append("file://" + tempfile.mkdtemp(prefix="spark-checkpoint-"))
        found = _own_dir[0]
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder_of(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n; null for a null key."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(n))


def long_id(column: str = "doc_id") -> Column:
    return F.col(column).cast("long")


BROADCAST_BYTES = 8 << 20


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """Mark df for broadcast if its measured size is at most ``most`` bytes; else leave it to a shuffle join.

    A number counts 8 bytes, text and binary by their length, lists by their numbers. df should be cheap to read (a written table).
    """
    size = F.lit(8 * len(df.columns))
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind in ("array<int>", "array<bigint>"):
            size = size + 8 * F.coalesce(F.size(name), F.lit(0))
    total = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if total <= most else df


def by_bytes(batch: pa.RecordBatch, column: str, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``rows`` rows and about ``size`` bytes of a text column, one row at least."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64))
    low = 0
    while low < batch.num_rows:
        before = upto[low - 1] if low else 0
        high = min(low + rows, max(low + 1, int(np.searchsorted(upto, before + size, "right"))))
        yield batch.slice(low, high - low)
        low = high


def sent_with_tasks(module: str) -> None:
    """Send a module's functions along with the tasks that use them, so executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


sent_with_tasks(__name__)
