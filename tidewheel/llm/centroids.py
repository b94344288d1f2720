"""Lloyd's clustering of integer vectors with distances from scalar lookup tables.

Components become integers, so few different values occur in a dimension. In every round a task tabulates, for each
dimension and each integer that occurs there in the batch at hand, the squared difference to every centroid; the
squared distances of the batch's vectors are then gathers from these tables and sums, without a multiplication for each
vector. A table has a row for each occurring value, so it is never larger than the batch, whatever the values are.

A task hands on one row of sums and counts for each centroid; they are added by dimension, and only centroids times
dimensions numbers reach the driver. All arithmetic is in integers, so results do not depend on how rows are dealt.

Vectors that are null, of another length than ``dim``, or with a null or non-finite component take no part. A row is a
vector: rows that repeat a vec_id, or equal vectors, each count and get their own row. A null vec_id is clustered like
any other but is never a first centroid. Components are held within +-2**27, so that a squared distance fits 64 bits.
With fewer vectors than centroids there are as many centroids as vectors with an id;
without any, and for an empty table, there are no rows. Ties go to the
smaller centroid. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import sent_with_tasks, written

LARGEST, BLOCK = 1 << 27, 4_096


def as_integers(vectors: DataFrame, dim: int, scale: int = 256) -> DataFrame:
    """vec_id and v, floor(scale * component) as long, of the vectors that take part."""
    fine = vectors.filter(F.size("embedding") == dim).filter(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    within = lambda x: F.greatest(F.least(F.floor(scale * x.cast("double")), F.lit(LARGEST)), F.lit(-LARGEST)).cast("long")
    return fine.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", within).alias("v"))


def first_centroids(ints: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors with the smallest sha256 of salt and vec_id, in that order; of one vec_id the smaller vector first."""
    named = ints.filter("vec_id is not null").withColumn("h", F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256))
    return np.array([r.v for r in named.orderBy("h", "v").limit(k).collect()], np.int64)


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Rows of x by centroids, from a lookup table for each dimension over the integers that occur in it."""
    out = np.zeros((len(x), len(centroids)), np.int64)
    for d in range(x.shape[1]):
        values, at = np.unique(x[:, d], return_inverse=True)
        out += ((values[:, None] - centroids[None, :, d]) ** 2)[at]
    return out


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row, the smaller of equals, and the squared distance."""
    number, far = np.zeros(len(x), np.int32), np.zeros(len(x), np.int64)
    for low in range(0, len(x), BLOCK):
        d = squared_distances(x[low : low + BLOCK], centroids)
        number[low : low + BLOCK] = d.argmin(1)
        far[low : low + BLOCK] = d.min(1)
    return number, far


def matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy().reshape(-1, dim)


def moved(ints: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid at the floor of its vectors' mean; one without vectors stays."""
    k, dim = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            x = matrix(batch, dim)
            number, _ = nearest(x, centroids)
            order = np.argsort(number, kind="stable")
            starts = np.flatnonzero(np.diff(number[order], prepend=-1))
            found = number[order][starts]
            n += np.bincount(number, minlength=k)
            total[found] += np.add.reduceat(x[order], starts) if len(x) else 0
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(n[held]), pa.array(list(total[held]), pa.list_(pa.int64()))], ["c", "n", "total"])

    each = ints.select("v").mapInArrow(sums, "c int, n long, total array<long>").select("c", "n", F.posexplode("total").alias("d", "x"))
    out = centroids.copy()
    for r in each.groupBy("c", "d").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect():
        out[r.c, r.d] = r.x // r.n
    return out


def assigned(ints: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance (squared) of every vector."""
    dim = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, far = nearest(matrix(batch, dim), centroids)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(number), pa.array(far)], ["vec_id", "cluster", "distance"])

    return ints.mapInArrow(run, "vec_id long, cluster int, distance long")


def clustered(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, salt: str = "2:") -> tuple[DataFrame, np.ndarray]:
    """Every vector's vec_id, cluster and squared distance after ``rounds`` rounds, and the final centroids."""
    ints = written(as_integers(vectors, dim), "cluster-vectors")
    centroids = first_centroids(ints, k, salt).reshape(-1, dim)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
    for _ in range(rounds):
        centroids = moved(ints, centroids)
    return written(assigned(ints, centroids), "clusters"), centroids


def inertia(found: DataFrame) -> dict[int, int | None]:
    """Sum of the squared distances of each cluster that has vectors; null where it does not fit 64 bits."""
    return {r.cluster: r.x for r in found.groupBy("cluster").agg(F.try_sum("distance").alias("x")).collect()}


sent_with_tasks(__name__)
