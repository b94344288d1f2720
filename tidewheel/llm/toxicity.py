"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the hashed n-grams (3 to 6 characters of the lower-cased text) that it holds, each counted once and scaled by the log ratio of its smoothed document frequencies in toxic and other training texts. A logistic
regression on the scaled features gives the score.

The classifier is fitted on a bounded sample of the labelled rows: the ``sample`` rows with the smallest hash of their
id. Everything else works on all rows and whole texts.

Nulls and short texts: a null text scores as the empty text, which has no features and gets the score of the intercept.
With no labelled rows, or rows of one label, the score is 0 or 1 by the label known, or 0. Repeated labels of one id
count as toxic if any is; labels with a null id or value are left out. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import sent_with_tasks

ORDERS, BITS = (3, 4, 5, 6), 20
SAMPLE, EPOCHS, RATE, RIDGE, TOXIC_WEIGHT = 8_000, 15, 0.1, 1e-4, 4.0
LEAST_DOCS, LEAST_Z = 3, 4.0
MIX = np.uint64(0x9E3779B97F4A7C15)


def buckets(text: str | None) -> np.ndarray:
    """The hashed n-grams of a text, repeats included; white space counts as one blank, also at both ends."""
    plain = f" {' '.join((text or '').lower().split())} "
    points = np.frombuffer(plain.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    grams, out = points, []
    for n in range(2, ORDERS[-1] + 1):
        if len(points) < n:
            break
        grams = grams[:-1] * MIX + points[n - 1 :]
        if n in ORDERS:
            out.append(((grams ^ (grams >> np.uint64(29))) * (MIX + np.uint64(2 * n)) >> np.uint64(64 - BITS)).astype(np.int32))
    return np.concatenate(out) if out else np.zeros(0, np.int32)


def packed(ids: np.ndarray) -> bytes:
    """Ascending ids as compressed gaps, about a third of their size."""
    return zlib.compress(np.diff(ids, prepend=0).astype(np.int32).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), np.int32))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """label and packed features of the sampled labelled documents, one row for each id: of ids with several rows the least features."""
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    # At most `sample` rows of 12 bytes: a broadcast of proven size.
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).withColumnRenamed("doc_id", "label_id")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("label_id", "label", "text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = [packed(np.unique(buckets(t.as_py()))) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("label_id").cast(pa.int64()), batch.column("label").cast(pa.int32()), pa.array(features, pa.binary())], ["label_id", "label", "features"])

    each = rows.withColumn("label_id", F.xxhash64("label_id")).mapInArrow(pack, "label_id long, label int, features binary")
    return each.groupBy("label_id").agg(F.max("label").alias("label"), F.min("features").alias("features")).select("label", "features")


def fit(labels: np.ndarray, features: list[bytes]) -> tuple[np.ndarray, float]:
    """Weight of each bucket and the intercept. features: packed ids, unpacked one at a time.

    n-grams of fewer than LEAST_DOCS documents, or whose document frequencies differ by less than LEAST_Z standard
    errors, get no weight. The rest are fitted by AdaGrad steps on the logistic loss; toxic rows weigh TOXIC_WEIGHT.
    """
    size, n, toxic = 1 << BITS, len(labels), labels > 0
    if n == 0 or toxic.all() or not toxic.any():
        return np.zeros(size, np.float32), (40.0 if n and toxic.all() else -40.0)
    pos, neg = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for f, is_toxic in zip(features, toxic, strict=True):
        (pos if is_toxic else neg)[unpacked(f)] += 1
    n1 = int(toxic.sum())
    ratio = (np.log((pos + 1) / (n1 + 2)) - np.log((neg + 1) / (n - n1 + 2))).astype(np.float32)
    df, share = pos + neg, n1 / n
    z = (pos - df * share) / np.sqrt(np.maximum(df * share * (1 - share) * (1 - df / n), 1e-3))
    ratio[(df < LEAST_DOCS) | (np.abs(z) < LEAST_Z)] = 0
    used_by = [f[ratio[f] != 0] for f in map(unpacked, features)]
    scale = float(np.mean([np.sqrt(max(1.0, float((ratio[f] ** 2).sum()))) for f in used_by]))
    weight, square = np.zeros(size, np.float32), np.full(size, 1e-6, np.float32)
    bias, bias_square = float(np.log(TOXIC_WEIGHT * n1 / (n - n1))), 1e-6
    draw = np.random.default_rng(1)
    batches = max(1, n // 64)
    for _ in range(max(EPOCHS, 600 // batches)):  # a small sample needs more passes
        for part in np.array_split(draw.permutation(n), batches):
            cols = np.concatenate([used_by[i] for i in part])
            rows = np.repeat(np.arange(len(part)), [len(used_by[i]) for i in part])
            x = ratio[cols] / scale
            z = np.bincount(rows, x * weight[cols], minlength=len(part)) + bias
            err = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - toxic[part]) * np.where(toxic[part], TOXIC_WEIGHT, 1)
            met, at = np.unique(cols, return_inverse=True)
            grad = np.bincount(at, err[rows] * x, minlength=len(met)) / len(part) + RIDGE * weight[met]
            square[met] += (grad * grad).astype(np.float32)
            weight[met] -= (RATE * grad / np.sqrt(square[met])).astype(np.float32)
            bias_square += float(err.mean()) ** 2
            bias -= RATE * float(err.mean()) / np.sqrt(bias_square)
    return (weight * ratio / scale).astype(np.float32), float(bias)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Fit in one task on the bounded sample; the model (2**BITS weights) comes to the driver."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, features = [], []
        for batch in batches:
            got += batch.column("label").to_pylist()
            features += batch.column("features").to_pylist()
        order = sorted(range(len(got)), key=lambda i: (got[i], features[i]))
        weight, bias = fit(np.array([got[i] for i in order], np.float64), [features[i] for i in order])
        yield pa.RecordBatch.from_arrays([pa.array([weight.tobytes()], pa.binary()), pa.array([bias])], ["weight", "bias"])

    rows = training_rows(docs, labels, sample).repartition(1).mapInArrow(one, "weight binary, bias double").collect()
    if not rows:
        return fit(np.zeros(0), [])
    row = rows[0]
    return np.frombuffer(bytes(row.weight), np.float32), row.bias


def scored(docs: DataFrame, model: tuple[np.ndarray, float], keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """The kept columns of docs (default: all) with a column ``name``, the probability of label 1. A column named so is replaced."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # 2**BITS floats, whatever the data
    cols = [c for c in (keep if keep is not None else docs.columns) if c != name]
    plain = docs.select(*cols, F.col("text").alias("__text")) if "text" not in cols else docs.select(*cols)
    text = "text" if "text" in cols else "__text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, bias = shared.value
        weighs = weight != 0
        for batch in batches:
            z = np.full(batch.num_rows, bias)
            for i, t in enumerate(batch.column(text)):
                ids = buckets(t.as_py())
                z[i] += weight[np.unique(ids[weighs[ids]])].sum(dtype=np.float64)
            score = pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in cols), score], [*cols, name])

    schema = docs.select(*cols).withColumn(name, F.lit(0.0)).schema
    return plain.mapInArrow(run, schema)


def predicted(score: Column) -> Column:
    return (score >= 0.5).cast("int")


sent_with_tasks(__name__)
