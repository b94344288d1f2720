"""Mixing sources to target weights by hash-threshold histograms.

Each document gets a hash in [0, 2**60). A source's budget of words is met by taking all documents below a hash
threshold. The threshold comes from a histogram of words by source and hash bucket: the buckets wholly below the
budget are summed, and only the bucket that the budget falls into is refined by the next bits of the hash, until it
is one hash value. The filter then compares hashes; nothing is sorted. A larger budget has a larger threshold, so
mixes for growing budgets are nested.

A source with a target above its size takes every document once and those below the threshold for the excess twice.

Nulls: a null text has size 0, a null source is a source of its own (last), a null doc_id is hashed as the word null.
Rows equal in both id and text have one hash and are taken together. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.common import broadcast_if_small, written

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS, LEVEL_BITS = 60, 12  # 4096 buckets a level, so a source is that many rows at most


def mix_hash(doc_id: Column, text: Column) -> Column:
    """First 60 bits of md5 of the id as text (or 'null') and the md5 of the text, so rows that share one of them spread."""
    digest = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit("-"), digest)
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source with source_size and target.

    The budget (share of all sizes) is dealt by weight; a target stops at ``most`` times its source's size and the
    excess is dealt again by weight until no target is above. That fixed point is target = min(cap, level * weight),
    where level is found on the sources in order of cap / weight: the first k are capped, for the smallest k that
    leaves the next one under its cap. The windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank"), F.lit(len(weights))) + 1).cast("int"))
    ranked = per.withColumn("rank", F.row_number().over(order) - 1).withColumn("weight", weight.cast("double"))
    ranked = ranked.withColumn("cap", F.lit(most) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = (F.col("budget") - F.col("caps_before")) / F.col("weight_left")
    found = (
        ranked.withColumn("caps_before", F.coalesce(F.sum("cap").over(by_ratio), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0.0)))
        .withColumn("budget", F.lit(share) * F.sum("source_size").over(whole))
        .withColumn("level", F.when(level * F.col("weight") <= F.col("cap"), level))
    )
    # Past the first source left under its cap the level only falls, so that one has the largest.
    first = F.max("level").over(whole)
    return found.select("source", "source_size", F.coalesce(F.least("cap", first * F.col("weight")), F.col("cap")).alias("target"))


def hash_thresholds(hashed: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per source, the hash below which documents are taken: ``threshold``.

    hashed: source, h, size. budgets: source, budget. Level by level the histogram of the boundary bucket alone is
    refined; after the last level the bucket is one hash value, taken if that brings the sum nearer to the budget.
    """
    bounds = budgets.select("source", F.lit(0).cast("long").alias("low"), F.col("budget").cast("double").alias("left"))
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        shift = HASH_BITS - LEVEL_BITS * level
        rows = hashed.withColumn("bucket", F.shiftright("h", shift))
        bounds = broadcast_if_small(bounds)
        inside = rows.join(bounds, rows.source.eqNullSafe(bounds.source) & (F.shiftright(F.col("h"), shift + LEVEL_BITS) == F.shiftright(F.col("low"), shift + LEVEL_BITS)), "inner").select(rows.source, "bucket", "size", "left")
        histogram = inside.groupBy("source", "bucket").agg(F.sum("size").alias("size"), F.max("left").alias("left"))
        run = Window.partitionBy("source").orderBy("bucket")
        summed = histogram.withColumn("upto", F.sum("size").over(run))
        last = level == HASH_BITS // LEVEL_BITS
        over = F.col("upto") > F.col("left")
        first = summed.filter(over).groupBy("source").agg(F.min(F.struct("bucket", "upto", "size", "left")).alias("b"))
        if last:
            nearer = F.col("b.upto") - F.col("b.left") <= F.col("b.left") - (F.col("b.upto") - F.col("b.size"))
            step = first.select("source", (F.col("b.bucket") + nearer.cast("long")).alias("low"), F.lit(0.0).alias("left"))
        else:
            step = first.select("source", F.shiftleft(F.col("b.bucket"), shift).alias("low"), (F.col("b.left") - (F.col("b.upto") - F.col("b.size"))).alias("left"))
        old = bounds.select(F.col("source").alias("s0"))
        # A source whose budget is not reached in its bucket (only where it has no excess at all) takes all.
        merged = old.join(step, F.col("s0").eqNullSafe(F.col("source")), "left").select(F.col("s0").alias("source"), F.coalesce("low", F.lit(1 << HASH_BITS)).alias("low"), F.coalesce("left", F.lit(0.0)).alias("left"))
        bounds = written(merged, "mix-bounds")  # one row per source; later levels do not redo earlier ones
    return bounds.select("source", F.col("low").alias("threshold"))


def sizes(docs: DataFrame) -> DataFrame:
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return written(docs.select("doc_id", "source", size.alias("size"), mix_hash(F.col("doc_id"), F.col("text")).alias("h")), "mix-sizes")


def mix_plan(sized: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """s1 (source), source_size, target, base (times that every document is taken), threshold (hash below which once more)."""
    targets = written(source_targets(sized, weights, share, most), "mix-targets")
    base = F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    plan = targets.withColumn("base", base.cast("long")).withColumn("budget", F.col("target") - F.col("base") * F.col("source_size"))
    thresholds = hash_thresholds(sized.filter("size > 0"), plan).withColumnRenamed("source", "s1")
    return written(plan.join(thresholds, plan.source.eqNullSafe(F.col("s1"))).select("s1", "source_size", "target", "base", "threshold"), "mix-plan")


def with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """rows (source, h and more) with source_size, target and ``copies``, how often the mix takes the row."""
    copies = F.col("base") + (F.col("h") < F.col("threshold")).cast("long")
    return rows.join(broadcast_if_small(plan), rows.source.eqNullSafe(F.col("s1"))).withColumn("copies", copies).drop("s1", "base", "threshold")


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """doc_id, source, size, h, source_size, target, copies for every document."""
    sized = sizes(docs)
    return with_copies(sized, mix_plan(sized, weights, share, most))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """docs with every row as often as the mix takes it."""
    plan = mix_plan(sizes(docs), weights, share, most)
    hashed = docs.select(F.struct(*docs.columns).alias("row"), "source", mix_hash(F.col("doc_id"), F.col("text")).alias("h"))
    taken = with_copies(hashed, plan).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
