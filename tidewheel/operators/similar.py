"""Similar rows by shared leaves (D31) and percentiles among them (D32), on bitmaps.

Training rows are numbered in the order of their value. A leaf of a tree is a bitmap of the places of its rows; a class of
rows with equal leaves has the union of its leaves' bitmaps. How many similar rows have smaller values is a count of bits
below a place, and the value at a rank is found by halving a bitmap. So no pair of rows or classes is made, a class is as
many rows as there are bitmaps of 32768 places, and nothing of it is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.functions.ranks import row_numbers, running_totals
from tidewheel.sources.io import at_rest

PLACES, BYTES = 32_768, 4_096


def _bucket(place: Column) -> Column:
    return F.bitmap_bucket_number(place)


def _count(bits: Column) -> Column:
    return F.coalesce(F.bitmap_count(bits), F.lit(0))


def _head(bits: Column, n: Column) -> Column:
    """The first n bytes."""
    return F.substring(bits, F.lit(1), n.cast("int"))


def _byte(bits: Column, n: Column) -> Column:
    """The byte after the first n."""
    return F.conv(F.hex(F.substring(bits, (n + 1).cast("int"), F.lit(1))), 16, 10).cast("int")


def _low_bits(byte: Column, n: Column) -> Column:
    """Ones among the n lowest bits of a byte."""
    return F.bit_count(byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), n.cast("int")) - 1)).cast("long")


def similar_bitmaps(train: DataFrame, rows: DataFrame, key: str, value: str) -> tuple[DataFrame, DataFrame]:
    """D31. leaves, bucket, bits, ones, before (ones of the buckets before) for the classes of rows; and the training rows'
    place and value. train, rows: key, leaves (array); train also value. Rows without a value take no part."""
    numbered = at_rest(row_numbers(train.filter(F.col(value).isNotNull()).select(key, value, "leaves"), [], [F.col(value).asc(), F.col(key).asc()], "place"))
    at = lambda df: df.select("*", F.posexplode("leaves").alias("tree", "leaf"))
    leaves = at(numbered).groupBy("tree", "leaf", _bucket(F.col("place")).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    classes = at(rows.select("leaves").distinct())
    per = classes.join(leaves, ["tree", "leaf"]).groupBy("leaves", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    last = numbered.agg(F.coalesce(F.max(_bucket(F.col("place"))), F.lit(0))).first()[0]
    # Every bucket of every class, so that what lies before a place is known wherever it is.
    every = rows.select("leaves").distinct().withColumn("bucket", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(max(last, 1)).cast("long"))))
    counted = every.join(per, ["leaves", "bucket"], "left").withColumn("ones", _count(F.col("bits")))
    before = F.sum("ones").over(Window.partitionBy("leaves").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    return at_rest(counted.withColumn("before", F.coalesce(before, F.lit(0)))), numbered.select("place", value)


def ones_upto(wanted: DataFrame, bitmaps: DataFrame, place: str, name: str) -> DataFrame:
    """wanted (leaves, place and more) with how many of the class's rows are at places up to that; place 0 is before all."""
    asked = wanted.withColumn("_bucket", _bucket(F.greatest(F.col(place), F.lit(1)).cast("long")))
    maps = bitmaps.select(F.col("leaves").alias("_leaves"), F.col("bucket").alias("_b"), "bits", "before")
    met = asked.join(maps, (F.col("leaves") == F.col("_leaves")) & (F.col("_bucket") == F.col("_b")))
    n = F.col(place) - (F.col("_bucket") - 1) * PLACES  # places of this bucket that count
    whole = F.floor(n / 8)
    inside = _count(_head(F.col("bits"), whole)) + F.coalesce(F.when(whole < BYTES, _low_bits(_byte(F.col("bits"), whole), n - whole * 8)), F.lit(0))
    return met.withColumn(name, F.when(F.col(place) > 0, F.col("before") + inside).otherwise(F.lit(0)).cast("long")).drop("_bucket", "_leaves", "_b", "bits", "before")


def places_of_ranks(wanted: DataFrame, bitmaps: DataFrame, rank: str) -> DataFrame:
    """wanted (leaves, rank from 0, and more) with the place of the class's row of that rank; ranks that it lacks are absent."""
    counts = bitmaps.select(F.col("leaves").alias("_leaves"), F.col("bucket").alias("_b"), F.col("before").alias("_before"), "ones")
    k = F.col(rank)
    found = wanted.join(counts, F.col("leaves") == F.col("_leaves")).filter((k >= F.col("_before")) & (k < F.col("_before") + F.col("ones"))).drop("_leaves", "ones")
    maps = bitmaps.select(F.col("leaves").alias("_leaves"), F.col("bucket").alias("_b2"), "bits")
    met = found.join(maps, (F.col("leaves") == F.col("_leaves")) & (F.col("_b") == F.col("_b2"))).withColumn("_k", k - F.col("_before"))
    # Halving: the most whole bytes that hold no more than _k ones.
    steps = F.array(*(F.lit(BYTES >> i) for i in range(1, BYTES.bit_length())))
    bytes_ = F.aggregate(steps, F.lit(0), lambda n, step: F.when(_count(_head(F.col("bits"), n + step)) <= F.col("_k"), n + step).otherwise(n))
    out = met.withColumn("_n", bytes_)
    out = out.withColumns({"_left": F.col("_k") - _count(_head(F.col("bits"), F.col("_n"))), "_byte": _byte(F.col("bits"), F.col("_n"))})
    bit = F.size(F.filter(F.sequence(F.lit(1), F.lit(8)), lambda i: _low_bits(F.col("_byte"), i) <= F.col("_left")))
    place = (F.col("_b") - 1) * PLACES + F.col("_n") * 8 + bit + 1
    return out.withColumn("place", place.cast("long")).drop("_leaves", "_b", "_b2", "bits", "_before", "_k", "_n", "_left", "_byte")


def performance(train: DataFrame, rows: DataFrame, key: str, value: str, drop_share: float = 0.05) -> DataFrame:
    """D32. key, percentile, p90, p95, p100: where a row's value lies among those of its similar training rows (and itself), without
    the similar values above their interpolated percentile 1 - drop_share; and the values at those shares, no greater than its own
    unless so before. Rows of a class without similar rows are absent."""
    bitmaps, places = similar_bitmaps(train, rows, key, value)
    per = bitmaps.groupBy("leaves").agg(F.sum("ones").alias("every")).filter("every > 0")
    # How many training rows have smaller values, and values up to each; own values too.
    counted = places.groupBy(value).agg(F.count("*").alias("n")).unionByName(rows.select(value, F.lit(0).cast("long").alias("n")).filter(F.col(value).isNotNull()))
    totals = at_rest(running_totals(counted.groupBy(value).agg(F.sum("n").alias("n")), [], [F.col(value).asc()], ["n"]))
    upto = totals.select(F.col(value).alias("_v"), F.col("upto_n").alias("_upto"), (F.col("upto_n") - F.col("n")).alias("_below"))

    edge = places_of_ranks(per.withColumn("_rank", F.floor((1 - drop_share) * (F.col("every") - 1)).cast("long")), bitmaps, "_rank").join(places, "place").select("leaves", F.col(value).alias("_edge"))
    kept = ones_upto(edge.join(upto, F.col("_edge") == F.col("_v")).select("leaves", "_upto"), bitmaps, "_upto", "all").select("leaves", "all")
    kept = at_rest(kept)

    shares = {"p90": 0.9, "p95": 0.95, "p100": 1.0}
    rank = {p: F.greatest(F.lit(1), F.ceil((F.col("all") + 1) * s)).cast("long") for p, s in shares.items()}
    asked = [F.struct(F.lit(f"{p}{tail}").alias("mark"), (r - back).alias("r")) for p, r in rank.items() for tail, back in (("", 1), ("_before", 2))]
    ranks = kept.select("leaves", "all", F.explode(F.array(*asked)).alias("x")).select("leaves", "all", "x.mark", "x.r").filter("r >= 0 and r < all")
    marks = places_of_ranks(ranks.select("leaves", "mark", "r"), bitmaps, "r").join(places, "place")
    marks = marks.groupBy("leaves").agg(*(F.max(F.when(F.col("mark") == f"{p}{tail}", F.col(value))).alias(f"_{p}{tail}") for p in shares for tail in ("", "_before")))

    own = rows.select(key, "leaves", value).join(upto.select("_v", "_below"), F.col(value) == F.col("_v")).drop("_v")
    placed = ones_upto(own, bitmaps, "_below", "_smaller").join(kept, "leaves").join(marks, "leaves", "left")
    at = lambda p: F.when(F.col(f"_{p}") <= F.col(value), F.col(f"_{p}")).otherwise(F.greatest(value, f"_{p}_before"))
    return placed.select(key, (100.0 * F.least("_smaller", "all") / (F.col("all") + 1)).alias("percentile"), *(at(p).alias(p) for p in shares))
