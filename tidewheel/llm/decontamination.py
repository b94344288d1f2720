"""Benchmark decontamination by size-partitioned MinHash containment search. Spark SQL functions only.

A test item is contained in a document if at least num / den of its distinct word shingles occur there. Items are put
into size classes (powers of two of their number of shingles). Each class has its own MinHash sketch: the k smallest
shingle hashes of the item, k being one more than the most shingles that a contained item of that class can miss. So
a document that contains an item holds at least one hash of its sketch, whatever the document's length: the search
loses nothing, and short items do not vanish in long documents as they do where whole sets are compared.

The sketches' hashes are also folded into a bit map of fixed size. Documents test their shingles against it before
anything is exploded or shuffled; the few that pass are joined with the sketches. Each candidate pair is then verified
on the shingles themselves.

Words are runs of letters and digits, lower-cased. An item of fewer words than a shingle takes is one shingle of its own
length, and documents are shingled at the lengths of such items too: it is found wherever its words stand in a row, so an
item of a single common word is found in all documents that hold the word.
Nulls: a null text, or one without words, contains nothing and is contained nowhere; a null item_id takes no part.
Documents are told apart by doc_id and text, so ``clean`` judges rows of a null or repeated doc_id each by its own text;
``contaminated`` names documents, so rows of a null doc_id are not in it. Repeated rows give one pair. Empty tables give
no pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import broadcast_if_small, written

WORDS, NUM, DEN = 5, 80, 100
BITMAP_BITS = 18


def words_of(text: str = "text") -> Column:
    return F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def runs(column: str, k: int, of) -> Column:
    """What ``of`` makes of each run of k elements; none where there are fewer."""
    x = F.col(column)
    many = F.transform(F.sequence(F.lit(1), F.size(x) - k + 1), lambda i: of(x, i, k))
    return F.when(F.size(x) >= k, many).otherwise(F.array())


def shingles(column: str, lengths: list[int]) -> Column:
    """Distinct shingles of a column of words, as text, of all the lengths."""
    joined = lambda x, i, k: F.array_join(F.slice(x, i, k), " ")
    return F.array_distinct(F.concat(*(runs(column, k, joined).cast("array<string>") for k in lengths)))


def shingle_hashes(column: str, lengths: list[int]) -> Column:
    """Hashes of the shingles, repeats included; a shingle's hash is made of its words' hashes."""
    mixed = lambda x, i, k: F.xxhash64(*(F.get(x, i - 1 + j) for j in range(k)))
    return F.concat(*(runs(column, k, mixed).cast("array<bigint>") for k in lengths))


def with_words(df: DataFrame) -> DataFrame:
    return df.withColumn("words", words_of()).withColumn("word_hashes", F.transform("words", lambda x: F.xxhash64(x)))


def by_length(items: DataFrame, n: int, shape) -> Column:
    """``shape`` at an item's own length: n words, or all it has if fewer."""
    return F.coalesce(*(F.when(F.least(F.size("words"), F.lit(n)) == k, shape([k])) for k in range(1, n + 1)))


def sketch(items: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """item_id, length, hash: each item's sketch, as large as its size class needs."""
    worded = with_words(items.select("item_id", "text")).filter(F.size("words") > 0)
    hashes = F.array_sort(F.array_distinct(by_length(worded, n, lambda k: shingle_hashes("word_hashes", k))))
    sets = worded.select("item_id", F.least(F.size("words"), F.lit(n)).alias("length"), hashes.alias("hashes"))
    size_class = F.floor(F.log2(F.size("hashes").cast("double")))
    largest = F.pow(F.lit(2.0), size_class + 1) - 1
    k = F.floor(largest * (den - num) / den + 1e-9).cast("int") + 1
    return sets.select("item_id", "length", F.explode(F.slice("hashes", F.lit(1), F.least(k, F.size("hashes")))).alias("hash"))


def bitmap(sketches: DataFrame) -> list[int]:
    """2**BITMAP_BITS bits, 32 in a number; a bit is set if a sketch has a hash that falls on it. As large whatever the items."""
    bit = F.pmod("hash", F.lit(1 << BITMAP_BITS))
    words = sketches.select(F.shiftright(bit, 5).cast("int").alias("at"), F.expr(f"shiftleft(1L, cast(pmod(hash, {1 << BITMAP_BITS}) & 31 as int))").alias("one"))
    out = [0] * (1 << BITMAP_BITS - 5)
    for at, bits in words.groupBy("at").agg(F.bit_or("one")).collect():
        out[at] = bits
    return out


def candidates(docs: DataFrame, sketches: DataFrame, lengths: list[int]) -> DataFrame:
    """doc_id, text_hash, item_id of documents that hold a hash of an item's sketch."""
    bits = F.expr(f"array({', '.join(f'{b}L' for b in bitmap(sketches))})")  # 64 KB: fixed size
    rows = with_words(docs.select("doc_id", "text").filter("text is not null")).select("doc_id", F.xxhash64("text").alias("text_hash"), shingle_hashes("word_hashes", lengths).alias("hashes"))
    passes = lambda h: F.getbit(F.get(bits, F.shiftright(F.pmod(h, F.lit(1 << BITMAP_BITS)), 5).cast("int")), h.bitwiseAND(F.lit(31)).cast("int")) == 1
    hits = rows.select("doc_id", "text_hash", F.explode(F.array_distinct(F.filter("hashes", passes))).alias("hash"))
    return hits.join(sketches, "hash").select("doc_id", "text_hash", "item_id").distinct()


def leaks(docs: DataFrame, items: DataFrame, n: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, text_hash, item_id, n_shared, n_item of every document and item with containment of num / den or more."""
    items = items.filter("item_id is not null and text is not null")
    sketches = written(sketch(items, n, num, den), "item-sketches")
    lengths = [r.length for r in sketches.select("length").distinct().orderBy("length").collect()] or [n]  # n of them at most
    pairs = written(candidates(docs, sketches, lengths), "item-candidates")
    found = broadcast_if_small(pairs.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "item_id"))
    hashed = docs.filter("text is not null").select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    texts = hashed.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")))
    doc_sets = texts.withColumn("words", words_of()).select("doc_id", "text_hash", "item_id", shingles("words", lengths).alias("doc_set"))
    worded = items.withColumn("words", words_of()).filter(F.size("words") > 0)
    item_sets = worded.select(F.col("item_id").alias("i"), by_length(worded, n, lambda k: shingles("words", k)).alias("item_set"))
    both = doc_sets.join(item_sets, F.col("item_id") == F.col("i")).withColumn("n_shared", F.size(F.array_intersect("item_set", "doc_set")).cast("long")).withColumn("n_item", F.size("item_set").cast("long"))
    return both.filter(F.col("n_shared") * den >= F.col("n_item") * num).select("doc_id", "text_hash", "item_id", "n_shared", "n_item")


def contaminated(docs: DataFrame, items: DataFrame, n: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, item_id, n_shared, n_item, containment of every pair with containment of num / den or more."""
    best = leaks(docs.filter("doc_id is not null"), items, n, num, den)
    # A doc_id or item_id of several rows gives one pair, the fullest.
    one = best.groupBy("doc_id", "item_id").agg(F.max(F.struct((F.col("n_shared") / F.col("n_item")).alias("c"), "n_shared", "n_item")).alias("x"))
    return one.select("doc_id", "item_id", "x.n_shared", "x.n_item", F.col("x.c").alias("containment"))


def clean(docs: DataFrame, items: DataFrame, n: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """docs without the rows whose text contains a test item."""
    found = leaks(docs, items, n, num, den).select(F.col("doc_id").alias("__leak"), F.col("text_hash").alias("__hash")).distinct()
    found = broadcast_if_small(written(found, "leaks"))
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("__leak")) & (F.xxhash64("text") == F.col("__hash")), "left_anti")
