"""Removal of lines that spread over many sites. Spark SQL functions only.

Lines are hashed. For each hash a HyperLogLog sketch of the sites it stands on is built in every task and merged by
aggregation, so a line of a third of all rows is a few sketches. A hash whose estimate is clearly above the threshold is
boilerplate, clearly below it is not; near the threshold the sites are counted exactly. Boilerplate lines are removed
from every document of every site.

Lines are compared trimmed of blanks; blank lines always stay. A null site is a site of its own. A null text stays null.
A document that loses all its lines keeps an empty text. Rows that repeat a doc_id are treated each by itself. An
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import broadcast_if_small, written

SITES, MARGIN, SKETCH_BITS = 5, 0.25, 10


def lines(docs: DataFrame) -> DataFrame:
    """site and hash of every line that is not blank."""
    each = docs.select(F.coalesce(F.col("source"), F.lit("\u0000null")).alias("site"), F.explode(F.split("text", "\n")).alias("line"))
    return each.select("site", F.trim("line").alias("line")).filter("line <> ''").select("site", F.xxhash64("line").alias("h1"), F.hash("line").alias("h2"))


def boilerplate(docs: DataFrame, sites: int = SITES, margin: float = MARGIN) -> DataFrame:
    """h1, h2, n_sites of the lines that stand on ``sites`` sites or more."""
    each = lines(docs)
    spread = each.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", SKETCH_BITS).alias("sketch")).select("h1", "h2", F.hll_sketch_estimate("sketch").alias("about"))
    likely = written(spread.filter(F.col("about") >= sites * (1 - margin)), "likely-lines")
    sure = likely.filter(F.col("about") > sites * (1 + margin)).select("h1", "h2", F.col("about").alias("n_sites"))
    near = likely.filter(F.col("about") <= sites * (1 + margin)).select("h1", "h2")
    exact = each.join(near, ["h1", "h2"], "left_semi").distinct().groupBy("h1", "h2").agg(F.count("*").alias("n_sites")).filter(F.col("n_sites") >= sites)
    return written(sure.unionByName(exact), "boilerplate")


def without(parts: Column, gone: Column) -> Column:
    """The array without the places in ``gone`` (ascending, from 0): what lies between them, in one pass over the array."""
    ends = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(parts)))
    between = lambda s, i: F.slice(s["parts"], F.get(s["ends"], i) + 2, F.get(s["ends"], i + 1) - F.get(s["ends"], i) - 1)
    kept = lambda s: F.flatten(F.transform(F.sequence(F.lit(0), F.size(s["ends"]) - 2), lambda i: between(s, i)))
    # As the variable of a lambda the text is split once, not once for each stretch.
    return F.transform(F.array(F.struct(parts.alias("parts"), ends.alias("ends"))), kept)[0]


def remove_boilerplate(docs: DataFrame, sites: int = SITES, margin: float = MARGIN) -> DataFrame:
    """All columns of docs, text without boilerplate lines, with ``n_lines`` (not blank) and ``n_removed``; columns of these names are replaced."""
    found = boilerplate(docs, sites, margin).select("h1", "h2")
    # The input's columns stay in one struct, so no name of theirs meets one made here.
    rows = docs.select(F.struct(*docs.columns).alias("__whole"), F.struct("doc_id", F.xxhash64("text", "source")).alias("__row"), "text")
    place = rows.select("__row", F.posexplode(F.split("text", "\n")).alias("pos", "line")).select("__row", "pos", F.trim("line").alias("line")).filter("line <> ''")
    gone = place.select("__row", "pos", F.xxhash64("line").alias("h1"), F.hash("line").alias("h2")).join(found, ["h1", "h2"], "left_semi")
    per = written(gone.groupBy(F.col("__row").alias("__key")).agg(F.array_sort(F.collect_set("pos")).alias("__gone")), "lines-gone")
    joined = rows.join(broadcast_if_small(per), F.col("__row").eqNullSafe(F.col("__key")), "left")
    parts = F.split("text", "\n")
    left = without(parts, F.col("__gone"))
    full = F.coalesce(F.size(F.filter(parts, lambda x: F.trim(x) != "")), F.lit(0)).cast("long")
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(full).cast("long").alias("n_lines")
    n_removed = F.coalesce(F.when(F.size("__gone") > 0, F.size("__gone")), F.lit(0)).cast("long").alias("n_removed")
    same = [text.alias(c) if c == "text" else F.col("__whole").getField(c).alias(c) for c in docs.columns if c not in ("n_lines", "n_removed")]
    return joined.select(*same, n_lines, n_removed)
