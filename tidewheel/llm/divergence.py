"""How much the sources of a language differ in their words: chi-square-like divergences in exact integers.

A document's terms are its runs of letters and of characters beyond ASCII, A to Z lower-cased. A language keeps the
terms that at least ``LEAST_DOCS`` of its documents hold. A group is a source within a language. Its share of a term is
p = 1 + floor(10**9 * (count + 1) / (N + V)), N its occurrences of kept terms and V their number; the divergence of a
term from share p to share q is floor((p - q)**2 / q).

1. Terms are counted in batches, by group, so a hot source or a hot word is a few rows a task before any shuffle.
2. Every pair of groups is compared over every kept term by cube partitioning. Groups are dealt into blocks, terms into
   blocks, and a cell (group block, group block, term block) is one piece of work: the slices of its two group blocks in
   its term block are sent to it, and it sums the divergences of all its pairs over its terms. The sums of the cells are
   added along the term axis. A slice goes to as many cells as there are group blocks; no cell is larger than its two
   slices, whatever the numbers of groups and terms.
3. A term that neither group of a pair holds has the same divergence for all such terms. Cells leave it out: they sum the
   difference from it, and it is added V times in the end.

Null text, lang and source count as ''. Every row is a document, rows that repeat a doc_id too. A group without terms
has the least share of all kept terms. A language without kept terms has pairs of value 0. An empty table gives no
rows. Other columns are not read. Counts are exact up to 10**18.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.common import broadcast_if_small, sent_with_tasks, written

LEAST_DOCS, TOP_TERMS = 3, 200
#: Groups and terms of a block (about); different terms a task holds before it hands them on.
GROUPS, TERMS, HELD = 64, 2_048, 200_000
#: Bytes outside letters become blanks; A to Z become small letters; bytes of characters beyond ASCII stay.
LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(LETTERS).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it) of every group."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary").alias(name)
    names = ["lang", "source", "term", "n", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, in_docs) in held.items():
                terms = list(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(terms), pa.binary()), pa.array([source] * len(terms), pa.binary()), pa.array(terms, pa.binary()), pa.array(n.values(), pa.int64()), pa.array([in_docs[t] for t in terms], pa.int64())], names)
            held.clear()

        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                for lang, source, words in zip(*(c.to_pylist() for c in whole.slice(at, 200).columns), strict=True):
                    found = terms_of(words)
                    n, in_docs = held.setdefault((lang, source), (Counter(), Counter()))
                    size -= len(n)
                    n.update(found)
                    in_docs.update(set(found))
                    size += len(n)
                    if size > HELD:
                        yield from flush()
                        size = 0
        yield from flush()

    parts = docs.select(text("lang"), text("source"), text("text")).mapInArrow(run, "lang binary, source binary, term binary, n long, docs long")
    string = lambda c: F.col(c).cast("string").alias(c)
    return parts.select(string("lang"), string("source"), string("term"), "n", "docs").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(10**9 * (n + 1) / (total + v)), exactly."""
    times = F.lit(10**9).cast("decimal(20,0)") * (n + 1).cast("decimal(18,0)")
    whole = F.greatest((total + v).cast("decimal(20,0)"), F.lit(1).cast("decimal(20,0)"))
    return F.lit(1).cast("long") + F.call_function("div", times, whole)


def groups_of(docs: DataFrame, kept: DataFrame, terms: DataFrame) -> DataFrame:
    """lang, source, n_group, n_lang, v, low (share of an absent term), block, blocks, slices: one row for every group."""
    own = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source")).distinct()
    per = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("n_lang"))
    sources = own.groupBy("lang").agg(F.count("*").alias("sources"))
    out = own.join(per, ["lang", "source"], "left").join(sources, "lang").join(langs, "lang", "left").fillna(0, ["n_group", "n_lang", "v"])
    parts = lambda n, size: F.greatest(F.ceil(F.col(n) / size), F.lit(1)).cast("int")
    out = out.withColumn("blocks", parts("sources", GROUPS)).withColumn("slices", parts("v", TERMS))
    return out.select("lang", "source", "n_group", "n_lang", "v", share(F.lit(0), F.col("n_group"), F.col("v")).alias("low"), F.pmod(F.xxhash64("source"), "blocks").cast("int").alias("block"), "blocks", "slices")


def cell_sums(table: pa.Table) -> pa.Table:
    """The divergences of all pairs of groups of a cell, over its terms, above those of terms that neither group holds.

    Rows without a term are one for each group of the cell; ``low`` is its share of the terms that it does not hold.
    """
    a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
    marks = table.filter(pc.is_null(table.column("term")))
    entries = table.filter(pc.is_valid(table.column("term")))
    names, low, block, v = marks.column("source").to_pylist(), marks.column("low").to_numpy(), marks.column("block").to_numpy(), marks.column("v").to_numpy()
    term = entries.column("term").combine_chunks().dictionary_encode() if entries.num_rows else None
    n = len(term.dictionary) if term else 0
    p = np.repeat(low[:, None], n, 1)
    if n:
        row = pc.index_in(entries.column("source"), value_set=pa.array(names, pa.string())).to_numpy()
        p[row, term.indices.to_numpy()] = entries.column("p").to_numpy()
    out: list[tuple] = []
    for g in np.flatnonzero(block == a):
        others = np.flatnonzero(block == b)
        others = others[others > g] if a == b else others
        if not len(others):
            continue
        square = (p[g] - p[others]) ** 2
        square_low = (low[g] - low[others]) ** 2
        there, back = square_low // low[others], square_low // low[g]
        for h, x, x0, y, y0 in zip(others, (square // p[others]).sum(1) - n * there, there, (square // p[g]).sum(1) - n * back, back, strict=True):
            out += [(names[g], names[h], int(x), int(x0), int(v[g])), (names[h], names[g], int(y), int(y0), int(v[g]))]
    cols = list(zip(*out, strict=True)) or [()] * 5
    lang = pa.array([table.column("lang")[0].as_py()] * len(out), pa.string())
    return pa.table([lang, *(pa.array(c, pa.string()) for c in cols[:2]), *(pa.array(c, pa.int64()) for c in cols[2:])], ["lang", "source", "item", "above", "absent", "v"])


def ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def pair_divergences(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value, rank: each group against each other source of its language, over all kept terms."""
    marks = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("p"), "low", "v", "block", "blocks", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("k"))
    dealt = entries.select("lang", "source", "term", "p", "low", "v", "block", "blocks", F.pmod(F.xxhash64("term"), "slices").cast("int").alias("k")).unionByName(marks)
    sent = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sent = sent.select("lang", "source", "term", "p", "low", "v", "block", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "k")
    cells = sent.groupBy("lang", "a", "b", "k").applyInArrow(cell_sums, "lang string, source string, item string, above long, absent long, v long")
    value = F.sum("above") + F.max("v") * F.max("absent")
    return ranked(cells.groupBy("lang", "source", "item").agg(value.alias("value")))


def term_divergences(entries: DataFrame, most: int = TOP_TERMS) -> DataFrame:
    """lang, source, item, value, rank: the terms that a group holds more than its language does, the ``most`` largest."""
    p, q = F.col("p"), share(F.col("n_term"), F.col("n_lang"), F.col("v"))
    above = entries.withColumn("q", q).filter(p > F.col("q"))
    value = F.call_function("div", (p - F.col("q")) * (p - F.col("q")), F.col("q"))
    return ranked(above.select("lang", "source", F.col("term").alias("item"), value.alias("value"))).filter(F.col("rank") <= most)


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, most: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank of every group."""
    counts = written(term_counts(docs), "source-terms")
    terms = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang")).filter(F.col("docs") >= least_docs)
    terms = written(terms.select("lang", "term", "n_lang"), "language-terms")
    kept = written(counts.join(terms, ["lang", "term"]).select("lang", "source", "term", "n", F.col("n_lang").alias("n_term")), "kept-terms")
    groups = written(groups_of(docs, kept, terms), "groups")
    entries = kept.join(broadcast_if_small(groups), ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("n_group"), F.col("v")))
    part = lambda rows, name: rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
    return part(pair_divergences(entries, groups), "pair").unionByName(part(term_divergences(entries, most), "term"))


sent_with_tasks(__name__)
