"""Quality by the perplexity of an interpolated modified Kneser-Ney character n-gram model.

The model is trained on trusted text (documents labelled as good). Counts of n-grams of four characters come from all
trusted documents: each task sums its own, the sums are merged by a shuffle on the n-gram, so no task holds them all.
Continuation counts, discounts and context totals are aggregations of that table, and joins on shared context and suffix
give each n-gram its interpolated probability, order by order; all are dealt by key. Unseen n-grams back off along the
same tables.

A document's perplexity is taken over its whole text. It is kept if that does not exceed a quantile, of its own
language, of the perplexities of trusted documents that the model was not trained on: one in ``FOLDS`` of them, by a
hash of the id, is held out for that.

With ``characters`` the n-grams are of the characters themselves: every code point is a symbol of its own, in texts of any
script. The three characters of context are one long of 21 bits each, the character is a column beside it. The n-grams
of all documents are joined with the model's tables to get their bits, and each document's n-grams, with how often it
has them, are joined with these. Nothing comes to the driver but counts of counts; the bits of the n-grams used most, 8 MB
at most, are broadcast, the rest is dealt by n-gram with the documents' n-grams. An unseen character has its share of all
code points.

Without, characters are folded into 64 symbols: small letters a to z, one symbol for capitals, some signs, and buckets of
code points for the letters of all other scripts. That is a coarser model of at most 64**4 entries, sent to the tasks that
score as one dense array of 32 MB.

Nulls and short texts: a null or empty text has a null perplexity and is not kept. A null language is a language of its
own; a language without trusted documents takes the quantile of all trusted documents. Without trusted documents no
perplexity is known and everything with text is kept. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import BROADCAST_BYTES, broadcast_if_small, by_bytes, remainder_of, sent_with_tasks, written

ORDER, SYMBOLS = 4, 64
PLAIN = "\n abcdefghijklmnopqrstuvwxyz.,!"
OTHER = {"capital": 31, "upper": 32, "digit": 33, "sign": 34, "letter": 35, "start": 63}
QUANTILE, FOLDS = 0.99, 5
#: Symbols of the model of characters: a code point plus one; START stands before a text. Bits of a symbol; code points.
START, BITS, POINTS = 0, 21, 0x110000
#: Characters of a text that a task takes at a time; a bit is SCALE, so sums of bits are whole and the same in any order.
STRETCH, SCALE = 1 << 20, 1 << 24


def symbol_table() -> np.ndarray:
    """Code point -> symbol: the plain characters, then classes and, for other letters, buckets of code points."""
    buckets = OTHER["start"] - OTHER["letter"]
    table = np.full(0x110000, OTHER["sign"], np.uint32)
    for p in range(len(table)):
        c = chr(p)
        if c.isalpha():
            table[p] = OTHER["capital" if p < 128 else "upper"] if c.isupper() else OTHER["letter"] + p % buckets
        elif c.isdigit():
            table[p] = OTHER["digit"]
    for k, c in enumerate(PLAIN):
        table[ord(c)] = k
    return table


def grams(text: str, table: np.ndarray) -> np.ndarray:
    """One n-gram id for each character; three start symbols stand before the text."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    s = np.concatenate([np.full(ORDER - 1, OTHER["start"], np.uint32), table[points]])
    out = s[ORDER - 1 :].copy()
    for k in range(1, ORDER):
        out |= s[ORDER - 1 - k : len(s) - k] << np.uint32(6 * k)
    return out


def gram_counts(trusted: DataFrame) -> DataFrame:
    """gram, n over all trusted texts; summed in each task first."""
    table = symbol_table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting = np.zeros(SYMBOLS**ORDER, np.int64), []
        for batch in batches:
            for t in batch.column("text"):
                waiting.append(grams(t.as_py(), table))
                if sum(map(len, waiting[-200:])) > 1 << 20 or len(waiting) >= 200:
                    ids, n = np.unique(np.concatenate(waiting), return_counts=True)
                    total[ids] += n
                    waiting = []
        if waiting:
            ids, n = np.unique(np.concatenate(waiting), return_counts=True)
            total[ids] += n
        ids = np.flatnonzero(total)
        for at in range(0, len(ids), 100_000):
            part = ids[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["gram", "n"])

    return trusted.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """What n-grams seen once, twice and more often give up, from how many were seen once to four times."""
    n, y = (n1, n2, n3, n4), n1 / (n1 + 2 * n2) if n1 + n2 else 0.0
    return tuple(min(float(k), max(0.0, k - (k + 1) * y * n[k] / n[k - 1])) if n[k - 1] else 0.5 for k in (1, 2, 3))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """order, gram, p, back: interpolated probabilities of the n-grams seen, and the back-off weight of each as a context.

    Below the highest order an n-gram counts by how many different symbols stand before it. The three discounts of an
    order come from its counts of counts.
    """
    levels = [counts.select("gram", "n")]
    for order in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << 6 * order) - 1))
        levels.append(levels[-1].groupBy(suffix.alias("gram")).agg(F.count("*").alias("n")))
    levels.reverse()  # now by order, 1 first
    lower, out = None, []
    for order, level in enumerate(levels, 1):
        d1, d2, d3 = discounts(*level.agg(*(F.count_if(F.col("n") == k) for k in (1, 2, 3, 4))).first())
        d = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        cut = level.withColumn("context", F.shiftright("gram", 6)).withColumn("d", d)
        totals = cut.groupBy("context").agg(F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("back"))
        seen = cut.join(totals, "context").withColumn("own", (F.col("n") - F.col("d")) / F.col("total"))
        if lower is None:
            solved = seen.withColumn("p", F.col("own") + F.col("back") / SYMBOLS)
        else:
            below = lower.select(F.col("gram").alias("suffix"), F.col("p").alias("p_low"))
            solved = seen.withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << 6 * (order - 1)) - 1))).join(below, "suffix").withColumn("p", F.col("own") + F.col("back") * F.col("p_low"))
        lower = written(solved.select("gram", "p"), f"kn-{order}")
        out.append(lower.withColumns({"order": F.lit(order), "back": F.lit(None).cast("double")}))
        out.append(totals.select(F.col("context").alias("gram"), F.lit(None).cast("double").alias("p"), F.lit(order).alias("order"), "back"))
    model = out[0]
    for part in out[1:]:
        model = model.unionByName(part)
    return written(model.select("order", "gram", "p", "back"), "kn-model")


def dense(model: DataFrame) -> np.ndarray:
    """-log2 p of every n-gram of the highest order, seen or not: 64**4 float16 from at most 2 * 64**4 rows of 13 bytes."""
    rows = model.select(F.col("order").cast("byte"), F.col("gram").cast("int"), F.col("p").cast("float"), F.col("back").cast("float")).toArrow()
    parts = [rows.filter(pa.compute.equal(rows["order"], k)) for k in range(1, ORDER + 1)]
    low = np.full(1, 1 / SYMBOLS, np.float32)
    for order in range(1, ORDER + 1):
        at = parts[order - 1]
        back = np.ones(SYMBOLS ** (order - 1), np.float32)
        contexts = at.filter(at["back"].is_valid())
        back[contexts["gram"].to_numpy()] = contexts["back"].to_numpy()
        p = np.tile(low, SYMBOLS) if order > 1 else np.full(SYMBOLS, 1 / SYMBOLS, np.float32)
        p *= np.repeat(back, SYMBOLS)
        seen = at.filter(at["p"].is_valid())
        p[seen["gram"].to_numpy()] = seen["p"].to_numpy()
        low = p
    return (-np.log2(np.maximum(low, 2.0**-24))).astype(np.float16)


def perplexity(docs: DataFrame, bits: np.ndarray, keep: list[str]) -> DataFrame:
    """The kept columns of docs with ``perplexity`` per character over the whole text."""
    table = symbol_table()
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # 64**4 values, whatever the corpus
    cols = [c for c in keep if c != "perplexity"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            got = [float(2 ** bits[grams(t, table)].mean(dtype=np.float64)) if (t := s.as_py()) else None for s in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in cols), pa.array(got, pa.float64())], [*cols, "perplexity"])

    schema = docs.select(*cols).withColumn("perplexity", F.lit(None).cast("double")).schema
    return docs.select(*cols, *(["text"] if "text" not in cols else [])).mapInArrow(run, schema)


def characters_of(text: str) -> np.ndarray:
    """The symbols of a text, with three start symbols before them."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.concatenate([np.full(ORDER - 1, START, np.uint32), points + np.uint32(1)])


def stretches(symbols: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """The symbols in parts of at most ``most`` n-grams; each n-gram is in one part."""
    for at in range(ORDER - 1, len(symbols), most):
        yield symbols[at - ORDER + 1 : at + most]


def distinct_grams(symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Context, character and count of the different n-grams; those that end in a start symbol are left out.

    n-grams are sorted as numbers of 16 bits a symbol, by a list of the symbols that occur. Symbols with more different
    ones than that are halved; then an n-gram may come twice, each time with a part of its count.
    """
    met = np.zeros(int(symbols.max()) + 1, bool)
    met[symbols] = True
    alphabet = np.flatnonzero(met)
    if len(alphabet) > 1 << 16:
        half = len(symbols) // 2
        yield from distinct_grams(symbols[:half])
        yield from distinct_grams(symbols[half - ORDER + 1 :])
        return
    codes = np.zeros(len(met), np.uint64)
    codes[alphabet] = np.arange(len(alphabet), dtype=np.uint64)
    s = codes[symbols]
    grams = s[ORDER - 1 :].copy()
    for k in range(1, ORDER):
        grams |= s[ORDER - 1 - k : len(s) - k] << np.uint64(16 * k)
    grams, n = np.unique(grams, return_counts=True)
    last, *before = (alphabet[(grams >> np.uint64(16 * k)) & np.uint64(0xFFFF)] for k in range(ORDER))
    context = sum(x << BITS * k for k, x in enumerate(before))
    real = last != START
    yield context[real], last[real].astype(np.int32), n[real]


def character_counts(docs: DataFrame) -> DataFrame:
    """context, c, n over all texts; summed in each stretch and task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[np.ndarray]:
            waiting, size = [], 0
            for batch in batches:
                for t in batch.column("text"):
                    symbols = characters_of(t.as_py())
                    if len(symbols) > STRETCH:
                        yield from stretches(symbols, STRETCH)
                        continue
                    waiting.append(symbols)  # whole texts: what spans two ends in a start symbol
                    size += len(symbols)
                    if size >= STRETCH:
                        yield np.concatenate(waiting)
                        waiting, size = [], 0
            if waiting:
                yield np.concatenate(waiting)

        for part in parts():
            for columns in distinct_grams(part):
                for at in range(0, len(columns[0]), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 100_000]) for x in columns], ["context", "c", "n"])

    found = docs.filter("length(text) > 0").select("text").mapInArrow(run, "context long, c int, n long")
    return found.groupBy("context", "c").agg(F.sum("n").alias("n"))


def context_of(order: int) -> Column:
    """The characters of a context that an n-gram of this order has before its last one."""
    return F.col("context").bitwiseAND(F.lit((1 << BITS * (order - 1)) - 1))


def character_bits(counts: DataFrame, asked: DataFrame) -> DataFrame:
    """context, c, uses, bits: -log2 of the interpolated probability of every n-gram asked for, seen or not, times SCALE.

    ``asked`` has how often each is asked for as n, which is handed on as ``uses``.
    Counts and discounts are as in ``kneser_ney``. Below the lowest order all code points are alike. Only if all three
    discounts of an order are zero can a probability be zero; it counts as 2**-60.
    """
    levels = [counts]
    for order in range(ORDER - 1, 0, -1):
        level = levels[-1].groupBy(context_of(order).alias("context"), "c").agg(F.count("*").alias("n"))
        levels.append(written(level, f"kn-level-{order}"))
    found = asked.select("context", "c", F.col("n").alias("uses"), F.lit(1 / POINTS).alias("p"))
    for order, level in enumerate(reversed(levels), 1):
        d = discounts(*level.agg(*(F.count_if(F.col("n") == k) for k in (1, 2, 3, 4))).first())
        given = sum(d[k] * F.count_if(F.least("n", F.lit(3)) == k + 1) for k in range(3))
        totals = level.groupBy(F.col("context").alias("at")).agg(F.sum("n").alias("total"), (given / F.sum("n")).alias("back"))
        cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        seen = level.select(F.col("context").alias("at"), "c", "n", (F.col("n") - cut).alias("left"))
        if order == 1:  # one context, the empty one
            found = found.withColumn("at", F.lit(0).cast("long")).join(F.broadcast(totals), "at", "left").join(seen.drop("at"), "c", "left")
        else:
            found = found.withColumn("at", context_of(order)).join(totals, "at", "left").join(seen, ["at", "c"], "left")
        p = F.coalesce(F.col("left") / F.col("total"), F.lit(0.0)) + F.coalesce("back", F.lit(1.0)) * F.col("p")
        found = found.select("context", "c", "uses", p.alias("p"))
    return written(found.select("context", "c", "uses", F.round(-F.log2(F.greatest("p", F.lit(2.0**-60))) * SCALE).cast("long").alias("bits")), "kn-bits")


def by_use(bits: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
    """The bits of the n-grams used most, ``most`` bytes of them at most, and those of all others, if there are any."""
    sizes = bits.groupBy(F.length(F.bin("uses")).alias("digits")).count().collect()  # 64 rows at most
    total, least = 0, 0
    for digits, n in sorted(sizes, reverse=True):
        total += n
        if total * 8 * 3 > most:
            least = 1 << digits
            break
    bits, often = bits.select("context", "c", "bits", "uses"), F.col("uses") >= least
    return bits.filter(often).drop("uses"), bits.filter(~often).drop("uses") if least else None


def character_perplexity(docs: DataFrame, bits: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, lang, perplexity per character over the whole text: each document's n-grams joined with their bits.

    The bits of the n-grams used most are broadcast. If they are not all, a document's other n-grams, which are rare, are
    dealt by n-gram and joined with the others' bits.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_bytes(whole, "text", 1_000, STRETCH):
                rows, ends, found = [], [0], []
                for i, t in enumerate(batch.column("text")):
                    parts = [x for s in stretches(characters_of(t.as_py() or ""), STRETCH) for x in distinct_grams(s)]
                    for x in parts or [(np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int64))]:
                        rows.append(i)
                        found.append(x)
                        ends.append(ends[-1] + len(x[0]))
                columns = [pa.array(np.concatenate(x)) for x in zip(*found)]
                values = pa.StructArray.from_arrays(columns, names=["context", "c", "times"])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                kept = batch.select(["row", "doc_id", "lang"]).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([*kept.columns, lists], ["row", "doc_id", "lang", "grams"])

    given = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "lang", "text")
    schema = given.drop("text").withColumn("grams", F.lit(None).cast("array<struct<context:long,c:int,times:long>>")).schema
    own = given.mapInArrow(run, schema).select("row", "doc_id", "lang", F.inline_outer("grams"))
    often, others = by_use(bits, most)
    own, key = own.join(F.broadcast(often), ["context", "c"], "left"), ["row", "doc_id", "lang"]
    sums = [F.sum(F.col("times") * F.col("bits")).alias("bits"), F.sum("times").alias("times")]
    if others is None:
        found = own.groupBy(*key).agg(*sums)
    else:
        rare = [F.when(F.col("bits").isNull(), F.col(x)).alias(x) for x in ("context", "c")]
        found = written(own.groupBy(*key, *rare).agg(*sums), "kn-parts")
        late = found.filter("c is not null").drop("bits").join(others, ["context", "c"]).select(*key, (F.col("times") * F.col("bits")).alias("bits"), "times")
        found = found.filter("c is null").select(*key, "bits", "times").unionByName(late).groupBy(*key).agg(F.sum("bits").alias("bits"), F.sum("times").alias("times"))
    return found.select("doc_id", "lang", F.pow(F.lit(2.0), F.col("bits") / F.col("times") / SCALE).alias("perplexity"))


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, folds: int = FOLDS, characters: bool = False) -> DataFrame:
    """doc_id, lang, perplexity, threshold, kept for every document.

    Trusted: documents with a label of quality 1 (any, if labels repeat). Of a language none of whose trusted documents
    is held out, the threshold is that of all held out; if there are none at all, that of all trusted documents. The model
    is of characters, or of the 64 symbols of ``symbol_table``.
    """
    docs = docs.select("doc_id", "lang", "text")
    good = labels.filter("doc_id is not null and quality = 1").select(F.col("doc_id").alias("good_id")).distinct()
    good = broadcast_if_small(good)
    trusted = docs.filter("length(text) > 0").join(good, F.col("doc_id") == F.col("good_id"), "left_semi")
    held = remainder_of(F.col("doc_id"), folds) == 0
    count = character_counts if characters else gram_counts
    counts = written(count(trusted.filter(~held)), "kn-counts")
    if counts.isEmpty():  # so few are trusted that all are held out
        counts = written(count(trusted), "kn-counts")
    if counts.isEmpty():
        return docs.select("doc_id", "lang", F.lit(None).cast("double").alias("perplexity"), F.lit(None).cast("double").alias("threshold"), F.coalesce(F.length("text") > 0, F.lit(False)).alias("kept"))
    if characters:
        scored = character_perplexity(docs, character_bits(counts, written(character_counts(docs), "kn-asked")))
    else:
        scored = perplexity(docs, dense(kneser_ney(counts)), ["doc_id", "lang"])
    scored = written(scored, "kn-scored")
    trusted = scored.filter("perplexity is not null").join(good, F.col("doc_id") == F.col("good_id"), "left_semi")
    sure = trusted.filter(held)
    if sure.isEmpty():
        sure = trusted
    q = lambda: F.percentile_approx("perplexity", quantile, 10_000)
    per = sure.groupBy("lang").agg(q().alias("own")).withColumnRenamed("lang", "l1")
    overall = sure.agg(q()).first()[0]
    joined = scored.join(per, scored.lang.eqNullSafe(F.col("l1")), "left")
    out = joined.select("doc_id", "lang", "perplexity", F.coalesce("own", F.lit(overall).cast("double")).alias("threshold"))
    return out.withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)))


sent_with_tasks(__name__)
