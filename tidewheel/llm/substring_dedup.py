"""Removal of passages that an earlier document holds too, by an FM-index for each shard.

A window is ``words`` consecutive words of a document. A word is removed if a window over it also starts in a document
with a smaller doc_id. Windows are judged on the input.

1. Every window is named by its least hash among its runs of ``GRAM`` words; consecutive windows of one name are one run.
   Equal windows have equal names, so a window needs to be compared with runs of its own name only.
2. Runs are sorted over the cluster by name, content and doc_id and walked once. A name in one document only cannot
   repeat. Of runs of equal content the one of the smallest doc_id is kept; in all others every window repeats. No group
   has to fit a task: what lies across the edge of a task is kept twice, which costs time only.
3. The kept runs, as words, are dealt to shards by name. A shard's task builds an FM-index over its runs (a wavelet
   matrix of their Burrows-Wheeler transform) and streams them through it: backward search gives the matching statistics
   of each place, and where these reach ``words`` the rows of the match give the smallest doc_id that holds the window.
4. A name of more than ``HOT`` runs would swell its shard. Its windows are taken one by one and each finds its smallest
   doc_id by an aggregation.
5. Spans meet by document, are merged, and the words in them are left out.

Steps 1 and 2 know words and runs by 64-bit hashes; step 3 compares the words. Words are separated by blanks and the
control characters 9 to 13; kept words are joined by one space. A null text stays null and has no words. A null doc_id
is smaller or larger than nothing: its row stays whole. Rows that repeat a doc_id are one document as to order, and
each its own text. A doc_id is a whole number, or text of one. Fewer words than a window stay. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import broadcast_if_small, sent_with_tasks, written
from tidewheel.llm.fm_index import FmIndex, matching_statistics

WORDS, GRAM = 13, 6
#: Runs of a shard (about), and of a name beyond which it is taken window by window; bytes of text hashed at once.
SHARD, HOT, BLOCK = 25_000, 12_500, 1 << 20
SPACE = np.array([b in b" \t\n\x0b\x0c\r" for b in range(256)])
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE, INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_rng = np.random.default_rng(20240612)
BYTES, PLACES = (_rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1) for n in (256, 256))
RUNS = "gram long, content long, doc_id long, row long, start long, n int"


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def stretch_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each stretch values[begin:end], from prefix sums of a polynomial modulo 2**64 and the stretch's length."""
    out = np.empty(len(begin), np.uint64)
    low = 0
    while low < len(begin):
        high = max(low + 1, int(np.searchsorted(end, begin[low] + BLOCK, "right")))
        base, top = int(begin[low]), int(end[high - 1])
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[base:top] * powers(BASE, top - base), dtype=np.uint64)])
        b, e = begin[low:high] - base, end[low:high] - base
        out[low:high] = mixed((sums[e] - sums[b]) * powers(INVERSE, top - base + 1)[b] + (e - b).astype(np.uint64) * M2)
        low = high
    return out


def word_bounds(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end in texts that lie one after another; edges: where each text begins, and the end."""
    space = SPACE[data]
    begins, ends = np.concatenate([[True], space[:-1]]), np.concatenate([space[1:], [True]])
    inner = edges[(edges > 0) & (edges < len(data))]
    begins[inner], ends[inner - 1] = True, True
    return np.flatnonzero(~space & begins), np.flatnonzero(~space & ends) + 1


def runs_of(data: np.ndarray, edges: np.ndarray, words: int, gram: int) -> tuple[np.ndarray, ...]:
    """text (its number), start (word in its text), windows, name and content of the runs of windows of one name."""
    begin, end = word_bounds(data, edges)
    text = np.searchsorted(edges, begin, "right") - 1
    n = len(begin) - words + 1
    if n < 1:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    h = stretch_hashes(BYTES[data], begin, end)
    grams = np.zeros(len(h) - gram + 1, np.uint64)
    for k in range(gram):
        grams += h[k : len(grams) + k] * PLACES[k]
    grams = mixed(grams)
    least, at = grams[:n].copy(), np.arange(n)
    for k in range(1, words - gram + 1):
        less = grams[k : n + k] < least
        least[less] = grams[k : n + k][less]
        at[less] = np.flatnonzero(less) + k
    window = np.flatnonzero(text[:n] == text[words - 1 :])
    if not len(window):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    new = np.concatenate([[True], (np.diff(window) > 1) | (np.diff(at[window]) != 0) | (np.diff(text[window]) != 0)])
    first = np.flatnonzero(new)
    start, size = window[first], np.diff(np.append(first, len(window)))
    content = stretch_hashes(h, start, start + size + words - 1)
    own = start - np.searchsorted(text, text[start])
    return text[start], own, size, least[start].view(np.int64), content.view(np.int64)


def texts_of(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The batch's texts in parts of about BLOCK bytes, one text at least: number of the first, bytes, edges of the texts."""
    column = batch.column("text").cast(pa.large_binary())
    if not len(column):
        return
    _, edges, data = column.buffers()
    edges = np.frombuffer(edges, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(edges, edges[low] + BLOCK, "right")) - 1)
        yield low, data[edges[low] : edges[high]], edges[low : high + 1] - edges[low]
        low = high


def named_runs(rows: DataFrame, words: int) -> DataFrame:
    """gram (the name), content, doc_id, row, start (a word of the text, from 0) and n (windows) of the runs of every text."""
    gram = min(GRAM, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("doc_id").to_numpy(), batch.column("row").to_numpy()
            for at, data, edges in texts_of(batch):
                text, start, n, name, content = runs_of(data, edges, words, gram)
                if len(text):
                    arrays = [name, content, ids[at + text], keys[at + text], start, n.astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["gram", "content", "doc_id", "row", "start", "n"])

    return rows.mapInArrow(run, RUNS)


def repeated(runs: DataFrame) -> DataFrame:
    """The runs whose name stands in several documents; copy: an earlier document holds the whole run.

    The runs come sorted over all tasks. At the edges of a task a name counts as repeated, and the first content as new.
    """
    names = ["gram", "content", "doc_id", "row", "start", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 5 + [np.zeros(0, np.int32)]
        # Of the last row seen: its name (known as repeated), content and that content's first document.
        last, begun = None, False
        for batch in batches:
            cols = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, names, strict=True)]
            gram, content, doc = cols[:3]
            if not len(gram):
                continue
            group = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
            size = np.diff(np.append(group, len(gram)))
            several = np.minimum.reduceat(doc, group) < np.maximum.reduceat(doc, group)
            if not begun or (last and last[0] == gram[0]):
                several[0] = True
            begun = True
            head = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (content[1:] != content[:-1])]))
            first = doc[head]
            if last and last[0] == gram[0] and last[1] == content[0]:
                first[0] = last[2]
            first = np.repeat(first, np.diff(np.append(head, len(gram))))
            keep = len(gram) if several[-1] else int(group[-1])  # the last name is not known yet
            out = np.flatnonzero(np.repeat(several, size)[:keep])
            if len(out):
                yield pa.RecordBatch.from_arrays([*(pa.array(c[out]) for c in (gram, *cols[2:])), pa.array(doc[out] > first[out])], ["gram", *names[2:], "copy"])
            last = (gram[-1], content[-1], first[-1]) if several[-1] else None
            held = [c[keep:] for c in cols]
        if len(held[0]):
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in (held[0], *held[2:])), pa.array(np.zeros(len(held[0]), bool))], ["gram", *names[2:], "copy"])

    dealt = runs.repartitionByRange(*names[:5]).sortWithinPartitions(*names[:5])
    return dealt.mapInArrow(run, "gram long, doc_id long, row long, start long, n int, copy boolean")


def run_words(rows: DataFrame, kept: DataFrame, words: int) -> DataFrame:
    """kept (doc_id, row, and lists gram, start, n of its runs) with the words of each run, joined by blanks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, texts, size = [], [], 0

        def done() -> pa.RecordBatch:
            cols = [np.concatenate(c) for c in zip(*parts, strict=True)]
            return pa.RecordBatch.from_arrays([*(pa.array(c) for c in cols), pa.array(texts, pa.binary())], ["gram", "doc_id", "row", "start", "n", "text"])

        for batch in batches:
            ids, keys, lists = batch.column("doc_id").to_numpy(), batch.column("row").to_numpy(), batch.column("runs")
            for k, text in enumerate(batch.column("text")):
                found = text.as_py().split()
                plain = b" ".join(found)
                at = np.concatenate([[0], np.cumsum([len(w) + 1 for w in found])])
                own = lists[k].values
                gram, start, n = (own.field(c).to_numpy() for c in ("gram", "start", "n"))
                texts += [plain[a:b] for a, b in zip(at[start].tolist(), (at[start + n + words - 1] - 1).tolist(), strict=True)]
                parts.append((gram, np.full(len(n), ids[k]), np.full(len(n), keys[k]), start, n))
                size += len(n)
                if size > 5_000:
                    yield done()
                    parts, texts, size = [], [], 0
        if parts:
            yield done()

    per = kept.groupBy(F.col("doc_id").alias("d"), F.col("row").alias("r")).agg(F.collect_list(F.struct("gram", "start", "n")).alias("runs"))
    met = rows.join(per, (F.col("doc_id") == F.col("d")) & (F.col("row") == F.col("r"))).select("doc_id", "row", "text", "runs")
    return met.mapInArrow(run, "gram long, doc_id long, row long, start long, n int, text binary")


def shard_spans(table: pa.Table, words: int) -> pa.Table:
    """doc_id, row, low, high: the stretches of the shard's runs whose windows an earlier document holds."""
    doc, start, n = (table.column(c).to_numpy() for c in ("doc_id", "start", "n"))
    texts = [t.split(b" ") for t in table.column("text").to_pylist()]
    sizes = np.array([len(t) for t in texts])
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    number = {w: k for k, w in enumerate(sorted({w for t in texts for w in t}), 1)}
    text = np.zeros(begin[-1], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    inside = np.arange(len(text)) - begin[owner] < sizes[owner]
    text[inside] = [number[w] for t in texts for w in t]
    index = FmIndex(text, len(number) + 1, words)
    ends = np.flatnonzero(inside & (np.arange(len(text)) - begin[owner] >= words - 1))
    length, low, high = matching_statistics(index, text, ends, words)
    ends, low, high = (x[length == words] for x in (ends, low, high))
    if len(ends):
        # Rows of equal windows are one stretch: the smallest document of each.
        edges, at = np.unique(low, return_index=True)
        bounds = np.column_stack([edges, high[at]]).ravel()
        docs = np.append(doc[owner[index.suffixes]], np.iinfo(np.int64).max)
        earliest = np.minimum.reduceat(docs, bounds)[::2][np.searchsorted(edges, low)]
        ends = ends[earliest < doc[owner[ends]]]
    own = owner[ends]
    window = ends - begin[own] - (words - 1)
    new = np.concatenate([[True], (np.diff(own) != 0) | (np.diff(window) != 1)])[: len(own)]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(own))[: len(first)] - 1
    low, high = start[own[first]] + window[first], start[own[first]] + window[last] + words
    return pa.table([pa.array(doc[own[first]]), table.column("row").take(pa.array(own[first])), pa.array(low), pa.array(high)], ["doc_id", "row", "low", "high"])


def indexed_spans(rows: DataFrame, kept: DataFrame, words: int) -> DataFrame:
    """Spans found by the shards' indexes; kept: runs of names that are not hot."""
    shards = max(1, -(-kept.count() // SHARD))
    texts = run_words(rows, kept, words).withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(shards)))
    return texts.groupBy("shard").applyInArrow(lambda t: shard_spans(t, words), "doc_id long, row long, low long, high long")


def hot_spans(rows: DataFrame, kept: DataFrame, words: int) -> DataFrame:
    """The same for runs of hot names: their windows one by one, each with the smallest doc_id that holds it."""
    texts = run_words(rows, kept, words).withColumn("w", F.split(F.col("text").cast("string"), " "))
    each = texts.select("doc_id", "row", "start", F.posexplode(F.transform(F.sequence(F.lit(1), F.col("n")), lambda k: F.slice("w", k, words))).alias("k", "window"))
    each = each.select("doc_id", "row", (F.col("start") + F.col("k")).alias("low"), F.array_join("window", " ").alias("window"))
    first = each.groupBy("window").agg(F.min("doc_id").alias("first"))
    late = each.join(first, "window").filter("doc_id > first")
    return late.select("doc_id", "row", "low", (F.col("low") + words).alias("high"))


def merged(spans: DataFrame) -> DataFrame:
    """d, r and the lists low, high of each document's merged spans, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lows, highs = [], []
            for row in batch.column("spans"):
                low, high = (row.values.field(c).to_numpy() for c in ("low", "high"))
                order = np.argsort(low, kind="stable")
                low, reach = low[order], np.maximum.accumulate(high[order])
                first = np.flatnonzero(np.concatenate([[True], low[1:] > reach[:-1]]))
                lows.append(low[first])
                highs.append(reach[np.append(first[1:], len(low)) - 1])
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (lows, highs)]
            yield pa.RecordBatch.from_arrays([batch.column("d"), batch.column("r"), *lists], ["d", "r", "low", "high"])

    per = spans.groupBy(F.col("doc_id").alias("d"), F.col("row").alias("r")).agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    return per.mapInArrow(run, "d long, r long, low array<long>, high array<long>")


def keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """docs with doc_id as long in __id and __row: 0, or a hash of the text for ids of several rows; and the texts to
    search: doc_id, row and text (binary) of every row with an id, equal rows once."""
    rows = docs.withColumn("__id", F.col("doc_id").cast("long"))
    texts = lambda df: df.filter("__id is not null").select(F.col("__id").alias("doc_id"), F.col("__row").alias("row"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    several = written(rows.filter("__id is not null").groupBy(F.col("__id").alias("__several")).count().filter("count > 1").select("__several"), "ids-of-several-rows")
    if several.isEmpty():
        rows = rows.withColumn("__row", F.lit(0).cast("long"))
        return rows, texts(rows)
    joined = rows.join(broadcast_if_small(several), F.col("__id") == F.col("__several"), "left")
    rows = joined.withColumn("__row", F.when(F.col("__several").isNull(), 0).otherwise(F.coalesce(F.xxhash64("text"), F.lit(0))).cast("long"))
    once = texts(rows.filter("__several is not null")).groupBy("doc_id", "row").agg(F.max("text").alias("text"))
    return rows.drop("__several"), texts(rows.filter("__several is null")).unionByName(once)


def repeated_spans(rows: DataFrame, words: int = WORDS) -> DataFrame:
    """d, r, low, high: the merged stretches of words of each document (doc_id, row, text binary) that earlier ones hold."""
    found = written(repeated(named_runs(rows, words)), "repeated-runs")
    copies = found.filter("copy").select("doc_id", "row", F.col("start").alias("low"), (F.col("start") + F.col("n") + (words - 1)).alias("high"))
    kept = found.filter("not copy").drop("copy")
    hot = written(kept.groupBy("gram").agg(F.count("*").alias("x")).filter(F.col("x") > HOT).select("gram"), "hot-names")
    if hot.isEmpty():
        spans = copies.unionByName(indexed_spans(rows, kept, words))
    else:
        # At most one name for each HOT runs.
        hot = broadcast_if_small(hot)
        spans = copies.unionByName(indexed_spans(rows, kept.join(hot, "gram", "left_anti"), words)).unionByName(hot_spans(rows, kept.join(hot, "gram", "left_semi"), words))
    return written(merged(spans), "spans")


def without_repeats(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """All columns of docs, text without the words that repeat, with n_words and n_removed; columns of these names are replaced."""
    whole, rows = keyed(docs.select(F.struct(*docs.columns).alias("__whole"), "doc_id", "text"))
    spans = broadcast_if_small(repeated_spans(rows, words))
    joined = whole.join(spans, (F.col("__id") == F.col("d")) & (F.col("__row") == F.col("r")), "left")
    parts = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    # As the variable of a lambda the text is split once.
    between = lambda s, k: F.slice(s["w"], (F.get(s["high"], k) + 1).cast("int"), (F.get(s["low"], k) - F.get(s["high"], k)).cast("int"))
    left = lambda s: F.when(F.size(s["low"]) == 1, s["w"]).otherwise(F.flatten(F.transform(F.sequence(F.lit(0), F.size(s["low"]) - 1), lambda k: between(s, k))))
    no = F.array().cast("array<long>")
    ends = lambda w: F.concat(F.coalesce("low", no), F.array(F.size(w).cast("long")))
    one = F.transform(F.array(parts), lambda w: F.struct(w.alias("w"), ends(w).alias("low"), F.concat(F.array(F.lit(0).cast("long")), F.coalesce("high", no)).alias("high")))
    done = F.transform(one, lambda s: F.struct(F.size(s["w"]).cast("long").alias("n"), left(s).alias("left")))[0]
    out = joined.select("__whole", F.when(F.col("text").isNotNull(), done).alias("__done"))
    n, kept = (F.coalesce(c, F.lit(0)).cast("long") for c in (F.col("__done.n"), F.size("__done.left")))
    same = [F.array_join("__done.left", " ").alias(c) if c == "text" else F.col("__whole").getField(c).alias(c) for c in docs.columns if c not in ("n_words", "n_removed")]
    return out.select(*same, n.alias("n_words"), F.when(F.col("__done").isNull(), 0).otherwise(n - kept).cast("long").alias("n_removed"))


sent_with_tasks("tidewheel.llm.fm_index")
sent_with_tasks(__name__)
