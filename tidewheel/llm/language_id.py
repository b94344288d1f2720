"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built of a bounded sample of its labelled text. A document is parsed against
each automaton into phrases, each the longest match with the sample (or one character that the sample lacks). Phrases
are normalised by the logarithm of the sample's length, as a phrase costs that many bits to point at: the language of
the smallest phrases * log2(sample length) wins, so a small sample is at no disadvantage; ties go to the first language
by code point.

The parse is a finite transducer: a transition table from (state, symbol) to the next state and whether a phrase ended.
Each language has symbols of its own, from its sample: its most frequent letters, its other letters in a few buckets,
one for letters it lacks and one for what is no letter. So any script is learned, and a letter foreign to a language is
a phrase there. Many stretches of text step through the table together. A text is parsed in stretches of ``STRETCH``
characters, which adds at most one phrase per stretch for every language alike; whole texts are parsed.

Nulls and short texts: a null text, or one with no letter, is ``und`` with score 0. A sample without any labelled text
makes every prediction ``und``. Every language with a text that has a letter is learned. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.common import broadcast_if_small, by_bytes, sent_with_tasks, written

SAMPLE_CHARS, SAMPLE_DOCS, STRETCH = 40_000, 60, 1024
#: Symbols of a language: 0 for what is no letter, then its frequent letters, buckets of its others, and foreign letters.
SYMBOLS, BUCKETS = 56, 8
FOREIGN = SYMBOLS - 1
#: Bytes of text (about) that are parsed together.
PART_BYTES = 4 << 20


def sample_text(labelled: DataFrame, chars: int = SAMPLE_CHARS, docs: int = SAMPLE_DOCS) -> dict[str, str]:
    """Per language ``docs`` distinct texts, those of the smallest hashes, to ``chars`` characters.

    Copies of a text count once, whether a language has few or many of them. Texts are cut for the sample only: each
    gives an eighth of it, and more if the others do not fill it. What comes to the driver is at most docs * chars
    characters a language.
    """
    rows = labelled.filter("lang is not null and text rlike '[\\\\p{L}]'").select("lang", "text", F.xxhash64("text").alias("h"))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).withColumnRenamed("lang", "known")
    counts = broadcast_if_small(written(counts, "language-counts"))  # a row per language; texts stay where they are
    # Some four times as many as are wanted pass the threshold: it may thin, but not lose, a language.
    share = F.lit(4.0 * docs) / F.col("n")
    near = rows.select("lang", "h").join(counts, F.col("lang") == F.col("known")).filter(F.pmod("h", F.lit(1_000_003)) / 1_000_003.0 < share).select("lang", "h").distinct()
    order = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1_000_003)), "h")
    few = near.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= docs).select(F.col("lang").alias("known"), F.col("h").alias("chosen"), "at")
    few = broadcast_if_small(written(few, "language-sample"))
    drawn = rows.join(few, (F.col("lang") == F.col("known")) & (F.col("h") == F.col("chosen")))
    texts = drawn.groupBy("lang", "at").agg(F.min(F.substring("text", 1, chars)).alias("text"))
    found: dict[str, list[str]] = {}
    for lang, text in texts.orderBy("lang", F.length("text") > chars // 20, "at").select("lang", "text").toLocalIterator():
        found.setdefault(lang, []).append(text.lower())
    got = {}
    for lang, parts in found.items():
        own = "\n".join(t[: chars // 8] for t in parts)[:chars]
        got[lang] = "\n".join([own, *(t[chars // 8 :] for t in parts)])[:chars] if len(own) < chars else own
    return dict(sorted(got.items()))


def letter_numbers(samples: dict[str, str]) -> np.ndarray:
    """Code point -> 0 for what is no letter, 1 for letters of no sample, from 2 on the samples' letters."""
    known = sorted({c for text in samples.values() for c in text if c.isalpha()})
    table = np.array([chr(p).isalpha() for p in range(0x110000)], np.uint16)
    for k, c in enumerate(known):
        table[ord(c)] = k + 2
    return table


def own_symbols(text: str, table: np.ndarray) -> np.ndarray:
    """Number of a letter -> symbol of the language that the text is a sample of."""
    counts = Counter(c for c in text if c.isalpha())
    out = np.full(int(table.max()) + 1, FOREIGN, np.int32)
    out[0] = 0
    frequent = SYMBOLS - 2 - BUCKETS
    for k, c in enumerate(sorted(counts, key=lambda c: (-counts[c], c))):
        out[table[ord(c)]] = k + 1 if k < frequent else frequent + 1 + ord(c) % BUCKETS
    return out


def numbers(text: str, table: np.ndarray) -> np.ndarray:
    """The numbers of a text's letters; a run of characters that are no letters counts as one."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    out = table[points]
    return out[(out != 0) | np.concatenate([[True], out[:-1] != 0])] if len(out) else out


def automaton(seq: list[int]) -> tuple[list[dict[int, int]], int]:
    """Transitions of the suffix automaton of a sequence."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in seq:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt, len(nxt)


def transducers(samples: dict[str, str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All automata in one table of 4 * next + phrases ended; of each language the root, the symbols and the bits of a phrase.

    Where a state lacks a symbol the phrase ends and the symbol starts the next one at the root; a symbol that the root
    lacks is a phrase by itself, so it may end two.
    """
    parts, roots, own, bits, base = [], [], [], [], 0
    for text in samples.values():
        own.append(own_symbols(text, table))
        seq = own[-1][numbers(text, table)]
        nxt, n = automaton(seq.tolist())
        root = np.full(SYMBOLS, base, np.int64)
        for c, s in nxt[0].items():
            root[c] = base + s
        step = np.tile(root * 4 + 1 + (root == base), (n, 1))
        step[0] = root * 4 + (root == base)
        for s, out in enumerate(nxt):
            for c, t in out.items():
                step[s, c] = (base + t) * 4
        parts.append(step.astype(np.int32))
        roots.append(base)
        bits.append(np.log2(len(seq) + 1))
        base += n
    return np.concatenate(parts).ravel(), np.array(roots, np.int32), np.array(own), np.array(bits)


def phrases(codes: list[np.ndarray], step: np.ndarray, roots: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Phrases of each text (rows) in each language (columns); stretches advance together, longest first."""
    owner, pieces = [], []
    for i, c in enumerate(codes):
        for at in range(0, len(c), STRETCH):
            owner.append(i)
            pieces.append(c[at : at + STRETCH])
    out = np.zeros((len(codes), len(roots)), np.int64)
    if not pieces:
        return out
    order = sorted(range(len(pieces)), key=lambda k: -len(pieces[k]))
    for lo in range(0, len(order), 4096):
        part = order[lo : lo + 4096]
        lens = np.array([len(pieces[k]) for k in part])
        grid = np.zeros((lens[0], len(part)), np.int32)
        for col, k in enumerate(part):
            grid[: lens[col], col] = pieces[k]
        live = np.searchsorted(-lens, -np.arange(lens[0]), side="left")  # how many are longer than t
        state = np.repeat(roots[:, None], len(part), 1)
        count = np.zeros((len(roots), len(part)), np.int32)
        for t in range(lens[0]):
            n = live[t]
            v = step[state[:, :n] * SYMBOLS + own[:, grid[t, :n]]]
            count[:, :n] += v & 3
            state[:, :n] = v >> 2
        count += state != roots[:, None]  # the phrase that the stretch's end cuts
        np.add.at(out, [owner[k] for k in part], count.T)
    return out


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def identify(docs: DataFrame, samples: dict[str, str], keep: list[str]) -> DataFrame:
    """The kept columns of docs with ``lang_pred`` and ``score`` (how far the runner-up is behind, 0 to 1)."""
    table = letter_numbers(samples)
    model = (table, *transducers(samples, table), list(samples)) if samples else None
    # SAMPLE_CHARS bounds the states of a language; the table grows with languages only.
    shared = docs.sparkSession.sparkContext.broadcast(model)
    cols = [c for c in keep if c not in ("lang_pred", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for batch in by_bytes(whole, "text", 1000, PART_BYTES):
                texts = [(t or "").lower() for t in batch.column("text").to_pylist()]
                known = [bool(model) and has_letter(t) for t in texts]
                names, score = ["und"] * len(texts), [0.0] * len(texts)
                if any(known):
                    table, step, roots, own, bits, langs = model
                    rows = [i for i, k in enumerate(known) if k]
                    got = phrases([numbers(texts[i], table) for i in rows], step, roots, own) * bits
                    for i, counts in zip(rows, got, strict=True):
                        first = int(counts.argmin())
                        rest = np.delete(counts, first)
                        names[i] = langs[first]
                        score[i] = float(1 - counts[first] / rest.min()) if len(rest) else 1.0
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in cols), pa.array(names), pa.array(score, pa.float64())], [*cols, "lang_pred", "score"])

    schema = docs.select(*cols).withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return docs.select(*cols, *(["text"] if "text" not in cols else [])).mapInArrow(run, schema)


sent_with_tasks(__name__)
