"""The quality model of characters against brute force; op8_quality tells apart what the folded alphabet does not."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from tests.llm.conftest import DOCS
from tidewheel.llm import quality_lm, queries


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, None, len(t or "")) for i, t, lang in rows], DOCS)


def windows(text):
    s = [None] * 3 + list(text)
    return [tuple(s[i - 3 : i + 1]) for i in range(3, len(s))]


def brute(texts):
    """p(gram) of an interpolated modified Kneser-Ney model over tuples of characters."""
    levels = {4: Counter(w for t in texts for w in windows(t))}
    for order in (3, 2, 1):
        levels[order] = Counter(g[1:] for g in levels[order + 1])
    cut = {k: quality_lm.discounts(*(sum(c == n for c in level.values()) for n in (1, 2, 3, 4))) for k, level in levels.items()}
    totals, given = defaultdict(int), defaultdict(float)
    for level in levels.values():
        for g, c in level.items():
            totals[g[:-1]] += c
            given[g[:-1]] += cut[len(g)][min(c, 3) - 1]

    def p(gram):
        if not gram:
            return 1 / 0x110000
        low, total, c = p(gram[1:]), totals[gram[:-1]], levels[len(gram)].get(gram, 0)
        return low if not total else (c - (cut[len(gram)][min(c, 3) - 1] if c else 0)) / total + given[gram[:-1]] / total * low

    return p


def perplexity(p, text):
    return 2 ** (-sum(math.log2(p(w)) for w in windows(text)) / len(text))


def texts_of(seed, n):
    r = random.Random(seed)
    words = ["Der", "DER", "día", "dia", "été", "Éte", "жук", "лес", "木の", "a1", "a2", "x#", "x%", "😀", "end."]
    return [" ".join(r.choice(words) for _ in range(r.randrange(1, 40))) for _ in range(n)]


def test_characters_against_brute_force(spark):
    """Every perplexity and threshold; nulls, empty texts and repeated rows; bits broadcast and dealt."""
    texts = texts_of(1, 60)
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(100, "ZZZ never met 語", None), (101, None, "en"), (102, "", "en"), (None, texts[0], "en"), (7, texts[7], "en"), (7, texts[7], "en")]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 0]
    p = brute([t for i, t, _ in rows if i is not None and i < 40 and i not in held])
    got = quality_lm.classify(documents(spark, rows).repartition(3), labels, characters=True).collect()
    assert Counter((r.doc_id, r.lang) for r in got) == Counter((i, lang) for i, _, lang in rows)
    own = {i: perplexity(p, t) if t else None for i, t, _ in rows}
    limit = max(own[i] for i in held)
    for r in got:
        if own[r.doc_id] is None:
            assert r.perplexity is None and not r.kept
        else:
            assert math.isclose(r.perplexity, own[r.doc_id], rel_tol=1e-6) and math.isclose(r.threshold, limit, rel_tol=1e-6)
            assert r.kept == (r.perplexity <= r.threshold)
    docs = documents(spark, rows)
    bits = quality_lm.character_bits(quality_lm.character_counts(docs.filter("doc_id < 40")), quality_lm.character_counts(docs))
    parts = [quality_lm.by_use(bits, most) for most in (1 << 30, 24 * 100, 0)]
    n = bits.count()
    assert parts[0][1] is None and parts[0][0].count() == n and 0 < parts[1][0].count() <= 100 and parts[2][0].isEmpty()
    assert all(often.count() + others.count() == n for often, others in parts[1:])
    near, mixed, far = (Counter(quality_lm.character_perplexity(docs.select("doc_id", "lang", "text"), bits, most).collect()) for most in (1 << 30, 24 * 100, 0))
    assert near == mixed == far and sum(near.values()) == len(rows)


def test_op8_tells_characters_apart(spark, tmp_path):
    """Capitals, digits, signs and letters of one bucket of the folded alphabet are different characters."""
    table = quality_lm.symbol_table()
    documents(spark, [(i, "AB1 %é" * 20, "en") for i in range(12)] + [(50, "AZ1 %é" * 20, "en"), (51, "AB2 %é" * 20, "en"), (52, "AB1 #é" * 20, "en"), (53, "AB1 %" * 20 + chr(ord("é") + 28) * 20, "en"), (54, "AB1 %" * 20 + "é" * 20, "en")]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(12)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: (r.perplexity, r.kept) for r in queries.op8_quality(spark, str(tmp_path)).collect()}
    assert table[ord("é")] == table[ord("é") + 28] and got[53][0] > got[54][0] * 1.5
    assert all(got[i][1] for i in range(12)) and not any(got[i][1] for i in (50, 51, 52))
    assert all(got[i][0] > 1.5 * got[0][0] for i in (50, 51, 52))


def counted(parts):
    found = Counter()
    for part in parts:
        for context, c, n in quality_lm.distinct_grams(part):
            for x, y, k in zip(context.tolist(), c.tolist(), n.tolist()):
                found[x, y] += k
    return found


def test_stretches_and_many_different_characters(spark, monkeypatch):
    """Stretches lose no n-gram and count none twice, also with more different characters than 16 bits hold."""
    points = np.random.default_rng(1).permutation(np.r_[0x20:0xD800, 0xE000:0x30000])[:90_000]
    text = "".join(map(chr, points)) + "the cat sat on the cat " * 9
    expected = Counter()
    for w in windows(text):
        a, b, c, d = (0 if x is None else ord(x) + 1 for x in w)
        expected[a << 42 | b << 21 | c, d] += 1
    s = quality_lm.characters_of(text)
    assert counted([s]) == counted(quality_lm.stretches(s, 1_000)) == expected
    monkeypatch.setattr(quality_lm, "STRETCH", 500)
    some = [(1, text[-900:], None), (2, "short", None), (3, text[-700:], None), (4, "short", None), (5, "", None), (6, None, None)]
    got = {(r.context, r.c): r.n for r in quality_lm.character_counts(documents(spark, some)).collect()}
    expected = Counter()
    for _, t, _ in some:
        for w in windows(t or ""):
            a, b, c, d = (0 if x is None else ord(x) + 1 for x in w)
            expected[a << 42 | b << 21 | c, d] += 1
    assert got == expected
