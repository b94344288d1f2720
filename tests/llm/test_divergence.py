"""Divergence audit against brute force in plain Python, with nulls, ties, repeats, empty groups and many blocks."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.conftest import DOCS
from tidewheel.llm import divergence

PATTERN = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least_docs, most):
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        found = PATTERN.findall((text or "").translate(SMALL))
        key = (lang or "", source or "")
        groups.add(key)
        n[key].update(found)
        docs[key[0]].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, d in docs[lang].items() if d >= least_docs]
        own = {g[1]: {t: n[g][t] for t in kept} for g in groups if g[0] == lang}
        whole = {t: sum(c[t] for c in own.values()) for t in kept}
        shares = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p, q = {s: shares(c) for s, c in own.items()}, shares(whole)
        for s in own:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in own if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, item, -v, k) for k, (v, item) in enumerate(ranked if part == "pair" else ranked[:most], 1)]
    return Counter(out)


def same(spark, rows, least_docs=3, most=200):
    df = spark.createDataFrame([(i, t, lang, src, None) for i, t, lang, src in rows], DOCS).withColumns({"term": F.lit(1), "p": F.lit("x"), "n": F.lit(None).cast("double"), "block": F.lit(0), "v": F.lit(True)})
    got = Counter(tuple(r) for r in divergence.audit(df.repartition(3), least_docs, most).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == brute(rows, least_docs, most)


def prose(seed, n):
    r = np.random.default_rng(seed)
    return " ".join(f"w{chr(97 + x % 26)}{chr(97 + x // 26)}" for x in r.zipf(1.4, n) % 600)


def test_many_blocks(spark, monkeypatch):
    """Several group and term blocks, sources that share few terms, ranks cut off."""
    monkeypatch.setattr(divergence, "GROUPS", 3)
    monkeypatch.setattr(divergence, "TERMS", 20)
    monkeypatch.setattr(divergence, "HELD", 50)
    same(spark, [(i, prose(i, 5 + i % 40), "en" if i % 3 else "fr", f"s{i % 11}") for i in range(150)], most=7)


def test_odd_rows(spark):
    """Nulls, texts without terms, a language of one source, terms of too few documents, ties, repeated rows, other scripts, a long text."""
    rows = [(1, None, None, None), (2, "", "en", "a"), (None, "Only HERE only", "en", None), (3, "x1y", None, "b"), (3, "x1y", None, "b"), (3, "x", None, "c"), (4, "ab Ab aB ÄB äb", "en", "a"), (5, "ab äb", "en", "b"), (6, "ab - äb\x00ab\x7f", "en", "b"), (7, "日本 日本", "ja", "a"), (8, "日本!本", "ja", "a"), (9, "日本", "ja", "a"), (10, "123", "zz", "q"), (11, "...", "zz", "r"), (12, prose(1, 20_000), "en", "long")]
    for least in (1, 2, 3):
        same(spark, rows, least)
    same(spark, [])


def test_cell_of_large_counts():
    """Shares from 1 to 10**9 in one cell; the sums are exact."""
    cols = {"lang": ["l"] * 5, "source": ["a", "b", "a", "b", "a"], "term": ["t", "t", "u", None, None], "p": [10**9, 1, 5, None, None], "low": [3, 2, 3, 2, 3], "v": [4] * 5, "block": [0] * 5, "a": [0] * 5, "b": [0] * 5, "k": [0] * 5}
    out = {(r["source"], r["item"]): r for r in divergence.cell_sums(pa.table(cols)).to_pylist()}
    f = lambda p, q: (p - q) ** 2 // q
    assert out["a", "b"]["above"] == f(10**9, 1) + f(5, 2) - 2 * f(3, 2) and out["a", "b"]["absent"] == f(3, 2)
    assert out["b", "a"]["above"] == f(1, 10**9) + f(2, 5) - 2 * f(2, 3)


def test_share_is_exact(spark):
    n = [0, 1, 7, 10**12, 10**17]
    df = spark.createDataFrame([(x, y, v) for x in n for y in n for v in (1, 3) if y >= x], "n long, total long, v long")
    assert all(r.p == 1 + 10**9 * (r.n + 1) // (r.total + r.v) for r in df.withColumn("p", divergence.share(F.col("n"), F.col("total"), F.col("v"))).collect())
