"""FM-index and passage removal against brute force in plain Python, with nulls, ties, repeats, long texts and empty tables."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DOCS
from tidewheel.llm import substring_dedup as sd
from tidewheel.llm.fm_index import FmIndex, matching_statistics

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, words):
    found = [(i, WORD.findall(t or ""), t) for i, t in rows]
    first = {}
    for i, w, _ in found:
        for k in range(len(w) - words + 1) if i is not None else ():
            key = tuple(w[k : k + words])
            first[key] = min(i, first.get(key, i))
    out = []
    for i, w, t in found:
        gone = {k + j for k in range(len(w) - words + 1) if i is not None and first[tuple(w[k : k + words])] < i for j in range(words)}
        out.append((i, len(w), len(gone), None if t is None else " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def same(spark, rows, words=13):
    df = spark.createDataFrame([(i, t, "en", "a", None) for i, t in rows], DOCS)
    df = df.withColumns({"n_words": F.lit("x"), "row": F.lit(1), "low": F.lit(2), "d": F.lit(3), "gram": F.lit("g"), "__row": F.lit(4), "spans": F.create_map(F.lit("a"), F.lit(1))})
    out = sd.without_repeats(df.repartition(5), words)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "low", "d", "gram", "__row", "spans", "n_words", "n_removed"]
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in out.collect()), key=str) == brute(rows, words)


@pytest.mark.parametrize("seed", range(3))
def test_index(seed):
    """Rows of every pattern, and matching statistics, against a search of the text."""
    r = np.random.default_rng(seed)
    parts = [r.integers(1, 4 + seed * 30, n) for n in r.integers(1, 40, 30)]
    text = np.concatenate([np.append(p, 0) for p in parts])
    index = FmIndex(text, int(text.max()) + 1, 5)
    s = "".join(chr(64 + x) for x in text)
    at = lambda p: [k for k in range(len(s)) if s.startswith(p, k)]
    ends = np.flatnonzero(text > 0)
    length, low, high = matching_statistics(index, text, ends, 5)
    for e, n, lo, hi in zip(ends, length, low, high, strict=True):
        want = max((k for k in range(1, 6) if e - k + 1 >= 0 and "@" not in s[e - k + 1 : e + 1] and len(at(s[e - k + 1 : e + 1])) > 1), default=0)
        assert n == want
        if n:
            assert sorted(index.suffixes[lo:hi].tolist()) == at(s[e - n + 1 : e + 1])


def test_runs_cover_each_window_once():
    """Runs by name: every window is in one run, equal windows have equal names, equal runs equal contents."""
    r = random.Random(4)
    texts = [" ".join(r.choice("ab ccc é \t日本\x0b x1".split(" ")) for _ in range(r.randrange(0, 60))).encode() for _ in range(40)] + [b"", b"same " * 50, b"  lead and trail  "]
    batch = pa.record_batch([pa.array([b"skipped", *texts], pa.binary())], ["text"]).slice(1)
    names, contents, seen = defaultdict(set), defaultdict(set), []
    for first, data, edges in sd.texts_of(batch):
        text, start, n, name, content = sd.runs_of(data, edges, 13, 6)
        for t, s, m, g, c in zip(text + first, start, n, name, content, strict=True):
            w = texts[t].split()
            seen += [(t, s + k) for k in range(m)]
            contents[tuple(w[s : s + m + 12])].add(c)
            for k in range(m):
                names[tuple(w[s + k : s + k + 13])].add(g)
    assert sorted(seen) == [(t, k) for t, x in enumerate(texts) for k in range(len(x.split()) - 12)]
    assert all(len(x) == 1 for x in [*names.values(), *contents.values()])
    assert len({c for x in contents.values() for c in x}) == len(contents)


def test_hashes_of_long_stretches(monkeypatch):
    values = np.random.default_rng(1).integers(0, 1 << 63, 5_000, np.uint64)
    begin, end = np.array([0, 10, 900, 4_000]), np.array([3, 900, 4_900, 5_000])
    whole = sd.stretch_hashes(values, begin, end)
    monkeypatch.setattr(sd, "BLOCK", 64)
    assert (sd.stretch_hashes(values, begin, end) == whole).all()
    moved = sd.stretch_hashes(np.concatenate([values[:7], values]), begin + 7, end + 7)
    assert (moved == whole).all()


def passages(seed):
    """Texts that share passages of all lengths about the threshold, whole copies, edited copies and repeats within a text."""
    r = random.Random(seed)
    word = lambda: r.choice("abcdefgh") + r.choice("xyz") + str(r.randrange(40))
    shared = [[word() for _ in range(n)] for n in (5, 12, 13, 14, 20, 40, 300)]
    rows = []
    for i in range(120):
        w = [word() for _ in range(r.randrange(0, 60))]
        for _ in range(r.randrange(0, 4)):
            p = r.choice(shared)
            cut = r.randrange(0, 4)
            at = r.randrange(0, len(w) + 1)
            w[at:at] = p[cut : len(p) - r.randrange(0, 4)]
        rows.append((r.randrange(1000) * 2, r.choice(" \t\n\x0b").join(w)))
    ids = {}
    rows = [(ids.setdefault(i, i) if i not in ids else 10_000 + k, t) for k, (i, t) in enumerate(rows)]
    rows += [(20_000 + k, rows[k][1]) for k in range(0, 60, 3)] + [(-k, rows[k][1].replace("a", "b", 1)) for k in range(1, 60, 5)]
    return rows


def test_passages(spark, monkeypatch):
    for shard, hot in ((10, 10**9), (25_000, 12_500), (5, 3)):
        monkeypatch.setattr(sd, "SHARD", shard)
        monkeypatch.setattr(sd, "HOT", hot)
        same(spark, passages(shard))


def test_odd_rows(spark):
    """Nulls, empty texts, ids with several texts or equal rows, constant and long texts, windows within one document."""
    r = random.Random(8)
    p, q, long = ([f"{c}{r.randrange(10**6)}" for _ in range(n)] for c, n in (("p", 13), ("q", 30), ("l", 20_000)))
    text = " ".join
    rows = [(1, None), (2, ""), (None, text(q)), (None, None), (3, " \n\t "), (3, "x"), (4, "same " * 30), (5, "same " * 40), (5, "same " * 40), (5, text(q)), (6, text(p + p)), (7, text(p[:12])), (8, text(p)), (8, text(["a", *p])), (9, text(long)), (10, text(long[5_000:] + q)), (10, text(long[5_000:] + q)), (11, text(q + q)), (12, "é　日本 " * 20), (13, "é　日本 " * 20), (-5, text(q[3:20]))]
    same(spark, rows)
    same(spark, rows, words=2)
    same(spark, [])
    same(spark, [(None, None)])


def test_one_text_over_many_tasks(spark):
    """A large group of copies, and one passage in every row, over more partitions than a group would fit."""
    r = random.Random(2)
    passage, copy = ([str(r.randrange(10**9)) for _ in range(n)] for n in (40, 60))
    rows = [(i, " ".join([str(r.randrange(10**9)) for _ in range(5)] + passage + [str(i)])) for i in range(1500)] + [(5_000 + i, " ".join(copy)) for i in range(1500)]
    same(spark, rows)
