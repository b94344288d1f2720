"""Registered queries against their SQL in DuckDB, and the pipeline against its stages by hand."""

import zlib
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from tests.llm.conftest import SF
from tidewheel.llm import near_dup, queries

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    result = con.execute(queries.oracle_sql()[name])
    cols = [c[0] for c in result.description]
    assert sorted(cols) == sorted(df.columns)
    tidy = lambda row: tuple(round(v, 6) if isinstance(v, float) else v for v in row)
    assert Counter(tidy(r[c] for c in cols) for r in df.collect()) == Counter(map(tidy, result.fetchall()))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, SF).cache()
        seen[name] = kept.collect()
        if name != "sharding":
            assert kept.columns == docs.columns
    clean = {r.doc_id for r in seen["toxicity"]}
    assert sum(i not in clean for i, t in labels.items() if t) >= 0.7 * sum(labels.values())
    assert sum(i in clean for i, t in labels.items() if not t) >= 0.95 * sum(not t for t in labels.values())
    known = near_dup.WordHashes()
    sets = {r.doc_id: set(near_dup.shingle_set(r.text, 5, known).tolist()) for r in seen["toxicity"]}
    left = [r.doc_id for r in seen["near_duplicates"]]
    like = lambda a, b: sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    assert not any(like(a, b) for k, a in enumerate(left) for b in left[k + 1 :])
    assert all(any(like(a, b) for b in sets if b != a) for a in set(sets) - set(left))
    taken = Counter(r.doc_id for r in seen["mixing"])
    assert max(taken.values()) <= 2 and set(taken) <= {r.doc_id for r in seen["decontamination"]}
    assert Counter(r.doc_id for r in seen["sharding"]) == taken
    assert all(r.size == len(t.encode()) + 16 for r in seen["sharding"] for t in [next(d.text for d in seen["mixing"] if d.doc_id == r.doc_id)])


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls in every column, empty and long texts, ties, repeated rows, no rows, and columns of the stages' own names."""
    from tests.llm.test_operators import ODD, prose

    long = prose(9, 20_000)
    rows = [*ODD, (6, long, "en", "long"), (7, long + " end", None, "long"), (None, "only here", None, "z"), (8, "only here", "en", None), (9, "holds the test item words in a row", "en", "a")]
    df = spark.createDataFrame([(i, t, lang, src, None) for i, t, lang, src in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df = df.selectExpr("*", "'s' as score", "1 as shard", "2 as node", "3 as component", "'p' as predicted", "4 as h", "5 as copies", "6 as kept", "7 as text_hash", "8 as words")
    spark.createDataFrame([(2, 0, 1), (4, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "the test item words in a row"), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (df, df.limit(0)):
        seen = {}
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            seen[name] = out.collect()
            assert name == "sharding" or out.columns == df.columns
    stages = dict(corpus_pipeline.STAGES)
    assert {r.score for r in stages["toxicity"](spark, df, str(tmp_path)).collect()} <= {"s"}
    kept = Counter((r.doc_id, r.text) for r in stages["near_duplicates"](spark, df, str(tmp_path)).collect())
    assert max(kept.values()) == 1 and (4, "same " * 30) in kept and (5, "same " * 30) not in kept and (6, long) in kept and (7, long + " end") not in kept
    assert (8, "only here") in kept and (None, "only here") not in kept and (1, None) in kept and (2, "") in kept
    clean = stages["decontamination"](spark, df, str(tmp_path))
    assert clean.count() == len(rows) - 1 and clean.filter("doc_id = 9").isEmpty()
    assert stages["sharding"](spark, df, str(tmp_path)).count() == len(rows)


def test_held_out_flags(spark):
    rows = queries.op3_language_id(spark, SF).select("doc_id", "held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
