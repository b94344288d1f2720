"""A corpus pipeline of five stages: toxicity, near-duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and reread as the next one's docs. All
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm import decontamination, mixing, near_dup, sharding, toxicity
from tidewheel.llm.common import table, written

SCORE = "__toxic_score"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on a bounded sample of the labelled ones, does not call toxic.

    Every row is judged by its text; a null text counts as empty, a null or repeated doc_id does no harm.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, name=SCORE).filter(toxicity.predicted(F.col(SCORE)) == 0).drop(SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard similarity of 0.8 or more).

    Texts without words are copies of nothing and stay. Of rows equal in doc_id and text one stays.
    """
    return near_dup.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark. Every row is judged by its text; null and empty texts stay."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those of no words go with the hash threshold of their source."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document goes: doc_id, size, text_crc32, shard, slot, virtual_slot. Rows of a null id or text have a place too."""
    return sharding.shard(docs, 40).select("doc_id", "size", "text_crc32", "shard", "slot", "virtual_slot")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: No SQL: the first stage is a trained classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
