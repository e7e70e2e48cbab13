"""The corpus pipeline: filter, near-duplicates, decontamination, mixing, sharding, each stage on what the last one kept.

No stage changes a document but the mix, which cuts the one document of a source in which the source's budget ends. The
quality stage learns from ``labels`` and the decontamination stage reads ``benchmark``, both below ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.llm import decontaminate, mixing, near_duplicates, quality, sharding
from clickfeat.llm.common import n_words, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Near-duplicates of the corpus: five-word shingles, similarity 0.8.
WIDTH, PERCENT = 5, 80
# Two stages learn or are seeded, so SQL cannot give the same rows; tests compare with brute force.
ORACLE_SQL = None


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking accepts."""
    ranked = quality.ranked(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))
    return ranked.where(F.col("predicted") == 1).select(*COLUMNS)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_duplicates.one_of_each(docs.select(*COLUMNS), WIDTH, PERCENT)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources, documents of several epochs repeated."""
    return mixing.copies(mixing.mix(docs.select(*COLUMNS), n_words(F.col("text")))).select(*COLUMNS)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in a random order, cut into shards."""
    return sharding.external_shuffle(docs.select(*COLUMNS))


STAGES = [
    ("quality classifier", good),
    ("n-gram Jaccard join", unlike),
    ("benchmark decontamination", unleaked),
    ("mixing sources", mixed),
    ("sharding", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
