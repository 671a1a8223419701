"""The training-data pipeline: five stages, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum.llm.common import fold, table
from pactum.llm.decontamination import decontaminate
from pactum.llm.language import with_known_language
from pactum.llm.mixing import mixed_copies
from pactum.llm.ngram_join import distinct_documents
from pactum.llm.sharding import sharded_documents
from pactum.plans.session import materialize

SHARDS = 16
#: Stages on word shingles take five words and 80 percent; 4 and 85 are op3's own contract.
NEAR_WORDS, NEAR_PERCENT = 5, 80
#: The stages learn and sample, so SQL cannot restate the run; tests compare it with plain Python.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier can tell; it learns from two thirds of those with a language."""
    return with_known_language(docs, fold(F.col("doc_id"), 3) != 1)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by word 5-grams at 80 percent, that of the least id."""
    return distinct_documents(docs, size=NEAR_WORDS, percent=NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a contaminating share of benchmark passages."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the source mix takes it."""
    return mixed_copies(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and slot."""
    return sharded_documents(docs, shards=SHARDS)


STAGES = [("language_id", language_id), ("ngram_join", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing), ("sharding", sharding)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
