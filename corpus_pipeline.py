"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; its result is written as
Parquet and reread as the next one's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from runlens.llm.common import read_table, stored
from runlens.llm.exact_dedup import keep_first
from runlens.llm.mixing import mix_documents
from runlens.llm.ngram_join import keep_one_of_each
from runlens.llm.packing import pack_documents
from runlens.llm.toxicity import keep_clean


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores 0.5 or more go."""
    return keep_clean(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return keep_first(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays, the one with the smallest id (null last)."""
    return keep_one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Smaller sources are repeated up to 1.25 times; every document stays at least once."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every drawn document as pieces in sequences of at most 4096 tokens."""
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("ngram_join", ngram_join), ("mixing", mixing), ("packing", packing)]

# A trained classifier and a tokenizer are no SQL: the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
