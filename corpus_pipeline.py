"""A training corpus from raw documents: five stages, each over all that the one before kept.

1. ``language``: documents whose language is unknown or unsure go.
2. ``exact_dedup``: of equal texts the one with the largest id stays.
3. ``near_dedup``: of texts that links of five-word Jaccard 0.8 or more connect, the smallest id stays.
4. ``secrets``: secrets inside texts are replaced; every document stays.
5. ``packing``: the remaining texts, encoded and packed; one row per piece.

Every stage's result is written to the shared folder and read back as the next one's documents, so a
lost executor costs at most the tasks of the running stage. The scratch tables of a run, and those of the
stages within it, are deleted by ``session.release_scratch`` once its result has been read.

Defined results: rows with a null text have no language and go; null ids, extra columns and columns named
like the stages' own pass through; of repeated rows one stays; very long texts are texts like others;
ties are broken as the operators state. Empty tables, and tables of which nothing stays, give no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmill.llm import exact_dedup, language_id, minhash, packing, secret_scan
from starmill.llm.common import no_listings, short_plans, small_batches, table
from starmill.llm.queries import tokenizer_file
from starmill.session import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_plans(spark)
    no_listings(spark)
    small_batches(spark)
    return language_id.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_plans(spark)
    no_listings(spark)
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_plans(spark)
    no_listings(spark)
    small_batches(spark)
    return minhash.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_plans(spark)
    no_listings(spark)
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_plans(spark)
    no_listings(spark)
    small_batches(spark)
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("language", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("secrets", secrets),
    ("packing", pack),
]

# SQL has no classifier, forest or tokenizer; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
