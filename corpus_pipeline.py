"""A training corpus from raw documents: filter by quality and toxicity, drop near copies and repeated passages, pack.

Each stage takes what the one before it kept, written as Parquet and read again. All but the last return the columns of
``documents``; the last returns the packed pieces. Labels teach the two classifiers, never decide for a document.

Defined cases: null and empty texts pass the quality stage if its model says so and go on as documents of their end id
alone; rows with a null id are kept like others, but neither remove repeated passages nor lose any; of rows that repeat an id
and its text one stays. Columns beyond those of ``documents`` pass through. An empty table gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daylog.llm.common import documents, ship_code, stored
from daylog.llm.folds import labels
from daylog.llm.packing import pack_documents
from daylog.llm.quality import good_documents
from daylog.llm.simhash import DISTANCE, SHINGLE, one_of_each
from daylog.llm.substring_dedup import without_repeats
from daylog.llm.toxicity import harmless_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return good_documents(docs, labels(spark, sf_dir, "quality"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return harmless_documents(docs, labels(spark, sf_dir, "toxic"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return one_of_each(docs, SHINGLE, DISTANCE)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return without_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("packing", packing),
]

#: Classifiers and tokenizers are beyond SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all stages' work on ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
