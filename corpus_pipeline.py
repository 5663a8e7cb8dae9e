"""A cleaned, mixed and tokenised corpus in stages over ``documents``.

Each stage takes all rows that the one before it kept.  All stages but the last return the columns of
``documents``; the last returns one row per document of the token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.llm import decontaminate, jaccard, mixing, quality, tokens
from tallyhouse.llm.base import LlmQuery, prepare, table
from tallyhouse.session import materialize


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    prepare(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates (five words, 0.8)."""
    prepare(spark)
    return jaccard.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    prepare(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their target weights; repeated documents come out repeatedly."""
    prepare(spark)
    out = mixing.mix(docs)
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else out


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and what they hold of each document."""
    prepare(spark)
    return tokens.op8(spark, docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontaminate", decontaminated),
    ("mix", mixed),
    ("tokens", tokenised),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs


#: The classifier and the tokenizer have no SQL form; tests hold the stages against plain code.
ORACLE_SQL = None
query = LlmQuery("pipeline", run, ORACLE_SQL)
