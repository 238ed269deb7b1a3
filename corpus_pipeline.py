"""A training corpus from raw documents, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillscope.llm import decontam, mixing, nbsvm, pii, simhash
from tillscope.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not reject."""
    return nbsvm.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id."""
    return simhash.without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window that repeats a benchmark item."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"), by_text=True)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the text."""
    return pii.without_personal_data(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each kept document the mix takes, by source targets."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality", quality),
    ("simhash", near_duplicates),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("mixing", mixed),
]

#: No stage can be written in SQL: models, bit fingerprints and hashed orders decide.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents, each over what the one before it kept."""
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
