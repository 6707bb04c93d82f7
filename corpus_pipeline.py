"""From raw documents to packed sequences, stage by stage.

Each stage takes the documents its predecessor kept and returns the columns of
``documents``; the last returns pieces of sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from firstseen.llm import decontaminate, packing, pii, quality, simhash
from firstseen.llm.frames import small_batches, staged, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores as bad go."""
    return quality.keep_good(docs, table(small_batches(spark), sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays, the one with the smallest id.

    Edited copies more than 4 bits apart stay too; the README says how many.
    """
    small_batches(spark)
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontaminate.keep_clean(docs, table(small_batches(spark), sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced in the texts."""
    small_batches(spark)
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become token sequences."""
    small_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("quality", quality_filter),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal data", redact_personal_data),
    ("packing", pack),
]

# SQL has no model training, no tokenizer and no packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
