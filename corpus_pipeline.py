"""Corpus cleaning from raw documents to packed sequences, in five stages over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import dart_minhash, decontaminate, exact_dedup, langid, packing
from ledgerloom.llm.common import prepare
from ledgerloom.session import materialise


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is recognised; the model is learned from a sample of the labelled rows."""
    prepare(spark)
    return langid.accepted_rows(docs, langid.learn(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per distinct text."""
    return exact_dedup.surviving_rows(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per class of near duplicates."""
    return dart_minhash.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    return decontaminate.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining rows in sequences of 1024 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", language),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]

#: SQL cannot express the stages; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each result written and read again."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
