"""Cleaning pipeline over ``documents``: five stages, each on what the one before it kept.

Toxic documents go, one document of each group of near-duplicates stays, documents
contaminated by the benchmark go, secrets are replaced in the texts, and what is left
is packed into sequences. Every stage is written as Parquet to the shared folder and
read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkstrata.llm import decontamination, neardup, packing, secrets, toxicity
from inkstrata.llm.common import scan
from inkstrata.llm.queries import TOKENIZER
from inkstrata.session import fresh_dir, ship


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    ship(spark)
    return toxicity.drop_toxic(docs, scan(spark, sf_dir, "labels"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    ship(spark)
    return neardup.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is in benchmark windows."""
    ship(spark)
    return decontamination.drop_contaminated(docs, scan(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in the texts replaced."""
    ship(spark)
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences, with their ids."""
    ship(spark)
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

# Trees and token ids have no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
