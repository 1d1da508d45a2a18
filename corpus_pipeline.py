"""A cleaning pipeline over the documents: each stage works on what the one before it kept.

Every stage but the last returns documents with all their columns. The toxicity and benchmark
stages decide where the rows are; only the two duplicate stages shuffle texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linewarden.llm import cutting_stock, decontamination, exact_dedup, simhash, toxicity
from linewarden.llm.encoding import public_path
from linewarden.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more go; the model learns from labels not held out."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model, threshold=0.3)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, that of the smallest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints within 3 bits stays."""
    return simhash.drop_near_duplicates(docs, shingle=3, radius=3)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten words in a row of a benchmark item, or a whole shorter item, go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of at most 4096 tokens."""
    return cutting_stock.pack_documents(docs, public_path(), capacity=4096)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# The toxicity model is trained, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that all stages keep."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
