"""From raw documents to packed training sequences, in five stages.

Every stage gets what its predecessor kept, as Parquet. The first four return
rows of ``documents`` as they came; the last one returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskweave.llm.gray import keep_one
from riskweave.llm.grouping import pack_documents
from riskweave.llm.language import language_filter
from riskweave.llm.quality import quality_filter
from riskweave.llm.ship import ship
from riskweave.llm.templates import decontaminate
from riskweave.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose quality score is below 0.3."""
    ship(spark)
    return quality_filter(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that are in no language."""
    ship(spark)
    return language_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates (five words, similarity 0.8)."""
    ship(spark)
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a benchmark item, word for word or with other values."""
    ship(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 2048 tokens."""
    ship(spark)
    return pack_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

# SQL expresses none of the models, fingerprints and plans; the tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
