"""The corpus pipeline: stages over ``documents``, each stored and reread by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrane.llm import bagminhash, decontaminate, mixture, pii, quality
from terrane.session import stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality resampling keeps."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that with the smallest id."""
    return bagminhash.keep(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.keep(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes words of, with that number in ``taken``."""
    return mixture.draw(docs)


STAGES = [
    ("quality", quality_stage),
    ("near-duplicates", dedup_stage),
    ("decontamination", decontamination_stage),
    ("personal data", pii_stage),
    ("mixture", mixture_stage),
]

#: Training, compression and edit distances have no SQL form; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
