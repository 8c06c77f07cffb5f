"""Training corpus from ``documents``: quality, exact copies, near copies, benchmark passages, mix.

Every stage takes what its predecessor kept, written as Parquet and read again, and returns the columns of
``documents``; the last one adds ``copies``, how often a document is to be read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratavault.llm import decontaminate, exact_dedup, mixing, quality, simhash
from stratavault.session import materialise


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model judges to be bad go."""
    return quality.good_only(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for blanks the longest original stays, then the smallest doc_id."""
    return exact_dedup.deduplicated(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints the one with the smallest doc_id stays."""
    return simhash.deduplicated(docs, shingle=simhash.SHINGLE, distance=simhash.DISTANCE)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage that is similar to a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with ``copies``."""
    return mixing.take(docs)


STAGES = [("quality", quality_stage), ("exact dedup", exact_dedup_stage), ("near dedup", near_dedup_stage),
          ("decontaminate", decontaminate_stage), ("mix", mix_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL can express neither a trained model nor a random mix.
ORACLE_SQL = None
