"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's input.

Every stage works on all rows that its predecessor kept; all but the last return the columns of
``documents``.  No stage is expressible in SQL, so ORACLE_SQL is None and tests/llm holds the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contigra.llm import packing, quality, secret_scan, setsketch, tiling
from contigra.llm.common import batched, documents, write_shared


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.drop_rejected(batched(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word shingles, similarity 0.8)."""
    return setsketch.drop_near_duplicates(batched(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return tiling.drop_contaminated(batched(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return secret_scan.redact(batched(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token sequences: one row a piece."""
    return packing.pack(batched(docs))


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = write_shared(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
