"""A corpus pipeline of five stages, each one of the operators: quality rules, SimHash near-duplicates, substring dedup,
benchmark decontamination and packing. Each stage's rows are written and read again as the documents of the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from volcohort.llm import decontaminate, packing, quality_rules, similar, substring_dedup
from volcohort.llm.storage import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep."""
    return quality_rules.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of each group of near-duplicates."""
    return similar.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without words that repeat what came before."""
    return substring_dedup.strip_documents(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that leak no benchmark item."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches of the pieces of all documents."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality), ("near-duplicates", near_duplicates), ("repeated passages", repeated_passages),
    ("benchmark leaks", benchmark_leaks), ("packing", packed),
]
#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
