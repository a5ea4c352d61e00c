"""The queries of this folder: `queries()` and `oracle_sql()` as in `__spark_entry__.py`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volcohort.llm import (
    decontaminate, hard_negatives, hmm_lm, line_dedup, oracles, packing, pairwise_quality, periodic, quality_rules, sharding, simhash, substring_dedup, suffix_dedup,
    token_cache,
)
from volcohort.llm.storage import new_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.measure(_table(spark, sf_dir, "documents"))
    return out.withColumns({c: F.round(c, 6) for c in ("class_distance", "word_distance")})


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", "start", "n_words", F.round("similarity", 6).alias("similarity"))


def op3_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op4_token_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A cache of its own, empty at first: the query doesn't lean on what earlier runs left.
    return token_cache.count_tokens(_table(spark, sf_dir, "documents"), cache=new_path(spark, "token-counts"))


def op5_vector_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.measure(_table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.measure(_table(spark, sf_dir, "documents"))


def op9_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.score(_table(spark, sf_dir, "documents"))


def op10_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairwise_quality.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_line_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.measure(_table(spark, sf_dir, "documents"))


def op12_harmonic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.summary(periodic.collapse(periodic.planted(_table(spark, sf_dir, "documents"))))


def op13_vantage_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.relabelled(_table(spark, sf_dir, "embeddings")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_quality_rules, op2_decontamination, op3_length_buckets, op4_token_cache, op5_vector_shards, op6_prefix_doubling,
        op7_simhash, op8_recompression, op9_hidden_markov, op10_pairwise_quality, op11_line_hash, op12_harmonic_runs,
        op13_vantage_negatives,
    )}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": oracles.OP1, "op2_decontamination": oracles.OP2, "op6_prefix_doubling": oracles.OP6, "op8_recompression": oracles.OP8,
        "op11_line_hash": oracles.OP11, "op12_harmonic_runs": oracles.OP12, "op13_vantage_negatives": oracles.OP13,
    }
