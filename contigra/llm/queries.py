"""The queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contigra.llm import conversation_repair, edit_counts, lattice, licenses, packing, quality, ranking, secret_scan, setsketch, sharding, telephony, tiling, toxicity
from contigra.llm.common import documents


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contamination(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op2_hypergeometric_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


def op3_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.severity(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op4_configuration_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op5_hierarchical_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op6_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_counts.edited_counts(documents(spark, sf_dir))


def op7_grammar_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir))


def op8_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score(documents(spark, sf_dir))


def op9_setsketch_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(documents(spark, sf_dir), k=2)


def op10_telephony_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telephony.media_features(documents(spark, sf_dir))


def op11_impact_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op12_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(_table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_string_tiling, op2_hypergeometric_shuffle, op3_ordinal_toxicity, op4_configuration_packing, op5_hierarchical_quality, op6_edit_token_counts, op7_grammar_secrets, op8_lattice_likelihood, op9_setsketch_duplicates, op10_telephony_media, op11_impact_ranking, op12_license_rules, op13_conversation_repair]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    """Ranks are expressible in SQL on whole tables, the other twelve are not; tests/llm holds them against brute force."""
    return {"op11_impact_ranking": ranking.oracle_sql()}
