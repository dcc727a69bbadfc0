"""Registered queries of the subpackage: thin callables over the operators, whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bazaar.llm import (
    host_rules,
    language_id,
    mixing,
    oracles,
    periodic_runs,
    phrases,
    pieces,
    private_data,
    resharding,
    secret_scan,
    simhash_near,
    simhash_search,
    substring_dedup,
    toxicity,
)
from bazaar.llm.common import TOKENIZER, documents


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir))


def op2_mixing_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.mix(documents(spark, sf_dir), labels, {"good": 0.8, "low": 0.15, "toxic": 0.05})


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(documents(spark, sf_dir), window=35)


def op4_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.verdicts(documents(spark, sf_dir))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.scan(documents(spark, sf_dir))


def op7_min_cost_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resharding.reshard(documents(spark, sf_dir), old_shards=24, new_shards=24)


def op8_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.tokens(documents(spark, sf_dir), TOKENIZER, kind="bpe")


def op9_simhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_search.fingerprints(documents(spark, sf_dir))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near.near_duplicates(documents(spark, sf_dir), shingle=3, max_bits=2)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.collapse(periodic_runs.with_planted_runs(documents(spark, sf_dir)))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.7)


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir), least=10, top=2000, cover=50)


SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_mixing_weights": op2_mixing_weights,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_host_quality_rules": op4_host_quality_rules,
    "op5_language_id": op5_language_id,
    "op6_personal_data": op6_personal_data,
    "op7_min_cost_resharding": op7_min_cost_resharding,
    "op8_piece_encoding": op8_piece_encoding,
    "op9_simhash_fingerprints": op9_simhash_fingerprints,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_toxicity": op12_toxicity,
    "op13_phrase_collocations": op13_phrase_collocations,
}
#: The others rest on XXH64, trained models, a flow or the tokenizer: tests hold them against plain versions.
ORACLE: dict[str, str] = {
    "op1_secret_scan": oracles.SECRETS,
    "op3_substring_dedup": oracles.SUBSTRING,
    "op4_host_quality_rules": oracles.HOST_RULES,
    "op13_phrase_collocations": oracles.PHRASES,
}
