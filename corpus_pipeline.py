"""Corpus pipeline over ``documents``: language ID, near-dedup, secrets, mixing, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and gives a DataFrame that is
written as Parquet in the shared folder and read again as the next stage's input.  All but the last return the input's
columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bazaar.llm import language_id, mixing, pieces, secret_scan, simhash_near
from bazaar.llm.common import TOKENIZER, documents, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: letterless text, or no language with half of the words."""
    return language_id.known_language(docs, min_score=0.5)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one of least doc_id."""
    return simhash_near.one_of_each(docs, shingle=3, max_bits=2)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their text are masked."""
    return secret_scan.without_secrets(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go, by a limit calibrated on labelled documents; of the others the good domain's tokens grow by a
    fourth and the low domain's by a twentieth.  No rate is under 1, so clean documents stay and some come twice."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.drawn(docs, labels, {"good": 1.25, "low": 1.05, "toxic": 0.0}, snap=0.0, least=1.0, settled=0.001)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with n_tokens, token_ids and round_trip."""
    return pieces.tokenised(docs, TOKENIZER, kind="bpe")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("simhash_near_dedup", near_dedup),
    ("secret_scan", secrets),
    ("mixing_weights", mixture),
    ("piece_encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs


#: No SQL engine shares the XXH64 fingerprints, the trained models or the tokenizer: tested against brute force.
ORACLE_SQL = None
