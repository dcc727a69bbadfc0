"""Readers for the parquet tables the star schema is derived from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; later selects/filters are pruned and pushed into it."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))
