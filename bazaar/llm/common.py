"""Shared helpers: table reading, packed rows, lineage cuts.

Every operator takes any DataFrame with the columns it names and selects just those, so extra columns of any name
cannot clash.  Stages that give whole rows back pack the input row in one struct first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.session import ensure_checkpoint_dir, stored  # noqa: F401

ROW = "_row"
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"  # vocabulary file of the registered queries and the pipeline
#: Words of all operators here: runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD_BREAKS = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Lineage cut in the shared folder of ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def packed(docs: DataFrame, *names: str) -> DataFrame:
    """The whole input row as struct ``_row`` beside the named columns."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias(ROW), *[docs[n] for n in names])


def unpacked(df: DataFrame) -> DataFrame:
    return df.select(f"{ROW}.*")


def with_text(df: DataFrame, docs_columns: list[str], text: Column) -> DataFrame:
    """Packed rows given back with another text; n_chars follows where the table has it."""
    # a step of its own: beside an alias "text", a lambda would take the alias for the column
    df, text = df.withColumn("_clean", text), F.col("_clean")
    out = []
    for c in docs_columns:
        if c == "text":
            out.append(text.alias(c))
        elif c == "n_chars":
            out.append(F.coalesce(F.length(text), F.lit(0)).cast(df.schema[ROW].dataType[c].dataType).alias(c))
        else:
            out.append(F.col(f"{ROW}.`{c}`").alias(c))
    return df.select(*out)
