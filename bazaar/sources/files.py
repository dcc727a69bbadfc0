"""File sources and sinks: yearly sales CSVs, the product catalog, JSON artifacts, bound SQL."""

from __future__ import annotations

import logging
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}


def column_name(name: str, only_word_characters: bool = True) -> str:
    """Trimmed, lower case, white space runs as underscores; for sales nothing but word characters stays."""
    name = re.sub(r"\s+", "_", name.strip().lower())
    return re.sub(r"[^\w]", "", name) if only_word_characters else name


def source_year(path: str) -> int | None:
    """S3: the year at the end of a file's stem, after its last underscore."""
    stem = path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]
    last = stem.rsplit("_", 1)[-1]
    return int(last) if last.isdigit() else None


def list_files(spark: SparkSession, folder: str, pattern: str) -> list[tuple[str, int]]:
    """Paths and sizes of a folder's files that match and hold anything, by path; listed by Spark on any file system."""
    try:
        found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "length")
        return sorted((r["path"], r["length"]) for r in found.collect())  # one row a file
    except AnalysisException:
        return []


def read_sales(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """All matching files as text columns, united by name, with ``source_year`` where the file name has one.

    Unreadable and empty files are skipped with a warning; no matching or no usable file is an error.
    """
    files = list_files(spark, folder, pattern)
    if not files:
        raise FileNotFoundError(f"no file {pattern!r} in {folder}")
    parts: list[DataFrame] = []
    for path, _ in files:
        try:
            df = spark.read.options(**CSV_OPTIONS).csv(path)
        except AnalysisException as e:
            log.warning("skipped %s: %s", path, e)
            continue
        if df.isEmpty():
            log.warning("skipped empty file %s", path)
            continue
        df = df.toDF(*[column_name(c) for c in df.columns])
        year = source_year(path)
        if year is None:
            log.warning("no year in the name of %s", path)
        parts.append(df if year is None else df.withColumn("source_year", F.lit(year)))
    if not parts:
        raise ValueError(f"no usable file {pattern!r} in {folder}")
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The product catalog CSV as text columns."""
    try:
        df = spark.read.options(**CSV_OPTIONS).csv(path)
    except AnalysisException as e:
        raise FileNotFoundError(f"no product catalog at {path}") from e
    return df.toDF(*[column_name(c, only_word_characters=False) for c in df.columns])


def query(spark: SparkSession, sql: str, **params) -> DataFrame:
    """A SQL query with named parameters (``:name``), bound and not pasted in."""
    return spark.sql(sql, args=params)


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON artifact (an object, or an array of objects) as rows."""
    return spark.read.option("multiLine", "true").json(path)


def write_parquet(df: DataFrame, path: str, *partition_by: str) -> None:
    """K6."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """K7."""
    df.write.mode("overwrite").options(header="true", quote='"', escape='"').csv(path)
