"""Loading the star: keyed upserts, dimensions from sales rows, year-partitioned facts, run log (K1-K5, K8, K9).

An upsert is a DataFrame operator: rows of the old table whose key is not in the new rows, and the new rows with one
row per key.  On files it rewrites only the year partitions that it touches.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut

SENTINEL = "1900-01-01"

CUSTOMER_COLUMNS = ["customer_city", "customer_state", "customer_tier", "customer_age_group", "customer_spending_tier",
                    "is_prime_member"]
PRODUCT_COLUMNS = ["product_name", "category", "subcategory", "brand", "base_price_2015", "weight_kg", "rating",
                   "is_prime_eligible", "launch_year", "model"]


def one_per_key(df: DataFrame, keys: list[str], order: list[str], last: bool = False) -> DataFrame:
    """The first (or last) row of each key by the order columns; a map-side aggregate, so a hot key is one row a task."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    return df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*").select(*df.columns)


def upsert(old: DataFrame | None, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """K1: rows of ``new`` (the last per key by ``order``) replace rows of ``old`` with their key; others are added.

    Doing it twice gives the same table.  ``old`` may be None (no table yet).
    """
    new = one_per_key(new, keys, order, last=True)
    if old is None:
        return new
    stay = old.join(new.select(*[F.col(k).alias(f"_n_{k}") for k in keys]),
                    [F.col(k).eqNullSafe(F.col(f"_n_{k}")) for k in keys], "left_anti")
    return stay.unionByName(new.select(*old.columns))


def _first(sales: DataFrame, key: str, columns: list[str], order: list[str]) -> DataFrame:
    cols = [c for c in columns if c in sales.columns]
    rows = sales.where(F.col(key).isNotNull())
    got = rows.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_r"))
    return got.select(key, *[F.col(f"_r.{c}").alias(c) for c in cols])


def load_customers(sales: DataFrame, order: list[str], columns: list[str] | None = None) -> DataFrame:
    """K2: the customer columns of each customer's first sales row, null customers left out."""
    return _first(sales, "customer_id", columns or CUSTOMER_COLUMNS, order)


def load_products(catalog: DataFrame, order: list[str]) -> DataFrame:
    """K3: the first catalog row of each product."""
    return _first(catalog, "product_id", PRODUCT_COLUMNS, order)


def with_sentinel(dim_time: DataFrame) -> DataFrame:
    """K9: the calendar with the sentinel day that unreadable order dates point to."""
    day = F.lit(SENTINEL).cast("date")
    values = {"date_id": day, "day": F.dayofmonth(day), "month": F.month(day), "quarter": F.quarter(day), "year": F.year(day),
              "is_weekend": F.weekday(day) >= 5, "is_festival": F.lit(False), "festival_name": F.lit(None)}
    row = dim_time.sparkSession.range(1).select(*[values[c].cast(t).alias(c) for c, t in dim_time.dtypes])
    return dim_time.where(F.col("date_id") != day).unionByName(row)


def load_facts(spark: SparkSession, path: str, sales: DataFrame, keys: list[str], order: list[str]) -> int:
    """K5: upsert into a fact table partitioned by ``order_year``; gives the number of rows taken in.

    Only partitions that get rows or lose an old version of one are rewritten; the merged rows are cut off first, as
    a partition is read and overwritten.
    """
    new = cut(one_per_key(sales, keys, order, last=True))
    n = new.count()
    if not n:
        return 0
    old = _table(spark, path)
    if old is not None:
        moved = old.join(new.select(*keys), keys, "left_semi").select("order_year").distinct()
        touched = [r[0] for r in moved.unionByName(new.select("order_year").distinct()).distinct().collect()]
        new = cut(upsert(old.where(F.col("order_year").isin(touched)), new, keys, order))
        gone = set(touched) - {r[0] for r in new.select("order_year").distinct().collect()}
        if gone:  # a partition that lost all rows is overwritten with none
            raise ValueError(f"years {sorted(gone)} would be left empty; drop their partitions first")
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("order_year").parquet(path)
    return n


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table of a path, None where there is none; any other fault is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _commits(spark: SparkSession, path: str) -> DataFrame | None:
    return _table(spark, f"{path}/commits")


def current_facts(spark: SparkSession, path: str) -> DataFrame | None:
    """K5: the fact table as of its last commit: of each year the folder that the latest commit names for it.

    None where nothing has been committed; a year without rows is named by no folder.
    """
    commits = _commits(spark, path)
    if commits is None:
        return None
    last = commits.groupBy("order_year").agg(F.max_by(F.struct("folder", "rows"), "version").alias("c"))
    years = last.select("order_year", "c.folder", "c.rows").orderBy("order_year").collect()  # a row a year
    kept = [r for r in years if r["rows"] > 0]
    if not kept:
        return None
    parts = [spark.read.parquet(f"{path}/data/{r['folder']}/order_year={r['order_year']}").withColumn("order_year", F.lit(r["order_year"])) for r in kept]
    return reduce(lambda a, b: a.unionByName(b), parts)


def commit_facts(spark: SparkSession, path: str, sales: DataFrame, keys: list[str], order: list[str]) -> int:
    """K5: the upsert of ``load_facts`` as one transaction; gives the number of rows taken in.

    The years that it touches are written to a new folder; then one small file in ``commits`` names that folder for all of
    them.  Readers (``current_facts``) see the old table until that file is there and the whole new one from then on, so a
    run that dies in between changes nothing.  One writer at a time; rows need an ``order_year``.
    """
    new = cut(one_per_key(sales, keys, order, last=True))
    n = new.count()
    if not n:
        return 0
    if new.where(F.col("order_year").isNull()).count():
        raise ValueError("rows without order_year")
    old = current_facts(spark, path)
    years = new.select("order_year").distinct()
    if old is not None:
        years = years.unionByName(old.join(new.select(*keys), keys, "left_semi").select("order_year").distinct()).distinct()
    touched = [r[0] for r in years.collect()]
    merged = cut(upsert(None if old is None else old.where(F.col("order_year").isin(touched)), new, keys, order))
    folder = uuid.uuid4().hex
    merged.write.partitionBy("order_year").parquet(f"{path}/data/{folder}")
    rows = {r["order_year"]: r["n"] for r in merged.groupBy("order_year").agg(F.count(F.lit(1)).alias("n")).collect()}
    version = 1 + (commits.agg(F.max("version")).first()[0] if (commits := _commits(spark, path)) is not None else 0)
    named = [(version, y, folder, rows.get(y, 0)) for y in touched]
    spark.createDataFrame(named, "version long, order_year int, folder string, rows long").coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return n


def append_run(log: DataFrame, path: str, run_ts: dt.datetime) -> None:
    """K8: one more row of the cleaning log, with the time of its run."""
    log.withColumn("run_timestamp", F.lit(run_ts.strftime("%Y%m%d_%H%M%S"))).coalesce(1).write.mode("append").json(path)


def last_runs(spark: SparkSession, path: str, n: int = 30) -> DataFrame:
    """K8: the summary of the last runs (a top-n report)."""
    return spark.read.json(path).orderBy(F.desc("run_timestamp")).limit(n)


def line_key() -> Column:
    """Key of a sales line in the test tables, where a transaction has several lines."""
    return F.concat_ws("-", "transaction_id", "line_number", "product_id", "supplier_id")
