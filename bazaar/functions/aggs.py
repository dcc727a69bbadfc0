"""Aggregate expressions whose results do not depend on row order.

Money columns are DECIMAL, so ``SUM`` is exact; the result is cast to DOUBLE
once at the end.  An average is that exact sum divided by the count, which
gives the same double on every engine and every partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dsum(c: str | Column) -> Column:
    """Exact sum, returned as double."""
    return F.sum(_c(c)).cast("double")


def dmean(c: str | Column) -> Column:
    """Order-independent mean: exact sum / count of non-null values."""
    return F.sum(_c(c)).cast("double") / F.count(_c(c))


def ratio_of_sums(num: Column, den: Column) -> Column:
    """Mean recovered from pre-aggregated partial sums and counts."""
    return F.sum(num).cast("double") / F.sum(den)


def count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def pct(part: Column, whole: Column, digits: int | None = None) -> Column:
    v = part.cast("double") / whole * 100
    return F.round(v, digits) if digits is not None else v
