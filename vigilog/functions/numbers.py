"""Guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is not positive."""
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * F.lit(100.0)


def page_count(total: Column, size: int) -> Column:
    return F.ceil(total.cast("double") / F.lit(size)).cast("bigint")
