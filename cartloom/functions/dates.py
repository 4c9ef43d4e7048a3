"""Date arithmetic."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def date_literal(value: dt.date | str | Column) -> Column:
    """A date column from a date, ISO text or an existing column."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole days from ``earlier`` to ``later`` as an integer."""
    return F.datediff(later, earlier)


def date_spine(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """One row ``date_day`` per day from ``start`` up to but not including ``end``."""
    start, end = date_literal(start), date_literal(end)
    return spark.range(1).where(start < end).select(
        F.explode(F.sequence(start, F.date_sub(end, 1))).alias("date_day")
    )
