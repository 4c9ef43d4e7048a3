"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cartloom.functions.casts import to_money

def or_zero(col: Column | str) -> Column:
    """The value, or 0 where it is NULL."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col, F.lit(0))


def exact_avg(total: Column, count: Column) -> Column:
    """Mean of a decimal sum with 16 decimal places; Spark's own ``avg`` keeps only six.

    Taking sum and count instead of the raw column also lets callers add up partial results.
    """
    return total.cast("decimal(20,2)") / count.cast("decimal(13,0)")


def to_cents(col: Column | str) -> Column:
    """Money as a whole number of cents, which adds up exactly and much faster than decimals."""
    return (to_money(col) * 100).cast("bigint")


def from_cents(cents: Column | str) -> Column:
    """A sum of cents as decimal(20,2)."""
    cents = F.col(cents) if isinstance(cents, str) else cents
    return (cents.cast("decimal(19,0)") / 100).cast("decimal(20,2)")
