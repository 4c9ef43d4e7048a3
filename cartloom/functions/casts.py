"""Casts from raw text or numbers to the staging types. NULL stays NULL, bad input raises (ANSI)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def to_timestamp(col: Column | str) -> Column:
    """Timestamp without zone."""
    return F.col(col).cast("timestamp_ntz") if isinstance(col, str) else col.cast("timestamp_ntz")


def to_int(col: Column | str) -> Column:
    """Whole number; ``12.0`` is accepted and fractions round half to even."""
    col = F.col(col) if isinstance(col, str) else col
    return F.rint(col.cast("double")).cast("int")


def to_money(col: Column | str) -> Column:
    """decimal(10,2), rounded half up; too large a value raises."""
    col = F.col(col) if isinstance(col, str) else col
    return col.cast("decimal(10,2)")
