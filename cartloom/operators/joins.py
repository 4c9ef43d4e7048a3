"""Key-existence joins. No broadcast hints: Spark picks a broadcast only below its size threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_known_key(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key exists in ``parent``; parent columns are not needed, so nothing is multiplied.

    Parent rows are reduced to their keys before they are shuffled: in semi and anti joins Spark never splits
    the right side, so all rows of a hot key would meet in one task. The join uses the same shuffle.
    """
    return df.join(parent.select(key).distinct(), key, "left_semi")


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-null ``column`` has no ``field`` in the parent, whose keys are reduced first as above."""
    keys = parent.select(F.col(field).alias(column)).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """The missing keys with their number of child rows.

    Child rows are counted per key before the join, so a key that holds a large share of the
    rows crosses the network as one partial count per task.
    """
    counted = child.groupBy(column).agg(F.count("*").alias("n_rows"))
    return orphans(counted, column, parent, field)
