"""Type-2 history: every change of a key becomes a version with a validity range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cartloom.functions.keys import version_key
from cartloom.operators.windows import ROWS_PER_TASK, over_key, quoted

HISTORY_COLUMNS = ("version_id", "valid_from", "valid_to")


def scd2_changes(open_versions: DataFrame, current: DataFrame, key: str, updated_at: str) -> DataFrame:
    """The open versions as they stand after ``current`` was seen, plus the new versions.

    A key that is new, or newer than its open version, gets a new open version; the version it
    replaces is closed at the new one's time. Equal or older rows change nothing, and keys
    missing from ``current`` stay open. Both sides hold one row per key, so this is one
    one-to-one join; both result rows come out of it in the same pass. A key that ``current`` holds twice raises.
    """
    columns, seen = _seen(current, key, updated_at)
    old = open_versions.select(F.col(key), F.struct(*columns, *HISTORY_COLUMNS).alias("old"))
    is_new = F.col("new").isNotNull() & _newer(updated_at)
    closed_at = F.when(is_new, F.col("new.valid_from"))
    kept = F.when(F.col("old").isNotNull(), F.col("old").withField("valid_to", closed_at))
    added = F.when(is_new, F.col("new"))
    joined = old.join(seen, key, "full_outer")
    versions = joined.select(F.explode(F.array(kept, added)).alias("v")).where(F.col("v").isNotNull())
    return versions.select("v.*")


def scd2_new_versions(open_versions: DataFrame, current: DataFrame, key: str, updated_at: str) -> DataFrame:
    """(key, new, old): only what ``current`` changes, the new version and the open one that it closes, if there is one.

    ``old`` has its end set. Open versions that stay as they are don't come out of the join; a key twice raises.
    """
    columns, seen = _seen(current, key, updated_at)
    old = open_versions.select(F.col(key), F.struct(*columns, *HISTORY_COLUMNS).alias("old"))
    changed = seen.join(old, key, "left").where(_newer(updated_at))
    closed = F.when(F.col("old").isNotNull(), F.col("old").withField("valid_to", F.col("new.valid_from")))
    return changed.select(key, "new", closed.alias("old"))


def _seen(current: DataFrame, key: str, updated_at: str) -> tuple[list[str], DataFrame]:
    """The columns of ``current``, and its keys with the version that each would open."""
    columns, current = current.columns, one_per_key(current, key)
    version = F.struct(
        *columns,
        version_key(key, updated_at).alias("version_id"),
        F.col(updated_at).alias("valid_from"),
        F.lit(None).cast(current.schema[updated_at].dataType).alias("valid_to"),
    )
    return columns, current.select(F.col(key), version.alias("new"))


def _newer(updated_at: str) -> Column:
    return F.col("old").isNull() | (F.col(f"new.{updated_at}") > F.col("old.valid_from"))


def one_per_key(current: DataFrame, key: str) -> DataFrame:
    """``current``, which raises when it is read if it holds a key twice.

    The grouping combines before its shuffle, which the join on the key then uses.
    """
    rows = current.groupBy(key).agg(F.count("*").alias("_n"), F.first(F.struct("*")).alias("_row"))
    message = F.concat(F.lit(f"{key} is not unique: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    single = F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.col("_row"))
    return rows.select(single.alias("_row")).select("_row.*")


def scd2_apply(history: DataFrame, current: DataFrame, key: str, updated_at: str) -> DataFrame:
    """The whole history after ``current`` was seen. Closed versions pass through unshuffled."""
    is_open = F.col("valid_to").isNull()
    changed = scd2_changes(history.where(is_open), current, key, updated_at)
    return history.where(~is_open).unionByName(changed)


def scd2_start(current: DataFrame, key: str, updated_at: str) -> DataFrame:
    """The history after the first sight of ``current``: everything is open. A key twice raises."""
    return one_per_key(current, key).select(
        "*",
        version_key(key, updated_at).alias("version_id"),
        F.col(updated_at).alias("valid_from"),
        F.lit(None).cast(current.schema[updated_at].dataType).alias("valid_to"),
    )


def close_versions(
    versions: DataFrame, key: str, updated_at: str, rows_per_task: int | None = ROWS_PER_TASK
) -> DataFrame:
    """History of versions that are all at hand: each one ends where the key's next one starts.

    A key may have any number of versions; ``rows_per_task=None`` says that none has many (see ``over_key``).
    """
    closed = over_key(versions, key, updated_at, following={"valid_to": updated_at}, rows_per_task=rows_per_task)
    return closed.select(
        *[F.col(quoted(c)) for c in versions.columns],
        version_key(key, updated_at).alias("version_id"),
        F.col(updated_at).alias("valid_from"),
        "valid_to",
    )
