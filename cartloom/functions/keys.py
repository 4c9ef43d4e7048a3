"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the text that stands for NULL inside a surrogate key.
NULL_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the text forms of ``cols`` joined by ``-``."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_PART)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def version_key(key: Column | str, updated_at: Column | str) -> Column:
    """md5 that identifies one version of one key."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in (key, updated_at)]
    return F.md5(F.concat_ws("|", *parts))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
