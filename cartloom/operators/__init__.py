"""Reusable relational operators over any DataFrame; column names are parameters."""

from cartloom.operators.joins import orphan_keys, orphans, with_known_key
from cartloom.operators.quality import Check, enforce, failing_rows, quality_report
from cartloom.operators.scd2 import close_versions, scd2_changes, scd2_apply
from cartloom.operators.timeline import dense_timeline, expand_days
from cartloom.operators.windows import over_key, rolling_sum, running_sum

__all__ = [
    "Check",
    "close_versions",
    "dense_timeline",
    "enforce",
    "expand_days",
    "failing_rows",
    "orphan_keys",
    "orphans",
    "quality_report",
    "over_key",
    "rolling_sum",
    "running_sum",
    "scd2_apply",
    "scd2_changes",
    "with_known_key",
]
