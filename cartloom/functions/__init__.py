"""Column functions: pure expressions over built-ins, no UDFs."""

from cartloom.functions.casts import to_int, to_money, to_timestamp
from cartloom.functions.dates import date_literal, date_spine, days_between
from cartloom.functions.keys import surrogate_key, version_key
from cartloom.functions.numbers import exact_avg, from_cents, or_zero, to_cents
from cartloom.functions.tiers import better_tier, classify_tier

__all__ = [
    "better_tier",
    "classify_tier",
    "date_literal",
    "date_spine",
    "days_between",
    "exact_avg",
    "from_cents",
    "or_zero",
    "surrogate_key",
    "to_cents",
    "to_int",
    "to_money",
    "to_timestamp",
    "version_key",
]
