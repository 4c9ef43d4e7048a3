"""Tier classification shared by the seller and customer models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Tier names from best to worst and the lower bounds of the first three.
TIERS = ("platinum", "gold", "silver")
LOWEST_TIER = "bronze"
THRESHOLDS = {
    "volume": (500, 100, 20),
    "revenue": (10000, 5000, 1000),
}


def classify_tier(
    metric: Column | str, tier_type: str = "volume", thresholds: Sequence[float] | None = None
) -> Column:
    """Name the tier a metric reaches.

    An unknown ``tier_type`` uses the volume bounds, a NULL metric is the lowest tier, and
    ``thresholds`` (best tier first) replaces the bounds for data of another scale.
    """
    metric = F.col(metric) if isinstance(metric, str) else metric
    bounds = THRESHOLDS.get(tier_type, THRESHOLDS["volume"]) if thresholds is None else thresholds
    tier = F.lit(LOWEST_TIER)
    for name, bound in reversed(list(zip(TIERS, bounds, strict=True))):
        tier = F.when(metric >= bound, name).otherwise(tier)
    return tier


def better_tier(left: Column | str, right: Column | str) -> Column:
    """The higher of two tiers."""
    order = F.array(*[F.lit(name) for name in (*TIERS, LOWEST_TIER)])
    return F.element_at(
        order, F.least(F.array_position(order, _col(left)), F.array_position(order, _col(right))).cast("int")
    )


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
