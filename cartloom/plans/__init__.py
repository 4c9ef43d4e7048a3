"""The models: each is a function from DataFrames to a DataFrame."""

from cartloom.plans.customers import (
    customer_daily_features,
    customer_landing,
    customer_tiers,
    daily_payments,
)
from cartloom.plans.project import MODELS, Project
from cartloom.plans.sellers import (
    seller_performance,
    seller_performance_rounds,
    seller_tier_history,
)
from cartloom.plans.staging import (
    stg_customers,
    stg_order_items,
    stg_order_items_snapshot,
    stg_order_payments,
    stg_orders,
)

__all__ = [
    "MODELS",
    "Project",
    "customer_daily_features",
    "customer_landing",
    "customer_tiers",
    "daily_payments",
    "seller_performance",
    "seller_performance_rounds",
    "seller_tier_history",
    "stg_customers",
    "stg_order_items",
    "stg_order_items_snapshot",
    "stg_order_payments",
    "stg_orders",
]
