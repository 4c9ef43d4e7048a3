"""Staging: typed, cleaned copies of the raw tables.

Filters act on the raw columns, before any cast, so they reach the file scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cartloom.functions.casts import to_int, to_money, to_timestamp

# The status staging drops, and those that do not count as a sale.
DROPPED_STATUS = "unavailable"
EXCLUDED_STATUSES = ("canceled", "unavailable")

ORDER_TIMES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def counts_as_sale(excluded: Sequence[str] = EXCLUDED_STATUSES) -> Column:
    """Orders with an excluded or unknown (NULL) status are no sale."""
    return ~F.col("order_status").isin(list(excluded))


def stg_orders(orders: DataFrame, dropped_status: str = DROPPED_STATUS) -> DataFrame:
    kept = orders.where(
        (F.col("order_status") != dropped_status) & F.col("order_purchase_timestamp").isNotNull()
    )
    return kept.select(
        "order_id",
        "customer_id",
        "order_status",
        *[to_timestamp(c).alias(c) for c in ORDER_TIMES],
        _purchase_date(),
    )


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.where(F.col("customer_id").isNotNull()).select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    )


def stg_order_items(items: DataFrame) -> DataFrame:
    kept = items.where(F.col("order_id").isNotNull() & (F.col("price") > 0))
    return kept.select(
        "order_id",
        to_int("order_item_id").alias("order_item_id"),
        "product_id",
        "seller_id",
        to_timestamp("shipping_limit_date").alias("shipping_limit_date"),
        to_money("price").alias("price"),
        to_money("freight_value").alias("freight_value"),
    )


def stg_order_payments(payments: DataFrame) -> DataFrame:
    kept = payments.where(F.col("order_id").isNotNull() & (F.col("payment_value") > 0))
    return kept.select(
        "order_id",
        to_int("payment_sequential").alias("payment_sequential"),
        "payment_type",
        to_int("payment_installments").alias("payment_installments"),
        to_money("payment_value").alias("payment_value"),
    )


def stg_order_items_snapshot(
    items: DataFrame, orders: DataFrame, excluded: Sequence[str] = EXCLUDED_STATUSES
) -> DataFrame:
    """Valid sold items with their order's time and status, from the raw tables."""
    valid = items.where(
        F.col("order_id").isNotNull() & F.col("seller_id").isNotNull() & (F.col("price") > 0)
    ).select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        to_money("price").alias("price"),
        to_money("freight_value").alias("freight_value"),
    )
    sold = orders.where(counts_as_sale(excluded) & F.col("order_purchase_timestamp").isNotNull()).select(
        "order_id",
        to_timestamp("order_purchase_timestamp").alias("order_purchase_timestamp"),
        _purchase_date(),
        "order_status",
    )
    return valid.join(sold, "order_id")


def _purchase_date() -> Column:
    return to_timestamp("order_purchase_timestamp").cast("date").alias("order_date")
