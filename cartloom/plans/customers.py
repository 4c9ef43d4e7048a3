"""Customer models: landing date, dense daily features, tiers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cartloom.functions.dates import days_between
from cartloom.functions.keys import NULL_PART, surrogate_key
from cartloom.functions.numbers import exact_avg, from_cents, to_cents
from cartloom.functions.tiers import better_tier, classify_tier
from cartloom.operators.joins import with_known_key
from cartloom.operators.timeline import dense_timeline
from cartloom.plans.staging import EXCLUDED_STATUSES, counts_as_sale

# The day range of the feature table and its rolling windows in days.
FIRST_DAY = dt.date(2016, 1, 1)
LAST_DAY = dt.date(2018, 10, 31)
ROLLING_DAYS = (7, 14)


def customer_landing(
    orders: DataFrame, customers: DataFrame, excluded: Sequence[str] = EXCLUDED_STATUSES
) -> DataFrame:
    """First sale of every known customer.

    The minimum is taken before the customer check: it is combined map-side, so a customer with
    a large share of all orders is one row per task when it is shuffled and joined.
    """
    first = (
        orders.where(counts_as_sale(excluded))
        .groupBy("customer_id")
        .agg(F.min("order_purchase_timestamp").alias("first_order_timestamp"))
    )
    landed = with_known_key(first, customers, "customer_id").withColumn(
        "landing_date", F.col("first_order_timestamp").cast("date")
    )
    return landed.select(
        "customer_id",
        "first_order_timestamp",
        "landing_date",
        surrogate_key("customer_id", "landing_date").alias("customer_unique_key"),
    )


# The same as a query, for a view.
LANDING_SQL = f"""
SELECT customer_id, first_order_timestamp, landing_date,
       md5(concat_ws('-', CAST(customer_id AS STRING), coalesce(CAST(landing_date AS STRING), '{NULL_PART}'))) AS customer_unique_key
FROM (
    SELECT customer_id, first_order_timestamp, CAST(first_order_timestamp AS DATE) AS landing_date
    FROM (
        SELECT customer_id, min(order_purchase_timestamp) AS first_order_timestamp
        FROM {{stg_orders}} WHERE order_status NOT IN {{excluded}} GROUP BY customer_id)
    WHERE customer_id IN (SELECT DISTINCT customer_id FROM {{stg_customers}}))
"""


def paid_orders(
    orders: DataFrame, payments: DataFrame, excluded: Sequence[str] = EXCLUDED_STATUSES
) -> DataFrame:
    """Sold orders with the sum (in cents) and number of their payments, without the unpaid ones.

    Payments are added up per order before the join, so an order with very many payments joins
    as one row.
    """
    per_order = payments.groupBy("order_id").agg(
        F.sum(to_cents("payment_value")).alias("paid_cents"), F.count("payment_value").alias("n_payments")
    )
    sold = orders.where(counts_as_sale(excluded)).select(
        "order_id", "customer_id", F.col("order_purchase_timestamp").cast("date").alias("order_date")
    )
    return sold.join(per_order, "order_id")


def daily_payments(
    orders: DataFrame, payments: DataFrame, excluded: Sequence[str] = EXCLUDED_STATUSES
) -> DataFrame:
    """Paid value and number of paid orders per customer and day."""
    return (
        paid_orders(orders, payments, excluded)
        .groupBy("customer_id", "order_date")
        .agg(
            from_cents(F.sum("paid_cents")).alias("daily_payment_value"),
            F.count_distinct("order_id").alias("daily_order_count"),
        )
    )


def customer_daily_features(
    landing: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    first_day: dt.date | str = FIRST_DAY,
    last_day: dt.date | str = LAST_DAY,
    excluded: Sequence[str] = EXCLUDED_STATUSES,
) -> DataFrame:
    """Running totals and 7 and 14 day sums for every customer and day since the landing.

    The sums are decimal(18,2), the widest that is one machine word in memory and in files; this
    is by far the largest table.
    """
    daily = daily_payments(orders, payments, excluded)
    days = dense_timeline(
        landing.select("customer_id", "landing_date"),
        daily.withColumn("daily_payment_value", F.col("daily_payment_value").cast("decimal(18,2)")),
        key="customer_id",
        start="landing_date",
        day="order_date",
        measures={"payment": "daily_payment_value", "orders": "daily_order_count"},
        windows=ROLLING_DAYS,
        first=first_day,
        last=last_day,
    )
    return days.select(
        "customer_id",
        "date",
        "landing_date",
        F.col("payment_total").alias("total_payment_value"),
        days_between("date", "landing_date").alias("days_since_landing"),
        F.col("orders_total").alias("total_orders"),
        "payment_7d",
        "orders_7d",
        "payment_14d",
        "orders_14d",
    )


def customer_tiers(
    orders: DataFrame,
    payments: DataFrame,
    excluded: Sequence[str] = EXCLUDED_STATUSES,
    volume_thresholds: Sequence[float] | None = None,
    revenue_thresholds: Sequence[float] | None = None,
) -> DataFrame:
    """Lifetime figures per customer and their tiers; the composite is the better of the two."""
    totals = (
        paid_orders(orders, payments, excluded)
        .groupBy("customer_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            from_cents(F.sum("paid_cents")).alias("total_revenue"),
            F.sum("n_payments").alias("n_payments"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
    )
    tiered = totals.withColumns(
        {
            "tier_by_volume": classify_tier("total_orders", "volume", volume_thresholds),
            "tier_by_revenue": classify_tier("total_revenue", "revenue", revenue_thresholds),
        }
    )
    return tiered.select(
        "customer_id",
        "tier_by_volume",
        "tier_by_revenue",
        "total_orders",
        "total_revenue",
        # The mean payment, despite its name.
        exact_avg(F.col("total_revenue"), F.col("n_payments")).alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        better_tier("tier_by_volume", "tier_by_revenue").alias("composite_tier"),
    )
