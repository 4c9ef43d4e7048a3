"""Seller models: performance as of a date, its replay over several dates, tier history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartloom.functions.dates import date_literal
from cartloom.functions.numbers import exact_avg, from_cents, to_cents
from cartloom.functions.tiers import classify_tier
from cartloom.operators.scd2 import close_versions

# The date the performance is taken at, and the dates of the history replay.
SNAPSHOT_DATE = dt.date(2018, 10, 17)
REPLAY_DATES = (dt.date(2017, 1, 1), dt.date(2017, 6, 30), dt.date(2018, 1, 31), SNAPSHOT_DATE)

SELLER_KEY, SELLER_TIME = "seller_id", "updated_at"


def seller_performance(
    items: DataFrame,
    snapshot_date: dt.date | str = SNAPSHOT_DATE,
    updated_at: dt.datetime | str | Column | None = None,
    thresholds: Sequence[float] | None = None,
) -> DataFrame:
    """Sales of every seller up to ``snapshot_date``.

    ``updated_at`` is the time of the calculation, by default now; a fixed one makes runs
    repeatable. For the distinct counts Spark spreads (seller, order) and (seller, product) pairs
    over all tasks first, so a seller with a large share of the rows is not one task's work.
    Every pair carries the sums; as cents they are one machine word.
    """
    totals = (
        items.where(F.col("order_date") <= date_literal(snapshot_date))
        .groupBy(SELLER_KEY)
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.count_distinct("product_id").alias("unique_products"),
            F.sum(to_cents("price")).alias("cents"),
            F.count("price").alias("n_items"),
            F.min("order_date").alias("first_sale_date"),
            F.max("order_date").alias("last_sale_date"),
        )
    )
    return _finish(totals.withColumn(SELLER_TIME, _time(updated_at)), thresholds)


def seller_performance_rounds(
    items: DataFrame,
    rounds: Sequence[tuple[dt.date, dt.datetime]],
    thresholds: Sequence[float] | None = None,
) -> DataFrame:
    """``seller_performance`` for several (snapshot_date, updated_at) rounds in one pass.

    The dates are cumulative, so each item, each order of a seller and each product of a seller
    is counted in the first round that sees it, and a running sum over a seller's rounds gives
    the figures of each. Every item feeds three groups: its (seller, order) pair, its (seller,
    product) pair and its (seller, round) sums. All are combined before the shuffle and spread
    over all tasks, and the work is that of one round, however many there are.
    """
    rounds = sorted(rounds)
    if any(later[1] <= earlier[1] for earlier, later in zip(rounds, rounds[1:])):
        raise ValueError("a later snapshot date needs a later calculation time")
    last = len(rounds) - 1
    first_round = F.lit(last)
    for i in reversed(range(last)):
        first_round = F.when(F.col("order_date") <= rounds[i][0], i).otherwise(first_round)
    none = F.lit(None)

    def group(part: Column, order=none, product=none, cents=none, date=none) -> Column:
        return F.struct(
            # Sums are kept apart by round, the pairs are not.
            part.alias("part"),
            order.alias("order_id"),
            product.alias("product_id"),
            cents.alias("cents"),
            date.alias("date"),
        )

    groups = F.array(
        group(F.lit(-1), order=F.col("order_id")),
        group(F.lit(-2), product=F.col("product_id")),
        group(F.col("round"), cents=to_cents("price"), date=F.col("order_date")),
    )
    seen = (
        items.where(F.col("order_date") <= rounds[last][0])
        .withColumn("round", first_round)
        .select(SELLER_KEY, "round", F.inline(groups))
        .groupBy(SELLER_KEY, "part", "order_id", "product_id")
        .agg(
            F.min("round").alias("round"),
            F.sum("cents").alias("cents"),
            F.count("cents").alias("n_items"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
        )
    )
    per_round = seen.groupBy(SELLER_KEY, "round").agg(
        F.count("order_id").alias("orders"),
        F.count("product_id").alias("products"),
        F.sum("cents").alias("cents"),
        F.sum("n_items").alias("n_items"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    )
    in_order = Window.partitionBy(SELLER_KEY).orderBy("round")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = per_round.select(
        SELLER_KEY,
        F.sum("orders").over(so_far).alias("total_orders"),
        F.sum("products").over(so_far).alias("unique_products"),
        F.sum("cents").over(so_far).alias("cents"),
        F.sum("n_items").over(so_far).alias("n_items"),
        F.min("first_date").over(so_far).alias("first_sale_date"),
        F.max("last_date").over(so_far).alias("last_sale_date"),
        # A seller without new sales keeps its figures until its next round.
        F.sequence("round", F.coalesce(F.lead("round").over(in_order) - 1, F.lit(last))).alias("rounds"),
    )
    times = F.array(*[_time(updated_at) for _, updated_at in rounds])
    each = running.withColumn("round", F.explode("rounds")).withColumn(
        SELLER_TIME, F.element_at(times, F.col("round") + 1)
    )
    return _finish(each, thresholds)


def seller_tier_history(
    items: DataFrame,
    rounds: Sequence[tuple[dt.date, dt.datetime]],
    thresholds: Sequence[float] | None = None,
) -> DataFrame:
    """Type-2 history after a snapshot in every round, without writing the rounds one by one.

    Each round's calculation time is newer than the one before, so every seller present gets a
    version per round, as it does when the snapshots are taken one after the other.
    """
    # A seller has one row a round at most.
    return close_versions(seller_performance_rounds(items, rounds, thresholds), SELLER_KEY, SELLER_TIME, None)


def _time(updated_at: dt.datetime | str | Column | None) -> Column:
    if updated_at is None:
        updated_at = F.current_timestamp()
    elif not isinstance(updated_at, Column):
        # As text, so that no time zone of the Python process gets in.
        updated_at = F.lit(str(updated_at))
    return updated_at.cast("timestamp_ntz")


def _finish(totals: DataFrame, thresholds: Sequence[float] | None) -> DataFrame:
    totals = totals.withColumn("total_revenue", from_cents("cents"))
    return totals.select(
        SELLER_KEY,
        classify_tier("total_orders", "volume", thresholds).alias("seller_tier"),
        "total_orders",
        "unique_products",
        "total_revenue",
        # The mean item price, despite its name.
        exact_avg(F.col("total_revenue"), F.col("n_items")).alias("avg_order_value"),
        "first_sale_date",
        "last_sale_date",
        SELLER_TIME,
    )
