"""The single operators the models are made of, over the star-schema tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartloom.functions import (
    better_tier,
    classify_tier,
    date_literal,
    date_spine,
    days_between,
    exact_avg,
    or_zero,
    surrogate_key,
    to_int,
    to_money,
    to_timestamp,
)
from cartloom.operators import (
    Check,
    close_versions,
    expand_days,
    failing_rows,
    orphan_keys,
    orphans,
    over_key,
    quality_report,
    rolling_sum,
    running_sum,
    with_known_key,
)
from cartloom.plans import customers
from cartloom.session import stored
from cartloom.workload import models as m, tables as t
from cartloom.workload.registry import query

# Projections, filters and predicates


@query(
    """
SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS line, CAST(l_quantity AS INTEGER) AS quantity,
       CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS DOUBLE) AS price,
       CAST(l_shipdate AS TIMESTAMP) AS shipped
FROM lineitem
"""
)
def text_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text cast to whole numbers, money and timestamps; ``23.0`` is a whole number."""
    raw = t.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        *[F.col(c).cast("string").alias(c) for c in ("l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")],
    )
    return raw.select(
        "l_orderkey",
        to_int("l_linenumber").alias("line"),
        to_int("l_quantity").alias("quantity"),
        to_money("l_extendedprice").alias("price"),
        to_timestamp("l_shipdate").alias("shipped"),
    )


@query(
    """
WITH s AS (SELECT NULLIF(o_orderstatus, 'O') AS status FROM orders)
SELECT 'all' AS predicate, COUNT(*) AS n_rows FROM s
UNION ALL SELECT 'not equal', COUNT(*) FROM s WHERE status <> 'P'
UNION ALL SELECT 'not null', COUNT(*) FROM s WHERE status IS NOT NULL
UNION ALL SELECT 'not in', COUNT(*) FROM s WHERE status NOT IN ('P', 'X')
"""
)
def null_aware_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that pass !=, IS NOT NULL and NOT IN when a third of the values is NULL, in one scan."""
    status = F.col("status")
    passed = {
        "all": F.lit(True),
        "not equal": status != "P",
        "not null": status.isNotNull(),
        "not in": ~status.isin("P", "X"),
    }
    rows = t.table(spark, sf_dir, "orders").select(F.nullif("o_orderstatus", F.lit("O")).alias("status"))
    counts = rows.agg(*[F.count_if(condition).alias(name) for name, condition in passed.items()])
    return counts.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("predicate"), F.col(n).alias("n_rows")) for n in passed]))
    )


@query(
    """
SELECT l_orderkey, l_linenumber, CAST(CAST(l_discount * 0.04 AS DECIMAL(10,2)) AS DOUBLE) AS amount
FROM lineitem WHERE l_discount * 0.04 > 0
"""
)
def positive_before_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small amounts that are positive in the raw data and 0.00 as money stay."""
    raw = t.table(spark, sf_dir, "lineitem").withColumn("raw", F.col("l_discount") * 0.04)
    return raw.where(F.col("raw") > 0).select("l_orderkey", "l_linenumber", to_money("raw").alias("amount"))


@query(
    """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '1996-01-01' AND CAST(o_orderdate AS DATE) <= DATE '1998-10-17'
"""
)
def date_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders between two days, both included."""
    order_date = F.col("o_orderdate").cast("date")
    within = order_date.between(date_literal("1996-01-01"), date_literal(dt.date(1998, 10, 17)))
    return t.table(spark, sf_dir, "orders").where(within).select("o_orderkey", order_date.alias("order_date"))


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'bl_e%' AND p_type NOT LIKE 'PROMO%'")
def like_prefix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIKE and NOT LIKE prefixes; the underscore matches any character."""
    part = t.table(spark, sf_dir, "part")
    matches = F.col("p_name").like("bl_e%") & ~F.col("p_type").like("PROMO%")
    return part.where(matches).select("p_partkey", "p_name")


# Joins


@query(
    """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, l_linenumber AS payment_sequential,
       CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS DOUBLE) AS payment_value
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
"""
)
def inner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with each of their payments."""
    orders = m.stg_orders_input(spark, sf_dir).select("order_id", "customer_id")
    payments = m.payments_input(spark, sf_dir)
    return orders.join(payments, "order_id").select(
        "order_id", "customer_id", "payment_sequential", "payment_value"
    )


@query(
    f"""
SELECT d.customer_id, d.order_date, CAST(COALESCE(p.daily_payment_value, 0) AS DOUBLE) AS paid,
       COALESCE(p.daily_order_count, 0) AS n_paid_orders
FROM (SELECT DISTINCT customer_id, order_date FROM ({m.STG_ORDERS_SQL})) d
LEFT JOIN ({m.DAILY_PAYMENTS_SQL}) p ON d.customer_id = p.customer_id AND d.order_date = p.order_date
"""
)
def left_join_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's order days with what was paid on them, 0 where nothing was."""
    orders = m.stg_orders_input(spark, sf_dir)
    days = orders.select("customer_id", "order_date").distinct()
    paid = customers.daily_payments(orders, m.payments_input(spark, sf_dir), t.EXCLUDED)
    return days.join(paid, ["customer_id", "order_date"], "left").select(
        "customer_id",
        "order_date",
        or_zero("daily_payment_value").alias("paid"),
        or_zero("daily_order_count").alias("n_paid_orders"),
    )


@query(
    f"""
SELECT d.date, COUNT(*) AS n_customers, MIN(l.landing_date) AS first_landing, MAX(l.landing_date) AS last_landing
FROM ({m.LANDING_SQL}) l
JOIN (SELECT CAST(UNNEST(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-01', INTERVAL 1 DAY))
                  AS DATE) AS date) d ON d.date >= l.landing_date
GROUP BY 1
"""
)
def customer_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer on each day since the landing, counted per day; made without a cross join."""
    landing = customers.customer_landing(
        m.stg_orders_input(spark, sf_dir), t.known_customers(spark, sf_dir), t.EXCLUDED
    )
    days = expand_days(landing.select("customer_id", "landing_date"), "landing_date", t.LAST_DAY)
    return days.groupBy("date").agg(
        F.count("*").alias("n_customers"),
        F.min("landing_date").alias("first_landing"),
        F.max("landing_date").alias("last_landing"),
    )


@query("SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that have lines."""
    keys = t.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return with_known_key(t.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), keys, "o_orderkey")


@query(
    """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey IS NOT NULL AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
"""
)
def anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without lines."""
    orders = t.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return orphans(orders, "o_orderkey", t.table(spark, sf_dir, "lineitem"), "l_orderkey")


@query(
    """
SELECT l_orderkey, COUNT(*) AS n_rows FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
GROUP BY 1
"""
)
def missing_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys of lines that are not among the sold orders, with their number of lines."""
    sold = t.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    return orphan_keys(t.table(spark, sf_dir, "lineitem"), "l_orderkey", sold, "o_orderkey")


# Aggregations


@query(
    f"""
SELECT o_orderstatus AS status, COUNT(*) AS n_orders,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(10,2))) AS DOUBLE) AS total,
       {m.mean_sql('CAST(o_totalprice AS DECIMAL(10,2))')} AS avg_price,
       CAST(MIN(o_orderdate) AS TIMESTAMP) AS first_time, CAST(MAX(o_orderdate) AS TIMESTAMP) AS last_time
FROM orders GROUP BY 1 ORDER BY 1
"""
)
def group_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, sum, exact mean, minimum and maximum per status, in order."""
    price = to_money("o_totalprice")
    return (
        t.table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderstatus").alias("status"))
        .agg(
            F.count("*").alias("n_orders"),
            F.sum(price).alias("total"),
            exact_avg(F.sum(price), F.count(price)).alias("avg_price"),
            F.min("o_orderdate").alias("first_time"),
            F.max("o_orderdate").alias("last_time"),
        )
        .orderBy("status")
    )


@query(
    f"""
SELECT customer_id, order_date, CAST(daily_payment_value AS DOUBLE) AS daily_payment_value, daily_order_count
FROM ({m.DAILY_PAYMENTS_SQL})
"""
)
def group_by_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paid value and paid orders per customer and day, the day taken from a timestamp."""
    return customers.daily_payments(
        m.stg_orders_input(spark, sf_dir), m.payments_input(spark, sf_dir), t.EXCLUDED
    )


@query(
    """
SELECT l_suppkey AS seller_id, COUNT(DISTINCT l_orderkey) AS orders, COUNT(DISTINCT l_partkey) AS products
FROM lineitem GROUP BY 1
"""
)
def count_distinct_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two distinct counts in one grouping."""
    return (
        t.table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("seller_id"))
        .agg(F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("products"))
    )


@query(
    """
SELECT l_suppkey AS seller_id,
       CASE WHEN COUNT(DISTINCT l_orderkey) >= 500 THEN 'platinum'
            WHEN COUNT(DISTINCT l_orderkey) >= 100 THEN 'gold'
            WHEN COUNT(DISTINCT l_orderkey) >= 20 THEN 'silver' ELSE 'bronze' END AS seller_tier
FROM lineitem GROUP BY 1
"""
)
def tier_over_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CASE over a distinct count."""
    return (
        t.table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("seller_id"))
        .agg(classify_tier(F.count_distinct("l_orderkey")).alias("seller_tier"))
    )


@query(
    """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem
GROUP BY 1, 2 HAVING COUNT(*) > 1
"""
)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated (order, line number) pairs."""
    lines = t.table(spark, sf_dir, "lineitem")
    return lines.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n_rows")).where("n_rows > 1")


# Window functions

SPARSE_WINDOW_SQL = f"""
SELECT customer_id, order_date,
       CAST(SUM(daily_payment_value) OVER total AS DOUBLE) AS value_total,
       CAST(SUM(daily_order_count) OVER total AS BIGINT) AS orders_total,
       CAST(SUM(daily_payment_value) OVER w7 AS DOUBLE) AS value_7,
       CAST(SUM(daily_order_count) OVER w7 AS BIGINT) AS orders_7,
       CAST(SUM(daily_payment_value) OVER w14 AS DOUBLE) AS value_14,
       CAST(SUM(daily_order_count) OVER w14 AS BIGINT) AS orders_14
FROM ({m.DAILY_PAYMENTS_SQL})
WINDOW total AS (PARTITION BY customer_id ORDER BY order_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       w7 AS (PARTITION BY customer_id ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
       w14 AS (PARTITION BY customer_id ORDER BY order_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)
"""


@query(SPARSE_WINDOW_SQL)
def running_and_rolling_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running, 7-row and 14-row sums over each customer's paid days."""
    daily = customers.daily_payments(
        m.stg_orders_input(spark, sf_dir), m.payments_input(spark, sf_dir), t.EXCLUDED
    )
    features = {}
    for name, column in (("value", "daily_payment_value"), ("orders", "daily_order_count")):
        features[f"{name}_total"] = running_sum(column, "customer_id", "order_date")
        for rows in (7, 14):
            features[f"{name}_{rows}"] = rolling_sum(column, "customer_id", "order_date", rows)
    return daily.select("customer_id", "order_date", *[c.alias(n) for n, c in features.items()])


@query(
    f"""
SELECT customer_id, order_date, daily_order_count,
       md5(CAST(customer_id AS VARCHAR) || '|' || CAST(order_date AS VARCHAR)) AS version_id,
       order_date AS valid_from,
       LEAD(order_date) OVER (PARTITION BY customer_id ORDER BY order_date) AS valid_to
FROM ({m.DAILY_PAYMENTS_SQL})
"""
)
def version_closing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's paid days as versions that last until the next one."""
    daily = customers.daily_payments(
        m.stg_orders_input(spark, sf_dir), m.payments_input(spark, sf_dir), t.EXCLUDED
    )
    return close_versions(daily.drop("daily_payment_value"), "customer_id", "order_date", None)


HOT_SQL = f"""
SELECT CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey END AS customer_id, o_orderkey AS order_id, paid FROM orders
JOIN (SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(10,2))) AS paid FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
"""


def hot_customer(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """Paid orders, a third of them of one customer, and a size of which that customer has many."""
    paid = m.payments_input(spark, sf_dir).groupBy("order_id").agg(F.sum("payment_value").alias("paid"))
    orders = t.raw_orders(spark, sf_dir).join(paid, "order_id")
    customer = F.when(F.col("customer_id") % 3 == 0, 0).otherwise(F.col("customer_id"))
    return stored(orders.select(customer.alias("customer_id"), "order_id", "paid")), 500


@query(
    f"""
SELECT customer_id, order_id, CAST(SUM(paid) OVER total AS DOUBLE) AS paid_total, ROW_NUMBER() OVER total AS orders_total,
       CAST(SUM(paid) OVER w7 AS DOUBLE) AS paid_7, CAST(SUM(paid) OVER w14 AS DOUBLE) AS paid_14
FROM ({HOT_SQL})
WINDOW total AS (PARTITION BY customer_id ORDER BY order_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       w7 AS (PARTITION BY customer_id ORDER BY order_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
       w14 AS (PARTITION BY customer_id ORDER BY order_id ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)
"""
)
def hot_key_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running, 7-row and 14-row sums where one customer has a third of all orders, split over tasks."""
    rows, size = hot_customer(spark, sf_dir)
    found = over_key(
        rows, "customer_id", "order_id", running={"paid_total": "paid", "orders_total": F.lit(1)},
        rolling={"paid_7": ("paid", 7), "paid_14": ("paid", 14)}, rows_per_task=size,
    )
    return found.drop("paid")


@query(
    f"""
SELECT customer_id, order_id, md5(CAST(customer_id AS VARCHAR) || '|' || CAST(order_id AS VARCHAR)) AS version_id,
       order_id AS valid_from, LEAD(order_id) OVER (PARTITION BY customer_id ORDER BY order_id) AS valid_to
FROM ({HOT_SQL})
"""
)
def hot_key_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions that last until the key's next one where one key has a third of all versions, split over tasks."""
    rows, size = hot_customer(spark, sf_dir)
    return close_versions(rows.drop("paid"), "customer_id", "order_id", size)


# Scalar functions and reusable expressions


@query(
    """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
       CAST(CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS INTEGER) AS days,
       COALESCE(CASE WHEN o_orderstatus <> 'P' THEN o_custkey END, 0) AS customer_or_zero,
       CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'other' END AS label
FROM orders
"""
)
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day of a timestamp, day difference, COALESCE with 0, CASE and a date literal."""
    order_date, status = F.to_date("o_orderdate"), F.col("o_orderstatus")
    return t.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        order_date.alias("order_date"),
        days_between(order_date, date_literal("1995-01-01")).alias("days"),
        or_zero(F.when(status != "P", F.col("o_custkey"))).alias("customer_or_zero"),
        F.when(status == "F", "done").when(status == "O", "open").otherwise("other").alias("label"),
    )


@query(
    """
SELECT o_orderkey,
       CASE WHEN v >= 500 THEN 'platinum' WHEN v >= 100 THEN 'gold' WHEN v >= 20 THEN 'silver' ELSE 'bronze' END AS volume,
       CASE WHEN r >= 10000 THEN 'platinum' WHEN r >= 5000 THEN 'gold' WHEN r >= 1000 THEN 'silver' ELSE 'bronze' END AS revenue,
       CASE WHEN v >= 500 THEN 'platinum' WHEN v >= 100 THEN 'gold' WHEN v >= 20 THEN 'silver' ELSE 'bronze' END AS unknown_type,
       CASE WHEN v >= 300 THEN 'platinum' WHEN v >= 200 THEN 'gold' WHEN v >= 10 THEN 'silver' ELSE 'bronze' END AS own_bounds
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS v, o_totalprice / 20 AS r FROM orders)
"""
)
def tier_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiers by volume, by revenue, by an unknown type and by own bounds; some metrics are NULL."""
    rows = t.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("v"),
        (F.col("o_totalprice") / 20).alias("r"),
    )
    return rows.select(
        "o_orderkey",
        classify_tier("v").alias("volume"),
        classify_tier("r", "revenue").alias("revenue"),
        classify_tier("v", "loyalty").alias("unknown_type"),
        classify_tier("v", thresholds=(300, 200, 10)).alias("own_bounds"),
    )


@query(
    """
SELECT volume, revenue, CASE WHEN 'platinum' IN (volume, revenue) THEN 'platinum'
                             WHEN 'gold' IN (volume, revenue) THEN 'gold'
                             WHEN 'silver' IN (volume, revenue) THEN 'silver' ELSE 'bronze' END AS best,
       COUNT(*) AS n_orders
FROM (
    SELECT CASE WHEN o_custkey >= 500 THEN 'platinum' WHEN o_custkey >= 100 THEN 'gold'
                WHEN o_custkey >= 20 THEN 'silver' ELSE 'bronze' END AS volume,
           CASE WHEN o_totalprice / 20 >= 10000 THEN 'platinum' WHEN o_totalprice / 20 >= 5000 THEN 'gold'
                WHEN o_totalprice / 20 >= 1000 THEN 'silver' ELSE 'bronze' END AS revenue
    FROM orders
) GROUP BY ALL
"""
)
def composite_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The better of two tiers, counted for every pair that occurs."""
    tiers = t.table(spark, sf_dir, "orders").select(
        classify_tier("o_custkey").alias("volume"),
        classify_tier(F.col("o_totalprice") / 20, "revenue").alias("revenue"),
    )
    return tiers.groupBy("volume", "revenue", better_tier("volume", "revenue").alias("best")).agg(
        F.count("*").alias("n_orders")
    )


@query(
    """
SELECT o_orderkey,
       md5(CAST(o_custkey AS VARCHAR) || '-' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '-' ||
           COALESCE(NULLIF(o_orderstatus, 'P'), '_dbt_utils_surrogate_key_null_')) AS key
FROM orders
"""
)
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash keys over a number, a date and a text that may be NULL."""
    return t.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        surrogate_key(
            "o_custkey", F.to_date("o_orderdate"), F.nullif("o_orderstatus", F.lit("P"))
        ).alias("key"),
    )


@query(
    """
SELECT CAST(d AS DATE) AS date_day, COUNT(o_orderkey) AS n_orders
FROM (SELECT UNNEST(generate_series(TIMESTAMP '1994-12-01', TIMESTAMP '2001-08-31', INTERVAL 1 DAY)) AS d)
LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE)
GROUP BY 1
"""
)
def orders_on_date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per day, with a row for days without any."""
    per_day = t.table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("date_day")).agg(
        F.count("*").alias("n")
    )
    spine = date_spine(spark, "1994-12-01", "2001-09-01")
    return spine.join(per_day, "date_day", "left").select("date_day", or_zero("n").alias("n_orders"))


# Data tests

SALE_STATUSES = ("F", "O")


def tested_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Orders with a NULL priority where it is not specified, and their lines."""
    orders = t.table(spark, sf_dir, "orders").withColumn(
        "o_orderpriority", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED"))
    )
    return {
        "orders": orders,
        "lineitem": t.table(spark, sf_dir, "lineitem"),
        "customer": t.table(spark, sf_dir, "customer"),
    }


ORDER_CHECKS = [
    Check("o_orderkey", "unique"),
    Check("o_orderkey", "not_null"),
    Check("o_orderpriority", "not_null"),
    Check("o_orderstatus", "accepted_values", severity="warn", values=SALE_STATUSES),
    Check("o_custkey", "relationships", to="customer", field="c_custkey"),
    Check("o_orderkey", "relationships", severity="warn", to="lineitem", field="l_orderkey"),
]
LINE_CHECKS = [Check("l_orderkey", "unique"), Check("l_orderkey", "not_null")]


@query("SELECT l_orderkey, COUNT(*) AS n_rows FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1")
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys that repeat among the lines."""
    return failing_rows(LINE_CHECKS[0], "lineitem", tested_tables(spark, sf_dir))


@query(
    """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderpriority IS NULL OR o_orderpriority = '4-NOT SPECIFIED'
"""
)
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without a priority."""
    failing = failing_rows(ORDER_CHECKS[2], "orders", tested_tables(spark, sf_dir))
    return failing.select("o_orderkey", "o_custkey")


@query(
    """
SELECT o_orderstatus, COUNT(*) AS n_rows FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1
"""
)
def check_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses outside the accepted ones."""
    return failing_rows(ORDER_CHECKS[3], "orders", tested_tables(spark, sf_dir))


@query(
    """
SELECT o_orderkey, COUNT(*) AS n_rows FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY 1
"""
)
def check_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that no line refers to."""
    return failing_rows(ORDER_CHECKS[5], "orders", tested_tables(spark, sf_dir))


@query(
    """
WITH r(model, "column", test, severity, failures) AS (
    SELECT 'orders', 'o_orderkey', 'unique', 'error',
           (SELECT COUNT(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING COUNT(*) > 1))
    UNION ALL SELECT 'orders', 'o_orderkey', 'not_null', 'error', (SELECT COUNT(*) FROM orders WHERE o_orderkey IS NULL)
    UNION ALL SELECT 'orders', 'o_orderpriority', 'not_null', 'error',
           (SELECT COUNT(*) FROM orders WHERE o_orderpriority IS NULL OR o_orderpriority = '4-NOT SPECIFIED')
    UNION ALL SELECT 'orders', 'o_orderstatus', 'accepted_values', 'warn',
           (SELECT COUNT(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus NOT IN ('F', 'O'))
    UNION ALL SELECT 'orders', 'o_custkey', 'relationships', 'error',
           (SELECT COUNT(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
    UNION ALL SELECT 'orders', 'o_orderkey', 'relationships', 'warn',
           (SELECT COUNT(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))
    UNION ALL SELECT 'lineitem', 'l_orderkey', 'unique', 'error',
           (SELECT COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING COUNT(*) > 1))
    UNION ALL SELECT 'lineitem', 'l_orderkey', 'not_null', 'error', (SELECT COUNT(*) FROM lineitem WHERE l_orderkey IS NULL)
)
SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM r
"""
)
def data_test_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All data tests of orders and lines with their failures and status."""
    return quality_report(tested_tables(spark, sf_dir), {"orders": ORDER_CHECKS, "lineitem": LINE_CHECKS})
