"""The star-schema tables in the roles of the raw commerce tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

# The order status that stands for orders that are no sale.
EXCLUDED = ("P",)
# The first and last order date of the tables.
FIRST_DAY, LAST_DAY = dt.date(1995, 1, 1), dt.date(2001, 8, 1)
# Snapshot rounds; each calculation takes place on the day after its date.
ROUNDS = [
    (dt.date(1995, 2, 28), dt.datetime(1995, 3, 1)),
    (dt.date(1995, 6, 30), dt.datetime(1995, 7, 1)),
    (dt.date(1996, 12, 31), dt.datetime(1997, 1, 1)),
    (dt.date(2001, 12, 31), dt.datetime(2002, 1, 1)),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders; approval and estimated delivery are the order date, shipping times are unknown."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.col("o_orderdate").alias("order_approved_at"),
        F.lit(None).cast("string").alias("order_delivered_carrier_date"),
        F.lit(None).cast("string").alias("order_delivered_customer_date"),
        F.col("o_orderdate").alias("order_estimated_delivery_date"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers; the market segment stands for the city, the nation for the state."""
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("customer_state")
    )
    customers = table(spark, sf_dir, "customer").join(nation, "c_nationkey", "left")
    return customers.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        "customer_state",
    )


def known_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers' keys alone, for models that only ask whether a customer exists."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines; the quantity stands for the freight value."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("freight_value"),
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line is one payment of its price, in as many instalments as its quantity."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.col("l_returnflag").alias("payment_type"),
        F.col("l_quantity").alias("payment_installments"),
        F.col("l_extendedprice").alias("payment_value"),
    )
