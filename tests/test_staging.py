import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from cartloom.plans import (
    stg_customers,
    stg_order_items,
    stg_order_items_snapshot,
    stg_order_payments,
    stg_orders,
)
from tests import shop


def test_stg_orders(spark):
    df = stg_orders(shop.raw(spark, "orders"))
    # Not the unavailable one, the one of unknown status and the one of unknown time.
    assert {r["order_id"] for r in df.collect()} == {f"o{n}" for n in range(1, 14)} - {"o5", "o7", "o8"}
    assert dict(df.dtypes)["order_purchase_timestamp"] == "timestamp_ntz"
    row = df.where("order_id = 'o2'").first()
    assert row["order_purchase_timestamp"] == dt.datetime(2017, 1, 2, 23, 59, 59)
    assert row["order_date"] == dt.date(2017, 1, 2)
    assert row["order_delivered_carrier_date"] is None


def test_rows_that_are_dropped_are_not_cast(spark):
    schema = shop.raw(spark, "orders").schema
    bad = [shop.order("x", "c", "unavailable", "no time")]
    assert stg_orders(spark.createDataFrame(bad, schema)).count() == 0
    with pytest.raises(PySparkException):
        stg_orders(spark.createDataFrame([shop.order("x", "c", "shipped", "no time")], schema)).collect()


def test_stg_customers(spark):
    df = stg_customers(shop.raw(spark, "customers"))
    assert df.count() == 6
    assert df.where("customer_id = 'c1'").first()["customer_zip_code_prefix"] == "01151"


def test_stg_order_items(spark):
    df = stg_order_items(shop.raw(spark, "order_items"))
    assert dict(df.dtypes)["price"] == "decimal(10,2)"
    assert df.where("order_id IS NULL OR order_id = 'o6'").count() == 0
    # Positive before the cast, 0.00 after it.
    assert df.where("order_id = 'o1' AND order_item_id = 2").first()["price"] == Decimal("0.00")
    assert df.count() == 9


def test_stg_order_payments(spark):
    df = stg_order_payments(shop.raw(spark, "order_payments"))
    assert {r["order_id"] for r in df.collect()} == {"o1", "o2", "o3", "o4", "o9", "o10", "o12", "o13", "gone"}
    assert dict(df.dtypes) == {
        "order_id": "string",
        "payment_sequential": "int",
        "payment_type": "string",
        "payment_installments": "int",
        "payment_value": "decimal(10,2)",
    }


def test_stg_order_items_snapshot(spark):
    df = stg_order_items_snapshot(shop.raw(spark, "order_items"), shop.raw(spark, "orders"))
    found = {(r["order_id"], r["order_item_id"]) for r in df.collect()}
    assert found == {("o1", 1), ("o1", 2), ("o2", 1), ("o4", 1)}
    assert df.columns == [
        "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value",
        "order_purchase_timestamp", "order_date", "order_status",
    ]
