"""Declared schemas of the raw tables. Timestamps stay text until staging casts them."""

from __future__ import annotations

from pyspark.sql.types import DataType, DoubleType, IntegerType, StringType, StructField, StructType

TEXT, WHOLE, REAL = StringType(), IntegerType(), DoubleType()


def schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


RAW_SCHEMAS: dict[str, StructType] = {
    "orders": schema(
        order_id=TEXT,
        customer_id=TEXT,
        order_status=TEXT,
        order_purchase_timestamp=TEXT,
        order_approved_at=TEXT,
        order_delivered_carrier_date=TEXT,
        order_delivered_customer_date=TEXT,
        order_estimated_delivery_date=TEXT,
    ),
    "customers": schema(
        customer_id=TEXT,
        customer_unique_id=TEXT,
        # Text, so that leading zeros stay.
        customer_zip_code_prefix=TEXT,
        customer_city=TEXT,
        customer_state=TEXT,
    ),
    "order_items": schema(
        order_id=TEXT,
        order_item_id=WHOLE,
        product_id=TEXT,
        seller_id=TEXT,
        shipping_limit_date=TEXT,
        price=REAL,
        freight_value=REAL,
    ),
    "order_payments": schema(
        order_id=TEXT,
        payment_sequential=WHOLE,
        payment_type=TEXT,
        payment_installments=WHOLE,
        payment_value=REAL,
    ),
    "product_category_name_translation": schema(
        product_category_name=TEXT,
        product_category_name_english=TEXT,
    ),
}
