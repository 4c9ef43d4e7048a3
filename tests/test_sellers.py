import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartloom.plans import (
    seller_performance,
    seller_performance_rounds,
    seller_tier_history,
    stg_order_items_snapshot,
)
from tests import shop
from tests.compare import spark_rows

START = dt.date(2017, 1, 1)
ROUNDS = [
    (START + dt.timedelta(days), dt.datetime(2020, 1, 1) + dt.timedelta(n))
    for n, days in enumerate((10, 25, 26, 90))
]


def sold(spark, rng, rows=400):
    """Items of few sellers, orders and products; orders repeat on other dates and under other sellers."""
    items = [
        (
            f"o{rng.randint(0, 60)}",
            None if rng.random() < 0.05 else f"p{rng.randint(0, 25)}",
            "hot" if rng.random() < 0.4 else f"s{rng.randint(0, 8)}",
            Decimal(rng.randint(0, 5000)) / 100,
            START + dt.timedelta(rng.randint(0, 110)),
        )
        for _ in range(rows)
    ]
    items.append(("o1", "p1", "late", Decimal(1), START + dt.timedelta(80)))
    items.append(("o1", "p1", "never", Decimal(1), START + dt.timedelta(100)))
    schema = "order_id string, product_id string, seller_id string, price decimal(10,2), order_date date"
    return spark.createDataFrame(items, schema)


def test_performance(spark):
    items = stg_order_items_snapshot(shop.raw(spark, "order_items"), shop.raw(spark, "orders"))
    at = dt.datetime(2018, 1, 1, 12, 30)
    rows = {r["seller_id"]: r.asDict() for r in seller_performance(items, updated_at=at).collect()}
    assert rows[shop.SELLER_A] == {
        "seller_id": shop.SELLER_A,
        "seller_tier": "bronze",
        "total_orders": 2,
        "unique_products": 3,
        "total_revenue": Decimal("40.00"),
        "avg_order_value": Decimal("13.3333333333333333"),
        "first_sale_date": dt.date(2017, 1, 2),
        "last_sale_date": dt.date(2017, 1, 9),
        "updated_at": at,
    }
    early = seller_performance(items, "2017-01-02", at).collect()
    assert {r["seller_id"]: r["total_orders"] for r in early} == {shop.SELLER_A: 1, shop.SELLER_B: 1}
    assert seller_performance(items, "2016-12-31", at).count() == 0


def test_performance_time_defaults_to_now(spark):
    items = sold(spark, random.Random(0))
    before = dt.datetime.now(dt.UTC).replace(tzinfo=None) - dt.timedelta(seconds=5)
    times = {r["updated_at"] for r in seller_performance(items).collect()}
    assert len(times) == 1
    assert before < times.pop() < before + dt.timedelta(minutes=5)


@pytest.mark.parametrize("seed", range(3))
def test_rounds_equal_single_runs(spark, seed):
    # Some without a seller, who make a group of their own.
    items = sold(spark, random.Random(seed)).withColumn("seller_id", F.nullif("seller_id", F.lit("s3"))).persist()
    together = seller_performance_rounds(items, ROUNDS, (30, 20, 10))
    single = [seller_performance(items, day, at, (30, 20, 10)) for day, at in ROUNDS]
    for df, (day, _) in zip(single, ROUNDS, strict=True):
        counted = items.where(F.col("order_date") <= day).groupBy("seller_id").agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.count_distinct("product_id").alias("unique_products"),
            F.sum("price").alias("total_revenue"),
            F.min("order_date").alias("first_sale_date"),
            F.max("order_date").alias("last_sale_date"),
        )
        assert spark_rows(df.select(counted.columns)) == spark_rows(counted)
    expected = single[0]
    for df in single[1:]:
        expected = expected.unionByName(df)
    assert together.columns == expected.columns
    assert together.dtypes == expected.dtypes
    assert spark_rows(together) == spark_rows(expected)
    items.unpersist()


def test_rounds_need_increasing_times(spark):
    items = sold(spark, random.Random(0))
    with pytest.raises(ValueError):
        seller_performance_rounds(items, [ROUNDS[0], (ROUNDS[1][0], ROUNDS[0][1])])


def test_history_has_one_version_per_round(spark):
    history = seller_tier_history(sold(spark, random.Random(1)), ROUNDS)
    versions = {}
    for r in history.orderBy("updated_at").collect():
        versions.setdefault(r["seller_id"], []).append((r["valid_from"], r["valid_to"]))
    times = [at for _, at in ROUNDS]
    assert versions["hot"] == list(zip(times, [*times[1:], None], strict=True))
    assert versions["late"] == [(times[3], None)]
    assert "never" not in versions
