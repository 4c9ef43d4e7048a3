"""The physical plans: what is pushed down, how often rows are shuffled, how hot keys are split."""

import contextlib
import re

import pytest
from pyspark.sql import functions as F

from cartloom.operators import orphan_keys
from cartloom.plans import sellers, stg_order_items_snapshot
from cartloom.sources import create_namespace, save_table
from cartloom.workload import QUERIES
from cartloom.workload import models as m
from cartloom.workload import tables as t
from tests.compare import spark_rows

SF_DIR = "/root/testdata/sf0.001"


@contextlib.contextmanager
def conf(spark, **settings):
    names = {key.replace("__", "."): value for key, value in settings.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture(autouse=True)
def large_tables(spark):
    """No table is small enough for a broadcast, as at scale."""
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        yield


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def tree(df):
    """The operator tree without the details below it."""
    return plan(df).split("\n\n")[0]


def count(df, operator):
    return len(re.findall(rf"(?:^|[\s+\-:]){operator} ", tree(df)))


# What writes or reads files on the way is executed, not one plan.
LAZY = sorted(
    set(QUERIES)
    - {"bucketed_join", "csv_ingest_report", "csv_ingest_total", "csv_scan", "drop_built_tables",
       "project_row_counts", "snap_seller_tier", "table_overwrite"}
)


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loops_and_no_python(spark, name):
    text = tree(QUERIES[name](spark, SF_DIR))
    for operator in ("NestedLoop", "Cartesian", "Python", "ArrowEval", "SinglePartition", "GlobalLimit"):
        assert operator not in text


def test_filters_and_columns_reach_the_scan(spark):
    items = m.sold_items(spark, SF_DIR)
    text = plan(items.where("order_date <= '1996-12-31'").select("seller_id", "product_id", "price"))
    # The date bound on a cast column arrives as a bound on the stored timestamp.
    assert re.search(r"PushedFilters: .*Not\(EqualTo\(o_orderstatus,P\)\).*LessThan\(o_orderdate,", text)
    assert re.search(r"PushedFilters: .*GreaterThan\(l_extendedprice,0\.0\)", text)
    schemas = re.findall(r"ReadSchema: struct<(.*)>", text)
    columns = {column.split(":")[0] for schema in schemas for column in schema.split(",")}
    assert columns == {
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "o_orderkey", "o_orderdate", "o_orderstatus",
    }


def test_daily_features_expand_last(spark):
    df = m.daily_features(spark, SF_DIR)
    # Payments by order, orders by order, days by customer and day, landing and customers by
    # customer, steps by customer. Nothing is shuffled or sorted after the days are expanded.
    assert count(df, "Exchange") == 6
    text = tree(df)
    expanding = text.index("Generate")
    assert expanding < min(text.index(op) for op in ("Exchange", "Sort ", "Window", "Join"))
    # Both windows use one sort.
    between = text[text.index("Window") : text.index("Exchange")]
    assert between.count("Window") == 2
    assert between.count("Sort") == 1


def test_seller_figures_read_the_items_once(spark):
    items = m.stored_items(spark, SF_DIR)
    one, four = sellers.seller_performance(items, *t.ROUNDS[-1]), sellers.seller_performance_rounds(items, t.ROUNDS)
    for df in (one, four):
        assert tree(df).count("Scan parquet") == 1
        # The large shuffle is by seller and pair; those after it move a few rows per seller.
        large = [line for line in plan(df).splitlines() if "hashpartitioning(" in line and "order_id" in line]
        assert len(large) == 1
        assert "product_id" in large[0]
    assert (count(one, "Exchange"), count(four, "Exchange")) == (2, 3)


def test_landing_combines_before_it_shuffles(spark):
    text = tree(QUERIES["int_customer_landing"](spark, SF_DIR))
    side = text[: text.index("Scan parquet")]
    assert side.count("HashAggregate") == 2
    assert side.count("Exchange") == 1


def test_report_scans_each_table_once(spark):
    df = QUERIES["data_test_report"](spark, SF_DIR)
    # orders, lineitem and customer, tested or referred to; one grouping of all entries, one of the tests.
    assert tree(df).count("Scan parquet") == 3
    assert plan(df).count("hashpartitioning(") == 2


def test_bucketed_tables_join_without_a_shuffle(spark):
    create_namespace(spark, "plan_test")
    save_table(m.stg_orders_input(spark, SF_DIR), "plan_test.stg_orders", "order_id", 4)
    save_table(m.payments_input(spark, SF_DIR), "plan_test.stg_order_payments", "order_id", 4)
    orders, payments = spark.table("plan_test.stg_orders"), spark.table("plan_test.stg_order_payments")
    paid = m.customers.paid_orders(orders, payments, t.EXCLUDED)
    assert count(paid, "Exchange") == 0
    assert count(m.customers.daily_payments(orders, payments, t.EXCLUDED), "Exchange") == 1
    spark.sql("DROP DATABASE plan_test CASCADE")


def hot_items(spark):
    """A third of the items in one order of one seller."""
    n = 30_000
    items = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("order_id"),
        F.col("id").cast("int").alias("order_item_id"),
        (F.col("id") % 97).alias("product_id"),
        F.when(F.col("id") % 3 == 1, 0).otherwise(F.col("id") % 50).alias("seller_id"),
        F.lit(1.25).alias("price"),
        F.lit(0.5).alias("freight_value"),
    )
    orders = spark.range(n).select(
        F.col("id").alias("order_id"),
        F.lit("delivered").alias("order_status"),
        F.lit("2017-05-06 07:08:09").alias("order_purchase_timestamp"),
    )
    return items, orders


def test_hot_order_is_split(spark):
    items, orders = hot_items(spark)
    settings = {
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
        "spark__sql__adaptive__coalescePartitions__enabled": "false",
    }
    with conf(spark, **settings):
        # Several map tasks, as a hot partition is split along them.
        df = stg_order_items_snapshot(items.repartition(16), orders)
        assert df.where("order_status = 'delivered'").count() == 30_000
        per_seller = df.groupBy("seller_id", "order_id").agg(F.count("*").alias("n"), F.sum("price").alias("sum"))
        rows = per_seller.collect()
        final = per_seller._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in final
    assert sum(r["n"] for r in rows) == 30_000
    expected = items.groupBy("seller_id", "order_id").agg(F.count("*").alias("n"), (F.count("*") * 1.25).alias("sum"))
    assert spark_rows(per_seller) == spark_rows(expected)


def test_hot_key_is_counted_before_the_join(spark):
    items, orders = hot_items(spark)
    df = orphan_keys(items, "order_id", orders.where("order_id <> 0"), "order_id")
    text = tree(df)
    # From the top: the join, then on its child side the final count, the shuffle, the partial count.
    places = [text.index("SortMergeJoin")]
    for operator in ("HashAggregate", "Exchange", "HashAggregate", "Range"):
        places.append(text.index(operator, places[-1] + 1))
    assert text[: places[-1]].count("Exchange") == 1
    assert [tuple(r) for r in df.collect()] == [(0, 10_000)]


def test_parents_are_reduced_to_keys_in_the_shuffle_of_the_join(spark):
    """A hot parent key: partial counts on the parent side, and no shuffle beyond those of the join."""
    items, orders = hot_items(spark)
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        df = orphan_keys(orders, "order_id", items, "order_id")
        text = tree(df)
        assert text.count("Exchange") == 2
        parent = text[text.rindex("Exchange") :]
        assert "HashAggregate" in parent
        assert df.count() == orders.select("order_id").subtract(items.select("order_id")).count()
