"""Sources, sinks and catalog operations over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cartloom.operators.scd2 import scd2_apply, scd2_start
from cartloom.plans import sellers
from cartloom.plans.project import LANDING_VIEW, MODELS, SNAPSHOT, Project
from cartloom.session import configure, shared_dir
from cartloom.sources.csv import ingest_directory, ingest_once, read_csv
from cartloom.sources.history import BucketedHistoryTable, HistoryTable
from cartloom.sources.seeds import read_seed
from cartloom.sources.tables import create_namespace, drop_built, quote, row_counts, save_table
from cartloom.workload import models as m, tables as t
from cartloom.workload.registry import query

# A bucket is one task at the read: a few million short rows.
ROWS_PER_BUCKET = 4_000_000
INGESTED = ("customer", "lineitem", "nation", "orders", "part", "region", "supplier")


def new_database(spark: SparkSession, name: str) -> tuple[str, str]:
    """Name and shared location of the database of one query; what an earlier call left is replaced."""
    database = f"cartloom_{name}"
    spark.sql(f"DROP DATABASE IF EXISTS {quote(database)} CASCADE")
    return database, shared_dir(spark, name)


def write_csv(spark: SparkSession, sf_dir: str, tables: tuple[str, ...], name: str) -> str:
    """The tables as CSV folders in the shared folder of one query."""
    directory = shared_dir(spark, f"{name}_csv")
    for name in tables:
        t.table(spark, sf_dir, name).write.option("header", True).csv(f"{directory}/{name}.csv")
    return directory


@query(
    """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CAST(o_orderdate AS TIMESTAMP) AS o_orderdate, o_orderpriority
FROM orders
"""
)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV and read back with their declared types."""
    directory = write_csv(spark, sf_dir, ("orders",), "csv_scan")
    schema = t.table(spark, sf_dir, "orders").schema
    return read_csv(spark, f"{directory}/orders.csv", schema)


@query(" UNION ALL ".join(f'SELECT \'{name}\' AS "table", COUNT(*) AS row_count FROM {name}' for name in INGESTED))
def csv_ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory of CSVs loaded into a new database, one table per CSV, with row counts."""
    directory = write_csv(spark, sf_dir, INGESTED, "csv_ingest_report")
    database, location = new_database(spark, "csv_ingest_report")
    schemas = {name: t.table(spark, sf_dir, name).schema for name in INGESTED}
    return ingest_once(spark, directory, database, schemas=schemas, location=location)


@query("SELECT SUM(n) AS total_rows FROM (" + " UNION ALL ".join(f"SELECT COUNT(*) AS n FROM {name}" for name in INGESTED) + ")")
def csv_ingest_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total rows of an ingest without declared schemas, in which every column stays text."""
    directory = write_csv(spark, sf_dir, INGESTED, "csv_ingest_total")
    database, location = new_database(spark, "csv_ingest_total")
    report = ingest_directory(spark, directory, database, schemas={}, location=location)
    return report.agg(F.sum("row_count").alias("total_rows"))


CSV_NOTE = "'line one' || chr(10) || '\"' || {0} || '\", x' || chr(10) || ',end'"


@query(
    f"""
SELECT 'customer' AS "table", CAST(c_custkey AS BIGINT) AS id, c_name AS name, {CSV_NOTE.format('c_mktsegment')} AS note,
       CAST(c_acctbal AS VARCHAR) AS amount FROM customer
UNION ALL
SELECT 'orders', CAST(o_orderkey AS BIGINT), o_orderpriority, {CSV_NOTE.format('o_orderstatus')},
       CAST(o_totalprice AS VARCHAR) FROM orders
"""
)
def csv_ingest_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that come through an ingest: quotes, commas and line breaks in a text, plain and compressed part files."""
    directory = shared_dir(spark, "csv_ingest_values_csv")
    note = "concat('line one\n\"', {0}, '\", x\n,end') AS note"
    sources = {
        "customer": ("c_custkey AS id", "c_name AS name", note.format("c_mktsegment"), "CAST(c_acctbal AS STRING) AS amount"),
        "orders": ("o_orderkey AS id", "o_orderpriority AS name", note.format("o_orderstatus"), "CAST(o_totalprice AS STRING) AS amount"),
    }
    for name, columns in sources.items():
        rows = t.table(spark, sf_dir, name).selectExpr(*columns).repartition(3)
        writer = rows.write.option("header", True).option("escape", '"').option("quoteAll", True)
        writer.option("compression", "gzip" if name == "orders" else "none").csv(f"{directory}/{name}.csv")
    database, location = new_database(spark, "csv_ingest_values")
    schema = StructType([StructField("id", LongType()), *[StructField(c, StringType()) for c in ("name", "note", "amount")]])
    ingest_directory(spark, directory, database, dict.fromkeys(sources, schema), location=location)
    tables = [spark.table(f"{quote(database)}.{name}").select(F.lit(name).alias("table"), "*") for name in sources]
    return tables[0].union(tables[1])


TYPED = {
    "customer": "c_custkey:int,c_name:string,c_nationkey:int,c_mktsegment:string,zip:string,amount:double",
    "orders": "o_orderkey:int,o_custkey:int,o_orderstatus:string,o_large:bigint,o_digits:string,o_open:boolean",
}


@query(
    f"""
SELECT 'customer' AS "table", '{TYPED['customer']}' AS types, CAST(c_custkey AS BIGINT) AS key, CAST(c_nationkey AS BIGINT) AS number,
       c_mktsegment AS word, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS digits, CAST(c_custkey + 0.5 AS DOUBLE) AS amount, NULL AS flag
FROM customer
UNION ALL
SELECT 'orders', '{TYPED['orders']}', CAST(o_orderkey AS BIGINT), o_orderkey + 5000000000, o_orderstatus,
       '1234567890123456789' || CAST(o_orderkey AS VARCHAR), NULL, o_orderstatus = 'O'
FROM orders
"""
)
def csv_ingest_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that nobody declared, in the types their values allow over several part files, and these types."""
    directory = shared_dir(spark, "csv_ingest_types_csv")
    sources = {
        "customer": (
            "c_custkey", "c_name", "c_nationkey", "c_mktsegment",
            "lpad(CAST(c_nationkey AS STRING), 5, '0') AS zip", "CAST(c_custkey + 0.5 AS DOUBLE) AS amount",
        ),
        "orders": (
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderkey + 5000000000 AS o_large",
            "'1234567890123456789' || o_orderkey AS o_digits", "o_orderstatus = 'O' AS o_open",
        ),
    }
    for name, columns in sources.items():
        rows = t.table(spark, sf_dir, name).selectExpr(*columns).repartition(3)
        rows.write.option("header", True).csv(f"{directory}/{name}.csv")
    database, location = new_database(spark, "csv_ingest_types")
    ingest_directory(spark, directory, database, schemas={}, location=location)
    loaded = {name: spark.table(f"{quote(database)}.{name}") for name in sources}
    types = {name: F.lit(",".join(f"{c}:{kind}" for c, kind in df.dtypes)).alias("types") for name, df in loaded.items()}
    none = F.lit(None)
    customers = loaded["customer"].select(
        F.lit("customer").alias("table"), types["customer"], F.col("c_custkey").cast("bigint").alias("key"),
        F.col("c_nationkey").cast("bigint").alias("number"), F.col("c_mktsegment").alias("word"), F.col("zip").alias("digits"),
        "amount", none.cast("boolean").alias("flag"),
    )
    orders = loaded["orders"].select(
        F.lit("orders"), types["orders"], F.col("o_orderkey").cast("bigint"), "o_large", "o_orderstatus", "o_digits",
        none.cast("double"), "o_open",
    )
    return customers.union(orders)


@query(
    f"""
SELECT CAST(o_orderkey AS BIGINT) AS id, {CSV_NOTE.format('o_orderstatus')} AS note FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT CAST(o_orderkey AS BIGINT), 'one line, "' || o_orderpriority || '"' FROM orders WHERE o_orderstatus <> 'F'
"""
)
def csv_split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose files are read split over tasks, but for those in which a value breaks its line."""
    directory = shared_dir(spark, "csv_split_lines_csv")
    orders = t.table(spark, sf_dir, "orders")
    notes = {
        "o_orderstatus = 'F'": "concat('line one\n\"', o_orderstatus, '\", x\n,end') AS note",
        "o_orderstatus <> 'F'": "concat('one line, \"', o_orderpriority, '\"') AS note",
    }
    for rows, note in notes.items():
        writer = orders.where(rows).selectExpr("o_orderkey AS id", note).write.mode("append")
        writer.option("header", True).option("escape", '"').csv(f"{directory}/notes.csv")
    schema = StructType([StructField("id", LongType()), StructField("note", StringType())])
    return read_csv(spark, f"{directory}/notes.csv", schema, split_bytes=0)


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def table_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that held other rows before it was replaced."""
    database, location = new_database(spark, "table_overwrite")
    create_namespace(spark, database, location)
    name = f"{quote(database)}.part"
    part = t.table(spark, sf_dir, "part")
    save_table(part.select("p_partkey"), name)
    save_table(part, name)
    return spark.table(name)


@query(
    """
SELECT o_custkey AS customer_id, COUNT(*) AS n_lines, CAST(SUM(CAST(l_extendedprice AS DECIMAL(10,2))) AS DOUBLE) AS amount
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
GROUP BY 1
"""
)
def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, and payments added up per order, laid out by order, then joined without a shuffle."""
    database, location = new_database(spark, "bucketed_join")
    create_namespace(spark, database, location)
    orders, payments = f"{quote(database)}.stg_orders", f"{quote(database)}.stg_order_payments"
    paid = m.payments_input(spark, sf_dir).groupBy("order_id").agg(
        F.count("*").alias("n_lines"), F.sum("payment_value").alias("amount")
    )
    rows = m.stg_orders_input(spark, sf_dir)
    buckets = max(1, -(-rows.count() // ROWS_PER_BUCKET))
    save_table(rows, orders, "order_id", buckets)
    save_table(paid, payments, "order_id", buckets)
    joined = spark.table(orders).join(spark.table(payments), "order_id")
    return joined.groupBy("customer_id").agg(F.sum("n_lines").alias("n_lines"), F.sum("amount").alias("amount"))


@query("SELECT customer_id, landing_date FROM (" + m.LANDING_SQL + ")")
def view_materialization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model kept as a view in the catalog, made in one session and read in another."""
    database, location = new_database(spark, "view_materialization")
    create_namespace(spark, database, location)
    save_table(t.raw_orders(spark, sf_dir), f"{quote(database)}.raw_orders")
    save_table(t.raw_customers(spark, sf_dir), f"{quote(database)}.raw_customers")
    models = {n: MODELS[n] for n in ("stg_orders", "stg_customers")} | {"int_customer_landing": LANDING_VIEW}
    made = Project(spark, database, source_prefix="raw_", variables={"excluded": t.EXCLUDED}, models=models, location=location)
    made.run()
    other = Project(configure(spark.newSession()), database, models=models, location=location)
    return other.ref("int_customer_landing").select("customer_id", "landing_date")


@query("SELECT 'raw_orders' AS \"table\", COUNT(*) AS row_count FROM orders")
def drop_built_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of a raw and two built tables after the cleanup."""
    database, location = new_database(spark, "drop_built_tables")
    create_namespace(spark, database, location)
    orders = t.raw_orders(spark, sf_dir)
    for name in ("raw_orders", "stg_orders", "int_orders"):
        save_table(orders, f"{quote(database)}.{name}")
    drop_built(spark, database)
    left = sorted(table.name for table in spark.catalog.listTables(database) if not table.isTemporary)
    return row_counts(spark, database, left)


@query(
    f"""
WITH first AS ({m.ROUNDS_SQL[0]}), second AS ({m.ROUNDS_SQL[2]})
SELECT v.*, {m.VERSION_ID_SQL}, updated_at AS valid_from,
       CASE WHEN seller_id IN (SELECT seller_id FROM second) THEN TIMESTAMP '1997-01-01' END AS valid_to
FROM first v
UNION ALL
SELECT v.*, {m.VERSION_ID_SQL}, updated_at, NULL FROM second v
"""
)
def scd2_one_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One newer state applied to the history of a first one, without storing either."""
    items = m.sold_items(spark, sf_dir)
    first, second = (sellers.seller_performance(items, *r) for r in (t.ROUNDS[0], t.ROUNDS[2]))
    key, time = sellers.SELLER_KEY, sellers.SELLER_TIME
    return scd2_apply(scd2_start(first, key, time), second, key, time)


SNAP_SQL = f"""
WITH first AS ({m.ROUNDS_SQL[0]}), second AS ({m.ROUNDS_SQL[2]}), late AS ({m.ROUNDS_SQL[3]})
SELECT v.*, {m.VERSION_ID_SQL}, updated_at AS valid_from,
       CASE WHEN seller_id IN (SELECT seller_id FROM second) THEN TIMESTAMP '1997-01-01' END AS valid_to
FROM first v
UNION ALL
SELECT v.*, {m.VERSION_ID_SQL}, updated_at, NULL FROM second v
UNION ALL
SELECT v.* REPLACE (TIMESTAMP '1995-03-01' AS updated_at),
       md5(CAST(seller_id AS VARCHAR) || '|1995-03-01 00:00:00'), TIMESTAMP '1995-03-01', NULL
FROM late v
WHERE seller_id NOT IN (SELECT seller_id FROM first) AND seller_id NOT IN (SELECT seller_id FROM second)
"""


@query(SNAP_SQL)
def snap_seller_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored history: a first snapshot, a newer one that closes its versions, and a late one.

    The late one carries the time of the first, so it only adds sellers not seen before.
    """
    database, location = new_database(spark, "snap_seller_tier")
    create_namespace(spark, database, location)
    items = m.stored_items(spark, sf_dir)
    history = HistoryTable(spark, database, SNAPSHOT, sellers.SELLER_KEY, sellers.SELLER_TIME)
    for snapshot_date, updated_at in (t.ROUNDS[0], t.ROUNDS[2], (t.ROUNDS[3][0], t.ROUNDS[0][1])):
        history.apply(sellers.seller_performance(items, snapshot_date, updated_at))
    return history.read()


@query(SNAP_SQL)
def snap_seller_tier_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same three snapshots with the open versions in hash buckets, of which only those with a change are written."""
    database, location = new_database(spark, "snap_seller_tier_bucketed")
    create_namespace(spark, database, location)
    items = m.stored_items(spark, sf_dir)
    buckets = max(4, -(-t.table(spark, sf_dir, "supplier").count() // ROWS_PER_BUCKET))
    history = BucketedHistoryTable(spark, database, SNAPSHOT, sellers.SELLER_KEY, sellers.SELLER_TIME, buckets)
    for snapshot_date, updated_at in (t.ROUNDS[0], t.ROUNDS[2], (t.ROUNDS[3][0], t.ROUNDS[0][1])):
        history.apply(sellers.seller_performance(items, snapshot_date, updated_at))
    return history.read()


@query(
    f"""
WITH first AS ({m.ROUNDS_SQL[0]}), second AS ({m.ROUNDS_SQL[2]})
SELECT v.*, {m.VERSION_ID_SQL}, updated_at AS valid_from,
       CASE WHEN seller_id IN (SELECT seller_id FROM second) THEN TIMESTAMP '1997-01-01' END AS valid_to,
       CAST(NULL AS BIGINT) AS orders_now
FROM first v
UNION ALL
SELECT v.*, {m.VERSION_ID_SQL}, updated_at, NULL, total_orders FROM second v
"""
)
def snap_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored history whose second snapshot has its columns in another order and one more."""
    database, location = new_database(spark, "snap_new_column")
    create_namespace(spark, database, location)
    items = m.sold_items(spark, sf_dir)
    history = HistoryTable(spark, database, SNAPSHOT, sellers.SELLER_KEY, sellers.SELLER_TIME)
    first, second = (sellers.seller_performance(items, *r) for r in (t.ROUNDS[0], t.ROUNDS[2]))
    history.apply(first)
    return history.apply(second.select(F.col("total_orders").alias("orders_now"), *reversed(second.columns)))


@query(
    f"""
WITH first AS ({m.ROUNDS_SQL[0]}), second AS ({m.ROUNDS_SQL[2]})
SELECT seller_id, seller_tier, total_orders, total_revenue, TRUE AS is_first,
       seller_id NOT IN (SELECT seller_id FROM second) AS is_open FROM first
UNION ALL SELECT seller_id, seller_tier, total_orders, total_revenue, FALSE, TRUE FROM second
"""
)
def project_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The life of a project whose raw tables are found by name: staging models by tag, selected models with variables
    given at the run, and two snapshots."""
    database, location = new_database(spark, "project_by_name")
    create_namespace(spark, database, location)
    raw = {
        "orders": t.raw_orders(spark, sf_dir),
        "customers": t.raw_customers(spark, sf_dir),
        "order_items": t.raw_items(spark, sf_dir),
        "order_payments": t.raw_payments(spark, sf_dir),
    }
    for name, rows in raw.items():
        save_table(rows, f"{quote(database)}.raw_{name}")
    project = Project(spark, database, source_prefix="raw_", variables={"excluded": t.EXCLUDED}, location=location)
    project.run(["tag:staging"])
    project.run(["stg_order_items_snapshot"])
    for day, at in (t.ROUNDS[0], t.ROUNDS[2]):
        project.run(["int_seller_performance"], {"snapshot_date": str(day), "updated_at": at})
        history = project.snapshot()
    first = F.col("valid_from") == F.lit(str(t.ROUNDS[0][1])).cast("timestamp_ntz")
    return history.select(
        "seller_id", "seller_tier", "total_orders", "total_revenue", first.alias("is_first"),
        F.col("valid_to").isNull().alias("is_open"),
    )


@query(
    """
SELECT r_name AS region, n_name AS nation, COUNT(*) AS n_customers, CAST(SUM(c_custkey) AS BIGINT) AS keys
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2
"""
)
def seeds_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two small static tables read as seeds, stored, and joined to the customers."""
    directory = write_csv(spark, sf_dir, ("nation", "region"), "seeds_joined")
    database, location = new_database(spark, "seeds_joined")
    create_namespace(spark, database, location)
    for name in ("nation", "region"):
        seed = read_seed(spark, f"{directory}/{name}.csv", t.table(spark, sf_dir, name).schema)
        save_table(seed, f"{quote(database)}.{name}")
    nation, region = (spark.table(f"{quote(database)}.{name}") for name in ("nation", "region"))
    joined = t.table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    joined = joined.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy(F.col("r_name").alias("region"), F.col("n_name").alias("nation")).agg(
        F.count("*").alias("n_customers"), F.sum("c_custkey").cast("bigint").alias("keys")
    )


@query(
    f"""
WITH sold AS ({m.STG_ORDERS_SQL}), landing AS ({m.LANDING_SQL}), items AS ({m.SOLD_ITEMS_SQL}),
paid AS (SELECT o.* FROM sold o JOIN ({m.STG_PAYMENTS_SQL}) p ON o.order_id = p.order_id
         WHERE o.order_status NOT IN ('P'))
SELECT 'stg_orders' AS "table", COUNT(*) AS row_count FROM sold
UNION ALL SELECT 'stg_customers', COUNT(*) FROM customer
UNION ALL SELECT 'stg_order_items', COUNT(*) FROM lineitem WHERE l_extendedprice > 0
UNION ALL SELECT 'stg_order_payments', COUNT(*) FROM lineitem WHERE l_extendedprice > 0
UNION ALL SELECT 'stg_order_items_snapshot', COUNT(*) FROM items
UNION ALL SELECT 'int_customer_landing', COUNT(*) FROM landing
UNION ALL SELECT 'int_customer_daily_features',
                 CAST(SUM(DATE '2001-08-01' - landing_date + 1) AS BIGINT) FROM landing
UNION ALL SELECT 'int_seller_performance', COUNT(DISTINCT seller_id) FROM items
UNION ALL SELECT 'int_customer_tiers', COUNT(DISTINCT customer_id) FROM paid
UNION ALL SELECT 'snap_seller_tier', SUM(n) FROM (
    {' UNION ALL '.join(
        f"SELECT COUNT(DISTINCT seller_id) AS n FROM items WHERE order_date <= DATE '{d}'" for d, _ in t.ROUNDS
    )})
"""
)
def project_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All models built in order, the history replayed, and the rows of every table counted."""
    database, location = new_database(spark, "project_row_counts")
    project = Project(
        spark,
        database,
        sources={
            "orders": t.raw_orders(spark, sf_dir),
            "customers": t.raw_customers(spark, sf_dir),
            "order_items": t.raw_items(spark, sf_dir),
            "order_payments": t.raw_payments(spark, sf_dir),
        },
        variables={"first_day": t.FIRST_DAY, "last_day": t.LAST_DAY, "excluded": t.EXCLUDED},
        location=location,
    )
    built = project.run()
    project.replay(t.ROUNDS)
    return row_counts(spark, database, [*built, SNAPSHOT])
