import os
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cartloom.session import setting, shared_dir
from cartloom.sources import (
    RAW_SCHEMAS,
    catalog_summary,
    create_namespace,
    csv_tables,
    drop_built,
    drop_table,
    ingest_directory,
    ingest_once,
    namespace_exists,
    quote,
    read_csv,
    read_seed,
    save_table,
    seed_cities,
    splittable,
    typed,
)
from cartloom.sources import csv, tables
from cartloom.sources.schemas import REAL, TEXT, WHOLE, schema
from cartloom.sources.seeds import CITIES_CSV, CITIES_SCHEMA


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


@pytest.fixture
def database(spark, tmp_path):
    name = "sources_test"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_bom_and_crlf(spark, tmp_path):
    text = "product_category_name,product_category_name_english\r\nbeleza_saúde,health\r\nbebês,baby\r\n"
    path = write(tmp_path / "t.csv", text, "utf-8-sig")
    df = read_csv(spark, path, RAW_SCHEMAS["product_category_name_translation"])
    assert [tuple(r) for r in df.collect()] == [("beleza_saúde", "health"), ("bebês", "baby")]
    untyped = read_csv(spark, path)
    assert untyped.columns == df.columns
    assert untyped.collect() == df.collect()


def test_missing_values_quotes_and_numbers(spark, tmp_path):
    text = 'id,name,n,x\n007,"said ""hi"", left",12.0,1.5\n,"",,\nNA,null,NaN,nan\n8, None ,3,1e2\n'
    df = read_csv(spark, write(tmp_path / "t.csv", text), schema(id=TEXT, name=TEXT, n=WHOLE, x=REAL))
    assert [tuple(r) for r in df.collect()] == [
        ("007", 'said "hi", left', 12, 1.5),
        (None, None, None, None),
        (None, None, None, None),
        ("8", " None ", 3, 100.0),
    ]


def test_line_breaks_in_quotes(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'id,text\n1,"two\nlines"\n2,x\n')
    rows = read_csv(spark, path, schema(id=WHOLE, text=TEXT), multiline=True).collect()
    assert [tuple(r) for r in rows] == [(1, "two\nlines"), (2, "x")]


@pytest.mark.parametrize("text", ["id,m\n1,2\n", "id,n\n1,two\n", "id,n\n1,2,3\n"])
def test_bad_files_raise(spark, tmp_path, text):
    path = write(tmp_path / "t.csv", text)
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_csv(spark, path, schema(id=WHOLE, n=WHOLE)).collect()


def test_ingest(spark, tmp_path, database):
    write(tmp_path / "shop_orders.csv", "order_id," + ",".join(RAW_SCHEMAS["orders"].names[1:]) + "\na,b,c,,,,,\n")
    write(tmp_path / "geo.csv", "zip,lat\n01,1.5\n02,2\n")
    write(tmp_path / "notes.txt", "not a table")
    spark.range(3).write.option("header", True).csv(str(tmp_path / "numbers.csv"))
    assert [r["table"] for r in csv_tables(spark, str(tmp_path)).collect()] == ["geo", "numbers", "shop_orders"]
    assert not namespace_exists(spark, database)
    report = ingest_once(spark, str(tmp_path), database, prefix="shop_")
    expected = [("geo", 2), ("numbers", 3), ("shop_orders", 1)]
    assert sorted(tuple(r) for r in report.collect()) == expected
    assert report.agg(F.sum("row_count")).first()[0] == 6
    assert spark.table(f"{database}.shop_orders").schema.names == RAW_SCHEMAS["orders"].names
    # Values that a number would change stay text.
    assert {r["zip"] for r in spark.table(f"{database}.geo").collect()} == {"01", "02"}
    assert ingest_once(spark, str(tmp_path), database) is None
    # A second load replaces the tables.
    again = ingest_directory(spark, str(tmp_path), database, prefix="shop_")
    assert sorted(tuple(r) for r in again.collect()) == expected


def test_ingest_of_an_empty_directory(spark, tmp_path, database):
    with pytest.raises(FileNotFoundError):
        ingest_directory(spark, str(tmp_path), database)
    assert not namespace_exists(spark, database)


def test_cleanup_and_summary(spark, database):
    create_namespace(spark, database)
    create_namespace(spark, database)
    names = ["stg_a", "stg_b", "int_a", "mart_a", "snap_a", "raw_a", "product_a", "intx", "cities"]
    for name in names:
        save_table(spark.range(2), f"{database}.{name}")
    spark.sql(f"CREATE VIEW {database}.stg_view AS SELECT * FROM {database}.stg_a")
    summary = catalog_summary(spark, database, ["raw_%", "product_%"])
    # The underscore of a pattern matches any character, so intx counts as intermediate.
    assert [tuple(r) for r in summary.collect()] == [
        ("Intermediate", 2), ("Other", 2), ("Snapshot", 1), ("Staging", 2),
    ]
    # Dropping takes the names literally.
    assert drop_built(spark, database) == ["int_a", "mart_a", "snap_a", "stg_a", "stg_b", "stg_view"]
    left = {t.name for t in spark.catalog.listTables(database) if not t.isTemporary}
    assert left == {"raw_a", "product_a", "intx", "cities"}


def test_overwrite_and_buckets(spark, database):
    create_namespace(spark, database)
    save_table(spark.range(5), f"{database}.t")
    save_table(spark.range(2), f"{database}.t")
    assert spark.table(f"{database}.t").count() == 2
    save_table(spark.range(7), f"{database}.t", "id", 4)
    assert spark.table(f"{database}.t").count() == 7
    spec = spark.sql(f"DESCRIBE EXTENDED {database}.t").where("col_name = 'Num Buckets'").first()
    assert spec["data_type"] == "4"


def test_seed(spark, tmp_path):
    df = seed_cities(spark)
    assert df.count() == 15
    assert dict(df.dtypes)["logistics_hub"] == "int"
    assert df.where("city = 'Brasília'").first()["region"] == "Central-West"
    path = write(tmp_path / "cities.csv", CITIES_CSV)
    assert read_seed(spark, path, CITIES_SCHEMA).collect() == df.collect()


def test_quote():
    assert quote("a`b c") == "`a``b c`"


def test_settings(spark, monkeypatch):
    assert setting(spark, "database", "shop") == "shop"
    monkeypatch.setenv("CARTLOOM_DATABASE", "from_env")
    assert setting(spark, "database", "shop") == "from_env"
    spark.conf.set("cartloom.database", "from_conf")
    assert setting(spark, "database", "shop") == "from_conf"
    spark.conf.unset("cartloom.database")


def test_shared_dir_is_below_the_named_folder(spark):
    first, second = shared_dir(spark), shared_dir(spark)
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir") + "/")


TWO_LINES = '1,"first line\nsecond line"\n2,x\n'


def test_line_breaks_in_quotes_by_default_and_split_files(spark, tmp_path, database):
    write(tmp_path / "notes.csv", "id,text\n" + TWO_LINES)
    ingest_directory(spark, str(tmp_path), database)
    assert {r["text"] for r in spark.table(f"{database}.notes").collect()} == {"first line\nsecond line", "x"}
    # Split over tasks, a quote that its line does not close raises.
    with pytest.raises((PySparkException, Py4JJavaError)):
        ingest_directory(spark, str(tmp_path), database, single_line=["notes"])
    assert spark.table(f"{database}.notes").count() == 2


def test_only_direct_children_are_tables(spark, tmp_path, database):
    folder = tmp_path / "dump.csv"
    folder.mkdir()
    write(folder / "things.csv", "id\n1\n2\n")
    (folder / "old").mkdir()
    write(folder / "old" / "things.csv", "id\n3\n")
    (folder / "empty.csv").mkdir()
    report = ingest_directory(spark, str(folder), database)
    assert [tuple(r) for r in report.collect()] == [("things", 2)]
    # The folder is itself called like a table, and holds parts where it is read as one.
    assert [tuple(r)[0] for r in csv_tables(spark, str(tmp_path)).collect()] == ["dump"]


def test_compressed_parts_and_names_that_clash(spark, tmp_path, database):
    spark.range(4).repartition(2).write.option("header", True).option("compression", "gzip").csv(str(tmp_path / "items.csv"))
    assert [tuple(r) for r in ingest_directory(spark, str(tmp_path), database).collect()] == [("items", 4)]
    write(tmp_path / "Items.csv", "id\n1\n")
    with pytest.raises(ValueError, match="both table"):
        ingest_directory(spark, str(tmp_path), database)
    assert spark.table(f"{database}.items").count() == 4


def test_parts_with_headers_in_another_order_raise(spark, tmp_path):
    (tmp_path / "t.csv").mkdir()
    write(tmp_path / "t.csv" / "a.csv", "a,b\n1,2\n")
    write(tmp_path / "t.csv" / "b.csv", "b,a\n2,1\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_csv(spark, str(tmp_path / "t.csv")).collect()


def test_a_load_that_died_is_not_complete(spark, tmp_path, database):
    write(tmp_path / "t.csv", "a\n1\n")
    create_namespace(spark, database)
    assert ingest_once(spark, str(tmp_path), database) is not None
    assert ingest_once(spark, str(tmp_path), database) is None


def test_failed_overwrite_keeps_the_old_table(spark, database):
    create_namespace(spark, database)
    save_table(spark.range(5), f"{database}.t")
    bad = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("bad"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises((PySparkException, Py4JJavaError)):
        save_table(bad, f"{database}.t")
    assert spark.table(f"{database}.t").count() == 5
    # A table may be replaced by what is read from it.
    save_table(spark.table(f"{database}.t").where("id > 2"), f"{quote(database)}.{quote('t')}")
    assert spark.table(f"{database}.t").count() == 2
    assert {t.name for t in spark.catalog.listTables(database) if not t.isTemporary} == {"t"}


def test_clustered_table_skips_other_days(spark, database):
    create_namespace(spark, database)
    rows = spark.range(20_000).select(F.expr("date_add(date'2020-01-01', CAST(id * 7 % 90 AS int))").alias("day"), "id")
    with_settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in with_settings.items():
        spark.conf.set(key, value)
    save_table(rows, f"{database}.t", cluster_by=["day", "id"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.table(f"{database}.t").groupBy(F.input_file_name().alias("f")).agg(F.min("day").alias("a"), F.max("day").alias("b"))
    ranges = sorted((r["a"], r["b"]) for r in files.collect())
    assert len(ranges) >= 4
    assert all(b <= c for (_, b), (c, _) in zip(ranges, ranges[1:]))
    found = spark.table(f"{database}.t").where("day = date'2020-02-01'")
    assert "PushedFilters: [IsNotNull(day), EqualTo(day" in found._jdf.queryExecution().executedPlan().toString()


def test_named_shared_dir_is_emptied(spark):
    first = shared_dir(spark, "named")
    spark.range(1).write.parquet(first)
    assert shared_dir(spark, "named") == first
    spark.range(1).write.parquet(first)


def records(path, count, note=lambda i: f'"said ""{i}"", left"'):
    with open(path, "w", newline="") as file:
        file.write("id,note\r\n")
        file.writelines(f"{i},{note(i)}\r\n" for i in range(count))
    return str(path)


def test_large_file_is_split_without_an_option(spark, tmp_path):
    columns = schema(id=WHOLE, note=TEXT)
    path = records(tmp_path / "t.csv", 400_000)
    df = read_csv(spark, path, columns)
    assert df.rdd.getNumPartitions() == 3  # 12 MB
    assert read_csv(spark, path, columns, multiline=True).rdd.getNumPartitions() == 1
    found = df.agg(F.count("*"), F.sum("id"), F.count_distinct("note"), F.max(F.length("note"))).first()
    assert tuple(found) == (400_000, 400_000 * 399_999 // 2, 400_000, len('said "399999", left'))


def test_files_with_line_breaks_in_values_are_read_whole(spark, tmp_path):
    columns, folder = schema(id=WHOLE, note=TEXT), tmp_path / "t a.csv"
    folder.mkdir()
    records(folder / "plain.csv", 300)
    records(folder / "broken 1.csv", 300, lambda i: '"two\nlines, ""x"""')
    df = read_csv(spark, str(folder), columns, split_bytes=100)
    assert df.where("note = 'two\\nlines, \"x\"'").count() == 300
    assert df.count() == 600
    assert df.select("id").distinct().count() == 300
    every = read_csv(spark, str(folder), columns, multiline=True)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, every.collect()))


@pytest.mark.parametrize(
    "text, alone",
    [
        ("a\n1\n", True), ("a\r\n1\r\n\r\n2", True), ('a\n"x ""y"" z"\n', True), ("a\n\n1\n", True), ("", True),
        ('a\n"x\ny"\n', False), ('a\n"x\n""y""\nz"\n', False), ("a\n1\r2\n", False), ("a\r1\r2\r", False),
        ("a\n  \n1\n", False), ("a\n \r\n1\n", False), ('a\n"x\ry"\n', False), ("a\n1\r\r\n", False),
    ],
)
def test_lines_that_are_rows(spark, tmp_path, text, alone):
    path = "file:" + write(tmp_path / "t é.csv", text)
    assert splittable(spark, [path]) == ([path] if alone else [])


@pytest.mark.parametrize("text", ["a\n  \n1\n", 'a\r\n"x\r\ny"\r\n2\r\n', "a\n1\n\n2\n", 'a\n"x ""y"" z"\n', "a\n", "a\r\n1\r\n2"])
def test_split_and_whole_files_give_the_same_rows(spark, tmp_path, text):
    path = write(tmp_path / "t.csv", text)
    found = [read_csv(spark, path, schema(a=TEXT), **o).collect() for o in ({"split_bytes": 0}, {"multiline": True})]
    assert found[0] == found[1]


def test_types_of_undeclared_columns(spark, tmp_path, database):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    header = "flag,small,large,real,mixed,zip,huge,beyond,word,none,signed,at"
    write(folder / "a.csv", f"{header}\nTrue,1,5000000000,1.5,3,01,99999999999999999999,9007199254740993,x,,+7,2017-01-01\n")
    write(folder / "b.csv", f"{header}\nfalse,-2,1,1e3,0.25,20,1,0.5,7,NaN,-0,2017-01-02\n,,NA,null,,,,,,,,\n")
    report = ingest_directory(spark, str(tmp_path), database)
    assert [tuple(r) for r in report.collect()] == [("t", 3)]
    table = spark.table(f"{database}.t")
    assert dict(table.dtypes) == {
        "flag": "boolean", "small": "int", "large": "bigint", "real": "double", "mixed": "double", "zip": "string",
        "huge": "string", "beyond": "string", "word": "string", "none": "string", "signed": "int", "at": "string",
    }
    rows = {tuple(r) for r in table.select("flag", "small", "large", "real", "mixed", "zip", "huge", "signed").collect()}
    assert rows == {
        (True, 1, 5_000_000_000, 1.5, 3.0, "01", "99999999999999999999", 7), (False, -2, 1, 1000.0, 0.25, "20", "1", 0), (None,) * 8,
    }
    ingest_directory(spark, str(tmp_path), database, infer=False)
    assert {kind for _, kind in spark.table(f"{database}.t").dtypes} == {"string"}
    assert read_csv(spark, str(folder)).schema == typed(read_csv(spark, str(folder)).where("false")).schema


def folders(tmp_path):
    return sorted(p.name for p in tmp_path.glob("db/t__versions/*"))


def test_a_replacement_that_dies_before_the_switch_leaves_the_old_rows(spark, database, tmp_path, monkeypatch):
    create_namespace(spark, database, str(tmp_path / "db"))
    name = f"{database}.t"
    save_table(spark.range(5), name)
    reader = spark.table(name)

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(tables, "_switch", die)
        with pytest.raises(RuntimeError):
            save_table(spark.range(9), name)
    assert spark.table(name).count() == 5
    assert len(folders(tmp_path)) == 2
    # Readers of the version before go on reading it.
    save_table(spark.range(7), name)
    assert (spark.table(name).count(), reader.count()) == (7, 5)
    save_table(spark.range(8), name)
    assert spark.table(name).count() == 8
    assert len(folders(tmp_path)) == 2
    assert {t.name for t in spark.catalog.listTables(database) if not t.isTemporary} == {"t"}


def test_the_switch_is_one_catalog_call(spark, database, tmp_path):
    create_namespace(spark, database, str(tmp_path / "db"))
    name = f"{database}.t"
    save_table(spark.range(5), name)
    before = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Created Time'").first()
    other = spark.newSession()
    save_table(spark.range(6), name)
    after = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Created Time'").first()
    assert before == after
    assert other.table(name).count() == 6
    # Other columns, or buckets, need a new entry.
    save_table(spark.range(3).withColumn("b", F.lit("x")), name)
    assert spark.table(name).columns == ["id", "b"]
    drop_table(spark, name)
    assert not spark.catalog.tableExists(name)
    assert folders(tmp_path) == []


def test_rows_are_counted_as_they_are_written(spark, database):
    create_namespace(spark, database)
    measures = {"rows": F.count("*"), "odd": F.count_if(F.col("id") % 2 == 1)}
    for options in ({}, {"bucket_by": "id", "buckets": 3}, {"cluster_by": ["id"]}):
        assert save_table(spark.range(11), f"{database}.t", measures=measures, **options) == {"rows": 11, "odd": 5}
    assert save_table(spark.range(0), f"{database}.t", measures=measures) == {"rows": 0, "odd": 0}


def test_two_loaders_load_once(spark, tmp_path, database, monkeypatch):
    write(tmp_path / "t.csv", "a\n" + "1\n" * 50)
    loads = []
    load = csv.ingest_directory
    monkeypatch.setattr(csv, "ingest_directory", lambda *a, **k: (loads.append(1), load(*a, **k))[1])
    with ThreadPoolExecutor(4) as pool:
        found = list(pool.map(lambda _: ingest_once(spark, str(tmp_path), database), range(4)))
    assert len(loads) == 1
    assert sum(r is not None for r in found) == 1
    assert spark.table(f"{database}.t").count() == 50


def test_a_claim_is_freed_and_lapses(spark, tmp_path):
    path = str(tmp_path / "claims" / "_loading")
    with pytest.raises(RuntimeError):
        with csv.claimed(spark, path):
            raise RuntimeError("failed")
    with csv.claimed(spark, path):
        start = time.time()
        old = time.time() - 100
        os.utime(path, (old, old))
        with csv.claimed(spark, path, lapse=50):  # the first holder is taken for lost
            assert time.time() - start < 30
    assert not os.path.exists(path)
